"""Running a function over whole groups of rows inside sorted partitions."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T


def beside(frame: DataFrame, name: str, more: str) -> T.StructType:
    """The schema of one column of ``frame``, whatever its fields are called, and of ``more`` columns."""
    return T.StructType([frame.schema[name], *T.StructType.fromDDL(more).fields])


def quoted(name: str) -> str:
    """A column's name as Spark parses it."""
    return f"`{name.replace('`', '``')}`"


def per_group(
    df: DataFrame,
    keys: list[str],
    use: Callable[[pa.Table], pa.Table | None],
    schema: str,
    parts: int | None = None,
) -> DataFrame:
    """``use`` of every group, like ``applyInArrow`` but without its cost per group.

    For many groups of bounded size: a task holds one batch and one group at a time. ``parts``
    is the most tasks that the rows are worth.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            table = pa.Table.from_batches(held)
            starts = _starts(table, keys)
            for at, stop in zip(starts[:-1], starts[1:]):
                yield from _made(use, table.slice(at, stop - at))
            # The last group may go on in the next batch.
            held = table.slice(starts[-1]).combine_chunks().to_batches()
        if held:
            yield from _made(use, pa.Table.from_batches(held))

    dealt = df.repartition(*keys)
    if parts is not None:
        dealt = dealt.coalesce(parts)
    return dealt.sortWithinPartitions(*keys).mapInArrow(run, schema)


def _starts(table: pa.Table, keys: list[str]) -> list[int]:
    if not table.num_rows:
        return [0]
    changed = np.zeros(table.num_rows, bool)
    changed[0] = True
    for key in keys:
        values = table[key].to_numpy()
        changed[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(changed).tolist()


def _made(use: Callable, table: pa.Table) -> Iterator[pa.RecordBatch]:
    if table.num_rows:
        made = use(table)
        if made is not None and made.num_rows:
            yield from made.combine_chunks().to_batches()
