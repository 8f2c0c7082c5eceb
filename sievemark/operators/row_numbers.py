"""Source row numbers: position of a record in its batch, the header being row 1.

Both functions number rows without a window over a whole batch, which would put
the largest batch into one task. Rows get an id that ascends within their task,
each run of rows is counted, and a short table of run offsets does the rest.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..plans import lookup
from ..plans.durable import durable, stored
from .validate import ROW

FIRST_DATA_ROW = 2


def number_runs(
    rows: DataFrame, *, batch: str, run: str, position: str, first: int = FIRST_DATA_ROW
) -> DataFrame:
    """Replace ``run`` and ``position`` by the row number in the batch.

    ``run`` orders the runs of a batch; ``position`` ascends by one within a run.
    ``rows`` must be stored: a second evaluation has to give the same positions.
    """
    runs, counts = durable(
        rows.groupBy(batch, run).agg(
            F.min(position).alias("__start"), F.count(F.lit(1)).alias("__length")
        ),
        runs=F.count(F.lit(1)),
        rows=F.coalesce(F.sum("__length"), F.lit(0)),
    )
    # One row per run, and a run is what one task read or sorted.
    earlier = Window.partitionBy(batch).orderBy(run).rowsBetween(Window.unboundedPreceding, -1)
    offsets = runs.select(
        batch,
        run,
        "__length",
        (F.coalesce(F.sum("__length").over(earlier), F.lit(0)) - F.col("__start")).alias("__shift"),
    )
    numbered = lookup.join_groups(
        rows,
        offsets,
        keys=[batch, run],
        size="__length",
        facts=["__shift"],
        row_id=position,
        group_count=counts["runs"],
        grouped_rows=counts["rows"],
    )
    number = F.col(position) + F.col("__shift") + F.lit(first)
    return numbered.withColumn(ROW, number.cast("bigint")).drop(run, position, "__shift")


def number_rows(
    df: DataFrame, *, batch: str, order: Sequence[str], first: int = FIRST_DATA_ROW
) -> DataFrame:
    """Number the rows of each batch by ``order``; for tables that keep no file order.

    A range-partitioned sort spreads each batch over many tasks. The last sort key
    breaks ties, so that rows which are equal on ``order`` do not pile up in one task.
    """
    tie = "__tie"
    tagged = df.withColumn(tie, F.monotonically_increasing_id())
    keys = [batch, *order, tie]
    ranged = tagged.repartitionByRange(*keys).sortWithinPartitions(*keys).drop(tie)
    kept = stored(ranged.withColumn("__position", F.monotonically_increasing_id()), "numbered")
    runs = kept.withColumn("__run", F.shiftright("__position", 33))
    return number_runs(runs, batch=batch, run="__run", position="__position", first=first)
