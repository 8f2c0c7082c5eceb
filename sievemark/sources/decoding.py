"""Lines of files in encodings that Spark's readers do not split, decoded by Python in splits.

A file is cut where the bytes of a line feed stand. In UTF-16 and UTF-32 these bytes also stand where
no line ends, across two code units, but never overlap with a true one. So a cut is true
if it begins at a whole number of code units, which the lengths of the pieces before it tell:
summed up per split first, and then along each split. Pieces between true cuts are one line.
A line that crosses splits is put together from its fragments; all others are decoded where they
are read. What does not decode is found exactly as Python finds it, for every codec of its.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Sequence
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..plans.durable import stored
from . import storage
from .batches import BatchFile
from .encodings import Encoding

_SPLIT = ["file_name", "block"]
_LINES = "file_name string, block bigint, part int, line string, fed boolean, broken boolean"
_ROWS = pa.schema(
    [
        ("file_name", pa.string()),
        ("block", pa.int64()),
        ("part", pa.int32()),
        ("line", pa.string()),
        ("fed", pa.bool_()),  # a line feed follows, or the end of the file
        ("broken", pa.bool_()),
        ("fragment", pa.binary()),  # bytes of a line that began or ends in another split
        ("begins", pa.bool_()),
    ]
)
_ROW_TYPES = f"{_LINES}, fragment binary, begins boolean"


class _Made:
    """Rows to be passed on, about a thousand lines at a time."""

    def __init__(self) -> None:
        self.columns: list[list] = [[] for _ in _ROWS]

    def add(self, *values: object) -> None:
        for column, value in zip(self.columns, values):
            column.append(value)

    def line(self, file_name: str, block: int, content: bytes, python: str, first: bool) -> None:
        """One whole line, cut after each carriage return as these end lines too."""
        try:
            text = content.decode(python)
        except UnicodeDecodeError:
            self.add(file_name, block, 0, None, True, True, None, None)
            return
        if first:
            text = text.removeprefix("﻿")
        pieces = text.split("\r")
        last = len(pieces) - 1
        for part, piece in enumerate(pieces):
            whole = piece if part == last else piece + "\r"
            self.add(file_name, block, part, whole, part == last, False, None, None)

    def full(self) -> bool:
        return len(self.columns[0]) >= 1000

    def any(self) -> bool:
        return bool(self.columns[0])

    def take(self) -> pa.RecordBatch:
        arrays = [pa.array(column, field.type) for column, field in zip(self.columns, _ROWS)]
        self.columns = [[] for _ in _ROWS]
        return pa.RecordBatch.from_arrays(arrays, schema=_ROWS)


def _by_split(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], list[bytes]]]:
    """The pieces of a batch, those of a split together."""
    names, blocks = batch.column("file_name"), batch.column("block")
    contents, last = batch.column("content").to_pylist(), batch.num_rows - 1
    if last >= 0 and (names[0], blocks[0]) == (names[last], blocks[last]):  # a task reads splits one after another
        yield (names[0].as_py(), blocks[0].as_py()), contents
        return
    rows = zip(zip(names.to_pylist(), blocks.to_pylist()), contents)
    for split, group in groupby(rows, lambda row: row[0]):
        yield split, [content for _, content in group]


def _whole_lines(contents: list[bytes], charset: Encoding) -> list[str] | None:
    """The pieces as lines, decoded as one; ``None`` if a cut is false or something does not decode."""
    if charset.unit > 1 and any(len(content) % charset.unit for content in contents):
        return None
    try:
        lines = charset.line_feed.join(contents).decode(charset.python).split("\n")
    except UnicodeDecodeError:
        return None
    return lines if len(lines) == len(contents) else None


def _many(split: tuple[str, int], lines: list[str]) -> pa.RecordBatch:
    """Rows of lines of a split, cut after each carriage return as these end lines too."""
    parts, fed = [0] * len(lines), [True] * len(lines)
    if any("\r" in line for line in lines):
        whole, lines, parts, fed = lines, [], [], []
        for line in whole:
            pieces = line.split("\r") if "\r" in line else (line,)
            last = len(pieces) - 1
            lines += [piece + "\r" for piece in pieces[:last]]
            lines.append(pieces[last])
            parts += range(last + 1)
            fed += [False] * last
            fed.append(True)
    count = len(lines)
    values = {
        "file_name": pa.repeat(pa.scalar(split[0], pa.string()), count),
        "block": pa.repeat(pa.scalar(split[1], pa.int64()), count),
        "part": pa.array(parts, pa.int32()),
        "line": pa.array(lines, pa.string()),
        "fed": pa.array(fed, pa.bool_()),
        "broken": pa.repeat(pa.scalar(False), count),
    }
    arrays = [values[field.name] if field.name in values else pa.nulls(count, field.type) for field in _ROWS]
    return pa.RecordBatch.from_arrays(arrays, schema=_ROWS)


def _decode(charset: Encoding, starts: dict[tuple[str, int], int]):
    """``starts`` tells, for splits that begin inside a code unit, how many bytes of it are before."""
    python, unit, feed = charset.python, charset.unit, charset.line_feed

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, split, over, held, begins = _Made(), None, 0, [], True
        at_start = False

        def leave() -> None:
            if held:
                made.add(*split, None, None, None, False, feed.join(held), begins)

        for batch in batches:
            for now, contents in _by_split(batch):
                if now != split:
                    leave()
                    split, held = now, []
                    over = starts.get(split, 0)
                    begins, at_start = over == 0, split[1] == 0
                lines = None if held or over else _whole_lines(contents, charset)
                if lines is not None:
                    if made.any():
                        yield made.take()
                    if at_start:
                        lines[0] = lines[0].removeprefix("\ufeff")
                    yield _many(split, lines)
                    at_start = False
                    continue
                for content in contents:
                    held.append(content)
                    over = (over + len(content) + len(feed)) % unit
                    if over:
                        continue
                    if begins:
                        made.line(*split, feed.join(held), python, at_start)
                    else:
                        made.add(*split, None, None, None, False, feed.join(held), False)
                    held, begins, at_start = [], True, False
                    if made.full():
                        yield made.take()
        leave()
        yield made.take()

    return run


def _joined(charset: Encoding):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = _Made()
            for row in batch.to_pylist():
                content = charset.line_feed.join(f["fragment"] for f in row["fragments"])
                first = row["block"] == 0 and row["first"]
                before = len(made.columns[0])
                made.line(row["file_name"], row["block"], content, charset.python, first)
                made.columns[6][before:] = [row["id"].to_bytes(8, "big")] * (len(made.columns[0]) - before)
            yield made.take()

    return run


def _starts(pieces: DataFrame, charset: Encoding) -> dict[tuple[str, int], int]:
    """Splits that begin inside a code unit, and how many of its bytes are before them; mostly none."""
    if charset.unit == 1:
        return {}
    lengths = pieces.groupBy(*_SPLIT).agg(F.sum(F.octet_length("content") + len(charset.line_feed)).alias("bytes"))
    before = Window.partitionBy("file_name").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # of splits
    over = F.coalesce(F.sum("bytes").over(before), F.lit(0)) % charset.unit
    found = lengths.select(*_SPLIT, over.cast("int").alias("over")).where("over <> 0")
    return {(row.file_name, row.block): row.over for row in found.collect()}


def _lines_of(spark: SparkSession, paths: Sequence[str], charset: Encoding) -> DataFrame:
    """(file_name, block, position, line, fed, broken) of files of one byte order."""
    pieces = spark.read.option("lineSep", charset.line_feed.decode("latin-1")).text(list(paths)).select(
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("value").cast("binary").alias("content"),
    )
    decode = _decode(charset, _starts(pieces, charset))
    rows = stored(pieces.mapInArrow(decode, _ROW_TYPES).withColumn("id", F.monotonically_increasing_id()), "decoded")
    wanted = ["file_name", "block", "id", "part", "line", "fed", "broken"]
    whole = rows.where("fragment is null").select(*wanted)
    if charset.unit > 1:
        # Few: at most two for every split.
        order = Window.partitionBy("file_name").orderBy("block", "id")
        fragments = rows.where("fragment is not null").withColumn("run", F.sum(F.col("begins").cast("int")).over(order))
        earliest = rows.where("block = 0").groupBy("file_name").agg(F.min("id").alias("least"))
        runs = fragments.groupBy("file_name", "run").agg(
            F.array_sort(F.collect_list(F.struct("block", "id", "fragment"))).alias("fragments")
        )
        runs = runs.join(earliest, "file_name", "left").select(
            "file_name", F.col("fragments")[0]["block"].alias("block"), F.col("fragments")[0]["id"].alias("id"),
            "fragments", F.coalesce(F.col("fragments")[0]["id"] == F.col("least"), F.lit(False)).alias("first"),
        )
        made = stored(runs.mapInArrow(_joined(charset), _ROW_TYPES), "joined")
        number = F.conv(F.hex("fragment"), 16, 10).cast("bigint")
        whole = whole.unionByName(made.withColumn("id", number).select(*wanted))
    return whole.select(
        "file_name", "block", F.struct("id", "part").alias("position"), "line", "fed", "broken"
    )


def decoded_lines(
    spark: SparkSession, batches: Sequence[BatchFile], charset: Encoding
) -> tuple[DataFrame, set[str]]:
    """(file_name, block, position, line, fed) of the files that decode, and the names of the others."""
    by_order: dict[Encoding, list[str]] = defaultdict(list)
    for batch in batches:
        first = storage.first_bytes(spark, batch.path, charset.unit) if charset.by_mark else b""
        by_order[charset.ordered(first)].append(batch.path)
    lines = None
    for one, paths in by_order.items():
        part = _lines_of(spark, paths, one)
        lines = part if lines is None else lines.unionByName(part)
    broken = {row.file_name for row in lines.where("broken").select("file_name").distinct().collect()}
    return lines.where(~F.col("file_name").isin(list(broken))).drop("broken"), broken
