"""Records of files in which quoted fields span lines, found in splits.

Lines are what line feeds, carriage returns or both end; what ended a line is kept, and
belongs to the record where the line ends inside a quoted field.

A line alone does not tell whether it begins inside a quoted field. But it tells
where it ends in either case: a line either ends in one state whatever came before,
or keeps the state, or turns it over. Such steps can be summed up per input split,
the splits of a file chained in a short table, and the state before every line
read off. Lines that are a record of their own need no more; the lines of the
others are gathered by record.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions import is_blank
from ..functions.sql import text
from ..plans.durable import durable, stored

_SPLIT = ["file_name", "block"]
LONGEST_RECORD = 1 << 30  # characters


@dataclass(frozen=True)
class LongRecords:
    """``records`` has file_name, number (the header is 1) and text.

    ``too_long`` gives, by file name, the first record that is longer than a text can be.
    """

    records: DataFrame
    unclosed: frozenset[str]
    too_long: dict[str, int]


def _ends_open(line: str, delimiter: str) -> str:
    """A line that begins a record ends inside a quoted field (quotes count at field starts)."""
    mark = re.escape(delimiter)
    body = '[^"]*+(?:""[^"]*+)*+'
    field = f'(?:"{body}"[^{mark}]*+|[^"{mark}][^{mark}]*+|)'
    pattern = rf'\A(?:{field}{mark})*+"{body}\z'
    return f"({line} RLIKE {text(pattern)})"


def _run_state(order: str, keys: Sequence[str], ends_at: int) -> tuple[Column, Column]:
    """Chained steps up to ``ends_at`` rows from here: the last fixed state, and turns since it.

    Rows carry ``fixed`` (the state they end in, or null) and ``turns`` (0 or 1), and
    ``turned``, the running sum of turns.
    """
    window = Window.partitionBy(*keys).orderBy(order)
    frame = window.rowsBetween(Window.unboundedPreceding, ends_at)
    fixed = F.last("fixed", ignorenulls=True).over(frame)
    at_fixed = F.last(F.when(F.col("fixed").isNotNull(), F.col("turned")), ignorenulls=True)
    turned = F.coalesce(F.max("turned").over(frame), F.lit(0))
    return fixed, (turned - F.coalesce(at_fixed.over(frame), F.lit(0))) % 2 == 1


def _running_turns(rows: DataFrame, order: str, keys: Sequence[str]) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(order)
    frame = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.withColumn("turned", F.sum("turns").over(frame))


def text_lines(spark: SparkSession, paths: Sequence[str], encoding: str = "UTF-8") -> DataFrame:
    """(file_name, block, position, line, fed): the lines of files, ``fed`` if a line feed ends them.

    ``encoding`` is one that ``decode`` knows and in which line breaks are single bytes.
    """
    value = F.col("value")
    if encoding == "ISO-8859-1":
        value = F.decode(value.cast("binary"), encoding)
    bom = (F.col("block") == 0) & F.startswith("line", F.lit("﻿"))
    parts = F.when(F.contains(value, F.lit("\r")), F.split(value, r"(?<=\r)", -1)).otherwise(
        F.array(value)
    )
    return (
        spark.read.option("lineSep", "\n")
        .text(list(paths))
        .select(
            F.col("_metadata.file_name").alias("file_name"),
            F.col("_metadata.file_block_start").alias("block"),
            parts.alias("parts"),
        )
        .select(*_SPLIT, F.size("parts").alias("parts_in"), F.posexplode("parts").alias("part", "line"))
        .select(
            *_SPLIT,
            F.monotonically_increasing_id().alias("position"),
            "line",
            (F.col("part") == F.col("parts_in") - 1).alias("fed"),
        )
        .withColumn("line", F.when(bom, F.expr("substring(line, 2)")).otherwise(F.col("line")))
    )


def long_records(read: DataFrame, *, delimiter: str = ",") -> LongRecords:
    """Assemble records from lines, see ``text_lines``. Windows run over one input split each."""
    # A line without quotes neither opens nor closes a field.
    quoted = F.contains("line", F.lit('"'))
    outside = quoted & F.expr(_ends_open("line", delimiter))
    inside = ~quoted | F.expr(_ends_open("concat('\"', line)", delimiter))
    steps = read.withColumns({"__outside": outside, "__inside": inside}).select(
        *_SPLIT,
        "position",
        "line",
        "fed",
        F.when(F.col("__outside") == F.col("__inside"), F.col("__outside")).alias("fixed"),
        (F.col("__outside") & ~F.col("__inside")).cast("int").alias("turns"),
    )
    lines = _running_turns(stored(steps, "lines"), "position", _SPLIT)
    fixed, odd = _run_state("position", _SPLIT, 0)
    states = lines.select(*_SPLIT, "position", "line", "fed", fixed.alias("fixed"), odd.alias("odd"))

    # One row per input split.
    last = F.max_by(F.struct("fixed", "odd"), "position")
    splits = states.groupBy(*_SPLIT).agg(last.alias("end")).select(*_SPLIT, "end.*")
    chained = splits.select(
        *_SPLIT,
        (F.col("fixed") != F.col("odd")).alias("fixed"),
        F.when(F.col("fixed").isNull(), F.col("odd").cast("int")).otherwise(0).alias("turns"),
    )
    chained = _running_turns(chained, "block", ["file_name"])
    before, before_odd = _run_state("block", ["file_name"], -1)
    after, after_odd = _run_state("block", ["file_name"], 0)
    entry, _ = durable(
        chained.select(
            *_SPLIT,
            (F.coalesce(before, F.lit(False)) != before_odd).alias("enter"),
            (F.coalesce(after, F.lit(False)) != after_odd).alias("leave"),
        )
    )
    ends = entry.groupBy("file_name").agg(F.max_by("leave", "block").alias("open"))
    unclosed = frozenset(row.file_name for row in ends.where("open").collect())

    # Told to be broadcast, as Spark does not know how small checkpoints are.
    placed = states.join(F.broadcast(entry.drop("leave")), _SPLIT).withColumn(
        "open_after", F.coalesce("fixed", "enter") != F.col("odd")
    )
    window = Window.partitionBy(*_SPLIT).orderBy("position")
    open_before = F.coalesce(F.lag("open_after").over(window), F.col("enter"))
    flagged = placed.withColumn("open_before", open_before).where(
        F.col("open_before") | F.expr(f"NOT {is_blank('line')}")
    )
    running = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    in_split = F.sum((~F.col("open_before")).cast("bigint")).over(running)
    marked = stored(
        flagged.where(~F.col("file_name").isin(list(unclosed))).select(
            *_SPLIT, "position", "line", "fed", "open_before", "open_after",
            in_split.alias("in_split"),
        ),
        "marked",
    )
    begun = marked.groupBy(*_SPLIT).agg(F.count_if(~F.col("open_before")).alias("begun"))
    earlier = Window.partitionBy("file_name").orderBy("block")
    earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
    offsets, _ = durable(
        begun.select(*_SPLIT, F.coalesce(F.sum("begun").over(earlier), F.lit(0)).alias("offset"))
    )
    numbered = marked.join(F.broadcast(offsets), _SPLIT).withColumn(
        "number", F.col("in_split") + F.col("offset")
    )
    alone = ~F.col("open_before") & ~F.col("open_after")
    ended = F.endswith("line", F.lit("\r"))
    bare = F.when(ended, F.regexp_replace("line", r"\r\z", "")).otherwise(F.col("line"))
    whole = numbered.where(alone).select("file_name", "number", bare.alias("text"))
    # The lines of one record only; their length is measured before they are gathered.
    spread = numbered.where(~alone).withColumn(
        "text",
        F.when(~F.col("open_after"), bare)
        .when(F.col("fed"), F.concat("line", F.lit("\n")))
        .otherwise(F.col("line")),
    )
    lengths = spread.groupBy("file_name", "number").agg(F.sum(F.length("text")).alias("length"))
    long = lengths.where(F.col("length") > LONGEST_RECORD).groupBy("file_name")
    too_long = {row.file_name: row.first for row in long.agg(F.min("number").alias("first")).collect()}
    pieces = F.array_sort(F.collect_list(F.struct("block", "position", "text")))
    joined = (
        spread.where(~F.col("file_name").isin(list(too_long)))
        .groupBy("file_name", "number")
        .agg(F.array_join(pieces["text"], "").alias("text"))
    )
    return LongRecords(whole.unionByName(joined), unclosed, too_long)
