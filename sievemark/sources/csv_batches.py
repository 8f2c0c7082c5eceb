"""Reading batch files as text under an exact schema.

Every field is a string and blanks stay ``''``. The header is read as data, which
gives the header check, the records and their positions in one scan. Two extra
columns tell records that have too many fields.

All files are split among tasks, whatever their size and encoding. Where no record spans lines, Spark
reads records from the splits; elsewhere they are assembled from lines first (``long_records``).
Lines in encodings that Spark does not read are decoded before that (``decoding``). In every case the
parsed records are stored once as a columnar table, and all later work reads that.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions import as_text, is_blank
from ..operators.row_numbers import number_runs
from ..operators.validate import BATCH, ROW
from ..plans.durable import stored
from .batches import (
    NAME_PATTERN,
    BatchFile,
    batch_year,
    file_kinds,
)
from .decoding import decoded_lines
from .encodings import find_encoding
from .long_records import long_records, text_lines

_EXTRA = "__extra"
_RECORD = "__record"
_HEADER_ROW = 1
NOT_CLOSED = "file is malformed: a quoted field is not closed"


@dataclass(frozen=True)
class RawBatches:
    """Records of all batches, and what makes a batch unusable (by year)."""

    rows: DataFrame
    problems: dict[int, list[str]]
    row_counts: dict[int, int]


def _too_long(columns: int, delimiter: str) -> Column:
    """The record has more fields than the contract.

    The schema has one column more than the contract, so a record of the right
    length is short by one and its text is kept in the record column.
    """
    record, mark = F.col(_RECORD), re.escape(delimiter)
    one_too_many = record.isNull()
    many = F.col(_EXTRA).isNotNull()
    delimiters = F.length(record) - F.length(F.replace(record, F.lit(delimiter), F.lit("")))
    # Only an empty first surplus field is left: count the delimiters outside quotes.
    bare = F.regexp_replace(record, rf'(^|{mark})(?:"[^"]*")+', "$1")
    outside = F.regexp_count(bare, F.lit(mark))
    return one_too_many | many | ((delimiters > columns - 1) & (outside > columns - 1))


def _fields(columns: Sequence[str]) -> list[str]:
    return [f"__f{index}" for index in range(len(columns))]


def _options(encoding: str, delimiter: str) -> dict[str, str]:
    return {
        "columnNameOfCorruptRecord": _RECORD,
        "escape": '"',
        "encoding": encoding,
        "sep": delimiter,
    }


def _schema(columns: Sequence[str]) -> T.StructType:
    names = [*_fields(columns), _EXTRA, _RECORD]
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


def _parse(
    spark: SparkSession,
    batches: Sequence[BatchFile],
    columns: Sequence[str],
    *,
    encoding: str,
    delimiter: str,
    name_pattern: str,
) -> DataFrame:
    """Records as Spark's reader gives them, one a line."""
    records = (
        spark.read.schema(_schema(columns))
        .options(**_options(encoding, delimiter), header="false")
        .csv([batch.path for batch in batches])
    )
    filled = F.col(_EXTRA).isNotNull() | F.col(_RECORD).isNull() | F.expr(f"NOT {is_blank(_RECORD)}")
    present = records.where(filled)  # blank lines are not records
    return _checked(
        present.select(
            "*",
            batch_year(F.col("_metadata.file_name"), name_pattern).alias(BATCH),
            F.col("_metadata.file_block_start").alias("__block"),
            F.monotonically_increasing_id().alias("__position"),
        ),
        columns,
        delimiter,
    )


def _parse_long(
    records: DataFrame, columns: Sequence[str], *, delimiter: str, name_pattern: str
) -> DataFrame:
    """Records that were assembled from lines."""
    schema = ", ".join(f"{field.name} string" for field in _schema(columns).fields)
    parsed = F.from_csv("text", schema, _options("utf-8", delimiter))
    rows = records.select(
        batch_year(F.col("file_name"), name_pattern).alias(BATCH),
        F.lit(0).cast("bigint").alias("__block"),
        F.col("number").alias("__position"),
        parsed.alias("__parsed"),
    )
    flat = rows.select(BATCH, "__block", "__position", "__parsed.*")
    return _checked(flat, columns, delimiter)


def _checked(records: DataFrame, columns: Sequence[str], delimiter: str) -> DataFrame:
    fields = _fields(columns)
    return records.select(
        BATCH,
        "__block",
        "__position",
        _too_long(len(columns), delimiter).alias("__long"),
        F.col(_EXTRA),
        _width([*fields, _EXTRA]).alias("__width"),
        *[F.expr(as_text(name)).alias(f"__c{index}") for index, name in enumerate(fields)],
    )


def _names(columns: int) -> Column:
    """A record as a header: as many names as it has fields."""
    fields = [F.col(f"__c{index}") for index in range(columns)]
    return F.slice(F.array(*fields, F.coalesce(_EXTRA, F.lit(""))), F.lit(1), F.col("__width"))


def _width(names: Sequence[str]) -> Column:
    """How many fields a record has: up to the last that is there."""
    width = F.lit(0)
    for number, name in enumerate(names, 1):
        width = F.when(F.col(name).isNotNull(), F.lit(number)).otherwise(width)
    return width


def header_problems(actual: list[str], expected: Sequence[str]) -> list[str]:
    """How a header differs from the contract; names, order and case must be the same."""
    wanted = list(expected)
    if actual == wanted:
        return []
    missing = [name for name in wanted if name not in actual]
    unexpected = [name for name in actual if name not in wanted]
    return [
        f"columns do not match the contract; missing: {missing}; unexpected: {unexpected}; "
        f"expected order: {wanted}; actual order: {actual}"
    ]


def header_conformance(
    headers: DataFrame, header: str, expected: Sequence[str], *, keep: Sequence[str] = ()
) -> DataFrame:
    """The header check as columns, for a column holding an array of names."""
    wanted = F.array(*[F.lit(name) for name in expected])
    return headers.select(
        *keep,
        (F.col(header) == wanted).alias("conforms"),
        F.array_except(wanted, header).alias("missing"),
        F.array_except(header, wanted).alias("unexpected"),
    )


def batch_row_counts(rows: DataFrame, batches: DataFrame, *, batch: str = BATCH) -> DataFrame:
    """Data rows of every listed batch; a batch without any is reported, not dropped."""
    counts = rows.groupBy(batch).agg(F.count(F.lit(1)).alias("row_count"))
    filled = F.coalesce("row_count", F.lit(0))
    return (
        batches.select(batch)
        .join(counts, batch, "left")
        .select(batch, filled.alias("row_count"), (filled > 0).alias("has_rows"))
    )


def read_batches(
    spark: SparkSession,
    batches: Sequence[BatchFile],
    columns: Sequence[str],
    *,
    encoding: str = "utf-8",
    delimiter: str = ",",
    name_pattern: str = NAME_PATTERN,
    facts: DataFrame | None = None,
) -> RawBatches:
    """All records of the batches as text, with batch year and source row number.

    ``facts`` are the ``line_facts`` of some of the files, which are not scanned again.
    """
    charset = find_encoding(encoding)
    years = [batch.year for batch in batches]
    if len(years) != len(set(years)):
        raise ValueError("there must be one file per batch year")
    problems: dict[int, list[str]] = defaultdict(list)
    for batch in batches:
        if batch.size_bytes == 0:
            problems[batch.year].append("file has no header")

    full = [batch for batch in batches if batch.size_bytes > 0]
    split, long, lines = [], [], None
    if charset.spark is None:
        if full:
            lines, broken = decoded_lines(spark, full, charset)
            for batch in full:
                if batch.name in broken:
                    problems[batch.year].append(f"file does not decode as {encoding}")
                else:
                    long.append(batch)
    else:
        # One row per batch file.
        known = {row.file_name: row for row in facts.drop("digest").collect()} if facts else {}
        unknown = [batch.path for batch in full if batch.name not in known]
        if unknown:
            scan = file_kinds(spark, unknown, delimiter=delimiter)
            known |= {row.file_name: row for row in scan.collect()}
        for batch in full:
            fact = known[batch.name]
            if not {"UTF-8": fact.valid_utf8, "US-ASCII": fact.ascii}.get(charset.spark, True):
                problems[batch.year].append(f"file does not decode as {encoding}")
            else:
                (split if fact.one_line_records else long).append(batch)
        if long:
            lines = text_lines(spark, [batch.path for batch in long], charset.spark)

    parsed = None
    if split:
        parsed = _parse(
            spark, split, columns, encoding=charset.spark, delimiter=delimiter, name_pattern=name_pattern
        )
    if long:
        found = long_records(lines, delimiter=delimiter)
        for batch in long:
            if batch.name in found.unclosed:
                problems[batch.year].append(NOT_CLOSED)
            if batch.name in found.too_long:
                number = found.too_long[batch.name]
                problems[batch.year].append(f"file is malformed: record {number} is too long")
        part = _parse_long(
            found.records, columns, delimiter=delimiter, name_pattern=name_pattern
        )
        parsed = part if parsed is None else parsed.unionByName(part)
    if parsed is None:
        schema = ", ".join(f"`{name}` string" for name in columns)
        nothing = spark.createDataFrame([], f"{schema}, {BATCH} smallint, {ROW} bigint")
        return RawBatches(nothing, dict(problems), {})

    records = number_runs(
        stored(parsed, "records"), batch=BATCH, run="__block", position="__position",
        first=_HEADER_ROW,
    )
    is_header = F.col(ROW) == _HEADER_ROW
    # One row per batch: counts and the header. A list keeps it a hash aggregation; there is one header.
    checks = records.groupBy(BATCH).agg(
        F.count_if(~is_header).alias("data_rows"),
        F.count_if(~is_header & F.col("__long")).alias("long_rows"),
        F.collect_list(F.when(is_header, _names(len(columns)))).alias("headers"),
    )
    counts: dict[int, int] = {}
    for row in checks.collect():
        found, counts[row[BATCH]] = problems[row[BATCH]], row.data_rows
        found.extend(header_problems(list(row.headers[0]) if row.headers else [], columns))
        if row.long_rows:
            found.append(f"file is malformed: {row.long_rows} records have too many fields")
        if row.data_rows == 0:
            found.append("file has no data rows")
    for batch in split + long:
        if batch.year not in counts and not problems[batch.year]:
            problems[batch.year].append("file has no header")

    rows = records.where(~is_header).select(
        *[F.col(f"__c{index}").alias(name) for index, name in enumerate(columns)], BATCH, ROW
    )
    return RawBatches(rows, {year: found for year, found in problems.items() if found}, counts)
