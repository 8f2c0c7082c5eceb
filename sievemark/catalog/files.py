"""Queries over batch files: orders written as one CSV file a year, then read by the run's own path."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.validate import BATCH, ROW
from ..plans.durable import dropped, scratch_path, stored
from ..plans.run import Settings, run_all, run_totals
from ..sources import storage
from ..sources.batches import BatchFile, discover_batches, inspect_batches
from ..sources.csv_batches import read_batches
from .raw_orders import COLUMNS, CONTRACT, RAW_ORDERS_SQL, ROLES, raw_orders

_YEARS = {"start_year": 1990, "end_year": 2010}
_HEADER = ",".join(COLUMNS)


def _cell(name: str) -> Column:
    value = F.col(name)
    quoted = F.concat(F.lit('"'), F.replace(value, F.lit('"'), F.lit('""')), F.lit('"'))
    special = F.contains(value, F.lit('"'))
    for char in ",\r\n":
        special = special | F.contains(value, F.lit(char))
    return F.when(special, quoted).otherwise(value)


def _lines(rows: DataFrame, line: Column | None = None) -> DataFrame:
    """The text of every record, null for none, made once for all the files that are written of it."""
    text = F.concat_ws(",", *[_cell(name) for name in COLUMNS]) if line is None else line
    return stored(rows.select(BATCH, ROW, text.alias("line")), "file_lines")


# A file has one writer. So many partitions that two years seldom share one; most have none.
_WRITERS = 200


def _write(
    lines: DataFrame,
    header: Column | None = None,
    encode: Callable[[Column], Column] = lambda text: text,
    line_feed: str = "\n",
    folder: str | None = None,
) -> str:
    """A folder with one file per batch year, records in the order of their numbers; a new one if none is given.

    ``encode`` gives the bytes of a line, and ``line_feed`` those of its end, as characters up to 127. All
    but the order and the writing is done before rows go to the one task that writes their file.
    """
    spark = lines.sparkSession
    headers = lines.select(BATCH).distinct().select(
        BATCH, F.lit(-1).cast("bigint").alias(ROW), (F.lit(_HEADER) if header is None else header).alias("line"),
    )
    parts = scratch_path(spark, "parts")
    (
        headers.unionByName(lines.where("line is not null"))
        .select(BATCH, ROW, encode(F.col("line")).cast("string").alias("line"))
        .repartition(_WRITERS, BATCH)
        .sortWithinPartitions(BATCH, ROW)
        .select(BATCH, "line")
        .write.option("lineSep", line_feed)
        .partitionBy(BATCH)
        .text(parts)
    )
    folder = folder or scratch_path(spark, "incoming")
    # One folder per year.
    for entry in storage.entries(spark, parts):
        if not entry.is_file:
            year = entry.name.split("=")[1]
            (part,) = [e for e in storage.entries(spark, entry.path) if e.name.startswith("part-")]
            target = f"{folder}/food_inspections_{year}.csv"
            storage.replace_folder(spark, part.path, target, f"{parts}/none")
    return folder


def _discover(spark: SparkSession, folder: str) -> list[BatchFile]:
    return discover_batches(spark, folder, file_pattern="food_inspections_*.csv", **_YEARS)


def _spanning(rows: DataFrame) -> DataFrame:
    """Names with quotes, delimiters and line breaks of all kinds."""
    name = F.col("name")
    return rows.withColumn(
        "name",
        F.when(F.col(ROW) % 50 == 0, F.concat(name, F.lit('\r\n"b", c')))
        .when(F.col(ROW) % 51 == 0, F.concat(F.lit("\n"), name, F.lit("\r")))
        .otherwise(name),
    )


_SPANNING_SQL = f"""WITH {RAW_ORDERS_SQL}, spanning AS (
  SELECT * REPLACE (CASE WHEN source_row_number % 50 = 0 THEN concat(name, chr(13), chr(10), '"b", c')
    WHEN source_row_number % 51 = 0 THEN concat(chr(10), name, chr(13)) ELSE name END AS name)
  FROM raw_orders
)"""


def csv_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records of all files, with their numbers."""
    folder = _write(_lines(_spanning(raw_orders(spark, sf_dir))))
    read = read_batches(spark, _discover(spark, folder), COLUMNS)
    if read.problems:
        raise ValueError(f"files could not be read: {read.problems}")
    return read.rows


_CSV_ROWS = f"""{_SPANNING_SQL}
SELECT {", ".join(COLUMNS)}, batch_year,
  row_number() OVER (PARTITION BY batch_year ORDER BY source_row_number) + 1 AS source_row_number
FROM spanning"""


def batch_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Name, size and SHA-256 of every file."""
    batches = _discover(spark, _write(_lines(_spanning(raw_orders(spark, sf_dir)))))
    found = inspect_batches(spark, batches, algorithm="sha256")
    return found.withColumn("path", F.regexp_extract("path", "[^/]*$", 0))


_QUOTED = ", ".join(
    f"""CASE WHEN regexp_matches({n}, '[",\\r\\n]') THEN concat('"', replace({n}, '"', '""'), '"') ELSE {n} END"""
    for n in COLUMNS
)
_BATCH_LISTING = f"""{_SPANNING_SQL}, content AS (
  SELECT batch_year, concat('{_HEADER}', chr(10),
    string_agg(concat_ws(',', {_QUOTED}), chr(10) ORDER BY source_row_number), chr(10)) AS content
  FROM spanning GROUP BY batch_year
)
SELECT batch_year, concat('food_inspections_', batch_year, '.csv') AS path,
  strlen(content) AS size_bytes, 'sha256' AS checksum_algorithm, sha256(content) AS checksum
FROM content"""


def batch_line_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hash tree over the lines of every file."""
    found = inspect_batches(spark, _discover(spark, _write(_lines(_spanning(raw_orders(spark, sf_dir))))))
    return found.select("batch_year", "checksum_algorithm", "checksum")


# Three levels of nodes, for files of up to 1024 * 1024 * 1024 lines.
_NODES = ", ".join(
    f"""level{level} AS (
  SELECT batch_year, n // 1024 AS n, sha256(concat('1:', string_agg(hash, '' ORDER BY n))) AS hash
  FROM level{level - 1} GROUP BY batch_year, n // 1024
), root{level} AS (
  SELECT batch_year, any_value(hash) AS hash FROM level{level} GROUP BY batch_year HAVING count(*) = 1
)"""
    for level in (1, 2, 3)
)
_BATCH_LINE_DIGEST = f"""{_SPANNING_SQL}, content AS (
  SELECT batch_year, string_split(concat('{_HEADER}', chr(10),
    string_agg(concat_ws(',', {_QUOTED}), chr(10) ORDER BY source_row_number)), chr(10)) AS lines
  FROM spanning GROUP BY batch_year
), level0 AS (
  SELECT batch_year, n, sha256(concat('0:', lines[n + 1])) AS hash
  FROM (SELECT batch_year, lines, unnest(range(len(lines))) AS n FROM content)
), {_NODES}
SELECT batch_year, 'sha256-lines' AS checksum_algorithm,
  concat(len(lines), '-', coalesce(root1.hash, root2.hash, root3.hash)) AS checksum
FROM content LEFT JOIN root1 USING (batch_year) LEFT JOIN root2 USING (batch_year) LEFT JOIN root3 USING (batch_year)"""


def csv_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is wrong with files that are faulty in a different way each year, by encoding."""
    rows, year = raw_orders(spark, sf_dir), F.col(BATCH)
    given = F.concat_ws(",", *[_cell(name) for name in COLUMNS])
    line = (
        F.when((year == 1996) & (F.col(ROW) % 7 == 0), F.concat(given, F.lit(",é,é")))
        .when(year == 1998, F.replace(given, F.lit("Clerk"), F.lit("é")))
        .otherwise(given)
    )
    header = F.when(year == 1999, F.replace(F.lit(_HEADER), F.lit("zip"), F.lit("ZIP"))).otherwise(_HEADER)
    batches = _discover(spark, _write(_lines(rows, line), header))
    found = []
    for encoding in ("utf8", "us-ascii"):
        problems = read_batches(spark, batches, COLUMNS, encoding=encoding).problems
        found += [(encoding, y, text) for y, texts in problems.items() for text in texts]
    return spark.createDataFrame(found, "encoding string, batch_year smallint, problem string")


_CSV_PROBLEMS = f"""WITH {RAW_ORDERS_SQL}, encodings AS (SELECT unnest(['utf8', 'us-ascii']) AS encoding)
SELECT encoding, batch_year, 'file does not decode as us-ascii' AS problem
FROM encodings, raw_orders WHERE encoding = 'us-ascii' AND (batch_year = 1998
  OR batch_year = 1996 AND source_row_number % 7 = 0) GROUP BY encoding, batch_year
UNION ALL
SELECT 'utf8', batch_year, concat('file is malformed: ', count(*), ' records have too many fields')
FROM raw_orders WHERE batch_year = 1996 AND source_row_number % 7 = 0 GROUP BY batch_year
UNION ALL
SELECT encoding, batch_year, concat('columns do not match the contract; missing: [''zip'']; unexpected: [''ZIP'']; ',
  'expected order: [', '{", ".join(f"''{n}''" for n in COLUMNS)}', ']; actual order: [',
  '{", ".join(f"''{'ZIP' if n == 'zip' else n}''" for n in COLUMNS)}', ']')
FROM encodings, (SELECT DISTINCT batch_year FROM raw_orders WHERE batch_year = 1999)"""


# Files in two other encodings: as code units with a byte order mark, and a code page with € at 0x80.
_WIDE = {"encode": lambda text: F.encode(text, "UTF-16LE"), "line_feed": "\n\0"}
_ENCODED = {
    "utf-16": _WIDE,
    "cp1252": {"encode": lambda text: F.encode(F.replace(text, F.lit("€"), F.lit("\x80")), "ISO-8859-1")},
}


def _marked(header: str, encoding: str) -> Column:
    return F.lit("\ufeff" + header if encoding == "utf-16" else header)


def csv_encodings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records of files in other encodings, whose names span lines and have letters beyond ASCII."""
    rows = _spanning(raw_orders(spark, sf_dir)).withColumn("name", F.concat("name", F.lit(" é€")))
    lines = _lines(rows)
    found = None
    for encoding, how in _ENCODED.items():
        folder = _write(lines, _marked(_HEADER, encoding), **how)
        read = read_batches(spark, _discover(spark, folder), COLUMNS, encoding=encoding)
        if read.problems:
            raise ValueError(f"files could not be read: {read.problems}")
        part = read.rows.withColumn("encoding", F.lit(encoding))
        found = part if found is None else found.unionByName(part)
    dropped(lines)
    return found


_CSV_ENCODINGS = f"""{_SPANNING_SQL}
SELECT encoding, {", ".join("concat(name, ' é€') AS name" if n == "name" else n for n in COLUMNS)}, batch_year,
  row_number() OVER (PARTITION BY encoding, batch_year ORDER BY source_row_number) + 1 AS source_row_number
FROM spanning, (SELECT unnest(['utf-16', 'cp1252']) AS encoding)"""


_ODD = "\ue000"  # stands for bytes that are no text
_FAULTY = {
    "utf8": ({"encode": lambda text: text.cast("binary")}, b"\xff"),
    "utf-16": (_WIDE, b"\x00\xd8"),
    "cp1252": (_ENCODED["cp1252"], b"\x81"),
}


def csv_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is wrong with files of no bytes, of a header alone, with an open quote or with bytes that are no text."""
    rows, year = raw_orders(spark, sf_dir), F.col(BATCH)
    given = F.concat_ws(",", *[_cell(name) for name in COLUMNS])
    tenth = F.col(ROW) % 10 == 0
    line = (
        F.when(year == 1996, None)
        .when((year == 1997) & (F.col(ROW) == 10), F.concat(F.lit('"'), F.replace(given, F.lit('"'), F.lit(""))))
        .when(year == 1997, F.replace(given, F.lit('"'), F.lit("")))
        .when((year == 1998) & tenth, F.concat(given, F.lit(_ODD)))
        .otherwise(given)
    )
    lines = _lines(rows, line)
    found = []
    for encoding, (how, odd) in _FAULTY.items():

        def encode(text: Column, known: Callable[[Column], Column] = how["encode"], odd: bytes = odd) -> Column:
            good = known(F.replace(text, F.lit(_ODD), F.lit("")))
            return F.when(F.endswith(text, F.lit(_ODD)), F.concat(good, F.lit(odd))).otherwise(good)

        folder = _write(lines, _marked(_HEADER, encoding), encode, how.get("line_feed", "\n"))
        storage.empty_file(spark, f"{folder}/food_inspections_2002.csv")
        problems = read_batches(spark, _discover(spark, folder), COLUMNS, encoding=encoding).problems
        found += [(encoding, y, text) for y, texts in problems.items() for text in texts]
    return spark.createDataFrame(found, "encoding string, batch_year smallint, problem string")


_CSV_FAULTS = f"""WITH {RAW_ORDERS_SQL}, encodings AS (SELECT unnest(['utf8', 'utf-16', 'cp1252']) AS encoding)
SELECT encoding, CAST(2002 AS SMALLINT) AS batch_year, 'file has no header' AS problem FROM encodings
UNION ALL
SELECT encoding, batch_year, 'file has no data rows' FROM encodings, raw_orders WHERE batch_year = 1996
GROUP BY encoding, batch_year
UNION ALL
SELECT encoding, batch_year, concat('file does not decode as ', encoding) FROM encodings, raw_orders
WHERE batch_year = 1998 AND source_row_number % 10 = 0 GROUP BY encoding, batch_year
UNION ALL
SELECT encoding, batch_year, 'file is malformed: a quoted field is not closed' FROM encodings, raw_orders
WHERE batch_year = 1997 AND source_row_number = 10 GROUP BY encoding, batch_year"""


def run_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reports of two runs; between them the file of 1998 loses its last records."""
    lines = _lines(raw_orders(spark, sf_dir))
    folder = _write(lines)
    root = scratch_path(spark, "outputs")
    settings = Settings(
        curated=f"{root}/curated", quarantine=f"{root}/quarantine", state=f"{root}/state",
        dataset="raw_orders", **_YEARS,
    )
    wanted = [
        BATCH, "status", "reason", "errors", "warnings", "duplicate_detection_skipped",
        "raw", "accepted", "rejected", "quarantine_issues", "curated_rows", "quarantine_rows",
    ]

    def report(number: int) -> list[tuple]:
        found = run_all(spark, folder, CONTRACT, settings, roles=ROLES)
        return [(number, *row) for row in found.select(*wanted).collect()]  # one row per batch

    rows_of_both = report(1)
    # The other files stay as they are.
    storage.remove_folder(spark, f"{folder}/food_inspections_1998.csv")
    _write(lines.where((F.col(BATCH) == 1998) & (F.col(ROW) % 10 != 0)), folder=folder)
    rows_of_both += report(2)
    return spark.createDataFrame(
        rows_of_both,
        "run int, batch_year smallint, status string, reason string, errors bigint, warnings bigint, "
        "duplicate_detection_skipped boolean, raw bigint, accepted bigint, rejected bigint, "
        "quarantine_issues bigint, curated_rows bigint, quarantine_rows bigint",
    )


def totals_of_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of the two runs found, processed and skipped."""
    return run_totals(run_twice(spark, sf_dir), by=["run"])


def run_issue_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The issue counts that a run over files has stored."""
    root = scratch_path(spark, "outputs")
    settings = Settings(
        curated=f"{root}/curated", quarantine=f"{root}/quarantine", state=f"{root}/state",
        metrics=f"{root}/metrics", dataset="raw_orders", **_YEARS,
    )
    run_all(spark, _write(_lines(raw_orders(spark, sf_dir))), CONTRACT, settings, roles=ROLES)
    shape = f"rule_id string, column string, severity string, issue_count bigint, {BATCH} smallint"
    return spark.read.schema(shape).parquet(settings.metrics).select(
        BATCH, "rule_id", "column", "severity", "issue_count"
    )


FILE_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "csv_rows": csv_rows,
    "batch_listing": batch_listing,
    "batch_line_digest": batch_line_digest,
    "csv_encodings": csv_encodings,
    "csv_problems": csv_problems,
    "csv_faults": csv_faults,
    "run_twice": run_twice,
    "run_totals": totals_of_runs,
    "run_issue_metrics": run_issue_metrics,
}
FILE_ORACLES = {
    "csv_rows": _CSV_ROWS,
    "batch_listing": _BATCH_LISTING,
    "batch_line_digest": _BATCH_LINE_DIGEST,
    "csv_encodings": _CSV_ENCODINGS,
    "csv_problems": _CSV_PROBLEMS,
    "csv_faults": _CSV_FAULTS,
}
