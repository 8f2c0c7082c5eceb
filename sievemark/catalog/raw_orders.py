"""A dirty, batched all-text input made from the ``orders`` table.

The provided tables are clean, so this view puts known dirt into them: which rows
get it depends on the order key only. ``source_row_number`` tells the rows of a batch apart and
stands for their position in the source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..plans.contract import Roles
from ..plans.session import prepare, spread

COLUMNS = [
    "record_id",
    "name",
    "license",
    "risk",
    "state",
    "zip",
    "event_date",
    "result",
    "latitude",
    "longitude",
]

ROLES = Roles(date="event_date", result="result", license="license", risk="risk")

_TRIM = ["trim_whitespace"]


def _entry(target: str, kind: str, nullable: bool = True, **settings) -> dict:
    return {"target_name": target, "target_type": kind, "nullable": nullable, **settings}


CONTRACT = {
    "contract": {"name": "raw_orders", "primary_key": "record_id"},
    "source_schema": {"expected_columns": COLUMNS},
    "columns": {
        "record_id": _entry("record_id", "int64", False, validations={"minimum": 1}),
        "name": _entry(
            "name", "string", False, cleaning=[*_TRIM, "collapse_internal_whitespace"]
        ),
        "license": _entry(
            "license_number",
            "Int64",
            cleaning={"zero_as_null": True},
            validations={"format_when_present": "digits"},
        ),
        "risk": _entry(
            "risk",
            "string",
            allowed_values=["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"],
            unknown_value_severity="warning",
        ),
        "state": _entry(
            "state",
            "string",
            cleaning=[*_TRIM, "uppercase"],
            validations={"pattern": "^[A-Z]{2}$"},
        ),
        "zip": _entry(
            "zip_code", "string", cleaning=_TRIM, validations={"pattern": "^[0-9]{5}$"}
        ),
        "event_date": _entry(
            "event_date", "date", False, accepted_formats=["%Y-%m-%dT%H:%M:%S.%f"]
        ),
        "result": _entry("result", "string", False, allowed_values=["O", "F", "P"]),
        "latitude": _entry("latitude", "float64", validations={"minimum": -90, "maximum": 90}),
        "longitude": _entry("longitude", "float64", validations={"minimum": -180, "maximum": 180}),
    },
    "record_rules": [{"id": "exact_duplicate_record", "severity": "error"}],
}


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One scan of ``orders``; a copied order gives two rows from the same input row."""
    orders = spread(prepare(spark).read.parquet(f"{sf_dir}/orders.parquet"))
    k, y = F.col("k"), F.col("y")
    text = orders.select(
        F.col("o_orderkey").alias("k"),
        F.col("o_custkey").cast("string").alias("c"),
        F.col("o_orderstatus").alias("st"),
        F.col("o_orderpriority").alias("pr"),
        F.year("o_orderdate").alias("y"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss.SSS").alias("ts"),
    )
    copied = (k % 137 == 0) & (y >= 1996)
    numbers = F.when(copied, F.array(k, k + F.lit(100_000_000))).otherwise(F.array(k))
    rows = text.withColumn("source_row_number", F.explode(numbers))
    number = F.col("source_row_number").cast("string")

    def every(modulus: int) -> Column:
        return k % modulus == 0

    def bad_id(modulus: int) -> Column:
        return (y == 1995) & every(modulus)

    tail = F.lpad((k % 1000).cast("string"), 3, "0")
    no_place = every(127)
    return rows.select(
        y.cast("smallint").alias("batch_year"),
        "source_row_number",
        F.when(bad_id(211), "")
        .when(bad_id(223), F.concat(number, F.lit("A")))
        .when(bad_id(227), "9223372036854775808")
        .when(bad_id(229), "0")
        .when(bad_id(233), "00100000007")
        .otherwise(number)
        .alias("record_id"),
        F.when(every(29), F.concat(F.lit("  Clerk   "), "c", F.lit(" ")))
        .otherwise(F.concat(F.lit("Clerk "), "c"))
        .alias("name"),
        F.when(every(31), "0").when(every(37), "").when(every(41), "12X").otherwise(F.col("c"))
        .alias("license"),
        F.when(every(43), "").when(every(47), "9-UNKNOWN").otherwise(F.col("pr")).alias("risk"),
        F.when(every(53), "").when(every(59), "Illinois").when(every(61), "il").otherwise("IL")
        .alias("state"),
        F.when(every(67), "123").when(every(71), "")
        .otherwise(F.lpad((k % 100_000).cast("string"), 5, "0"))
        .alias("zip"),
        F.when(every(73), "").when(every(79), "not-a-date")
        .when(every(83), "2019-02-30T00:00:00.000").when(every(89), "1900-01-01T00:00:00.000")
        .otherwise(F.col("ts"))
        .alias("event_date"),
        F.when(every(97), "").when(every(101), F.lower("st")).otherwise(F.col("st"))
        .alias("result"),
        F.when(no_place, "").when(every(107), "north").when(every(109), "91")
        .otherwise(F.concat(F.lit("41."), tail))
        .alias("latitude"),
        F.when(no_place | every(103), "").when(every(113), "NaN")
        .otherwise(F.concat(F.lit("-87."), tail))
        .alias("longitude"),
    )


RAW_ORDERS_SQL = """
base AS (
  SELECT o_orderkey AS k, cast(o_custkey AS varchar) AS c, o_orderstatus AS st,
         o_orderpriority AS pr, year(o_orderdate) AS y,
         strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%g') AS ts
  FROM orders
), src AS (
  SELECT *, k AS seq FROM base
  UNION ALL
  SELECT *, k + 100000000 AS seq FROM base WHERE k % 137 = 0 AND y >= 1996
), raw_orders AS (
  SELECT cast(y AS smallint) AS batch_year, cast(seq AS bigint) AS source_row_number,
    CASE WHEN y = 1995 AND k % 211 = 0 THEN ''
         WHEN y = 1995 AND k % 223 = 0 THEN concat(cast(seq AS varchar), 'A')
         WHEN y = 1995 AND k % 227 = 0 THEN '9223372036854775808'
         WHEN y = 1995 AND k % 229 = 0 THEN '0'
         WHEN y = 1995 AND k % 233 = 0 THEN '00100000007'
         ELSE cast(seq AS varchar) END AS record_id,
    CASE WHEN k % 29 = 0 THEN concat('  Clerk   ', c, ' ') ELSE concat('Clerk ', c) END AS name,
    CASE WHEN k % 31 = 0 THEN '0' WHEN k % 37 = 0 THEN '' WHEN k % 41 = 0 THEN '12X'
         ELSE c END AS license,
    CASE WHEN k % 43 = 0 THEN '' WHEN k % 47 = 0 THEN '9-UNKNOWN' ELSE pr END AS risk,
    CASE WHEN k % 53 = 0 THEN '' WHEN k % 59 = 0 THEN 'Illinois' WHEN k % 61 = 0 THEN 'il'
         ELSE 'IL' END AS state,
    CASE WHEN k % 67 = 0 THEN '123' WHEN k % 71 = 0 THEN ''
         ELSE lpad(cast(k % 100000 AS varchar), 5, '0') END AS zip,
    CASE WHEN k % 73 = 0 THEN '' WHEN k % 79 = 0 THEN 'not-a-date'
         WHEN k % 83 = 0 THEN '2019-02-30T00:00:00.000'
         WHEN k % 89 = 0 THEN '1900-01-01T00:00:00.000' ELSE ts END AS event_date,
    CASE WHEN k % 97 = 0 THEN '' WHEN k % 101 = 0 THEN lower(st) ELSE st END AS result,
    CASE WHEN k % 127 = 0 THEN '' WHEN k % 107 = 0 THEN 'north' WHEN k % 109 = 0 THEN '91'
         ELSE concat('41.', lpad(cast(k % 1000 AS varchar), 3, '0')) END AS latitude,
    CASE WHEN k % 127 = 0 OR k % 103 = 0 THEN '' WHEN k % 113 = 0 THEN 'NaN'
         ELSE concat('-87.', lpad(cast(k % 1000 AS varchar), 3, '0')) END AS longitude
  FROM src
)"""
