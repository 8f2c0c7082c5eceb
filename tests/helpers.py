"""Small inputs in the shape of the default contract."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sievemark import INSPECTIONS

COLUMNS = INSPECTIONS["source_schema"]["expected_columns"]

GOOD = {
    "inspection_id": "1",
    "dba_name": "Corner Cafe",
    "aka_name": "Corner Cafe",
    "license_": "4711",
    "facility_type": "Restaurant",
    "risk": "Risk 1 (High)",
    "address": "1 Lake Rd",
    "city": "Chicago",
    "state": "IL",
    "zip": "60601",
    "inspection_date": "2019-05-01T10:00:00.000",
    "inspection_type": "Canvass",
    "results": "Pass",
    "violations": "",
    "latitude": "41.5",
    "longitude": "-87.5",
    "location": "(41.5, -87.5)",
}


def record(number: object, **changes: str | None) -> dict:
    """A valid record that differs from all others in its name and id."""
    return {**GOOD, "inspection_id": str(number), "dba_name": f"Place {number}", **changes}


def batch(spark: SparkSession, records: list[dict], year: int = 2019) -> DataFrame:
    rows = [
        (*[item[name] for name in COLUMNS], year, position + 2)
        for position, item in enumerate(records)
    ]
    names = ", ".join(f"`{name}` string" for name in COLUMNS)
    return spark.createDataFrame(rows, f"{names}, batch_year smallint, source_row_number bigint")


def column(spark: SparkSession, values: list, sql: str, kind: str = "string") -> list:
    """The values of an expression over a column ``v``, in order."""
    rows = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}").coalesce(1)
    return [row.x for row in rows.select("i", F.expr(sql).alias("x")).orderBy("i").collect()]


def csv_text(records: list[dict]) -> str:
    def cell(value: str) -> str:
        return '"' + value.replace('"', '""') + '"' if set(value) & set(',"\n') else value

    lines = [",".join(COLUMNS)]
    lines += [",".join(cell(item[name]) for name in COLUMNS) for item in records]
    return "\n".join(lines) + "\n"
