"""Quarantine: one row per blocking issue, with the raw record and its diagnosis."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..plans.contract import Contract, primary_key, source_columns
from .rules import explode_issues
from .validate import BATCH, ROW
from .wording import ERROR

# Names of the diagnostic columns, in output order.
QUARANTINE_COLUMNS = (
    "dq_source_row_number",
    "dq_rule_id",
    "dq_column",
    "dq_value",
    "dq_message",
    "dq_severity",
    "dq_duplicate_of_inspection_id",
    "dq_batch_year",
)


def quarantine(
    validated: DataFrame, contract: Contract, *, batch: str = BATCH, row: str = ROW
) -> DataFrame:
    """The source columns followed by the diagnostic columns, for every error issue."""
    names = source_columns(contract)
    check_quarantine_source(names, primary_key(contract))
    carried = [name for name in dict.fromkeys([*names, row, batch, "duplicate_of"])]
    # Issue fields are renamed on the way out, since a source column may be called "value".
    renamed = validated.withColumn(
        "issues",
        F.col("issues").cast(
            "array<struct<dq_rule_id:string,dq_column:string,dq_value:string,"
            "dq_message:string,dq_severity:string>>"
        ),
    )
    exploded = renamed.select(*carried, F.inline_outer("issues"))
    values = {
        "dq_source_row_number": F.col(row).cast("bigint"),
        "dq_duplicate_of_inspection_id": F.col("duplicate_of"),
        "dq_batch_year": F.col(batch).cast("smallint"),
    }
    return exploded.where(F.col("dq_severity") == ERROR).select(
        *names, *[values.get(name, F.col(name)).alias(name) for name in QUARANTINE_COLUMNS]
    )


def check_quarantine_source(columns: list[str], key: str) -> None:
    """The raw columns can be stored next to the diagnostic ones."""
    if len(columns) != len(set(columns)):
        raise ValueError("source columns repeat a name")
    if key not in columns:
        raise ValueError(f"source columns lack the primary key {key}")
    taken = sorted(set(columns) & set(QUARANTINE_COLUMNS))
    if taken:
        raise ValueError(f"source columns use the names of diagnostic columns: {taken}")
