"""Counts about validated batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .rules import explode_issues
from .validate import BATCH, error_count, has_error, warning_count


def summary_columns() -> list[Column]:
    """Row-grain and issue-grain counts; a rejected row counts once, its issues each."""
    return [
        F.count(F.lit(1)).alias("raw_rows"),
        F.count_if(~has_error()).alias("accepted_rows"),
        F.count_if(has_error()).alias("rejected_rows"),
        F.sum(error_count()).cast("bigint").alias("error_issues"),
        F.sum(warning_count()).cast("bigint").alias("warning_issues"),
        F.bool_or("duplicate_detection_skipped").alias("duplicate_detection_skipped"),
    ]


def batch_summary(validated: DataFrame, *, batch: str = BATCH) -> DataFrame:
    return validated.groupBy(batch).agg(*summary_columns())


def issue_metrics(validated: DataFrame, *, batch: str = BATCH) -> DataFrame:
    """Issues by batch, rule, column and severity."""
    return (
        explode_issues(validated, [batch])
        .groupBy(batch, "rule_id", "column", "severity")
        .agg(F.count(F.lit(1)).alias("issue_count"))
    )


def reconciliation(
    summary: DataFrame, curated: DataFrame, quarantined: DataFrame, *, batch: str = BATCH
) -> DataFrame:
    """Do the outputs add up to the input? ``curated`` and ``quarantined`` are counted per batch.

    All three sides have one row per batch after aggregation.
    """
    stored = curated.groupBy(batch).agg(F.count(F.lit(1)).alias("curated_rows"))
    held = quarantined.groupBy(batch).agg(F.count(F.lit(1)).alias("quarantine_rows"))
    joined = summary.join(stored, batch, "left").join(held, batch, "left")
    filled = joined.withColumns(
        {
            name: F.coalesce(name, F.lit(0)).cast("bigint")
            for name in ("curated_rows", "quarantine_rows")
        }
    )
    return filled.select(
        batch,
        "raw_rows",
        "accepted_rows",
        "rejected_rows",
        "error_issues",
        "curated_rows",
        "quarantine_rows",
        (F.col("accepted_rows") + F.col("rejected_rows") == F.col("raw_rows")).alias("rows_add_up"),
        (F.col("curated_rows") == F.col("accepted_rows")).alias("curated_complete"),
        (F.col("quarantine_rows") == F.col("error_issues")).alias("quarantine_complete"),
    )
