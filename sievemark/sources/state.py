"""The state table: one row for every batch that has been published completely."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from . import storage

STATE_VERSION = 1

_TEXT, _COUNT = T.StringType(), T.LongType()

# Fields of a state record, in order.
STATE = T.StructType(
    [
        T.StructField("schema_version", T.IntegerType()),
        T.StructField("dataset", _TEXT),
        T.StructField("batch_year", T.ShortType()),
        T.StructField("completed_at_utc", _TEXT),
        T.StructField("source_path", _TEXT),
        T.StructField("source_size_bytes", _COUNT),
        T.StructField("checksum_algorithm", _TEXT),
        T.StructField("checksum", _TEXT),
        T.StructField("raw_row_count", _COUNT),
        T.StructField("accepted_row_count", _COUNT),
        T.StructField("rejected_record_count", _COUNT),
        T.StructField("quarantine_issue_count", _COUNT),
        T.StructField("error_count", _COUNT),
        T.StructField("warning_count", _COUNT),
        T.StructField("curated_path", _TEXT),
        T.StructField("curated_row_count", _COUNT),
        T.StructField("curated_size_bytes", _COUNT),
        T.StructField("curated_compression", _TEXT),
        T.StructField("quarantine_path", _TEXT),
        T.StructField("quarantine_row_count", _COUNT),
        T.StructField("quarantine_size_bytes", _COUNT),
        T.StructField("quarantine_compression", _TEXT),
    ]
)


def check_dataset(dataset: object) -> None:
    if not isinstance(dataset, str) or not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9_-]*", dataset):
        raise ValueError(f"invalid dataset name: {dataset!r}")


def write_state(records: DataFrame, root: str) -> None:
    """Add or replace the rows of these batches; other batches stay as they are."""
    complete = records.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in STATE.fields])
    (
        complete.coalesce(1)  # one short row per batch
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("dataset", "batch_year")
        .parquet(root)
    )


def read_state(
    spark: SparkSession, root: str, *, dataset: str, years: Sequence[int] | None = None
) -> DataFrame:
    """State of one dataset, or of some years of it; empty when nothing has been published yet.

    Only records that are returned must be sound.
    """
    check_dataset(dataset)
    if not storage.entries(spark, root):
        return spark.createDataFrame([], STATE)
    state = spark.read.schema(STATE).parquet(root).where(F.col("dataset") == dataset)
    if years is not None:
        state = state.where(F.col("batch_year").isin(list(years)))
    state = state.select(*STATE.fieldNames())
    unsound = state_violations(state).first()
    if unsound:
        raise ValueError(f"state of {dataset} {unsound.batch_year} is unsound: {unsound.problems}")
    return state


def state_violations(state: DataFrame) -> DataFrame:
    """Per batch: what is wrong with its state record; sound records are left out."""
    checks = {
        "unknown schema version": F.col("schema_version") != STATE_VERSION,
        "rows do not add up": F.col("accepted_row_count") + F.col("rejected_record_count")
        != F.col("raw_row_count"),
        "curated rows differ from accepted rows": F.col("curated_row_count")
        != F.col("accepted_row_count"),
        "quarantine rows differ from issues": F.col("quarantine_row_count")
        != F.col("quarantine_issue_count"),
        "quarantined issues differ from errors": F.col("quarantine_issue_count")
        != F.col("error_count"),
    }
    for field in STATE.fields:
        column = F.col(field.name)
        if field.name.endswith(("_count", "_bytes")):
            bad = F.coalesce(column < 0, F.lit(True))
            checks[f"{field.name} is not a count"] = bad
        elif field.name == "completed_at_utc":
            zoned = column.rlike(r"(?:Z|[+-][0-9]{2}:[0-9]{2})\z")
            read = F.try_to_timestamp(column).isNotNull()
            checks[f"{field.name} is not a time with a zone"] = ~F.coalesce(
                zoned & read, F.lit(False)
            )
        elif isinstance(field.dataType, T.StringType):
            checks[f"{field.name} is empty"] = F.coalesce(column == "", F.lit(True))
    found = F.concat_ws("; ", *[F.when(bad, F.lit(text)) for text, bad in checks.items()])
    return state.select("dataset", "batch_year", found.alias("problems")).where("problems <> ''")


def output_sizes(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Bytes now stored under each output path; missing outputs are left out."""
    sizes = [(path, storage.data_size(spark, path)) for path in paths]
    present = [(path, size) for path, size in sizes if size is not None]
    return spark.createDataFrame(present, "path string, size_bytes bigint")
