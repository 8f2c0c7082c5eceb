"""Publishing tables as year-partitioned Parquet, one folder per batch.

All batches of a run are written by one job into a staging folder next to the
table. Guards and counts are taken from what was written. Only then is each batch's
folder put in place, which also replaces an old folder by an empty one.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..operators.curate import CURATED_PARTITION
from ..operators.quarantine import QUARANTINE_COLUMNS
from ..operators.wording import ERROR
from . import storage

QUARANTINE_PARTITION = "dq_batch_year"
CODECS = ("snappy", "gzip", "zstd", "lz4", "none", "uncompressed")


@dataclass(frozen=True)
class Published:
    """One batch's folder of a published table."""

    year: int
    path: str
    row_count: int
    size_bytes: int
    compression: str


def check_format(output_format: object, compression: object) -> str:
    """The codec to use; only Parquet is supported."""
    if not isinstance(output_format, str) or output_format.strip().lower() != "parquet":
        raise ValueError(f"unsupported output format: {output_format!r}")
    codec = compression.strip().lower() if isinstance(compression, str) else ""
    if codec not in CODECS:
        raise ValueError(f"unsupported compression codec: {compression!r}")
    return codec


def check_partitioning(partition_by: Sequence[str]) -> None:
    if list(partition_by) != [CURATED_PARTITION]:
        raise ValueError(f"curated data must be partitioned by {CURATED_PARTITION} alone")


def check_quarantine_columns(columns: Sequence[str]) -> None:
    missing = [name for name in QUARANTINE_COLUMNS if name not in columns]
    if missing:
        raise ValueError(f"quarantine data lacks diagnostic columns: {missing}")


def partition_guards(partition: str, years: Sequence[int] | Column) -> dict[str, Column]:
    """Counts of rows that may not be stored under the expected years; all must be 0."""
    column = F.col(partition)
    number = column.cast("string").try_cast("double")
    if isinstance(years, Column):
        within = number == years
    else:
        within = number.isin([float(year) for year in years])
    whole = number % 1 == 0
    return {
        "null_partitions": F.count_if(column.isNull()),
        "not_integral": F.count_if(column.isNotNull() & ~F.coalesce(whole, F.lit(False))),
        "other_batch": F.count_if(F.coalesce(whole & ~within, F.lit(False))),
    }


def severity_guards(column: str = "dq_severity") -> dict[str, Column]:
    """Quarantine holds blocking issues only."""
    severity = F.col(column)
    return {
        "null_severities": F.count_if(severity.isNull()),
        "other_severities": F.count_if(severity.isNotNull() & (severity != ERROR)),
    }


def guard_report(df: DataFrame, guards: Mapping[str, Column], by: Sequence[str] = ()) -> DataFrame:
    """The guards as a table, optionally per group."""
    counts = [F.count(F.lit(1)).alias("row_count")]
    return df.groupBy(*by).agg(*counts, *[expr.alias(name) for name, expr in guards.items()])


def publish(
    df: DataFrame,
    root: str,
    *,
    partition: str,
    years: Sequence[int],
    expected_rows: Mapping[int, int],
    order: Sequence[str],
    compression: str = "snappy",
    rebalance: bool = False,
    drop: Sequence[str] = (),
) -> list[Published]:
    """Replace the folders of the given batches by the rows of ``df``.

    Rows keep the source order given by ``order`` within each file; ``drop`` removes
    ordering columns afterwards. ``rebalance`` gathers each batch into files of good
    size when rows have been shuffled or thinned out before; a large batch is still
    split among tasks.
    """
    spark = df.sparkSession
    names = [name for name in df.columns if name not in drop]
    if len(names) != len(set(names)):
        raise ValueError("published data repeats a column name")
    if partition not in names:
        raise ValueError(f"published data lacks the partition column {partition}")
    guards = partition_guards(partition, years)
    if partition == QUARANTINE_PARTITION:
        check_quarantine_columns(names)
        guards |= severity_guards()

    fields = [field for field in df.schema.fields if field.name in names]
    content = T.StructType([field for field in fields if field.name != partition])
    layout = T.StructType([*content.fields, T.StructField(partition, T.StringType())])
    run = uuid.uuid4().hex
    staging, aside = (f"{root.rstrip('/')}/_{kind}-{run}" for kind in ("staging", "replaced"))
    rows = df.hint("rebalance", partition) if rebalance else df
    try:
        (
            rows.sortWithinPartitions(partition, *order)
            .select(*names)
            .write.option("compression", compression)
            .partitionBy(partition)
            .parquet(staging)
        )
        # One row per folder written; counts come from file footers.
        staged = guard_report(spark.read.schema(layout).parquet(staging), guards, by=[partition])
        folders = staged.collect()
        broken = {name: sum(row[name] for row in folders) for name in guards}
        if any(broken.values()):
            found = {name: count for name, count in broken.items() if count}
            raise ValueError(f"rows may not be published to {root}: {found}")
        written = {int(row[partition]): row.row_count for row in folders}
        for year in years:
            if written.get(year, 0) != expected_rows[year]:
                raise ValueError(
                    f"batch {year}: {written.get(year, 0)} rows written to {root}, "
                    f"{expected_rows[year]} expected"
                )
        published = []
        for year in years:
            fresh, target = f"{staging}/{partition}={year}", f"{root.rstrip('/')}/{partition}={year}"
            if year not in written:
                empty = spark.createDataFrame([], content)
                empty.write.option("compression", compression).parquet(fresh)
            storage.replace_folder(spark, fresh, target, f"{aside}/{year}")
            published.append(
                Published(
                    year,
                    storage.qualified(spark, target),
                    written.get(year, 0),
                    storage.data_size(spark, target) or 0,
                    compression,
                )
            )
        storage.remove_folder(spark, aside)
        return published
    finally:
        # Old content that could not be put back stays in the folder set aside.
        storage.remove_folder(spark, staging)
