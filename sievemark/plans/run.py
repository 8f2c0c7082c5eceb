"""Whole runs: find batches, skip current ones, validate, publish, record state.

All pending batches share one scan, one validation and one write per table. A batch
that cannot be published stops the run: batches before it (by year) are published,
later ones are not.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.conflicts import Conflicts
from ..operators.curate import CURATED_PARTITION, conversion_failures, curate
from ..operators.metrics import batch_summary, issue_metrics
from ..operators.quarantine import check_quarantine_source, quarantine
from ..operators.rules import Chain
from ..operators.validate import BATCH, ROW, accepted, annotate, batch_conflicts
from ..sources.batches import (
    BATCHES,
    LINE_DIGEST,
    NAME_PATTERN,
    BatchFile,
    check_algorithm,
    discover_batches,
    inspect_batches,
    line_facts,
    locate_batch,
)
from ..sources.csv_batches import read_batches
from ..sources.encodings import find_encoding
from ..sources.publish import (
    QUARANTINE_PARTITION,
    Published,
    check_format,
    check_partitioning,
    publish,
)
from ..sources.state import (
    STATE,
    STATE_VERSION,
    check_dataset,
    output_sizes,
    read_state,
    state_violations,
    write_state,
)
from .contract import Contract, Roles, check_contract, primary_key, source_columns
from .durable import scratch, stored
from .incremental import pending_batches
from .session import prepared


class BatchError(Exception):
    """A batch cannot be published."""

    def __init__(self, year: int, problems: Sequence[str]):
        super().__init__(f"batch {year}: {'; '.join(problems)}")
        self.year = year
        self.problems = list(problems)


@dataclass(frozen=True)
class Settings:
    """Where a dataset lives and how it is read and written.

    ``metrics`` is where issues are counted by batch, rule, column and severity, if that is wanted.
    """

    curated: str
    quarantine: str
    state: str
    dataset: str
    start_year: int
    end_year: int
    file_pattern: str = "food_inspections_*.csv"
    name_pattern: str = NAME_PATTERN
    encoding: str = "utf-8"
    delimiter: str = ","
    hash_algorithm: str = LINE_DIGEST
    output_format: str = "parquet"
    compression: str = "snappy"
    partition_by: tuple[str, ...] = (CURATED_PARTITION,)
    metrics: str | None = None

    @property
    def years(self) -> dict:
        return {
            "start_year": self.start_year,
            "end_year": self.end_year,
            "name_pattern": self.name_pattern,
        }


REPORT = (
    "batch_year smallint, status string, reason string, path string, size_bytes bigint, "
    "checksum_algorithm string, checksum string, completed_at_utc string, errors bigint, "
    "warnings bigint, duplicate_detection_skipped boolean, raw bigint, accepted bigint, "
    "rejected bigint, quarantine_issues bigint, curated_path string, curated_rows bigint, "
    "curated_size_bytes bigint, curated_compression string, quarantine_path string, "
    "quarantine_rows bigint, quarantine_size_bytes bigint, quarantine_compression string"
)


def run_report(batches: DataFrame, state: DataFrame, processed: DataFrame) -> DataFrame:
    """One row per batch: was it processed or skipped, its counts and its outputs.

    ``processed`` lists the batches of this run with ``duplicate_detection_skipped``.
    """
    names = {
        "completed_at_utc": "completed_at_utc",
        "errors": "error_count",
        "warnings": "warning_count",
        "raw": "raw_row_count",
        "accepted": "accepted_row_count",
        "rejected": "rejected_record_count",
        "quarantine_issues": "quarantine_issue_count",
    }
    for kind in ("curated", "quarantine"):
        names[f"{kind}_path"] = f"{kind}_path"
        names[f"{kind}_rows"] = f"{kind}_row_count"
        names[f"{kind}_size_bytes"] = f"{kind}_size_bytes"
        names[f"{kind}_compression"] = f"{kind}_compression"
    counts = state.select("batch_year", *[F.col(old).alias(new) for new, old in names.items()])
    done = processed.withColumn("__done", F.lit(True))
    rows = batches.join(counts, "batch_year").join(done, "batch_year", "left")
    is_done = F.col("__done").isNotNull()
    return rows.withColumns(
        {
            "status": F.when(is_done, "processed").otherwise("skipped"),
            "reason": F.when(~is_done, "batch_state_current"),
        }
    ).select(*[field.split()[0] for field in REPORT.split(", ")])


def run_totals(report: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """How many batches a run found, processed and skipped, from its report; ``by`` tells runs apart."""
    return report.groupBy(*by).agg(
        F.count(F.lit(1)).alias("discovered"),
        F.count_if(F.col("status") == "processed").alias("processed"),
        F.count_if(F.col("status") == "skipped").alias("skipped"),
    )


def run_all(
    spark: SparkSession,
    incoming: str,
    contract: Contract,
    settings: Settings,
    *,
    roles: Roles = Roles(),
    extra: Sequence[Chain] = (),
) -> DataFrame:
    """Bring every batch file of a folder up to date; returns the run report.

    ``extra`` are rules of the caller's own, evaluated after those of the contract.
    """
    batches = discover_batches(
        spark, incoming, file_pattern=settings.file_pattern, **settings.years
    )
    return run_batches(spark, batches, contract, settings, roles=roles, extra=extra)


def run_one(
    spark: SparkSession,
    path: str,
    contract: Contract,
    settings: Settings,
    *,
    roles: Roles = Roles(),
    extra: Sequence[Chain] = (),
) -> DataFrame:
    """Bring one batch file up to date; returns the run report."""
    batch = locate_batch(spark, path, **settings.years)
    return run_batches(spark, [batch], contract, settings, roles=roles, extra=extra)


def run_batches(
    spark: SparkSession,
    batches: Sequence[BatchFile],
    contract: Contract,
    settings: Settings,
    *,
    roles: Roles = Roles(),
    extra: Sequence[Chain] = (),
) -> DataFrame:
    check_contract(contract)
    check_quarantine_source(source_columns(contract), primary_key(contract))
    check_dataset(settings.dataset)
    check_partitioning(settings.partition_by)
    codec = check_format(settings.output_format, settings.compression)
    find_encoding(settings.encoding)
    check_algorithm(settings.hash_algorithm)
    if not batches:
        return spark.createDataFrame([], REPORT)
    # Intermediate tables go when the run ends, also when it fails; the settings are put back.
    with scratch(spark), prepared(spark):
        return _run(spark, batches, contract, settings, codec, roles, extra)


def _run(
    spark: SparkSession,
    batches: Sequence[BatchFile],
    contract: Contract,
    settings: Settings,
    codec: str,
    roles: Roles,
    extra: Sequence[Chain],
) -> DataFrame:
    # One scan of the lines serves both for the digests and for how to read the files.
    facts = None
    full = [batch.path for batch in batches if batch.size_bytes > 0]
    if full and check_algorithm(settings.hash_algorithm) == LINE_DIGEST:
        facts = stored(line_facts(spark, full, delimiter=settings.delimiter), "line_facts")
    # The lists below have one entry per batch year.
    found = inspect_batches(
        spark,
        batches,
        algorithm=settings.hash_algorithm,
        facts=facts,
    ).collect()
    inspected = spark.createDataFrame(found, BATCHES)
    asked = [batch.year for batch in batches]
    known = read_state(spark, settings.state, dataset=settings.dataset, years=asked)
    paths = [
        path
        for row in known.select("curated_path", "quarantine_path").collect()
        for path in (row.curated_path, row.quarantine_path)
    ]
    pending = pending_batches(inspected, known, output_sizes(spark, paths))
    years = sorted(row.batch_year for row in pending.select("batch_year").collect())
    processed = {}
    if years:
        chosen = [batch for batch in batches if batch.year in years]
        processed = _process(
            spark, chosen, inspected, facts, contract, settings, codec, roles, extra
        )

    gates = spark.createDataFrame(
        list(processed.items()), "batch_year smallint, duplicate_detection_skipped boolean"
    )
    now = read_state(spark, settings.state, dataset=settings.dataset, years=asked)
    report = run_report(inspected, now, gates).orderBy("batch_year")
    # One row per batch, apart from the tables of this run.
    return spark.createDataFrame(report.collect(), REPORT)


def _process(
    spark: SparkSession,
    batches: Sequence[BatchFile],
    inspected: DataFrame,
    facts: DataFrame | None,
    contract: Contract,
    settings: Settings,
    codec: str,
    roles: Roles,
    extra: Sequence[Chain],
) -> dict[int, bool]:
    """Validate and publish; returns the gate of each published batch."""
    raw = read_batches(
        spark,
        batches,
        source_columns(contract),
        encoding=settings.encoding,
        delimiter=settings.delimiter,
        name_pattern=settings.name_pattern,
        facts=facts,
    )
    problems = dict(raw.problems)
    usable = [b.year for b in batches if b.year < min(problems, default=1 << 15)]
    if usable:
        rows = raw.rows.where(F.col(BATCH).isin(usable))
        conflicts = batch_conflicts(rows, contract)
        # Read by the counts and by both writes, so it is written once to the shared folder.
        validated = stored(annotate(rows, contract, conflicts, roles=roles, extra=extra), "validated")
        summary = {row[BATCH]: row for row in batch_summary(validated).collect()}
        problems |= _unpublishable(validated, contract)
        publishable = [year for year in usable if year < min(problems, default=1 << 15)]
        if publishable:
            _publish(
                spark, validated, conflicts, summary, publishable, inspected, contract,
                settings, codec,
            )
    if problems:
        first = min(problems)
        raise BatchError(first, problems[first])
    return {year: summary[year].duplicate_detection_skipped for year in publishable}


def _unpublishable(validated: DataFrame, contract: Contract) -> dict[int, list[str]]:
    failures = conversion_failures(accepted(validated), contract)
    found: dict[int, list[str]] = {}
    for row in failures.where("blank_rows > 0 OR invalid_rows > 0").collect():
        texts = found.setdefault(row[BATCH], [])
        if row.blank_rows:
            texts.append(f"{row.blank_rows} accepted rows are blank in {row.source_column}")
        if row.invalid_rows:
            texts.append(f"{row.invalid_rows} accepted rows do not convert in {row.source_column}")
    return found


def _publish(
    spark: SparkSession,
    validated: DataFrame,
    conflicts: Conflicts,
    summary: dict,
    years: Sequence[int],
    inspected: DataFrame,
    contract: Contract,
    settings: Settings,
    codec: str,
) -> None:
    """Quarantine first, then curated and metrics, then state: a batch counts only once its state is there."""
    rows = validated.where(F.col(BATCH).isin(list(years)))
    held = publish(
        quarantine(rows, contract),
        settings.quarantine,
        partition=QUARANTINE_PARTITION,
        years=years,
        expected_rows={year: summary[year].error_issues for year in years},
        order=["dq_source_row_number", "dq_rule_id", "dq_column"],
        compression=codec,
        rebalance=True,
    )
    kept = publish(
        curate(accepted(rows), contract, keep=(ROW,)),
        settings.curated,
        partition=CURATED_PARTITION,
        years=years,
        expected_rows={year: summary[year].accepted_rows for year in years},
        order=[ROW],
        compression=codec,
        # Rows still lie as they were read unless the conflicts had to be shuffled in.
        rebalance=conflicts.moves_rows,
        drop=[ROW],
    )
    if settings.metrics:
        _publish_metrics(rows, settings.metrics, years, codec)
    records = _state_records(spark, summary, years, inspected, settings, held, kept)
    broken = state_violations(records).collect()
    if broken:
        raise BatchError(broken[0].batch_year, [broken[0].problems])
    write_state(records, settings.state)


def _publish_metrics(rows: DataFrame, root: str, years: Sequence[int], codec: str) -> None:
    """Replace the counts of these batches, also by none. A batch has few: as many as rules meet columns."""
    counts = stored(issue_metrics(rows), "issue_metrics")
    expected = {row[BATCH]: row.n for row in counts.groupBy(BATCH).agg(F.count(F.lit(1)).alias("n")).collect()}
    publish(
        counts,
        root,
        partition=BATCH,
        years=years,
        expected_rows={year: expected.get(year, 0) for year in years},
        order=["rule_id", "column", "severity"],
        compression=codec,
        rebalance=True,
    )


def _state_records(
    spark: SparkSession,
    summary: dict,
    years: Sequence[int],
    inspected: DataFrame,
    settings: Settings,
    held: Sequence[Published],
    stored: Sequence[Published],
) -> DataFrame:
    source = {row.batch_year: row for row in inspected.collect()}
    outputs = {
        "curated": {item.year: item for item in stored},
        "quarantine": {item.year: item for item in held},
    }
    finished = f"{datetime.now(timezone.utc):%Y-%m-%dT%H:%M:%SZ}"
    records = []
    for year in years:
        counts, file = summary[year], source[year]
        record = {
            "schema_version": STATE_VERSION,
            "dataset": settings.dataset,
            "batch_year": year,
            "completed_at_utc": finished,
            "source_path": file.path,
            "source_size_bytes": file.size_bytes,
            "checksum_algorithm": file.checksum_algorithm,
            "checksum": file.checksum,
            "raw_row_count": counts.raw_rows,
            "accepted_row_count": counts.accepted_rows,
            "rejected_record_count": counts.rejected_rows,
            "quarantine_issue_count": outputs["quarantine"][year].row_count,
            "error_count": counts.error_issues,
            "warning_count": counts.warning_issues,
        }
        for kind, items in outputs.items():
            record[f"{kind}_path"] = items[year].path
            record[f"{kind}_row_count"] = items[year].row_count
            record[f"{kind}_size_bytes"] = items[year].size_bytes
            record[f"{kind}_compression"] = items[year].compression
        records.append(tuple(record[name] for name in STATE.fieldNames()))
    return spark.createDataFrame(records, STATE)
