"""One query per operator, over the provided tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import clean, collapse, is_blank, strip, to_bigint, to_date, to_double
from ..operators.conflicts import find_exact_duplicates, key_clashes
from ..operators.curate import CURATED_PARTITION, conversion_failures, curate
from ..operators.metrics import batch_summary, issue_metrics, reconciliation
from ..operators.quarantine import quarantine
from ..operators.row_numbers import number_rows
from ..operators.rules import (
    Chain,
    find_issues,
    license_rule,
    pattern_rule,
    result_rule,
    risk_rule,
)
from ..operators.validate import (
    BATCH,
    ROW,
    accepted,
    duplicate_gate,
    error_count,
    has_error,
    identifier_issues,
    issues,
    validate,
    warning_count,
)
from ..plans.contract import Roles, identifier_chain, row_chains
from ..plans.durable import durable, scratch_path
from ..plans.incremental import multi_batch_summary, pending_batches, skipped_batches
from ..plans.run import run_report
from ..plans.session import prepare
from ..sources.batches import batch_year_ranges, content_fingerprint
from ..sources.csv_batches import batch_row_counts, header_conformance
from ..sources.publish import (
    QUARANTINE_PARTITION,
    guard_report,
    partition_guards,
    publish,
    severity_guards,
)
from ..sources.state import STATE, read_state, write_state
from .files import FILE_QUERIES
from .raw_orders import COLUMNS, CONTRACT, ROLES, raw_orders

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate(raw_orders(spark, sf_dir), CONTRACT, roles=ROLES)


# Row rules ------------------------------------------------------------------------


def _of_rules(found: DataFrame, rule_ids: tuple[str, ...]) -> DataFrame:
    return found.where(F.col("rule_id").isin(*rule_ids)) if rule_ids else found


def _identifier_rule(rule_id: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = raw_orders(spark, sf_dir)
        found = find_issues(rows, [identifier_chain(CONTRACT)], [BATCH, ROW, "record_id"])
        return _of_rules(found, (rule_id,))

    return query


def _row_rule(roles: Roles, *rule_ids: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = raw_orders(spark, sf_dir)
        found = find_issues(rows, row_chains(CONTRACT, roles), [BATCH, ROW, "record_id"])
        return _of_rules(found, rule_ids)

    return query


def _only(**roles: object) -> Roles:
    none = dict.fromkeys(("date", "result", "license", "risk", "latitude", "longitude"))
    return Roles(**{**none, "patterns": (), **roles})


def rule_id_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = identifier_issues(raw_orders(spark, sf_dir), CONTRACT)
    return _of_rules(found, ("inspection_id_unique",))


def _table_rule(name: str, key: str, chain: Callable[[], Chain]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return find_issues(table(spark, sf_dir, name), [chain()], [key])

    return query


def _required_rule(chain: Callable[[], Chain]) -> Query:
    """A rule of columns that the contract lets be blank, as if it did not."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return find_issues(raw_orders(spark, sf_dir), [chain()], [BATCH, ROW, "record_id"])

    return query


def key_clashes_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return key_clashes(table(spark, sf_dir, "lineitem"), keys=["l_orderkey", "l_linenumber"])


# Whole-batch rules ----------------------------------------------------------------


def exact_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return find_exact_duplicates(documents, key="doc_id", columns=["doc_id", "text"])


def exact_duplicates_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumn(
        BATCH, F.year("o_orderdate").cast("smallint")
    )
    columns = ["o_orderkey", "o_custkey", "o_orderdate"]
    return find_exact_duplicates(orders, key="o_orderkey", columns=columns, batch=BATCH)


def exact_duplicate_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = issues(validated(spark, sf_dir), CONTRACT)
    return _of_rules(found, ("exact_duplicate_record",))


def all_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return issues(validated(spark, sf_dir), CONTRACT)


def issues_by_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = validated(spark, sf_dir).select(
        BATCH,
        ROW,
        error_count().alias("errors"),
        warning_count().alias("warnings"),
        has_error().alias("has_errors"),
    )
    return rows.where((F.col("errors") > 0) | (F.col("warnings") > 0))


def gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_gate(raw_orders(spark, sf_dir), CONTRACT)


# Outputs --------------------------------------------------------------------------


def accepted_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return accepted(validated(spark, sf_dir)).select(BATCH, ROW, "record_id")


def quarantine_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quarantine(validated(spark, sf_dir), CONTRACT)


def curated_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curate(accepted(validated(spark, sf_dir)), CONTRACT)


def required_blank_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows, not only accepted ones, so that there is something to count."""
    return conversion_failures(raw_orders(spark, sf_dir), CONTRACT)


def _summary_rows(checked: DataFrame) -> dict:
    return {row[BATCH]: row for row in batch_summary(checked).collect()}  # one row per batch


def publish_curated_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked, root = validated(spark, sf_dir), scratch_path(spark, "curated")
    summary = _summary_rows(checked)
    rows = curate(accepted(checked), CONTRACT, keep=(ROW,))
    publish(
        rows,
        root,
        partition=CURATED_PARTITION,
        years=sorted(summary),
        expected_rows={year: row.accepted_rows for year, row in summary.items()},
        order=[ROW],
        drop=[ROW],
    )
    return spark.read.schema(rows.drop(ROW).schema).parquet(root)


def publish_quarantine_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked, root = validated(spark, sf_dir), scratch_path(spark, "quarantine")
    summary = _summary_rows(checked)
    rows = quarantine(checked, CONTRACT)
    publish(
        rows,
        root,
        partition=QUARANTINE_PARTITION,
        years=sorted(summary),
        expected_rows={year: row.error_issues for year, row in summary.items()},
        order=["dq_source_row_number", "dq_rule_id", "dq_column"],
        rebalance=True,
    )
    return spark.read.schema(rows.schema).parquet(root)


# Counts ---------------------------------------------------------------------------


def summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batch_summary(validated(spark, sf_dir))


def reconciled(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = validated(spark, sf_dir)
    curated = curate(accepted(checked), CONTRACT, keep=(BATCH,))
    held = quarantine(checked, CONTRACT).withColumnRenamed("dq_batch_year", BATCH)
    return reconciliation(batch_summary(checked), curated, held)


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return issue_metrics(validated(spark, sf_dir))


# Sources --------------------------------------------------------------------------


def schema_conformance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keys of each event's properties, as a header; some event types add or reorder."""
    keys = F.json_object_keys("props")
    header = (
        F.when(F.col("event_type") == "signup", F.concat(keys, F.array(F.lit("K"))))
        .when(F.col("event_type") == "view", F.concat(F.array(F.lit("event")), keys))
        .otherwise(F.concat(keys, F.array(F.lit("event"))))
    )
    headers = table(spark, sf_dir, "events").select("event_type", header.alias("header"))
    checked = header_conformance(headers, "header", ["k", "event"], keep=["event_type"])
    return checked.groupBy(
        "event_type",
        "conforms",
        F.array_join("missing", ",").alias("missing"),
        F.array_join("unexpected", ",").alias("unexpected"),
    ).agg(F.count(F.lit(1)).alias("row_count"))


def row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every year with orders and the year after it must have data rows."""
    rows = raw_orders(spark, sf_dir)
    listed = rows.select(F.explode(F.array(BATCH, (F.col(BATCH) + 1).cast("smallint"))).alias(BATCH))
    return batch_row_counts(rows, listed.distinct())


def year_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    year = F.year("o_orderdate").cast("string")
    name = F.concat(
        F.lit("food_inspections_"),
        F.when(F.col("o_orderkey") % 17 == 0, F.substring(year, 1, 3)).otherwise(year),
        F.when(F.col("o_orderkey") % 19 == 0, F.lit(".CSV")).otherwise(F.lit(".csv")),
    )
    names = table(spark, sf_dir, "orders").select(name.alias("file_name"))
    ranged = batch_year_ranges(names, "file_name", start_year=1996, end_year=2000)
    return ranged.groupBy("file_name", BATCH, "accepted").agg(
        F.count(F.lit(1)).alias("row_count")
    )


def fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content_fingerprint(raw_orders(spark, sf_dir), [ROW, *COLUMNS], batch=BATCH)


def partition_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    year = F.nullif(F.substring("event_date", 1, 4), F.lit(""))
    rows = raw_orders(spark, sf_dir).select(BATCH, year.alias("partition_year"))
    guards = partition_guards("partition_year", F.col(BATCH))
    return guard_report(rows, guards, by=[BATCH])


def severity_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = all_issues(spark, sf_dir)
    severity = F.when(F.col("rule_id") != "risk_missing", F.col("severity"))
    rows = found.select(BATCH, severity.alias("dq_severity"))
    return guard_report(rows, severity_guards(), by=[BATCH])


def source_row_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = raw_orders(spark, sf_dir).select(BATCH, F.col(ROW).alias("seq"), "record_id")
    return number_rows(rows, batch=BATCH, order=["seq"])


# State ----------------------------------------------------------------------------


def _batch_files(rows: DataFrame) -> DataFrame:
    """Every batch as if it were a file, with sizes and checksums taken from its content."""
    facts = content_fingerprint(rows, [ROW, *COLUMNS], batch=BATCH)
    return facts.select(
        BATCH,
        F.concat(F.lit("orders/"), BATCH).alias("path"),
        (F.col("row_count") * 100).alias("size_bytes"),
        F.lit("md5-sum").alias("checksum_algorithm"),
        "checksum",
    )


def _state_of(files: DataFrame, counts: DataFrame) -> DataFrame:
    joined = files.join(counts, BATCH)
    fields = {
        "schema_version": F.lit(1),
        "dataset": F.lit("raw_orders"),
        "batch_year": F.col(BATCH),
        "completed_at_utc": F.lit("2024-01-01T00:00:00Z"),
        "source_path": F.col("path"),
        "source_size_bytes": F.col("size_bytes"),
        "checksum_algorithm": F.upper("checksum_algorithm"),
        "checksum": F.col("checksum"),
        "raw_row_count": F.col("raw_rows"),
        "accepted_row_count": F.col("accepted_rows"),
        "rejected_record_count": F.col("rejected_rows"),
        "quarantine_issue_count": F.col("error_issues"),
        "error_count": F.col("error_issues"),
        "warning_count": F.col("warning_issues"),
    }
    for kind, count in (("curated", "accepted_rows"), ("quarantine", "error_issues")):
        fields[f"{kind}_path"] = F.concat(F.lit(f"{kind}/"), BATCH)
        fields[f"{kind}_row_count"] = F.col(count)
        fields[f"{kind}_size_bytes"] = F.col(count) * 10
        fields[f"{kind}_compression"] = F.lit("snappy")
    return joined.select(*[fields[f.name].cast(f.dataType).alias(f.name) for f in STATE.fields])


def _incremental(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Batches now, the state of an earlier run, and the outputs that are still there.

    Since that run the names of 1998 have been changed, 1999 has lost its curated
    output, the quarantine output of 2000 has changed its size, and 2001 is new.
    """
    rows = raw_orders(spark, sf_dir)
    year = F.col(BATCH)
    old_name = F.when(year == 1998, F.upper("name")).otherwise(F.col("name"))
    earlier = rows.where(year < 2001).withColumn("name", old_name)
    now, _ = durable(_batch_files(rows))
    then = validate(earlier, CONTRACT, roles=ROLES)
    state, _ = durable(_state_of(_batch_files(earlier), batch_summary(then)))
    sizes = F.array(
        F.struct(
            F.col("curated_path").alias("path"), F.col("curated_size_bytes").alias("size_bytes")
        ),
        F.struct(
            F.col("quarantine_path").alias("path"),
            (F.col("quarantine_size_bytes") + F.when(year == 2000, 1).otherwise(0)).alias(
                "size_bytes"
            ),
        ),
    )
    outputs = state.select(F.inline(sizes)).where(F.col("path") != "curated/1999")
    return now, state, outputs


def incremental_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pending_batches(*_incremental(spark, sf_dir))


def incremental_skipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return skipped_batches(*_incremental(spark, sf_dir))


def multi_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_batch_summary(*_incremental(spark, sf_dir))


def batch_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the state of all batches, then again that of some with another checksum."""
    rows = raw_orders(spark, sf_dir)
    checked = validate(rows, CONTRACT, roles=ROLES)
    records, _ = durable(_state_of(_batch_files(rows), batch_summary(checked)))
    root = scratch_path(spark, "state")
    write_state(records, root)
    changed = records.where(F.col(BATCH) >= 2000)
    write_state(changed.withColumn("checksum", F.concat(F.lit("x"), "checksum")), root)
    return read_state(spark, root, dataset="raw_orders")


def report(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = raw_orders(spark, sf_dir)
    checked = validate(rows, CONTRACT, roles=ROLES)
    files, _ = durable(_batch_files(rows))
    counts, _ = durable(batch_summary(checked))
    processed = counts.where(F.col(BATCH) >= 1998).select(BATCH, "duplicate_detection_skipped")
    return run_report(files, _state_of(files, counts), processed)


# Scalar functions -----------------------------------------------------------------


def scalar_cleaning(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts, padded with several kinds of whitespace."""
    padded = F.concat(F.lit(" \t\u00a0 \x1c"), "text", F.lit("\u2003\n "))
    texts = table(spark, sf_dir, "documents").select("doc_id", "source", padded.alias("padded"))
    both = clean("padded", ["trim_whitespace", "collapse_internal_whitespace"])
    return texts.selectExpr(
        "doc_id",
        f"md5({strip('padded')}) AS stripped",
        f"md5({collapse('padded')}) AS collapsed",
        f"md5({both}) AS cleaned",
        f"{clean('source', ['uppercase'])} AS source_upper",
        f"{is_blank('padded')} AS blank",
    )


def scalar_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers and dates of order lines, written as text and read back."""
    texts = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey",
        "cast(l_linenumber AS string) AS line",
        "CASE WHEN l_partkey % 7 = 0 THEN '1d' ELSE concat(' ', l_partkey) END AS part",
        "cast(l_suppkey % 4 AS string) AS remainder",
        "CASE WHEN l_suppkey % 5 = 0 THEN '1f' ELSE concat(l_discount, ' ') END AS rate",
        "CASE WHEN l_suppkey % 3 = 0 THEN date_format(l_shipdate, 'dd/MM/yyyy') "
        "ELSE date_format(l_shipdate, 'yyyy-MM-dd') END AS shipped",
    )
    return texts.selectExpr(
        "l_orderkey",
        f"{to_bigint('line')} AS line_number",
        f"{to_bigint('part')} AS part_key",
        f"nullif({to_bigint('remainder')}, 0L) AS sentinel",
        f"{to_double('rate')} AS discount",
        f"{to_date('shipped', ['%Y-%m-%d', '%d/%m/%Y'])} AS ship_date",
        f"year({to_date('shipped', ['%Y-%m-%d'])}) AS iso_year",
    )


QUERIES: dict[str, Query] = {
    "rule_id_required": _identifier_rule("inspection_id_required"),
    "rule_id_format": _identifier_rule("inspection_id_format"),
    "rule_id_int64": _identifier_rule("inspection_id_int64"),
    "rule_id_minimum": _identifier_rule("inspection_id_minimum"),
    "rule_id_unique": rule_id_unique,
    "rule_date_required": _row_rule(_only(date="event_date"), "inspection_date_required"),
    "rule_date_format": _row_rule(_only(date="event_date"), "inspection_date_format"),
    "rule_year_matches_batch": _row_rule(
        _only(date="event_date"), "inspection_year_matches_filename"
    ),
    "rule_domain_required": _row_rule(_only(result="result"), "inspection_result_required"),
    "rule_domain_allowed": _row_rule(_only(result="result"), "inspection_result_allowed_values"),
    "rule_pair_consistency": _row_rule(
        _only(latitude="latitude", longitude="longitude"), "coordinate_pair_consistency"
    ),
    "rule_coord_numeric": _row_rule(
        _only(latitude="latitude", longitude="longitude"), "latitude_numeric", "longitude_numeric"
    ),
    "rule_coord_range": _row_rule(
        _only(latitude="latitude", longitude="longitude"), "latitude_range", "longitude_range"
    ),
    "rule_pattern_state": _row_rule(_only(patterns=("state",))),
    "rule_pattern_zip": _row_rule(_only(patterns=("zip",))),
    "rule_license": _row_rule(_only(license="license")),
    "rule_risk": _row_rule(_only(risk="risk")),
    "rule_domain_events": _table_rule(
        "events", "event_id", lambda: result_rule("event_type", ["click", "view", "purchase"])
    ),
    "rule_risk_segments": _table_rule(
        "customer", "c_custkey", lambda: risk_rule("c_mktsegment", ["BUILDING", "MACHINERY"])
    ),
    "rule_pattern_pages": _table_rule(
        "pages",
        "page_id",
        lambda: pattern_rule("url", r"^https?://[a-z.]+/(?:fr|de)/[0-9]+(?:\?.*)?$", False),
    ),
    "rule_required_state": _required_rule(lambda: pattern_rule("state", "^[A-Z]{2}$", False)),
    "rule_required_zip": _required_rule(lambda: pattern_rule("zip", "^[0-9]{5}$", False)),
    "rule_required_license": _required_rule(lambda: license_rule("license", False)),
    "key_clashes_lineitem": key_clashes_lineitem,
    "exact_duplicates": exact_duplicates,
    "exact_duplicates_orders": exact_duplicates_orders,
    "exact_duplicate_issues": exact_duplicate_issues,
    "all_issues": all_issues,
    "issues_by_severity": issues_by_severity,
    "duplicate_gate": gate,
    "accepted_rows": accepted_rows,
    "quarantine_rows": quarantine_rows,
    "curated_projection": curated_projection,
    "required_blank_counts": required_blank_counts,
    "publish_curated_roundtrip": publish_curated_roundtrip,
    "publish_quarantine_roundtrip": publish_quarantine_roundtrip,
    "batch_summary": summary,
    "reconciliation": reconciled,
    "issue_metrics": metrics,
    "schema_conformance": schema_conformance,
    "batch_row_counts": row_counts,
    "batch_year_range": year_range,
    "batch_fingerprint": fingerprint,
    "partition_guard": partition_guard,
    "severity_guard": severity_guard,
    "source_row_numbers": source_row_numbers,
    "incremental_pending": incremental_pending,
    "incremental_skipped": incremental_skipped,
    "multi_batch_summary": multi_batch,
    "batch_state": batch_state,
    "run_report": report,
    "scalar_cleaning": scalar_cleaning,
    "scalar_casts": scalar_casts,
    **FILE_QUERIES,
}


def issues_by_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocking issues by rule: raw text to validated rows to quarantine to counts."""
    return (
        quarantine(validated(spark, sf_dir), CONTRACT)
        .groupBy("dq_rule_id")
        .agg(F.count(F.lit(1)).alias("issue_count"))
        .orderBy("dq_rule_id")
    )
