"""All rules of a contract over all batches at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..plans.contract import (
    Contract,
    Roles,
    check_contract,
    duplicate_severity,
    identifier_chain,
    primary_key,
    row_chains,
    source_columns,
)
from .conflicts import CLASH, GATED, KEPT, Conflicts, attach_conflicts, find_conflicts
from .rules import Chain, duplicate_rule, explode_issues, issues_column, with_helpers
from .wording import ERROR, EXACT_DUPLICATE, WARNING

BATCH = "batch_year"
ROW = "source_row_number"


def batch_conflicts(df: DataFrame, contract: Contract, *, batch: str = BATCH) -> Conflicts:
    """Identifier clashes, unsound identifiers and duplicate groups per batch."""
    key = primary_key(contract)
    names = source_columns(contract)
    compared = [name for name in names if name != key]
    rows = with_helpers(df.select(batch, *names), [identifier_chain(contract)])
    minimum = contract["columns"][key]["validations"]["minimum"]
    return find_conflicts(rows, compared=compared, batch=batch, minimum=minimum)


def annotate(
    df: DataFrame,
    contract: Contract,
    conflicts: Conflicts,
    *,
    batch: str = BATCH,
    row: str = ROW,
    roles: Roles = Roles(),
    extra: Sequence[Chain] = (),
) -> DataFrame:
    """``df`` plus ``issues``, ``duplicate_of`` and ``duplicate_detection_skipped``."""
    key = primary_key(contract)
    chains = [
        identifier_chain(contract, CLASH),
        *row_chains(contract, roles, batch),
        duplicate_rule(key, KEPT, duplicate_severity(contract)),
        *extra,
    ]
    rows = attach_conflicts(with_helpers(df, chains), conflicts, row)
    return rows.select(
        *df.columns,
        issues_column(chains).alias("issues"),
        F.col(KEPT).alias("duplicate_of"),
        F.col(GATED).alias("duplicate_detection_skipped"),
    )


def validate(
    df: DataFrame,
    contract: Contract,
    *,
    batch: str = BATCH,
    row: str = ROW,
    roles: Roles = Roles(),
    extra: Sequence[Chain] = (),
) -> DataFrame:
    """Evaluate every rule of the contract; the result has one row per input row."""
    check_contract(contract)
    conflicts = batch_conflicts(df, contract, batch=batch)
    return annotate(df, contract, conflicts, batch=batch, row=row, roles=roles, extra=extra)


def identifier_issues(
    df: DataFrame, contract: Contract, *, batch: str = BATCH, row: str = ROW
) -> DataFrame:
    """Issues of the identifier alone; reads no other source column."""
    key, chain = primary_key(contract), identifier_chain(contract)
    minimum = contract["columns"][key]["validations"]["minimum"]
    names = [batch, row, key]
    rows = with_helpers(df.select(*names), [chain])
    conflicts = find_conflicts(rows, compared=(), batch=batch, minimum=minimum)
    attached = attach_conflicts(rows, conflicts, row)
    full = identifier_chain(contract, CLASH)
    found = attached.select(*names, issues_column([full]).alias("issues"))
    return explode_issues(found, names)


def duplicate_gate(df: DataFrame, contract: Contract, *, batch: str = BATCH) -> DataFrame:
    """Per batch: is duplicate detection skipped because an identifier is not sound."""
    key, chain = primary_key(contract), identifier_chain(contract)
    minimum = contract["columns"][key]["validations"]["minimum"]
    rows = with_helpers(df.select(batch, key), [chain])
    conflicts = find_conflicts(rows, compared=(), batch=batch, minimum=minimum)
    flags = conflicts.gated.withColumn(GATED, F.lit(True))
    return (
        df.select(batch)
        .distinct()
        .join(F.broadcast(flags), batch, "left")
        .select(batch, F.coalesce(GATED, F.lit(False)).alias("duplicate_detection_skipped"))
    )


def has_error() -> F.Column:
    """The row has a blocking issue (warnings do not block)."""
    return F.array_contains("issues.severity", ERROR)


def error_count() -> F.Column:
    return F.size(F.array_remove("issues.severity", WARNING))


def warning_count() -> F.Column:
    return F.size(F.array_remove("issues.severity", ERROR))


def issues(
    validated: DataFrame,
    contract: Contract,
    *,
    batch: str = BATCH,
    row: str = ROW,
    severity: str | None = None,
) -> DataFrame:
    """One row per issue, optionally of one severity only."""
    key = primary_key(contract)
    # An exact duplicate is reported under its canonical number, other issues under the raw text.
    exploded = explode_issues(validated, [batch, row, key], severity)
    is_copy = F.col("rule_id") == EXACT_DUPLICATE
    raw = F.coalesce(key, F.lit(""))
    return exploded.select(
        batch,
        F.col(row).alias(ROW),
        F.when(is_copy, F.col("value")).otherwise(raw).alias("record_id"),
        "rule_id",
        "column",
        "value",
        "message",
        "severity",
    )


def accepted(validated: DataFrame) -> DataFrame:
    """Rows without a blocking issue. A filter on the row itself: identifiers may repeat."""
    return validated.where(~has_error())
