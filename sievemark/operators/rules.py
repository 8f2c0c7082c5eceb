"""Row rules as SQL expressions.

A rule is a chain of checks; the first failing check of a chain gives the issue
and chains do not affect one another. A chain compiles to one ``CASE WHEN`` whose
value is an array of zero or one issue, so any number of chains is one projection.
Values a chain needs more than once (a parsed date, say) are its ``helpers``.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import (
    as_text,
    full_match,
    is_blank,
    is_digits,
    is_finite,
    quoted,
    to_date,
    to_double,
)
from ..functions.sql import name as ref, text
from .wording import ERROR, EXACT_DUPLICATE, SEVERITIES, WARNING, message

ISSUE = "struct<rule_id:string,column:string,value:string,message:string,severity:string>"

ID_HELPER = "__identifier"


@dataclass(frozen=True)
class Check:
    """One way to fail: the condition and the issue it gives.

    ``failed``, ``value`` and ``message`` are SQL expressions over the row.
    """

    rule_id: str
    failed: str
    column: str
    value: str
    message: str
    severity: str = ERROR

    def sql(self) -> str:
        return (
            f"WHEN {self.failed} THEN array(named_struct('rule_id', {text(self.rule_id)}, "
            f"'column', {text(self.column)}, 'value', {self.value}, 'message', {self.message}, "
            f"'severity', {text(self.severity)}))"
        )


@dataclass(frozen=True)
class Chain:
    """Checks in order of precedence, and the columns they read."""

    checks: tuple[Check, ...]
    reads: tuple[str, ...]
    helpers: dict[str, str] = field(default_factory=dict)

    def sql(self) -> str:
        whens = " ".join(check.sql() for check in self.checks)
        return f"CASE {whens} ELSE cast(array() AS array<{ISSUE}>) END"


def _need(ok: bool, text: str) -> None:
    if not ok:
        raise ValueError(text)


def _need_name(name: object, what: str) -> None:
    _need(isinstance(name, str) and bool(name.strip()), f"{what} must be a non-empty string")


def _need_domain(values: object, what: str) -> list[str]:
    _need(
        isinstance(values, Sequence) and not isinstance(values, (str, bytes)),
        f"{what} must be a sequence of strings",
    )
    domain = list(values)
    _need(bool(domain), f"{what} must not be empty")
    _need(
        all(isinstance(item, str) and item.strip() for item in domain),
        f"{what} must be non-empty strings",
    )
    _need(len(domain) == len(set(domain)), f"{what} must not repeat a value")
    return domain


def _need_bounds(minimum: object, maximum: object, what: str) -> tuple[float, float]:
    for bound in (minimum, maximum):
        _need(
            isinstance(bound, (int, float)) and not isinstance(bound, bool),
            f"{what} bounds must be numeric",
        )
        _need(math.isfinite(bound), f"{what} bounds must be finite")
    _need(minimum < maximum, f"{what} minimum must be lower than its maximum")
    return float(minimum), float(maximum)


def identifier_rule(column: str, minimum: int = 1, clash: str | None = None) -> Chain:
    """Required, digits only, 64-bit, at least ``minimum``; then unique in its batch.

    ``clash`` tells whether another row of the batch has the same number. It comes
    from ``conflicts``; without it only the checks on the row itself are made.
    """
    _need_name(column, "identifier column")
    _need(
        isinstance(minimum, int) and not isinstance(minimum, bool) and minimum >= 1,
        f"identifier minimum must be a positive integer: {minimum}",
    )
    raw, number = as_text(ref(column)), ref(ID_HELPER)
    failures = {
        "inspection_id_required": is_blank(raw),
        "inspection_id_format": f"{number} IS NULL AND NOT {is_digits(raw)}",
        "inspection_id_int64": f"{number} IS NULL",
        "inspection_id_minimum": f"{number} < {minimum}",
    }
    if clash is not None:
        failures["inspection_id_unique"] = clash
    settings, row = {"minimum": str(minimum)}, {"id": number}
    checks = tuple(
        Check(rule_id, failed, column, raw, message(rule_id, settings=settings, row=row))
        for rule_id, failed in failures.items()
    )
    helper = f"CASE WHEN {is_digits(raw)} THEN try_cast({raw} AS bigint) END"
    return Chain(checks, (column,), {ID_HELPER: helper})


def date_rule(column: str, formats: Sequence[str], batch: str = "batch_year") -> Chain:
    """Required, in an accepted format, and in the year of its batch."""
    _need_name(column, "date column")
    _need(
        isinstance(formats, Sequence)
        and not isinstance(formats, (str, bytes))
        and len(formats) > 0
        and all(isinstance(item, str) and item.strip() for item in formats),
        "accepted date formats must be a sequence of non-empty strings",
    )
    helper = f"__date_{column}"
    raw, day, year = as_text(ref(column)), ref(helper), f"year({ref(helper)})"
    row = {"year": year, "batch": ref(batch)}
    failures = {
        "inspection_date_required": is_blank(raw),
        "inspection_date_format": f"{day} IS NULL",
        "inspection_year_matches_filename": f"{year} <> {ref(batch)}",
    }
    checks = tuple(
        Check(rule_id, failed, column, raw, message(rule_id, row=row))
        for rule_id, failed in failures.items()
    )
    return Chain(checks, (column, batch), {helper: to_date(raw, list(formats))})


def _domain(raw: str, values: list[str]) -> str:
    return f"{raw} NOT IN ({', '.join(text(value) for value in values)})"


def result_rule(column: str, allowed: Sequence[str]) -> Chain:
    """Required, and one of the allowed values exactly as written."""
    _need_name(column, "result column")
    domain = _need_domain(allowed, "allowed results")
    raw = as_text(ref(column))
    failures = {
        "inspection_result_required": is_blank(raw),
        "inspection_result_allowed_values": _domain(raw, domain),
    }
    return Chain(
        tuple(Check(rid, bad, column, raw, message(rid)) for rid, bad in failures.items()),
        (column,),
    )


def risk_rule(column: str, allowed: Sequence[str], severity: str = WARNING) -> Chain:
    """Present, and one of the allowed values; how serious a miss is, is a setting."""
    _need_name(column, "risk column")
    _need(severity in SEVERITIES, "severity must be 'error' or 'warning'")
    domain = _need_domain(allowed, "allowed risks")
    raw, settings = as_text(ref(column)), {"column": column}
    failures = {"risk_missing": is_blank(raw), "risk_unknown": _domain(raw, domain)}
    checks = tuple(
        Check(rule_id, failed, column, raw, message(rule_id, settings=settings), severity)
        for rule_id, failed in failures.items()
    )
    return Chain(checks, (column,))


def pattern_rule(column: str, pattern: str, nullable: bool = True) -> Chain:
    """The whole raw value matches ``pattern``; blanks pass when nullable."""
    _need_name(column, "pattern column")
    _need(isinstance(pattern, str) and bool(pattern), "pattern must be a non-empty string")
    _need(isinstance(nullable, bool), "nullable must be boolean")
    try:
        re.compile(pattern)
    except re.error as error:
        raise ValueError(f"invalid pattern for {column}: {pattern}") from error
    raw = as_text(ref(column))
    failures = {} if nullable else {"{column}_required": is_blank(raw)}
    failures["{column}_pattern"] = f"NOT {full_match(raw, pattern)} AND NOT {is_blank(raw)}"
    checks = tuple(
        Check(
            rule.replace("{column}", column),
            failed,
            column,
            raw,
            message(rule, settings={"column": column}),
        )
        for rule, failed in failures.items()
    )
    return Chain(checks, (column,))


def license_rule(
    column: str,
    nullable: bool = True,
    zero_as_null: bool = True,
    format_when_present: str = "digits",
) -> Chain:
    """Digits when present; all zeros stand for a missing number and give a warning."""
    _need_name(column, "license column")
    _need(isinstance(nullable, bool), "nullable must be boolean")
    _need(isinstance(zero_as_null, bool), "zero_as_null must be boolean")
    _need(format_when_present == "digits", "format_when_present must be 'digits'")
    raw = as_text(ref(column))
    failures = {} if nullable else {"license_required": (is_blank(raw), ERROR)}
    failures["license_digits"] = (f"NOT {is_digits(raw)} AND NOT {is_blank(raw)}", ERROR)
    if zero_as_null:
        zeros = f"startswith({raw}, '0') AND {full_match(raw, '0+')}"
        failures["license_zero_sentinel"] = (zeros, WARNING)
    checks = tuple(
        Check(rid, bad, column, raw, message(rid, settings={"column": column}), severity)
        for rid, (bad, severity) in failures.items()
    )
    return Chain(checks, (column,))


def coordinate_rules(
    latitude: str,
    longitude: str,
    latitude_bounds: tuple[float, float] = (-90, 90),
    longitude_bounds: tuple[float, float] = (-180, 180),
) -> list[Chain]:
    """Both or neither present; each a finite number within its bounds."""
    chains = []
    for column, label, bounds in (
        (latitude, "Latitude", latitude_bounds),
        (longitude, "Longitude", longitude_bounds),
    ):
        _need_name(column, f"{label} column")
        low, high = _need_bounds(*bounds, label)
        helper = f"__number_{column}"
        raw, number = as_text(ref(column)), ref(helper)
        settings = {"name": label, "minimum": f"{low:g}", "maximum": f"{high:g}"}
        failures = {
            "{column}_numeric": f"NOT {is_finite(number)} AND NOT {is_blank(raw)}",
            "{column}_range": f"{number} NOT BETWEEN double('{low!r}') AND double('{high!r}')",
        }
        checks = tuple(
            Check(
                rule.replace("{column}", column),
                failed,
                column,
                raw,
                message(rule, settings=settings),
            )
            for rule, failed in failures.items()
        )
        chains.append(Chain(checks, (column,), {helper: to_double(raw)}))

    first, second = as_text(ref(latitude)), as_text(ref(longitude))
    pair = Check(
        "coordinate_pair_consistency",
        f"{is_blank(first)} <> {is_blank(second)}",
        f"{latitude},{longitude}",
        f"concat({text(latitude + '=')}, {quoted(first)}, "
        f"{text('; ' + longitude + '=')}, {quoted(second)})",
        message("coordinate_pair_consistency"),
    )
    return [Chain((pair,), (latitude, longitude)), *chains]


def duplicate_rule(
    column: str, kept: str, severity: str = ERROR, rule_id: str = EXACT_DUPLICATE
) -> Chain:
    """The row repeats another row that is kept (``kept`` is null when it does not)."""
    _need(severity in SEVERITIES, "severity must be 'error' or 'warning'")
    number = f"cast({ref(ID_HELPER)} AS string)"
    told = message(EXACT_DUPLICATE, settings={"key": column}, row={"kept": kept})
    return Chain((Check(rule_id, f"{kept} IS NOT NULL", column, number, told, severity),), (column,))


def with_helpers(df: DataFrame, chains: Sequence[Chain]) -> DataFrame:
    """Add the helper columns of all chains; fail early on columns that are missing."""
    missing = {column for chain in chains for column in chain.reads} - set(df.columns)
    _need(not missing, f"data is missing columns: {sorted(missing)}")
    helpers = {helper: sql for chain in chains for helper, sql in chain.helpers.items()}
    return df.selectExpr("*", *[f"{sql} AS {ref(helper)}" for helper, sql in helpers.items()])


def issues_column(chains: Sequence[Chain]) -> Column:
    """All issues of a row, ordered by rule, column and value."""
    return F.expr(f"sort_array(concat({', '.join(chain.sql() for chain in chains)}))")


def explode_issues(df: DataFrame, keep: Sequence[str], severity: str | None = None) -> DataFrame:
    """One row per issue: the ``keep`` columns followed by the issue's fields.

    The outer form plus a filter is used because Spark would otherwise infer
    ``size(issues) > 0`` below the generator and build every issue array twice.
    """
    exploded = df.select(*keep, F.inline_outer("issues"))
    wanted = F.col("rule_id").isNotNull() if severity is None else F.col("severity") == severity
    return exploded.where(wanted)


def find_issues(df: DataFrame, chains: Sequence[Chain], keep: Sequence[str]) -> DataFrame:
    """Issues of the given chains only; reads just the columns they need."""
    found = with_helpers(df, chains).select(*keep, issues_column(chains).alias("issues"))
    return explode_issues(found, keep)
