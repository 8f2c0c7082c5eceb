"""Curated rows: accepted records, cleaned, cast, renamed and ordered by the contract."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions import (
    clean,
    is_blank,
    null_if_blank,
    parse_bigint,
    parse_double,
    strip,
    to_date,
)
from ..functions.sql import name as ref, text
from ..plans.contract import Contract, source_columns
from .validate import BATCH

CURATED_PARTITION = "inspection_year"


def _cleaning_steps(name: str, entry: Mapping) -> list[str]:
    steps = entry.get("cleaning") or []
    if isinstance(steps, (str, bytes, Mapping)):
        raise ValueError(f"string cleaning must be a sequence: {name}")
    return list(steps)


def _zero_as_null(name: str, entry: Mapping) -> bool:
    settings = entry.get("cleaning") or {}
    if not isinstance(settings, Mapping):
        raise ValueError(f"numeric cleaning must be a mapping: {name}")
    flag = settings.get("zero_as_null", False)
    if not isinstance(flag, bool):
        raise ValueError(f"zero_as_null must be boolean: {name}")
    return flag


def _prepared(name: str, entry: Mapping) -> str:
    """The raw value made ready for its target: strings cleaned, numbers stripped."""
    if entry["target_type"] == "string":
        return clean(ref(name), _cleaning_steps(name, entry))
    return ref(name) if entry["target_type"] == "date" else strip(ref(name))


def _text(name: str, entry: Mapping) -> str:
    return null_if_blank(ref(name)) if entry["nullable"] else ref(name)


def _integer(name: str, entry: Mapping) -> str:
    return parse_bigint(ref(name))


def _nullable_integer(name: str, entry: Mapping) -> str:
    number = _integer(name, entry)
    return f"nullif({number}, 0L)" if _zero_as_null(name, entry) else number


def _float(name: str, entry: Mapping) -> str:
    return parse_double(ref(name))


def _date(name: str, entry: Mapping) -> str:
    if not entry["accepted_formats"]:
        raise ValueError(f"no accepted date format: {name}")
    return to_date(ref(name), entry["accepted_formats"])


# Target expressions over the prepared values.
_TARGETS = {
    "string": _text,
    "int64": _integer,
    "Int64": _nullable_integer,
    "float64": _float,
    "date": _date,
}
_CONVERTED = {"int64": _integer, "Int64": _integer, "float64": _float, "date": _date}


def _published(contract: Contract) -> list[tuple[str, Mapping]]:
    chosen = [
        (name, contract["columns"][name])
        for name in source_columns(contract)
        if contract["columns"][name].get("publish", True) is not False
    ]
    targets = [entry["target_name"] for _, entry in chosen]
    if CURATED_PARTITION in targets:
        raise ValueError(f"target names must not use {CURATED_PARTITION}")
    repeated = sorted({name for name in targets if targets.count(name) > 1})
    if repeated:
        raise ValueError(f"target names repeat: {repeated}")
    for name, entry in chosen:
        if entry["target_type"] not in _TARGETS:
            raise ValueError(f"unsupported target type for {name}: {entry['target_type']}")
    return chosen


def _prepare(rows: DataFrame, contract: Contract, keep: Sequence[str]) -> DataFrame:
    """A projection of its own, so that prepared values are computed once per row."""
    prepared = [f"{_prepared(name, e)} AS {ref(name)}" for name, e in _published(contract)]
    return rows.selectExpr(*[ref(name) for name in keep], *prepared)


def curate(
    rows: DataFrame, contract: Contract, *, batch: str = BATCH, keep: Sequence[str] = ()
) -> DataFrame:
    """Typed target columns plus the year partition; ``keep`` passes columns through.

    A value that cannot be converted gives null here. ``conversion_failures`` finds
    those beforehand, and nothing is published for a batch that has any.
    """
    carried = list(dict.fromkeys([batch, *keep]))
    targets = [
        f"{_TARGETS[entry['target_type']](name, entry)} AS {ref(entry['target_name'])}"
        for name, entry in _published(contract)
    ]
    year = f"cast({ref(batch)} AS smallint) AS {ref(CURATED_PARTITION)}"
    prepared = _prepare(rows, contract, carried)
    return prepared.selectExpr(*[ref(name) for name in keep], *targets, year)


def failure_flags(contract: Contract) -> dict[str, dict[str, str]]:
    """Per source column, over prepared values: blank though required, present but unconvertible."""
    flags: dict[str, dict[str, str]] = {}
    for name, entry in _published(contract):
        kind, blank = entry["target_type"], is_blank(ref(name))
        found = {} if entry["nullable"] else {"blank": blank}
        if kind in _CONVERTED:
            found["invalid"] = f"{_CONVERTED[kind](name, entry)} IS NULL AND NOT {blank}"
        if found:
            flags[name] = found
    return flags


def conversion_failures(rows: DataFrame, contract: Contract, *, batch: str = BATCH) -> DataFrame:
    """Per batch and source column: rows that cannot be published, in one aggregate."""
    flags = failure_flags(contract)
    counts = (
        _prepare(rows, contract, [batch])
        .groupBy(batch)
        .agg(
            *[
                F.expr(f"count_if({flag})").alias(f"{name}:{kind}")
                for name, kinds in flags.items()
                for kind, flag in kinds.items()
            ]
        )
    )

    def count(name: str, kind: str) -> str:
        return ref(f"{name}:{kind}") if kind in flags[name] else "0L"

    report = ", ".join(
        f"named_struct('source_column', {text(name)}, 'blank_rows', {count(name, 'blank')}, "
        f"'invalid_rows', {count(name, 'invalid')})"
        for name in flags
    )
    return counts.select(batch, F.expr(f"inline(array({report}))"))
