"""The data contract: a plain mapping, read through a few accessors.

Sections: ``contract`` (name, primary_key), ``source_schema.expected_columns``,
``columns`` (one entry per source column), ``record_rules``.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any

from ..operators.rules import (
    Chain,
    coordinate_rules,
    date_rule,
    identifier_rule,
    license_rule,
    pattern_rule,
    result_rule,
    risk_rule,
)
from ..operators.wording import EXACT_DUPLICATE

Contract = Mapping[str, Any]


@dataclass(frozen=True)
class Roles:
    """Which source column each rule applies to; ``None`` leaves a rule out."""

    date: str | None = "inspection_date"
    result: str | None = "results"
    license: str | None = "license_"
    risk: str | None = "risk"
    latitude: str | None = "latitude"
    longitude: str | None = "longitude"
    patterns: tuple[str, ...] = ("state", "zip")


def primary_key(contract: Contract) -> str:
    return contract["contract"]["primary_key"]


def source_columns(contract: Contract) -> list[str]:
    return list(contract["source_schema"]["expected_columns"])


def duplicate_severity(contract: Contract) -> str:
    for rule in contract["record_rules"]:
        if rule["id"] == EXACT_DUPLICATE:
            return rule["severity"]
    raise ValueError(f"contract has no record rule {EXACT_DUPLICATE}")


def check_contract(contract: Contract) -> None:
    """The parts every operator relies on are there and agree."""
    columns, key = source_columns(contract), primary_key(contract)
    if not columns or len(columns) != len(set(columns)):
        raise ValueError("expected_columns must be a non-empty list without repeats")
    undescribed = [name for name in columns if name not in contract["columns"]]
    if undescribed:
        raise ValueError(f"contract does not describe columns {undescribed}")
    if key not in columns:
        raise ValueError(f"primary key {key} is not a source column")


def identifier_chain(contract: Contract, clash: str | None = None) -> Chain:
    key = primary_key(contract)
    return identifier_rule(key, contract["columns"][key]["validations"]["minimum"], clash)


def row_chains(contract: Contract, roles: Roles = Roles(), batch: str = "batch_year") -> list[Chain]:
    """Every rule that looks at one row, except the identifier's."""
    columns = contract["columns"]
    chains: list[Chain] = []
    if roles.date:
        chains.append(date_rule(roles.date, columns[roles.date]["accepted_formats"], batch))
    if roles.result:
        chains.append(result_rule(roles.result, columns[roles.result]["allowed_values"]))
    if roles.latitude and roles.longitude:
        bounds = [
            (columns[name]["validations"]["minimum"], columns[name]["validations"]["maximum"])
            for name in (roles.latitude, roles.longitude)
        ]
        chains.extend(coordinate_rules(roles.latitude, roles.longitude, *bounds))
    for name in roles.patterns:
        entry = columns[name]
        chains.append(pattern_rule(name, entry["validations"]["pattern"], entry["nullable"]))
    if roles.license:
        entry = columns[roles.license]
        chains.append(
            license_rule(
                roles.license,
                entry["nullable"],
                entry["cleaning"]["zero_as_null"],
                entry["validations"]["format_when_present"],
            )
        )
    if roles.risk:
        entry = columns[roles.risk]
        severity = entry["unknown_value_severity"]
        chains.append(risk_rule(roles.risk, entry["allowed_values"], severity))
    return chains
