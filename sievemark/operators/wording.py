"""Rule ids and messages.

Fixed values: results are compared by these ids and texts, so they must stay as
they are. A name in braces is filled in from the rule's settings or from the row.
"""

from __future__ import annotations

import re

from ..functions.sql import text

ERROR = "error"
WARNING = "warning"
SEVERITIES = (ERROR, WARNING)

EXACT_DUPLICATE = "exact_duplicate_record"

MESSAGES = {
    "inspection_id_required": "Inspection ID is required.",
    "inspection_id_format": "Inspection ID must contain digits only.",
    "inspection_id_int64": "Inspection ID cannot be represented as int64.",
    "inspection_id_minimum": "Inspection ID must be greater than or equal to {minimum}.",
    "inspection_id_unique": "Inspection ID {id} appears more than once in the batch.",
    "inspection_date_required": "Inspection date is required.",
    "inspection_date_format": "Inspection date does not match an accepted format.",
    "inspection_year_matches_filename": "Inspection year {year} does not match batch year {batch}.",
    "inspection_result_required": "Inspection result is required.",
    "inspection_result_allowed_values": "Inspection result is not an allowed value.",
    "coordinate_pair_consistency": "Latitude and longitude must both be present or both be null.",
    "{column}_numeric": "{name} must be a finite number.",
    "{column}_range": "{name} must be between {minimum} and {maximum}.",
    "{column}_required": "{column} is required.",
    "{column}_pattern": "{column} does not match the required pattern.",
    "license_required": "{column} is required.",
    "license_digits": "{column} must contain digits only.",
    "license_zero_sentinel": "{column} uses the zero sentinel and will be normalized to null.",
    "risk_missing": "{column} is missing.",
    "risk_unknown": "{column} is not an allowed risk value.",
    EXACT_DUPLICATE: "Record is an exact duplicate of {key} {kept}.",
}


def message(rule_id: str, *, settings: dict[str, str] = {}, row: dict[str, str] = {}) -> str:
    """The rule's message as SQL; ``settings`` are known now, ``row`` are expressions."""
    template = MESSAGES[rule_id]
    for key, value in settings.items():
        template = template.replace("{" + key + "}", value)
    parts = [part for part in re.split(r"(\{\w+\})", template) if part]
    pieces = [
        f"cast({row[part[1:-1]]} AS string)" if part[1:-1] in row else text(part) for part in parts
    ]
    return pieces[0] if len(pieces) == 1 else f"concat({', '.join(pieces)})"
