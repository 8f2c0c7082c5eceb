"""The default contract: annual files of food inspections, 17 text columns.

Fixed values: column names, types, domains, patterns and bounds.
"""

from __future__ import annotations

TRIM = "trim_whitespace"
COLLAPSE = "collapse_internal_whitespace"
UPPER = "uppercase"


def _column(target: str, kind: str = "string", nullable: bool = True, **settings) -> dict:
    return {"target_name": target, "target_type": kind, "nullable": nullable, **settings}


INSPECTIONS = {
    "contract": {"name": "food_inspections", "version": "1.0.0", "primary_key": "inspection_id"},
    "source_schema": {
        "expected_columns": [
            "inspection_id",
            "dba_name",
            "aka_name",
            "license_",
            "facility_type",
            "risk",
            "address",
            "city",
            "state",
            "zip",
            "inspection_date",
            "inspection_type",
            "results",
            "violations",
            "latitude",
            "longitude",
            "location",
        ]
    },
    "columns": {
        "inspection_id": _column("inspection_id", "int64", False, validations={"minimum": 1}),
        "dba_name": _column("dba_name", nullable=False, cleaning=[TRIM, COLLAPSE]),
        "aka_name": _column("aka_name", cleaning=[TRIM, COLLAPSE]),
        "license_": _column(
            "license_number",
            "Int64",
            cleaning={"zero_as_null": True},
            validations={"format_when_present": "digits"},
        ),
        "facility_type": _column("facility_type", cleaning=[TRIM, COLLAPSE]),
        "risk": _column(
            "risk",
            allowed_values=["Risk 1 (High)", "Risk 2 (Medium)", "Risk 3 (Low)", "All"],
            unknown_value_severity="warning",
        ),
        "address": _column("address", nullable=False, cleaning=[TRIM, COLLAPSE]),
        "city": _column("city", cleaning=[TRIM, COLLAPSE, UPPER]),
        "state": _column("state", cleaning=[TRIM, UPPER], validations={"pattern": "^[A-Z]{2}$"}),
        "zip": _column("zip_code", cleaning=[TRIM], validations={"pattern": "^[0-9]{5}$"}),
        "inspection_date": _column(
            "inspection_date", "date", False, accepted_formats=["%Y-%m-%dT%H:%M:%S.%f"]
        ),
        "inspection_type": _column("inspection_type", nullable=False, cleaning=[TRIM, COLLAPSE]),
        "results": _column(
            "inspection_result",
            nullable=False,
            allowed_values=[
                "Pass",
                "Pass w/ Conditions",
                "Fail",
                "Out of Business",
                "No Entry",
                "Not Ready",
                "Business Not Located",
            ],
        ),
        "violations": _column("violations", cleaning=[TRIM]),
        "latitude": _column("latitude", "float64", validations={"minimum": -90, "maximum": 90}),
        "longitude": _column("longitude", "float64", validations={"minimum": -180, "maximum": 180}),
        "location": _column("location", publish=False),
    },
    "record_rules": [{"id": "exact_duplicate_record", "severity": "error"}],
}
