import copy
import datetime

import pytest
from helpers import batch, record

from sievemark import INSPECTIONS, conversion_failures, curate

TARGETS = {
    "inspection_id": "bigint",
    "dba_name": "string",
    "aka_name": "string",
    "license_number": "bigint",
    "facility_type": "string",
    "risk": "string",
    "address": "string",
    "city": "string",
    "state": "string",
    "zip_code": "string",
    "inspection_date": "date",
    "inspection_type": "string",
    "inspection_result": "string",
    "violations": "string",
    "latitude": "double",
    "longitude": "double",
    "inspection_year": "smallint",
}


def test_columns_and_types(spark):
    curated = curate(batch(spark, [record(1)]), INSPECTIONS)
    assert dict(curated.dtypes) == TARGETS
    assert curated.columns == list(TARGETS)


def test_cleaning_and_nulls(spark):
    raw = record(
        "0012",
        dba_name="  The \t Corner\n Cafe ",
        city=" new  york ",
        state=" il",
        zip=" 60601 ",
        aka_name="  ",
        risk="",
        license_="000",
        latitude="",
        longitude=" -87.5 ",
        violations=" a  b ",
        facility_type=None,
    )
    row = curate(batch(spark, [raw]), INSPECTIONS).first()
    assert row.inspection_id == 12
    assert row.dba_name == "The Corner Cafe"
    assert (row.city, row.state, row.zip_code) == ("NEW YORK", "IL", "60601")
    assert (row.aka_name, row.risk, row.license_number, row.latitude) == (None,) * 4
    assert row.facility_type is None
    assert row.longitude == -87.5
    assert row.violations == "a  b"
    assert row.inspection_date == datetime.date(2019, 5, 1)
    assert row.inspection_year == 2019


def test_conversion_failures_name_the_column(spark):
    rows = [
        record(1, dba_name=" "),
        record(2, address=""),
        record(3, license_="99999999999999999999"),
        record(4, inspection_date="2019-02-30T00:00:00.000"),
        record(5, latitude="north"),
        record(6),
    ]
    report = conversion_failures(batch(spark, rows), INSPECTIONS)
    found = {
        row.source_column: (row.blank_rows, row.invalid_rows)
        for row in report.where("blank_rows + invalid_rows > 0").collect()
    }
    assert found == {
        "dba_name": (1, 0),
        "address": (1, 0),
        "license_": (0, 1),
        "inspection_date": (0, 1),
        "latitude": (0, 1),
    }


@pytest.mark.parametrize(
    ("column", "change", "problem"),
    [
        ("city", {"target_type": "decimal"}, "unsupported target type"),
        ("city", {"target_name": "state"}, "repeat"),
        ("city", {"target_name": "inspection_year"}, "must not use"),
        ("city", {"cleaning": "uppercase"}, "sequence"),
        ("city", {"cleaning": ["reverse"]}, "unsupported cleaning"),
        ("license_", {"cleaning": ["zero_as_null"]}, "mapping"),
        ("license_", {"cleaning": {"zero_as_null": "yes"}}, "boolean"),
        ("inspection_date", {"accepted_formats": []}, "no accepted date format"),
    ],
)
def test_unsound_settings(spark, column, change, problem):
    contract = copy.deepcopy(INSPECTIONS)
    contract["columns"][column].update(change)
    with pytest.raises(ValueError, match=problem):
        curate(batch(spark, [record(1)]), contract)
