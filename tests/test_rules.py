import pytest
from helpers import batch, record

from sievemark import INSPECTIONS
from sievemark.operators.rules import (
    coordinate_rules,
    date_rule,
    find_issues,
    identifier_rule,
    license_rule,
    pattern_rule,
    result_rule,
    risk_rule,
)
from sievemark.operators.validate import identifier_issues


def found(frame, *chains, fields=("rule_id", "value")):
    issues = find_issues(frame, list(chains), ["source_row_number"])
    rows = issues.orderBy("source_row_number", "rule_id").collect()
    return [(row.source_row_number, *[row[name] for name in fields]) for row in rows]


def with_values(spark, name, values, **other):
    records = [record(i + 1, **{name: value, **other}) for i, value in enumerate(values)]
    return batch(spark, records)


def test_identifier_chain(spark):
    values = ["", "12A", "9223372036854775808", "0", "15", " ", None, "000", "9223372036854775807"]
    frame = with_values(spark, "inspection_id", values)
    fields = ("rule_id", "value", "message")
    assert found(frame, identifier_rule("inspection_id"), fields=fields) == [
        (2, "inspection_id_required", "", "Inspection ID is required."),
        (3, "inspection_id_format", "12A", "Inspection ID must contain digits only."),
        (
            4,
            "inspection_id_int64",
            "9223372036854775808",
            "Inspection ID cannot be represented as int64.",
        ),
        (5, "inspection_id_minimum", "0", "Inspection ID must be greater than or equal to 1."),
        (7, "inspection_id_required", " ", "Inspection ID is required."),
        (8, "inspection_id_required", "", "Inspection ID is required."),
        (9, "inspection_id_minimum", "000", "Inspection ID must be greater than or equal to 1."),
    ]


def test_identifier_clash_compares_numbers_and_flags_all(spark):
    frame = with_values(spark, "inspection_id", ["001", "1", "2", "002", "3", "x", "x"])
    issues = identifier_issues(frame, INSPECTIONS).orderBy("source_row_number").collect()
    assert [(row.inspection_id, row.rule_id, row.message) for row in issues] == [
        ("001", "inspection_id_unique", "Inspection ID 1 appears more than once in the batch."),
        ("1", "inspection_id_unique", "Inspection ID 1 appears more than once in the batch."),
        ("2", "inspection_id_unique", "Inspection ID 2 appears more than once in the batch."),
        ("002", "inspection_id_unique", "Inspection ID 2 appears more than once in the batch."),
        ("x", "inspection_id_format", "Inspection ID must contain digits only."),
        ("x", "inspection_id_format", "Inspection ID must contain digits only."),
    ]


def test_identifiers_of_different_batches_do_not_clash(spark):
    frame = batch(spark, [record(1)]).union(batch(spark, [record(1)], year=2020))
    assert identifier_issues(frame, INSPECTIONS).count() == 0


def test_dates(spark):
    values = ["", "not-a-date", "2018-12-31T23:59:59.000", "2019-01-01T00:00:00.000"]
    frame = with_values(spark, "inspection_date", values)
    chain = date_rule("inspection_date", ["%Y-%m-%dT%H:%M:%S.%f"])
    assert found(frame, chain, fields=("rule_id", "message")) == [
        (2, "inspection_date_required", "Inspection date is required."),
        (3, "inspection_date_format", "Inspection date does not match an accepted format."),
        (
            4,
            "inspection_year_matches_filename",
            "Inspection year 2018 does not match batch year 2019.",
        ),
    ]


def test_several_date_formats(spark):
    frame = with_values(spark, "inspection_date", ["2019-01-10", "01/10/2019"])
    assert found(frame, date_rule("inspection_date", ["%Y-%m-%d", " %m/%d/%Y "])) == []


def test_results(spark):
    frame = with_values(spark, "results", ["", "Pass", "pass", " Pass", "Fail"])
    assert found(frame, result_rule("results", ["Pass", "Fail"])) == [
        (2, "inspection_result_required", ""),
        (4, "inspection_result_allowed_values", "pass"),
        (5, "inspection_result_allowed_values", " Pass"),
    ]


def test_coordinates(spark):
    places = [
        ("", "-87"),
        ("north", "-87"),
        ("91", "-181"),
        ("NaN", "inf"),
        ("-90", "180"),
        ("", " "),
        ("x", ""),
        ("1e999", "0"),
    ]
    records = [record(i + 1, latitude=a, longitude=b) for i, (a, b) in enumerate(places)]
    chains = coordinate_rules("latitude", "longitude")
    assert found(batch(spark, records), *chains) == [
        (2, "coordinate_pair_consistency", "latitude=''; longitude='-87'"),
        (3, "latitude_numeric", "north"),
        (4, "latitude_range", "91"),
        (4, "longitude_range", "-181"),
        (5, "latitude_numeric", "NaN"),
        (5, "longitude_numeric", "inf"),
        (8, "coordinate_pair_consistency", "latitude='x'; longitude=''"),
        (8, "latitude_numeric", "x"),
        (9, "latitude_numeric", "1e999"),
    ]
    narrow = coordinate_rules("latitude", "longitude", (-1.5, 40), (-180, 180))
    issues = find_issues(batch(spark, records[:5]), narrow, ["source_row_number"])
    message = issues.where("rule_id = 'latitude_range'").first().message
    assert message == "Latitude must be between -1.5 and 40."


def test_pattern(spark):
    frame = with_values(spark, "state", ["IL", "ILL", " IL", "", "IL\n"])
    failing = [(3, "state_pattern", "ILL"), (4, "state_pattern", " IL"), (6, "state_pattern", "IL\n")]
    assert found(frame, pattern_rule("state", "^[A-Z]{2}$")) == failing
    required = pattern_rule("state", "^[A-Z]{2}$", nullable=False)
    assert (5, "state_required", "") in found(frame, required)


def test_license(spark):
    frame = with_values(spark, "license_", ["", "12A", "0", "000", "12", " 12"])
    fields = ("rule_id", "severity")
    assert found(frame, license_rule("license_", nullable=False), fields=fields) == [
        (2, "license_required", "error"),
        (3, "license_digits", "error"),
        (4, "license_zero_sentinel", "warning"),
        (5, "license_zero_sentinel", "warning"),
        (7, "license_digits", "error"),
    ]
    assert [row[1] for row in found(frame, license_rule("license_", True, False))] == [
        "license_digits",
        "license_digits",
    ]


def test_risk(spark):
    frame = with_values(spark, "risk", ["", "Risk 9", "All"])
    for severity in ("warning", "error"):
        chain = risk_rule("risk", ["All"], severity)
        assert found(frame, chain, fields=("rule_id", "message", "severity")) == [
            (2, "risk_missing", "risk is missing.", severity),
            (3, "risk_unknown", "risk is not an allowed risk value.", severity),
        ]


@pytest.mark.parametrize(
    "build",
    [
        lambda: identifier_rule(""),
        lambda: identifier_rule("id", 0),
        lambda: identifier_rule("id", True),
        lambda: date_rule("d", []),
        lambda: date_rule("d", [" "]),
        lambda: date_rule("d", "%Y"),
        lambda: result_rule("r", "Pass"),
        lambda: result_rule("r", []),
        lambda: result_rule("r", ["a", "a"]),
        lambda: result_rule("r", ["a", " "]),
        lambda: risk_rule("r", ["a"], "fatal"),
        lambda: risk_rule(" ", ["a"]),
        lambda: pattern_rule("s", ""),
        lambda: pattern_rule("s", "["),
        lambda: pattern_rule("s", "a", "yes"),
        lambda: license_rule("l", None),
        lambda: license_rule("l", True, 1),
        lambda: license_rule("l", True, True, "letters"),
        lambda: coordinate_rules("a", "b", (1, 1)),
        lambda: coordinate_rules("a", "b", (0, float("inf"))),
        lambda: coordinate_rules("a", "b", (False, 1)),
        lambda: coordinate_rules("a", "b", ("0", 1)),
    ],
)
def test_bad_parameters(build):
    with pytest.raises(ValueError):
        build()


def test_missing_column(spark):
    with pytest.raises(ValueError, match="missing columns"):
        found(batch(spark, [record(1)]), risk_rule("danger", ["a"]))
