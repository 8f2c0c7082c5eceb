import copy

import pytest
from helpers import COLUMNS, batch, record

from sievemark import INSPECTIONS, Roles, accepted, batch_summary, issue_metrics, issues
from sievemark import quarantine, reconciliation, curate, validate
from sievemark.functions.sql import name as ref, text
from sievemark.operators.quarantine import QUARANTINE_COLUMNS
from sievemark.operators.rules import Chain, Check


def listed(frame, severity=None):
    rows = issues(frame, INSPECTIONS, severity=severity).collect()
    return [(row.source_row_number, row.rule_id, row.record_id) for row in rows]


def twins(first, second, **changes):
    return [record(n, dba_name="Twin", aka_name="Twin", **changes) for n in (first, second)]


def test_clean_batch_has_no_issues(spark):
    checked = validate(batch(spark, [record(1), record(2)]), INSPECTIONS)
    assert listed(checked) == []
    assert accepted(checked).count() == 2
    assert checked.columns == [*COLUMNS, "batch_year", "source_row_number", "issues",
                               "duplicate_of", "duplicate_detection_skipped"]


def test_issues_of_a_row_are_ordered_and_severities_kept(spark):
    bad = record(1, zip="1", state="x", risk="", inspection_date="", license_="0")
    checked = validate(batch(spark, [bad]), INSPECTIONS)
    assert [rule for _, rule, _ in listed(checked)] == [
        "inspection_date_required",
        "license_zero_sentinel",
        "risk_missing",
        "state_pattern",
        "zip_pattern",
    ]
    assert len(listed(checked, "error")) == 3
    assert len(listed(checked, "warning")) == 2


def test_one_bad_identifier_skips_duplicates_of_its_batch_only(spark):
    gated = batch(spark, [*twins(1, 2), record("x")])
    sound = batch(
        spark, twins(1, 2, inspection_date="2020-05-01T10:00:00.000"), year=2020
    )
    checked = validate(gated.union(sound), INSPECTIONS)
    rows = issues(checked, INSPECTIONS).collect()
    assert sorted((row.batch_year, row.rule_id) for row in rows) == [
        (2019, "inspection_id_format"),
        (2020, "exact_duplicate_record"),
    ]
    flags = {row[0]: row[1] for row in checked.select("batch_year", "duplicate_detection_skipped").collect()}
    assert flags == {2019: True, 2020: False}


def test_duplicate_with_leading_zero_is_reported_by_its_number(spark):
    checked = validate(batch(spark, twins("5", "0007")), INSPECTIONS)
    assert listed(checked) == [(3, "exact_duplicate_record", "7")]
    row = quarantine(checked, INSPECTIONS).first()
    assert (row.inspection_id, row.dq_value, row.dq_duplicate_of_inspection_id) == ("0007", "7", 5)


def test_duplicate_severity_comes_from_the_contract(spark):
    contract = copy.deepcopy(INSPECTIONS)
    contract["record_rules"][0]["severity"] = "warning"
    checked = validate(batch(spark, twins(1, 2)), contract)
    assert accepted(checked).count() == 2
    assert quarantine(checked, contract).count() == 0
    assert [row.severity for row in issues(checked, contract).collect()] == ["warning"]
    contract["record_rules"] = []
    with pytest.raises(ValueError, match="no record rule"):
        validate(batch(spark, twins(1, 2)), contract)


def test_null_values_count_as_blank(spark):
    checked = validate(batch(spark, [record(1, results=None, risk=None, zip=None)]), INSPECTIONS)
    assert [rule for _, rule, _ in listed(checked)] == [
        "inspection_result_required",
        "risk_missing",
    ]


def test_own_rule_and_left_out_rules(spark):
    city = ref("city")
    check = Check("city_known", f"{city} <> 'Chicago'", "city", city, text("City is not served."))
    frame = batch(spark, [record(1, city="Gary", risk="?"), record(2)])
    roles = Roles(risk=None)
    checked = validate(frame, INSPECTIONS, roles=roles, extra=[Chain((check,), ("city",))])
    assert listed(checked) == [(2, "city_known", "1")]


def test_quarantine_has_one_row_per_error(spark):
    bad = record(2, state="Illinois", zip="1", risk="")
    checked = validate(batch(spark, [record(1), bad, *twins(3, 4, state="il")]), INSPECTIONS)
    held = quarantine(checked, INSPECTIONS)
    assert held.columns == [*COLUMNS, *QUARANTINE_COLUMNS]
    assert dict(held.dtypes)["dq_batch_year"] == "smallint"
    assert dict(held.dtypes)["dq_source_row_number"] == "bigint"
    rows = held.orderBy("dq_source_row_number", "dq_rule_id").collect()
    assert [
        (r.dq_source_row_number, r.dq_rule_id, r.dq_value, r.dq_duplicate_of_inspection_id)
        for r in rows
    ] == [
        (3, "state_pattern", "Illinois", None),
        (3, "zip_pattern", "1", None),
        (4, "state_pattern", "il", None),
        # The retained record is told on every issue of a duplicate row.
        (5, "exact_duplicate_record", "4", 3),
        (5, "state_pattern", "il", 3),
    ]
    assert {row.dq_severity for row in rows} == {"error"}


def test_quarantine_rejects_colliding_columns(spark):
    contract = copy.deepcopy(INSPECTIONS)
    contract["source_schema"]["expected_columns"] = ["inspection_id", "dq_rule_id"]
    checked = validate(batch(spark, [record(1)]), INSPECTIONS)
    with pytest.raises(ValueError, match="diagnostic columns"):
        quarantine(checked, contract)


def test_rows_with_repeated_ids_are_rejected_one_by_one(spark):
    """Identifiers may repeat, so rows are told apart by themselves, not by id."""
    checked = validate(batch(spark, [record("x"), record(5), record(6, zip="1")]), INSPECTIONS)
    assert [row.inspection_id for row in accepted(checked).collect()] == ["5"]


def test_counts_reconcile(spark):
    frame = batch(spark, [record(1), record(2, zip="1", state="x"), *twins(3, 4), record(5, risk="")])
    checked = validate(frame, INSPECTIONS)
    summary = batch_summary(checked)
    row = summary.first()
    assert (row.raw_rows, row.accepted_rows, row.rejected_rows) == (5, 3, 2)
    assert (row.error_issues, row.warning_issues) == (3, 1)
    curated = curate(accepted(checked), INSPECTIONS).withColumnRenamed("inspection_year", "batch_year")
    held = quarantine(checked, INSPECTIONS).withColumnRenamed("dq_batch_year", "batch_year")
    sound = reconciliation(summary, curated, held).first()
    assert sound.rows_add_up and sound.curated_complete and sound.quarantine_complete
    short = reconciliation(summary, curated.limit(1), held.limit(0)).first()
    assert not short.curated_complete and not short.quarantine_complete
    metrics = {(r.rule_id, r.severity): r.issue_count for r in issue_metrics(checked).collect()}
    assert metrics == {
        ("zip_pattern", "error"): 1,
        ("state_pattern", "error"): 1,
        ("exact_duplicate_record", "error"): 1,
        ("risk_missing", "warning"): 1,
    }


@pytest.mark.parametrize(
    ("change", "problem"),
    [
        (lambda c: c["source_schema"].update(expected_columns=[]), "non-empty"),
        (lambda c: c["source_schema"]["expected_columns"].append("zip"), "without repeats"),
        (lambda c: c["columns"].pop("city"), "does not describe"),
        (lambda c: c["contract"].update(primary_key="id"), "not a source column"),
    ],
)
def test_unsound_contracts(spark, change, problem):
    contract = copy.deepcopy(INSPECTIONS)
    change(contract)
    with pytest.raises(ValueError, match=problem):
        validate(batch(spark, [record(1)]), contract)


def test_batch_year_must_be_smallint(spark):
    frame = batch(spark, [record(1)]).selectExpr("* EXCEPT (batch_year)", "2019 AS batch_year")
    with pytest.raises(ValueError, match="SMALLINT"):
        validate(frame, INSPECTIONS)
