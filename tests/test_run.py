from pathlib import Path

import pytest
from helpers import csv_text, record

from sievemark import INSPECTIONS, BatchError, Settings, run_all, run_one, run_totals
from sievemark.operators.rules import Chain, Check
from sievemark.plans.durable import checkpoint_dir

DAY = {year: f"{year}-05-01T10:00:00.000" for year in (2019, 2020, 2021)}


def settings(folder, **changes):
    values = {
        "curated": str(folder / "curated"),
        "quarantine": str(folder / "quarantine"),
        "state": str(folder / "state"),
        "dataset": "inspections",
        "start_year": 2019,
        "end_year": 2025,
    }
    return Settings(**{**values, **changes})


def put(folder, year, records):
    incoming = folder / "incoming"
    incoming.mkdir(exist_ok=True)
    path = incoming / f"food_inspections_{year}.csv"
    path.write_text(csv_text([{**item, "inspection_date": DAY[year]} for item in records]))
    return str(path)


def run(spark, folder, **changes):
    report = run_all(spark, str(folder / "incoming"), INSPECTIONS, settings(folder, **changes))
    return {row.batch_year: row for row in report.collect()}


def ids(spark, folder, name="curated", column="inspection_id"):
    return sorted(row[0] for row in spark.read.parquet(str(folder / name)).select(column).collect())


def files(folder):
    return {
        path: path.stat().st_mtime_ns
        for name in ("curated", "quarantine", "state")
        for path in (folder / name).rglob("*.parquet")
    }


SEVEN = [
    record(1),
    record(2),
    record(3, license_="0"),
    record(4, risk="", latitude="", longitude="", location=""),
    record(5, longitude="", location=""),
    record(6, dba_name="Twin", aka_name='The "Twin", Inc'),
    record(7, dba_name="Twin", aka_name='The "Twin", Inc'),
]


def test_seven_row_scenario(spark, tmp_path):
    put(tmp_path, 2019, SEVEN)
    row = run(spark, tmp_path)[2019]
    assert (row.status, row.reason, row.duplicate_detection_skipped) == ("processed", None, False)
    assert (row.raw, row.accepted, row.rejected) == (7, 5, 2)
    assert (row.errors, row.warnings, row.quarantine_issues) == (2, 2, 2)
    assert (row.curated_rows, row.quarantine_rows) == (5, 2)
    assert ids(spark, tmp_path) == [1, 2, 3, 4, 6]
    curated = {r.inspection_id: r for r in spark.read.parquet(str(tmp_path / "curated")).collect()}
    assert curated[3].license_number is None and curated[4].risk is None
    held = spark.read.parquet(str(tmp_path / "quarantine")).orderBy("dq_source_row_number")
    assert [
        (r.inspection_id, r.dq_source_row_number, r.dq_rule_id, r.dq_duplicate_of_inspection_id)
        for r in held.collect()
    ] == [("5", 6, "coordinate_pair_consistency", None), ("7", 8, "exact_duplicate_record", 6)]
    assert len(held.columns) == 25

    before = files(tmp_path)
    again = run(spark, tmp_path)[2019]
    assert (again.status, again.reason) == ("skipped", "batch_state_current")
    assert (again.raw, again.errors, again.completed_at_utc) == (7, 2, row.completed_at_utc)
    assert files(tmp_path) == before


def test_changed_new_and_damaged_batches_are_processed(spark, tmp_path):
    for year in (2019, 2020):
        put(tmp_path, year, [record(1), record(2, zip="1")])
    run(spark, tmp_path)
    put(tmp_path, 2020, [record(1), record(3)])
    put(tmp_path, 2021, [record(9)])
    rows = run(spark, tmp_path)
    assert {year: row.status for year, row in rows.items()} == {
        2019: "skipped", 2020: "processed", 2021: "processed",
    }
    assert ids(spark, tmp_path) == [1, 1, 3, 9]
    # The quarantine of 2020 is empty now, and stays readable.
    assert ids(spark, tmp_path, "quarantine", "dq_batch_year") == [2019]
    for path in (tmp_path / "curated" / "inspection_year=2019").glob("*"):
        path.unlink()
    assert {year: row.status for year, row in run(spark, tmp_path).items()} == {
        2019: "processed", 2020: "skipped", 2021: "skipped",
    }
    assert ids(spark, tmp_path) == [1, 1, 3, 9]


def test_a_failing_batch_stops_the_run_after_earlier_ones(spark, tmp_path):
    put(tmp_path, 2019, [record(1)])
    put(tmp_path, 2020, [record(2, address=" ")])
    put(tmp_path, 2021, [record(3)])
    with pytest.raises(BatchError, match="batch 2020: 1 accepted rows are blank in address"):
        run(spark, tmp_path)
    assert ids(spark, tmp_path) == [1]
    put(tmp_path, 2020, [record(2)])
    assert {year: row.status for year, row in run(spark, tmp_path).items()} == {
        2019: "skipped", 2020: "processed", 2021: "processed",
    }


def test_an_unreadable_first_batch_publishes_nothing(spark, tmp_path):
    put(tmp_path, 2020, [record(1)])
    (tmp_path / "incoming" / "food_inspections_2019.csv").write_text("a,b\n1,2\n")
    with pytest.raises(BatchError, match="batch 2019: columns do not match"):
        run(spark, tmp_path)
    assert not (tmp_path / "curated").exists()


def test_values_that_pass_the_rules_but_do_not_convert(spark, tmp_path):
    put(tmp_path, 2019, [record(1, license_="9" * 30)])
    with pytest.raises(BatchError, match="do not convert in license_"):
        run(spark, tmp_path)


def test_one_file(spark, tmp_path):
    path = put(tmp_path, 2019, [record(1), record(1)])
    put(tmp_path, 2020, [record(2)])
    rows = run_one(spark, path, INSPECTIONS, settings(tmp_path)).collect()
    assert [(row.batch_year, row.status) for row in rows] == [(2019, "processed")]
    assert rows[0].duplicate_detection_skipped is True
    assert (rows[0].accepted, rows[0].errors) == (0, 2)
    assert ids(spark, tmp_path) == []


def test_the_requested_digest_is_used(spark, tmp_path):
    path = put(tmp_path, 2019, SEVEN)
    row = run(spark, tmp_path)[2019]
    assert (row.status, row.checksum_algorithm, row.accepted) == ("processed", "sha256-lines", 5)
    assert run(spark, tmp_path)[2019].status == "skipped"
    # Line breaks of another kind, of the same size, are a change.
    with open(path, "rb") as file:
        content = file.read()
    with open(path, "wb") as file:
        file.write(content[:-1] + b"\r")
    assert run(spark, tmp_path)[2019].status == "processed"
    row = run(spark, tmp_path, hash_algorithm="sha256")[2019]
    assert (row.status, row.checksum_algorithm) == ("processed", "sha256")
    assert run(spark, tmp_path, hash_algorithm="sha256")[2019].status == "skipped"


def test_rules_of_the_callers_own(spark, tmp_path):
    put(tmp_path, 2019, [record(1), record(2, city="Nowhere")])
    check = Check("city_known", "city = 'Nowhere'", "city", "city", "'City is not known.'")
    report = run_all(
        spark, str(tmp_path / "incoming"), INSPECTIONS, settings(tmp_path),
        extra=[Chain((check,), ("city",))],
    ).collect()
    assert [(row.accepted, row.rejected, row.errors) for row in report] == [(1, 1, 1)]
    assert ids(spark, tmp_path) == [1]
    assert ids(spark, tmp_path, "quarantine", "dq_rule_id") == ["city_known"]


def test_intermediate_tables_go_with_the_run(spark, tmp_path):
    put(tmp_path, 2019, SEVEN)
    before = spark.conf.get("spark.sql.codegen.hugeMethodLimit")
    run(spark, tmp_path)
    folder = Path(checkpoint_dir(spark).removeprefix("file:"))
    assert folder.is_dir() and list(folder.glob("run-*")) == []
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == before


def test_nothing_to_do(spark, tmp_path):
    (tmp_path / "incoming").mkdir()
    assert run(spark, tmp_path) == {}


@pytest.mark.parametrize(
    "changes",
    [
        {"output_format": "csv"},
        {"compression": "rar"},
        {"partition_by": ("year",)},
        {"dataset": "a b"},
        {"hash_algorithm": "crc"},
        {"encoding": "utf-7"},
        {"encoding": "nonsense"},
    ],
)
def test_bad_settings(spark, tmp_path, changes):
    put(tmp_path, 2019, [record(1)])
    with pytest.raises(ValueError):
        run(spark, tmp_path, **changes)


def test_totals_and_stored_metrics_follow_the_files(spark, tmp_path):
    """Counts of a batch are replaced with it, also by none; a batch that is skipped keeps its own."""
    place = str(tmp_path / "metrics")

    def both():
        incoming = str(tmp_path / "incoming")
        report = run_all(spark, incoming, INSPECTIONS, settings(tmp_path, metrics=place))
        stored = spark.read.parquet(place).collect()
        return tuple(run_totals(report).first()), {
            (r.batch_year, r.rule_id, r.severity): r.issue_count for r in stored
        }

    put(tmp_path, 2019, SEVEN)
    put(tmp_path, 2020, [record(1, risk=""), record(2, risk=""), record(3)])
    totals, counts = both()
    assert totals == (2, 2, 0)
    assert counts == {
        (2019, "coordinate_pair_consistency", "error"): 1,
        (2019, "exact_duplicate_record", "error"): 1,
        (2019, "license_zero_sentinel", "warning"): 1,
        (2019, "risk_missing", "warning"): 1,
        (2020, "risk_missing", "warning"): 2,
    }
    put(tmp_path, 2019, [record(1)])
    totals, counts = both()
    assert totals == (2, 1, 1)
    assert counts == {(2020, "risk_missing", "warning"): 2}
    assert tuple(run_totals(spark.createDataFrame([], "status string")).first()) == (0, 0, 0)


def test_a_run_over_another_code_page(spark, tmp_path):
    path = put(tmp_path, 2019, [record(1, dba_name="Café € 1"), record(2, dba_name="Two\nlines é")])
    Path(path).write_bytes(Path(path).read_text().encode("cp1252"))
    assert run(spark, tmp_path, encoding="cp1252", hash_algorithm="blake2b")[2019].accepted == 2
    names = {r.dba_name for r in spark.read.parquet(str(tmp_path / "curated")).collect()}
    assert names == {"Café € 1", "Two lines é"}
    assert run(spark, tmp_path, encoding="cp1252", hash_algorithm="blake2b")[2019].status == "skipped"


def test_the_second_of_two_runs_gets_one_new_file(spark, monkeypatch):
    from sievemark.catalog import files

    written = []

    def spy(lines, *rest, write=files._write, **named):
        written.append(sorted(row.batch_year for row in lines.select("batch_year").distinct().collect()))
        return write(lines, *rest, **named)

    monkeypatch.setattr(files, "_write", spy)
    rows = files.run_twice(spark, "/root/testdata/sf0.001").collect()
    years = sorted({row.batch_year for row in rows})
    assert written == [years, [1998]] and len(rows) == 2 * len(years) > 2
    assert [row.batch_year for row in rows if row.run == 2 and row.status == "processed"] == [1998]
