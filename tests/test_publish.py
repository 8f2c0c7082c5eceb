import pytest

from sievemark import multi_batch_summary, pending_batches, publish, skipped_batches
from sievemark.operators.quarantine import QUARANTINE_COLUMNS
from sievemark.sources import storage
from sievemark.sources.publish import check_format, check_partitioning
from sievemark.sources.state import (
    STATE,
    check_dataset,
    output_sizes,
    read_state,
    state_violations,
    write_state,
)


def rows(spark, *pairs):
    return spark.createDataFrame(pairs, "n int, inspection_year smallint")


def put(frame, root, counts, **options):
    return publish(
        frame,
        root,
        partition="inspection_year",
        years=sorted(counts),
        expected_rows=counts,
        order=["n"],
        **options,
    )


def stored(spark, root):
    frame = spark.read.schema("n int, inspection_year smallint").parquet(root)
    return sorted(tuple(row) for row in frame.collect())


def test_replaces_only_the_given_batches(spark, tmp_path):
    root = str(tmp_path / "out")
    put(rows(spark, (1, 2019), (2, 2020)), root, {2019: 1, 2020: 1})
    done = put(rows(spark, (3, 2020), (4, 2020)), root, {2020: 2}, compression="zstd")
    assert stored(spark, root) == [(1, 2019), (3, 2020), (4, 2020)]
    assert (done[0].year, done[0].row_count, done[0].compression) == (2020, 2, "zstd")
    files = list((tmp_path / "out" / "inspection_year=2020").glob("*.parquet"))
    assert done[0].size_bytes == sum(file.stat().st_size for file in files)
    assert [entry.name for entry in (tmp_path / "out").iterdir() if entry.name[0] == "_"] == []


def refuse_renames(monkeypatch, target):
    """Let the new folder of ``target`` be missing when it is to be moved into place."""
    replace = storage.replace_folder

    def gone(spark, new, current, aside):
        replace(spark, new + "-missing" if target in current else new, current, aside)

    monkeypatch.setattr(storage, "replace_folder", gone)


def test_old_rows_stay_when_new_ones_cannot_be_moved(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "out")
    put(rows(spark, (1, 2019), (2, 2019)), root, {2019: 2})
    refuse_renames(monkeypatch, "=2019")
    with pytest.raises(Exception):
        put(rows(spark, (3, 2019)), root, {2019: 1})
    assert stored(spark, root) == [(1, 2019), (2, 2019)]
    assert [e.name for e in (tmp_path / "out").iterdir() if "staging" in e.name] == []


def test_a_failure_in_the_second_of_three_years(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "out")
    put(rows(spark, (1, 2019), (2, 2020), (3, 2021)), root, {2019: 1, 2020: 1, 2021: 1})
    refuse_renames(monkeypatch, "=2020")
    with pytest.raises(Exception):
        put(rows(spark, (4, 2019), (5, 2020), (6, 2021)), root, {2019: 1, 2020: 1, 2021: 1})
    assert stored(spark, root) == [(2, 2020), (3, 2021), (4, 2019)]


def test_empty_batch_replaces_the_old_one(spark, tmp_path):
    root = str(tmp_path / "out")
    put(rows(spark, (1, 2019)), root, {2019: 1})
    done = put(rows(spark), root, {2019: 0})
    assert stored(spark, root) == []
    assert done[0].row_count == 0 and done[0].size_bytes > 0


def test_rebalanced_rows_are_all_there(spark, tmp_path):
    root = str(tmp_path / "out")
    frame = spark.sql("SELECT cast(id AS int) AS n, 2019S AS inspection_year FROM range(0, 5000)")
    put(frame.repartition(7), root, {2019: 5000}, rebalance=True)
    assert len(stored(spark, root)) == 5000


@pytest.mark.parametrize(
    ("pairs", "counts", "problem"),
    [
        ([(1, None)], {2019: 0}, "null_partitions"),
        ([(1, 2018)], {2019: 0}, "other_batch"),
        ([(1, 2019)], {2019: 2}, "1 rows written"),
    ],
)
def test_nothing_is_replaced_when_a_check_fails(spark, tmp_path, pairs, counts, problem):
    root = str(tmp_path / "out")
    put(rows(spark, (7, 2019)), root, {2019: 1})
    with pytest.raises(ValueError, match=problem):
        put(rows(spark, *pairs), root, counts)
    assert stored(spark, root) == [(7, 2019)]
    assert [entry.name for entry in (tmp_path / "out").iterdir()] == ["inspection_year=2019"]


def test_fractional_and_missing_partitions(spark, tmp_path):
    frame = spark.createDataFrame([(1, 2019.5)], "n int, inspection_year double")
    with pytest.raises(ValueError, match="not_integral"):
        put(frame, str(tmp_path), {2019: 1})
    with pytest.raises(ValueError, match="lacks the partition"):
        put(frame.select("n"), str(tmp_path), {2019: 1})


def held(spark, severity):
    values = ", ".join(
        f"{sql} AS {name}"
        for name, sql in zip(
            QUARANTINE_COLUMNS, ["2L", "'r'", "'c'", "'v'", "'m'", severity, "NULL", "2019S"]
        )
    )
    return spark.sql(f"SELECT {values}")


@pytest.mark.parametrize(
    ("severity", "problem"), [("'warning'", "other_severities"), ("NULL", "null_severities")]
)
def test_quarantine_holds_errors_only(spark, tmp_path, severity, problem):
    options = {"partition": "dq_batch_year", "years": [2019], "expected_rows": {2019: 1},
               "order": ["dq_source_row_number"]}
    publish(held(spark, "'error'"), str(tmp_path), **options)
    with pytest.raises(ValueError, match=problem):
        publish(held(spark, f"cast({severity} AS string)"), str(tmp_path), **options)
    with pytest.raises(ValueError, match="lacks diagnostic"):
        publish(held(spark, "'error'").drop("dq_value"), str(tmp_path), **options)


def test_formats():
    assert check_format(" Parquet ", " SNAPPY ") == "snappy"
    for output_format, codec in (("csv", "snappy"), (None, "snappy"), ("parquet", "rar"), ("parquet", None)):
        with pytest.raises(ValueError):
            check_format(output_format, codec)
    check_partitioning(["inspection_year"])
    with pytest.raises(ValueError):
        check_partitioning(["inspection_year", "city"])


RECORD = {
    "schema_version": 1,
    "dataset": "ds",
    "batch_year": 2019,
    "completed_at_utc": "2024-01-01T00:00:00Z",
    "source_path": "in/2019.csv",
    "source_size_bytes": 10,
    "checksum_algorithm": "SHA256",
    "checksum": "abc",
    "raw_row_count": 3,
    "accepted_row_count": 2,
    "rejected_record_count": 1,
    "quarantine_issue_count": 2,
    "error_count": 2,
    "warning_count": 0,
    "curated_path": "cur",
    "curated_row_count": 2,
    "curated_size_bytes": 100,
    "curated_compression": "snappy",
    "quarantine_path": "qua",
    "quarantine_row_count": 2,
    "quarantine_size_bytes": 50,
    "quarantine_compression": "snappy",
}


def state(spark, **changes):
    record = {**RECORD, **changes}
    return spark.createDataFrame([tuple(record[name] for name in STATE.fieldNames())], STATE)


def test_state_round_trip(spark, tmp_path):
    root = str(tmp_path / "state")
    assert read_state(spark, root, dataset="ds").count() == 0
    write_state(state(spark), root)
    write_state(state(spark, batch_year=2020), root)
    write_state(state(spark, dataset="other"), root)
    write_state(state(spark, checksum="new"), root)
    found = {row.batch_year: row.asDict() for row in read_state(spark, root, dataset="ds").collect()}
    assert found == {2019: {**RECORD, "checksum": "new"}, 2020: {**RECORD, "batch_year": 2020}}


@pytest.mark.parametrize(
    ("changes", "problem"),
    [
        ({"schema_version": 2}, "schema version"),
        ({"accepted_row_count": 1}, "add up"),
        ({"curated_row_count": 1}, "curated rows"),
        ({"quarantine_row_count": 1}, "quarantine rows"),
        ({"error_count": 1}, "differ from errors"),
        ({"warning_count": -1}, "warning_count is not a count"),
        ({"checksum": ""}, "checksum is empty"),
        ({"completed_at_utc": "yesterday"}, "time with a zone"),
        ({"completed_at_utc": "2024-01-01T00:00:00"}, "time with a zone"),
    ],
)
def test_unsound_state(spark, tmp_path, changes, problem):
    assert problem in state_violations(state(spark, **changes)).first().problems
    write_state(state(spark, **changes), str(tmp_path / "state"))
    with pytest.raises(ValueError, match="unsound"):
        read_state(spark, str(tmp_path / "state"), dataset="ds")


def test_an_unsound_year_does_not_stop_the_others(spark, tmp_path):
    root = str(tmp_path / "state")
    write_state(state(spark).unionByName(state(spark, batch_year=2018, raw_row_count=99)), root)
    assert read_state(spark, root, dataset="ds", years=[2019]).count() == 1
    with pytest.raises(ValueError, match="unsound"):
        read_state(spark, root, dataset="ds", years=[2018, 2019])


@pytest.mark.parametrize("name", ["", "-x", "a b", None, "a/b"])
def test_dataset_names(name):
    with pytest.raises(ValueError, match="dataset"):
        check_dataset(name)


FILE = {"batch_year": 2019, "path": "p", "size_bytes": 10, "checksum_algorithm": "sha256",
        "checksum": "abc"}


@pytest.mark.parametrize(
    ("file", "outputs", "current"),
    [
        ({}, {"cur": 100, "qua": 50}, True),
        ({"checksum_algorithm": "Sha256"}, {"cur": 100, "qua": 50}, True),
        ({"batch_year": 2020}, {"cur": 100, "qua": 50}, False),
        ({"size_bytes": 11}, {"cur": 100, "qua": 50}, False),
        ({"checksum": "abd"}, {"cur": 100, "qua": 50}, False),
        ({"checksum_algorithm": "md5"}, {"cur": 100, "qua": 50}, False),
        ({}, {"qua": 50}, False),
        ({}, {"cur": 100}, False),
        ({}, {"cur": 101, "qua": 50}, False),
        ({}, {"cur": 100, "qua": 49}, False),
    ],
)
def test_pending(spark, file, outputs, current):
    schema = "batch_year smallint, path string, size_bytes bigint, checksum_algorithm string, checksum string"
    batches = spark.createDataFrame([tuple({**FILE, **file}.values())], schema)
    sizes = spark.createDataFrame(list(outputs.items()), "path string, size_bytes bigint")
    assert pending_batches(batches, state(spark), sizes).count() == (0 if current else 1)
    assert skipped_batches(batches, state(spark), sizes).count() == (1 if current else 0)
    counts = multi_batch_summary(batches, state(spark), sizes).first()
    assert tuple(counts) == ((1, 0, 1) if current else (1, 1, 0))


def test_output_sizes(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.parquet").write_bytes(b"12345")
    (tmp_path / "a" / "_SUCCESS").write_bytes(b"1")
    (tmp_path / "b").mkdir()
    paths = [str(tmp_path / name) for name in "abc"]
    assert [tuple(row) for row in output_sizes(spark, paths).collect()] == [(paths[0], 5)]
