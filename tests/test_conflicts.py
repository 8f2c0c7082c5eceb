import random
from collections import defaultdict

import pytest
from helpers import batch, record

from sievemark import INSPECTIONS, find_exact_duplicates, issues, validate
from sievemark.operators.conflicts import key_clashes
from sievemark.plans import lookup


def duplicates(frame, **options):
    rows = find_exact_duplicates(frame, **options).orderBy("record_id").collect()
    return [(row.record_id, row.duplicate_of) for row in rows]


def test_lowest_key_is_kept(spark):
    rows = [(30, "a", 1.0), (10, "a", 1.0), (20, "a", 1.0), (9, "b", None), (7, "b", None)]
    frame = spark.createDataFrame([*rows, (100, "c", 2.0)], "id bigint, t string, n double")
    expected = [(9, 7), (20, 10), (30, 10)]
    assert duplicates(frame, key="id", columns=["id", "t", "n"]) == expected


def test_text_keys_compare_as_numbers(spark):
    frame = spark.createDataFrame([("9", "a"), ("10", "a")], "id string, t string")
    assert duplicates(frame, key="id", columns=["id", "t"]) == [(10, 9)]


def test_blank_and_null_differ(spark):
    frame = spark.createDataFrame([(1, ""), (2, None), (3, None)], "id bigint, t string")
    assert duplicates(frame, key="id", columns=["id", "t"]) == [(3, 2)]


def test_batches_are_apart(spark):
    frame = spark.sql("SELECT * FROM VALUES (1, 'a', 1S), (2, 'a', 2S), (3, 'a', 2S) AS v(id, t, y)")
    rows = find_exact_duplicates(frame, key="id", columns=["id", "t"], batch="y").collect()
    assert [tuple(row) for row in rows] == [(2, 3, 2)]


@pytest.mark.parametrize(
    ("keys", "columns", "problem"),
    [
        ([1, 2], [], "without repeats"),
        ([1, 2], ["id", "t", "t"], "without repeats"),
        ([1, 2], ["t"], "include the key"),
        ([1, 2], ["id", "x"], "in the data"),
        ([1, 2], ["id"], "at least one column"),
        (["1", "x"], ["id", "t"], "not digits"),
        (["1", None], ["id", "t"], "not digits"),
        (["1", "9223372036854775808"], ["id", "t"], "not digits"),
        (["1", "01"], ["id", "t"], "repeated"),
    ],
)
def test_preconditions(spark, keys, columns, problem):
    kind = "bigint" if isinstance(keys[0], int) else "string"
    frame = spark.createDataFrame([(key, "a") for key in keys], f"id {kind}, t string")
    with pytest.raises(ValueError, match=problem):
        find_exact_duplicates(frame, key="id", columns=columns)


def test_key_clashes(spark):
    frame = spark.createDataFrame([(1, 1), (1, 1), (1, 2)], "a int, b int")
    assert [tuple(row) for row in key_clashes(frame, keys=["a", "b"]).collect()] == [(1, 1, 2)]


def skewed_rows(seed):
    """A third of the rows of each kind of batch share one key."""
    rng = random.Random(seed)
    records, years = [], []
    for number in range(1, 301):
        year = 2019 + number % 2
        copy = rng.random()
        name = "hot" if copy < 0.35 else f"n{rng.randrange(60)}"
        identifier = str(number)
        if year == 2020:
            identifier = rng.choice(["", "77", "077", str(number)]) if copy < 0.5 else identifier
        records.append(record(identifier, dba_name=name, aka_name="x"))
        years.append(year)
    return records, years


def expected_conflicts(records, years):
    """Brute force, row by row."""
    out = []
    ids = defaultdict(list)
    bad = set()
    for position, (item, year) in enumerate(zip(records, years)):
        text = item["inspection_id"]
        if not text.strip():
            bad.add(year)
        else:
            ids[year, int(text)].append(position)
    for (year, _), positions in ids.items():
        if len(positions) > 1:
            bad.add(year)
            out += [(position, "inspection_id_unique", None) for position in positions]
    groups = defaultdict(list)
    for position, (item, year) in enumerate(zip(records, years)):
        if year not in bad:
            groups[year, item["dba_name"]].append((int(item["inspection_id"]), position))
    for members in groups.values():
        kept = min(members)[0]
        out += [(pos, "exact_duplicate_record", kept) for number, pos in members if number > kept]
    return sorted(out, key=repr)


@pytest.mark.parametrize(("groups", "hot"), [(None, None), (0, None), (0, 3), (0, 1)])
def test_every_join_strategy_gives_the_same_result(spark, monkeypatch, groups, hot):
    if groups is not None:
        monkeypatch.setattr(lookup, "MAX_BROADCAST_GROUPS", groups or 1)
    if hot is not None:
        monkeypatch.setattr(lookup, "HOT_ROWS", hot)
        monkeypatch.setattr(lookup, "hot_threshold", lambda rows: hot)
    records, years = skewed_rows(7)
    parts = [
        batch(spark, [item]).drop("batch_year", "source_row_number").selectExpr(
            "*", f"cast({year} AS smallint) AS batch_year", f"{position}L AS source_row_number"
        )
        for position, (item, year) in enumerate(zip(records[:1], years[:1]))
    ]
    frame = parts[0]
    rows = [
        (*[item[name] for name in frame.columns[:-2]], year, position)
        for position, (item, year) in enumerate(zip(records, years))
    ]
    frame = spark.createDataFrame(rows, frame.schema).repartition(4)
    checked = validate(frame, INSPECTIONS)
    plan = checked._jdf.queryExecution().toString()
    assert ("SortMergeJoin" in plan) == (groups is not None)
    found = [
        (row.source_row_number, row.rule_id, row.duplicate_of)
        for row in checked.selectExpr("source_row_number", "duplicate_of", "inline(issues)").collect()
        if row.rule_id in ("inspection_id_unique", "exact_duplicate_record")
    ]
    assert sorted(found, key=repr) == expected_conflicts(records, years)
    assert len(found) > 100


def test_plan_stays_in_the_jvm_and_off_windows(spark):
    frame = batch(spark, [record(1), record(2)])
    plan = issues(validate(frame, INSPECTIONS), INSPECTIONS)._jdf.queryExecution().toString()
    for operator in ("Python", "Window", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in plan
