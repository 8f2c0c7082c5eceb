"""Mined URL rules against all combinations counted one by one."""

import os
import random
import time
from collections import Counter
from itertools import combinations, product

import pytest
from pyspark.sql import functions as F

from sievemark.llm import url_rules
from sievemark.llm.queries import LISTED, op5_url_rules


def all_rules(rows, least, needed):
    """(tokens, confidence, support) of every combination that holds more than its parts."""
    seen, bad = Counter(), Counter()
    for own, is_bad in rows:
        for size in (1, 2, 3):
            for combo in combinations(sorted(own), size):
                seen[combo] += 1
                bad[combo] += is_bad
    good = {c: bad[c] / seen[c] for c in bad if bad[c] >= least and bad[c] / seen[c] >= needed}
    return {
        c: (x, bad[c] / len(rows))
        for c, x in good.items()
        if not any(good.get(p, 0) >= x for size in range(1, len(c)) for p in combinations(c, size))
    }


def written_out(rules):
    return {
        tuple(sorted(combo)): (pytest.approx(r.confidence), pytest.approx(r.support))
        for r in rules
        for combo in product(*r.sets)
    }


def labelled(spark, rows):
    table = spark.createDataFrame(rows, "url string, bad boolean")
    own = table.select(url_rules.tokens(F.col("url")).alias("t"), "bad").where(F.size("t") > 0)
    return table, [(set(r.t), r.bad) for r in own.collect()]


@pytest.mark.parametrize("seed", range(3))
def test_rules_equal_all_combinations(spark, seed):
    rng = random.Random(seed)
    words = "abcdefg"
    rows = []
    for _ in range(500):
        chosen = [w for w in words if rng.random() < 0.45]
        host = rng.choice(["x.example.org", "y.example.org", "z.example.net"])
        if host[0] == "z":
            chosen += ["always", "together"]
        score = ("a" in chosen) + ("b" in chosen) + (host[0] == "y")
        rows.append((f"https://{host}/{'/'.join(chosen)}", rng.random() < [0.02, 0.1, 0.75, 0.97][score]))
    rows += [(None, True), ("no url", True), ("", False)] + rows[:40]
    table, own = labelled(spark, rows)
    share = sum(b for _, b in own) / len(own)
    rules, seen = url_rules.mine(table)
    expected = all_rules(own, url_rules.LEAST_TRANSACTIONS, max(0.7, share + (1 - share) / 2))
    # Sets of equal tokens count once; combinations of three here have no more sets than tokens.
    assert expected and written_out(rules) == expected
    by = url_rules.index(rules, seen)
    for held, _ in own:
        match = url_rules.best_match(sorted(held), by)
        fitting = [(*v, c) for c, v in expected.items() if held.issuperset(c)]
        assert (match and match[0]) == (max(fitting)[2] if fitting else None)


def test_long_paths_shared_by_many_urls(spark):
    folder = "/".join(f"word{i}x" for i in range(60))
    rows = [(f"https://a.example.org/{folder}/{i}", i % 20 != 0) for i in range(200)]
    rows += [(f"https://b.example.org/{i}/other", False) for i in range(200)]
    table, _ = labelled(spark, rows)
    start = time.perf_counter()
    rules, seen = url_rules.mine(table)
    assert time.perf_counter() - start < 30
    assert len(rules) == 1 and len(rules[0].sets[0]) == 61
    match = url_rules.best_match(["path=word7x"], url_rules.index(rules, seen))
    assert match[0] == ("path=word7x",) and match[1].confidence == pytest.approx(0.95)


def test_most_pages_bad(spark):
    rows = [(f"https://a.example.org/{'p' if i % 5 else 'q'}/{i}", i % 5 != 0) for i in range(500)]
    rules, _ = url_rules.mine(labelled(spark, rows)[0])
    assert [r.tokens for r in rules] == [("path=p",)]
    only_bad = spark.createDataFrame([(u, True) for u, _ in rows], "url string, bad boolean")
    assert url_rules.mine(only_bad) == ([], {})
    assert url_rules.mine(only_bad.where("false")) == ([], {})


def test_mined_rules_decide_pages_of_the_tables(spark):
    sf_dir = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
    rows = op5_url_rules(spark, sf_dir).collect()
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    own = {r.page_id: set(r.t) for r in pages.select("page_id", url_rules.tokens(F.col("url")).alias("t")).collect()}
    verdicts = {one.rule: one.verdict for one in LISTED}
    given = [(own[r.page_id], verdicts[r.rule] == "block") for r in rows if r.rule and own[r.page_id]]
    share = sum(b for _, b in given) / len(given)
    expected = all_rules(
        given,
        max(url_rules.LEAST_TRANSACTIONS, url_rules.LEAST_SUPPORT * len(given)),
        max(0.7, share + (1 - share) / 2),
    )
    for r in rows:
        fits = any(own[r.page_id].issuperset(c) for c in expected)
        assert r.verdict == (verdicts[r.rule] if r.rule else "block" if fits else "allow")
        assert (r.mined is not None) == fits
    assert {r.verdict for r in rows if not r.rule} == {"block", "allow"}
