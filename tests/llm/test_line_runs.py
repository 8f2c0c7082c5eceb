"""Repeated runs of lines, in shards of any size, against a plain look-up of every selected run."""

import random
from collections import defaultdict

import pytest

from sievemark.llm import line_dedup


def documents():
    random.seed(71)
    lines = [f"line {i} " + "w " * random.choice([1, 3, 25]) for i in range(60)]
    common = ["menu", "footer and imprint", "a b c"]
    docs = []
    for i in range(150):
        if i and random.random() < 0.3:
            text = random.choice(docs)[1] or ""  # a copy, at times a changed one
            kept = [part for part in text.split("\n") if random.random() < random.choice([1, 0.9])]
        else:
            kept = [random.choice(lines) for _ in range(random.choice([0, 1, 2, 5, 30]))]
        kept = [x for part in kept for x in ([part, random.choice(common)] if random.random() < 0.1 else [part])]
        if i % 3 == 0:
            kept = ["menu", "a b c", "footer and imprint", *kept]
        docs.append((random.choice([i, i, i, 7, None]), None if i % 40 == 9 else "\n".join(kept)))
    return [*docs, docs[3], docs[3], (200, docs[3][1])]


def key_of(doc):
    """Documents in order: null ids first."""
    return (doc[0] is not None, doc[0] or 0, doc[1])


def runs_by_hand(docs):
    """By document, and by document and anchor: the lines that repeat earlier ones."""
    spots = defaultdict(set)
    for doc in docs:
        hashes, sizes = line_dedup.line_hashes(doc[2] or "")
        hashes = hashes.tolist()
        places, lengths, found = line_dedup.select(line_dedup.line_hashes(doc[2] or "")[0], sizes)
        for place, length, value in zip(places.tolist(), lengths.tolist(), found.tolist()):
            stop = place + length
            spots["alone", value].add((key_of(doc), place, stop, 0))
            if place > 0:
                spots["before", value, hashes[place - 1]].add((key_of(doc), place - 1, stop, 0))
            if stop < len(hashes):
                spots["after", value, hashes[stop]].add((key_of(doc), place, stop + 1, 1))
    lines, by_anchor = defaultdict(set), defaultdict(set)
    for of in spots.values():
        first = min(of)
        for doc, start, stop, lap in of:
            if len(of) > 1 and (doc != first[0] or start >= first[2] - lap):
                lines[doc].update(range(start, stop))
                by_anchor[doc, first[0]].update(range(start, stop))
    return lines, by_anchor


@pytest.mark.parametrize("shard_rows", [10**6, 200, 9])
def test_runs_equal_a_plain_look_up(spark, shard_rows):
    docs = documents()
    table = spark.createDataFrame(docs, "doc_id long, text string")
    versions = {
        (r.doc_id, r.text): r.version
        for r in table.selectExpr("doc_id", "text", "xxhash64(text) AS version").collect()
    }
    # Rows equal in id and text are one document.
    named = sorted({(i, versions[i, text], text) for i, text in docs}, key=repr)
    wanted, by_anchor = runs_by_hand(named)
    found = defaultdict(set)
    for row in line_dedup.found_runs(table, shard_rows=shard_rows)[0].collect():
        for run in row.runs:
            found[key_of((row.id, row.version))].update(range(run.start, run.stop))
    assert found == wanted
    for hot_rows in (1, 10, 1000):
        found = defaultdict(set)
        runs, hot = line_dedup.found_runs(table, anchors=True, shard_rows=shard_rows, hot_rows=hot_rows)
        for row in runs.collect():
            for run in row.runs:
                of = hot[run.key] if run.key is not None else (run.first_id, run.first_version)
                found[key_of((row.id, row.version)), key_of(of)].update(range(run.start, run.stop))
        assert found == by_anchor
