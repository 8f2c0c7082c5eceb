"""The divergence audit against brute force."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from sievemark.llm import divergence
from sievemark.llm.divergence import LEAF, SIDE


@pytest.mark.parametrize("seed", range(6))
def test_joint_walk_equals_dense_differences(seed):
    rng = np.random.default_rng(seed)
    width, rows, others = (int(rng.integers(1, SIDE + 1)) for _ in range(3))
    rows, others = max(1, rows // (1 + seed % 3 * 20)), max(1, others // 4)

    def tile(height):
        zeros = rng.integers(0, 50, height)
        dense = np.repeat(zeros[:, None], width, 1)
        hit = rng.random((height, width)) < (0.4 if seed % 2 else 0.002)
        dense[hit] = rng.integers(0, 1_000_000_000, int(hit.sum()))
        row, column = np.nonzero(hit)
        return (row, column, dense[hit]), zeros, dense

    one, zeros, dense = tile(rows)
    other, other_zeros, other_dense = tile(others)
    wanted = np.abs(dense[:, None, :] - other_dense[None, :, :]).sum(-1)
    assert (divergence.distances(one, other, zeros, other_zeros, width) == wanted).all()
    within = np.triu(np.abs(dense[:, None, :] - dense[None, :, :]).sum(-1), 1)
    found = divergence.distances(one, None, zeros, zeros, width)
    assert (np.triu(found, 1) == within).all()
    nothing = (np.zeros(0, np.int64),) * 3
    blank = np.repeat(other_zeros[:, None], width, 1)
    wanted = np.abs(dense[:, None, :] - blank[None, :, :]).sum(-1)
    assert (divergence.distances(one, nothing, zeros, other_zeros, width) == wanted).all()
    assert SIDE % LEAF == 0


def audit_by_hand(docs, least_docs, ranks):
    counts, in_docs = defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source in docs:
        lang, source = lang or "", source or ""
        lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower)
        counts[lang, source].update(terms)
        in_docs[lang].update(set(terms))
    kept = {lang: [t for t, n in found.items() if n >= least_docs] for lang, found in in_docs.items()}

    def shares(count, terms):
        whole = sum(count[t] for t in terms) + 5 * len(terms)
        return {t: 1 + 1_000_000_000 * (count[t] + 5) // whole for t in terms}

    rows = []
    for lang, source in counts:
        terms = kept.get(lang, [])
        in_lang = sum((c for (l, _), c in counts.items() if l == lang), Counter())
        mine, all_of = shares(counts[lang, source], terms), shares(in_lang, terms)
        pairs = []
        for other_lang, other in counts:
            if other_lang == lang and other != source:
                theirs = shares(counts[lang, other], terms)
                pairs.append((-sum(abs(mine[t] - theirs[t]) for t in terms), other.encode()))
        more = [(all_of[t] - mine[t], t.encode()) for t in terms if counts[lang, source][t] and mine[t] > all_of[t]]
        for part, found in (("pair", sorted(pairs)), ("term", sorted(more)[:ranks])):
            rows += [(lang, source, part, item.decode(), -value, rank) for rank, (value, item) in enumerate(found, 1)]
    return sorted(rows)


def documents():
    random.seed(41)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(400)] + ["Été", "été", "日本", "O'Neil", "a1b"]
    docs = []
    for i in range(700):
        # One language has more groups than a tile has rows, and one source a third of the documents.
        lang = random.choice(["en"] * 4 + ["fr", None, "xx"])
        source = f"s{random.randrange(320)}" if lang == "en" else random.choice([None, "", "a", "Ä"])
        if i % 3 == 0:
            lang, source = "en", "hot"
        size = random.choice([0, 1, 5, 40])
        text = None if i % 50 == 0 else " ".join(random.choices(words, k=size) if lang != "xx" else ["q"])
        docs.append((i % 600, text, lang, source))
    return [*docs, docs[3], docs[3]]


def test_audit_equals_brute_force(spark):
    docs = documents()
    table = spark.createDataFrame(
        [(*d, "x", 1, "y") for d in docs],
        "doc_id long, text string, lang string, source string, term string, rank int, value string",
    )
    found = divergence.audit(table, least_docs=5, ranks=7)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, found.collect())) == audit_by_hand(docs, 5, 7)


def test_audit_without_kept_terms_and_without_rows(spark):
    schema = "text string, lang string, source string"
    table = spark.createDataFrame([("a b", "en", "x"), ("c", "en", "y"), (None, None, None)], schema)
    found = sorted(map(tuple, divergence.audit(table).collect()))
    assert found == [("en", "x", "pair", "y", 0, 1), ("en", "y", "pair", "x", 0, 1)]
    assert divergence.audit(spark.createDataFrame([], schema)).collect() == []


def test_long_text_is_counted_in_pieces(monkeypatch):
    monkeypatch.setattr(divergence, "_PIECE", 7)
    assert divergence.terms_of("Abc déf-abc ABC9x".encode()) == {b"abc": 3, "déf".encode(): 1, b"x": 1}
