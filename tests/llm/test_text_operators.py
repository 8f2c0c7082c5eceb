"""Decontamination, fingerprints and line dedup against brute force on small tables."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash

from sievemark.llm import decontamination, line_dedup, winnowing
from sievemark.llm.hashing import SPACES, slices, text_bytes, word_hashes

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ASCII_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text):
    return WORD.findall((text or "").translate(ASCII_LOWER))


def contamination_by_hand(docs, items, size=10):
    windows = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - size + 1)):
            if w:
                windows.setdefault(tuple(w[i : i + size]), set()).add(str(item))
    result = []
    for doc_id, text in docs:
        w = words(text)
        hit, found = set(), set()
        for window, names in windows.items():
            for i in range(len(w) - len(window) + 1):
                if tuple(w[i : i + len(window)]) == window:
                    hit |= set(range(i, i + len(window)))
                    found |= names
        result.append((doc_id, len(w), len(hit), tuple(sorted(found)), bool(hit)))
    return sorted(result, key=repr)


def sentence(n, vocabulary="a b c d e É ß 7 x1".split()):
    return " ".join(random.choice(vocabulary) for _ in range(n))


def test_contamination_equals_brute_force(spark):
    random.seed(1)
    items = [(i, sentence(random.randint(1, 14))) for i in range(12)]
    items += [(20, None), (21, ""), (22, "a"), (23, "A b"), (3, items[3][1]), (24, items[5][1])]
    docs = [(i, sentence(random.randint(0, 60))) for i in range(60)]
    docs += [(100 + i, f"{sentence(5)} {random.choice(items)[1]}, {sentence(3)}") for i in range(20)]
    docs += [(200, None), (201, ""), (202, "..."), (None, "A, b"), (5, docs[5][1])]
    table = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, item string, start int")
    marks = spark.createDataFrame([(*i, 0) for i in items], "item_id long, text string, doc_id int")
    checked = decontamination.contamination(table, marks)
    assert checked.columns == ["doc_id", "text", "item", "start", "contamination"]
    rows = [
        (r.doc_id, c.n_words, c.n_hit, tuple(c["items"]), c.contaminated)
        for r in checked.collect()
        for c in [r.contamination]
    ]
    assert sorted(rows, key=repr) == contamination_by_hand(docs, items)


def test_repeated_rows_keep_their_contamination(spark):
    text = "one two three four five six seven eight nine ten eleven"
    docs = [(1, f"x {text} y"), (1, f"x {text} y"), (None, text), (None, text), (2, "no"), (2, "no")]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    items = spark.createDataFrame([(7, text)], "item_id long, text string")
    rows = decontamination.contamination(table, items).collect()
    found = [(r.doc_id, c.n_words, c.n_hit, tuple(c["items"]), c.contaminated) for r in rows for c in [r.contamination]]
    assert sorted(found, key=repr) == contamination_by_hand(docs, [(7, text)])
    assert sum(r[-1] for r in found) == 4


@pytest.mark.parametrize("side", ["docs", "items", "both"])
def test_contamination_of_empty_tables(spark, side):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    docs = docs.where("false") if side != "items" else docs
    items = items.where("false") if side != "docs" else items
    rows = decontamination.contamination(docs, items).collect()
    assert [r.contamination.contaminated for r in rows] == ([False] if side == "items" else [])


def signed(value):
    return value - (1 << 64) if value >= 1 << 63 else value


def winnow_by_hand(text, k=4, window=8):
    found = re.findall(r"\S{1,32}", text)
    if not found:
        return []
    def hashed(part):
        seed = 42
        for word in part:
            seed = xxhash.xxh64_intdigest(word.encode(), seed)
        return signed(seed) >> 20
    grams = [hashed(found[i : i + k]) for i in range(len(found) - k + 1)]
    if not grams:
        return [(hashed(found), 0)]
    chosen = []
    for i in range(max(1, len(grams) - window + 1)):
        part = grams[i : i + window]
        least = min(part)
        at = i + max(j for j, g in enumerate(part) if g == least)
        if (least, at) not in chosen:
            chosen.append((least, at))
    return chosen


def test_fingerprints_equal_brute_force(spark):
    random.seed(2)
    texts = [sentence(random.choice([0, 1, 3, 4, 11, 12, 40, 200])) for _ in range(40)]
    texts += [texts[4], None, "", "x" * 300, "é" * 33 + " a", sentence(9000)]
    docs = [(i * 3 if i % 7 else i * 3 + 1, t) for i, t in enumerate(texts)]
    table = spark.createDataFrame([(*d, "b", 1) for d in docs], "doc_id long, text string, span string, id int")
    rows = {r.doc_id: r for r in winnowing.fingerprints(table).collect()}
    order = sorted((d, t or "") for d, t in docs)
    assert len(rows) == len(docs)
    def as_text(chosen):
        return " ".join(f"{h & ((1 << 44) - 1):X}@{p}" for h, p in chosen)
    def like(a, b):
        a, b = ({h for h, _ in x} for x in (a, b))
        return len(a & b) / len(a | b) if a | b else 1.0
    for at, (doc_id, text) in enumerate(order):
        following = order[(at + 1) % len(order)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        own, changed, other = map(winnow_by_hand, (text, edited, following))
        row = rows[doc_id]
        assert row.n_chars == len(text)
        assert row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert (row.fingerprint, row.edited_fingerprint) == (as_text(own), as_text(changed))
        assert row.near_edited == pytest.approx(like(own, changed))
        assert row.near_next == pytest.approx(like(own, other))


def test_shared_runs_share_a_fingerprint():
    random.seed(3)
    vocabulary = [f"w{i}" for i in range(500)]
    for _ in range(50):
        run = sentence(11, vocabulary)
        a, b = (winnow_by_hand(f"{sentence(30, vocabulary)} {run} {sentence(9, vocabulary)}") for _ in "ab")
        assert {h for h, _ in a} & {h for h, _ in b}


def test_next_document_over_many_ranges(spark):
    ids = random.Random(4).sample(range(100_000), 2500)
    rows = [(i, f"t{i}") for i in ids] + [(None, "null"), (ids[0], "zz")]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = {(r.id, r.text): r.next_text for r in winnowing.with_next(table).where("not copy").collect()}
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    assert found == {row: order[(i + 1) % len(order)][1] for i, row in enumerate(order)}


def test_fingerprints_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert winnowing.fingerprints(empty).collect() == []


def lines_of(text):
    return [part.strip().lower() for part in re.split(r"(?<=[.!?])[ \t]+|\n", text or "") if part.strip()]


def test_repeated_runs_go_and_nothing_else(spark):
    random.seed(5)
    passage = [f"Passage line {i} here." for i in range(7)]
    docs = []
    for i in range(40):
        own = [f"Own {i} {j} {random.random()}." for j in range(random.randint(0, 9))]
        at = random.randint(0, len(own))
        docs.append((i, ("\n" if i % 2 else " ").join(own[:at] + (passage if i % 3 == 0 else []) + own[at:])))
    docs += [(90, "\n".join(f"Copy {i} of a line." for i in range(9)))]
    docs += [(89, docs[-1][1]), (91, None), (92, ""), (93, "A. A. A. A. A. A. A. A."), (0, docs[0][1])]
    table = spark.createDataFrame([(*d, "x", 7) for d in docs], "doc_id long, text string, runs string, hash int")
    rows = line_dedup.drop_repeated_runs(table).collect()
    assert rows[0].asDict().keys() == {"doc_id", "text", "runs", "hash", "n_removed", "emptied"}
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    first = docs[0][1]
    assert [r.text for r in by[0]] == [first, first]
    for doc_id, text in docs[1:40]:
        expected = [l for l in lines_of(text) if not l.startswith("passage")]
        assert lines_of(by[doc_id][0].text) == expected, doc_id
        assert by[doc_id][0].n_removed == (7 if doc_id % 3 == 0 else 0)
    assert len(lines_of(by[89][0].text)) == 9 and by[90][0].text == "" and by[90][0].emptied
    assert by[91][0].text is None and by[92][0].text == ""
    assert lines_of(by[93][0].text) == ["a."] * 8  # too few words
    # Of equal hashes the rightmost are selected, so the anchor is the second run of this text.
    tight = line_dedup.drop_repeated_runs(table.where("doc_id = 93"), least_words=0).collect()
    assert lines_of(tight[0].text) == ["a."] * 3


def test_every_run_of_three_lines_is_found(spark):
    random.seed(6)
    lines = [f"l{i}." for i in range(400)]
    earlier = [(i, " ".join(lines[i * 20 : i * 20 + 20])) for i in range(20)]
    later, expected = [], {}
    for i in range(60):
        own = [f"own {i} {j}." for j in range(6)]
        start = random.randint(0, 19) * 20 + random.randint(0, 20 - 9)
        run = lines[start : start + random.randint(3, 9)]
        later.append((100 + i, " ".join(own[:3] + run + own[3:])))
        expected[100 + i] = own
    table = spark.createDataFrame(earlier + later, "doc_id long, text string")
    found = {r.doc_id: r.text for r in line_dedup.drop_repeated_runs(table, least_words=0).collect()}
    for doc_id, own in expected.items():
        assert lines_of(found[doc_id]) == own
    for doc_id, text in earlier:
        assert found[doc_id] == text


def test_spared_copies_and_empty_tables(spark):
    text = " ".join(f"line {i}." for i in range(10))
    table = spark.createDataFrame([(1, text), (2, text)], "doc_id long, text string")
    assert {r.text for r in line_dedup.drop_repeated_runs(table, spare=0.5).collect()} == {text}
    assert line_dedup.drop_repeated_runs(table.where("false")).collect() == []


def test_word_hashes_depend_on_the_word_alone(monkeypatch):
    import pyarrow as pa

    from sievemark.llm import hashing

    texts = ["Ab cd", None, "", " cd\tAB ", "é" * 40 + " ab", "x" * 5000 + " cd"]
    whole, firsts = word_hashes(*text_bytes(pa.array(texts)))
    assert np.diff(firsts).tolist() == [2, 0, 0, 2, 2, 2]
    assert whole[0] == whole[3] == whole[5] and whole[1] == whole[2] == whole[7]
    monkeypatch.setattr(hashing, "PIECE", 16)
    again, _ = word_hashes(*text_bytes(pa.array(texts)), between=SPACES)
    assert again.tolist() == whole.tolist()
    assert [len(s) for s in slices(pa.array(texts), 10)] == [3, 1, 1, 1]


def test_long_lines_alone_and_in_pairs_are_found(spark):
    def own(i, n=6):
        return [f"Own {i} {j}." for j in range(n)]

    line = " ".join(f"w{i}" for i in range(60)) + "."
    pair = [" ".join(f"{c}{i}" for i in range(12)) + "." for c in "pq"]
    han = "".join(chr(0x4E00 + i) for i in range(40)) + "。"
    docs = []
    for i in range(40):
        middle = [[line], pair, [han]][i % 3]
        docs.append((i, "\n".join(own(i)[:3] + middle + own(i)[3:])))
    han_prose = "".join(chr(0x5E00 + i) for i in range(5)) + "！" + han + "".join(chr(0x6E00 + i) for i in range(5))
    docs += [(90, line), (91, han_prose)]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    found = {r.doc_id: r for r in line_dedup.drop_repeated_runs(table).collect()}
    for doc_id, text in docs[:3]:
        assert found[doc_id].text == text
    for doc_id, _ in docs[3:40]:
        assert found[doc_id].text == "\n".join(own(doc_id))
    assert found[90].emptied and found[91].text == han_prose.replace(han, "")


def test_common_pairs_inside_a_run_do_not_hide_it(spark):
    docs, expected = [], {}
    for i in range(24):
        def part(name, n):
            return " ".join(f"{name}{i}x{j}" for j in range(n)) + "."

        run = [part("w", 15), part("x", 5), part("y", 5), part("z", 15)]
        own = [f"own {i} {c}." for c in "abcdefgh"]
        docs.append((i, "\n".join([own[0], run[1], run[2], own[1]])))
        docs.append((100 + i, "\n".join([own[2], *run, own[3]])))
        docs.append((200 + i, "\n".join([own[4], *run, own[5]])))
        expected[200 + i] = "\n".join([own[4], own[5]])
    table = spark.createDataFrame(docs, "doc_id long, text string")
    found = {r.doc_id: r.text for r in line_dedup.drop_repeated_runs(table).collect()}
    assert {k: found[k] for k in expected} == expected


def test_only_near_copies_are_spared(spark):
    def lines(name, n):
        return [" ".join(f"{name}{i}x{j}" for j in range(8)) + "." for i in range(n)]

    a, b, c = (lines(x, 20) for x in "abc")
    mixed = a[:6] + b[:6] + lines("m", 2)  # most of it repeats, no one document's copy
    partly = c[:10] + lines("p", 8)
    copy = b[:19] + lines("q", 1)
    short = [" ".join(f"s{i}" for i in range(60)) + ".", "Own words."]
    first = lines("f", 30) + [short[0]]
    docs = [(1, a), (2, b), (3, c), (4, first), (10, mixed), (11, partly), (12, copy), (13, short), (14, a)]
    table = spark.createDataFrame([(i, "\n".join(t)) for i, t in docs], "doc_id long, text string")
    rows = {r.doc_id: r for r in line_dedup.drop_repeated_runs(table, spare=0.5).collect()}
    for doc_id, text in [*docs[:4], docs[6], docs[8]]:
        assert rows[doc_id].text == "\n".join(text) and rows[doc_id].n_removed == 0
    assert lines_of(rows[10].text) == lines("m", 2)
    assert lines_of(rows[11].text) == lines("p", 8)
    assert lines_of(rows[13].text) == ["own words."]
