"""Toxicity, URL rules, pseudonyms: accuracy on held-out rows, rules by hand, round trips."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from sievemark.llm import pseudonyms, toxicity, url_rules

GOOD = [f"word{i}" for i in range(300)]
BAD = ["awful", "nasty", "vile"]


def toxic_tables(spark, n=900):
    random.seed(7)
    docs, labels = [], []
    for i in range(n):
        own = [random.choice(GOOD) for _ in range(random.randint(0, 60))]
        bad = i % 5 == 0
        if bad:
            for _ in range(2):
                own.insert(random.randint(0, len(own)), random.choice(BAD) + random.choice(["", ",", "!"]))
        docs.append((i, " ".join(own), "en" if i % 2 else "fr", "clash"))
        labels.append((i, 1, int(bad)))
    docs += [(n, None, None, "x"), (n + 1, "", "en", "x"), (None, "a nasty word1", "xx", "x")]
    labels += [(n + 5, 0, 1), (None, 0, 1), (3, 0, 0), (7, 0, None)]
    return (
        spark.createDataFrame(docs, "doc_id long, text string, lang string, kept string"),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
    )


def test_held_out_documents_are_told_apart(spark):
    docs, labels = toxic_tables(spark)
    rows = toxicity.judge(docs, labels).collect()
    assert len(rows) == 903 and "kept" in rows[0].asDict()
    held = [r for r in rows if r.held_out and r.text]
    assert len(held) > 200
    right = sum(r.predicted == (r.doc_id % 5 == 0) for r in held)
    assert right / len(held) > 0.98
    assert sum(r.rejected == (r.doc_id % 5 == 0) for r in held) / len(held) > 0.98
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    empty = {r.score for r in rows if not r.text}
    assert len(empty) == 1


def test_labels_of_held_out_rows_are_never_read(spark):
    docs, labels = toxic_tables(spark, 300)
    flipped = labels.withColumn(
        "toxic", F.when(toxicity.is_held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic"))
    )
    first, second = (
        {(r.doc_id, r.text): r.score for r in toxicity.judge(docs, given).collect()}
        for given in (labels, flipped)
    )
    assert first == second
    assert {r.held_out for r in docs.where("doc_id is null").select(
        toxicity.is_held_out().alias("held_out")).collect()} == {False}


def test_thresholds_come_from_all_labelled_rows(spark):
    rows = [(i, f"{GOOD[i % 7]} " + ("awful" if i % 4 == 0 else "fine"), "rare" if i % 20 < 2 else "en")
            for i in range(1200)]
    # In the rare language the telling word is as often used of clean documents.
    labels = [(i, int(i % 4 == 0 and (lang == "en" or i % 40 == 0))) for i, _, lang in rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame(labels, "doc_id long, toxic int")
    may_learn = ~toxicity.is_held_out()
    sample = toxicity.training_sample(docs, labels, may_learn, sample_docs=150)
    model = toxicity.calibrate(toxicity.train(sample), docs, labels, may_learn)
    assert len(sample) < 300 and len(set(model.fitted)) <= len(sample)
    assert set(model.thresholds) == {"rare", "en"}
    judged = toxicity.score(docs, model).join(labels, "doc_id").where(may_learn).collect()
    unseen = [r for r in judged if r.doc_id not in set(model.fitted.tolist())]
    over = [r.toxic for r in unseen if r.lang == "en" and r.score >= model.thresholds["en"]]
    assert over and sum(over) / len(over) >= toxicity.PRECISION


def test_the_sample_stays_in_tasks(spark, monkeypatch):
    docs, labels = toxic_tables(spark, 400)
    may_learn = ~toxicity.is_held_out()
    here = toxicity.train(toxicity.training_sample(docs, labels, may_learn))
    there = toxicity.fitted_model(toxicity.sample_rows(docs, labels, may_learn))
    for name in ("words", "stems", "word_rows", "stem_rows", "out", "fitted"):
        assert np.array_equal(getattr(here, name), getattr(there, name))
    # Neither words nor texts come to the driver, only the model and counted scores.
    monkeypatch.setattr(toxicity, "training_sample", None)
    monkeypatch.setattr(type(docs), "toPandas", None)
    seen, to_arrow = [], type(docs).toArrow
    monkeypatch.setattr(type(docs), "toArrow", lambda self: seen.append(self.columns) or to_arrow(self))
    assert toxicity.judge(docs, labels).where("rejected").count() > 50
    assert seen and not any({"words", "stems", "text"} & set(columns) for columns in seen)


def test_scores_without_labels_and_of_empty_tables(spark):
    docs, labels = toxic_tables(spark, 30)
    assert {r.score for r in toxicity.judge(docs, labels.where("false")).collect()} == {0.0}
    assert toxicity.judge(docs.where("false"), labels).collect() == []


def test_long_texts_score_as_in_one_run(spark, monkeypatch):
    import pyarrow as pa

    docs, labels = toxic_tables(spark, 400)
    model = toxicity.train(toxicity.training_sample(docs, labels, ~toxicity.is_held_out()))
    random.seed(8)
    texts = pa.array([" ".join(random.choice(GOOD + BAD) for _ in range(n)) for n in (0, 1, 2, 50, 333, 7)])
    whole = model.score(texts)
    for run in (1, 3, 10, 64):
        monkeypatch.setattr(toxicity, "_RUN", run)
        assert np.allclose(model.score(texts), whole)


LISTED = [
    url_rules.Listed("block", "net/"),
    url_rules.Listed("allow", "example.net/en/"),
    url_rules.Listed("block", "example.com/de/"),
    url_rules.Listed("allow", "org/fr/"),
]


def rule_by_hand(url):
    found = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (found[1], found[2]) if found else ("", "")
    host = "".join(c.lower() if c.isascii() else c for c in host)
    best = None
    for one in LISTED:
        h, p = one.rule.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            best = one if best is None or len(one.rule) > len(best.rule) else best
    return host, path, best and best.rule, best and best.verdict


def test_listed_rules(spark):
    urls = [
        "https://A.Example.NET/en/x?y=/de/", "http://example.net/fr/", "https://net/", "https://net",
        "x://example.com/de/", "x://example.com/de", "://q.org/fr/#a", "http://org/fr/", "http://borg/fr/",
        "no scheme", None, "", "http://", "http://É.net/a\nb", "a://b://c.net/", "http://h?x.net/",
    ]
    pages = spark.createDataFrame(
        [(i, u, "h", "clash") for i, u in enumerate(urls)] + [(None, urls[0], None, None)],
        "page_id long, url string, host string, verdict string",
    )
    labels = spark.createDataFrame([], "page_id long, bad boolean")
    rows = url_rules.judge(pages, labels, LISTED).collect()
    assert len(rows) == len(urls) + 1
    for r in rows:
        host, path, rule, verdict = rule_by_hand(urls[r.page_id or 0])
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, rule, verdict or "allow")
    assert url_rules.judge(pages.where("false"), labels, LISTED).collect() == []


def test_mined_rules_against_brute_force(spark):
    random.seed(9)
    pages, labels = [], []
    for i in range(600):
        spam, shop = random.random() < 0.2, random.random() < 0.5
        host = ("pills." if spam else "") + random.choice(["a", "b", "c"]) + ".example.org"
        pages.append((i, f"https://{host}/{'buy' if shop else 'read'}/{i}?ref={i}"))
        labels.append((i, spam and shop))
    table = spark.createDataFrame(pages, "page_id long, url string")
    given = spark.createDataFrame(labels, "page_id long, bad boolean")
    rules, seen = url_rules.mine(table.join(given, "page_id").select("url", "bad"))
    assert ("host=pills", "path=buy") in {r.tokens for r in rules}
    owned = {r.page_id: set(r.t) for r in table.select("page_id", url_rules.tokens(F.col("url")).alias("t")).collect()}
    bad = dict(labels)
    for r in rules:
        holding = [i for i, t in owned.items() if t >= set(r.tokens)]
        assert r.confidence == pytest.approx(sum(bad[i] for i in holding) / len(holding))
        assert r.support == pytest.approx(sum(bad[i] for i in holding) / len(owned))
        assert r.confidence >= 0.7 and len(r.tokens) <= 3
    for row in url_rules.judge(table, given, []).collect():
        assert row.verdict == ("block" if any(owned[row.page_id] >= set(r.tokens) for r in rules) else "allow")
        assert (row.verdict == "block") == bad[row.page_id]


VALUES = {
    "phone": ["+1 (988) 555-2485", "555-123-4567", "+49 30 1234567", "(212) 555-0187"],
    "card": ["4041894974608795", "4111 1111 1111 1111", "5500-0000-0000-0004"],
    "email": ["bosbt.42@mail8.example.com", "A@b.co"],
    "ip": ["70.123.182.155", "0.0.0.0", "255.255.255.255"],
    "secret": ["MD62HKU6VBLCCCCE", "e3b3ed3cc8548923d6"],
    "ssn": ["078-05-1120"],
    "iban": ["DE89370400440532013000", "GB82 WEST 1234 5698 7654 32"],
    "date": ["1987-06-05", "31/12/2001", "05.06.1987", "1900-01-01", "2099-12-31"],
}


def test_pseudonyms_keep_format_and_can_be_revealed():
    names = pseudonyms.Pseudonyms(b"key")
    finders = {}
    for kind, _, _, valid in pseudonyms._FINDERS:
        finders.setdefault(kind, valid)
    for kind, values in VALUES.items():
        for value in values:
            made = names.of(kind, value)
            assert made != value and names.reveal(kind, made) == value
            assert re.sub("[0-9]", "9", re.sub("[A-Za-z]", "a", made)) == re.sub(
                "[0-9]", "9", re.sub("[A-Za-z]", "a", value)
            ) or kind in ("secret", "email", "iban")
            assert len(made) == len(value) and finders.get(kind, lambda _: True)(made)
    assert names.of("date", "1987-06-05").split("-") == names.of("date", "05/06/1987").split("/")[::-1]
    assert pseudonyms.Pseudonyms(b"other").of("card", VALUES["card"][0]) != names.of("card", VALUES["card"][0])


def test_permutations_are_bijections():
    names = pseudonyms.Pseudonyms(b"key")
    for radices in ([10, 10, 3], [2], [26, 2, 2, 5], [7, 7]):
        space = [list(map(int, i)) for i in np.ndindex(*radices)]
        images = [tuple(names.permute(s, radices, "k")) for s in space]
        assert len(set(images)) == len(space)
        assert [names.permute(list(i), radices, "k", back=True) for i in images] == space


def test_texts_are_pseudonymized_and_linked(spark):
    text = "Mail bosbt.42@mail8.example.com or +1 (988) 555-2485, card 4041894974608795. v2.0.1 and 1234567890123456."
    rows = [(1, text, "x"), (2, f"again 4041894974608795; {text}", "y"), (3, None, None), (4, "", ""), (None, "none", "z")]
    table = spark.createDataFrame(rows, "doc_id long, text string, pii_kind string")
    found = {r.doc_id: r for r in pseudonyms.pseudonymize(table, b"k").collect()}
    assert [p.kind for p in found[1].pii] == ["email", "phone", "card"]
    for value in ("bosbt.42", "555-2485", "4041894974608795"):
        assert value not in found[1].text and value not in found[2].text
    assert "v2.0.1 and 1234567890123456." in found[1].text
    card = found[1].text[found[1].pii[2].start :][:16]
    assert found[2].text.count(card) == 2 and pseudonyms.luhn(card)
    assert found[3].text is None and found[4].text == "" and found[None].text == "none"
    assert pseudonyms.pseudonymize(table.where("false"), b"k").collect() == []
