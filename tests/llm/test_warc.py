"""Archives written and read back, against a plain grouping of the payloads."""

import hashlib
import random

import pytest

from sievemark.llm import warc

MARK = b"\r\n\r\nWARC/1.1\r\n"


def pages():
    random.seed(61)
    long = b"<p>" + b"copied " * 30
    payloads = [
        long, long + b"\r\n", long + b"\r\n\r\n", long + b"\r\n\r\n\r\n", b"\r\n\r\n" + long, MARK, b"WARC/1.1\r\n", b"x\r\n\r\nWARC/1.1",
        b"a" * 40 + MARK + b"Content-Length: 3\r\n\r\nabc" + MARK * 3 + b"b" * 100, b"", None, b"x" * 99, b"x" * 100,
        "hé 日本".encode() * 20, b"\xff\xfe\x00broken" * 20, b"\r", b"\n" * 120, b"\r\n" * 60,
    ]
    urls = ["https://a.example/p?q=1#f", "http://b.example", "no url", "", None, "https://c.example/é\r\nX: 1", "ftp://d"]
    rows = [(i, random.choice(urls), p) for i, p in enumerate(payloads)]
    # A third of the pages are copies of one.
    rows += [(100 + i, random.choice(urls), long if i % 3 == 0 else random.choice(payloads)) for i in range(90)]
    return [*rows, (0, None, long), (0, None, long), (None, "https://n.example/", long), (None, None, b"y" * 200), (None, None, b"y" * 200)]


def by_hand(rows):
    first = {}
    for page, _, payload in rows:
        if len(payload or b"") >= 100 and page is not None:
            first[payload] = min(page, first.get(payload, page))
    found = []
    for page, _, payload in rows:
        payload = payload or b""
        of = first.get(payload)
        again = of is not None and of != page
        found.append((page, len(payload), hashlib.sha256(payload).hexdigest(), "revisit" if again else "response", of if again else None))
    return sorted(found, key=repr)


@pytest.mark.parametrize("compression,split", [("gzip", "128m"), ("none", "2k")])
@pytest.mark.parametrize("most", [None, 0])
def test_round_trip_equals_brute_force(spark, tmp_path, compression, split, most):
    rows = pages()
    table = spark.createDataFrame(
        [(*r, 7, "clash") for r in rows], "page_id long, url string, html binary, payload int, type string"
    ).repartition(3)
    decided = warc.decided(table, max_broadcast=most, hot_rows=3 if most == 0 else None)
    warc.write_archives(decided, f"{tmp_path}/archives", compression=compression)
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        records = warc.read_records(spark, f"{tmp_path}/archives")
        assert records.count() == 3 * len(rows)
        found = warc.captures(records).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.type, r.refers_to) for r in found]
    assert sorted(got, key=repr) == by_hand(rows)
    assert len({r.record_id for r in found}) == len(rows)
    for r in found:
        assert (r.payload is None) == (r.type == "revisit")
        assert r.payload is None or hashlib.sha256(r.payload).hexdigest() == r.payload_digest
        assert r.request.block.startswith(b"GET /") and r.request.block.endswith(b"\r\n\r\n")
        assert f"WARC-Concurrent-To: {r.record_id}" in r.request.head
        assert f"WARC-Concurrent-To: {r.record_id}" in r.metadata.head
        assert r.target_uri is None or r.target_uri.isascii()


def test_text_pages_and_incomplete_transactions(spark, tmp_path):
    table = spark.createDataFrame([(1, "https://a.example/x/y?z", "<p>é</p>"), (2, None, None)], "page_id long, url string, html string")
    warc.write_archives(warc.decided(table), f"{tmp_path}/archives")
    records = warc.read_records(spark, f"{tmp_path}/archives")
    alone = warc.captures(records.where("type = 'response'")).collect()
    assert [(r.page_id, r.request, r.metadata) for r in alone] == [(None, None, None)] * 2
    (one,) = warc.captures(records).where("page_id = 1").collect()
    assert one.payload.decode() == "<p>é</p>" and one.target_uri == "https://a.example/x/y?z"
    assert one.request.block == b"GET /x/y?z HTTP/1.1\r\nHost: a.example\r\n\r\n"


def test_a_record_of_another_length_is_an_error(spark, tmp_path):
    good = "WARC/1.1\r\nWARC-Type: metadata\r\nContent-Length: 2\r\n\r\nab\r\n\r\n"
    for name, text in (("cut", good + good.replace(": 2", ": 3")), ("none", good.replace("Content-Length", "X"))):
        (tmp_path / name).mkdir()
        (tmp_path / name / "a.warc").write_bytes(text.encode())
        with pytest.raises(Exception, match="not as long as it says"):
            warc.read_records(spark, f"{tmp_path}/{name}").collect()
    (tmp_path / "good").mkdir()
    (tmp_path / "good" / "a.warc").write_bytes((good * 3).encode())
    assert [bytes(r.block) for r in warc.read_records(spark, f"{tmp_path}/good").collect()] == [b"ab"] * 3


def test_archive_of_no_pages(spark, tmp_path):
    table = spark.createDataFrame([], "page_id long, url string, html string")
    warc.write_archives(warc.decided(table), f"{tmp_path}/archives")
    assert warc.captures(warc.read_records(spark, f"{tmp_path}/archives")).collect() == []
