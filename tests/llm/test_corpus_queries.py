"""Corpus queries against their SQL, and what the pipeline must keep to."""

import hashlib
import os

import pytest
from compare import connect, differences

import corpus_pipeline
from sievemark.llm import near_dedup
from sievemark.llm.queries import ORACLES, QUERIES, tokenizer_path
from sievemark.plans.durable import stored

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


def test_one_query_per_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, name):
    assert differences(spark, QUERIES[name], ORACLES[name], SF_DIR, connect(SF_DIR)) == []


@pytest.mark.parametrize(
    "name,table,key",
    [
        ("op2_fingerprints", "documents", "doc_id"),
        ("op3_line_dedup", "documents", "doc_id"),
        ("op4_pseudonyms", "documents", "doc_id"),
        ("op5_url_rules", "pages", "page_id"),
        ("op6_toxicity", "documents", "doc_id"),
        ("op8_near_duplicates", "documents", "doc_id"),
        ("op10_html_text", "pages", "page_id"),
    ],
)
def test_query_returns_every_row(spark, name, table, key):
    rows = [r[0] for r in QUERIES[name](spark, SF_DIR).select(key).collect()]
    given = [r[0] for r in spark.read.parquet(f"{SF_DIR}/{table}.parquet").select(key).collect()]
    assert sorted(rows) == sorted(given)


def test_tokens_equal_the_library(spark):
    tokenizers = pytest.importorskip("tokenizers")
    library = tokenizers.Tokenizer.from_file(tokenizer_path())
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = QUERIES["op7_bpe"](spark, SF_DIR).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_pipeline_keeps_its_promises(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "line_dedup", "near_dedup", "decontamination", "bpe"]
    inputs = [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        inputs.append(stored(stage(spark, inputs[-1], SF_DIR), "stage"))
        assert inputs[-1].columns == docs.columns
    ids = [{r.doc_id for r in table.select("doc_id").collect()} for table in inputs]
    assert all(later < earlier or later == earlier for earlier, later in zip(ids, ids[1:]))
    clean = {i for i, toxic in labels.items() if toxic == 0}
    assert len(clean - ids[1]) <= 0.01 * len(clean)
    assert len({i for i, toxic in labels.items() if toxic} - ids[1]) >= 0.85 * sum(labels.values())
    assert len(ids[1] - ids[2]) <= 0.02 * len(ids[1])
    again = near_dedup.near_duplicates(inputs[3], 5, 80).where("not kept")
    assert again.collect() == []
    named = inputs[3].select("doc_id", "text")
    checked = corpus_pipeline.decontamination.contamination(
        named, spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    )
    contaminated = {r.doc_id for r in checked.where("contamination.contaminated").collect()}
    assert ids[4] == ids[3] - contaminated and contaminated
    out = corpus_pipeline.STAGES[-1][1](spark, inputs[-1], SF_DIR).collect()
    assert {r.doc_id for r in out} == ids[4] and all(r.n_tokens == len(r.ids) for r in out)


def test_pipeline_of_empty_documents(spark, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        table = spark.read.parquet(f"{SF_DIR}/{name}.parquet")
        table.where("false").write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
