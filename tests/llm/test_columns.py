"""Extra columns whose names are those of results pass all stages of the pipeline unchanged."""

import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sievemark.llm import bpe, decontamination, line_dedup, toxicity
from sievemark.llm.queries import tokenizer_path
from sievemark.plans.durable import stored

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
# Names of results and of columns that operators use inside, of other types than theirs.
EXTRA = {
    "score": "'mine'", "rejected": "0.5D", "threshold": "array(1)", "held_out": "3", "emptied": "'no'",
    "n_removed": "cast(null AS string)", "contamination": "true", "n_hit": "'x'", "items": "1.5D", "ids": "'ids'",
    "decoded": "7", "kept": "'k'", "label": "'l'", "version": "'v'", "id": "'i'", "runs": "2", "a b": "1",
    "dot.ted`": "2", "number": "cast(doc_id AS string)",
}


@pytest.fixture(scope="module")
def docs(spark):
    given = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    return stored(given.select("*", *[F.expr(value).alias(name) for name, value in EXTRA.items()]), "extra")


def test_stages_keep_every_column(spark, docs):
    plain = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, SF_DIR)
        without = stage(spark, plain, SF_DIR)
        if name == "bpe":
            assert [c for c in made.columns if c not in without.columns] == [c for c in EXTRA if c != "ids"]
        else:
            assert made.dtypes == docs.dtypes, name
        made, without = stored(made, "stage"), stored(without, "stage")
        kept = [f"`{c.replace('`', '``')}`" for c in EXTRA if not (name == "bpe" and c == "ids")]
        expected = docs.select("doc_id", *[F.col(c) for c in kept])
        assert made.select("doc_id", *[F.col(c) for c in kept]).exceptAll(expected).count() == 0, name
        assert made.count() == without.count() > 0
        assert made.select(*without.columns).exceptAll(without).count() == 0
        if name != "bpe":
            docs, plain = made, without


def test_operators_replace_columns_named_like_their_results(spark, docs):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    some = docs.where("doc_id < 60")
    assert dict(toxicity.judge(some, labels).dtypes)["score"] == "double"
    assert dict(line_dedup.drop_repeated_runs(some).dtypes)["n_removed"] == "bigint"
    assert decontamination.contamination(some, items).select("contamination.n_hit", "n_hit").count() == 60
    encoded = bpe.encode(some, tokenizer_path())
    assert dict(encoded.dtypes)["ids"].startswith("array") and encoded.columns.count("decoded") == 1
