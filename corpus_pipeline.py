"""A corpus pipeline: documents pass one operator after another, each written and read again.

Every stage takes the documents that the one before it kept, whole, and returns their columns; the last
adds their tokens. Extra columns of documents, whatever their names, pass all stages untouched: a stage hands them
to its operator as one column, and takes them out again. A column with the name of one that the last
stage adds is replaced by it, and so is its text. Empty tables pass through.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sievemark.llm import bpe, decontamination, line_dedup, near_dedup, toxicity
from sievemark.llm.grouping import quoted
from sievemark.llm.queries import BATCH_ROWS, tokenizer_path
from sievemark.plans.durable import scratch, scratch_path

# Near-duplicate removal, which comes next, needs whole texts. A text of which half repeats stays whole
# if it is a near copy of one earlier document by the likeness of that stage; all others are cut.
SPARE = 0.5
LIKENESS = (5, 80)
_SEEN = ["doc_id", "text", "lang"]
_REST = "columns of the document"  # no operator has a result of that name


def _packed(docs: DataFrame) -> DataFrame:
    """Documents as operators see them: id, text and language, and all else in one column."""
    rest = [F.col(quoted(name)) for name in docs.columns if name not in _SEEN]
    return docs.select(*_SEEN, (F.struct(*rest) if rest else F.lit(True)).alias(_REST))


def _unpacked(docs: DataFrame, columns: list[str], **changed: Column) -> DataFrame:
    """The columns as they were given, but for those that a stage changes."""
    given = {name: F.col(name if name in _SEEN else f"`{_REST}`.{quoted(name)}") for name in columns} | changed
    return docs.select(*[given[name].alias(name) for name in columns])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score reaches the threshold of their language go."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    judged = toxicity.judge(_packed(docs), labels)
    return _unpacked(judged.where(~F.col("rejected")), docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeated runs of lines go, and documents of which nothing is left."""
    cut = line_dedup.drop_repeated_runs(_packed(docs), spare=SPARE, likeness=LIKENESS)
    size = F.char_length("text").cast(docs.schema["n_chars"].dataType)
    return _unpacked(cut.where(~F.col("emptied")), docs.columns, n_chars=size)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: the one with the least id."""
    return _unpacked(near_dedup.keep_one(_packed(docs), *LIKENESS), docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    checked = decontamination.contamination(_packed(docs), items)
    return _unpacked(checked.where(~F.col("contamination.contaminated")), docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The columns of each document but its text, its tokens, and a digest of what they decode to."""
    encoded = bpe.encode(_packed(docs), tokenizer_path())
    tokens = {
        "n_tokens": F.size("ids").cast("bigint"),
        "ids": F.col("ids"),
        "decoded_sha256": F.sha2("decoded", 256),
    }
    kept = [name for name in docs.columns if name not in ("text", *tokens)]
    return _unpacked(encoded, [*kept, *tokens], **tokens)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("bpe", encode),
]

# Training a classifier and byte-pair encoding are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        # What a stage writes meanwhile goes when it is done.
        path = scratch_path(spark, name)
        with scratch(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
