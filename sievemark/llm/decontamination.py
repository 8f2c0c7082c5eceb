"""Benchmark decontamination: a prefix-filtered set join, as DataFrame operations only.

A window is ``size`` consecutive words of a benchmark item; an item of fewer words is one
window. A window is seen as its shingles of three words. A document that contains the window
contains each shingle, so one of them is enough to find it: the rarest in the corpus. The
steps are

1. occurrences: places of documents where any shingle of the benchmark stands;
2. rarity: how often each shingle occurs, counted over all documents;
3. candidates: occurrences of the rarest shingle of each window, that leave room for the
   words before and after it (bounds on position and length);
4. verification: the window stands at a candidate if all its shingles stand there, in order.

Only matching places leave the scan of the documents: texts are never shuffled.

Defined results: a null text has no words; an item without words has no window; an item that
is null or repeated counts once under its id, as text; repeated documents each have a result.
Shingles are compared as 64-bit hashes of their words. Other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..plans.durable import stored
from .grouping import quoted

WINDOW = 10
SHINGLE = 3
MAX_BROADCAST = 1_000_000  # rows of three numbers
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_ANY_CASE_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words(text: Column) -> Column:
    """The words of a text, A-Z in lower case; none for null."""
    text = F.coalesce(text, F.lit(""))
    # `lower` also changes letters beyond A-Z, but a text of single bytes has none.
    low = F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, _UPPER, _UPPER.lower())
    )
    return F.regexp_extract_all(low, F.lit(_WORD), F.lit(0))


def count_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(_ANY_CASE_WORD)).cast("bigint")


def _hashed(found: Column, size: int) -> Column:
    """Hashes of all runs of ``size`` words; the size is part of the hash."""
    return F.transform(
        F.when(F.size(found) >= size, F.sequence(F.lit(0), F.size(found) - size)).otherwise(
            F.array().cast("array<int>")
        ),
        lambda i: F.xxhash64(F.lit(size), *[F.get(found, i + j) for j in range(size)]),
    )


def _bounded(small: DataFrame, rows: int) -> DataFrame:
    """Marked for broadcast if its measured size allows it; else it is shuffled."""
    return F.broadcast(small) if rows <= MAX_BROADCAST else small


def windows(items: DataFrame, size: int = WINDOW, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(window, item, length, shingle, offset): the shingles of all windows. Stored."""
    found = items.select(F.col(item_col).cast("string").alias("item"), words(F.col(text_col)).alias("w"))
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - (size - 1)))
    each = (
        found.where(F.size("w") > 0)
        .select("item", F.explode(F.transform(starts, lambda i: F.slice("w", i, size))).alias("w"))
        .withColumn("window", F.xxhash64("w"))
        .withColumn("length", F.size("w"))
    )
    shingle = F.when(F.size("w") >= SHINGLE, _hashed(F.col("w"), SHINGLE))
    for few in range(1, SHINGLE):
        shingle = shingle.when(F.size("w") == few, _hashed(F.col("w"), few))
    return stored(
        each.select("window", "item", "length", F.posexplode(shingle).alias("offset", "shingle"))
        .distinct(),
        "windows",
    )


def occurrences(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, version, n_words, place, shingle) wherever a wanted shingle stands. Stored.

    ``version`` tells texts apart that share an id.
    """
    rows = docs.select(
        F.col(id_col).alias("id"), F.xxhash64(text_col).alias("version"), words(F.col(text_col)).alias("w")
    )
    total = wanted.count()
    sizes = [row[0] for row in wanted.select("size").distinct().collect()]  # at most three
    parts = []
    for size in sorted(sizes):
        of_size = wanted.where(F.col("size") == size).select("shingle")
        parts.append(
            rows.select(
                "id",
                "version",
                F.size("w").alias("n_words"),
                F.posexplode(_hashed(F.col("w"), size)).alias("place", "shingle"),
            ).join(_bounded(of_size, total), "shingle")
        )
    if not parts:
        none = rows.where("false").select("id", "version", F.size("w").alias("n_words"))
        parts = [none.select("*", F.lit(0).alias("place"), F.lit(0).cast("bigint").alias("shingle"))]
    return stored(reduce(DataFrame.unionByName, parts), "occurrences")


def hits(
    docs: DataFrame,
    items: DataFrame,
    size: int = WINDOW,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """(id, version, start, length, window) where windows stand, and (window, item)."""
    parts = windows(items, size, item_col, item_text_col)
    wanted = parts.select("shingle", F.least("length", F.lit(SHINGLE)).alias("size")).distinct()
    found = occurrences(docs, wanted, id_col, text_col)
    rarity = found.groupBy("shingle").agg(F.count("*").alias("seen"))
    # A window with a shingle that occurs nowhere occurs nowhere.
    per_window = (
        parts.select("window", "length", "offset", "shingle").distinct().join(rarity, "shingle")
    )
    chosen = stored(
        per_window.groupBy("window", "length")
        .agg(
            F.count("*").alias("present"),
            F.min(F.struct("seen", "shingle", "offset")).alias("rarest"),
        )
        .where(F.col("present") == F.greatest(F.lit(1), F.col("length") - (SHINGLE - 1)))
        .select("window", "length", "present", "rarest.shingle", "rarest.offset"),
        "prefixes",
    )
    n_chosen = chosen.count()
    start = F.col("place") - F.col("offset")
    candidates = (
        found.join(_bounded(chosen, n_chosen), "shingle")
        .where((start >= 0) & (start + F.col("length") <= F.col("n_words")))
        .select("id", "version", start.alias("start"), "window", "length", "present")
        # Rows equal in id and text have the same ones.
        .distinct()
    )
    # What must stand where, for each candidate.
    shingles = per_window.select("window", F.col("offset").alias("step"), F.col("shingle").alias("must"))
    needed = candidates.join(_bounded(shingles, n_chosen * size), "window").select(
        "id", "version", "start", "window", "length", "present",
        (F.col("start") + F.col("step")).alias("place"), F.col("must").alias("shingle"),
    )
    there = found.select(
        F.col("id").alias("there_id"), "version", "place", "shingle"
    ).distinct()
    same = (
        needed["id"].eqNullSafe(there["there_id"])
        & (needed["version"] == there["version"])
        & (needed["place"] == there["place"])
        & (needed["shingle"] == there["shingle"])
    )
    verified = (
        needed.join(there, same)
        .groupBy(needed["id"], needed["version"], "start", "window", "length", "present")
        .agg(F.count("*").alias("standing"))
        .where("standing = present")
        .select("id", "version", "start", "length", "window")
    )
    return verified, parts.select("window", "item").distinct()


def contamination(
    docs: DataFrame,
    items: DataFrame,
    size: int = WINDOW,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """Per document: its words, words inside windows of items, and those items.

    All columns of ``docs`` are kept; the results follow them in a struct ``contamination``, which replaces a
    column of that name.
    """
    docs = docs.drop("contamination")
    found, of_items = hits(docs, items, size, id_col, text_col, item_col, item_text_col)
    found = stored(found, "hits")
    order = Window.partitionBy("id", "version").orderBy("start", "end")
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    covered = (
        found.select("id", "version", "start", (F.col("start") + F.col("length")).alias("end"))
        .distinct()
        .withColumn("from", F.greatest("start", F.coalesce(before, F.lit(0))))
        .groupBy("id", "version")
        .agg(F.sum(F.greatest(F.lit(0), F.col("end") - F.col("from"))).alias("n_hit"))
    )
    named = (
        found.select("id", "version", "window")
        .distinct()
        .join(of_items, "window")
        .groupBy("id", "version")
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
    )
    joined = covered.join(
        named.select(F.col("id").alias("named_id"), F.col("version").alias("named_version"), "items"),
        F.col("id").eqNullSafe(F.col("named_id")) & (F.col("version") == F.col("named_version")),
    ).select(F.struct("id", "version").alias("__of"), "n_hit", "items")
    per_doc = stored(
        joined.select(
            F.col("__of.id").alias("__id"), F.col("__of.version").alias("__version"),
            F.col("n_hit").alias("__n_hit"), F.col("items").alias("__items"),
        ),
        "contaminated",
    )
    # Both the rows and the ids they list are counted.
    size_of = per_doc.agg(F.sum(F.lit(1) + F.size("__items"))).first()[0] or 0
    per_doc = _bounded(per_doc, size_of)
    items_of = F.coalesce("__items", F.array().cast("array<string>"))
    n_hit = F.coalesce("__n_hit", F.lit(0)).cast("bigint")
    return (
        docs.withColumn("__version_of", F.xxhash64(text_col))
        .join(
            per_doc,
            docs[id_col].eqNullSafe(F.col("__id")) & (F.col("__version_of") == F.col("__version")),
            "left",
        )
        .select(
            *[docs[quoted(name)] for name in docs.columns],
            F.struct(
                count_words(docs[text_col]).alias("n_words"),
                n_hit.alias("n_hit"),
                items_of.alias("items"),
                (n_hit > 0).alias("contaminated"),
            ).alias("contamination"),
        )
    )
