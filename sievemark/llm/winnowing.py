"""Document fingerprints by winnowing, as Spark expressions only.

A text is a sequence of words: runs without white space, cut after 32 characters so that
text without spaces has words too. Every ``k`` consecutive words are hashed; of every
``window`` consecutive hashes the smallest is selected, the rightmost one on ties, and a
selected hash keeps its position. Two texts that share a run of ``window + k - 1`` words
therefore share a selected hash, and the positions say where the run stands in each.

Defined results: a null text is an empty one and has an empty fingerprint; a text with fewer
than ``k`` words has one hash, of all its words; one with fewer than ``window`` hashes is one
window. Equal texts have equal fingerprints wherever they stand. Repeated rows each
have their own result; columns other than id and text are ignored.

Spark's array functions carry no state from one element to the next, so a k-gram is hashed as
a whole instead of updating a rolling sum; the hashes are the same function of the k-gram
either way. Long texts are worked on in blocks that overlap by a window.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

K = 4
WINDOW = 8
BLOCK = 4096  # hashes in a block
WORD = r"\S{1,32}"
_LOW = 20  # bits of a selected value that hold the place in a block or text
_MASK = (1 << _LOW) - 1
_IDS_PER_RANGE = 500
_MAX_RANGES = 10_000


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once: a lambda's argument is not recomputed."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _sliding_min(keys: Column, window: int) -> Column:
    """Minima of all runs of ``window`` elements, by doubling; runs at the end are shorter."""
    span, current = 1, keys
    while span < window:
        step = min(span, window - span)
        current = _let(current, _pairs(step))
        span += step
    return current


def _pairs(step: int) -> Callable[[Column], Column]:
    def smaller(a: Column) -> Column:
        later = F.slice(a, step + 1, F.greatest(F.size(a) - step, F.lit(0)))
        return F.zip_with(a, later, lambda x, y: F.least(x, y))

    return smaller


def _block(words: Column, start: Column, grams: Column, k: int, window: int) -> Column:
    """Selected (hash, position) of the k-grams of one block, in order of position."""
    size = F.least(F.lit(BLOCK + window - 1), grams - start)
    # The place in the block counts down, so that equal hashes order the rightmost first.
    keys = F.transform(
        F.sequence(F.lit(0), size - 1),
        lambda i: F.xxhash64(*[F.get(words, start + i + j) for j in range(k)])
        .bitwiseAND(F.lit(~_MASK))
        .bitwiseOR(F.lit(_MASK) - i.cast("bigint")),
    )
    full = F.greatest(F.lit(1), size - (window - 1))
    chosen = F.array_distinct(F.slice(_sliding_min(keys, window), F.lit(1), full))
    # The first window of a text with fewer hashes than a window holds all of them.
    return F.transform(
        chosen,
        lambda key: F.struct(
            F.shiftright(key, _LOW).alias("hash"),
            (start + (F.lit(_MASK) - key.bitwiseAND(F.lit(_MASK)))).cast("int").alias("position"),
        ),
    )


def winnow(text: Column, k: int = K, window: int = WINDOW) -> Column:
    """The fingerprint of a text: an array of (hash, position) in order of position.

    The position is the number of the first word of the k-gram, from 0.
    """

    def of(words: Column) -> Column:
        grams = F.size(words) - (k - 1)
        starts = F.sequence(F.lit(0), F.greatest(F.lit(0), grams - window), F.lit(BLOCK))
        blocks = F.transform(starts, lambda start: _block(words, start, grams, k, window))
        whole = F.array(
            F.struct(
                F.shiftright(F.xxhash64(words), _LOW).alias("hash"), F.lit(0).alias("position")
            )
        )
        # Neighbouring blocks select the same hash of a window that both hold.
        return (
            F.when(F.size(words) == 0, F.slice(whole, 1, 0))
            .when(grams < 1, whole)
            .otherwise(F.array_distinct(F.flatten(blocks)))
        )

    return _let(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0)), of)


def likeness(a: Column, b: Column) -> Column:
    """Jaccard likeness of two fingerprints' hashes; two empty fingerprints are alike."""
    first, second = (F.transform(x, lambda e: e["hash"]) for x in (a, b))
    both = F.size(F.array_intersect(first, second))
    either = F.size(F.array_union(first, second))
    return F.when(either == 0, F.lit(1.0)).otherwise(both / either)


def as_text(fingerprint: Column) -> Column:
    """The fingerprint as ``hash@position`` terms, hashes in hexadecimal."""
    return F.array_join(
        F.transform(
            fingerprint,
            lambda e: F.concat(F.hex(e["hash"].bitwiseAND(F.lit((1 << 44) - 1))), F.lit("@"), e["position"]),
        ),
        " ",
    )


def _ranges(ids: DataFrame) -> tuple[Column, DataFrame]:
    """An expression giving an id its range, and (first id of a range, range before it).

    There are at most 10,000 ranges, bounded by quantiles of the ids, so both are small
    at any size of input. Nulls form a range of their own, before the others.
    """
    rows = ids.count()
    wanted = max(1, min(_MAX_RANGES, rows // _IDS_PER_RANGE))
    bounds: list[int] = []
    if wanted > 1:
        shares = [i / wanted for i in range(1, wanted)]
        row = ids.agg(F.percentile_approx("id", shares, max(10_000, 4 * wanted)).alias("q")).first()
        bounds = sorted(set(row.q or []))
    table = F.array(*[F.lit(b).cast("bigint") for b in bounds]) if bounds else None
    span = F.when(F.col("id").isNull(), F.lit(-1))
    span = span.otherwise(_place(table, len(bounds)) if bounds else F.lit(0))
    heads = (
        ids.select("id", span.alias("span"))
        .groupBy("span")
        .agg(F.min("id").alias("head"))
    )
    order = Window.orderBy("span")  # one row a range
    heads = heads.select(
        F.col("head"),
        F.coalesce(F.lag("span").over(order), F.max("span").over(Window.partitionBy())).alias(
            "before"
        ),
    )
    return span, heads


def _place(table: Column, size: int) -> Column:
    """How many bounds are at most the id, by halving: the bounds are sorted."""
    steps = max(1, size).bit_length()
    low = F.lit(0)
    for step in reversed(range(steps)):
        low = _let(low, _jump(table, 1 << step))
    return low


def _jump(table: Column, by: int) -> Callable[[Column], Column]:
    def on(at: Column) -> Column:
        passed = F.coalesce(F.get(table, at + (by - 1)) <= F.col("id"), F.lit(False))
        return F.when(passed, at + by).otherwise(at)

    return on


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, next_text): each text beside that of the next row by id, then text.

    After the last row comes the first; nulls sort first. Texts move once: ids are cut
    into ranges, each range is sorted, and the first row of a range is also sent to
    the range before it.
    """
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    span, heads = _ranges(rows.select("id"))
    placed = rows.withColumn("span", span).join(
        F.broadcast(heads), rows["id"].eqNullSafe(heads["head"]), "left"
    )
    own = F.struct(F.col("span").alias("span"), F.lit(False).alias("copy"))
    copy = F.struct(F.col("before").alias("span"), F.lit(True).alias("copy"))
    sent = placed.select(
        "id",
        "text",
        F.explode(F.when(F.col("before").isNull(), F.array(own)).otherwise(F.array(own, copy))).alias(
            "at"
        ),
    ).select("id", "text", "at.span", "at.copy")
    order = Window.partitionBy("span").orderBy("copy", "id", "text")
    return sent.withColumn("next_text", F.lead("text").over(order))


def fingerprints(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    k: int = K,
    window: int = WINDOW,
) -> DataFrame:
    """Fingerprints of all texts, of their edited texts, and likenesses.

    The edited text keeps the first half of the code points (the larger one) and goes on with
    as many of the next document as were dropped.
    """
    order = Window.partitionBy("span").orderBy("copy", "id", "text")
    half = F.floor(F.char_length("text") / 2).cast("int")
    edited = F.concat(
        F.left("text", F.char_length("text") - half), F.left(F.coalesce("next_text", F.lit("")), half)
    )
    marked = with_next(docs, id_col, text_col).select(
        "id",
        "span",
        "copy",
        "text",
        F.char_length("text").cast("bigint").alias("n_chars"),
        F.sha2(edited, 256).alias("edited_sha256"),
        winnow(F.col("text"), k, window).alias("own"),
        winnow(edited, k, window).alias("changed"),
    )
    return (
        marked.withColumn("next", F.lead("own").over(order))
        .where(~F.col("copy"))
        .select(
            F.col("id").alias(id_col),
            "n_chars",
            "edited_sha256",
            as_text(F.col("own")).alias("fingerprint"),
            as_text(F.col("changed")).alias("edited_fingerprint"),
            likeness(F.col("own"), F.col("changed")).alias("near_edited"),
            likeness(F.col("own"), F.col("next")).alias("near_next"),
        )
    )
