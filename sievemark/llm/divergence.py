"""How far the sources of a language lie apart in their words: an audit by quadtree.

Counts of terms by group (language and source) are a sparse matrix: groups are its rows, the kept
terms of the language its columns, both ordered from frequent to rare so that zeros gather. The
matrix is cut into tiles of ``SIDE`` by ``SIDE`` cells, and every tile that is not all zero becomes a
K-squared tree (K is 2): a quadrant has a node if any of its cells is not zero, down to leaves of
``LEAF`` by ``LEAF`` cells. Two tiles of the same columns are walked together, for all pairs of their
rows at once. Where both quadrants are all zero, every cell of a pair of rows has the same value, so
only the number of columns is noted and the price multiplied out at the end; leaves are
compared cell by cell. Tiles that neither row has are priced the same way, from the number of terms.

A tile is bounded, so no task holds more than two of them; a language of any size is many tiles.
Terms are counted by group inside each task before they are shuffled.

Defined results: null text, language and source are empty strings. A term is a run of letters A-Z
(in lower case) and characters beyond ASCII. Every row is a document of its own, also a repeated one.
A group without terms has a count of zero everywhere. A language without kept terms has pairs of
value 0 and no terms. An empty table has no rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..plans.durable import stored

LEAST_DOCS = 30
ADDED = 5
SCALE = 1_000_000_000
RANKS = 50

SIDE = 256
LEAF = 8
_BUCKET = 16 * SIDE  # terms that are numbered together
_HELD = 200_000  # distinct terms that a task counts before it passes them on
_PIECE = 1 << 20  # bytes of a text worked on at a time
_LETTERS = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)

_COUNTS = pa.schema(
    [("lang", pa.string()), ("source", pa.string()), ("term", pa.binary()), ("n", pa.int64()), ("docs", pa.int64())]
)


def terms_of(text: bytes) -> Counter[bytes]:
    """The terms of a text in UTF-8, with their counts."""
    found: Counter[bytes] = Counter()
    at = 0
    while at < len(text):
        stop = at + _PIECE
        # A piece ends where no term goes on.
        while stop < len(text) and _LETTERS[text[stop]] != 32:
            stop += 1
        found.update(text[at:stop].translate(_LETTERS).split())
        at = stop
    return found


def term_counts(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents; a null term counts the group itself."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        size = 0
        for batch in batches:
            for group_lang, group_source, content in zip(*(column.to_pylist() for column in batch.columns)):
                counts, in_docs = held.setdefault((group_lang, group_source), (Counter(), Counter()))
                before = len(counts)
                one = terms_of(content)
                counts.update(one)
                in_docs.update(one.keys())
                counts[None] += 1
                in_docs[None] += 1
                size += len(counts) - before
                if size > _HELD:
                    yield _counted(held)
                    held, size = {}, 0
        if held:
            yield _counted(held)

    given = docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("lang"),
        F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source"),
        F.coalesce(F.col(text), F.lit("")).cast("binary").alias("content"),
    )
    partial = given.mapInArrow(of, "lang string, source string, term binary, n bigint, docs bigint")
    return partial.groupBy("lang", "source", F.col("term").cast("string").alias("term")).agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs")
    )


def _counted(held: dict[tuple[str, str], tuple[Counter, Counter]]) -> pa.RecordBatch:
    langs, sources, terms, n, docs = [], [], [], [], []
    for (lang, source), (counts, in_docs) in held.items():
        langs += [lang] * len(counts)
        sources += [source] * len(counts)
        terms += counts.keys()
        n += counts.values()
        docs += [in_docs[term] for term in counts]
    return pa.RecordBatch.from_arrays(
        [pa.array(values, field.type) for values, field in zip((langs, sources, terms, n, docs), _COUNTS)],
        schema=_COUNTS,
    )


def _share(count: Column, total: Column) -> Column:
    """1 + floor(SCALE * (count + ADDED) / total), exactly, at any size of corpus."""
    wide = (count + ADDED).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    return F.expr("1") + F.call_function("div", wide, total.cast("decimal(20,0)"))


class _Tree:
    """A K-squared tree over some cells of a tile, and the values of its leaves.

    ``levels[k]`` has the codes (row, column) of the quadrants of ``SIDE >> k`` cells that are not
    all zero, in order; a quadrant's place there is its rank. A leaf holds the values of all its
    cells; a zero cell has the value that its row has for a count of zero.
    """

    def __init__(self, row: np.ndarray, column: np.ndarray, value: np.ndarray, zero: np.ndarray, width: int):
        depth = (SIDE // LEAF).bit_length()
        self.levels = [
            np.unique((row // (SIDE >> k)) * SIDE + column // (SIDE >> k)) for k in range(depth)
        ]
        codes = self.levels[-1]
        inside = (codes % SIDE * LEAF)[:, None] + np.arange(LEAF) < width
        rows = (codes // SIDE * LEAF)[:, None] + np.arange(LEAF)
        self.leaves = zero[rows][:, :, None] * inside[:, None, :]
        at = np.searchsorted(codes, (row // LEAF) * SIDE + column // LEAF)
        self.leaves[at, row % LEAF, column % LEAF] = value

    def rank(self, level: int, row: np.ndarray, column: np.ndarray) -> np.ndarray:
        """The rank of each quadrant, -1 if it is all zero."""
        codes, wanted = self.levels[level], row * SIDE + column
        if not len(codes):
            return np.full(len(wanted), -1)
        at = np.minimum(np.searchsorted(codes, wanted), len(codes) - 1)
        return np.where(codes[at] == wanted, at, -1)


def distances(
    one: tuple[np.ndarray, np.ndarray, np.ndarray],
    other: tuple[np.ndarray, np.ndarray, np.ndarray] | None,
    zeros: np.ndarray,
    other_zeros: np.ndarray,
    width: int,
) -> np.ndarray:
    """Sums over the columns of absolute differences, for each row of one tile and of another.

    A tile is given by rows, columns and values of its cells that are not zero; ``zeros`` are the
    values of a zero cell by row. Without an ``other``, pairs are within the tile, the upper half.
    """
    same = other is None
    first, second = (np.zeros(SIDE, np.int64) for _ in range(2))
    first[: len(zeros)] = zeros
    second[: len(other_zeros)] = other_zeros
    a = _Tree(*one, first, width)
    b = a if same else _Tree(*other, second, width)
    rows_a, rows_b = len(zeros), len(other_zeros)
    empty = np.zeros((SIDE, SIDE), np.int64)  # columns in which both rows are zero
    # Quadrant pairs still to be compared: both row numbers and the column number at this level.
    ra = rb = col = np.zeros(1, np.int64)
    last = len(a.levels) - 1
    for level in range(last + 1):
        span = SIDE >> level
        if level:
            child = np.arange(8)
            ra = (2 * ra[:, None] + (child >> 2)).ravel()
            rb = (2 * rb[:, None] + (child >> 1 & 1)).ravel()
            col = (2 * col[:, None] + (child & 1)).ravel()
        there = (ra * span < rows_a) & (rb * span < rows_b) & (col * span < width)
        if same:
            there &= ra <= rb
        ra, rb, col = ra[there], rb[there], col[there]
        rank_a, rank_b = a.rank(level, ra, col), b.rank(level, rb, col)
        blank = (rank_a < 0) & (rank_b < 0)
        noted = np.zeros((SIDE // span, SIDE // span), np.int64)
        np.add.at(noted, (ra[blank], rb[blank]), np.minimum(width - col[blank] * span, span))
        empty += np.repeat(np.repeat(noted, span, 0), span, 1)
        ra, rb, col, rank_a, rank_b = (x[~blank] for x in (ra, rb, col, rank_a, rank_b))
    total = np.zeros((SIDE // LEAF, SIDE // LEAF, LEAF, LEAF), np.int64)
    for at in range(0, len(ra), 4096):
        part = slice(at, at + 4096)
        left = _leaves(a, rank_a[part], ra[part], col[part], first, width)
        right = _leaves(b, rank_b[part], rb[part], col[part], second, width)
        gaps = np.abs(left[:, :, None, :] - right[:, None, :, :]).sum(-1)
        np.add.at(total, (ra[part], rb[part]), gaps)
    total = total.transpose(0, 2, 1, 3).reshape(SIDE, SIDE)
    total += empty * np.abs(first[:, None] - second[None, :])
    return total[:rows_a, :rows_b]


def _leaves(
    tree: _Tree, rank: np.ndarray, row: np.ndarray, column: np.ndarray, zero: np.ndarray, width: int
) -> np.ndarray:
    """The values of leaves; an all-zero one has the values of zero cells."""
    inside = (column * LEAF)[:, None] + np.arange(LEAF) < width
    blank = zero[(row * LEAF)[:, None] + np.arange(LEAF)][:, :, None] * inside[:, None, :]
    if not len(tree.leaves):
        return blank
    return np.where((rank < 0)[:, None, None], blank, tree.leaves[rank])


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows are pairs of tiles; gives (lang, a, b, value, width) for pairs of rows."""
    for batch in batches:
        for pair in range(batch.num_rows):
            row = batch.slice(pair, 1).to_pylist()[0]
            one, other = row["one"], row["other"]
            tiles = {tile["tile"]: tile["cells"] for tile in row["tiles"]}
            cells = [
                tuple(np.array([c[k] for c in tiles.get(tile, [])], np.int64) for k in ("row", "column", "share"))
                for tile in (one, other)
            ]
            zeros, other_zeros = (np.array(row[k], np.int64) for k in ("zeros", "other_zeros"))
            found = distances(cells[0], None if one == other else cells[1], zeros, other_zeros, row["width"])
            a, b = np.nonzero(np.ones_like(found, bool) if one != other else np.triu(np.ones_like(found, bool), 1))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([row["lang"]] * len(a), pa.string()),
                    pa.array(one * SIDE + a, pa.int64()),
                    pa.array(other * SIDE + b, pa.int64()),
                    pa.array(found[a, b], pa.int64()),
                    pa.array(np.full(len(a), row["width"]), pa.int64()),
                ],
                ["lang", "a", "b", "value", "width"],
            )


def _pair_values(cells: DataFrame, groups: DataFrame, widths: DataFrame) -> DataFrame:
    """(lang, a, b, value, width): of pairs of groups by number, over the tiles that either has."""
    tiles = cells.groupBy("lang", "block", F.shiftright("number", 8).alias("tile")).agg(
        F.collect_list(
            F.struct(F.col("number").bitwiseAND(SIDE - 1).alias("row"), F.col("column"), F.col("share"))
        ).alias("cells")
    )  # at most SIDE * SIDE cells
    # The values of zero cells, by tile of rows.
    rows = groups.groupBy("lang", F.shiftright("number", 8).alias("tile")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("number", "zero"))), lambda g: g["zero"]).alias("zeros"),
        F.max("row_tiles").alias("row_tiles"),
    )
    meant = tiles.join(rows.select("lang", "tile", "row_tiles"), ["lang", "tile"]).select(
        "lang", "block", F.struct("tile", "cells").alias("own"),
        F.explode(F.sequence(F.lit(0), F.col("row_tiles") - 1)).alias("with"),
    )
    pairs = meant.groupBy(
        "lang", "block", F.least("own.tile", "with").alias("one"), F.greatest("own.tile", "with").alias("other")
    ).agg(F.collect_list("own").alias("tiles"))  # one tile or two
    zeros = rows.select("lang", F.col("tile").alias("one"), "zeros")
    other_zeros = rows.select("lang", F.col("tile").alias("other"), F.col("zeros").alias("other_zeros"))
    whole = pairs.join(widths, ["lang", "block"]).join(zeros, ["lang", "one"]).join(other_zeros, ["lang", "other"])
    return (
        whole.select("lang", "one", "other", "tiles", "zeros", "other_zeros", "width")
        .mapInArrow(_compare, "lang string, a bigint, b bigint, value bigint, width bigint")
        .groupBy("lang", "a", "b")
        .agg(F.sum("value").alias("value"), F.sum("width").alias("width"))
    )


def _ranked(found: DataFrame, part: str, most: int | None = None) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = found.withColumn("rank", F.row_number().over(order))
    if most is not None:
        ranked = ranked.where(F.col("rank") <= most)  # Spark limits each task's groups before it shuffles
    return ranked.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")


def audit(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    least_docs: int = LEAST_DOCS,
    ranks: int = RANKS,
) -> DataFrame:
    """(lang, source, part, item, value, rank) for every group.

    Part ``pair``: the distance to every other source of the language. Part ``term``: the terms that
    are more frequent in the group than in the language, the ``ranks`` furthest of them.
    """
    counts = stored(term_counts(docs, text, lang, source), "term_counts")
    kept = (
        counts.where("term is not null")
        .groupBy("lang", "term")
        .agg(F.sum("n").alias("in_lang"), F.sum("docs").alias("docs"))
        .where(F.col("docs") >= least_docs)
        .drop("docs")
    )
    kept = stored(kept, "kept_terms")
    langs = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("in_lang").alias("lang_total"))
    langs = stored(langs, "langs")  # so that its size is known, and terms need not move to their language
    bucket = F.pmod(F.xxhash64("term"), F.ceil(F.col("terms") / _BUCKET))
    order = Window.partitionBy("lang", "bucket").orderBy(F.desc("in_lang"), "term")
    placed = kept.join(langs, "lang").withColumn("bucket", bucket)
    placed = placed.withColumn("place", F.row_number().over(order) - 1).select(
        "lang",
        "term",
        F.struct("bucket", F.shiftright("place", 8).alias("run")).alias("block"),
        F.col("place").bitwiseAND(SIDE - 1).alias("column"),
        _share(F.col("in_lang"), F.col("lang_total") + ADDED * F.col("terms")).alias("lang_share"),
    )
    placed = stored(placed, "placed_terms")
    widths = placed.groupBy("lang", "block").agg(F.count("*").alias("width"))
    mine = stored(
        counts.where("term is not null").select("lang", "source", "term", "n").join(placed, ["lang", "term"]),
        "group_terms",
    )

    totals = mine.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    every = counts.where("term is null").select("lang", "source")
    sized = every.join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
    terms = F.coalesce("terms", F.lit(0))
    whole = F.coalesce("total", F.lit(0)) + ADDED * terms
    in_order = Window.partitionBy("lang").orderBy(F.desc_nulls_last("total"), "source")  # one row a group
    groups = sized.select(
        "lang",
        "source",
        terms.alias("terms"),
        whole.alias("whole"),
        F.when(terms > 0, _share(F.lit(0), whole)).otherwise(0).alias("zero"),
        (F.row_number().over(in_order) - 1).alias("number"),
        F.floor((F.count("*").over(Window.partitionBy("lang")) + SIDE - 1) / SIDE).cast("int").alias("row_tiles"),
    )
    groups = stored(groups, "groups")

    cells = mine.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", "block", "column", "number", "lang_share",
        _share(F.col("n"), F.col("whole")).alias("share"),
    )
    cells = stored(cells, "cells")
    above = cells.where("share > lang_share").select(
        "lang", "source", F.col("term").alias("item"), (F.col("share") - F.col("lang_share")).alias("value")
    )

    values = stored(_pair_values(cells, groups, widths), "pair_values")
    each = groups.select("lang", "source", "number", "terms", "zero", "row_tiles")
    partner = groups.select(
        "lang", F.col("source").alias("item"), F.col("number").alias("partner"), F.col("zero").alias("other_zero"),
        F.shiftright("number", 8).alias("tile"),
    )
    pairs = (
        each.withColumn("tile", F.explode(F.sequence(F.lit(0), F.col("row_tiles") - 1)))
        .join(partner, ["lang", "tile"])
        .where("number <> partner")
        .withColumns({"a": F.least("number", "partner"), "b": F.greatest("number", "partner")})
        .join(values, ["lang", "a", "b"], "left")
    )
    unseen = F.col("terms") - F.coalesce("width", F.lit(0))
    value = F.coalesce("value", F.lit(0)) + unseen * F.abs(F.col("zero") - F.col("other_zero"))
    apart = pairs.select("lang", "source", "item", value.cast("bigint").alias("value"))
    return _ranked(apart, "pair").unionByName(_ranked(above, "term", ranks))
