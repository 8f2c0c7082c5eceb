"""Near duplicates by a chosen-path similarity join over word shingles.

Every text becomes a set of shingles. Texts with equal sets form one class at once. The classes
go down several independent trees: a node picks two of the 64 minwise coordinates, and a
class goes to the child named by its own token at each of them, so two classes of
likeness ``s`` share a child with probability ``1 - (1 - s)^2`` at each step. Nodes of at most
``SMALL`` classes are compared exhaustively; in a larger one all classes are compared with a
leader in the middle of the node, those close to it leave, and the rest branch again. Classes
whose signatures look alike are joined to clusters by at most one link per class and node.

Within a cluster every pair that is not yet connected is compared on full sets, so a link holds
exactly: ``100 * |A & B| >= percent * |A | B|``. Clusters above ``BLOCK`` classes are compared
block against block in separate tasks. A link is written only where it connects two
groups, so a task writes fewer links than it has classes; all pairs are never listed.

At likeness 0.85 a pair is missed by all three trees with a probability below 0.0001; a pair that is
missed is still found when other links put both into one cluster.

Defined results: a text without words (or null) has an empty set and is linked with nothing; one
with fewer than ``k`` words has one shingle, of all of them. Rows that repeat are separate
documents with one set. Columns other than id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..plans.durable import stored
from .components import components
from .grouping import per_group
from .hashing import mix, shingles, slices, text_bytes, word_hashes

COORDINATES = 64
TREES = 3
SMALL = 1024
BLOCK = 256
BLOCK_SHINGLES = 2_000_000
MAX_BROADCAST = 1_000_000  # rows of about 30 bytes
ROWS_PER_PART = 20_000  # of signatures or sets, in one task
LEAST_PARTS = 12
_A = np.random.default_rng(7).integers(0, 1 << 63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LINKS = "a bigint, b bigint"


def _signature(tokens: np.ndarray) -> np.ndarray:
    """The least hash of the tokens at each coordinate, as 32 bits."""
    least = np.full(COORDINATES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(tokens), 4096):
        part = tokens[at : at + 4096]
        np.minimum(least, (_A[:, None] * part[None, :]).min(axis=1), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def _fingerprint(tokens: np.ndarray) -> bytes:
    """128 bits that depend on the set alone; distinct sets differ but for 1 in 2^128."""
    return tokens.sum(dtype=np.uint64).tobytes() + np.bitwise_xor.reduce(mix(tokens)).tobytes()


def _sets_of(texts: pa.Array, k: int) -> Iterator[np.ndarray]:
    for part in slices(texts):
        hashes, firsts = word_hashes(*text_bytes(part))
        for i in range(len(firsts) - 1):
            yield shingles(hashes[firsts[i] : firsts[i + 1]], k)


def describe(docs: DataFrame, k: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per text: a row number, set size, set fingerprint and signature. Stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, prints, signatures = [], [], []
            for tokens in _sets_of(batch.column("text"), k):
                size.append(len(tokens))
                prints.append(_fingerprint(tokens) if len(tokens) else None)
                signatures.append(_signature(tokens).tobytes() if len(tokens) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("version"), pa.array(size, pa.int64()),
                 pa.array(prints, pa.binary()), pa.array(signatures, pa.binary())],
                ["doc_id", "version", "n", "fingerprint", "signature"],
            )

    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.xxhash64(text_col).alias("version"),
        F.col(text_col).alias("text"),
    )
    schema = "doc_id bigint, version bigint, n bigint, fingerprint binary, signature binary"
    # The numbers are fixed once the table is written.
    return stored(
        rows.mapInArrow(run, schema).withColumn("row", F.monotonically_increasing_id()), "sets"
    )


def _classes(sets: DataFrame) -> DataFrame:
    """One row per distinct set; ``class`` is the number of one of its rows."""
    parts = max(LEAST_PARTS, sets.count() // ROWS_PER_PART)
    return stored(
        sets.where("n > 0")
        .groupBy("fingerprint")
        .agg(
            F.min("row").alias("class"),
            F.min(F.struct("doc_id", "version")).alias("stands"),
            F.count("*").alias("rows"),
            F.first("n").alias("n"),
            F.first("signature").alias("signature"),
        )
        .coalesce(parts),
        "classes",
    )


def _child(node: Column, coordinate: Column) -> Column:
    token = F.substring(F.col("signature"), coordinate * F.lit(4) + F.lit(1), F.lit(4))
    return F.xxhash64(node, coordinate, token)


def _roots() -> Column:
    return F.array(
        *[_child(F.lit(tree), F.lit(2 * tree + side)) for tree in range(TREES) for side in (0, 1)]
    )


def _branches() -> Column:
    """Two children by two different coordinates that the node's own name picks."""
    first = F.pmod(F.xxhash64("node"), F.lit(COORDINATES)).cast("int")
    shift = F.pmod(F.xxhash64("node", F.lit(1)), F.lit(COORDINATES - 1)).cast("int") + 1
    return F.array(_child(F.col("node"), first), _child(F.col("node"), (first + shift) % COORDINATES))


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    joined = b"".join(column.to_pylist())
    return np.frombuffer(joined, np.uint32).reshape(-1, COORDINATES)


class _Groups:
    """Groups that only ever merge, as a label per member."""

    def __init__(self, size: int):
        self.label = np.arange(size)

    def merge(self, a: int, b: int) -> bool:
        x, y = self.label[a], self.label[b]
        if x == y:
            return False
        self.label[self.label == max(x, y)] = min(x, y)
        return True


def _links(ids: np.ndarray, pairs: list[tuple[int, int]]) -> pa.Table | None:
    if not pairs:
        return None
    a, b = (np.array([p[side] for p in pairs], np.int64) for side in (0, 1))
    return pa.table({"a": ids[a], "b": ids[b]})


def _alike(least: int) -> Callable[[pa.Table], pa.Table | None]:
    """Links between classes of a small node that agree at ``least`` coordinates."""

    def run(table: pa.Table) -> pa.Table | None:
        ids, rows = table["class"].to_numpy(), _matrix(table["signature"])
        groups, pairs = _Groups(len(ids)), []
        for i in range(len(ids) - 1):
            same = (rows[i + 1 :] == rows[i]).sum(axis=1) >= least
            for j in np.flatnonzero(same) + i + 1:
                if groups.merge(i, int(j)):
                    pairs.append((i, int(j)))
        return _links(ids, pairs)

    return run


def _elect(table: pa.Table) -> pa.Table:
    """The member of a sample that agrees best with what the sample holds most often."""
    rows = _matrix(table["signature"])
    votes = np.zeros(len(rows), np.int64)
    for column in rows.T:
        values, where, count = np.unique(column, return_inverse=True, return_counts=True)
        votes += count[where]
    best = int(votes.argmax())
    return pa.table(
        {
            "node": table["node"].slice(best, 1),
            "leader": table["class"].slice(best, 1),
            "leader_signature": table["signature"].slice(best, 1),
        }
    )


def _agreement(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        same = (_matrix(table["signature"]) == _matrix(table["leader_signature"])).sum(axis=1)
        yield pa.RecordBatch.from_arrays(
            [batch.column("node"), batch.column("class"), batch.column("leader"),
             pa.array(same.astype(np.int32))],
            ["node", "class", "leader", "same"],
        )


def _doubt(share: float, deviations: float) -> int:
    """Coordinates at which sets of a likeness agree, less some standard deviations."""
    spread = sqrt(share * (1 - share) * COORDINATES)
    return max(1, int(share * COORDINATES - deviations * spread))


def clusters(classes: DataFrame, percent: int) -> DataFrame | None:
    """(node, label) of classes that look alike to some other, through the trees."""
    share = percent / 100
    alike = _doubt(share, 5)
    leaves = max(alike, round(0.75 * COORDINATES))
    # What a class that leaves may be linked to is at most this much farther from the leader.
    joins = max(1, leaves - round((1 - share) * COORDINATES) - 12)
    signatures = classes.select("class", "signature")
    members = signatures.select("class", F.explode(_roots()).alias("node"))
    links = []
    # Few rows are not worth as many tasks as a large shuffle has.
    parts = max(LEAST_PARTS, classes.count() * 2 * TREES // ROWS_PER_PART)
    while True:
        members = stored(members.coalesce(parts), "members")
        counts = members.groupBy("node").agg(F.count("*").alias("size")).where("size > 1")
        placed = stored(
            members.join(counts, "node").coalesce(parts).join(signatures, "class").coalesce(parts),
            "placed",
        )
        small = placed.where(F.col("size") <= SMALL)
        links.append(
            stored(
                per_group(
                    small.select("node", "class", "signature"), ["node"], _alike(alike), _LINKS, parts
                ),
                "links",
            )
        )
        large = placed.where(F.col("size") > SMALL)
        if large.isEmpty():
            break
        sample = large.where(
            F.pmod(F.xxhash64("class"), F.greatest(F.lit(1), F.floor(F.col("size") / 64))) == 0
        )
        leaders = per_group(
            sample.select("node", "class", "signature"),
            ["node"],
            _elect,
            "node bigint, leader bigint, leader_signature binary",
            parts,
        )
        compared = stored(
            large.join(leaders, "node", "left")
            .where("leader is not null")
            .select("node", "class", "signature", "leader", "leader_signature")
            .coalesce(parts)
            .mapInArrow(_agreement, "node bigint, class bigint, leader bigint, same int"),
            "compared",
        )
        links.append(
            compared.where(F.col("same") >= joins).select(
                F.col("leader").alias("a"), F.col("class").alias("b")
            )
        )
        # A node whose sample is empty, by chance, branches without a leader.
        gone = compared.where(F.col("same") >= leaves).select("node", "class")
        rest = large.select("node", "class", "signature").join(gone, ["node", "class"], "left_anti")
        members = rest.select("class", F.explode(_branches()).alias("node")).distinct()
    found = links[0]
    for more in links[1:]:
        found = found.unionByName(more)
    return components(found)


def _exact(percent: int) -> Callable[[pa.Table], pa.Table | None]:
    """Links between classes of a block, or between two blocks, on full sets."""

    def run(table: pa.Table) -> pa.Table | None:
        ids, side = table["class"].to_numpy(), table["side"].to_numpy()
        data, bounds = text_bytes(table["tokens"])
        tokens = data.view(np.uint64) if len(data) else np.zeros(0, np.uint64)
        firsts = bounds // 8
        size = np.diff(firsts)
        vocabulary, tokens = np.unique(tokens, return_inverse=True)
        groups, pairs = _Groups(len(ids)), []
        order = np.lexsort((ids, size))
        cross = len(set(side.tolist())) > 1
        held = np.zeros(len(vocabulary), bool)
        for place, i in enumerate(order):
            rest = order[place + 1 :]
            rest = rest[100 * size[i] >= percent * size[rest]]
            rest = rest[groups.label[rest] != groups.label[i]]
            if cross:
                rest = rest[side[rest] != side[i]]
            if not len(rest):
                continue
            own = tokens[firsts[i] : firsts[i + 1]]
            held[own] = True
            for at in range(0, len(rest), 64):
                part = rest[at : at + 64]
                flat = np.concatenate([held[tokens[firsts[j] : firsts[j + 1]]] for j in part])
                starts = np.concatenate(([0], np.cumsum(size[part])[:-1]))
                both = np.add.reduceat(flat.astype(np.int64), starts)
                either = size[i] + size[part] - both
                for j in part[100 * both >= percent * either]:
                    if groups.merge(int(i), int(j)):
                        pairs.append((int(i), int(j)))
            held[own] = False
        return _links(ids, pairs)

    return run


def _full_sets(
    docs: DataFrame, wanted: DataFrame, k: int, id_col: str, text_col: str
) -> DataFrame:
    """(class, label, n, tokens) of the wanted classes, from their texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, tokens, size = [], [], []
            prints = batch.column("fingerprint").to_pylist()
            for i, own in enumerate(_sets_of(batch.column("text"), k)):
                if len(own) and _fingerprint(own) == prints[i]:
                    kept.append(i)
                    tokens.append(own.tobytes())
                    size.append(len(own))
            at = pa.array(kept, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("class").take(at), batch.column("label").take(at),
                 pa.array(size, pa.int64()), pa.array(tokens, pa.binary())],
                ["class", "label", "n", "tokens"],
            )

    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.xxhash64(text_col).alias("own"),
        F.col(text_col).alias("text"),
    )
    if wanted.count() <= MAX_BROADCAST:
        wanted = F.broadcast(wanted)
    # Any number of rows may share an id, so a text is named by its hash too.
    same = rows["doc_id"].eqNullSafe(wanted["id"]) & (rows["own"] == wanted["version"])
    texts = rows.join(wanted, same).select("text", "class", "label", "fingerprint")
    schema = "class bigint, label bigint, n bigint, tokens binary"
    # Rows that repeat share both; one of them stands for the class.
    return texts.mapInArrow(run, schema)


def exact_links(sets: DataFrame, percent: int) -> DataFrame:
    """Links inside clusters, enough of them to connect what is connected."""
    parts = max(4 * LEAST_PARTS, sets.count() // 200)
    sizes = sets.groupBy("label").agg(F.count("*").alias("members"), F.sum("n").alias("shingles"))
    block = F.greatest(F.lit(BLOCK), F.least(F.lit(8192), F.ceil(F.col("members") / 16)))
    blocks = F.greatest(
        F.ceil(F.col("members") / block), F.ceil(F.col("shingles") / BLOCK_SHINGLES), F.lit(1)
    ).cast("int")
    side = F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int")
    meets = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda other: F.struct(
            F.least(F.col("side"), other).alias("low"), F.greatest(F.col("side"), other).alias("high")
        ),
    )
    meeting = (
        sets.join(sizes.where("members > 1").select("label", blocks.alias("blocks")), "label")
        .withColumn("side", side)
        .withColumn("meet", F.explode(meets))
        .select("label", "meet.low", "meet.high", "class", "side", "tokens")
    )
    return per_group(meeting, ["label", "low", "high"], _exact(percent), _LINKS, parts)


def grouped(
    docs: DataFrame, k: int, percent: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(row, doc_id, version, n, label) per row; rows of one component share a label.

    ``row`` numbers the rows and ``version`` is a hash of the text; rows that are linked with no
    other have no label.
    """
    sets = describe(docs, k, id_col, text_col)
    classes = _classes(sets)
    looked = clusters(classes, percent)
    wanted = looked.withColumnRenamed("node", "class").join(
        classes.select("class", F.col("stands.doc_id").alias("id"), "stands.version", "fingerprint"), "class"
    )
    full = stored(
        _full_sets(docs, stored(wanted, "wanted"), k, id_col, text_col).dropDuplicates(["class"]),
        "full_sets",
    )
    linked = components(exact_links(full, percent)).withColumnRenamed("node", "class")
    labels = (
        classes.select("class", "fingerprint", "rows")
        .join(linked, "class", "left")
        .where("rows > 1 or label is not null")
        .select("fingerprint", F.coalesce("label", "class").alias("label"))
    )
    return sets.select("row", "doc_id", "version", "n", "fingerprint").join(
        labels, "fingerprint", "left"
    )


def near_duplicates(
    docs: DataFrame,
    k: int = 5,
    percent: int = 80,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row: set size, the least id of its component, and whether it has that id."""
    rows = stored(grouped(docs, k, percent, id_col, text_col), "grouped")
    least = rows.where("label is not null").groupBy("label").agg(F.min("doc_id").alias("least"))
    component = F.when(F.col("label").isNotNull(), F.col("least")).otherwise(F.col("doc_id"))
    return rows.join(least, "label", "left").select(
        "row",
        F.col("doc_id").alias(id_col),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )


def keep_one(
    docs: DataFrame,
    k: int = 5,
    percent: int = 80,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``docs`` with one row of each component: that of the least id, then of the least text hash."""
    rows = stored(grouped(docs, k, percent, id_col, text_col), "grouped").where("label is not null")
    key = F.struct("doc_id", "version")
    first = rows.groupBy("label").agg(F.min(key).alias("first"))
    marked = rows.join(first, "label").select(
        "doc_id", "version", key.eqNullSafe(F.col("first")).alias("stays")
    )
    keys = stored(
        marked.groupBy("doc_id", "version", "stays").agg(F.count("*").alias("copies")), "keys"
    )
    gone, repeated = keys.where("not stays"), keys.where("stays and copies > 1")
    rest = _by_key(docs, gone, "left_anti", id_col, text_col)
    if repeated.isEmpty():
        return rest
    once = _by_key(rest, repeated, "left_semi", id_col, text_col).dropDuplicates([id_col, text_col])
    return _by_key(rest, repeated, "left_anti", id_col, text_col).unionByName(once)


def _by_key(docs: DataFrame, keys: DataFrame, how: str, id_col: str, text_col: str) -> DataFrame:
    keys = keys.select(F.col("doc_id").alias("__id"), F.col("version").alias("__version"))
    if keys.count() <= MAX_BROADCAST:
        keys = F.broadcast(keys)
    same = docs[id_col].cast("bigint").eqNullSafe(F.col("__id")) & (
        F.xxhash64(docs[text_col]) == F.col("__version")
    )
    return docs.join(keys, same, how)
