"""The trie of conversation prefixes: padded matrices of turn ids, range shards, recombined borders.

A conversation is the sequence of its turns, each known by a digest of role and text. All
sequences are cut into range shards in lexicographic order, a sequence before its continuations and equal
ones by conversation. In a shard the turns are a matrix, padded with 0 and sorted by
``lexsort``; where a column differs from the row above, OR-accumulated over the columns, the row
begins a node at that depth, and ``reduceat`` over these starts aggregates every node of the depth.
Matrices are made in blocks of ``COLUMNS`` turns, and only rows that are that long are in a block.

Every aggregate over a subtree is a sum over the rows of a node: a row adds what it brings from its depth
on, and counts as new, or as a leaf, by what it shares with the rows next to it. So nodes inside a
shard are complete at once. The nodes on the path of a shard's first or last row may go on in the next
shard: their sums are added up by a digest of the path, less what a shard took for new because
it did not see the row before, and for a leaf because it did not see the row after.

Shards are bounded by counted turns, and equal sequences spread over shards, so neither a
frequent first turn nor a group of copies is gathered. The digest of a node's ends is sequential: pieces of
numbers, one for each shard, pass through one task as a stream. The turn digests of one
conversation, 16 bytes a turn, are one row.

Defined results: null role and text are empty. Turns come by number, null first; equal numbers by the
SHA-256 of length of role, role and text. Repeated rows are turns of their own. A row without a
conversation is left out, as it belongs to none. An empty table has no nodes, not even a root. Other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..plans.durable import stored

COLUMNS = 64
SHARD_TURNS = 200_000
_ID = 16  # bytes
_GROUP = 5  # conversations of a group share the head of its first
_MOST_HEAD = 8


def sequences(turns: DataFrame) -> DataFrame:
    """(conv_id, turns): the turns of each conversation in order, as (id, size); size is the bytes of the text."""
    role, text = (F.coalesce(F.col(name), F.lit("")) for name in ("role", "text"))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    one = turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.struct(
            F.col("turn").cast("bigint").alias("turn"),
            F.unhex(F.sha2(whole, 256)).alias("digest"),
            F.octet_length(text).cast("bigint").alias("size"),
        ).alias("turn"),
    )
    gathered = one.groupBy("conv_id").agg(F.array_sort(F.collect_list("turn")).alias("turns"))
    return gathered.select(
        "conv_id",
        F.transform(
            "turns", lambda t: F.struct(F.substring(t["digest"], 1, _ID).alias("id"), t["size"].alias("size"))
        ).alias("turns"),
    )


def with_group_heads(conversations: DataFrame) -> DataFrame:
    """Each conversation begun with the first h turns of the first one of its group.

    The group of c begins with c - c % 5, h is crc32(c) % 9; its own turns go on after its first h.
    """
    own = conversations.select(
        "conv_id", "turns",
        (F.col("conv_id") - F.col("conv_id") % _GROUP).alias("first"),
        (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (_MOST_HEAD + 1)).cast("int").alias("h"),
    )
    heads = conversations.select(
        F.col("conv_id").alias("first"), F.slice("turns", 1, _MOST_HEAD).alias("head")
    ).where(F.col("first") % _GROUP == 0)
    given = F.when(F.col("head").isNull(), F.slice("turns", 1, 0)).otherwise(F.slice("head", F.lit(1), F.col("h")))
    rest = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))
    return own.join(heads, "first", "left").select("conv_id", F.concat(given, rest).alias("turns"))


_NODES = pa.schema(
    [
        ("shard", pa.int32()),
        ("conv_id", pa.int64()),
        ("depth", pa.int32()),
        ("parent_conv_id", pa.int64()),
        ("parent_side", pa.string()),  # the path on which the parent lies, if it is not inside the shard
        ("n_convs", pa.int64()),
        ("n_children", pa.int64()),
        ("n_leaves", pa.int64()),
        ("saved_tokens", pa.int64()),
        ("ends_sha256", pa.string()),
        # Only of nodes on the path of the first or last row:
        ("path", pa.binary()),
        ("on_first", pa.bool_()),
        ("on_last", pa.bool_()),
        ("ends", pa.string()),
        ("before", pa.int64()),  # bytes of the first row's path above this node, and with it
        ("upto", pa.int64()),
    ]
)
_NODE_TYPES = (
    "shard int, conv_id bigint, depth int, parent_conv_id bigint, parent_side string, n_convs bigint, "
    "n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string, path binary, "
    "on_first boolean, on_last boolean, ends string, before bigint, upto bigint"
)


class _Rows:
    """The sequences of a shard: turn numbers, which keep the order of the turn digests, and sizes."""

    def __init__(self, conv: np.ndarray, digests: list[bytes], sizes: np.ndarray):
        self.conv = conv
        self.digests = digests
        self.length = np.array([len(d) // _ID for d in digests], np.int64)
        self.at = np.concatenate(([0], np.cumsum(self.length)))
        flat = np.frombuffer(b"".join(digests), f"S{_ID}")
        self.turn = np.unique(flat, return_inverse=True)[1].astype(np.int64) + 1
        self.size = sizes

    def matrix(self, rows: np.ndarray, block: int) -> np.ndarray:
        """The turns of some rows in one block of columns, padded with 0."""
        columns = block * COLUMNS + np.arange(COLUMNS)
        there = columns < self.length[rows][:, None]
        cells = np.where(there, self.at[rows][:, None] + columns, 0)
        return np.where(there, self.turn[cells] if len(self.turn) else 0, 0)

    def order(self) -> np.ndarray:
        """The rows in lexicographic order, equal sequences by conversation."""
        rank = np.zeros(len(self.conv), np.int64)
        block, rows = 0, np.flatnonzero(self.length > 0)
        while len(rows):
            keys = self.matrix(rows, block)
            order = np.lexsort((*keys.T[::-1], rank[rows]))
            rows, keys = rows[order], keys[order]
            changed = np.ones(len(rows), bool)
            changed[1:] = (keys[1:] != keys[:-1]).any(axis=1) | (rank[rows][1:] != rank[rows][:-1])
            # Shorter sequences of the same rank stay before these.
            finer = np.zeros(len(rank), np.int64)
            finer[rows] = np.cumsum(changed)
            rank = np.unique(rank * (len(rank) + 1) + finer, return_inverse=True)[1]
            block += 1
            rows = rows[self.length[rows] > block * COLUMNS]
        return np.lexsort((self.conv, rank))

    def shared(self, order: np.ndarray) -> np.ndarray:
        """How many turns each row shares with the one above it; -1 for the first."""
        shared = np.zeros(len(order), np.int64)
        shared[0] = -1
        block, rows = 0, np.arange(1, len(order))
        while len(rows):
            keys, above = self.matrix(order[rows], block), self.matrix(order[rows - 1], block)
            # A node begins at every column from the first that differs.
            begun = np.logical_or.accumulate((keys != above) | (keys == 0), axis=1)
            same = COLUMNS - begun.sum(axis=1)
            shared[rows] += same
            block += 1
            rows = rows[same == COLUMNS]
        return shared


def _digest(numbers: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, numbers)).encode()).hexdigest()


_NO_ENDS = _digest([])


def shard_nodes(shard: int, rows: _Rows) -> Iterator[pa.RecordBatch]:
    """The nodes of a shard, one batch a depth, as if there were no other shard."""
    order = rows.order()
    shared = rows.shared(order)
    conv, length = rows.conv[order], rows.length[order]
    leaf = np.append(shared[1:], -1) < length
    # Bytes up to each depth, row by row.
    running = np.concatenate(([0], np.cumsum(rows.size)))
    start = rows.at[:-1][order]
    whole = running[start + length] - running[start]

    def above(row: np.ndarray, depth: np.ndarray | int) -> np.ndarray:
        """Bytes of the turns of a row up to some depth."""
        return running[start[row] + depth] - running[start[row]]

    last = len(order) - 1
    paths = {"first": hashlib.sha256(), "last": hashlib.sha256()}
    alive = np.arange(len(order))
    parents, parent_conv = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for depth in range(int(length.max()) + 1):
        alive = alive[length[alive] >= depth]
        starts = np.flatnonzero(shared[alive] < depth)
        first_rows = alive[starts]
        up = max(depth - 1, 0)
        n_convs = np.diff(np.append(starts, len(alive)))
        least = np.minimum.reduceat(conv[alive], starts)
        member = np.add.reduceat(whole[alive] - above(alive, up), starts)
        fresh = np.add.reduceat(whole[alive] - above(alive, np.maximum(shared[alive], up)), starts)
        begins = (shared[alive] <= depth) & (length[alive] > depth)
        n_children = np.add.reduceat(begins.astype(np.int64), starts)
        n_leaves = np.add.reduceat(leaf[alive].astype(np.int64), starts)

        count = len(starts)
        ended = length[alive] == depth
        n_ended = np.add.reduceat(ended.astype(np.int64), starts)
        ends: list[str] = [_NO_ENDS] * count
        on_first = np.zeros(count, bool)
        on_last = np.zeros(count, bool)
        on_first[0] = alive[0] == 0
        on_last[-1] = alive[-1] == last
        border = on_first | on_last
        pieces: list[str | None] = [None] * count
        for node in np.flatnonzero((n_ended > 0) | border).tolist():
            # The sequences that end at a node come first in it.
            numbers = conv[alive[starts[node] : starts[node] + n_ended[node]]].tolist()
            if border[node]:
                pieces[node] = ",".join(map(str, numbers))
            else:
                ends[node] = _digest(numbers)

        path: list[bytes | None] = [None] * count
        for side, row, node, there in (("first", 0, 0, on_first[0]), ("last", last, count - 1, on_last[-1])):
            if there:
                if depth:
                    whole_path = rows.digests[order[row]]
                    paths[side].update(whole_path[(depth - 1) * _ID : depth * _ID])
                path[node] = paths[side].digest()

        parent: list[int | None] = [None] * count
        side_of: list[str | None] = [None] * count
        if depth:
            at = np.searchsorted(parents, first_rows, "right") - 1
            parent = parent_conv[at].tolist()
            if parent_first:
                for node in np.flatnonzero(at == 0).tolist():
                    parent[node], side_of[node] = None, "first"
            if parent_last:
                for node in np.flatnonzero(at == len(parents) - 1).tolist():
                    parent[node], side_of[node] = None, side_of[node] or "last"
        parents, parent_conv = first_rows, least
        parent_first, parent_last = bool(on_first[0]), bool(on_last[-1])

        before: list[int | None] = [None] * count
        upto: list[int | None] = [None] * count
        if on_first[0]:
            one = np.zeros(1, np.int64)
            before[0], upto[0] = int(above(one, up)[0]), int(above(one, depth)[0])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(count, shard), pa.int32()),
                pa.array(least),
                pa.array(np.full(count, depth), pa.int32()),
                pa.array(parent, pa.int64()),
                pa.array(side_of, pa.string()),
                pa.array(n_convs),
                pa.array(n_children),
                pa.array(n_leaves),
                pa.array(member - fresh),
                pa.array(ends, pa.string(), mask=border),
                pa.array(path, pa.binary()),
                pa.array(on_first),
                pa.array(on_last),
                pa.array(pieces, pa.string()),
                pa.array(before, pa.int64()),
                pa.array(upto, pa.int64()),
            ],
            schema=_NODES,
        )


def _of_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All rows of a partition are one shard, whose size was counted."""
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    table = pa.Table.from_batches(held).combine_chunks()
    sizes = table["sizes"].combine_chunks()
    rows = _Rows(
        table["conv_id"].to_numpy(),
        table["digests"].to_pylist(),
        sizes.flatten().to_numpy(zero_copy_only=False),
    )
    yield from shard_nodes(int(table["shard"][0].as_py()), rows)


def _ends(pieces: DataFrame) -> DataFrame:
    """(path, ends_sha256): digests of pieces in the order of their shards, read as a stream."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, digest, any_yet = None, None, False
        for batch in batches:
            paths, digests = [], []
            for path, ends in zip(batch.column("path").to_pylist(), batch.column("ends")):
                if path != current:
                    if digest is not None:
                        paths.append(current)
                        digests.append(digest.hexdigest())
                    current, digest, any_yet = path, hashlib.sha256(), False
                if any_yet:
                    digest.update(b",")
                digest.update(ends.as_py().encode())
                any_yet = True
            yield pa.RecordBatch.from_arrays(
                [pa.array(paths, pa.binary()), pa.array(digests, pa.string())], ["path", "ends_sha256"]
            )
        if digest is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([current], pa.binary()), pa.array([digest.hexdigest()])], ["path", "ends_sha256"]
            )

    ordered = pieces.select("path", "shard", "ends").repartition("path").sortWithinPartitions("path", "shard")
    return ordered.drop("shard").mapInArrow(run, "path binary, ends_sha256 string")


def _neighbours(border: DataFrame) -> DataFrame:
    """(shard, shared, shared_bytes, covered) by shard: turns and bytes its first row shares with the row before
    it, and whether the row after its last one goes on from it."""
    shards = border.select("shard").distinct()
    previous = F.lag("shard").over(Window.orderBy("shard"))  # one row a shard
    linked = shards.select("shard", previous.alias("previous")).where("previous is not null")
    lasts = border.where("on_last").select(F.col("shard").alias("previous"), "path", F.col("depth").alias("up"))
    firsts = border.where("on_first").select("shard", "path", "depth", "upto")
    # The root is on every path, so each pair of neighbours meets at least there.
    met = (
        firsts.join(linked, "shard")
        .join(lasts, ["previous", "path"])
        .groupBy("shard", "previous")
        .agg(F.max("depth").alias("shared"), F.max("upto").alias("shared_bytes"))
    )
    ends = border.where("on_last").groupBy("shard").agg(F.max("depth").alias("length"))
    after = met.join(ends.withColumnRenamed("shard", "previous"), "previous").select(
        F.col("previous").alias("shard"), (F.col("shared") >= F.col("length")).alias("covered")
    )
    return shards.join(met.drop("previous"), "shard", "left").join(after, "shard", "left")


def _recombined(border: DataFrame) -> DataFrame:
    """The nodes on the paths of first and last rows, one row each, with what all shards have of them."""
    seen = border.join(_neighbours(border), "shard")
    again = F.col("on_first") & (F.col("depth") <= F.coalesce("shared", F.lit(-1)))
    fixed = seen.select(
        "path", "depth", "conv_id", "n_convs",
        (F.col("n_children") - (again & (F.col("depth") < F.col("shared"))).cast("bigint")).alias("n_children"),
        (F.col("n_leaves") - (F.col("on_last") & F.coalesce("covered", F.lit(False))).cast("bigint")).alias("n_leaves"),
        (
            F.col("saved_tokens") + F.when(again, F.col("shared_bytes") - F.col("before")).otherwise(0)
        ).alias("saved_tokens"),
    )
    sums = fixed.groupBy("path").agg(
        F.min("conv_id").alias("conv_id"),
        F.first("depth").alias("depth"),
        *[F.sum(name).alias(name) for name in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
    )
    ended = _ends(border.where("ends <> ''"))
    return sums.join(ended, "path", "left").fillna({"ends_sha256": _NO_ENDS})


def trie(conversations: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row for every node of the trie of ``conversations`` (conv_id, turns), see ``sequences``.

    conv_id is the smallest member, depth the number of turns; n_convs members, n_children, n_leaves childless
    nodes of the subtree; saved_tokens sums (members - 1) times the bytes of the last text over the
    subtree; ends_sha256 is the digest of the members that end there.
    """
    flat = conversations.select(
        "conv_id",
        F.unhex(F.array_join(F.transform("turns", lambda t: F.hex(t["id"])), "")).alias("digests"),
        F.transform("turns", lambda t: t["size"]).alias("sizes"),
    )
    flat = stored(flat, "sequences")
    total = flat.agg(F.sum(F.size("sizes") + 1).alias("n")).first().n or 0
    shards = max(1, -(-total // shard_turns))
    # By conversation too, so that equal sequences lie in as many shards as they fill.
    dealt = flat.repartitionByRange(shards, "digests", "conv_id")
    made = dealt.select(F.spark_partition_id().alias("shard"), "conv_id", "digests", "sizes")
    nodes = stored(made.mapInArrow(_of_shards, _NODE_TYPES), "shard_nodes")

    border = nodes.where("path is not null")
    whole = stored(_recombined(border), "border_nodes")
    # Which node is at which depth of a shard's paths, and its smallest member in all shards.
    named = border.select("shard", "depth", "path", F.explode(_sides()).alias("side")).join(
        whole.select("path", F.col("conv_id").alias("of_all")), "path"
    )
    named = stored(named, "border_names")
    values = ["n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    above = named.select(
        "shard", F.col("side").alias("parent_side"), (F.col("depth") + 1).alias("depth"), "of_all"
    )
    inner = nodes.where("path is null").join(above, ["shard", "parent_side", "depth"], "left").select(
        "conv_id", "depth", F.coalesce("parent_conv_id", "of_all").alias("parent_conv_id"), *values
    )
    # A border node's parent is on the same path.
    parents = (
        named.alias("n")
        .join(above.alias("a"), (F.col("n.shard") == F.col("a.shard")) & (F.col("n.side") == F.col("a.parent_side"))
              & (F.col("n.depth") == F.col("a.depth")))
        .groupBy("n.path")
        .agg(F.min("a.of_all").alias("parent_conv_id"))
    )
    outer = whole.join(parents, "path", "left").select("conv_id", "depth", "parent_conv_id", *values)
    both = inner.unionByName(outer)
    return both.withColumn("depth", F.col("depth").cast("bigint")).select(
        "conv_id", "depth", "parent_conv_id", *values
    )


def _sides() -> Column:
    sides = F.array(F.when(F.col("on_first"), F.lit("first")), F.when(F.col("on_last"), F.lit("last")))
    return F.array_compact(sides)
