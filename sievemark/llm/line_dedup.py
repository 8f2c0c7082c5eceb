"""Repeated runs of lines: winnowing over line hashes, anchors, extension, deletion.

A line is what a line break or the end of a sentence ends, so that running prose has lines too; the
full stops of Chinese and Japanese end one without a blank. Every ``RUN`` consecutive lines are
hashed, and of every ``WINDOW`` consecutive hashes the smallest is selected (the rightmost on ties).
Selected besides are every line of ``LEAST_WORDS`` or more words by itself, and every run of shorter
lines that has as many together. A repeated run of that many words thus has a selected hash in both
places, at the same place of the run, whether it is one line, two, or more.

A selected run is looked up three times: alone, with the line before it, and with the line after
it. Each of these has an anchor of its own, its first occurrence by document id and place, and what
stands later than its anchor is deleted; the first occurrence of any line stays. Selected hashes are
never more than ``WINDOW`` apart, so one line on either side is all that lies between them, and a
repeated run is found whole even if parts of it stand elsewhere, earlier, between other lines. Runs
that touch are one, and one of fewer than ``LEAST_WORDS`` words stays: short sentences repeat by chance.

Selected runs are cut into range shards by hash, bounded by counted rows. A task looks up all hashes of its
shard but the first and the last, which may go on in the next; these are looked up by joins.

Lines are compared by 64-bit hashes of their text without outer white space, in lower case. Blank
lines do not count, and go with the line before them. In scripts without spaces each character
counts as a word.

Defined results: null and empty texts have no lines. Rows equal in id and text are one document,
so neither is the later one. Ids that are null come first. Columns other than id and text are kept.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from ..plans.durable import dropped, stored
from .grouping import beside, quoted
from .hashing import mix
from .near_dedup import _sets_of as sets_of

RUN = 2
WINDOW = 2
LEAST_WORDS = 20
SHARD_ROWS = 400_000
PARTNER = 0.25
HOT_ROWS = 1000
HOT_KEYS = 10_000
LIKENESS = (5, 80)  # words of a shingle, percent
# A line feed, or the blanks after the end of a sentence; every match begins with one character
# of a set, which is what makes the search fast.
_BREAK = re.compile(r"([ \t\n](?:(?<=\n)|(?<=[.!?][ \t])[ \t]*))")
_FULL_STOPS = re.compile("[\u3002\uff01\uff1f\uff61]")
_CLOSING = "\u300d\u300f\u201d\u2019\uff09"
_BREAK_WIDE = re.compile(
    rf"([ \t\n](?:(?<=\n)|(?<=[.!?\u3002\uff01\uff1f\uff61][ \t])[ \t]*)"
    rf"|(?<=[\u3002\uff01\uff1f\uff61])(?![\u3002\uff01\uff1f\uff61{_CLOSING}])"
    rf"|(?<=[\u3002\uff01\uff1f\uff61][{_CLOSING}]))"
)
# Thai, Lao, Myanmar, Khmer, kana and Chinese characters.
_UNSPACED = re.compile(
    "[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3041-\u30ff\u3400-\u4dbf\u4e00-\u9fff"
    "\uf900-\ufaff\U00020000-\U0003ffff]"
)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _parts(text: str) -> list[str]:
    wide = not text.isascii() and _FULL_STOPS.search(text)
    return (_BREAK_WIDE if wide else _BREAK).split(text)


def split_lines(text: str) -> tuple[list[str], list[int]]:
    """The text in pieces, each with what follows it, and the pieces that are lines."""
    parts = _parts(text)
    pieces = [a + b for a, b in zip(parts[::2], [*parts[1::2], ""])]
    return pieces, [i for i, part in enumerate(parts[::2]) if part.strip()]


def count_words(text: str) -> int:
    """Words between white space; each character of a script without spaces is one."""
    if text.isascii():
        return len(text.split())
    rest, unspaced = _UNSPACED.subn(" ", text)
    return len(rest.split()) + unspaced


def line_hashes(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, word counts) of the lines of a text."""
    digest = xxhash.xxh3_64_intdigest
    keys = [k for k in map(str.strip, _parts(text.lower())[::2]) if k]
    if text.isascii() or not _UNSPACED.search(text):
        sizes = [len(k.split()) for k in keys]
    else:
        sizes = [count_words(k) for k in keys]
    return np.array([digest(k) for k in keys], np.uint64), np.array(sizes, np.int64)


def select(
    lines: np.ndarray, sizes: np.ndarray, run: int = RUN, window: int = WINDOW
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(places, lengths, hashes) of the selected runs of a text's lines, single lines last."""
    long = sizes >= LEAST_WORDS
    alone = np.flatnonzero(long)
    alone_hashes = mix(lines[alone] ^ _BASE)
    grams = len(lines) - run + 1
    if grams < 1:
        return alone, np.ones(len(alone), np.int64), alone_hashes
    total = np.full(grams, np.uint64(run))
    words, has_long = np.zeros(grams, np.int64), np.zeros(grams, bool)
    for step in range(run):
        total = mix(total * _BASE + lines[step : step + grams])
        words += sizes[step : step + grams]
        has_long |= long[step : step + grams]
    width = min(window, grams)
    # Reversed, the first of equal minima is the rightmost.
    back = total[::-1]
    least = np.arange(grams - width + 1)
    for step in range(1, width):
        other = np.arange(step, step + len(least))
        least = np.where(back[other] < back[least], other, least)
    chosen = ~has_long & (words >= LEAST_WORDS)
    chosen[grams - 1 - least] = True
    places = np.flatnonzero(chosen)
    return (
        np.concatenate((places, alone)),
        np.repeat([run, 1], [len(places), len(alone)]),
        np.concatenate((total[places], alone_hashes)),
    )


def _near(lines: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The line hashes at some places, and which are not there."""
    missing = (at < 0) | (at >= len(lines))
    return lines[np.where(missing, 0, at)], missing


def fingerprints(
    docs: DataFrame, run: int, window: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(hash, id, version, place, length, before, after): the selected runs of each text.

    ``before`` and ``after`` are the lines next to the run.
    """
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, hashes, place, length, before, after = [], [], [], [], [], []
            for i, text in enumerate(batch.column("text")):
                lines, sizes = line_hashes(text.as_py())
                places, lengths, found = select(lines, sizes, run, window)
                if not len(places):
                    continue
                signed = lines.view(np.int64)
                rows.append(np.full(len(found), i))
                hashes.append(found.view(np.int64))
                place.append(places)
                length.append(lengths)
                before.append(_near(signed, places - 1))
                after.append(_near(signed, places + lengths))
            if not rows:
                continue
            at = pa.array(np.concatenate(rows))
            sides = [
                pa.array(np.concatenate(values), mask=np.concatenate(missing))
                for values, missing in (zip(*before), zip(*after))
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(hashes)),
                    batch.column("id").take(at),
                    batch.column("version").take(at),
                    pa.array(np.concatenate(place), pa.int32()),
                    pa.array(np.concatenate(length), pa.int32()),
                    *sides,
                ],
                ["hash", "id", "version", "place", "length", "before", "after"],
            )

    rows = docs.select(
        F.col(id_col).cast("bigint").alias("id"),
        F.xxhash64(text_col).alias("version"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    return rows.mapInArrow(
        of,
        "hash bigint, id bigint, version bigint, place int, length int, before bigint, after bigint",
    )


_SHARD_TYPES = (
    "id bigint, version bigint, start int, stop int, first_id bigint, first_version bigint, "
    "key bigint, lap int, open boolean"
)
_WAYS = (("alone", 0, 0), ("before", 1, 0), ("after", 0, 1))


def _numbers(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Values, 0 for nulls, and which are there."""
    there = column.is_valid().to_numpy()
    return column.fill_null(0).to_numpy(), there


def _ranks(*keys: np.ndarray) -> np.ndarray:
    """The rank of each row by the keys, the first one first; equal rows have equal ranks."""
    order = np.lexsort(keys[::-1])
    changed = np.zeros(len(order), np.int64)
    for key in keys:
        changed[1:] |= key[order][1:] != key[order][:-1]
    ranks = np.empty(len(order), np.int64)
    ranks[order] = np.cumsum(changed)
    return ranks


def _firsts(rows: np.ndarray, place: np.ndarray, *keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows by their keys, and for each the first of those that share its keys, by ``place``."""
    order = rows[np.lexsort((place[rows], *(key[rows] for key in keys[::-1])))]
    begins = np.ones(len(order), bool)
    if len(order):
        begins[1:] = False
    for key in keys:
        begins[1:] |= key[order][1:] != key[order][:-1]
    starts = np.flatnonzero(begins)
    return order, np.repeat(order[starts], np.diff(np.append(starts, len(order))))


def shard_runs(prints: pa.Table, anchors: bool) -> pa.Table:
    """What repeats in one shard, see ``_SHARD_TYPES``.

    The first and the last hash may go on in other shards. What repeats a print of such a hash in the same shard is
    certain to repeat the first of all, whose document it gets later, by key. The first one here, and what
    overlaps it, is ``open``: whether it repeats depends on the other shards.
    """
    hashes = prints["hash"].to_numpy()
    edge = (hashes == hashes.min()) | (hashes == hashes.max())
    order = np.argsort(hashes, kind="stable")
    equal = np.zeros(len(order) + 1, bool)
    equal[1:-1] = hashes[order][1:] == hashes[order][:-1]
    twice = np.zeros(len(order), bool)
    twice[order] = equal[1:] | equal[:-1]
    table, edge = prints.filter(pa.array(twice | edge)), edge[twice | edge]

    hashes = table["hash"].to_numpy()
    (ids, known), version = _numbers(table["id"]), table["version"].to_numpy()
    start = table["place"].to_numpy().astype(np.int64)
    stop = start + table["length"].to_numpy()
    # Ids that are null come first.
    doc = _ranks(known, ids, version)
    place = _ranks(doc, start)
    group = _ranks(hashes)
    rows = np.arange(len(doc))
    made = []

    def add(at: np.ndarray, left: object, right: object, of: np.ndarray | None, key: np.ndarray | None, is_open: bool) -> None:
        some = pa.array(at)
        columns = [
            table["id"].take(some),
            table["version"].take(some),
            pa.array(start[at] - left, pa.int32()),
            pa.array(stop[at] + right, pa.int32()),
            pa.nulls(len(at), pa.int64()) if of is None else table["id"].take(pa.array(of)),
            pa.nulls(len(at), pa.int64()) if of is None else table["version"].take(pa.array(of)),
            pa.nulls(len(at), pa.int64()) if key is None else pa.array(key.view(np.int64)),
            pa.array(np.full(len(at), right if is_open else 0), pa.int32()),
            pa.array(np.full(len(at), is_open)),
        ]
        made.append(pa.table(columns, [field.split()[0] for field in _SHARD_TYPES.split(", ")]))

    anchor, keys = [], []
    for number, (side, shift, lap) in enumerate(_WAYS):
        if side == "alone":
            found, first = _firsts(rows, place, group)
            key = mix(hashes.view(np.uint64))
        else:
            values, there = _numbers(table[side])
            found, first = _firsts(rows[there], place, group, values)
            key = mix(mix(hashes.view(np.uint64)) * _BASE + values.view(np.uint64) + np.uint64(number))
        # Within one document a run must begin after its anchor ends.
        good = (doc[found] != doc[first]) | (start[found] - shift >= stop[first])
        of = np.full(len(rows), -1)
        of[found[good]] = first[good]
        anchor.append(of)
        keys.append(key)
        unsure = found[~good & edge[found]]
        add(unsure, shift, lap, None, key[unsure], True)
    alone, before, after = anchor
    if not anchors:
        every = np.flatnonzero((alone >= 0) | (before >= 0) | (after >= 0))
        add(every, before[every] >= 0, after[every] >= 0, None, None, False)
        return pa.concat_tables(made)
    # One run for each anchoring document.
    docs_of = [np.where(of >= 0, doc[of], -1) if len(doc) else of for of in anchor]
    left = (before >= 0) & (docs_of[1] == docs_of[0]) & ~edge
    right = (after >= 0) & (docs_of[2] == docs_of[0]) & ~edge
    for (_, shift, lap), of, key, extra in zip(_WAYS, anchor, keys, (None, left, right)):
        for border in (False, True):
            at = np.flatnonzero((of >= 0) & (edge == border) & (True if extra is None else ~extra))
            sides = (left[at], right[at]) if extra is None else (shift, lap)
            add(at, *sides, None if border else of[at], key[at] if border else None, False)
    return pa.concat_tables(made)


Hot = dict[int, tuple[int | None, int]]


def found_runs(
    docs: DataFrame,
    run: int = RUN,
    window: int = WINDOW,
    id_col: str = "doc_id",
    text_col: str = "text",
    anchors: bool = False,
    shard_rows: int = SHARD_ROWS,
    hot_rows: int = HOT_ROWS,
) -> tuple[DataFrame, Hot]:
    """(id, version, runs): the lines, from start up to stop, that repeat earlier ones.

    With ``anchors``, each run also has the id and version of its anchor, or a key of the second result, which
    has the anchors that ``hot_rows`` runs or more at shards' borders share, ``HOT_KEYS`` at most.
    """
    prints = stored(fingerprints(docs, run, window, id_col, text_col), "line_prints")
    shards = max(1, -(-prints.count() // shard_rows))
    # A shard is a range, by place too, so a hash of any number of rows lies in as many as it fills.
    dealt = prints.repartitionByRange(shards, "hash", "id", "version", "place")

    def of_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [batch for batch in batches if batch.num_rows]
        if held:
            yield from shard_runs(pa.Table.from_batches(held), anchors).to_batches(max_chunksize=10_000)

    found = stored(dealt.mapInArrow(of_shard, _SHARD_TYPES), "shard_runs")
    dropped(prints)
    # One row for a key in each shard, or a few where it overlaps itself.
    unsure = found.where("open")
    first = unsure.groupBy("key").agg(
        F.count("*").alias("spots"), F.min(F.struct("id", "version", "start", "stop")).alias("anchor")
    )
    first = stored(first, "border_anchors")
    same = F.col("id").eqNullSafe(F.col("anchor.id")) & (F.col("version") == F.col("anchor.version"))
    # The line after a run may be the first one of its anchor.
    later = ~same | (F.col("start") >= F.col("anchor.stop") - F.col("lap"))
    names = ["id", "version", "start", "stop", "first_id", "first_version"]
    of_anchor = [F.col("anchor.id").alias("first_id"), F.col("anchor.version").alias("first_version")]
    opened = (
        unsure.drop("first_id", "first_version")
        .join(first.where("spots > 1"), "key")
        .where(later)
        .select("id", "version", "start", "stop", *of_anchor, F.lit(None).cast("bigint").alias("key"))
    )
    sure = found.where("not open").select(*names, "key")
    hot: Hot = {}
    if anchors:
        shared = sure.where("key is not null").groupBy("key").agg(F.count("*").alias("n"))
        named = stored(shared.join(first, "key").select("key", "n", "anchor"), "named_anchors")
        total = named.agg(F.sum("n").alias("n")).first().n or 0
        least = max(hot_rows, -(-total // HOT_KEYS))
        hot = {r.key: (r.anchor.id, r.anchor.version) for r in named.where(F.col("n") >= least).collect()}
        frequent = F.col("key").isin(list(hot))
        known = (
            sure.drop("first_id", "first_version")
            .where(F.col("key").isNotNull() & ~frequent)
            .join(named.where(F.col("n") < least), "key")
            .select("id", "version", "start", "stop", *of_anchor, F.lit(None).cast("bigint").alias("key"))
        )
        sure = sure.where(F.col("key").isNull() | frequent).unionByName(known)
    parts = ["start", "stop", *(["first_id", "first_version", "key"] if anchors else [])]
    both = sure.unionByName(opened).select("id", "version", F.struct(*parts).alias("run"))
    return both.groupBy("id", "version").agg(F.collect_set("run").alias("runs")), hot


def _without(
    text: str, runs: pa.StructArray, least_words: int, spare: float | None, hot: Hot
) -> tuple[str, int, int, list[dict] | None]:
    """The text without the runs, how many lines went, and how many are left.

    With ``spare``, also the anchors of a text of which at least that share goes, most text first: those that hold
    ``PARTNER`` of its characters. A document whose near copy this text is holds more, unless its lines repeat others.
    """
    pieces, lines = split_lines(text)
    starts, stops = (np.minimum(runs.field(name).to_numpy(), len(lines)) for name in ("start", "stop"))
    depth = np.zeros(len(lines) + 1, np.int64)
    np.add.at(depth, starts, 1)
    np.add.at(depth, stops, -1)
    gone = np.cumsum(depth)[:-1] > 0
    edges = np.flatnonzero(np.diff(np.concatenate(([False], gone, [False]))))
    for start, stop in zip(edges[::2].tolist(), edges[1::2].tolist()):
        if sum(count_words(pieces[i]) for i in lines[start:stop]) < least_words:
            gone[start:stop] = False
    anchors = None
    if spare is not None and gone.any():
        size = np.array([len(pieces[i]) for i in lines])
        if size[gone].sum() >= spare * size.sum():
            shared: dict[tuple, set[int]] = {}
            named = zip(*(runs.field(name).to_pylist() for name in ("first_id", "first_version", "key")))
            for start, stop, (first_id, first_version, key) in zip(starts.tolist(), stops.tolist(), named):
                of = shared.setdefault(hot.get(key) or (first_id, first_version), set())
                of.update(range(start, stop))
            chars = {of: int(size[list(at)].sum()) for of, at in shared.items()}
            order = sorted(chars, key=lambda of: (-chars[of], repr(of)))
            anchors = [{"id": i, "version": v} for i, v in order if chars[i, v] >= PARTNER * size.sum()]
    # What is no line goes with the line before it.
    owner = np.searchsorted(lines, np.arange(len(pieces)), "right") - 1
    kept = [p for p, o in zip(pieces, owner.tolist()) if o < 0 or not gone[o]]
    return "".join(kept), int(gone.sum()), int((~gone).sum()), anchors


def _copies(cut: DataFrame, k: int, percent: int) -> DataFrame:
    """(id, version) of texts over the share that are near copies of an anchor.

    An anchor that is over the share itself does not count, as its text may be cut too. The
    likeness is exact, between the whole text and what is left of the anchor's.
    """
    partner = F.col("partner")
    over = cut.where("anchors is not null").select(
        "id", "version", F.col("whole"), F.explode("anchors").alias("partner")
    )
    others = (
        cut.where("anchors is null")
        .select(F.col("id").alias("other_id"), F.col("version").alias("other_version"), F.col("text").alias("other"))
    )
    # Only anchors that are named travel.
    named = over.select(partner["id"].alias("n_id"), partner["version"].alias("n_version")).distinct()
    others = others.join(
        named,
        F.col("other_id").eqNullSafe(F.col("n_id")) & (F.col("other_version") == F.col("n_version")),
        "left_semi",
    ).dropDuplicates(["other_id", "other_version"])
    pairs = over.join(
        others,
        partner["id"].eqNullSafe(F.col("other_id")) & (partner["version"] == F.col("other_version")),
    ).select("id", "version", "whole", "other")

    def alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = (sets_of(batch.column(name), k) for name in ("whole", "other"))
            near = []
            for a, b in zip(*sides):
                both = len(np.intersect1d(a, b, assume_unique=True))
                near.append(both > 0 and 100 * both >= percent * (len(a) + len(b) - both))
            yield batch.select(["id", "version"]).filter(pa.array(near, pa.bool_()))

    return pairs.mapInArrow(alike, "id bigint, version bigint").distinct()


def drop_repeated_runs(
    docs: DataFrame,
    run: int = RUN,
    window: int = WINDOW,
    least_words: int = LEAST_WORDS,
    spare: float | None = None,
    likeness: tuple[int, int] = LIKENESS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``docs`` without later repeated runs, with ``n_removed`` lines and whether all went (``emptied``).

    Columns of these names are replaced.

    With ``spare``, a text of which at least that share of characters would go is left whole
    if it is a near copy of an earlier document: at least ``likeness`` percent of their shingles
    of so many words are shared. It is to be judged as a document; all others are cut.
    """
    docs = docs.drop("n_removed", "emptied")
    found, hot = found_runs(docs, run, window, id_col, text_col, spare is not None)
    runs = stored(found, "repeated_runs")
    marked = runs.select(
        F.col("id").alias("__id"), F.col("version").alias("__version"), F.col("runs").alias("__runs")
    )
    names = docs.columns
    others = [docs[quoted(n)] for n in names if n != text_col]
    joined = (
        docs.withColumn("__of", F.xxhash64(text_col))
        .join(
            marked,
            docs[id_col].cast("bigint").eqNullSafe(F.col("__id")) & (F.col("__of") == F.col("__version")),
            "left",
        )
        .select(
            (F.struct(*others) if others else F.lit(True)).alias("kept"),
            docs[text_col].alias("text"),
            F.col("__runs").alias("runs"),
            docs[id_col].cast("bigint").alias("id"),
            F.col("__of").alias("version"),
        )
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.num_rows
            given, runs = batch.column("text"), batch.column("runs")
            some, ends = runs.flatten(), np.cumsum(runs.value_lengths().fill_null(0).to_numpy())
            # Only texts with runs are taken apart.
            cut_rows = np.flatnonzero(np.diff(ends, prepend=0)).tolist()
            texts, removed, emptied = [], np.zeros(size, np.int64), np.zeros(size, bool)
            whole, anchors = [None] * size, [None] * size
            for i in cut_rows:
                start = ends[i - 1] if i else 0
                content = given[i].as_py()
                text, gone, left, of = _without(content, some.slice(start, ends[i] - start), least_words, spare, hot)
                texts.append(text)
                removed[i], emptied[i], anchors[i] = gone, left == 0, of
                whole[i] = None if of is None else content
            mask = np.zeros(size, bool)
            mask[cut_rows] = True
            new = pc.replace_with_mask(given, pa.array(mask), pa.array(texts, given.type))
            made = [batch.column("kept"), new, pa.array(removed), pa.array(emptied)]
            names = ["kept", "text", "n_removed", "emptied"]
            if spare is not None:
                pair = pa.struct([("id", pa.int64()), ("version", pa.int64())])
                made += [batch.column("id"), batch.column("version"), pa.array(whole, pa.string()),
                         pa.array(anchors, pa.list_(pair))]
                names += ["id", "version", "whole", "anchors"]
            yield pa.RecordBatch.from_arrays(made, names)

    shape = "text string, n_removed bigint, emptied boolean"
    columns = [F.col("text").alias(n) if n == text_col else F.col(f"kept.{quoted(n)}").alias(n) for n in names]
    if spare is None:
        return joined.mapInArrow(cut, beside(joined, "kept", shape)).select(*columns, "n_removed", "emptied")
    shape += ", id bigint, version bigint, whole string, anchors array<struct<id: bigint, version: bigint>>"
    done = stored(joined.mapInArrow(cut, beside(joined, "kept", shape)), "cut_texts")
    copies = stored(_copies(done, *likeness), "copies").select(
        F.col("id").alias("copy_id"), F.col("version").alias("copy_version"), F.lit(True).alias("spared")
    )
    same = F.col("id").eqNullSafe(F.col("copy_id")) & (F.col("version") == F.col("copy_version"))
    spared = F.col("spared").isNotNull()
    return (
        done.join(copies, same, "left")
        .withColumn("text", F.when(spared, F.col("whole")).otherwise(F.col("text")))
        .withColumn("n_removed", F.when(spared, 0).otherwise(F.col("n_removed")).cast("bigint"))
        .withColumn("emptied", F.col("emptied") & ~spared)
        .select(*columns, "n_removed", "emptied")
    )
