"""Finding batch files and telling whether their content has changed.

A batch is one file, and its year is in the file name. Years fit four digits, so
lists of batches are short and may live on the driver; file content never does.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from fnmatch import fnmatchcase

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import canonical_text, md5_number
from ..plans.durable import stored
from . import storage

# Fixed value: the naming convention of annual files.
NAME_PATTERN = r"^food_inspections_([0-9]{4})\.csv$"

# The digest of a file of any size that is taken in splits: a hash tree over its lines.
LINE_DIGEST = "sha256-lines"
# Children of a node of the tree.
FAN = 1024

BATCHES = (
    "batch_year smallint, path string, size_bytes bigint, checksum_algorithm string, checksum string"
)


@dataclass(frozen=True)
class BatchFile:
    year: int
    name: str
    path: str
    size_bytes: int


def batch_year(name: Column, pattern: str = NAME_PATTERN) -> Column:
    """Year in a file name; null when the name does not follow the convention."""
    return F.nullif(F.regexp_extract(name, pattern, 1), F.lit("")).try_cast("smallint")


def batch_year_ranges(
    names: DataFrame, name: str, *, start_year: int, end_year: int, pattern: str = NAME_PATTERN
) -> DataFrame:
    """Per file name: its year and whether that is within the accepted range."""
    year = batch_year(F.col(name), pattern)
    return names.select(
        name,
        year.alias("batch_year"),
        F.coalesce(year.between(start_year, end_year), F.lit(False)).alias("accepted"),
    )


def _batch_file(entry: storage.Entry, start_year: int, end_year: int, pattern: str) -> BatchFile:
    match = re.fullmatch(pattern, entry.name)
    if match is None:
        raise ValueError(f"batch file name does not follow the convention: {entry.name}")
    year = int(match.group(1))
    if not start_year <= year <= end_year:
        raise ValueError(f"batch year {year} is outside {start_year}-{end_year}")
    return BatchFile(year, entry.name, entry.path, entry.size_bytes)


def discover_batches(
    spark: SparkSession,
    folder: str,
    *,
    file_pattern: str,
    start_year: int,
    end_year: int,
    name_pattern: str = NAME_PATTERN,
) -> list[BatchFile]:
    """Batch files of a folder by year and name; content is not read.

    Entries that do not match the glob are ignored. One that does must follow the
    naming convention and lie in the year range.
    """
    glob = file_pattern.strip() if isinstance(file_pattern, str) else ""
    if not glob or "/" in glob or "\\" in glob or glob in {".", ".."}:
        raise ValueError("file pattern must be a file name pattern without folders")
    found = storage.entries(spark, folder)
    if found is None:
        raise ValueError(f"folder of incoming batches not found: {folder}")
    batches = [
        _batch_file(entry, start_year, end_year, name_pattern)
        for entry in found
        if entry.is_file and fnmatchcase(entry.name, glob)
    ]
    return sorted(batches, key=lambda batch: (batch.year, batch.name))


def locate_batch(
    spark: SparkSession,
    path: str,
    *,
    start_year: int,
    end_year: int,
    name_pattern: str = NAME_PATTERN,
) -> BatchFile:
    """One batch file given by its path."""
    entry = storage.file_entry(spark, path)
    if entry is None or not entry.is_file:
        raise ValueError(f"batch file not found: {path}")
    return _batch_file(entry, start_year, end_year, name_pattern)


def _line_kinds(delimiter: str) -> list[Column]:
    """Of a line ``value``: is it UTF-8, is it ASCII, is it whole records."""
    value = F.col("value")
    body = F.regexp_replace(value, r"\r\z", "")
    valid = F.is_valid_utf8(value)
    plain = ~F.contains(value, F.lit('"')) & ~F.contains(value, F.lit("\r"))
    return [
        valid.alias("valid"),
        (valid & (F.octet_length(value) == F.char_length(value))).alias("ascii"),
        F.when(plain, True)
        .otherwise(~F.contains(body, F.lit("\r")) & _quotes_are_whole_fields(body, delimiter))
        .alias("simple"),
    ]


_FILE_KINDS = {"valid_utf8": "valid", "ascii": "ascii", "one_line_records": "simple"}


def file_kinds(
    spark: SparkSession, paths: Sequence[str], *, delimiter: str = ","
) -> DataFrame:
    """The ``line_facts`` of files but their digests, so no line is kept or hashed."""
    read = spark.read.option("lineSep", "\n").text(list(paths))
    lines = read.select(F.col("_metadata.file_name").alias("file_name"), *_line_kinds(delimiter))
    kinds = [F.bool_and(of).alias(name) for name, of in _FILE_KINDS.items()]
    return lines.groupBy("file_name").agg(*kinds)


def line_facts(
    spark: SparkSession, paths: Sequence[str], *, delimiter: str = ","
) -> DataFrame:
    """Per file, from one scan that splits large files.

    Lines are what line feeds end, byte by byte. ``digest`` is the number of lines and the root of a
    hash tree over them, so it depends on every line and its position, but not on splits. ``valid_utf8``
    and ``ascii`` tell what the bytes are. ``one_line_records`` tells whether every quote
    opens at the start of a field and closes at its end on the same line, and carriage
    returns only end lines; then no record spans lines.
    """
    read = spark.read.option("lineSep", "\n").text(list(paths))
    lines = read.select(
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_block_start").alias("block"),
        F.unhex(F.sha2(F.concat(F.lit("0:"), F.col("value")), 256)).alias("hash"),
        *_line_kinds(delimiter),
    )
    # 32 bytes a line: the tree needs the number of a line, which only a whole scan tells.
    runs = stored(_line_runs(lines), "line_hashes")
    blocks = runs.groupBy("file_name", "block").agg(
        F.sum("lines").alias("lines"),
        F.bool_and("valid").alias("valid"),
        F.bool_and("ascii").alias("ascii"),
        F.bool_and("simple").alias("simple"),
    )
    # One row per input split: at most (bytes read / split size) rows in all.
    before = "sum(lines) OVER (PARTITION BY file_name ORDER BY block) - lines"
    blocks = stored(blocks.withColumn("before", F.expr(before)), "line_blocks")
    files = blocks.groupBy("file_name").agg(
        F.sum("lines").alias("lines"),
        *[F.bool_and(of).alias(name) for name, of in _FILE_KINDS.items()],
    )
    starts = blocks.select("file_name", "block", "before").join(
        files.select("file_name", F.col("lines").alias("total")), "file_name"
    )
    numbered = runs.join(F.broadcast(starts), ["file_name", "block"]).select(
        "file_name", (F.col("before") + F.col("at")).alias("first"), "lines", "total", "hashes"
    )
    most = files.agg(F.max("lines").alias("n")).first().n or 0
    roots = hash_tree(lowest_nodes(numbered), -(-most // FAN))
    return files.join(roots, "file_name").select(
        "file_name",
        F.concat_ws("-", F.col("lines").cast("string"), F.lower(F.hex("hash"))).alias("digest"),
        "valid_utf8",
        "ascii",
        "one_line_records",
    )


def _line_runs(lines: DataFrame) -> DataFrame:
    """Up to ``FAN`` consecutive lines of a split a row: ``at`` is the number in its split of the first.

    ``hashes`` holds those of the lines one after the other, so that later steps move few rows.
    """
    most = FAN

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, seen = None, 0
        for part in parts:
            if not part.num_rows:
                continue
            names, hashes = part.column("file_name"), part.column("hash")
            blocks, codes = part.column("block").to_numpy(), names.dictionary_encode().indices.to_numpy()
            kinds = [part.column(of).to_numpy(zero_copy_only=False) for of in _FILE_KINDS.values()]
            changed = np.flatnonzero((codes[1:] != codes[:-1]) | (blocks[1:] != blocks[:-1])) + 1
            bounds, rows = [0, *changed.tolist(), part.num_rows], []
            for start, stop in zip(bounds, bounds[1:]):
                if split != (names[start].as_py(), int(blocks[start])):
                    split, seen = (names[start].as_py(), int(blocks[start])), 0
                for at in range(start, stop, most):
                    end = min(at + most, stop)
                    joined = b"".join(hashes.slice(at, end - at).to_pylist())
                    rows.append((*split, seen, end - at, *[bool(kind[at:end].all()) for kind in kinds], joined))
                    seen += end - at
            kinds_of = [pa.bool_()] * len(kinds)
            types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), *kinds_of, pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in zip(zip(*rows), types)],
                ["file_name", "block", "at", "lines", *_FILE_KINDS.values(), "hashes"],
            )

    kinds = ", ".join(f"{of} boolean" for of in _FILE_KINDS.values())
    return lines.select("file_name", "block", "hash", *_FILE_KINDS.values()).mapInArrow(
        run, f"file_name string, block bigint, at bigint, lines bigint, {kinds}, hashes binary"
    )


def lowest_nodes(runs: DataFrame) -> DataFrame:
    """(file_name, number, hash, lines) of the nodes above each file's ``total`` lines, of which ``lines`` are the nodes.

    ``runs`` has the ``hashes`` of ``lines`` lines from number ``first`` on, ``FAN`` at most. A run lies in one node or two.
    """
    parts = runs.withColumn("number", F.expr(f"explode(sequence(first DIV {FAN}, (first + lines - 1) DIV {FAN}))"))
    skipped, until = f"greatest(number * {FAN} - first, 0L)", f"least((number + 1) * {FAN} - first, lines)"
    part = f"substring(hashes, cast({skipped} AS int) * 32 + 1, cast({until} - {skipped} AS int) * 32)"
    cut = parts.select(
        "file_name", "number", "total", F.expr(f"named_struct('first', first + {skipped}, 'part', {part})").alias("part")
    )
    texts = F.transform(F.array_sort(F.collect_list("part")), lambda part: F.lower(F.hex(part["part"])))
    return cut.groupBy("file_name", "number").agg(
        _node(texts).alias("hash"), F.ceil(F.first("total") / FAN).alias("lines")
    )


def _node(texts: Column) -> Column:
    """A node's hash from those of its children, written in hexadecimal."""
    return F.unhex(F.sha2(F.concat(F.lit("1:"), F.array_join(texts, "")), 256))


def hash_tree(nodes: DataFrame, most: int) -> DataFrame:
    """(file_name, hash): the root of the tree over each file's (number, hash) of ``lines`` lowest nodes, numbers from 0.

    A node is the SHA-256 of ``FAN`` consecutive children, written in hexadecimal after a mark that no leaf has.
    ``most`` is the number of lowest nodes of the largest file. Each level is one aggregation of bounded groups;
    the root of a file that is done stays as it is.
    """
    level = nodes.withColumn("done", F.col("lines") == 1)
    while most > 1:
        children = F.array_sort(F.collect_list(F.struct("number", "hash")))
        node = _node(F.transform(children, lambda child: F.lower(F.hex(child["hash"]))))
        level = (
            level.groupBy("file_name", F.expr(f"number DIV {FAN}").alias("node"))
            .agg(
                F.when(F.first("done"), F.first("hash")).otherwise(node).alias("hash"),
                F.ceil(F.first("lines") / FAN).alias("lines"),
            )
            .withColumn("done", F.col("lines") == 1)
            .withColumnRenamed("node", "number")
        )
        most = -(-most // FAN)
    return level.select("file_name", "hash")


def pair_quotes(text: Column) -> Column:
    """Each pair of quotes and what it encloses as one mark; an unpaired quote stays."""
    return F.regexp_replace(text, '"[^"]*"', "\x01")


def _quotes_are_whole_fields(line: Column, delimiter: str) -> Column:
    paired, edge = pair_quotes(line), re.escape(delimiter)
    inside = rf"[^{edge}\x01]\x01|\x01[^{edge}\x01]"
    return ~paired.contains('"') & ~paired.rlike(inside)


def check_algorithm(algorithm: object) -> str:
    """The name of a digest: ``sha256-lines``, or any that hashlib knows and that has a fixed length."""
    name = algorithm.strip().lower() if isinstance(algorithm, str) else ""
    if name != LINE_DIGEST:
        try:
            hashlib.new(name).hexdigest()
        except (ValueError, TypeError):
            raise ValueError(f"unsupported hash algorithm: {algorithm!r}") from None
    return name


@contextmanager
def _unsplit(spark: SparkSession) -> Iterator[None]:
    """Scans that are run meanwhile have one split for each file, and one task for each split."""
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {key: spark.conf.get(key) for key in keys}
    try:
        for key in keys:
            spark.conf.set(key, str(1 << 60))
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def whole_digests(
    spark: SparkSession, batches: Sequence[BatchFile], algorithm: str
) -> dict[str, str]:
    """Digest of the bytes of every file, by name; no file is empty.

    Such a digest needs all bytes in order, so a task reads a file, but as a stream of its lines: it
    holds one batch of them and the state of the hash, whatever the size.
    """
    sizes = {batch.name: batch.size_bytes for batch in batches}

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, state, seen, done = None, None, 0, []

        def finish() -> None:
            # The bytes tell whether a line feed ends the last line.
            if sizes[name] == seen + 1:
                state.update(b"\n")
            elif sizes[name] != seen:
                raise RuntimeError(f"{name} changed while it was read")
            done.append((name, state.hexdigest()))

        for part in parts:
            blocks = part.column("block").to_pylist()
            for at, (file_name, line) in enumerate(zip(part.column("file_name").to_pylist(), part.column("line"))):
                if file_name != name:
                    if name is not None:
                        finish()
                    if blocks[at]:
                        raise RuntimeError(f"{file_name} was split")
                    name, state, seen = file_name, hashlib.new(algorithm), 0
                else:
                    state.update(b"\n")
                    seen += 1
                content = line.as_py()
                state.update(content)
                seen += len(content)
        if name is not None:
            finish()
        names, digests = zip(*done) if done else ((), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array(digests, pa.string())], ["file_name", "checksum"]
        )

    with _unsplit(spark):
        lines = spark.read.option("lineSep", "\n").text([batch.path for batch in batches])
        named = lines.select(
            F.col("_metadata.file_name").alias("file_name"),
            F.col("_metadata.file_block_start").alias("block"),
            F.col("value").cast("binary").alias("line"),
        )
        found = named.mapInArrow(run, "file_name string, checksum string").collect()
    return {row.file_name: row.checksum for row in found}  # one row per batch


def inspect_batches(
    spark: SparkSession,
    batches: Sequence[BatchFile],
    *,
    algorithm: str = LINE_DIGEST,
    facts: DataFrame | None = None,
) -> DataFrame:
    """Size and checksum of every batch file (see ``BATCHES``).

    ``facts`` are the ``line_facts`` of the files, if they are known already. An empty file counts as
    the digest of nothing.
    """
    name = check_algorithm(algorithm)
    full = [batch for batch in batches if batch.size_bytes > 0]
    if name != LINE_DIGEST:
        digests = whole_digests(spark, full, name) if full else {}
        nothing = hashlib.new(name).hexdigest()
    else:
        if full and facts is None:
            facts = line_facts(spark, [batch.path for batch in full])
        digests = {row.file_name: row.digest for row in facts.collect()} if full else {}
        nothing = "0"
    return spark.createDataFrame(
        [
            (batch.year, batch.path, batch.size_bytes, name, digests[batch.name] if batch.size_bytes else nothing)
            for batch in batches
        ],
        BATCHES,
    )


def content_fingerprint(df: DataFrame, columns: Sequence[str], *, batch: str) -> DataFrame:
    """Row count and content checksum per batch of a table, whatever the row order."""
    joined = canonical_text(df.schema, columns)
    return df.groupBy(batch).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.expr(f"cast(sum({md5_number(joined)}) AS string)").alias("checksum"),
    )
