"""What only a whole batch can tell: clashing identifiers and exact duplicates.

Both questions are answered by one pass over the rows and one shuffle of short
keys. Each row sends its identifier and the digest of its other columns; equal
keys are counted map-side first, so a key held by a third of all rows costs no
more than any other. Only groups of two or more are kept.

Duplicates are looked for only in batches whose identifiers are all sound (the
gate), so a row needs one lookup: by identifier when its batch is gated, by
digest when it is not.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions import row_digest
from ..plans import lookup
from ..plans.durable import durable
from .rules import ID_HELPER, identifier_rule, with_helpers

CLASH = "__clash"
KEPT = "__kept"
GATED = "__gated"
_DIGEST_BYTES = 32
_UNSOUND = b""


@dataclass(frozen=True)
class Conflicts:
    """Groups of rows that share a key, per batch, and the batches that are gated."""

    groups: DataFrame
    gated: DataFrame
    batch: str
    compared: tuple[str, ...]
    group_count: int
    grouped_rows: int
    clash_count: int
    unsound_count: int

    @property
    def moves_rows(self) -> bool:
        """Whether attaching the groups shuffles the rows."""
        return self.group_count > lookup.MAX_BROADCAST_GROUPS


def _identifier_key(number: Column) -> Column:
    return F.encode(number.cast("string"), "UTF-8")  # at most 19 bytes, so never a digest


def find_conflicts(
    df: DataFrame, *, compared: Sequence[str], batch: str, minimum: int = 1
) -> Conflicts:
    """Groups that share an identifier or a digest. ``df`` carries the identifier helper.

    Without ``compared`` columns only identifiers are looked at.
    The batch column must be SMALLINT: that bounds the number of batches, and with
    it everything that is broadcast per batch.
    """
    if not isinstance(df.schema[batch].dataType, T.ShortType):
        raise ValueError(f"batch column {batch} must be SMALLINT")
    number = F.col(ID_HELPER)
    unsound = number.isNull() | (number < F.lit(minimum))
    gate_entry = F.array(F.lit(_UNSOUND))
    digests = [F.expr(row_digest(df.schema, compared))] if compared else []
    own_keys = F.array(_identifier_key(number), *digests)
    keys = df.select(
        batch,
        F.when(~unsound, number).alias("id"),
        F.explode(F.when(unsound, gate_entry).otherwise(own_keys)).alias("key"),
    )
    short = F.octet_length("key") < _DIGEST_BYTES
    is_gate = F.col("key") == F.lit(_UNSOUND)
    groups, counts = durable(
        keys.groupBy(batch, "key")
        .agg(F.count(F.lit(1)).alias("size"), F.min("id").alias("kept"))
        .where((F.col("size") > 1) | is_gate),
        groups=F.count(F.lit(1)),
        rows=F.coalesce(F.sum("size"), F.lit(0)),
        unsound=F.count_if(is_gate),
        clashes=F.count_if(short & ~is_gate),
    )
    return Conflicts(
        groups=groups,
        gated=groups.where(short).select(batch).distinct(),
        batch=batch,
        compared=tuple(compared),
        group_count=counts["groups"],
        grouped_rows=counts["rows"],
        clash_count=counts["clashes"],
        unsound_count=counts["unsound"],
    )


def attach_conflicts(df: DataFrame, conflicts: Conflicts, row_id: str) -> DataFrame:
    """Add, per row: is its batch gated, does its identifier clash, which row is kept for it."""
    batch, number = conflicts.batch, F.col(ID_HELPER)
    if conflicts.unsound_count or conflicts.clash_count:
        flags = conflicts.gated.withColumn(GATED, F.lit(True))
        rows = df.join(F.broadcast(flags), batch, "left")  # null where not gated
        digest_in_gated = (F.octet_length("key") == _DIGEST_BYTES) & F.col(GATED)
        groups = (
            conflicts.groups.join(F.broadcast(flags), batch, "left")
            .where((F.col("key") != F.lit(_UNSOUND)) & ~F.coalesce(digest_in_gated, F.lit(False)))
            .drop(GATED)
        )
    else:
        rows, groups = df.withColumn(GATED, F.lit(False)), conflicts.groups

    if conflicts.group_count == conflicts.unsound_count:  # nothing but gate entries
        nothing = {CLASH: F.lit(False), KEPT: F.lit(None).cast("bigint")}
        return rows.withColumns({**nothing, GATED: F.coalesce(GATED, F.lit(False))})

    key = F.when(F.col(GATED), _identifier_key(number))
    if conflicts.compared:
        key = key.otherwise(F.expr(row_digest(df.schema, conflicts.compared)))
    keyed = rows.withColumn("__key", key)
    joined = lookup.join_groups(
        keyed,
        groups.select(
            F.col(batch),
            F.col("key").alias("__key"),
            F.col("size").alias("__size"),
            F.col("kept").alias("__smallest"),
        ),
        keys=[batch, "__key"],
        size="__size",
        facts=["__smallest"],
        row_id=row_id,
        group_count=conflicts.group_count,
        grouped_rows=conflicts.grouped_rows,
    )
    smallest, gated = F.col("__smallest"), F.coalesce(GATED, F.lit(False))
    return joined.withColumns(
        {
            CLASH: gated & smallest.isNotNull(),
            KEPT: F.when(~gated & (smallest < number), smallest),
            GATED: gated,
        }
    ).drop("__key", "__smallest")


def find_exact_duplicates(
    df: DataFrame, *, key: str, columns: Sequence[str], batch: str | None = None
) -> DataFrame:
    """Rows equal to a row with a smaller key on every listed column but the key.

    Returns (batch,) ``record_id`` and ``duplicate_of``, the smallest key of the group.
    Ordered by (batch and) key. Nulls count as equal. Keys must be digits, fit 64 bits and not repeat in a batch.
    """
    names = list(columns)
    if not names or len(names) != len(set(names)):
        raise ValueError("columns must be a non-empty list without repeats")
    missing = [name for name in [*names, key] if name not in df.columns]
    if missing or key not in names:
        raise ValueError(f"columns must be in the data and include the key: {missing or key}")
    compared = [name for name in names if name != key]
    if not compared:
        raise ValueError("at least one column other than the key is required")

    by = batch or "__batch"
    rows = with_helpers(df.select(*([batch] if batch else []), *names), [identifier_rule(key)])
    if not batch:
        rows = rows.withColumn(by, F.lit(0).cast("smallint"))
    conflicts = find_conflicts(rows, compared=compared, batch=by, minimum=0)
    if conflicts.unsound_count:
        raise ValueError(f"key {key} has values that are not digits within 64 bits")
    if conflicts.clash_count:
        raise ValueError(f"key {key} has repeated values")
    return (
        attach_conflicts(rows, conflicts, ID_HELPER)
        .where(F.col(KEPT).isNotNull())
        .select(
            *([batch] if batch else []),
            F.col(ID_HELPER).alias("record_id"),
            F.col(KEPT).alias("duplicate_of"),
        )
        .orderBy(*([batch] if batch else []), "record_id")
    )


def key_clashes(df: DataFrame, *, keys: Sequence[str]) -> DataFrame:
    """Key values held by more than one row, with how many rows hold them."""
    return (
        df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).where(F.col("row_count") > 1)
    )
