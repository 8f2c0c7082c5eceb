"""Left-joining one-row-per-group facts back to rows, whatever the group sizes.

Few groups: the facts are broadcast and the rows do not move. The number of
groups is measured by the caller, not guessed.

Many groups: the rows are shuffled on the group key, and a group may hold a
large share of all rows. Groups of ``hot_rows`` rows or more are looked up in a
broadcast first; there are at most ``grouped rows / hot_rows`` of these, and
``hot_rows`` is raised until that is below the broadcast limit. Their rows, and rows
with no key at all, are then spread over all partitions instead of sent to one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

MAX_BROADCAST_GROUPS = 1_000_000
HOT_ROWS = 200_000
_SPREAD = 1 << 16


def hot_threshold(grouped_rows: int) -> int:
    """Size from which a group is hot: no more groups than may be broadcast reach it."""
    return max(HOT_ROWS, grouped_rows // MAX_BROADCAST_GROUPS)


def join_groups(
    rows: DataFrame,
    groups: DataFrame,
    *,
    keys: list[str],
    size: str,
    facts: list[str],
    row_id: str,
    group_count: int,
    grouped_rows: int,
    max_broadcast: int | None = None,
    hot_rows: int | None = None,
) -> DataFrame:
    """``rows`` plus the ``facts`` of their group, null where there is no such group.

    ``groups`` has one row per ``keys``, with the group's row count in ``size``.
    """
    max_broadcast = MAX_BROADCAST_GROUPS if max_broadcast is None else max_broadcast
    hot_rows = hot_threshold(grouped_rows) if hot_rows is None else hot_rows
    table = groups.select(*keys, *facts)
    if group_count <= max_broadcast:
        return rows.join(F.broadcast(table), keys, "left")

    hot = groups.where(F.col(size) >= hot_rows).select(
        *keys, *[F.col(name).alias(f"__hot_{name}") for name in facts], F.lit(True).alias("__hot")
    )
    cold = groups.where(F.col(size) < hot_rows).select(*keys, *facts, F.lit(0).alias("__spread"))
    no_key = F.lit(False)
    for key in keys:
        no_key = no_key | F.col(key).isNull()
    placed = rows.join(F.broadcast(hot), keys, "left").withColumn(
        "__spread",
        F.when(
            F.col("__hot") | no_key, F.lit(1) + F.pmod(F.xxhash64(row_id), F.lit(_SPREAD))
        ).otherwise(0).cast("int"),
    )
    # The merge hint keeps the optimizer from broadcasting a side whose size it guesses.
    joined = placed.join(cold.hint("merge"), [*keys, "__spread"], "left")
    return joined.select(
        *rows.columns,
        *[F.coalesce(f"__hot_{name}", name).alias(name) for name in facts],
    )
