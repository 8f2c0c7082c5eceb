"""Connected components of a graph given as edges, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..plans.durable import stored


EDGES_PER_PART = 100_000
LEAST_PARTS = 6


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b): the smallest node it is connected to.

    Each round hangs every node's neighbours on the smallest of them. No node's neighbours
    are ever gathered: minima are aggregated, then joined back, so a node with very many
    edges costs no single task more than its share. Rounds grow with the logarithm of the
    size; each is written to the checkpoint folder, in as many tasks as its edges call for.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    current = stored(edges, "edges")
    state = _state(current)
    # The number of edges never grows beyond twice what it was.
    parts = max(LEAST_PARTS, state[0] // EDGES_PER_PART)
    while state[0]:
        large = _large_star(current).coalesce(parts)
        current = stored(_small_star(large).coalesce(parts), "edges")
        before, state = state, _state(current)
        if state == before:
            break
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(roots)


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("h")
    ).first()
    return row.n, row.h


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    return (
        both.join(least, "u")
        .where("v > u")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .where("u <> v")
    )


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    hung = (
        down.join(least, "u")
        .where("v <> m")
        .select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v"))
    )
    return hung.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
