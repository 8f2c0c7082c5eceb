"""Which batches need work: those whose content or outputs differ from the state."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

_KEYS = ["batch_year", "size_bytes", "__algorithm", "checksum"]


def _current_state(state: DataFrame, outputs: DataFrame) -> DataFrame:
    """State records whose two outputs exist with the size they were written with."""

    def stored(kind: str) -> DataFrame:
        return outputs.select(
            F.col("path").alias(f"{kind}_path"), F.col("size_bytes").alias(f"{kind}_size_bytes")
        )

    for kind in ("curated", "quarantine"):
        state = state.join(stored(kind), [f"{kind}_path", f"{kind}_size_bytes"], "left_semi")
    return state.select(
        "batch_year",
        F.col("source_size_bytes").alias("size_bytes"),
        F.lower("checksum_algorithm").alias("__algorithm"),
        "checksum",
    )


def _keyed(batches: DataFrame) -> DataFrame:
    return batches.withColumn("__algorithm", F.lower("checksum_algorithm"))


def pending_batches(batches: DataFrame, state: DataFrame, outputs: DataFrame) -> DataFrame:
    """Batches that are new, changed, or whose outputs are missing or altered."""
    current = _current_state(state, outputs)
    return _keyed(batches).join(current, _KEYS, "left_anti").select(*batches.columns)


def skipped_batches(batches: DataFrame, state: DataFrame, outputs: DataFrame) -> DataFrame:
    """Batches whose state is current."""
    current = _current_state(state, outputs)
    return _keyed(batches).join(current, _KEYS, "left_semi").select(*batches.columns)


def multi_batch_summary(batches: DataFrame, state: DataFrame, outputs: DataFrame) -> DataFrame:
    """How many batches were found, need processing, and can be skipped."""
    current = _current_state(state, outputs).withColumn("__current", F.lit(True))
    found = _keyed(batches).join(current, _KEYS, "left")
    return found.agg(
        F.count(F.lit(1)).alias("discovered"),
        F.count_if(F.col("__current").isNull()).alias("processed"),
        F.count_if(F.col("__current").isNotNull()).alias("skipped"),
    )
