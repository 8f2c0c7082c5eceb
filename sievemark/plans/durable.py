"""Cutting a plan at a small intermediate result.

The result goes to the shared checkpoint folder, so it outlives any executor.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession

from ..sources import storage


def checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder; a temporary one only for local sessions without any."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        # Only where driver and executors are one process is a folder of this machine shared.
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="checkpoints-")
        atexit.register(shutil.rmtree, configured, ignore_errors=True)
    context.setCheckpointDir(configured)
    return context.getCheckpointDir()


_RUN: ContextVar[str | None] = ContextVar("run_folder", default=None)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables stored meanwhile go to a folder of their own, which is removed at the end."""
    folder = f"{checkpoint_dir(spark)}/run-{uuid.uuid4().hex}"
    token = _RUN.set(folder)
    try:
        yield
    finally:
        _RUN.reset(token)
        storage.remove_folder(spark, folder)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the checkpoint folder, or below that of the run."""
    return f"{_RUN.get() or checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def durable(df: DataFrame, **measures: Column) -> tuple[DataFrame, dict]:
    """Compute ``df`` once, keep it reliably, and return it with measures of what was kept.

    Measures are taken from the kept rows, so that neither retried tasks nor empty
    inputs can distort them.
    """
    checkpoint_dir(df.sparkSession)
    kept = df.checkpoint()
    if not measures:
        return kept, {}
    row = kept.agg(*[measure.alias(name) for name, measure in measures.items()]).first()
    return kept, row.asDict()


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as a table in the checkpoint folder and read it from there.

    For wide data: unlike a checkpoint, the table is columnar, so later readers
    fetch only the columns they need and split it evenly.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    kept = df.sparkSession.read.schema(df.schema).parquet(path)
    kept._stored_path = path
    return kept


def dropped(kept: DataFrame) -> None:
    """Remove a ``stored`` table that nothing will read again."""
    storage.remove_folder(kept.sparkSession, kept._stored_path)
