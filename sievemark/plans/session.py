"""Session settings that suit this work."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# A rule set compiles to large projections. HotSpot never compiles a method above 8000
# bytes of bytecode, so Spark should split such code instead of fusing it into one method.
SETTINGS = {"spark.sql.codegen.hugeMethodLimit": "8000"}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings for good; they change how fast queries run, never their results."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def prepared(spark: SparkSession) -> Iterator[SparkSession]:
    """The settings for the time of a run; what was set before comes back."""
    before = {key: spark.conf.get(key, None) for key in SETTINGS}
    try:
        yield prepare(spark)
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def spread(df: DataFrame) -> DataFrame:
    """Rows that lie in fewer splits than there are cores, dealt over all cores.

    A large input has more splits than that and is left as it lies.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
