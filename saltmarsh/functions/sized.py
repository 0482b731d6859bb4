"""Shuffles whose tasks stay of one size as the input grows."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

#: Bytes of the input's files for each partition of a shuffle, and bytes of it up to which adaptive execution puts partitions together.
FILE_BYTES, TOGETHER = 4_000_000, 16_000_000


def file_bytes(tables: Iterable[DataFrame]) -> int:
    """Bytes of tables as they lie in files, by Spark's statistics; nothing is run."""
    return sum(int(str(t._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) for t in tables)


def sized_session(spark: SparkSession, n_bytes: int) -> SparkSession:
    """A session of the same application and settings, but for shuffles: their partitions follow the bytes of the input.

    With a fixed number of partitions a task's sorts and hash maps grow with the input; put together up to Spark's own
    64 MB, rows of many sums take over a GB of a task. The session that is given stays as it is.
    """
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if own.conf.isModifiable(key):
            own.conf.set(key, value)
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_bytes // FILE_BYTES))
    own.conf.set("spark.sql.shuffle.partitions", str(partitions))
    own.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(TOGETHER))
    return own
