"""The daily click counts and the newer-wins merge as streams."""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saltmarsh.operators.clicks import recent
from saltmarsh.operators.merge import merge_newer
from saltmarsh.sources.buckets import BucketTable
from saltmarsh.sources.tables import VersionedTable, rebalanced


def read_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int = 100) -> DataFrame:
    """New Parquet files under a path as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def daily_counts(events: DataFrame, time_col: str = "ts", late: str | None = "2 days", keys: tuple[str, ...] = ("user_id", "event_type")) -> DataFrame:
    """Events per day and key; rows later than the watermark allows are left out, and days close behind it.

    Without a watermark (late=None) every row counts, in whatever order files come, and all days stay open.
    """
    rows = events.withColumn("_at", F.col(time_col).cast("timestamp"))
    if late is not None:
        rows = rows.withWatermark("_at", late)
    counted = rows.groupBy(F.window("_at", "1 day").alias("w"), *keys).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(F.to_date("w.start").alias("day"), *keys, "n")


def run_to_end(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None], mode: str = "update") -> None:
    """Handle all there is, batch by batch, and stop; a restart goes on from the checkpoint."""
    stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(each).start().awaitTermination()


def daily_identity(clicks: DataFrame, users: DataFrame, markets: DataFrame, event: str, as_of: datetime.date | str, id_col: str = "event_id", late: str = "2 days") -> DataFrame:
    """`operators.clicks.daily_identity` of a stream in which events may come again: counts per market, day, user, identity, product and session.

    An event that comes again within the watermark, known by its id, counts once; its state goes when the watermark has passed
    it. Markets and identities are static tables, read anew in each batch: a user of several identities counts under each.
    Identities are as many as users, so they are joined by a shuffle: no batch collects them.
    """
    rows = clicks.where(F.col("event") == event).withColumn("_at", F.col("time").cast("timestamp")).withWatermark("_at", late)
    once = rows.dropDuplicatesWithinWatermark([id_col])
    named = recent(once, markets, as_of).join(users.select("user_id", "identity").distinct().hint("merge"), "user_id", "left")
    return named.groupBy("country", "day", "user_id", "identity", "product_id", "session_id").agg(F.count(F.lit(1)).alias(event))


class MarketUpdates:
    """What a stream of counts has updated, in a folder per market; of each key the last update counts."""

    def __init__(self, spark: SparkSession, path: str, market: str = "country"):
        self.spark, self.path, self.market = spark, path.rstrip("/"), market

    def each(self, batch: DataFrame, n: int) -> None:
        """Writes one batch. A batch that is redone after a failure replaces what it wrote."""
        rows = rebalanced(batch.withColumn("_batch", F.lit(n)), self.market)
        rows.write.mode("overwrite").partitionBy(self.market).parquet(f"{self.path}/batch={n}")

    def latest(self, schema: T.StructType, measure: str) -> DataFrame:
        keys = [c for c in schema.names if c != measure]
        updates = self.spark.read.schema(T.StructType([*schema.fields, T.StructField("_batch", T.IntegerType())])).option("basePath", self.path).parquet(f"{self.path}/batch=*")
        return updates.groupBy(*keys).agg(F.max_by(measure, "_batch").alias(measure))


def merge_stream(table: VersionedTable | BucketTable, incoming: DataFrame, keys: list[str], filter_col: str, checkpoint: str) -> None:
    """Every micro-batch is merged into the table, newer rows winning. A `BucketTable` rewrites only the buckets it touches.

    Of several rows of a key in a batch the one with the latest filter value counts (a NULL one is earlier than all; ties
    fall to the largest row). Rows with a NULL key match nothing and are all added. Merging a batch twice changes
    nothing but for those.
    """

    def each(batch: DataFrame, _: int) -> None:
        whole = F.lit(True)
        for k in keys:
            whole = whole & F.col(k).isNotNull()
        order = F.struct(F.col(filter_col).isNotNull(), F.col(filter_col), *[c for c in batch.columns if c not in keys])
        latest = batch.where(whole).groupBy(*keys).agg(F.max_by(F.struct(*batch.columns), order).alias("r")).select("r.*")
        # Read more than once: to see what it touches, and to merge it.
        rows = latest.unionByName(batch.where(~whole)).persist()
        try:
            table.update(rows, lambda target, sent: merge_newer(target, sent, keys, filter_col))
        finally:
            rows.unpersist()

    run_to_end(incoming, checkpoint, each, "append")
