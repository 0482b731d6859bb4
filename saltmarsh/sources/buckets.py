"""Tables whose changes rewrite only the buckets of keys they touch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saltmarsh.sources.tables import rebalanced

#: What a change makes of the rows of some buckets and the incoming rows of the same.
Change = Callable[[DataFrame, DataFrame], DataFrame]


class BucketTable:
    """Rows dealt to buckets by a hash of their keys; each change writes new files for the buckets it touches, beside the old.

    The manifest says which version of each bucket counts: a change is there once its one file is added to it, so
    readers see all of it or nothing. Files of untouched buckets stay as they are. Buckets are a fixed number, and only their
    numbers reach the driver. Rows with a NULL key, which match nothing, are spread by all their columns.
    """

    def __init__(self, spark: SparkSession, base: str, schema: T.StructType, keys: list[str], buckets: int = 64):
        self.spark, self.base, self.schema, self.keys, self.buckets = spark, base.rstrip("/"), schema, keys, buckets

    def create(self) -> BucketTable:
        self.spark.createDataFrame([], "bucket int, version int").write.parquet(f"{self.base}/manifest")
        return self

    def bucket(self) -> Column:
        whole = F.lit(True)
        for k in self.keys:
            whole = whole & F.col(k).isNotNull()
        return F.pmod(F.when(whole, F.xxhash64(*self.keys)).otherwise(F.xxhash64(*self.schema.names)), F.lit(self.buckets)).cast("int")

    def versions(self) -> dict[int, int]:
        """The version in force of each bucket that has rows."""
        rows = self.spark.read.schema("bucket int, version int").parquet(f"{self.base}/manifest")
        return {r.bucket: r.version for r in rows.groupBy("bucket").agg(F.max("version").alias("version")).collect()}

    def _read(self, versions: dict[int, int]) -> DataFrame:
        if not versions:
            return self.spark.createDataFrame([], self.schema)
        paths = [f"{self.base}/data/version={v}/bucket={b}" for b, v in sorted(versions.items())]
        return self.spark.read.schema(self.schema).parquet(*paths)

    def read(self) -> DataFrame:
        return self._read(self.versions())

    def update(self, incoming: DataFrame, change: Change) -> None:
        """Replaces the buckets that incoming rows fall into by what `change` makes of their rows and these. It must keep a row's keys."""
        now = self.versions()
        touched = [r.b for r in incoming.select(self.bucket().alias("b")).distinct().collect()]
        if not touched:
            return
        version = max(now.values(), default=0) + 1
        made = change(self._read({b: now[b] for b in touched if b in now}), incoming).select(*self.schema.names).withColumn("bucket", self.bucket())
        # A change that was cut off may have left files of the same version, which no manifest names.
        rebalanced(made, "bucket").write.partitionBy("bucket").mode("overwrite").parquet(f"{self.base}/data/version={version}")
        rows = self.spark.createDataFrame([(b, version) for b in touched], "bucket int, version int")
        rows.coalesce(1).write.mode("append").parquet(f"{self.base}/manifest")

    def vacuum(self) -> int:
        """Deletes the folders of buckets that no version in force has, and returns their number. Nobody may be reading them."""
        fs_path = self.spark._jvm.org.apache.hadoop.fs.Path
        root = fs_path(f"{self.base}/data")
        fs, now, gone = root.getFileSystem(self.spark._jsc.hadoopConfiguration()), self.versions(), 0
        for version in fs.listStatus(root):
            number = int(version.getPath().getName().removeprefix("version="))
            for bucket in fs.listStatus(version.getPath()):
                name = bucket.getPath().getName()
                if name.startswith("bucket=") and now.get(int(name.removeprefix("bucket="))) != number:
                    gone += fs.delete(bucket.getPath(), True)
        return gone
