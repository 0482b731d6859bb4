"""Reading and writing: extracts, day partitions, CSV exports, versioned tables."""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def jdbc(spark: SparkSession, url: str, table: str, column: str, lower: int, upper: int, partitions: int, **options: str) -> DataFrame:
    """A relational table read in parallel ranges of a numeric column. Needs the vendor's driver on the class path."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).option("partitionColumn", column)
    reader = reader.option("lowerBound", lower).option("upperBound", upper).option("numPartitions", partitions).options(**options)
    return reader.load()


def date_ranges(column: str, first: datetime.date, last: datetime.date, days: int, literal: str = "TIMESTAMP '{} 00:00:00'") -> list[str]:
    """Predicates that cut a table into ranges of days, one a task; the first also takes what is earlier or NULL, the last what is later.

    literal: how the source writes the beginning of a day."""
    cuts = [first + datetime.timedelta(n) for n in range(days, (last - first).days + 1, days)]
    stamp = literal.format
    if not cuts:
        return [f"{column} IS NULL OR {column} IS NOT NULL"]
    middle = [f"{column} >= {stamp(a)} AND {column} < {stamp(z)}" for a, z in zip(cuts, cuts[1:], strict=False)]
    return [f"{column} < {stamp(cuts[0])} OR {column} IS NULL", *middle, f"{column} >= {stamp(cuts[-1])}"]


def key_shares(number: str, parts: int) -> list[str]:
    """Predicates that cut a table into shares by the remainder of a number that the source computes, for keys that aren't numbers: a hash
    in the source's own words (`ORA_HASH(k)`, `hashtext(k)`), or a length. NULL goes to the first."""
    return [f"MOD(ABS({number}), {parts}) = {n}" + (f" OR {number} IS NULL" if n == 0 else "") for n in range(parts)]


def jdbc_shares(spark: SparkSession, url: str, table: str, predicates: list[str], **options: str) -> DataFrame:
    """A relational table without a numeric key, read in parallel shares, each by a predicate of its own that the source applies.

    Predicates have to be disjoint and to hold for every row of the table together, as those of `date_ranges` and `key_shares` do.
    Further filters are pushed beside each.
    """
    return spark.read.jdbc(url, table, predicates=[f"({p})" for p in predicates], properties=options)


def extract(source: DataFrame, mode: str = "full", filter_col: str | None = None, watermark: Column | None = None, day: datetime.date | str | None = None) -> DataFrame:
    """full: all rows; append: rows after the watermark (all while there is none); incremental: rows of one day. Filters reach the source."""
    if mode == "full":
        return source
    c = F.col(filter_col)
    if mode == "append":
        return source if watermark is None else source.where((c > watermark) | watermark.isNull())
    if mode == "incremental":
        start = F.to_timestamp_ntz(F.lit(f"{day} 00:00:00")) if isinstance(source.schema[filter_col].dataType, T.TimestampNTZType) else F.to_timestamp(F.lit(f"{day} 00:00:00"))
        return source.where((c >= start) & (c < start + F.expr("INTERVAL '1' DAY")))
    raise ValueError(f"no mode {mode}")


def rebalanced(df: DataFrame, *columns: str) -> DataFrame:
    """df dealt by the columns it is to be partitioned by, so that a value makes one file, and as many more as its size asks for.

    Adaptive execution splits the rows of a large value over several tasks and puts small ones together
    (`spark.sql.adaptive.advisoryPartitionSizeInBytes`), so files don't grow with the number of tasks.
    """
    return df.hint("rebalance", *columns)


def by_day(df: DataFrame, day: Column) -> DataFrame:
    """df with columns year, month and day, and dealt by them."""
    parts = df.withColumn("year", F.date_format(day, "yyyy")).withColumn("month", F.date_format(day, "MM")).withColumn("day", F.date_format(day, "dd"))
    return rebalanced(parts, "year", "month", "day")


def write_day_partitions(df: DataFrame, base: str, day: Column) -> None:
    """Overwrites the year=/month=/day= partitions that df has rows of, and only those."""
    by_day(df, day).write.partitionBy("year", "month", "day").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(base)


def write_day_partition(df: DataFrame, base: str, day: datetime.date | str) -> None:
    """Replaces the partition of one day by all rows of df. Without rows the day is cleared: a rerun leaves nothing stale."""
    at = datetime.date.fromisoformat(str(day))
    df.write.mode("overwrite").parquet(f"{base}/year={at:%Y}/month={at:%m}/day={at:%d}")


def _files(spark: SparkSession, path: str, fmt: str) -> bool:
    """Whether a folder has files of a format, at any depth. A folder that isn't there has none."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(where):
        return False
    found = fs.listFiles(where, True)
    while found.hasNext():
        if found.next().getPath().getName().endswith(f".{fmt}"):
            return True
    return False


def _clear(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def _incoming(spark: SparkSession, path: str, fmt: str, schema: T.StructType | None) -> DataFrame:
    reader = spark.read.format(fmt).option("pathGlobFilter", f"*.{fmt}")
    return (reader if schema is None else reader.schema(schema)).load(path)


def publish_partition(spark: SparkSession, incoming: str, final: str, fmt: str | tuple[str, ...], partition: str, schema: T.StructType | None = None) -> None:
    """Replaces one partition of the final table by the incoming files of the given formats, and no others.

    A day on which nothing came leaves its partition empty. The schema is the stored one (`schemas.SchemaStore`); without it
    the files' own counts, which for CSV is text only. Several formats stay files of their own, side by side.
    """
    there = [f for f in ((fmt,) if isinstance(fmt, str) else fmt) if _files(spark, f"{incoming}/{partition}", f)]
    if not there:
        _clear(spark, f"{final}/{partition}")
    for n, f in enumerate(there):
        rows = _incoming(spark, f"{incoming}/{partition}", f, schema)
        rows.write.format(f).mode("append" if n else "overwrite").save(f"{final}/{partition}")


def publish_partitions(spark: SparkSession, incoming: str, final: str, fmt: str, by: str, schema: T.StructType | None = None, cleared: tuple[str, ...] = ()) -> None:
    """Replaces all partitions `by=...` that came by their incoming files of one format, in one job; those in `cleared` of which nothing came are emptied."""
    for value in cleared:
        if not _files(spark, f"{incoming}/{by}={value}", fmt):
            _clear(spark, f"{final}/{by}={value}")
    if _files(spark, incoming, fmt):
        rows = rebalanced(_incoming(spark, incoming, fmt, schema), by)
        rows.write.format(fmt).partitionBy(by).mode("overwrite").option("partitionOverwriteMode", "dynamic").save(final)


def write_observed(df: DataFrame, path: str, mode: str = "error", **observed: Column) -> dict[str, Any]:
    """Writes df as Parquet and returns aggregates of its rows, taken in the pass that writes; `rows` is their number.

    The table isn't read for them, neither before nor after. Redone tasks count once.
    """
    watch = Observation()
    df.observe(watch, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in observed.items()]).write.mode(mode).parquet(path)
    return watch.get


def write_csv(df: DataFrame, path: str, sep: str = ",", header: bool = True, quote_all: bool = True, partition_by: str | None = None) -> None:
    writer = df.write.mode("overwrite").option("sep", sep).option("header", header).option("quoteAll", quote_all).option("escape", '"')
    (writer.partitionBy(partition_by) if partition_by else writer).csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str, sep: str = ",", header: bool = True) -> DataFrame:
    return spark.read.schema(schema).option("sep", sep).option("header", header).option("escape", '"').csv(path)


def export_market_csv(df: DataFrame, base: str, market_col: str) -> None:
    """One folder of semicolon-separated files per market, written in one job, a large market as several files."""
    write_csv(rebalanced(df, market_col), base, sep=";", quote_all=False, partition_by=market_col)


def load_csv_append(spark: SparkSession, path: str, schema: T.StructType, table_path: str) -> None:
    """Appends CSV files of a fixed schema to a table, making it if need be."""
    read_csv(spark, path, schema).write.mode("append").parquet(table_path)


class VersionedTable:
    """A table of whole versions: a new one is written beside the old, then named in a row added to the pointer.

    Readers see the old version until that row is there. Old versions stay, for whoever still reads them.
    """

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")

    def read(self) -> DataFrame:
        version = self.spark.read.parquet(f"{self.base}/pointer").orderBy(F.desc("at")).first().version
        return self.spark.read.parquet(f"{self.base}/{version}")

    def replace(self, df: DataFrame, **observed: Column) -> dict[str, Any]:
        """Makes df the new version; returns the number of its `rows` and the aggregates asked for, taken as it is written."""
        version = f"v-{uuid.uuid4().hex}"
        seen = write_observed(df, f"{self.base}/{version}", **observed)
        self.spark.range(1).select(F.lit(version).alias("version"), F.current_timestamp().alias("at")).coalesce(1).write.mode("append").parquet(f"{self.base}/pointer")
        return seen

    def update(self, incoming: DataFrame, change: Callable[[DataFrame, DataFrame], DataFrame]) -> None:
        """Makes what `change` makes of all rows and the incoming ones the new version."""
        self.replace(change(self.read(), incoming))
