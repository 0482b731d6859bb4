"""Table changes as plans from DataFrames to a DataFrame.

Keys match by equality, so a NULL key matches nothing and its row is inserted. Keys are never
updated. Several incoming rows of one key raise, as which of them wins would be chance.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saltmarsh.functions.coerce import coerce_col, coerce_to
from saltmarsh.sources.tables import VersionedTable


def append(target: DataFrame, incoming: DataFrame) -> DataFrame:
    """target and the incoming rows, brought to its columns and types."""
    return target.unionByName(coerce_to(incoming, target.schema))


def full_refresh(target: DataFrame, incoming: DataFrame) -> DataFrame:
    """The incoming rows in the target's shape; what the target held is gone."""
    return coerce_to(incoming, target.schema)


def _whole(keys: list[str]) -> Column:
    whole = F.lit(True)
    for k in keys:
        whole = whole & F.col(k).isNotNull()
    return whole


def merge(target: DataFrame, incoming: DataFrame, keys: list[str], newer: Column | None = None) -> DataFrame:
    """target with matched rows replaced (where `newer`, over t_ and i_ columns, is TRUE) and others added.

    Rows with a NULL key match nothing, so they pass beside the join, where they would all meet in one task.
    """
    incoming = coerce_to(incoming, target.schema, strict=tuple(keys))
    others = [c for c in target.columns if c not in keys]
    counted = incoming.where(_whole(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.first(F.struct(F.lit(1).alias("_one"), *others)).alias("_row"))
    guard = F.when(F.col("_n") > 1, F.raise_error(F.lit("several incoming rows for one key"))).otherwise(F.col("_row"))
    # Keys stay columns, so the join takes over how the aggregation has dealt them.
    i = counted.select(*[F.col(k).alias(f"i_{k}") for k in keys], guard.alias("_i"))
    i = i.select(*[f"i_{k}" for k in keys], F.lit(True).alias("_i"), *[F.col(f"_i.{c}").alias(f"i_{c}") for c in others])
    t = target.where(_whole(keys)).select([F.col(c).alias(f"t_{c}") for c in target.columns]).withColumn("_t", F.lit(True))
    on = F.lit(True)
    for k in keys:
        on = on & (F.col(f"t_{k}") == F.col(f"i_{k}"))
    both = t.join(i, on, "full")
    take = F.col("_t").isNull() | (F.col("_i").isNotNull() & (F.lit(True) if newer is None else F.coalesce(newer, F.lit(False))))
    kept = [F.coalesce(f"t_{c}", f"i_{c}") if c in keys else F.when(take, F.col(f"i_{c}")).otherwise(F.col(f"t_{c}")) for c in target.columns]
    merged = both.select([k.alias(c) for k, c in zip(kept, target.columns, strict=True)])
    return merged.unionByName(target.where(~_whole(keys))).unionByName(incoming.where(~_whole(keys)))


def merge_newer(target: DataFrame, incoming: DataFrame, keys: list[str], filter_col: str, millis: bool = False) -> DataFrame:
    """Updates a matched row only if the incoming filter column is later; NULL on either side is not.

    With millis the filter column arrives as epoch milliseconds, and keys may be in upper case.
    """
    if millis:
        by_name = {c.lower(): c for c in incoming.columns}
        kind = incoming.schema[by_name[filter_col]].dataType
        stamp = coerce_col(F.col(by_name[filter_col]), kind, T.TimestampType())
        incoming = incoming.withColumn(by_name[filter_col], stamp)
    return merge(target, incoming, keys, F.col(f"i_{filter_col}").cast("timestamp") > F.col(f"t_{filter_col}").cast("timestamp"))


def merge_upsert(target: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Updates every matched row."""
    return merge(target, incoming, keys)


def delete_where(target: DataFrame, predicate: Column) -> DataFrame:
    """Rows for which the predicate is not TRUE."""
    return target.where(~F.coalesce(predicate, F.lit(False)))


def delete_since(target: DataFrame, column: str, since: Column) -> DataFrame:
    """Rows before a period (or without one); what follows is to be loaded anew."""
    return delete_where(target, F.col(column) >= since)


def high_watermark(target: DataFrame, column: str) -> DataFrame:
    """The largest timestamp of a column; NULL for an empty table."""
    return target.agg(latest(column).alias("high_watermark"))


WATERMARKS = "source_system string, schema_name string, table_name string, high_watermark timestamp"


def watermark_row(spark: SparkSession, key: dict[str, str], latest: datetime.datetime | None) -> DataFrame:
    return spark.createDataFrame([(*key.values(), latest)], WATERMARKS)


def _of_key(key: dict[str, str]) -> Column:
    own = F.lit(True)
    for k, v in key.items():
        own = own & F.col(k).eqNullSafe(F.lit(v))
    return own


def get_watermark(marks: VersionedTable, key: dict[str, str], target: DataFrame, column: str) -> datetime.datetime | None:
    """The stored watermark of a key; where none is stored it is computed from the target, and stored.

    None for an empty target: the next load takes all rows. A stored NULL is none.
    """
    found = marks.read().where(_of_key(key)).where("high_watermark is not null").first()
    return found.high_watermark if found else set_watermark(marks, key, target, column)


def set_watermark(marks: VersionedTable, key: dict[str, str], target: DataFrame, column: str) -> datetime.datetime | None:
    """Stores and returns the target's largest value."""
    return store_watermark(marks, key, high_watermark(target, column).first().high_watermark)


def latest(column: str) -> Column:
    """The aggregate a watermark is, to be observed while a table is written."""
    return F.max(F.col(column).cast("timestamp"))


def store_watermark(marks: VersionedTable, key: dict[str, str], stamp: datetime.datetime | None) -> datetime.datetime | None:
    """Stores and returns a watermark. None isn't stored, and leaves what is."""
    if stamp is not None:
        before = marks.read()
        marks.replace(delete_where(before, _of_key(key)).unionByName(watermark_row(before.sparkSession, key, stamp)))
    return stamp


def set_checkpoint(checkpoints: DataFrame, key: dict[str, str], stamp: Column) -> DataFrame:
    """Sets last_successful_run of one key. Adds no row."""
    match = F.lit(True)
    for k, v in key.items():
        match = match & (F.col(k) == v)
    return checkpoints.withColumn("last_successful_run", F.when(match, stamp).otherwise(F.col("last_successful_run")))


def get_checkpoint(checkpoints: DataFrame, key: dict[str, str]) -> DataFrame:
    rows = checkpoints
    for k, v in key.items():
        rows = rows.where(F.col(k) == v)
    return rows.select("last_successful_run")
