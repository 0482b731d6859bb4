"""Type conformance: from what arrives to what the target has.

Columns are matched by name, whatever their case or order. Epoch milliseconds stand for dates and
timestamps and are clamped up to 1900-01-01; other casts that fail give NULL, or raise where
`strict` names the column (merge keys). NULL stays NULL throughout.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Milliseconds of 1900-01-01T00:00:00Z.
EARLIEST_MILLIS = -2208988800000


def coerce_col(c: Column, source: T.DataType, target: T.DataType, strict: bool = False) -> Column:
    if source == target:
        return c
    if isinstance(source, T.LongType) and isinstance(target, T.DateType | T.TimestampType | T.TimestampNTZType):
        clamped = F.when(c < EARLIEST_MILLIS, F.lit(EARLIEST_MILLIS)).otherwise(c)
        return F.timestamp_millis(clamped).cast(target)
    return c.cast(target) if strict else c.try_cast(target)


def coerce_to(incoming: DataFrame, target: T.StructType, strict: tuple[str, ...] = ()) -> DataFrame:
    """incoming projected onto the target's columns, in its order and types. A column it lacks is NULL."""
    by_name = {f.name.lower(): f for f in incoming.schema.fields}
    keys = {k.lower() for k in strict}
    out = []
    for f in target.fields:
        have = by_name.get(f.name.lower())
        c = F.lit(None).cast(f.dataType) if have is None else coerce_col(F.col(f"`{have.name}`"), have.dataType, f.dataType, f.name.lower() in keys)
        out.append(c.alias(f.name))
    return incoming.select(*out)


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Lower-case names and the stored types; a value that doesn't fit is NULL."""
    return coerce_to(lower_names(df), schema)


def infer_schema(df: DataFrame) -> T.StructType:
    """The stored types of a source: lower-case names, and dates for timestamps without a time in any row."""
    source = lower_names(df)
    stamps = [f.name for f in source.schema.fields if isinstance(f.dataType, T.TimestampType | T.TimestampNTZType)]
    dates = set()
    if stamps:
        found = source.agg(*[F.bool_and(F.col(f"`{s}`") == F.date_trunc("day", f"`{s}`")).alias(s) for s in stamps]).first()
        dates = {s for s in stamps if found[s]}
    return T.StructType([T.StructField(f.name, T.DateType() if f.name in dates else f.dataType) for f in source.schema.fields])
