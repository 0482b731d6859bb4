"""Broadcasts behind a check of their size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of a plan, by Spark's statistics, up to which it is broadcast without counting its rows.
KNOWN_BYTES = 1_000_000
#: Bytes of the counted rows in memory up to which they are broadcast.
MOST_BYTES = 32_000_000


def row_bytes(df: DataFrame) -> int:
    """A guess at what a row needs in memory: 8 bytes a number or date, 40 a text, 100 anything nested."""
    size = lambda t: 40 if isinstance(t, T.StringType) else 100 if isinstance(t, T.ArrayType | T.MapType | T.StructType | T.BinaryType) else 8
    return 16 + sum(size(f.dataType) for f in df.schema.fields)


def small(df: DataFrame, rows: int = 100_000) -> DataFrame:
    """df, marked for broadcast if it has at most `rows` rows and `MOST_BYTES`. A larger one stays whole, for a shuffled join.

    Where the statistics tell the size (local rows, small files), nothing is run; else the rows are counted up to the bound.
    """
    stats = df._jdf.queryExecution().optimizedPlan().stats()
    bound = min(rows, MOST_BYTES // row_bytes(df))
    known = stats.rowCount()
    if known.isDefined():
        return F.broadcast(df) if int(str(known.get())) <= bound else df
    if int(str(stats.sizeInBytes())) <= KNOWN_BYTES:
        return F.broadcast(df)
    return F.broadcast(df) if df.limit(bound + 1).count() <= bound else df
