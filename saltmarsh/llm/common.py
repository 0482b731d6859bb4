"""What the operators of this subpackage share: tables, durable intermediate results, Arrow helpers."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from typing import Any
from weakref import WeakKeyDictionary

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _base(spark: SparkSession) -> str:
    """spark.checkpoint.dir, which driver and executors share.

    Only where that setting is missing on one machine (local master, as in tests) is a temporary folder set up.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("saltmarsh.shared.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="spark-saltmarsh-")
        spark.conf.set("saltmarsh.shared.dir", base)
    return f"{base.rstrip('/')}/saltmarsh-{spark.sparkContext.applicationId}"


#: The folder's name of what is stored just now.
_work: ContextVar[str] = ContextVar("work", default="other")


@contextmanager
def work(name: str) -> Iterator[None]:
    """What is stored inside goes to a folder of that name, which `clear` removes."""
    token = _work.set(name)
    try:
        yield
    finally:
        _work.reset(token)


def shared_dir(spark: SparkSession) -> str:
    """A new folder under spark.checkpoint.dir, in that of the present `work`."""
    return f"{_base(spark)}/{_work.get()}/{uuid.uuid4().hex}"


def clear(spark: SparkSession, name: str | None = None) -> bool:
    """Remove the stored intermediate tables of one `work`, or all of this application; results that read them must be written by then."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{_base(spark)}/{name}" if name else _base(spark))
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


_seen: WeakKeyDictionary[DataFrame, dict[str, Any]] = WeakKeyDictionary()


def durable(df: DataFrame, partition_by: str | None = None, **observed: Column) -> DataFrame:
    """Write df as Parquet to the shared folder and read it back: cuts lineage, survives lost executors.

    The rows, and further aggregates asked for, are counted while they are written (`seen`).
    """
    spark = df.sparkSession
    path, watch = shared_dir(spark), Observation()
    writer = df.observe(watch, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in observed.items()]).write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _seen[out] = watch.get
    return out


def seen(stored: DataFrame, name: str = "rows") -> Any:
    """What was counted when `durable` stored a table."""
    return _seen[stored][name]


#: Rows of a stored table, and bytes of it in memory, up to which it is broadcast; beyond, a shuffled join is used. Bytes are
#: those of all fields of nested rows; by 8 bytes a column, as they were counted before, the same rows came to a third of this.
BROADCAST_ROWS, BROADCAST_BYTES = 1_000_000, 96_000_000


def width(kind: T.DataType) -> int:
    """Bytes that a value of fixed width takes in memory, a null bitmap for each struct included."""
    return 8 + sum(width(f.dataType) for f in kind.fields) if isinstance(kind, T.StructType) else 8


def few(stored: DataFrame, times: int = 1) -> bool:
    """Whether the rows of a stored table of fixed width, held `times` times over, are few enough to be broadcast."""
    return seen(stored) <= min(BROADCAST_ROWS, BROADCAST_BYTES // (times * (16 + width(stored.schema))))


def side_of(stored: DataFrame) -> DataFrame:
    """A stored table of fixed width as a join's smaller side: broadcast if few enough, else joined by a shuffle."""
    return F.broadcast(stored) if few(stored) else stored


def ids_side(ids: DataFrame) -> DataFrame:
    """A list of ids of fixed width, stored, and broadcast if few enough; else it is joined by a shuffle."""
    return side_of(durable(ids))


def fresh(taken: Iterable[str], name: str) -> str:
    """A column name that none of those taken has, in whatever case."""
    lower = {t.lower() for t in taken}
    while name.lower() in lower:
        name = f"_{name}"
    return name


def rows_to_batches(columns: dict[str, Iterable], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], type=f.type) for f in schema], schema=schema)


def slices(batch: pa.RecordBatch, column: str, budget: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows whose `column` holds about `budget` bytes (one row at least)."""
    n = batch.num_rows
    if n == 0:
        return
    sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    ends = np.cumsum(sizes)
    start = 0
    while start < n:
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + budget, side="right")))
        yield batch.slice(start, stop - start)
        start = stop
