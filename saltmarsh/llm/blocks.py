"""Tables of counts of a fixed size, summed over the whole corpus.

Each task adds up its own table and emits it in blocks; blocks are summed in two levels, the first
over about the square root of the tasks, so no task meets the tables of all others. The final table
has a size fixed by its shape, whatever the corpus, and only that reaches the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Square root of the tasks up to which one level does.
FEW = 4
PARTIAL = "block int, part int, sums binary"
_NAMES = ["block", "part", "sums"]


def emit(total: np.ndarray, blocks: int) -> Iterator[pa.RecordBatch]:
    """The blocks of one task's table (rows x width, int64) that hold anything."""
    part = TaskContext.get().partitionId()
    for k, piece in enumerate(np.array_split(total, blocks)):
        if piece.any():
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([part], pa.int32()), pa.array([piece.astype("<i8").tobytes()], pa.binary())], names=_NAMES)


def _sum(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
    total = 0
    for s in t.column("sums"):
        total = total + np.frombuffer(s.as_buffer(), dtype="<i8")
    return pa.table({"block": pa.array([key[0].as_py()], pa.int32()), "part": pa.array([key[1].as_py()], pa.int32()), "sums": pa.array([total.tobytes()], pa.binary())})


def gather(partial: DataFrame, rows: int, width: int, blocks: int) -> np.ndarray:
    """The summed rows x width table of what tasks emitted (columns of PARTIAL)."""
    fan = math.isqrt(max(1, partial.rdd.getNumPartitions() - 1)) + 1
    partial = partial.select("block", "part", "sums")
    once = partial if fan <= FEW else partial.withColumn("part", F.pmod("part", F.lit(fan))).groupBy("block", "part").applyInArrow(_sum, PARTIAL)
    twice = once.withColumn("part", F.lit(0)).groupBy("block", "part").applyInArrow(_sum, PARTIAL)
    shape = [len(x) for x in np.array_split(np.empty(rows), blocks)]
    pieces = [np.zeros((n, width), dtype=np.int64) for n in shape]
    for r in twice.collect():
        pieces[r.block] = np.frombuffer(r.sums, dtype="<i8").reshape(-1, width)
    return np.concatenate(pieces)
