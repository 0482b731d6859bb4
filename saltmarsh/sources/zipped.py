"""CSV members of zip archives as rows.

A first pass reads the archives' directories and hands each member on, packed as it is; members are dealt
to tasks, and a second pass inflates them piece by piece. So an archive of many members is inflated by many tasks,
none of which holds more than a packed member, and what is damaged costs its own rows only.
"""

from __future__ import annotations

import bz2
import csv
import io
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Records handed on at a time, and packed bytes inflated at a time, so that a large member is not held whole.
RECORDS, PIECE = 10_000, 1 << 20
STORED, DEFLATED, BZIP2 = zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED, zipfile.ZIP_BZIP2
MEMBERS = "path string, member string, place int, method int, crc long, packed binary, error string"
RECORD = "path string, member string, fields array<string>, error string"


def members(archives: DataFrame, path: str = "path", content: str = "content") -> DataFrame:
    """MEMBERS: each member of each archive as its directory lists it, packed; an archive or member that can't be read is a row with an error.

    archives: rows of `spark.read.format("binaryFile")` or any (path, binary) rows. A null archive gives nothing.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for where, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if data.is_valid:
                    for row in _listed(data.as_buffer()):
                        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((where, *row), _MEMBER, strict=True)], names=_NAMES)

    return archives.select(F.col(path).alias("path"), F.col(content).alias("content")).mapInArrow(run, MEMBERS)


_NAMES = ["path", "member", "place", "method", "crc", "packed", "error"]
_MEMBER = [pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.string()]


def _listed(archive: pa.Buffer) -> Iterator[tuple]:
    try:
        with zipfile.ZipFile(pa.BufferReader(archive)) as z:
            listed = [i for i in z.infolist() if not i.is_dir()]
    except (zipfile.BadZipFile, OSError, ValueError, EOFError) as e:
        yield None, 0, None, None, None, f"no archive: {e}"
        return
    view = memoryview(archive)
    for place, i in enumerate(listed):
        head = bytes(view[i.header_offset : i.header_offset + 30])
        start = i.header_offset + 30 + int.from_bytes(head[26:28], "little") + int.from_bytes(head[28:30], "little")
        end = start + i.compress_size
        fault = None
        if head[:4] != b"PK\x03\x04" or end > len(view):
            fault = "the directory leads to no member"
        elif i.flag_bits & 1:
            fault = "encrypted"
        elif i.compress_type not in (STORED, DEFLATED, BZIP2):
            fault = f"packed by method {i.compress_type}"
        yield i.filename, place, i.compress_type, i.CRC, None if fault else bytes(view[start:end]), fault


class _Inflated(io.RawIOBase):
    """A packed member as a stream of its bytes; raises where they are damaged or don't have the member's checksum."""

    def __init__(self, packed: memoryview, method: int, crc: int):
        self.packed, self.crc, self.at, self.seen, self.held = packed, crc, 0, 0, b""
        self.unpack = zlib.decompressobj(-15) if method == DEFLATED else bz2.BZ2Decompressor() if method == BZIP2 else None

    def readable(self) -> bool:
        return True

    def readinto(self, into: memoryview) -> int:
        while not self.held and self.at < len(self.packed):
            piece = self.packed[self.at : self.at + PIECE]
            self.at += len(piece)
            self.held = bytes(piece) if self.unpack is None else self.unpack.decompress(piece)
            self.seen = zlib.crc32(self.held, self.seen)
        if not self.held:
            if self.unpack is not None and not self.unpack.eof:
                raise ValueError("the member isn't ended")
            if self.seen != self.crc:
                raise ValueError("checksum differs")
            return 0
        n = min(len(into), len(self.held))
        into[:n], self.held = self.held[:n], self.held[n:]
        return n


def records(archives: DataFrame, path: str = "path", content: str = "content", sep: str = ",") -> DataFrame:
    """RECORD: all records but the first of each member, whatever the member's name. Fields may hold quoted line breaks.

    Members with a header only give nothing; blank lines are no records. A null archive gives nothing. What
    can't be read gives one row with an error and no fields: an archive as a whole, a member, or the rest of a member
    behind the records before its damage.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = batch.column("packed")
            for k in range(batch.num_rows):
                where, name, method, crc, error = (batch.column(c)[k].as_py() for c in ("path", "member", "method", "crc", "error"))
                if error is not None:
                    yield _rows(where, name, [None], error)
                    continue
                held: list[list[str] | None] = []
                try:
                    stream = io.BufferedReader(_Inflated(memoryview(packed[k].as_buffer()), method, crc))
                    rows = csv.reader(io.TextIOWrapper(stream, "utf-8", errors="replace", newline=""), delimiter=sep)
                    next(rows, None)
                    for row in rows:
                        if row:
                            held.append(row)
                        if len(held) >= RECORDS:
                            yield _rows(where, name, held)
                            held = []
                except (zlib.error, OSError, ValueError, EOFError, csv.Error) as e:
                    fault = f"damaged: {e}"
                else:
                    fault = None
                if held:
                    yield _rows(where, name, held)
                if fault:
                    yield _rows(where, name, [None], fault)

    tasks = int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return members(archives, path, content).repartition(tasks, "path", "member", "place").mapInArrow(run, RECORD)


def _rows(path: str, member: str | None, held: list[list[str] | None], error: str | None = None) -> pa.RecordBatch:
    n = len(held)
    return pa.RecordBatch.from_arrays([pa.array([path] * n, pa.string()), pa.array([member] * n, pa.string()), pa.array(held, pa.list_(pa.string())), pa.array([error] * n, pa.string())], names=["path", "member", "fields", "error"])


def read_zipped_csv(archives: DataFrame, schema: T.StructType | str, sep: str = ",", error: str | None = None) -> DataFrame:
    """path, member and the columns of the schema, by place; what is missing, empty or doesn't fit is NULL.

    error: the name of a column for what can't be read, whose rows are then given too; without it, they raise.
    """
    kind = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    field = lambda k, t: F.nullif(F.get("fields", F.lit(k)), F.lit("")).try_cast(t)
    found = records(archives, sep=sep)
    columns = [field(k, f.dataType).alias(f.name) for k, f in enumerate(kind.fields)]
    if error:
        return found.select("path", "member", *columns, F.col("error").alias(error))
    told = F.raise_error(F.concat_ws(": ", F.lit("zip"), "path", "member", "error")).cast("boolean")
    return found.where(F.when(F.col("error").isNull(), F.lit(True)).otherwise(told)).select("path", "member", *columns)
