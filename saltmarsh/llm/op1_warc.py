"""WARC archives: writing, and a reader that salvages what lies behind damage.

Each record is written as a gzip member of its own; members of several records are read too. The reader checks a record's framing, its block digest and
its payload digest. Where a check fails it searches for the next place that opens a valid gzip
member or version line, goes on from there, and logs the bytes between as a quarantined gap, so that
records and gaps together cover each file without overlap.

Archives are rows (archive, content): those of `spark.read.format("binaryFile")`, or the ones
`write_archives` makes, which are stored as Parquet so that any store Spark can write will do.

Defined results: a null payload is empty; a null url is an empty target; a null page_id gives a
record without a page number. Of equal payloads the largest page_id is the response (rows repeating
that id are responses too; a group of null ids only is all response). An empty archive gives no
rows, a null one a gap of no bytes. A record of over `MOST_RECORD` bytes, or a gzip member that swells by over `STRAY` bytes
beyond its records, is a gap, however small it is packed. Extra columns don't pass.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saltmarsh.llm.common import durable, slices, table

#: Distinct repeated payloads (about 60 bytes each in memory) up to which the side of them is broadcast.
BROADCAST_GROUPS = 500_000
ARCHIVE_BYTES = 4_000_000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
GZIP = b"\x1f\x8b\x08"
_VERSION = re.compile(rb"WARC/1\.[01]\r\n")
_LENGTH = re.compile(rb"(?im)^content-length: *(\d{1,18})\s*$")
#: Bytes inflated at a time; the largest record that is taken; bytes of a member beyond its records from which it is left.
STEP, MOST_RECORD, STRAY = 1 << 20, 1 << 30, 1 << 24
_PAGE = re.compile(r"<urn:saltmarsh:page:(-?\d+)>")


def sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(kind: str, page: int | None, url: str, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One gzip member. A revisit keeps the HTTP header with the full length, but no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if kind == "response" else b"")
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:saltmarsh:page:{'' if page is None else page}>", "WARC-Date: 2024-01-01T00:00:00Z", f"WARC-Target-URI: {target}"]
    lines += [f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{sha1(block)}", "Content-Type: application/http;msgtype=response"]
    if kind == "revisit":
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:saltmarsh:page:{refers_to}>"]
    lines.append(f"Content-Length: {len(block)}")
    packer = zlib.compressobj(3, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


class Damage(ValueError):
    pass


def _parse(data: bytes, at: int) -> tuple[dict, int]:
    """The record at `at` of plain bytes and the place after it."""
    if not _VERSION.match(data, at):
        raise Damage("no version line")
    head_end = data.find(b"\r\n\r\n", at)
    if head_end < 0:
        raise Damage("header not ended")
    fields: dict[str, str] = {}
    for line in data[at:head_end].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise Damage("header line without a colon")
        fields[name.decode("latin-1").strip().lower()] = value.decode("utf-8", "replace").strip()
    if not fields.get("content-length", "").isdigit():
        raise Damage("no length")
    start = head_end + 4
    end = start + int(fields["content-length"])
    if data[end : end + 4] != b"\r\n\r\n":
        raise Damage("length doesn't lead to a record's end")
    block = data[start:end]
    if (want := fields.get("warc-block-digest", "").removeprefix("sha1:")) and want != sha1(block):
        raise Damage("block digest differs")
    out = {"record_type": fields.get("warc-type"), "record_id": fields.get("warc-record-id"), "target_uri": fields.get("warc-target-uri"), "payload_digest": fields.get("warc-payload-digest", "").removeprefix("sha1:") or None, "refers_to": fields.get("warc-refers-to")}
    payload, length = block, len(block)
    if fields.get("content-type", "").startswith("application/http"):
        http, _, payload = block.partition(b"\r\n\r\n")
        length = len(payload)
        if out["record_type"] == "revisit" and (m := re.search(rb"(?im)^content-length: *(\d+)", http)):
            length = int(m[1])
    if out["record_type"] == "response" and out["payload_digest"] not in (None, sha1(payload)):
        raise Damage("payload digest differs")
    return out | {"payload": payload, "payload_bytes": length}, end + 4


def _inflate(data: bytes) -> tuple[bytes, int, bool]:
    """What a gzip member holds, how much of data it takes, and whether it was left before its end.

    It is inflated step by step, and no further than its records go by their own Content-Length, each up to
    `MOST_RECORD`, and `STRAY` bytes beyond: a small member that swells without end takes no more memory than that.
    """
    unpack, plain, left = zlib.decompressobj(31), bytearray(), data
    at = known = 0  # where the next record may begin, and where the last one ends by its own word
    while not unpack.eof:
        try:
            piece = unpack.decompress(left, STEP)
        except zlib.error as e:
            raise Damage(f"gzip: {e}") from None
        left = unpack.unconsumed_tail
        plain += piece
        if not piece and not left and not unpack.eof:
            raise Damage("gzip member not ended")
        while version := _VERSION.search(plain, at):
            head = plain.find(b"\r\n\r\n", version.start())
            if head < 0:
                break
            length = _LENGTH.search(plain[version.start() : head])
            size = int(length[1]) if length else 0
            at = known = head + 8 + (size if size <= MOST_RECORD else 0)
        if len(plain) > known + STRAY:
            return bytes(plain), len(data) - len(left), True
    return bytes(plain), len(data) - len(unpack.unused_data), False


def _member(data: bytes) -> tuple[list[dict], int]:
    """The records in the gzip member that data begins with, and the member's length. What of it isn't sound is a gap without length."""
    plain, used, cut = _inflate(data)
    found, at = [], 0
    while at < len(plain):
        try:
            got, at = _parse(plain, at)
            found.append({"kind": "record", "error": None, **got})
        except Damage as e:
            if not found and at == 0 and not _VERSION.search(plain, 1):
                raise Damage(f"gzip member swells without a record: {e}" if cut else str(e)) from None
            found.append({"kind": "gap", "error": f"in a member{' that swells beyond its records' if cut else ''}: {e}"})
            version = _VERSION.search(plain, at + 1)
            at = version.start() if version else len(plain)
    if not any(f["kind"] == "record" for f in found):
        raise Damage(found[0]["error"] if found else "empty member")
    return found, used


def _at(data: bytes) -> tuple[list[dict], int]:
    if data.startswith(GZIP):
        return _member(data)
    got, used = _parse(data, 0)
    return [{"kind": "record", "error": None, **got}], used


def salvage(data: bytes) -> Iterator[dict]:
    """Records and gaps of one archive, in order; each has kind, offset and length.

    A member of several records gives each of them its own offset; its length stands with the first.
    """
    at, gap, why = 0, None, ""
    # A member's input is handed to zlib in windows, so that one record's cost doesn't grow with the file.
    view, window = data, 1 << 16
    following = {GZIP: 0, b"WARC/1.": 0}  # the next place of each opening, looked for once

    def next_place(after: int) -> int:
        for opening, place in following.items():
            while 0 <= place <= after or place > after and opening != GZIP and not _VERSION.match(view, place):
                place = view.find(opening, max(place, after) + 1)
            following[opening] = place
        return min((p for p in following.values() if p >= 0), default=len(view))

    while at < len(view):
        size = window
        while True:
            piece = view[at : at + size]
            try:
                got, used = _at(piece)
                break
            except Damage as e:
                fault = str(e)
                if at + size >= len(view) or not ("not ended" in fault or "length doesn't" in fault):
                    got = None
                    break
                size *= 4
        if got is not None:
            if gap is not None:
                yield {"kind": "gap", "offset": gap, "length": at - gap, "error": why}
                gap = None
            for k, x in enumerate(got):
                yield {"offset": at, "length": 0 if k else used, **x}
            at += used
            continue
        if gap is None:
            gap, why = at, fault
        at = next_place(at)
    if gap is not None:
        yield {"kind": "gap", "offset": gap, "length": len(view) - gap, "error": why}


RECORD = [
    ("archive", pa.string()), ("kind", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("record_type", pa.string()), ("record_id", pa.string()),
    ("target_uri", pa.string()), ("payload_digest", pa.string()), ("refers_to", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary()), ("error", pa.string()),
]


def _rows(found: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x.get(n) for x in found], t) for n, t in RECORD], names=[n for n, _ in RECORD])


def read_archives(archives: DataFrame, name: str = "archive", content: str = "content", with_payload: bool = True) -> DataFrame:
    """Rows of RECORD: kind `record` or, for quarantined bytes, `gap`."""
    spark_type = {pa.string(): "string", pa.int64(): "long", pa.binary(): "binary"}
    schema = ", ".join(f"{n} {spark_type[t]}" for n, t in RECORD)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "content", ARCHIVE_BYTES):
                for label, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    raw = data.as_py()
                    held, size = [], 0
                    for x in [{"kind": "gap", "offset": 0, "length": 0, "error": "no content"}] if raw is None else salvage(raw):
                        held.append(x | {"archive": label} | ({} if with_payload else {"payload": None}))
                        size += len(held[-1].get("payload") or b"") + 500
                        if size >= ARCHIVE_BYTES:
                            yield _rows(held)
                            held, size = [], 0
                    if held:
                        yield _rows(held)

    return archives.select(F.col(name).alias("archive"), F.col(content).alias("content")).mapInArrow(run, schema)


def decide(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """page_id, url, html and, for revisits, refers_to: the largest page_id with the same payload."""
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html")).withColumn("_key", F.unhex(F.sha1(F.encode("html", "utf-8"))))
    groups = (
        rows.where(F.octet_length("html") >= min_bytes).select("_key", "page_id")
        .groupBy("_key").agg(F.max("page_id").alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    )
    groups = durable(groups)
    if groups.count() <= BROADCAST_GROUPS:
        groups = F.broadcast(groups)
    first = F.when(F.col("page_id") != F.col("_first"), F.col("_first"))
    joined = rows.join(groups, "_key", "left").withColumn("refers_to", F.when(F.col("page_id").isNull(), F.col("_first")).otherwise(first))
    return joined.select("page_id", "url", "html", "refers_to")


def write_archives(decided: DataFrame) -> DataFrame:
    """(archive, content): each task's records, cut into archives of about ARCHIVE_BYTES."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, n, parts, size = TaskContext.get().partitionId(), 0, [], 0

        def close() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([f"part-{task:06d}-{n:06d}.warc.gz"]), pa.array([b"".join(parts)], pa.binary())], names=["archive", "content"])

        for whole in batches:
            for batch in slices(whole, "html"):
                for page, url, html, refers in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html", "refers_to")), strict=True):
                    payload = html.encode()
                    made = record("response" if refers is None else "revisit", page, url or "", payload, sha1(payload), refers)
                    parts.append(made)
                    size += len(made)
                    if size >= ARCHIVE_BYTES:
                        yield close()
                        n, parts, size = n + 1, [], 0
        if parts:
            yield close()

    return decided.mapInArrow(run, "archive string, content binary")


def digest(pages: DataFrame) -> DataFrame:
    archives = durable(write_archives(decide(pages)))
    number = lambda c: F.regexp_extract(c, _PAGE.pattern, 1).try_cast("long")
    records = read_archives(archives, with_payload=False).where("kind = 'record'")
    return records.select(number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", number("refers_to").alias("refers_to"), "archive", "offset")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(table(spark, sf_dir, "pages"))
