"""TIFF: walk the image directories of each file and emit one row per page.

`read_pages` takes any DataFrame with a binary column (such as `spark.read.format("binaryFile")`)
and decodes strips and tiles stored plain, as PackBits, LZW or deflate, in either byte order, with
horizontal-differencing predictors undone, for chunky samples of 8 or 16 bits (16 come back in
little-endian order); planes apart and floating-point predictors aren't decoded, and say so. `write_files`
stores bytes as TIFF files of up to three pages, whose decoders carry fixed shares of a text's rows of
576 bytes (a text of one row is all LZW).

Defined results: a null or broken file gives one row with page 0, no pixels and `error` filled; a
page that can't be decoded gives its row with `error`, and the walk goes on to the next directory.
A directory chain that loops ends where it would repeat. An empty table gives no rows. In the query
a null text counts as empty and every row of the table, repeated ones too, gives one row.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saltmarsh.llm.common import durable, slices, table

# Fixed values of the TIFF format: tags, compression codes, field type sizes.
WIDTH, LENGTH, BITS, COMPRESSION, PHOTOMETRIC, STRIP_OFFSETS, SAMPLES, ROWS_PER_STRIP = 256, 257, 258, 259, 262, 273, 277, 278
STRIP_COUNTS, PLANAR, PREDICTOR, TILE_WIDTH, TILE_LENGTH, TILE_OFFSETS, TILE_COUNTS = 279, 284, 317, 322, 323, 324, 325
NONE, LZW, DEFLATE, PACKBITS, OLD_DEFLATE = 1, 5, 8, 32773, 32946
NAMES = {NONE: "none", LZW: "lzw", DEFLATE: "deflate", PACKBITS: "packbits", OLD_DEFLATE: "deflate"}
FIELD = {1: (1, "B"), 3: (2, "H"), 4: (4, "I")}

UNIT = 576


class TiffError(ValueError):
    pass


def packbits_encode(data: bytes) -> bytes:
    """Runs of three equal bytes and more become repeats, all else literals of up to 128 bytes."""
    a = np.frombuffer(data, dtype=np.uint8)
    if not len(a):
        return b""
    head = np.flatnonzero(np.r_[True, a[1:] != a[:-1]])
    size = np.diff(np.r_[head, len(a)])
    out, done = bytearray(), 0

    def literal(stop: int) -> None:
        for k in range(done, stop, 128):
            piece = data[k : min(k + 128, stop)]
            out.append(len(piece) - 1)
            out.extend(piece)

    for at, n in zip(head[size >= 3].tolist(), size[size >= 3].tolist(), strict=True):
        literal(at)
        done = at + n
        while n > 0:
            k = min(n, 128)
            out.append((257 - k) & 255 if k > 1 else 0)
            out.append(data[at])
            n -= k
    literal(len(data))
    return bytes(out)


def packbits_decode(data: bytes, size: int) -> bytes:
    out, at, end = [], 0, len(data)
    got = 0
    while got < size and at < end:
        n = data[at]
        if n < 128:
            piece = data[at + 1 : at + 2 + n]
            at += 2 + n
        elif n > 128:
            piece = data[at + 1 : at + 2] * (257 - n)
            at += 2
        else:
            at += 1
            continue
        out.append(piece)
        got += len(piece)
    return b"".join(out)


_SINGLE = [bytes([i]) for i in range(256)]


def lzw_encode(data: bytes) -> bytes:
    """Most significant bit first, code width changed one code early, table cleared when full."""
    table = {s: i for i, s in enumerate(_SINGLE)}
    acc, held, width, free, out = 256, 9, 9, 258, bytearray()
    text = b""
    for byte in _iter_bytes(data):
        longer = text + byte
        if longer in table:
            text = longer
            continue
        acc, held = acc << width | table[text], held + width
        table[longer] = free
        free += 1
        text = byte
        if free == 4094:
            acc, held = acc << width | 256, held + width
            table = {s: i for i, s in enumerate(_SINGLE)}
            width, free = 9, 258
        elif free + 1 > 1 << width:
            width += 1
        if held > 4096:
            held, spare = held & 7, held
            out += (acc >> held).to_bytes(spare >> 3, "big")
            acc &= (1 << held) - 1
    if text:
        acc, held = acc << width | table[text], held + width
        free += 1
        if free + 1 > 1 << width and width < 12:
            width += 1
    acc, held = acc << width | 257, held + width
    pad = -held % 8
    return bytes(out + (acc << pad).to_bytes((held + pad) >> 3, "big"))


def _iter_bytes(data: bytes) -> Iterator[bytes]:
    return map(_SINGLE.__getitem__, data)


def lzw_decode(data: bytes, size: int) -> bytes:
    out: list[bytes] = []
    got, at, acc, held, width = 0, 0, 0, 0, 9
    table: list[bytes] = [*_SINGLE, b"", b""]
    last = b""
    while got < size:
        while held < width:
            if at >= len(data):
                return b"".join(out)
            chunk = data[at : at + 32]
            at += len(chunk)
            acc = (acc & ((1 << held) - 1)) << (8 * len(chunk)) | int.from_bytes(chunk, "big")
            held += 8 * len(chunk)
        held -= width
        code = (acc >> held) & ((1 << width) - 1)
        if code == 256:
            table, last, width = [*_SINGLE, b"", b""], b"", 9
            continue
        if code == 257:
            break
        if not last:
            if code > 255:
                raise TiffError("LZW code without a first string")
            entry = table[code]
        elif code < len(table):
            entry = table[code]
            table.append(last + entry[:1])
        elif code == len(table):
            entry = last + last[:1]
            table.append(entry)
        else:
            raise TiffError("LZW code past the table")
        out.append(entry)
        got += len(entry)
        last = entry
        if len(table) >= (1 << width) - 1 and width < 12:
            width += 1
    return b"".join(out)


def _pack(data: bytes, compression: int) -> bytes:
    if compression == LZW:
        return lzw_encode(data)
    if compression == PACKBITS:
        return packbits_encode(data)
    if compression in (DEFLATE, OLD_DEFLATE):
        return zlib.compress(data, 4)
    return data


def _unpack(data: bytes, compression: int, size: int) -> bytes:
    if compression == LZW:
        return lzw_decode(data, size)
    if compression == PACKBITS:
        return packbits_decode(data, size)
    if compression in (DEFLATE, OLD_DEFLATE):
        return zlib.decompressobj().decompress(data, size)
    if compression == NONE:
        return data[:size]
    raise TiffError(f"compression {compression}")


def encode_file(pages: list[tuple[np.ndarray, int, int, tuple[int, int] | None, int]]) -> bytes:
    """pages: (rows x columns of bytes, compression, predictor, (tile rows, tile columns) or None, rows per strip)."""
    out = bytearray(b"II*\0\0\0\0\0")
    link = 4
    for pixels, compression, predictor, tile, per_strip in pages:
        height, width = pixels.shape
        if tile:
            down, across = -(-height // tile[0]), -(-width // tile[1])
            full = np.zeros((down * tile[0], across * tile[1]), dtype=np.uint8)
            full[:height, :width] = pixels
            blocks = [full[r * tile[0] : (r + 1) * tile[0], c * tile[1] : (c + 1) * tile[1]] for r in range(down) for c in range(across)]
        else:
            blocks = [pixels[r : r + per_strip] for r in range(0, height, per_strip)]
        places, sizes = [], []
        for b in blocks:
            if predictor == 2:
                b = np.concatenate([b[:, :1], b[:, 1:] - b[:, :-1]], axis=1)
            data = _pack(b.tobytes(), compression)
            places.append(len(out))
            sizes.append(len(data))
            out += data
        if len(out) % 2:
            out += b"\0"
        fields: list[tuple[int, list[int]]] = [(WIDTH, [width]), (LENGTH, [height]), (BITS, [8]), (COMPRESSION, [compression]), (PHOTOMETRIC, [1]), (SAMPLES, [1]), (PLANAR, [1]), (PREDICTOR, [predictor])]
        fields += [(TILE_WIDTH, [tile[1]]), (TILE_LENGTH, [tile[0]]), (TILE_OFFSETS, places), (TILE_COUNTS, sizes)] if tile else [(ROWS_PER_STRIP, [per_strip]), (STRIP_OFFSETS, places), (STRIP_COUNTS, sizes)]
        entries = []
        for tag, values in sorted(fields):
            raw = struct.pack(f"<{len(values)}I", *values)
            if len(raw) > 4:
                entries.append(struct.pack("<HHII", tag, 4, len(values), len(out)))
                out += raw
            else:
                entries.append(struct.pack("<HHI", tag, 4, len(values)) + raw)
        struct.pack_into("<I", out, link, len(out))
        out += struct.pack("<H", len(entries)) + b"".join(entries)
        link = len(out)
        out += b"\0\0\0\0"
    return bytes(out)


def _directory(data: bytes, at: int, order: str) -> tuple[dict[int, tuple[int, ...]], int]:
    (count,) = struct.unpack_from(f"{order}H", data, at)
    fields = {}
    for k in range(count):
        place = at + 2 + 12 * k
        tag, kind, n = struct.unpack_from(f"{order}HHI", data, place)
        if kind in FIELD:
            size, code = FIELD[kind]
            if n * size > len(data):
                raise TiffError("field longer than the file")
            (where,) = (place + 8,) if n * size <= 4 else struct.unpack_from(f"{order}I", data, place + 8)
            fields[tag] = struct.unpack_from(f"{order}{n}{code}", data, where)
    (following,) = struct.unpack_from(f"{order}I", data, at + 2 + 12 * count)
    return fields, following


def decode_page(data: bytes, f: dict[int, tuple[int, ...]], order: str = "<") -> tuple[np.ndarray, dict]:
    one = lambda tag, default=None: f[tag][0] if f.get(tag) else default
    width, height, compression, predictor, samples = one(WIDTH), one(LENGTH), one(COMPRESSION, 1), one(PREDICTOR, 1), one(SAMPLES, 1)
    if not width or not height:
        raise TiffError("no size")
    bits = one(BITS, 1)
    if bits not in (8, 16) or any(b != bits for b in f[BITS]) or one(PLANAR, 1) != 1 or predictor not in (1, 2):
        raise TiffError("only chunky samples of 8 or 16 bits with predictor 1 or 2 are decoded")
    stored = np.dtype(np.uint8 if bits == 8 else f"{order}u2")
    tiled = TILE_OFFSETS in f
    if tiled:
        step_down, step_across, places, sizes = one(TILE_LENGTH), one(TILE_WIDTH), f[TILE_OFFSETS], f[TILE_COUNTS]
    else:
        step_down, step_across, places, sizes = min(one(ROWS_PER_STRIP, height), height), width, f[STRIP_OFFSETS], f[STRIP_COUNTS]
    if not step_down or not step_across:
        raise TiffError("no strip or tile size")
    across = -(-width // step_across)
    blocks = -(-height // step_down) * across
    if not len(places) == len(sizes) == blocks:
        raise TiffError("strips or tiles missing")
    if blocks * step_down * step_across * samples * stored.itemsize > 1032 * max(len(data), 1) * 16:
        raise TiffError("size out of proportion to the file")
    pixels = np.zeros((height, width, samples), dtype=stored.newbyteorder("<"))
    for k, (at, n) in enumerate(zip(places, sizes, strict=True)):
        row, column = k // across * step_down, k % across * step_across
        rows = step_down if tiled else min(step_down, height - row)
        raw = _unpack(data[at : at + n], compression, rows * step_across * samples * stored.itemsize)
        if len(raw) != rows * step_across * samples * stored.itemsize:
            raise TiffError(f"strip or tile {k} is short")
        block = np.frombuffer(raw, dtype=stored).reshape(rows, step_across, samples)
        if predictor == 2:
            block = np.cumsum(block, axis=1, dtype=stored.newbyteorder("="))
        pixels[row : row + rows, column : column + step_across] = block[: height - row, : width - column]
    return pixels, {"width": width, "height": height, "samples": samples, "bits": bits, "compression": NAMES[compression], "predictor": predictor, "layout": "tiles" if tiled else "strips"}


EMPTY = {"width": None, "height": None, "samples": None, "bits": None, "compression": None, "predictor": None, "layout": None}


def walk(data: bytes | None) -> Iterator[dict]:
    """One dict per page of a file."""
    if data is None or data[:4] not in (b"II*\0", b"MM\0*") or len(data) < 8:
        yield {"page": 0, **EMPTY, "pixels": None, "error": "not a TIFF file"}
        return
    order = "<" if data[:2] == b"II" else ">"
    (at,), seen, page = struct.unpack_from(f"{order}I", data, 4), set(), 0
    while at and at not in seen:
        seen.add(at)
        try:
            fields, at = _directory(data, at, order)
        except (struct.error, TiffError) as e:
            yield {"page": page, **EMPTY, "pixels": None, "error": f"directory: {e}"}
            return
        try:
            pixels, about = decode_page(data, fields, order)
            yield {"page": page, **about, "pixels": pixels.tobytes(), "error": None}
        except (TiffError, KeyError, struct.error, zlib.error, MemoryError) as e:
            yield {"page": page, **EMPTY, "pixels": None, "error": f"{type(e).__name__}: {e}"}
        page += 1


PAGE = "page integer, width long, height long, samples integer, bits integer, compression string, predictor integer, layout string, pixels binary, error string"
_PAGE_ARROW = [("page", pa.int32()), ("width", pa.int64()), ("height", pa.int64()), ("samples", pa.int32()), ("bits", pa.int32()), ("compression", pa.string()), ("predictor", pa.int32()), ("layout", pa.string()), ("pixels", pa.binary()), ("error", pa.string())]


def read_pages(files: DataFrame, keep: tuple[str, ...], content: str = "content") -> DataFrame:
    """One row per page, in page order within each file: the columns in `keep` and those of PAGE."""
    source = files.select(*keep, F.col(content).alias("_content"))
    schema = source.drop("_content").schema
    for field in PAGE.split(", "):
        schema = schema.add(*field.split())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "_content"):
                at, pages = [], []
                for k, data in enumerate(batch.column("_content")):
                    for p in walk(data.as_py()):
                        at.append(k)
                        pages.append(p)
                kept = [batch.column(c).take(pa.array(at, pa.int64())) for c in keep]
                made = [pa.array([p[n] for p in pages], t) for n, t in _PAGE_ARROW]
                yield pa.RecordBatch.from_arrays([*kept, *made], names=[*keep, *(n for n, _ in _PAGE_ARROW)])

    return source.mapInArrow(run, schema)


def payload_of(text: bytes) -> bytes:
    return text + b"\xff" * ((-len(text)) % UNIT if text else UNIT)


def plan_pages(payload: bytes) -> list:
    """An eighth of the rows LZW with differences in strips of 16, three eighths PackBits in strips of 8, the rest deflate in tiles with differences."""
    pixels = np.frombuffer(payload, dtype=np.uint8).reshape(-1, UNIT)
    a, b = -(-len(pixels) // 8), -(-len(pixels) // 2)
    plan = [(pixels[:a], LZW, 2, None, 16), (pixels[a:b], PACKBITS, 1, None, 8), (pixels[b:], DEFLATE, 2, (64, 192), 0)]
    return [p for p in plan if len(p[0])]


def write_files(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One TIFF file per row: id, n_bytes, content."""
    source = docs.select(F.col(id_col), F.col(text).alias("_text"))
    schema = source.drop("_text").schema.add("n_bytes", "long").add("content", "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "_text"):
                texts = [(t or "").encode() for t in batch.column("_text").to_pylist()]
                media = pa.array([encode_file(plan_pages(payload_of(t))) for t in texts], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(id_col), pa.array([len(t) for t in texts], pa.int64()), media], names=[id_col, "n_bytes", "content"])

    return source.mapInArrow(run, schema)


def _feature(pages: list[tuple[str, int]], payload: bytes) -> str:
    """Pages and their decoders, mean sample, and a 64-bit difference hash of 65 equal parts."""
    a = np.frombuffer(payload, dtype=np.uint8)
    total = np.concatenate([[0], np.cumsum(a, dtype=np.int64)])
    cut = np.linspace(0, len(a), 66).astype(np.int64)
    mean = np.diff(total[cut]) * 1000 // np.maximum(np.diff(cut), 1)
    bits = int.from_bytes(np.packbits(mean[1:] > mean[:-1]).tobytes(), "big")
    return f"{'+'.join(f'{c}:{h}' for c, h in pages)} mean={int(total[-1]) * 1000 // len(a)} dhash={bits:016x}"


def digest(docs: DataFrame) -> DataFrame:
    """Store every text, read the stored files back, and describe what came back."""
    stored = durable(write_files(docs)).withColumn("file", F.monotonically_increasing_id())
    about = stored.withColumns({"media_bytes": F.octet_length("content").cast("long"), "media_sha256": F.sha2("content", 256)})
    pages = read_pages(about, ("doc_id", "n_bytes", "file", "media_bytes", "media_sha256"))
    schema = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, n_pages int, error string"
    names = [f.split()[0] for f in schema.split(", ")]

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pages of one file are neighbours in a task, but may lie in two batches."""
        open_file: list[dict] = []

        def close() -> dict:
            first = open_file[0]
            payload = b"".join(p["pixels"] or b"" for p in open_file)
            return {
                "doc_id": first["doc_id"], "n_bytes": first["n_bytes"], "payload_bytes": len(payload), "payload_sha256": hashlib.sha256(payload).hexdigest(),
                "tail_crc32": zlib.crc32(payload[-32:]), "media_bytes": first["media_bytes"], "media_sha256": first["media_sha256"],
                "feature": _feature([(p["compression"], p["height"]) for p in open_file], payload) if payload else None,
                "n_pages": len(open_file), "error": next((p["error"] for p in open_file if p["error"]), None),
            }

        types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int32(), pa.string()]
        for batch in batches:
            done = []
            for row in batch.to_pylist():
                if open_file and row["file"] != open_file[0]["file"]:
                    done.append(close())
                    open_file.clear()
                open_file.append(row)
            if done:
                yield pa.RecordBatch.from_arrays([pa.array([d[n] for d in done], t) for n, t in zip(names, types, strict=True)], names=names)
        if open_file:
            last = close()
            yield pa.RecordBatch.from_arrays([pa.array([last[n]], t) for n, t in zip(names, types, strict=True)], names=names)

    return pages.mapInArrow(fold, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(table(spark, sf_dir, "documents"))
