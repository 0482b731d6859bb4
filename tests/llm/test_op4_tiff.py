import hashlib
import random
import struct
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from saltmarsh.llm import op4_tiff as op4
from tests.llm.helpers import ODD, table


@settings(max_examples=150, deadline=None)
@given(st.one_of(st.binary(max_size=700), st.text(alphabet="ab", max_size=3000).map(str.encode)))
def test_codecs(data):
    assert op4.packbits_decode(op4.packbits_encode(data), len(data)) == data
    assert op4.lzw_decode(op4.lzw_encode(data), len(data)) == data


def test_long_lzw_clears_its_table():
    r = random.Random(1)
    data = bytes(r.randrange(256) for _ in range(30_000))
    assert op4.lzw_decode(op4.lzw_encode(data), len(data)) == data


@pytest.mark.parametrize("compression", [op4.NONE, op4.LZW, op4.DEFLATE, op4.PACKBITS, op4.OLD_DEFLATE])
@pytest.mark.parametrize("predictor", [1, 2])
@pytest.mark.parametrize(("tile", "strip"), [(None, 7), (None, 50), ((16, 32), 0)])
def test_pages(compression, predictor, tile, strip):
    pixels = np.random.default_rng(0).integers(0, 4, (43, 75)).astype(np.uint8) * 60
    data = op4.encode_file([(pixels, compression, predictor, tile, strip)] * 2)
    got = list(op4.walk(data))
    assert [p["page"] for p in got] == [0, 1] and all(p["error"] is None for p in got)
    assert all(p["pixels"] == pixels.tobytes() and (p["width"], p["height"]) == (75, 43) for p in got)


def test_big_endian_and_rgb():
    pixels = bytes(range(2 * 3 * 3))
    tags = [(256, 3, 1, 3), (257, 3, 1, 2), (258, 3, 3, None), (259, 3, 1, 1), (273, 4, 1, 8), (277, 3, 1, 3), (278, 3, 1, 2), (279, 4, 1, len(pixels))]
    at = 8 + len(pixels)
    extra = at + 2 + 12 * len(tags) + 4
    body = b"".join(struct.pack(">HHI", t, k, n) + (struct.pack(">I", extra) if v is None else struct.pack(">HH", v, 0) if k == 3 else struct.pack(">I", v)) for t, k, n, v in tags)
    data = b"MM\0*" + struct.pack(">I", at) + pixels + struct.pack(">H", len(tags)) + body + struct.pack(">I", 0) + struct.pack(">HHH", 8, 8, 8)
    (page,) = op4.walk(data)
    assert page["error"] is None and page["pixels"] == pixels and page["samples"] == 3


def test_broken_files():
    whole = op4.encode_file([(np.zeros((4, 8), np.uint8), op4.DEFLATE, 1, None, 4)])
    assert [p["error"] for p in op4.walk(None)] == ["not a TIFF file"] == [p["error"] for p in op4.walk(b"II*")]
    for cut in range(8, len(whole)):
        for p in op4.walk(whole[:cut]):
            assert p["error"] or p["pixels"] == bytes(32)
    looped = bytearray(whole)
    struct.pack_into("<I", looped, len(whole) - 4, struct.unpack_from("<I", whole, 4)[0])
    assert len(list(op4.walk(bytes(looped)))) == 1
    r = random.Random(2)
    for _ in range(300):
        bad = bytearray(whole)
        bad[r.randrange(8, len(bad))] = r.randrange(256)
        list(op4.walk(bytes(bad)))


def test_digest_of_odd_rows(spark):
    got = op4.digest(table(spark, ODD).withColumn("file", F.lit("clash"))).collect()
    assert len(got) == len(ODD)
    seen = {}
    for r in got:
        assert r.error is None
        seen.setdefault((r.n_bytes, r.payload_sha256), set()).add((r.media_sha256, r.feature))
    assert all(len(v) == 1 for v in seen.values())
    for i, t in ODD:
        p = op4.payload_of((t or "").encode())
        assert any(r.doc_id == i and r.payload_sha256 == hashlib.sha256(p).hexdigest() and r.tail_crc32 == zlib.crc32(p[-32:]) and r.payload_bytes == len(p) and len(p) % 576 == 0 for r in got)
    assert op4.digest(table(spark, [])).count() == 0


@pytest.mark.parametrize("order", ["<", ">"])
def test_sixteen_bit_differences(order):
    import struct

    want = np.random.default_rng(2).integers(0, 65536, (5, 7), dtype=np.uint16)
    moved = np.concatenate([want[:, :1], want[:, 1:] - want[:, :-1]], axis=1).astype(f"{order}u2").tobytes()
    packed = op4.lzw_encode(moved)
    fields = {op4.WIDTH: 7, op4.LENGTH: 5, op4.BITS: 16, op4.COMPRESSION: op4.LZW, op4.SAMPLES: 1, op4.ROWS_PER_STRIP: 5, op4.STRIP_OFFSETS: 8, op4.STRIP_COUNTS: len(packed), op4.PREDICTOR: 2}
    entries = b"".join(struct.pack(f"{order}HHII", t, 4, 1, v) for t, v in sorted(fields.items()))
    data = (b"II*\0" if order == "<" else b"MM\0*") + struct.pack(f"{order}I", 8 + len(packed)) + packed + struct.pack(f"{order}H", len(fields)) + entries + b"\0" * 4
    (page,) = op4.walk(data)
    assert page["error"] is None and page["bits"] == 16
    assert (np.frombuffer(page["pixels"], "<u2").reshape(5, 7) == want).all()


def test_every_decoder_has_its_share_of_a_long_text():
    payload = op4.payload_of(bytes(np.random.default_rng(1).integers(0, 256, 576 * 200, dtype=np.uint8)))
    pages = list(op4.walk(op4.encode_file(op4.plan_pages(payload))))
    assert b"".join(p["pixels"] for p in pages) == payload
    assert [(p["compression"], p["height"], p["predictor"]) for p in pages] == [("lzw", 25, 2), ("packbits", 75, 1), ("deflate", 100, 2)]
