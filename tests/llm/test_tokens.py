"""Token counts and packing against the library."""

import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from saltmarsh.llm import op2_token_counts as op2
from saltmarsh.llm import op9_packing as op9
from tests.llm.helpers import ODD, table

ALPHABET = "abcXYZ0123 '!.,\n\t  éÉßİı²́ñÑ’ \u0085\x1c中あ🙂ΑΣς|<>endoftext½ªºµ×÷\x00\x7f\xadŉſ"


def strings(n=3000):
    r = random.Random(3)
    made = ["".join(r.choice(ALPHABET) for _ in range(r.randrange(40))) for _ in range(n)]
    return [*made, "<|endoftext|>", "a<|startoftext|>b", "<|ENDOFTEXT|>", "it's I'LL 'S", *(f"{chr(i)}a {chr(i)} 1{chr(i)}" for i in range(0x180))]


def test_counts_equal_the_library():
    path = op2.tokenizer_path()
    counter, lib = op2.Counter(path, op2.prove(path)), op2.library(path)
    given = strings()
    assert counter.count(given) == [len(e) for e in lib.encode_batch(given, add_special_tokens=False)]
    assert len(op2.prove(path)) > 20_000


def test_counts_of_odd_rows(spark):
    lib = op2.library(op2.tokenizer_path())
    got = op2.token_counts(table(spark, ODD).withColumn("n_tokens", F.lit("clash"))).collect()
    want = [(i, len((t or "").encode()), len(lib.encode(t or "", add_special_tokens=False).ids)) for i, t in ODD]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert op2.token_counts(table(spark, [])).count() == 0


def test_ids_equal_the_library():
    encoder = op9.Encoder(op9.byte_bpe_path())
    for t in strings():
        assert np.frombuffer(encoder.encode(t), encoder.unit).tolist() == encoder.lib.encode(t, add_special_tokens=False).ids


def test_windows_are_full_and_pieces_whole():
    r = random.Random(1)
    for _ in range(200):
        lengths = [r.choice([1, 5, 200, 300, 700, 1500, 2048, 5000, r.randrange(1, 3000)]) for _ in range(r.randrange(1, 60))]
        windows, parts = op9.pack(lengths), {}
        for size, pieces in windows:
            assert sum(n for _, _, n in pieces) == size and size & (size - 1) == 0 and size <= 2048
            for d, start, n in pieces:
                parts.setdefault(d, []).append((start, n))
        for d, n in enumerate(lengths):
            at = 0
            for start, k in sorted(parts[d]):
                assert start == at
                at += k
            assert at == n
        assert sum(size not in op9.TIERS for size, _ in windows) <= 11
        step = op9.steps(windows)
        held = {}
        for (size, _), s in zip(windows, step, strict=True):
            held.setdefault(s, []).append(size)
        assert all(len(set(v)) == 1 and sum(v) <= op9.STEP_TOKENS for v in held.values())


def test_packing_of_odd_rows(spark):
    lib = op9.library(op9.byte_bpe_path())
    docs = table(spark, ODD).withColumn("start", F.lit("clash"))
    got = op9.pack_documents(docs, group_bytes=100_000).collect()
    ids = [(i, [*lib.encode(t or "", add_special_tokens=False).ids, 1]) for i, t in ODD]
    want = sorted(((i, len(x)) for i, x in ids), key=repr)
    total = {}
    for p in got:
        total[p.doc_id] = total.get(p.doc_id, 0) + p.length
        assert any(i == p.doc_id and len(x) == p.doc_tokens and zlib.crc32(np.array(x[p.start : p.start + p.length], "<u4").tobytes()) == p.ids_crc32 for i, x in ids)
    expected = {}
    for i, n in want:
        expected[i] = expected.get(i, 0) + n
    assert total == expected
    sequences = {}
    for p in got:
        sequences.setdefault(p.sequence_id, []).append(p)
    for pieces in sequences.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 2048 and at & (at - 1) == 0
    assert op9.pack_documents(table(spark, [])).count() == 0


def test_no_key_fills_a_group(spark):
    rows = [(None, f"word{i} " * 50) for i in range(400)] + [(7, "the same text " * 25)] * 400
    got = op9.pack_documents(table(spark, rows), group_bytes=30_000).groupBy("doc_id", (F.col("sequence_id") / 2**32).cast("int").alias("g")).agg(F.sum((F.col("start") == 0).cast("int")).alias("n")).collect()
    for key in (None, 7):
        sizes = [r.n for r in got if r.doc_id == key]
        assert sum(sizes) == 400 and max(sizes) < 120


def test_repeated_rows_are_salted_over_small_batches(spark):
    docs = table(spark, [(1, "same text")] * 3000).coalesce(1)
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    try:
        rows = op9.tokenise(docs, op9.byte_bpe_path, 1).groupBy("row_hash", "salt").count().collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert len(rows) == 3000 and max(r["count"] for r in rows) == 1
