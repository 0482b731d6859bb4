import hashlib
import random

import numpy as np
import pytest

from saltmarsh.llm import op13_edit_fingerprint as op
from saltmarsh.llm import textarrays as ta

from .helpers import ODD, table


def walked(text):
    """The fingerprint, step by step."""
    bits = []
    for w in range(op.WALKS):
        stay, j, seen = op.stays(), 0, []
        for c in text:
            n = int(stay[(w * op.CLASSES + ((ord(c) ^ ord(c) >> 8) & 255)) * op.PERIOD + j % op.PERIOD])
            seen += [ord(c)] * n
            j += n
        for k, record in enumerate(op.records(w)):
            at = max(r for r in record.tolist() if r < max(j, 1))
            symbol = seen[at] if seen else 0x110000
            mixed = int(ta.mix(np.array([symbol ^ (w * op.SAMPLES + k) << 32], dtype=np.uint64), 13)[0])
            bits.append(mixed >> 40 & 1)
    return np.packbits(bits).tobytes()


def alike(a, b):
    return max(0.0, 1 - 2 * sum((x ^ y).bit_count() for x, y in zip(a, b, strict=True)) / op.BITS)


def test_fingerprints_are_the_walks(monkeypatch):
    texts = ["", "a", "aa", "ab" * 3000, "naïve 🙂 中文 text", *(f"text number {i} with words " * (i % 7) for i in range(80))]
    want = [walked(t) for t in texts]
    for few in (op.FEW, 0, 1000):
        monkeypatch.setattr(op, "FEW", few)
        assert [x.tobytes() for x in op.embed(texts)] == want
        following = texts[5:] + texts[:5]
        edited = [t[: len(t) - len(t) // 2] + f[: len(t) // 2] for t, f in zip(texts, following, strict=True)]
        own, other, shas = op.embed_edited(texts, following)
        assert [x.tobytes() for x in own] == want
        assert [x.tobytes() for x in other] == [walked(t) for t in edited]
        assert shas == [hashlib.sha256(t.encode()).digest() for t in edited]


def test_samples_are_spread_evenly():
    where = [r[np.searchsorted(r, 1000) - 1] for w in range(op.WALKS) for r in op.records(w)]
    assert all(60 < n < 145 for n in np.histogram(where, 5, (0, 1000))[0])


@pytest.mark.parametrize("rows", [ODD, ODD[:1], [], [(1, "x"), (2, "y")]])
def test_chain_equals_brute_force(spark, rows):
    docs = table(spark, rows, "doc_id long, text string, lang string, source string, n_chars long").withColumnRenamed("lang", "_hash").withColumnRenamed("source", "kind")
    got = op.chained(docs.repartition(3)).collect()
    hashes = {r.t: r.h for r in spark.createDataFrame([(t or "",) for _, t in rows], "t string").selectExpr("t", "xxhash64(t) h").collect()}
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, hashes[r[1] or ""]))
    want = []
    for k, (i, t) in enumerate(order):
        t, f = t or "", order[(k + 1) % len(order)][1] or ""
        edited = t[: len(t) - len(t) // 2] + f[: len(t) // 2]
        fp, efp = (op.embed([x])[0].tobytes() for x in (t, edited))
        want.append((i, len(t), hashlib.sha256(edited.encode()).digest(), fp, efp, alike(fp, efp), alike(fp, op.embed([f])[0].tobytes())))
    plain = sorted(((r.doc_id, r.n_chars, bytes(r.edited), bytes(r.fp), bytes(r.edited_fp), r.near_edited, r.near_next) for r in got), key=str)
    assert plain == sorted(want, key=str)


def test_groups_equal_all_pairs(spark):
    rng = random.Random(5)
    base = [" ".join(rng.choice("alpha beta gamma delta epsilon zeta eta theta".split()) + str(rng.randrange(99)) for _ in range(300)) for _ in range(12)]
    rows = []
    for k, t in enumerate(base):
        for n in range(1 + 3 * (k % 4)):
            cut = rng.randrange(100, len(t))
            rows.append((100 * k + n, t if n == 1 else t[:cut] + "?" + t[cut + n % 3 :]))
    rows += [(5000, base[0]), (None, base[0]), (None, base[3]), (7, None), (8, "")]
    prints = op.fingerprints(table(spark, rows))
    got = {bytes(r.fp): r.group for r in op.groups(prints).collect()}
    fp = {i: op.embed([t or ""])[0].tobytes() for i, t in rows if i is not None}
    place = {i: i for i in fp}
    for _ in fp:
        place = {i: min(place[j] for j in fp if alike(fp[i], fp[j]) >= op.NEAR) for i in fp}
    want = {fp[i]: p for i, p in place.items() if sum(q == p for q in place.values()) > 1}
    assert got == want
    assert op.groups(op.fingerprints(table(spark, []))).collect() == []


def test_no_link_is_left_out(spark, monkeypatch):
    """Fingerprints that share no band of the first pass, up to 25 bits apart, and one bit beyond."""
    rng = random.Random(9)
    flip = lambda fp, at: bytes(b ^ sum(1 << 7 - k % 8 for k in at if k // 8 == i) for i, b in enumerate(fp))
    rows, want = [], {}
    for k in range(60):
        base, bits = rng.randbytes(64), [32 * w + rng.randrange(32) for w in range(16)]
        apart = 16 + k % 11
        far = flip(base, bits + rng.sample([b for b in range(512) if b not in bits], apart - 16))
        rows += [(10 * k, base), (10 * k + 1, far), (10 * k + 2, far)]
        want |= {base: 10 * k, far: 10 * k} if apart <= 25 else {far: 10 * k + 1}
    # A crowd around one fingerprint, each one bit off it, and one that is near to a single one of the crowd.
    base = rng.randbytes(64)
    crowd = [flip(base, [i]) for i in range(0, 500, 5)]
    near = flip(crowd[7], [32 * w + 31 for w in range(16)] + [32 * w + 30 for w in range(9)])
    rows += [(1000 + i, fp) for i, fp in enumerate([*crowd, near])]
    want |= dict.fromkeys([*crowd, near], 1000)
    prints = spark.createDataFrame(rows, "doc_id long, fp binary")
    for at_once in (op.AT_ONCE, 16):
        monkeypatch.setattr(op, "AT_ONCE", at_once)
        assert {bytes(r.fp): r.group for r in op.groups(prints.repartition(5)).collect()} == want
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    try:
        assert {bytes(r.fp): r.group for r in op.groups(prints).collect()} == want
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@pytest.mark.parametrize("near", [1.0, 0.9, 0.75, 0.5])
def test_stretches_hold_every_near_pair(near):
    rng, n = random.Random(3), op.stretches(near)
    apart = max(a for a in range(512) if 1 - 2 * a / 512 >= near)
    for _ in range(200):
        bits = np.array([rng.randrange(2) for _ in range(512)], dtype=np.uint8)
        other = bits.copy()
        other[rng.sample(range(512), apart)] ^= 1
        a, b = op.half_stretches(np.packbits(np.stack([bits, other]), axis=1), n)
        low = (1 << op.HALF) - 1
        assert ((a >> op.HALF == b >> op.HALF) & (np.bitwise_count((a & low) ^ (b & low)) <= 1)).any()


def test_edits_and_query(spark, tmp_path):
    rng = random.Random(1)
    texts = ["".join(rng.choices("abcdefghij  ", k=2000)) for _ in range(40)]
    table(spark, list(enumerate(texts))).write.parquet(f"{tmp_path}/documents.parquet")
    rows = op.query(spark, str(tmp_path)).collect()
    assert min(r.near_edited for r in rows) > max(r.near_next for r in rows)
    assert all(len(r.fingerprint) == len(r.edited_fingerprint) == 128 and r.group_id == r.doc_id for r in rows)
