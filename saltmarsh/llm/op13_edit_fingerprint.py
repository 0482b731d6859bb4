"""Document fingerprints by a randomised edit embedding.

A walk reads a text character by character. At step j it looks at one character, and a random bit that
all texts share, chosen by j and the character, says whether the next step looks at the next one.
So a character is looked at for some steps, and texts that differ by edits fall into step again behind
them: their edit distance becomes a Hamming distance between what the walks look at, step by step.

A fingerprint samples that: each of its 512 bits (two walks, 256 each) takes a step and a random bit of
the character looked at there. The step is the one with the smallest random number among all steps of the
walk, so it is spread evenly over the whole text, however long, and texts of similar length are
sampled at the same steps. Of n steps it is the last record of a sequence of records, which depend on nothing
else and are drawn once (`records`). The likeness of two fingerprints is 2 * equal bits / 512 - 1, 0 at the
least: the share of steps at which the walks look at the same character.

Documents are linked where their whole fingerprints are at least `NEAR` alike, and groups (`groups`) are the
connected components of all links. Equal fingerprints are one class. Two passes find the components. The first one
puts crowds together at the cost of their size: the bits are dealt into 16 bands of 32, and in a band's bucket
each class is held against the smallest one; those that it doesn't link are dealt anew by that band and the
next one, and once more by four bands. That misses links, so a second pass finds every one between two components
of the first (`between`): two fingerprints that differ in 25 bits at most, cut into 13 stretches, differ in one bit at most
of some stretch, so one half of it is equal and the other one bit off at most. Classes meet by half stretches,
pairs of one component aren't made, and what a stretch allows is held against the whole fingerprints. A bucket of the second
pass costs the pairs of classes of different components in it, in a task's arrays; what is stored and shuffled is its size.

`chained` also fingerprints an edited text of each document: its last floor(n / 2) characters are replaced by the
first as many (or all) of the next document in the order of (doc_id, hash of text), the first following the
last. Texts are sorted by range once; only the first and last document of each range meet again.

Defined results: a null text is empty; an empty text has a fingerprint of its own. A table of one document has
itself as the next. Rows without a doc_id come before all others and belong to no group. Rows that share a doc_id
follow each other; rows equal in both are each other's next. doc_id is a long. Extra columns don't pass. An
empty table gives no rows. A text takes time in proportion to its length; one text has to fit a task.
Rows have to come in the same order if a task is redone, as from files.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from saltmarsh.llm import textarrays as ta
from saltmarsh.llm.common import durable, seen, side_of, slices, table
from saltmarsh.llm.components import components

U = np.uint64
WALKS, SAMPLES, BANDS = 2, 256, 16
BITS = WALKS * SAMPLES
#: The shared random bits repeat after so many steps; characters are told apart by 8 bits in them.
PERIOD, CLASSES = 4096, 256
NEAR = 0.9
#: Texts up to which each is walked by itself, not all side by side.
FEW = 48
_NOTHING = 0x110000
#: Bytes of text taken together.
SLICE = 6_000_000


@lru_cache(maxsize=1)
def stays() -> np.ndarray:
    """At [(walk * CLASSES + class) * PERIOD + step]: for how many steps a character met at that step is looked at."""
    go = np.random.default_rng(20250301).integers(0, 2, (WALKS * CLASSES, PERIOD), dtype=np.uint8).astype(bool)
    go[:, -1] = True
    here = np.arange(PERIOD)
    following = np.minimum.accumulate(np.where(go, here, PERIOD)[:, ::-1], axis=1)[:, ::-1]
    return (following - here + 1).astype(np.uint8).ravel()


@lru_cache(maxsize=WALKS)
def records(walk: int) -> list[np.ndarray]:
    """Of each sample the steps that have a smaller random number than all before them, up to 2^52."""
    rng, out = np.random.default_rng([20250302, walk]), []
    for _ in range(SAMPLES):
        at = [0]
        while at[-1] < 1 << 52:
            at.append(max(at[-1] + 1, int(np.ceil((at[-1] + 1) / max(rng.random(), 1e-12) - 1))))
        out.append(np.array(at))
    return out


class Texts:
    """Characters of texts, one behind the other."""

    def __init__(self, code: np.ndarray, size: np.ndarray):
        self.code, self.size = code, size
        self.first = np.cumsum(size) - size
        self.kind = ((code ^ (code >> 8)) & 255).astype(np.uint8)

    @classmethod
    def of(cls, texts: list[str]) -> Texts:
        return cls(np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype="<u4"), np.array([len(t) for t in texts], dtype=np.int64))


def _within(size: np.ndarray) -> np.ndarray:
    return np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)


def steps(x: Texts, begin: np.ndarray) -> np.ndarray:
    """Of each walk and character the step behind the last one at which it is looked at; begin: of each walk each text's first step.

    The walks of all texts go side by side, character by character; those of the few longest go on alone.
    """
    stay = stays()
    # Steps of a text are about twice its characters.
    upto = np.empty((WALKS, len(x.code)), dtype=np.int32 if len(x.code) < 1 << 28 else np.int64)
    order = np.argsort(-x.size, kind="stable")
    first, size, j = x.first[order], x.size[order], begin[:, order].astype(np.int64)
    kind = x.kind.astype(np.int32) * PERIOD
    tables = (np.arange(WALKS) * CLASSES * PERIOD)[:, None]
    longer = len(size) - np.cumsum(np.bincount(np.minimum(size, int(size[FEW]) if len(size) > FEW else 0)))  # texts of more than i characters
    i = 0
    for m in longer.tolist():
        if m <= FEW:
            break
        at, now = first[:m] + i, j[:, :m]
        now += stay[kind[at] + tables + (now & (PERIOD - 1))]
        upto[:, at] = now
        i += 1
    flat = stay.tobytes()
    for k in range(int(np.count_nonzero(size > i))):
        here, rest = int(first[k]) + i, kind[int(first[k]) + i : int(first[k] + size[k])].tolist()
        for w in range(WALKS):
            at, out, table_ = int(j[w, k]), [], int(tables[w, 0])
            for c in rest:
                at += flat[table_ + c + (at & (PERIOD - 1))]
                out.append(at)
            upto[w, here : here + len(out)] = out
    return upto


def sampled(x: Texts, upto: np.ndarray, walk: int) -> np.ndarray:
    """The bits of one walk, a row for each text."""
    some = np.flatnonzero(x.size)
    last = upto[x.first[some] + x.size[some] - 1].astype(np.int64)
    behind = np.cumsum(last) - last
    line = upto + np.repeat(behind, x.size[some])
    symbol = np.full((len(x.size), SAMPLES), _NOTHING, dtype=U)
    step = np.stack([r[np.searchsorted(r, last) - 1] for r in records(walk)], axis=1) + behind[:, None]
    symbol[some] = x.code[np.searchsorted(line, step.ravel(), side="right")].reshape(step.shape)
    number = np.arange(walk * SAMPLES, (walk + 1) * SAMPLES, dtype=U) << U(32)
    return (ta.mix(symbol ^ number, 13) >> U(40) & U(1)).astype(np.uint8)


def embed(texts: list[str]) -> np.ndarray:
    """The fingerprints of texts, 64 bytes a row."""
    x = Texts.of(texts)
    upto = steps(x, np.zeros((WALKS, len(texts)), dtype=np.int64))
    return np.packbits(np.concatenate([sampled(x, upto[w], w) for w in range(WALKS)], axis=1), axis=1)


def embed_edited(texts: list[str], following: list[str]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Fingerprints of texts and of what they become by the text that follows each, whose SHA-256 is given too.

    An edited text starts like its text, so its walk goes on from there.
    """
    x = Texts.of(texts)
    kept = x.size - x.size // 2
    tails = [f[: len(t) // 2] for t, f in zip(texts, following, strict=True)]
    y = Texts.of(tails)
    edited = Texts(np.empty(int((kept + y.size).sum()), dtype=np.uint32), kept + y.size)
    from_x, from_y = np.repeat(x.first, kept) + _within(kept), np.repeat(edited.first + kept, y.size) + _within(y.size)
    to_x = np.repeat(edited.first, kept) + _within(kept)

    def laid(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out = np.empty(len(edited.code), dtype=a.dtype)
        out[to_x], out[from_y] = a[from_x], b
        return out

    edited = Texts(laid(x.code, y.code), edited.size)
    upto = steps(x, np.zeros((WALKS, len(texts)), dtype=np.int64))
    begin, some = np.zeros((WALKS, len(texts)), dtype=np.int64), kept > 0
    begin[:, some] = upto[:, x.first[some] + kept[some] - 1]
    further = steps(y, begin)
    own = [sampled(x, upto[w], w) for w in range(WALKS)]
    other = [sampled(edited, laid(upto[w], further[w]), w) for w in range(WALKS)]
    shas = [hashlib.sha256((t[: len(t) - len(t) // 2] + u).encode("utf-8", "surrogatepass")).digest() for t, u in zip(texts, tails, strict=True)]
    return np.packbits(np.concatenate(own, axis=1), axis=1), np.packbits(np.concatenate(other, axis=1), axis=1), shas


def alike(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Likeness of fingerprints, row by row."""
    apart = np.bitwise_count(a ^ b).sum(axis=1, dtype=np.int64)
    return np.maximum(0.0, 1 - 2 * apart / BITS)


_CHAINED = [("kind", pa.string()), ("part", pa.int32()), ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited", pa.binary()), ("fp", pa.binary()), ("edited_fp", pa.binary()), ("near_edited", pa.float64()), ("near_next", pa.float64()), ("text", pa.string())]
CHAINED = "kind string, part int, doc_id long, n_chars long, edited binary, fp binary, edited_fp binary, near_edited double, near_next double, text string"


def _out(kind: str, part: int, ids: list[int | None], **columns: object) -> pa.RecordBatch:
    n = len(ids)
    values = {"kind": [kind] * n, "part": [part] * n, "doc_id": ids, **columns}
    return pa.RecordBatch.from_arrays([pa.array(values[c], t) if c in values else pa.nulls(n, t) for c, t in _CHAINED], names=[c for c, _ in _CHAINED])


def _judged(part: int, ids: list[int | None], texts: list[str], fp: np.ndarray, edited_fp: np.ndarray, shas: list[bytes], near_next: np.ndarray) -> pa.RecordBatch:
    packed = lambda x: [r.tobytes() for r in x]
    return _out("row", part, ids, n_chars=[len(t) for t in texts], edited=shas, fp=packed(fp), edited_fp=packed(edited_fp), near_edited=alike(fp, edited_fp), near_next=near_next)


def chained(docs: DataFrame, text: str = "text") -> DataFrame:
    """Rows of CHAINED: of each document its own and its edited text's fingerprint, and the likeness to both neighbours' (stored)."""
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(text, F.lit("")).alias("_text"))
    keyed = source.withColumn("_hash", F.xxhash64("_text")).withColumn("_salt", F.monotonically_increasing_id())
    spark = docs.sparkSession
    order = ["doc_id", "_hash", "_salt"]
    dealt = keyed.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        ids: list[int | None] = []
        texts: list[str] = []  # the last one waits for its next
        waiting: tuple | None = None  # the last row before it, which waits for its next one's fingerprint
        for whole in batches:
            for batch in slices(whole, "_text", SLICE):
                new_ids, new = batch.column("doc_id").to_pylist(), batch.column("_text").to_pylist()
                if not texts:
                    yield _out("first", part, new_ids[:1], text=new[:1])
                ids, texts = ids + new_ids, texts + new
                if len(texts) == 1:
                    continue
                fp, edited_fp, shas = embed_edited(texts[:-1], texts[1:])
                if waiting:
                    yield _judged(part, *waiting, alike(waiting[2], fp[:1]))
                if len(texts) > 2:
                    yield _judged(part, ids[:-2], texts[:-2], fp[:-1], edited_fp[:-1], shas[:-1], alike(fp[:-1], fp[1:]))
                waiting = (ids[-2:-1], texts[-2:-1], fp[-1:], edited_fp[-1:], shas[-1:])
                ids, texts = ids[-1:], texts[-1:]
        if waiting:
            yield _judged(part, *waiting, alike(waiting[2], embed(texts)))
        if texts:
            yield _out("last", part, ids, text=texts)

    found = durable(dealt.select("doc_id", "_text").mapInArrow(run, CHAINED))
    # One row for each range at most.
    held = sorted(r.part for r in found.where("kind = 'first'").select("part").collect())
    if not held:
        return found
    turns = spark.createDataFrame([(b, a) for a, b in zip(held, held[1:] + held[:1], strict=True)], "part int, to int")
    first = found.where("kind = 'first'").join(F.broadcast(turns), "part").select(F.col("to").alias("part"), F.col("text").alias("_next"))
    ends = found.where("kind = 'last'").select("part", "doc_id", F.col("text").alias("_text")).join(first, "part")

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, ids, texts, following = (batch.column(c).to_pylist() for c in ("part", "doc_id", "_text", "_next"))
            for k in range(len(texts)):
                fp, edited_fp, shas = embed_edited(texts[k : k + 1], following[k : k + 1])
                yield _judged(parts[k], ids[k : k + 1], texts[k : k + 1], fp, edited_fp, shas, alike(fp, embed(following[k : k + 1])))

    return found.where("kind = 'row'").unionByName(durable(ends.mapInArrow(close, CHAINED)))


def fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id and fp, the fingerprint of each text."""
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "_text", SLICE):
                fp = embed([t or "" for t in batch.column("_text").to_pylist()])
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([r.tobytes() for r in fp], pa.binary())], names=["doc_id", "fp"])

    return source.mapInArrow(run, "doc_id long, fp binary")


#: Neighbouring bands of the first pass taken together: first each alone, then for what a bucket's smallest class doesn't link.
LEVELS = (1, 2, 4)


def band_key(fp: Column, band: Column, level: int) -> Column:
    """`level` bands from one on, in a ring. Neighbouring bits are no closer to each other than others, so a band is four bytes."""
    return F.concat(F.substring(F.hex(band), -1, 1).cast("binary"), F.substring(F.concat(fp, fp), 4 * band + 1, F.lit(4 * level)))


def _judged_pairs(tried: DataFrame, classes: DataFrame, near: float) -> DataFrame:
    """Rows (id, pivot, band) and whether the two fingerprints are near enough, stored."""
    side = lambda name, fp: classes.select(F.col("id").alias(name), F.col("fp").alias(fp))
    both = tried.join(side("id", "_a"), "id").join(side("pivot", "_b"), "pivot").select("id", "pivot", "band", "_a", "_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.uint8).reshape(-1, BITS // 8) for c in ("_a", "_b"))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("id", "pivot", "band")), pa.array(alike(a, b) >= near)], names=["id", "pivot", "band", "near"])

    return durable(both.mapInArrow(run, "id long, pivot long, band int, near boolean"), far=F.count_if(~F.col("near")))


#: Bits of half a stretch at most, and pairs held against each other at once.
HALF, AT_ONCE = 20, 2_000_000


def stretches(near: float) -> int:
    """Into how many stretches fingerprints are cut, so that two that are near differ in one bit at most of one of them."""
    if near <= 0:
        raise ValueError("near has to be above 0")
    apart = max((a for a in range(BITS // 2) if 1 - 2 * a / BITS >= near), default=0)
    return max(apart // 2 + 1, -(-BITS // (2 * HALF)))


def half_stretches(fp: np.ndarray, n: int) -> np.ndarray:
    """Of each fingerprint 2 * n numbers: which half of which stretch, its bits, and those of the other half (`HALF` bits each)."""
    bits = np.unpackbits(fp, axis=1)
    ends = np.arange(2 * n + 1) * BITS // (2 * n)
    halves = np.stack([bits[:, a:z] @ (1 << np.arange(z - a, dtype=np.int64)) for a, z in pairwise(ends.tolist())], axis=1)
    other = halves.reshape(-1, n, 2)[:, :, ::-1].reshape(halves.shape)
    return np.arange(2 * n) << 2 * HALF | halves << HALF | other


def met(bucket: np.ndarray, part: np.ndarray, other: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of pairs of one bucket and different parts whose other halves are one bit off at most; rows in order of (bucket, part)."""
    place = np.arange(len(bucket))
    ends = lambda new: np.append(np.flatnonzero(new), len(bucket))[np.cumsum(np.append(0, new[1:])) + 1] if len(bucket) else place
    first = np.append(True, bucket[1:] != bucket[:-1])[: len(bucket)]
    start = ends(first | np.append(True, part[1:] != part[:-1])[: len(bucket)])
    many = ends(first) - start
    upto = np.cumsum(many)
    at = 0
    while at < len(bucket):
        stop = max(at + 1, int(np.searchsorted(upto, upto[at] - many[at] + AT_ONCE, side="right")))
        a = np.repeat(place[at:stop], many[at:stop])
        b = _within(many[at:stop]) + np.repeat(start[at:stop], many[at:stop])
        some = np.bitwise_count(other[a] ^ other[b]) <= 1
        if some.any():
            yield a[some], b[some]
        at = stop


def _buckets(batches: Iterator[pa.RecordBatch], columns: Callable[[pa.RecordBatch], list[np.ndarray]]) -> Iterator[list[np.ndarray]]:
    """The columns of rows that come in order of the first one, cut only where that changes."""
    held: list[list[np.ndarray]] = []
    for batch in batches:
        rows = columns(batch)
        if not len(rows[0]):
            continue
        last = int(np.searchsorted(rows[0], rows[0][-1]))
        if held and (last or held[-1][0][-1] != rows[0][0]):
            held.append([x[:last] for x in rows])
            yield [np.concatenate(x) for x in zip(*held, strict=True)]
            held, last, rows = [], 0, [x[last:] for x in rows]
        held.append(rows)
    if held:
        yield [np.concatenate(x) for x in zip(*held, strict=True)]


def _forest(a: np.ndarray, b: np.ndarray, over: dict[int, int]) -> Iterator[tuple[int, int]]:
    """Of links those that join what others before them, kept in `over`, haven't."""
    for x, y in np.unique(np.stack([a, b], axis=1), axis=0).tolist():
        roots = []
        for at in (x, y):
            while (up := over.get(at, at)) != at:
                over[at] = over.get(up, up)
                at = up
            roots.append(at)
        if roots[0] != roots[1]:
            over[roots[0]] = roots[1]
            yield x, y


def between(placed: DataFrame, near: float) -> DataFrame:
    """(a, b): links of parts of which classes are near, enough to join all parts that are so joined by any; stored.

    placed: id, part, fp. First only half stretches meet, and those that could be of a pair stay; they meet
    again with their fingerprints. Each time a row is one half stretch of a class, however many pairs it is in.
    """
    n, low = stretches(near), (1 << HALF) - 1
    prints = lambda batch: np.frombuffer(b"".join(batch.column("fp").to_pylist()), dtype=np.uint8).reshape(-1, BITS // 8)
    numbers = lambda batch: [batch.column(c).to_numpy() for c in ("bucket", "id", "part", "other")]
    entry = "bucket long, id long, part long, other int"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "fp", BITS // 8 * 4096):
                keys = half_stretches(prints(batch), n).ravel()
                ids, parts = (np.repeat(batch.column(c).to_numpy(), 2 * n) for c in ("id", "part"))
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (keys >> HALF, ids, parts, (keys & low).astype(np.int32))], names=["bucket", "id", "part", "other"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _buckets(batches, numbers):
            some = np.zeros(len(rows[0]), dtype=bool)
            for a, b in met(rows[0], rows[2], rows[3]):
                some[a] = some[b] = True
            yield pa.RecordBatch.from_arrays([pa.array(x[some]) for x in rows], names=["bucket", "id", "part", "other"])

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        over: dict[int, int] = {}
        for bucket, _, parts, other, fp in _buckets(batches, lambda b: [*numbers(b), prints(b)]):
            for a, b in met(bucket, parts, other):
                for at in range(0, len(a), AT_ONCE // 8):
                    x, y = a[at : at + AT_ONCE // 8], b[at : at + AT_ONCE // 8]
                    good = alike(fp[x], fp[y]) >= near
                    found = list(_forest(parts[x[good]], parts[y[good]], over))
                    yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], names=["a", "b"])

    dealt = lambda df: df.repartition("bucket").sortWithinPartitions("bucket", "part")
    entries = durable(dealt(placed.select("id", "part", "fp").mapInArrow(cut, entry)).mapInArrow(meet, entry))
    known = entries.join(placed.select("id", "fp"), "id").select("bucket", "id", "part", "other", "fp")
    return durable(dealt(known).mapInArrow(link, "a long, b long"))


def groups(prints: DataFrame, near: float = NEAR) -> DataFrame:
    """(fp, group): of each fingerprint that another document is near to, or equal, the smallest doc_id of its group.

    prints: doc_id, fp. Rows without a doc_id don't count. A doc_id that stands for several fingerprints is one node.
    """
    spark = prints.sparkSession
    classes = durable(prints.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("id"), F.max("doc_id").alias("most")))
    links = spark.createDataFrame([], "a long, b long")
    at = classes.select("id", "fp", F.explode(F.sequence(F.lit(0), F.lit(BANDS - 1))).alias("band"))
    for level in LEVELS:
        keyed = at.select("id", "band", band_key(F.col("fp"), F.col("band"), level).alias("key"))
        shared = durable(keyed.groupBy("key").agg(F.min("id").alias("pivot"), F.max("id").alias("_most")).where("pivot < _most").select("key", "pivot"))
        if not seen(shared):
            break
        judged = _judged_pairs(keyed.join(side_of(shared), "key").where("id <> pivot").select("id", "pivot", "band"), classes, near)
        links = links.union(judged.where("near").select(F.col("id").alias("a"), F.col("pivot").alias("b")))
        if not seen(judged, "far"):
            break
        at = judged.where("not near").select("id", "band").join(classes.select("id", "fp"), "id")
    placed = components(links)
    own = classes.join(side_of(placed), "id", "left").withColumn("part", F.coalesce("component", "id"))
    further = between(own, near)
    if seen(further):
        more = components(further)
        whole = side_of(more).select(F.col("id").alias("part"), F.col("component").alias("whole"))
        own = own.join(whole, "part", "left").withColumn("component", F.coalesce("whole", "component"))
    return own.where("component is not null or id < most").select("fp", F.coalesce("component", "id").alias("group"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = chained(table(spark, sf_dir, "documents"))
    near = durable(groups(rows.select("doc_id", "fp")))
    out = rows.join(near, "fp", "left")
    return out.select(
        "doc_id", "n_chars", F.lower(F.hex("edited")).alias("edited_sha256"), F.lower(F.hex("fp")).alias("fingerprint"), F.lower(F.hex("edited_fp")).alias("edited_fingerprint"),
        "near_edited", "near_next", F.when(F.col("doc_id").isNotNull(), F.coalesce("group", "doc_id")).alias("group_id"),
    )
