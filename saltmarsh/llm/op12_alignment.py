"""Cross-tokenizer alignment: which tokens of two vocabularies stand for the same bytes, and how often.

Both tokenisations of a text cut the same bytes (a space and the text), so their ends, laid over each
other, cut it into segments, each inside one token of either side: a segment is a link. Where both have
an end, a group ends.

The first pass aligns the stored tokens, and each task counts its pairs of ids. The distinct pairs get a
minimal perfect hash, shard by shard (`perfecthash`): a fixed number of shards by the pair's hash, each
with a share of at most the product of both vocabularies. Each task's counts then go into dense vectors
indexed by the hash; vectors are summed in two levels, the first over about the square root of the
tasks. The key kept for each slot is compared at every use. The second pass aligns the stored tokens again
and looks the counts up.

Up to `BROADCAST_PAIRS` distinct pairs the hash, keys and counts go to every worker. Beyond, only the most
frequent ones do, with a hash of their own; a link whose key isn't the one of its slot goes to a join with
the others. All links count either way.

Tokens come from dictionaries of pre-tokens (side A, `op9_packing.Encoder`) and of units between
places that no piece crosses (side B, proven when the vocabulary is loaded); what is new is put to the library.

Defined results: texts that are null, empty or whose tokens don't give their bytes back (for instance those
with the character that stands for a space on side B) have no tokens: zeros and an empty digest. Each row counts, repeated rows
and rows without a doc_id as well. Extra columns don't pass. An empty table gives no rows. A text takes time in
proportion to its length; one text has to fit a task.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saltmarsh.llm import textarrays as ta
from saltmarsh.llm.common import durable, slices, table
from saltmarsh.llm.op2_token_counts import byte_alphabet, tokenizer_path
from saltmarsh.llm.op9_packing import REMEMBERED, Encoder
from saltmarsh.llm.perfecthash import SHARDS, Levels, PerfectHash, shard_of

U = np.uint64
#: Distinct pairs up to which hash, keys and counts are broadcast: about 31 bytes a pair in a worker.
BROADCAST_PAIRS = 4_000_000
#: Links gathered before a task counts its pairs, and distinct pairs it holds before it passes them on.
GATHERED, HELD = 4_000_000, 2_000_000
SPACE = "▁"


class SideA(Encoder):
    """Byte-level BPE; strings of special tokens are plain text."""

    def __init__(self, path: str):
        super().__init__(path)
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        self.lib.encode_special_tokens = True
        self.special = re.compile("(?!)")
        self.bytes = [b""] * (max(self.lib.get_vocab().values()) + 1)
        alphabet = byte_alphabet()
        special = {t.content for t in self.lib.get_added_tokens_decoder().values()}
        for token, i in self.lib.get_vocab().items():
            self.bytes[i] = token.encode() if token in special else bytes(alphabet[c] for c in token)


class SideB(dict):
    """Unit -> its ids as bytes. A unit is a line break, spaces and what follows them, or what follows a line break.

    No piece holds a line break or goes on with a space behind another character, so merges stay inside units.
    """

    def __init__(self, path: str):
        super().__init__()
        import sentencepiece

        self.sp = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [sp.id_to_piece(i) for i in range(sp.vocab_size())]
        plain = [p for i, p in enumerate(pieces) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))]
        if any("\n" in p or re.search(f"[^{SPACE}]{SPACE}", p) for p in plain) or len(pieces) > 65536:
            raise ValueError("pieces go on behind a space or a line break, or ids don't fit two bytes")
        self.bytes = [bytes([int(p[3:-1], 16)]) if sp.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)]
        self.cut = re.compile("\n| +[^ \n]*|[^ \n]+")
        self.line = len(sp.encode("\n"))

    def __missing__(self, unit: str) -> bytes:
        # Behind a line break, so that the library adds no space to it.
        ids = self.sp.encode("\n" + unit)[self.line :]
        self[unit] = packed = np.array(ids, dtype="<u2").tobytes()
        return packed

    def encode(self, spaced: str) -> bytes:
        """Of a text behind the space that the library adds."""
        return b"".join(map(self.__getitem__, self.cut.findall(spaced)))


@dataclass
class Sides:
    a: SideA
    b: SideB

    def __post_init__(self) -> None:
        self.size_a, self.size_b = (np.array([len(x) for x in s.bytes], dtype=np.int64) for s in (self.a, self.b))
        names = [[str(i).encode() for i in range(len(s.bytes))] for s in (self.a, self.b)]
        # Each token's text with what stands behind it: inside its part of a group, and at the end of that part.
        self.text = [x + sep for side, seps in zip(names, (b",|", b",;"), strict=True) for sep in (seps[:1], seps[1:]) for x in side]

    def encode(self, text: str | None) -> tuple[bytes, bytes]:
        """The packed ids of both sides; none unless both give the bytes of the text behind a space."""
        if not text or SPACE in text:
            return b"", b""
        spaced = f" {text}"
        for s in (self.a, self.b):
            if len(s) > REMEMBERED:
                s.clear()
        a, b = self.a.encode(spaced), self.b.encode(spaced)
        whole = spaced.encode()
        for ids, s in ((a, self.a), (b, self.b)):
            if b"".join(map(s.bytes.__getitem__, np.frombuffer(ids, dtype="<u2").tolist())) != whole:
                return b"", b""
        return a, b


def paths() -> tuple[str, str]:
    return tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")


@lru_cache(maxsize=2)
def sides(a: str, b: str) -> Sides:
    return Sides(SideA(a), SideB(b))


Paths = Callable[[], tuple[str, str]]


def encode(docs: DataFrame, path_of: Paths = paths, text: str = "text") -> DataFrame:
    """doc_id and the ids of both sides, packed (two bytes an id)."""
    source = docs.select("doc_id", F.col(text).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = sides(*path_of())
        for whole in batches:
            for batch in slices(whole, "_text"):
                a, b = zip(*map(both.encode, batch.column("_text").to_pylist()), strict=True)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["doc_id", "ids_a", "ids_b"])

    return source.mapInArrow(run, source.select("doc_id").schema.add("ids_a", "binary").add("ids_b", "binary"))


@dataclass
class Aligned:
    """A batch of documents. Of each link its tokens, by place, and its document; of each group its end, as a link's place."""

    a: np.ndarray
    b: np.ndarray
    row_a: np.ndarray
    row_b: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray
    row: np.ndarray
    closes: np.ndarray

    def keys(self, both: Sides) -> np.ndarray:
        return (self.a[self.link_a] * len(both.size_b) + self.b[self.link_b]).astype(U)


def _ids(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All ids, and the row of each."""
    sizes = pa.compute.binary_length(column).to_numpy(zero_copy_only=False).astype(np.int64) // 2
    data = np.frombuffer(b"".join(x.as_buffer() for x in column), dtype="<u2").astype(np.int64)
    return data, np.repeat(np.arange(len(sizes)), sizes)


def align(batch: pa.RecordBatch, both: Sides) -> Aligned:
    (a, row_a), (b, row_b) = _ids(batch.column("ids_a")), _ids(batch.column("ids_b"))
    end_a, end_b = np.cumsum(both.size_a[a]), np.cumsum(both.size_b[b])
    total = int(end_a[-1]) if len(a) else 0
    ends = np.zeros(total + 1, dtype=np.uint8)
    ends[end_a] = 1
    ends[end_b] |= 2
    cut = np.flatnonzero(ends)
    is_a, is_b = ends[cut] & 1, ends[cut] >> 1
    link_a, link_b = np.cumsum(is_a, dtype=np.int64) - is_a, np.cumsum(is_b, dtype=np.int64) - is_b
    return Aligned(a, b, row_a, row_b, link_a, link_b, row_a[link_a], np.flatnonzero(is_a & is_b))


def digests(x: Aligned, both: Sides, rows: int) -> list[str]:
    """Of each row the digest of its groups."""
    last_a, last_b = x.link_a[x.closes], x.link_b[x.closes]
    # A group's tokens of side A stand behind all of side B of earlier groups, and its tokens of side B behind those.
    count_a, count_b = np.diff(last_a, prepend=-1), np.diff(last_b, prepend=-1)
    at_a = np.arange(len(x.a)) + np.repeat(np.cumsum(count_b) - count_b, count_a)
    at_b = np.arange(len(x.b)) + np.repeat(np.cumsum(count_a), count_b)
    closing_a, closing_b = np.zeros(len(x.a), dtype=np.int64), np.zeros(len(x.b), dtype=np.int64)
    closing_a[last_a] = closing_b[last_b] = 1
    code = np.empty(len(x.a) + len(x.b), dtype=np.int64)
    code[at_a] = x.a + closing_a * len(both.size_a)
    code[at_b] = 2 * len(both.size_a) + x.b + closing_b * len(both.size_b)
    sizes = np.bincount(x.row_a, minlength=rows) + np.bincount(x.row_b, minlength=rows)
    out, start = [], 0
    for n in sizes.tolist():
        text = b"".join(map(both.text.__getitem__, code[start : start + n].tolist()))
        out.append(hashlib.sha256(text[:-1]).hexdigest() if n else "")
        start += n
    return out


ENTRIES = "shard int, part int, keys binary, counts binary"


def pair_counts(encoded: DataFrame, path_of: Paths = paths) -> DataFrame:
    """First pass: distinct pairs of each task, and how often it met them, packed by shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, part = sides(*path_of()), TaskContext.get().partitionId()
        keys, counts = np.zeros(0, dtype=U), np.zeros(0, dtype=np.int64)
        fresh: list[np.ndarray] = []

        def add() -> None:
            nonlocal keys, counts
            new, n = np.unique(np.concatenate(fresh), return_counts=True)
            fresh.clear()
            keys, where = np.unique(np.concatenate([keys, new]), return_inverse=True)
            counts = np.bincount(where, np.concatenate([counts, n]), len(keys)).astype(np.int64)

        for whole in batches:
            for batch in slices(whole, "ids_a"):
                fresh.append(align(batch, both).keys(both))
                if sum(map(len, fresh)) >= GATHERED:
                    add()
                if len(keys) >= HELD:
                    yield from _by_shard(part, keys, counts)
                    keys, counts = keys[:0], counts[:0]
        if fresh:
            add()
        yield from _by_shard(part, keys, counts)

    return encoded.select("ids_a", "ids_b").mapInArrow(run, ENTRIES)


def _by_shard(part: int, keys: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    shard = shard_of(keys)
    order = np.argsort(shard, kind="stable")
    shard, keys, counts = shard[order], keys[order], counts[order]
    head = np.flatnonzero(np.diff(shard, prepend=-1))
    ends = np.append(head[1:], len(keys))
    if len(head):
        packed = [pa.array([v[i:j].tobytes() for i, j in zip(head, ends, strict=True)], pa.binary()) for v in (keys, counts)]
        yield pa.RecordBatch.from_arrays([pa.array(shard[head], pa.int32()), pa.array(np.full(len(head), part), pa.int32()), *packed], names=["shard", "part", "keys", "counts"])


def _rows(shard: int, *values: bytes, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), *(pa.array([v], pa.binary()) for v in values)], names=names)


def hashes(entries: DataFrame) -> DataFrame:
    """shard, sizes, bits, keys: the perfect hash of each shard's distinct keys, and these in the order of their slots."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        waiting: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            for shard, keys in zip(batch.column("shard").to_pylist(), batch.column("keys"), strict=True):
                mine = waiting.setdefault(shard, [])
                mine.append(np.frombuffer(keys.as_py(), dtype=U))
                if sum(map(len, mine)) > max(10_000, 2 * len(held.get(shard, ()))):
                    held[shard], waiting[shard] = np.unique(np.concatenate([held.get(shard, mine[0][:0]), *mine])), []
        for shard, mine in waiting.items():
            keys = np.unique(np.concatenate([held.get(shard, np.zeros(0, dtype=U)), *mine]))
            yield _hashed(shard, keys)[0]

    partitions = int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return entries.select("shard", "keys").repartition(partitions, "shard").mapInArrow(run, "shard int, sizes binary, bits binary, keys binary")


def _hashed(shard: int, keys: np.ndarray) -> tuple[pa.RecordBatch, np.ndarray]:
    levels = Levels.build(keys)
    slots = PerfectHash({shard: levels}).slots(keys)
    in_order = np.empty_like(keys)
    in_order[slots] = keys
    return _rows(shard, *levels.dump(), in_order.tobytes(), names=["shard", "sizes", "bits", "keys"]), slots


TABLE = "shard int, sizes binary, bits binary, keys binary, counts binary"


def _none(name: str) -> Column:
    return F.lit(None).cast("binary").alias(name)


def count_vectors(entries: DataFrame, hashed: DataFrame) -> DataFrame:
    """Of each shard its hash, keys and the summed vector of counts, indexed by the hash."""
    spark = entries.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    most = entries.agg(F.max("part")).first()[0]
    fan = math.isqrt(most or 0) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows by shard and group; of each group the hash comes first."""
        now, keys, vector, found = None, None, None, None
        for batch in batches:
            columns = (batch.column(c) for c in ("shard", "part", "sizes", "bits", "keys", "counts"))
            for shard, part, sizes, bits, own, counts in zip(*(c.to_pylist() for c in columns), strict=True):
                if now != (shard, part):
                    if vector is not None and vector.any():
                        yield _rows(now[0], vector.tobytes(), names=["shard", "counts"])
                    now, vector = (shard, part), None
                if sizes is not None:
                    found, keys = PerfectHash({shard: Levels.load(sizes, bits)}), np.frombuffer(own, dtype=U)
                    vector = np.zeros(len(keys), dtype=np.int64)
                    continue
                mine = np.frombuffer(own, dtype=U)
                at = found.slots(mine)
                if np.any(keys[at] != mine):
                    raise ValueError("a pair that has no slot")
                vector[at] += np.frombuffer(counts, dtype=np.int64)  # keys of an entry are distinct
        if vector is not None and vector.any():
            yield _rows(now[0], vector.tobytes(), names=["shard", "counts"])

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: dict[int, tuple[bytes, ...]] = {}
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            columns = (batch.column(c) for c in ("shard", "sizes", "bits", "keys", "counts"))
            for shard, sizes, bits, keys, counts in zip(*(c.to_pylist() for c in columns), strict=True):
                if sizes is not None:
                    own[shard] = (sizes, bits, keys)
                else:
                    sums[shard] = sums.get(shard, 0) + np.frombuffer(counts, dtype=np.int64)
        for shard, x in own.items():
            yield _rows(shard, *x, sums[shard].tobytes(), names=["shard", "sizes", "bits", "keys", "counts"])

    group = F.explode(F.sequence(F.lit(0), F.lit(fan - 1)))
    heads = hashed.select("shard", group.alias("part"), "sizes", "bits", "keys", _none("counts"))
    both = heads.unionByName(entries.select("shard", F.pmod("part", F.lit(fan)).alias("part"), _none("sizes"), _none("bits"), "keys", "counts"))
    dealt = both.repartition(partitions, "shard", "part").sortWithinPartitions("shard", "part", F.col("sizes").isNull())
    vectors = dealt.mapInArrow(run, "shard int, counts binary").select("shard", *[_none(c) for c in ("sizes", "bits", "keys")], "counts")
    return vectors.unionByName(hashed.withColumn("counts", _none("counts"))).repartition(partitions, "shard").mapInArrow(total, TABLE)


@dataclass
class Found:
    """What a worker looks pairs up in."""

    hash: PerfectHash
    keys: np.ndarray
    counts: np.ndarray
    best: np.ndarray  # of each id of side B the highest count of its pairs
    whole: bool  # whether all pairs are here

    def look_up(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Counts, and whether they are known here."""
        if not len(self.keys):
            return np.zeros(len(keys), dtype=np.int64), np.zeros(len(keys), dtype=bool)
        at = self.hash.slots(keys)
        known = (at >= 0) & (self.keys[at] == keys)
        if self.whole and not known.all():
            raise ValueError("a pair that the first pass didn't meet")
        return np.where(known, self.counts[at], 0), known


def highest(counted: DataFrame, ids_b: int) -> np.ndarray:
    """Of each id of side B the highest count of its pairs: a vector of the vocabulary's size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = np.zeros(ids_b, dtype=np.int64)
        for batch in batches:
            for keys, counts in zip(batch.column("keys").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                np.maximum.at(best, (np.frombuffer(keys, dtype=U) % U(ids_b)).astype(np.int64), np.frombuffer(counts, dtype=np.int64))
        b = np.flatnonzero(best)
        yield pa.RecordBatch.from_arrays([pa.array(b, pa.int32()), pa.array(best[b])], names=["b", "best"])

    out = np.zeros(ids_b, dtype=np.int64)
    for r in counted.select("keys", "counts").mapInArrow(run, "b int, best long").groupBy("b").agg(F.max("best").alias("best")).collect():
        out[r.b] = r.best
    return out


def frequent(counted: DataFrame, pairs: int) -> tuple[DataFrame, int]:
    """The table of the most frequent pairs, at most `pairs`, with a hash of their own, and the least count it takes."""

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = np.zeros(64, dtype=np.int64)
        for batch in batches:
            for counts in batch.column("counts").to_pylist():
                bins += np.bincount(np.log2(np.frombuffer(counts, dtype=np.int64)).astype(np.int64), minlength=64)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(64), pa.int32()), pa.array(bins)], names=["bin", "n"])

    bins = np.zeros(64, dtype=np.int64)
    for r in counted.select("counts").mapInArrow(sizes, "bin int, n long").groupBy("bin").agg(F.sum("n").alias("n")).collect():
        bins[r.bin] = r.n
    above = np.cumsum(bins[::-1])[::-1]
    fit = np.flatnonzero(above <= pairs)
    least = 1 << int(fit[0]) if len(fit) else 1 << 62

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, keys, counts in zip(*(batch.column(c).to_pylist() for c in ("shard", "keys", "counts")), strict=True):
                n = np.frombuffer(counts, dtype=np.int64)
                keep = n >= least
                if keep.any():
                    row, slots = _hashed(shard, np.frombuffer(keys, dtype=U)[keep])
                    vector = np.empty(len(slots), dtype=np.int64)
                    vector[slots] = n[keep]
                    yield pa.RecordBatch.from_arrays([*row.columns, pa.array([vector.tobytes()], pa.binary())], names=[*row.schema.names, "counts"])

    return counted.mapInArrow(run, TABLE), least


def others(counted: DataFrame, least: int, best: np.ndarray) -> DataFrame:
    """key, count and whether it is its id's highest, of the pairs below `least`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, counts in zip(batch.column("keys").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                n, k = np.frombuffer(counts, dtype=np.int64), np.frombuffer(keys, dtype=U)
                k, n = k[n < least], n[n < least]
                top = n == best[(k % U(len(best))).astype(np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(k.astype(np.int64)), pa.array(n), pa.array(top)], names=["key", "count", "top"])

    return counted.select("keys", "counts").mapInArrow(run, "key long, count long, top boolean")


RESULT = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


def look_up(encoded: DataFrame, found: Found, path_of: Paths = paths) -> DataFrame:
    """Second pass: each document's figures, and `rest`, the pairs that aren't found here, with how often they stand."""
    shared = encoded.sparkSession.sparkContext.broadcast(found)
    schema = encoded.select("doc_id").schema.add("row", "long")
    for c in RESULT:
        schema = schema.add(c, "long")
    schema = schema.add("groups_sha256", "string").add("rest", T.ArrayType(T.StructType().add("key", "long").add("times", "long")))
    kind = pa.list_(pa.struct([("key", pa.int64()), ("times", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, known = sides(*path_of()), shared.value
        next_row = TaskContext.get().partitionId() << 40
        for whole in batches:
            for batch in slices(whole, "ids_a"):
                rows = batch.num_rows
                x = align(batch, both)
                keys = x.keys(both)
                counts, here = known.look_up(keys)
                top = here & (counts == known.best[x.b[x.link_b]])
                per = lambda at, weights=None: np.bincount(at, weights, rows)
                sums = np.zeros(rows, dtype=np.int64)
                np.add.at(sums, x.row, counts)
                figures = [per(x.row_a), per(x.row_b), per(x.row[x.closes]), per(x.row), per(x.row[top]), sums]
                rest: list[list[dict[str, int]]] = [[] for _ in range(rows)]
                away = np.flatnonzero(~here)
                if len(away):
                    order = away[np.lexsort((keys[away], x.row[away]))]
                    head = np.flatnonzero(np.r_[True, (keys[order][1:] != keys[order][:-1]) | (x.row[order][1:] != x.row[order][:-1])])
                    for at, times in zip(order[head].tolist(), np.diff(np.append(head, len(order))).tolist(), strict=True):
                        rest[x.row[at]].append({"key": int(keys[at]), "times": times})
                row = np.arange(next_row, next_row + rows)
                next_row += rows
                made = [batch.column("doc_id"), pa.array(row), *(pa.array(f.astype(np.int64)) for f in figures), pa.array(digests(x, both, rows)), pa.array(rest, kind)]
                yield pa.RecordBatch.from_arrays(made, names=["doc_id", "row", *RESULT, "groups_sha256", "rest"])

    return encoded.mapInArrow(run, schema)


def pair_table(encoded: DataFrame, path_of: Paths = paths) -> DataFrame:
    """Of each shard its hash, keys (id of side A * size of vocabulary B + id of side B) and counts, stored."""
    entries = durable(pair_counts(encoded, path_of))
    return durable(count_vectors(entries, durable(hashes(entries))))


def alignment(docs: DataFrame, path_of: Paths = paths, pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256: one row per row of docs."""
    encoded = durable(encode(docs, path_of))
    counted = pair_table(encoded, path_of)
    best = highest(counted, len(sides(*path_of()).size_b))
    n = counted.agg(F.sum(F.octet_length("keys"))).first()[0] or 0
    whole, least = n // 8 <= pairs, 0
    used = counted
    if not whole:
        used, least = frequent(counted, pairs)
    rows = sorted(used.collect(), key=lambda r: r.shard)
    join = lambda c, kind: np.concatenate([np.zeros(0, dtype=kind), *(np.frombuffer(r[c], dtype=kind) for r in rows)])
    found = Found(PerfectHash({r.shard: Levels.load(r.sizes, r.bits) for r in rows}), join("keys", U), join("counts", np.int64), best, whole)
    out = look_up(encoded, found, path_of)
    result = ["doc_id", *RESULT, "groups_sha256"]
    if whole:
        return out.select(result)
    out = durable(out)
    rest = out.select("row", F.explode("rest").alias("r")).select("row", "r.key", "r.times").join(others(counted, least, best), "key")
    sums = rest.groupBy("row").agg(F.sum(F.col("times") * F.col("count")).alias("more_sum"), F.sum(F.when(F.col("top"), F.col("times")).otherwise(0)).alias("more_best"))
    more = lambda c, m: (F.col(c) + F.coalesce(m, F.lit(0))).alias(c)
    return out.join(sums, "row", "left").withColumns({"n_best": more("n_best", "more_best"), "count_sum": more("count_sum", "more_sum")}).select(result)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment(table(spark, sf_dir, "documents"))
