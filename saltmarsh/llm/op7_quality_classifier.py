"""A quality classifier on random-indexing word vectors.

Tokens are runs of letters, digits and non-ASCII bytes, or runs of one ASCII punctuation mark. Each
token has a fixed sparse index vector (a few +1 and -1, from its hash). A token's word vector is the
sum, over every occurrence in the whole corpus, of its own index vector and those of its neighbours
two to each side. Tokens share `BUCKETS` rows by hash, so the table of vectors has a fixed size (and
is broadcast), however many words a corpus has. A document is pooled to the mean of its tokens'
vectors, the mean cosine of neighbouring ones, and the share of neighbours that are equal; it is
scored by a two-layer network in numpy, whose probabilities are calibrated
by a temperature fitted on rows kept from its training.

The network is fitted on at most `max_rows` labelled rows (those with the smallest hash of doc_id);
word vectors and scores cover every row and every whole text.

Defined results: null and empty texts and texts without a token have zero vectors and get that
score. Labels that are null or not 0 or 1 are ignored, and of several for one document the lowest
counts. Without labels of both kinds every score is the share of label 1, or 0.5 without any.
Repeated rows get equal scores. Extra columns don't pass. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saltmarsh.llm import blocks
from saltmarsh.llm import textarrays as ta
from saltmarsh.llm.common import slices, table

BUCKETS, DIMS, BLOCKS = 1 << 15, 32, 64
FEATURES = DIMS + 2
NEIGHBOURS, SELF_WEIGHT = 2, 2
MAX_ROWS = 8_000
HIDDEN, EPOCHS, RATE, DECAY = 24, 60, 3e-3, 1e-4
THRESHOLD = 0.3

_KIND = np.ones(256, dtype=np.uint8)
_KIND[[9, 10, 11, 12, 13, 32]] = 0
for _c in range(33, 127):
    if not chr(_c).isalnum():
        _KIND[_c] = _c + 1
for _c in [*range(0, 9), *range(14, 32), 127]:
    _KIND[_c] = 2


def index_vectors() -> np.ndarray:
    """Four +1 or -1 per bucket, in places and signs drawn once with a fixed seed."""
    rng = np.random.default_rng(7)
    out = np.zeros((BUCKETS, DIMS), dtype=np.int8)
    for _ in range(4):
        out[np.arange(BUCKETS), rng.integers(0, DIMS, BUCKETS)] += (rng.integers(0, 2, BUCKETS) * 2 - 1).astype(np.int8)
    return out


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray, int]:
    """Bucket and row of each token, in order, and the number of rows."""
    raw, offsets = ta.utf8(column)
    rows = len(offsets) - 1
    if not len(raw):
        return np.zeros(0, dtype=np.uint16), np.zeros(0, dtype=np.int64), rows
    kind = _KIND[raw]
    edge = np.zeros(len(raw) + 1, dtype=bool)
    edge[offsets] = True
    edge[1:-1] |= kind[1:] != kind[:-1]
    start = np.flatnonzero(edge[:-1])
    size = np.diff(np.append(start, len(raw)))
    held = kind[start] != 0
    start, size = start[held], size[held]
    h = ta.hash_runs(raw, start, size)
    return (h >> np.uint64(49)).astype(np.uint16), np.searchsorted(offsets, start, side="right") - 1, rows


def word_vectors(docs: DataFrame, text: str = "text") -> np.ndarray:
    """BUCKETS x DIMS unit vectors (zero where no token fell), from all rows of docs."""
    index = index_vectors()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BUCKETS, DIMS), dtype=np.int64)
        for whole in batches:
            for batch in slices(whole, "_text"):
                bucket, row, _ = tokens(batch.column("_text"))
                if not len(bucket):
                    continue
                around = index[bucket].astype(np.int16) * SELF_WEIGHT
                for k in range(1, NEIGHBOURS + 1):
                    near = (row[k:] == row[:-k])[:, None] * np.int8(1)
                    around[k:] += index[bucket[:-k]] * near
                    around[:-k] += index[bucket[k:]] * near
                order = np.argsort(bucket, kind="stable")
                sorted_buckets = bucket[order]
                head = np.flatnonzero(np.r_[True, sorted_buckets[1:] != sorted_buckets[:-1]])
                total[sorted_buckets[head]] += np.add.reduceat(around[order], head, axis=0, dtype=np.int64)
        yield from blocks.emit(total, BLOCKS)

    partial = docs.select(F.col(text).alias("_text")).mapInArrow(count, blocks.PARTIAL)
    sums = blocks.gather(partial, BUCKETS, DIMS, BLOCKS).astype(np.float64)
    norm = np.linalg.norm(sums, axis=1, keepdims=True)
    return (sums / np.where(norm == 0, 1, norm)).astype(np.float32)


def pool(column: pa.Array, vectors: np.ndarray) -> np.ndarray:
    """Rows x features: the mean of the tokens' vectors, the mean cosine of neighbours, the share of equal ones."""
    bucket, row, rows = tokens(column)
    out = np.zeros((rows, FEATURES), dtype=np.float64)
    if len(bucket):
        head = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        v = vectors[bucket]
        out[row[head], :DIMS] = np.add.reduceat(v, head, axis=0, dtype=np.float64) / np.diff(np.append(head, len(row)))[:, None]
        inside = row[1:] == row[:-1]
        owner, pairs = row[1:][inside], np.maximum(np.bincount(row[1:][inside], minlength=rows), 1)
        out[:, DIMS] = np.bincount(owner, np.einsum("ij,ij->i", v[1:], v[:-1])[inside], rows) / pairs
        out[:, DIMS + 1] = np.bincount(owner, (bucket[1:] == bucket[:-1])[inside], rows) / pairs
    return out


@dataclass
class Network:
    """score = sigmoid((tanh(x' W1 + b1) W2 + b2) / temperature), x' being x in units of its spread."""

    mean: np.ndarray
    spread: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.spread @ self.w1 + self.b1) @ self.w2 + self.b2

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x) / self.temperature, -30, 30)))


def constant(share: float) -> Network:
    share = min(max(share, 1e-6), 1 - 1e-6)
    n = FEATURES
    return Network(np.zeros(n), np.ones(n), np.zeros((n, 1)), np.zeros(1), np.zeros(1), float(np.log(share / (1 - share))))


def fit(x: np.ndarray, y: np.ndarray, seed: int = 11) -> Network:
    """Adam on cross-entropy over four fifths of the rows; the rest sets the temperature."""
    if len(y) < 10 or len(np.unique(y)) < 2:
        return constant(float(np.mean(y)) if len(y) else 0.5)
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(y))
    x, y = x[order], y[order].astype(np.float64)
    cut = len(y) * 4 // 5
    spread = x[:cut].std(axis=0)
    net = Network(x[:cut].mean(axis=0), np.where(spread < 1e-9, 1.0, spread), rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 0.1, HIDDEN), 0.0)
    scaled = (x[:cut] - net.mean) / net.spread
    weights = [net.w1, net.b1, net.w2, np.zeros(1)]
    first, second, step = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
    for _ in range(EPOCHS):
        shuffled = rng.permutation(cut)
        for k in range(0, cut, 128):
            at = shuffled[k : k + 128]
            a = np.tanh(scaled[at] @ weights[0] + weights[1])
            p = 1 / (1 + np.exp(-np.clip(a @ weights[2] + weights[3], -30, 30)))
            out = (p - y[at]) / len(at)
            hidden = out[:, None] * weights[2] * (1 - a * a)
            slopes = [scaled[at].T @ hidden + DECAY * weights[0], hidden.sum(axis=0), a.T @ out + DECAY * weights[2], np.array([out.sum()])]
            step += 1
            for i, g in enumerate(slopes):
                first[i] += 0.1 * (g - first[i])
                second[i] += 0.001 * (g * g - second[i])
                weights[i] = weights[i] - RATE * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    net.w1, net.b1, net.w2, net.b2 = weights[0], weights[1], weights[2], float(weights[3][0])
    net.temperature = temperature(net.logit(x[cut:]), y[cut:])
    return net


def temperature(logit: np.ndarray, y: np.ndarray) -> float:
    """The temperature of least cross-entropy, by golden-section search on its logarithm."""
    loss = lambda t: float(np.mean(np.logaddexp(0, -(2 * y - 1) * logit / np.exp(t))))
    low, high, g = np.log(0.25), np.log(8.0), (np.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = high - g * (high - low), low + g * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, vectors: np.ndarray, max_rows: int = MAX_ROWS) -> Network:
    """Fit on labelled rows that aren't held out. The sample's ids are bounded by max_rows, so they are broadcast."""
    known = labels.where("doc_id is not null and quality in (0, 1)").where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.min("quality").cast("int").alias("_quality"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    rows = docs.select("doc_id", F.col("text").alias("_text")).join(F.broadcast(sample), "doc_id").select("doc_id", "_text", "_quality")
    shared = docs.sparkSession.sparkContext.broadcast(vectors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "_text"):
                x = pool(batch.column("_text"), shared.value).astype("<f4")
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("_quality"), pa.array([r.tobytes() for r in x], pa.binary())], names=["doc_id", "quality", "x"])

    # One row of a doc_id, so that repeats of it don't add to what reaches the driver: max_rows vectors at most.
    one = rows.mapInArrow(run, "doc_id long, quality int, x binary").groupBy("doc_id").agg(F.min("quality").alias("quality"), F.min("x").alias("x"))
    got = sorted((r.doc_id, bytes(r.x), r.quality) for r in one.toLocalIterator())
    x = np.array([np.frombuffer(r[1], dtype="<f4") for r in got], dtype=np.float64).reshape(len(got), FEATURES)
    return fit(x, np.array([r[2] for r in got], dtype=np.int64))


def score(docs: DataFrame, vectors: np.ndarray, net: Network, text: str = "text", name: str = "score") -> DataFrame:
    """docs with a column `name`, replacing one of that name."""
    docs = docs.drop(name)
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())])
    at = docs.columns.index(text)
    shared = docs.sparkSession.sparkContext.broadcast((vectors, net))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors, net = shared.value
        for whole in batches:
            for batch in slices(whole, text):
                got = pa.array(net.score(pool(batch.column(at), vectors)), pa.float64())
                yield pa.RecordBatch.from_arrays([*batch.columns, got], names=[*batch.schema.names, name])

    return docs.mapInArrow(run, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    vectors = word_vectors(docs)
    net = train(docs, labels, vectors)
    scored = score(docs.select("doc_id", "text"), vectors, net)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
