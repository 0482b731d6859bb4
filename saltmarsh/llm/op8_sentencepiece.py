"""SentencePiece encoding and decoding over a relational lattice.

A text is the library's normal form (spaces are marks, one stands before the text) cut into units,
wherever no piece holds the two neighbouring characters side by side: before marks, at line breaks,
mostly between letters and punctuation. No merge reaches over such a place. Distinct units are encoded
once for the whole corpus, as relations: every substring of at most the longest piece's length is
exploded and equi-joined to the piece table, which gives the lattice's edges; edges are grouped by
unit, one long each; and a higher-order `aggregate` folds them into a path. For unigram vocabularies
the fold is Viterbi. For byte-pair vocabularies, whose result is not the path of the largest score, the
edges are folded in order of score, then place: one joins what it spans if that is two neighbours just
then. Taking each edge once is merging exactly, if every piece comes out whole when it is encoded so on
its own (as long as no merge crosses a span's ends, the span merges as it does alone); that is proven
for the whole vocabulary when it is loaded, and units that hold a piece for which it fails (a run of
16 marks) don't take this way. Characters without a piece become byte pieces. Ids equal the library's.

Texts don't pass through that shuffle word by word. Tasks cut their rows into chunks; a chunk
sends its distinct units, gets their ids back, and meets them once with its texts (packed and
compressed). A unit of more than `MAX_UNIT` characters, one with a piece that isn't proven, or one missing
from a chunk's answer is merged where it is met, by the same rule, so a chunk cut otherwise on a second
reading changes nothing but time.

Decoding joins ids to the bytes of their pieces and puts them together in order: `decode` as relations,
`encode` for the texts it has met, document by document, from their ids alone.

Defined results: null and empty texts have no pieces. Nulls and repeats of doc_id are kept row by
row; doc_id is a long. Extra columns don't pass. An empty table gives no rows. Undecodable bytes become
U+FFFD. A text takes time in proportion to its length; one text has to fit a task.
"""

from __future__ import annotations

import heapq
import itertools
import zlib
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, replace
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from saltmarsh.llm import textarrays as ta
from saltmarsh.llm.common import durable, slices, table

MARK = "▁"
MAX_UNIT = 48
#: Code points below this one have their ids in a literal (ASCII to Latin Extended-B).
COMMON = 0x250
#: Neighbouring tasks share chunks: fewer chunks ask for the same unit.
TASKS_PER_CHUNK, CHUNK_BYTES = 2, 32_000_000
#: Compressed rows of a chunk's texts.
BLOB_BYTES = 2_000_000
#: Text bytes that meet the units of their chunk at a time.
MEET_BYTES = 1_000_000
#: Text bytes aimed at per task of the lattice.
TASK_BYTES = 8_000_000
#: Pieces that `runs` puts together at a time: the indices of what is in them take eight bytes each.
BLOCK = 1 << 16
_BUNDLE = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@dataclass(frozen=True)
class Model:
    """A vocabulary: pieces with their ids and scores, and the id of each byte."""

    pieces: dict[str, tuple[int, float]]
    first_byte: int
    longest: int
    unigram: bool = False
    unproven: tuple[str, ...] = ()


@lru_cache(maxsize=2)
def load(path: str, unigram: bool = False) -> Model:
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = [i for i in range(sp.vocab_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) or sp.is_byte(i))]
    pieces = {sp.id_to_piece(i): (i, sp.get_score(i)) for i in plain}
    crossing = [p for p in pieces if MARK in p.lstrip(MARK) or "\n" in p]
    if crossing:
        raise ValueError(f"pieces reach over the start of a unit: {crossing[:3]}")
    first = next((i for i in range(sp.vocab_size()) if sp.is_byte(i)), -1)
    model = Model(pieces, first, max(map(len, pieces)), unigram)
    unproven = () if unigram else tuple(p for p in pieces if not one_pass_keeps(p, model))
    if bad := [p for p in unproven if p.strip(MARK)]:
        raise ValueError(f"pieces that taking edges once doesn't give whole: {bad[:3]}")
    return replace(model, unproven=unproven)


def one_pass_keeps(piece: str, model: Model) -> bool:
    """Whether taking each edge over the piece once, in order, ends in the piece itself, as merging does."""
    n = len(piece)
    edges = sorted((-found[1], s, e) for s in range(n) for e in range(s + 2, n + 1) if (found := model.pieces.get(piece[s:e])))
    bounds = set(range(n + 1))
    for _, s, e in edges:
        between = bounds.intersection(range(s + 1, e))
        if s in bounds and e in bounds and len(between) == 1:
            bounds -= between
    return bounds == {0, n} and merge_unit(piece, model) == [model.pieces[piece][0]]


@lru_cache(maxsize=2)
def bridges(path: str) -> np.ndarray:
    """256 x 256: whether a unit may go on from one byte to the next. A space stands for the mark.

    Beside characters of several bytes units go on, but for marks and line breaks, which no piece has inside.
    """
    side_by_side = {(a, b) for p in load(path).pieces for a, b in itertools.pairwise(p.replace(MARK, " "))}
    out = np.ones((256, 256), dtype=bool)
    for a in range(128):
        for b in range(128):
            out[a, b] = (chr(a), chr(b)) in side_by_side
    out[128:, [10, 32]] = False
    out[10, 128:] = False
    return out


def cut_units(texts: pa.Array, path: str) -> tuple[pa.Array, np.ndarray]:
    """The units of all texts one after the other, with spaces for marks, and how many each text has."""
    marked = pa.compute.replace_substring(pa.compute.fill_null(texts, "").cast(pa.large_string()), MARK, " ")
    empty = pa.compute.equal(pa.compute.binary_length(marked), 0)
    raw, offsets = ta.utf8(pa.compute.if_else(empty, marked, pa.compute.binary_join_element_wise(pa.scalar(" ", pa.large_string()), marked, pa.scalar("", pa.large_string()))))
    if not len(raw):
        return pa.array([], pa.large_string()), np.zeros(len(texts), dtype=np.int64)
    start = np.empty(len(raw), dtype=bool)
    start[1:] = ~bridges(path)[raw[:-1], raw[1:]]
    start[offsets[:-1][np.diff(offsets) > 0]] = True
    at = np.flatnonzero(start)
    units = pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(np.append(at, len(raw)).astype(np.int64, copy=False)), pa.py_buffer(np.ascontiguousarray(raw)))
    return units, np.diff(np.searchsorted(at, offsets))


def merge_unit(unit: str, model: Model) -> list[int]:
    """Byte-pair merging of one unit: the rule of the relational fold, for units it isn't used for."""
    parts: list[str | None] = list(unit)
    left, right = list(range(-1, len(parts) - 1)), [*range(1, len(parts)), -1]
    heap: list[tuple[float, int, str]] = []

    def offer(a: int, b: int) -> None:
        if a >= 0 and b >= 0 and (found := model.pieces.get(both := parts[a] + parts[b])):
            heapq.heappush(heap, (-found[1], a, both))

    for k in range(1, len(parts)):
        offer(k - 1, k)
    while heap:
        _, a, both = heapq.heappop(heap)
        b = right[a]
        if parts[a] is None or b < 0 or parts[a] + parts[b] != both:
            continue
        parts[a], parts[b], right[a] = both, None, right[b]
        if right[b] >= 0:
            left[right[b]] = a
        offer(left[a], a)
        offer(a, right[a])
    out: list[int] = []
    for p in parts:
        if p is not None:
            out += [model.pieces[p][0]] if p in model.pieces else [model.first_byte + x for x in p.encode()]
    return out


def piece_table(spark: SparkSession, model: Model) -> DataFrame:
    """(piece, id, rank, score): one row per piece, so its size is the vocabulary's. Ranks number the scores, largest first."""
    ranks = {s: k for k, s in enumerate(sorted({s for _, s in model.pieces.values()}, reverse=True))}
    return spark.createDataFrame([(p, i, ranks[s], float(s)) for p, (i, s) in model.pieces.items()], "piece string, id int, rank int, score double")


def _bytes_of(char: Column, first: int) -> Column:
    code = F.hex(F.encode(char, "utf-8"))
    return F.transform(F.sequence(F.lit(1), F.length(code), F.lit(2)), lambda k: F.conv(F.substring(code, k, F.lit(2)), 16, 10).cast("int") + first)


def _shifted(bits: Column, by: Column) -> Column:
    return F.call_function("shiftleft", bits, by)


def _fold_merges(n: Column, edges: Column) -> Column:
    """The bits of the boundaries left when every edge was taken once; edges in order, as struct(.., ends, inner)."""
    start = _shifted(F.lit(1).cast("long"), n + 1) - 1

    def step(b: Column, e: Column) -> Column:
        joins = (b.bitwiseAND(e["ends"]) == e["ends"]) & (F.bit_count(b.bitwiseAND(e["inner"])) == 1)
        return F.when(joins, b.bitwiseAND(F.bitwise_not(e["inner"]))).otherwise(b)

    return F.aggregate(edges, start, step)


#: Bits of an edge in one long: rank, start, size and id of a piece; so edges in order are numbers in order.
_ID, _SIZE, _START = 20, 6, 6


def _opened(edge: Column) -> Column:
    """struct(s, size, id, ends, inner) of a packed edge."""
    one = F.lit(1).cast("long")
    s = F.call_function("shiftright", edge, F.lit(_ID + _SIZE)).bitwiseAND(F.lit((1 << _START) - 1)).cast("int")
    size = F.call_function("shiftright", edge, F.lit(_ID)).bitwiseAND(F.lit((1 << _SIZE) - 1)).cast("int")
    end = _shifted(one, s + size)
    return F.struct(s.alias("s"), size.alias("size"), edge.bitwiseAND(F.lit((1 << _ID) - 1)).cast("int").alias("id"), _shifted(one, s).bitwiseOR(end).alias("ends"), (end - _shifted(one, s + 1)).alias("inner"))


def _fold_viterbi(n: Column, edges: Column, unknown: float) -> Column:
    """The bits of the boundaries of the path of the largest sum of scores; of equal ones the longest last edge.

    The state holds, for each end so far, the best sum and the bits of its path. A character without
    a piece is an edge of score `unknown`, so each end is reached.
    """

    def step(state: Column, end: Column) -> Column:
        here = F.filter(edges, lambda e: e["s"] + e["size"] == end)
        ways = F.transform(
            here,
            lambda e: F.struct(
                (F.element_at(state, e["s"] + 1)["sum"] + F.coalesce(e["score"], F.lit(unknown))).alias("sum"),
                e["size"].alias("size"),
                F.element_at(state, e["s"] + 1)["bits"].bitwiseOR(e["ends"]).alias("bits"),
            ),
        )
        return F.concat(state, F.array(F.array_max(ways)))

    start = F.array(F.struct(F.lit(0.0).alias("sum"), F.lit(0).alias("size"), F.lit(1).cast("long").alias("bits")))
    return F.element_at(F.aggregate(F.sequence(F.lit(1), n), start, step), -1)["bits"]


def encode_units(distinct: DataFrame, pieces: DataFrame, model: Model, unit: str = "unit") -> DataFrame:
    """distinct units (and other columns) with `ids`. distinct must hold each unit once.

    If distinct is hash-partitioned by unit (as a groupBy leaves it), nothing here shuffles. Single
    characters up to `COMMON` don't go through the join: their ids are a literal of fixed size. Each
    unit's first character does, so that units without longer edges stay.
    """
    others = [c for c in distinct.columns if c != unit]
    n, s, size = F.length(unit), F.col("s"), F.col("size")
    common = 0 if model.unigram else COMMON
    char = lambda at: F.substring(F.col(unit), at + 1, F.lit(1))
    starts = distinct.where(F.length(unit).between(1, MAX_UNIT)).select(unit, *others, F.explode(F.sequence(F.lit(0), n - 1)).alias("s"))
    least = F.when((s > 0) & (F.ascii(char(s)) < common), F.lit(2)).otherwise(F.lit(1))
    most = F.least(F.lit(model.longest), n - s)
    spans = starts.where(least <= most).select(unit, *others, "s", F.explode(F.sequence(least, most)).alias("size"))
    joined = spans.withColumn("piece", F.substring(F.col(unit), s + 1, size)).join(F.broadcast(pieces), "piece", "left").where("id is not null or size = 1")
    first = [F.first(c).alias(c) for c in others]
    if model.unigram:
        one = F.lit(1).cast("long")
        ends, inner = _shifted(one, s).bitwiseOR(_shifted(one, s + size)), _shifted(one, s + size) - _shifted(one, s + 1)
        edge = F.struct("s", "size", "id", ends.alias("ends"), inner.alias("inner"), "score")
        grouped = joined.groupBy(unit).agg(*first, F.collect_list(edge).alias("_edges"))
        bits = _fold_viterbi(n, F.col("_edges"), min(x for _, x in model.pieces.values()) - 10)
    else:
        long = lambda c, by: _shifted(F.col(c).cast("long"), F.lit(by))
        edge = long("rank", _ID + _SIZE + _START).bitwiseOR(long("s", _ID + _SIZE)).bitwiseOR(long("size", _ID)).bitwiseOR(F.col("id").cast("long"))
        packed = joined.groupBy(unit).agg(*first, F.collect_list(edge).alias("_packed"))
        grouped = packed.select(unit, *others, F.transform(F.array_sort("_packed"), _opened).alias("_edges"))
        bits = _fold_merges(n, F.col("_edges"))
    b, edges = F.col("_bits"), F.col("_edges")
    literal = F.array(*[F.array(*[F.lit(i) for i in merge_unit(chr(c), model)]) for c in range(common)]) if common else F.array(F.array(F.lit(0)))

    def rare_char(at: Column) -> Column:
        found = F.get(F.filter(edges, lambda e: (e["s"] == at) & (e["size"] == 1)), F.lit(0))["id"]
        return F.when(found.isNotNull(), F.array(found)).otherwise(_bytes_of(char(at), model.first_byte))

    def ids_of_char(at: Column) -> Column:
        code = F.ascii(char(at))
        return F.when(code < common, F.element_at(literal, code + 1)).otherwise(rare_char(at))

    long = F.filter(edges, lambda e: (e["size"] > 1) & (b.bitwiseAND(e["ends"]) == e["ends"]) & (b.bitwiseAND(e["inner"]) == 0))
    alone = F.filter(F.sequence(F.lit(0), n - 1), lambda at: F.call_function("shiftright", b, at).bitwiseAND(F.lit(3)) == 3)
    path = F.concat(F.transform(long, lambda e: F.struct(e["s"].alias("s"), F.array(e["id"]).alias("i"))), F.transform(alone, lambda at: F.struct(at.alias("s"), ids_of_char(at).alias("i"))))
    ids = F.flatten(F.transform(F.array_sort(path), lambda x: x["i"]))
    return grouped.withColumn("_bits", bits).select(unit, *others, ids.alias("ids"))


def _chunks(batches: Iterator[pa.RecordBatch], chunk_bytes: int) -> Iterator[tuple[int, bool, pa.RecordBatch]]:
    """Runs of a task's rows with their chunk's number and whether the task's part of it ends there."""
    number, held = TaskContext.get().partitionId() // TASKS_PER_CHUNK << 20, 0
    last: pa.RecordBatch | None = None
    for whole in batches:
        for batch in slices(whole, "text", BLOB_BYTES):
            if last is not None:
                ends = held >= chunk_bytes
                yield number, ends, last
                number, held = (number + 1, 0) if ends else (number, held)
            last = batch
            held += batch.column("text").nbytes
    if last is not None:
        yield number, True, last


@lru_cache(maxsize=2)
def piece_bytes(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all pieces by id, one after the other (spaces for marks), and where those of each id start and how many they are."""
    model = load(path)
    codes = {i: p.replace(MARK, " ").encode() for p, (i, _) in model.pieces.items()}
    codes |= {model.first_byte + b: bytes([b]) for b in range(256)} if model.first_byte >= 0 else {}
    size = np.zeros(max(codes) + 1, dtype=np.int64)
    for i, c in codes.items():
        size[i] = len(c)
    return np.frombuffer(b"".join(codes.get(i, b"") for i in range(len(size))), dtype=np.uint8), np.cumsum(size) - size, size


def runs(values: np.ndarray, start: np.ndarray, size: np.ndarray, of: np.ndarray) -> np.ndarray:
    """values[start:start + size] of each of the places `of`, one after the other."""
    out, done = np.empty(int(size[of].sum()), dtype=values.dtype), 0
    for k in range(0, len(of), BLOCK):
        part = of[k : k + BLOCK]
        n = size[part]
        first = np.cumsum(n) - n
        m = int(n.sum())
        out[done : done + m] = values[np.repeat(start[part] - first, n) + np.arange(m)]
        done += m
    return out


def decode_ids(ids: np.ndarray, edges: np.ndarray, path: str) -> list[bytes]:
    """The texts of runs of ids, cut at edges: the bytes of their pieces, without the mark that stands before a text."""
    data, start, size = piece_bytes(path)
    text = runs(data, start, size, ids)
    at = np.concatenate([[0], np.cumsum(size[ids])])[edges]
    return [text[a + (a < z and text[a] == 32) : z].tobytes() for a, z in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]


def meet(left: pa.Table, right: pa.Table, path: str, with_ids: bool = True) -> pa.Table:
    """The rows of `encode` for a chunk: its texts (size, blob) and its units with their ids.

    A worker holds little more than what it is given: the units are looked up in those of some texts, not
    the other way round, so hash tables and arrays are of the size of `MEET_BYTES` and `BLOCK`.
    """
    model = load(path)
    known = pa.chunked_array(right.column("unit").chunks, pa.string())
    lists = right.column("ids").chunks
    codes = np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in lists] or [np.zeros(0, np.int32)])
    sizes = np.concatenate([pa.compute.list_value_length(c).to_numpy(zero_copy_only=False) for c in lists] or [np.zeros(0, np.int32)])
    first = np.cumsum(sizes, dtype=np.int64) - sizes
    codec, out = pa.Codec("zstd"), []
    for size, blob in zip(left.column("size").to_pylist(), left.column("blob"), strict=True):
        whole = pa.ipc.read_record_batch(codec.decompress(blob.as_buffer(), size), _BUNDLE)
        for batch in slices(whole, "text", MEET_BYTES):
            met, per_text = cut_units(batch.column("text"), path)
            coded = met.dictionary_encode()
            units = pa.compute.replace_substring(coded.dictionary, " ", MARK).cast(pa.string())
            which = pa.compute.fill_null(pa.compute.index_in(known, value_set=units), -1).to_numpy()
            found = np.flatnonzero(which >= 0)
            place = np.full(len(units), -1, dtype=np.int64)
            place[which[found]] = found
            if len(new := np.flatnonzero(place < 0)):
                added = units.take(pa.array(new))
                merged = [merge_unit(u, model) for u in added.to_pylist()]
                place[new] = len(sizes) + np.arange(len(new))
                known = pa.chunked_array([*known.chunks, added], pa.string())
                codes = np.concatenate([codes, np.array([i for m in merged for i in m], dtype=codes.dtype)])
                sizes = np.concatenate([sizes, np.array([len(m) for m in merged], dtype=np.int32)])
                first = np.cumsum(sizes, dtype=np.int64) - sizes
            at = place[coded.indices.to_numpy()]
            flat = runs(codes, first, sizes, at).astype("<u4")
            edge = np.concatenate([[0], np.cumsum(sizes[at], dtype=np.int64)])[np.concatenate([[0], np.cumsum(per_text)])]
            ids = [flat[a:z].tobytes() for a, z in itertools.pairwise(edge.tolist())]
            texts = decode_ids(flat, edge, path)
            same = [t == d.decode("utf-8", "replace") for t, d in zip(pa.compute.replace_substring(batch.column("text"), MARK, " ").to_pylist(), texts, strict=True)]
            doc_id = pa.array(batch.column("doc_id").to_pylist(), pa.int64())  # a slice would keep the texts beside it
            columns = {"doc_id": doc_id, "n_pieces": pa.array(np.diff(edge)), "ids_crc32": pa.array([zlib.crc32(x) for x in ids], pa.int64())}
            columns |= {"decoded_bytes": pa.array([len(t) for t in texts], pa.int64()), "decoded_crc32": pa.array([zlib.crc32(t) for t in texts], pa.int64()), "round_trip": pa.array(same)}
            out.append(pa.table(columns | {"ids": pa.array(ids if with_ids else [None] * len(ids), pa.binary())}))
            pa.default_memory_pool().release_unused()
    return pa.concat_tables(out)


@contextmanager
def roomy(spark: SparkSession) -> Iterator[None]:
    """While `encode` runs, grouping holds up to a million keys before it sorts, as a task has fewer units, and batches
    for Python hold some MB whatever their rows are; afterwards the session is as it was."""
    wanted = {"spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "1000000", "spark.sql.execution.arrow.maxBytesPerBatch": "4m"}
    before = {name: spark.conf.get(name) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def encode(docs: DataFrame, path_of: Callable[[], str] = model_path, chunk_bytes: int = CHUNK_BYTES, with_ids: bool = True) -> DataFrame:
    """doc_id, n_pieces, ids_crc32, decoded_bytes and decoded_crc32 (of the UTF-8 that the ids decode to), round_trip
    (whether that is the text; a mark in a text is a space), and ids (packed little-endian, four bytes each) or NULL.

    It is quicker where its result is written or counted inside `roomy`."""
    spark = docs.sparkSession
    model = load(path_of())
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    total = source.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tasks, meetings = max(width, -(-total // TASK_BYTES)), max(width, -(-4 * total // chunk_bytes))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, met = path_of(), []
        for number, ends, batch in _chunks(batches, chunk_bytes):
            met.append(cut_units(batch.column("text"), path)[0].unique())
            if ends or len(met) > 4:
                met = [pa.concat_arrays(met).unique()]
                pa.default_memory_pool().release_unused()
            if ends:
                units = pa.compute.replace_substring(met[0], " ", MARK)
                short = pa.compute.less_equal(pa.compute.utf8_length(units), MAX_UNIT)
                for p in model.unproven:
                    short = pa.compute.and_(short, pa.compute.invert(pa.compute.match_substring(units, p)))
                units = units.filter(short)
                units = units.take(pa.compute.sort_indices(units)).cast(pa.string())  # in order they travel in less space
                for part in pa.table({"unit": units}).to_batches(50_000):
                    yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.full(part.num_rows, number, dtype=np.int64))], names=["unit", "chunk"])
                met, units, short = [], None, None
                pa.default_memory_pool().release_unused()

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd", compression_level=9)
        for number, _, batch in _chunks(batches, chunk_bytes):
            plain = [batch.column("doc_id").cast(pa.int64()), batch.column("text").cast(pa.string())]
            raw = pa.RecordBatch.from_arrays(plain, schema=_BUNDLE).serialize()
            packed = codec.compress(raw)
            yield pa.RecordBatch.from_arrays([pa.array([number]), pa.array([raw.size]), pa.array([packed.to_pybytes()], pa.binary())], names=["chunk", "size", "blob"])

    # Units are distinct within a task's part already, so they are dealt out before they are grouped.
    distinct = source.mapInArrow(cut, "unit string, chunk long").repartition(tasks, "unit").groupBy("unit").agg(F.collect_set("chunk").alias("chunks"))
    coded = encode_units(distinct, piece_table(spark, model), model)
    answers = coded.select(F.explode("chunks").alias("chunk"), "unit", F.col("ids").cast("array<smallint>" if max(i for i, _ in model.pieces.values()) < 32768 else "array<int>").alias("ids"))
    bundles = source.mapInArrow(bundle, "chunk long, size long, blob binary")

    def apply(left: pa.Table, right: pa.Table) -> pa.Table:
        return meet(left, right, path_of(), with_ids)

    schema = "doc_id long, n_pieces long, ids_crc32 long, decoded_bytes long, decoded_crc32 long, round_trip boolean, ids binary"
    # Both sides are dealt alike, into some more tasks than there are chunks, so a task's share stays as the input grows and few sort two chunks.
    left, right = (side.repartition(meetings, "chunk").groupBy("chunk") for side in (bundles, answers))
    return left.cogroup(right).applyInArrow(apply, schema)


def decode(rows: DataFrame, model: Model, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """key and text of rows (key, ids array); key must tell rows apart. Native throughout."""
    spark = rows.sparkSession
    of_piece = [(i, p.encode().hex().upper()) for p, (i, _) in model.pieces.items()]
    of_byte = [(model.first_byte + b, f"{b:02X}") for b in range(256)] if model.first_byte >= 0 else []
    codes = spark.createDataFrame([*of_piece, *of_byte], "id int, code string")
    spread = rows.select(key, F.posexplode(ids).alias("at", "id")).join(F.broadcast(codes), "id")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "code"))), lambda x: x["code"]), "")
    whole = spread.groupBy(key).agg(F.regexp_replace(F.translate(F.decode(F.unhex(text), "utf-8"), MARK, " "), "^ ", "").alias("text"))
    return rows.select(key).join(whole, key, "left").select(key, F.coalesce("text", F.lit("")).alias("text"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    with roomy(spark):
        return durable(encode(table(spark, sf_dir, "documents"), with_ids=False).drop("ids"))
