"""Hierarchical multi-length packing of tokenised documents.

Context sizes form tiers (256, 512, 1024 and 2048 tokens). A document longer than the largest tier
gives full windows of it; what is left of it, and each shorter document, is routed to the smallest
tier that holds it. Tiers are packed from the longest: a window opens with the longest piece of its
tier, and its gap is filled from pieces of shorter tiers, the longest that fits first; the last gap
is closed by cutting the shortest piece left. So every window of a group is full but the last, whose
tokens are laid into windows of power-of-two lengths. Windows of one tier are then dealt to step
groups of equal token counts, in snake order of their attention cost, so that steps cost about the same.

Packing is done in groups of documents chosen by a hash of doc_id and text, of about `group_bytes` text
bytes each; repeats of a row are spread by their place in their task, so that no key fills a group (docs
must come in the same order if a task is redone, as from files). Groups are independent, so work spreads over any number of tasks and a lost task is
redone with the same result (a group is sorted before it is packed).

Token ids equal the library's. Texts of common characters are cut with an equal pattern and their
pre-tokens merged once per worker; a text with other characters, or with a special token's string,
goes through the library whole.

Defined results: a null or empty text has the closing id only. Documents with a null doc_id are
packed like all others. Repeated rows are packed once each. Extra columns don't pass. An empty
table gives no pieces.
"""

from __future__ import annotations

import itertools
import json
import re
import zlib
from bisect import bisect_right, insort
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saltmarsh.llm.common import slices, table
from saltmarsh.llm.op2_token_counts import UNSAFE, byte_alphabet, library, tokenizer_path

TIERS = (256, 512, 1024, 2048)
CLOSING_ID = 1
GROUP_BYTES = 2_000_000
STEP_TOKENS = 16_384
#: Text bytes aimed at per packing task.
TASK_BYTES = 64_000_000
REMEMBERED = 600_000
_LETTER = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ſ"
PRETOKEN = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[0-9]+| ?[^\\s0-9{_LETTER}]+|\\s+(?!\\S)|\\s+")


def byte_bpe_path() -> str:
    return tokenizer_path("byte_bpe_50k.json")


class Encoder(dict):
    """Pre-token -> its ids as bytes; merges what it doesn't know. Ids take 2 bytes, or 4 in large vocabularies."""

    def __init__(self, path: str):
        super().__init__()
        import tiktoken

        self.lib = library(path)
        with open(path, encoding="utf-8") as f:
            model = json.load(f)
        alphabet = byte_alphabet()
        special = {t["content"] for t in model["added_tokens"]}
        ranks = {bytes(alphabet[c] for c in t): i for t, i in model["model"]["vocab"].items() if t not in special}
        # Merging by ids is merging by the list of merges, if each id follows that list.
        made = [model["model"]["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["model"]["merges"]]
        if any(a >= b for a, b in itertools.pairwise(made)):
            raise ValueError("ids don't follow the order of merges")
        self.merge = tiktoken.Encoding("merges", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
        self.special = re.compile("|".join(map(re.escape, special)) or r"(?!)")
        self.unit = np.dtype("<u2" if max(model["model"]["vocab"].values()) < 65536 else "<u4")

    def __missing__(self, word: str) -> bytes:
        ids = np.array(self.merge.encode_ordinary(word), dtype=self.unit).tobytes()
        self[word] = ids
        return ids

    def encode(self, text: str) -> bytes:
        if UNSAFE.search(text) or self.special.search(text):
            return np.array(self.lib.encode(text, add_special_tokens=False).ids, dtype=self.unit).tobytes()
        return b"".join(map(self.__getitem__, PRETOKEN.findall(text)))


_encoders: dict[str, Encoder] = {}


def tokenise(docs: DataFrame, path_of: Callable[[], str], closing_id: int, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, ids (packed little-endian, closing id included), width (bytes of an id), and the row's hash and salt.

    The salt is 0, but for rows that the task has had before: these have one each. A row counts as had, too, where
    another one of the same place in a table of hashes was; that only chooses its group.
    """
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("_text"), F.xxhash64(id_col, text).alias("row_hash"))
    schema = source.drop("_text", "row_hash").schema.add("ids", "binary").add("width", "integer").add("row_hash", "long").add("salt", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = path_of()
        if path not in _encoders:
            _encoders[path] = Encoder(path)
        encoder = _encoders[path]
        close = np.array([closing_id], dtype=encoder.unit).tobytes()
        seen = (TaskContext.get().partitionId() << 40) + 1
        had = np.zeros(1 << 22, dtype=bool)
        for whole in batches:
            salt = np.arange(seen, seen + whole.num_rows)
            place, first = np.unique(whole.column("row_hash").to_numpy() & (len(had) - 1), return_index=True)
            salt[first[~had[place]]] = 0
            had[place] = True
            seen += whole.num_rows
            whole = pa.RecordBatch.from_arrays([*whole.columns, pa.array(salt, pa.int64())], names=[*whole.schema.names, "salt"])
            for batch in slices(whole, "_text"):
                if len(encoder) > REMEMBERED:
                    encoder.clear()
                ids = [encoder.encode(t or "") + close for t in batch.column("_text").to_pylist()]
                width = pa.array(np.full(len(ids), encoder.unit.itemsize, dtype=np.int32))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.binary()), width, batch.column("row_hash"), batch.column("salt")], names=["doc_id", "ids", "width", "row_hash", "salt"])

    return source.mapInArrow(run, schema)


def pack(lengths: list[int], tiers: tuple[int, ...] = TIERS) -> list[tuple[int, list[tuple[int, int, int]]]]:
    """Windows as (size, pieces); a piece is (document, start, length), documents being numbered from 0.

    Pieces fill each window without a gap, but for windows of a power-of-two size, which are full too.
    """
    top = tiers[-1]
    out: list[tuple[int, list[tuple[int, int, int]]]] = []
    pool: list[tuple[int, int, int]] = []  # (length, document, start), ascending
    for d, n in enumerate(lengths):
        for k in range(n // top):
            out.append((top, [(d, k * top, top)]))
        if n % top:
            pool.append((n % top, d, n // top * top))
    pool.sort()
    while pool:
        n, d, start = pool.pop()
        size = next(t for t in tiers if t >= n)
        pieces, gap = [(d, start, n)], size - n
        while gap and pool:
            at = bisect_right(pool, (gap, float("inf"))) - 1
            if at >= 0:
                n, d, start = pool.pop(at)
                pieces.append((d, start, n))
                gap -= n
            else:
                n, d, start = pool.pop(0)
                pieces.append((d, start, gap))
                insort(pool, (n - gap, d, start + gap))
                gap = 0
        if not gap:
            out.append((size, pieces))
            continue
        left = size - gap  # the group's last window
        while left:
            part = 1 << (left.bit_length() - 1)
            left -= part
            window, need = [], part
            while need:
                d, start, n = pieces.pop(0)
                take = min(n, need)
                window.append((d, start, take))
                need -= take
                if n > take:
                    pieces.insert(0, (d, start + take, n - take))
            out.append((part, window))
    return out


def steps(windows: list[tuple[int, list[tuple[int, int, int]]]], step_tokens: int = STEP_TOKENS) -> list[int]:
    """The step group of each window: windows of one size, dealt in snake order of attention cost."""
    by_size: dict[int, list[int]] = {}
    for k, (size, _) in enumerate(windows):
        by_size.setdefault(size, []).append(k)
    out, used = [0] * len(windows), 0
    for size in sorted(by_size, reverse=True):
        members = sorted(by_size[size], key=lambda k: (-sum(n * n for _, _, n in windows[k][1]), k))
        groups = max(1, -(-len(members) * size // step_tokens))
        for rank, k in enumerate(members):
            turn, place = divmod(rank, groups)
            out[k] = used + (place if turn % 2 == 0 else groups - 1 - place)
        used += groups
    return out


PIECES = [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("sequence_tokens", pa.int64()), ("step_group", pa.int64())]


def pack_documents(docs: DataFrame, path_of: Callable[[], str] = byte_bpe_path, closing_id: int = CLOSING_ID, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """One row per piece: where it comes from, and where it lies."""
    total = docs.agg(F.coalesce(F.sum(F.octet_length("text") + 1), F.lit(0))).first()[0]
    groups = max(1, -(-total // group_bytes))
    number = F.pmod(F.xxhash64("row_hash", "salt"), F.lit(groups)).alias("g")
    tokens = tokenise(docs, path_of, closing_id).select(number, "doc_id", "ids", "width")
    first_step = 1 << 20

    def run(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        g = key[0].as_py()
        ids, doc, width = t.column("ids").to_pylist(), t.column("doc_id").to_pylist(), t.column("width").to_pylist()
        order = sorted(range(len(doc)), key=lambda k: (doc[k] is None, doc[k] or 0, ids[k]))
        rows: dict[str, list] = {n: [] for n, _ in PIECES}
        windows = pack([len(ids[k]) // width[k] for k in order])
        for number, (window, step) in enumerate(zip(windows, steps(windows), strict=True)):
            offset = 0
            for d, start, n in window[1]:
                k = order[d]
                piece = np.frombuffer(ids[k], dtype=f"<u{width[k]}", count=n, offset=start * width[k])
                values = (doc[k], start, n, zlib.crc32(piece.astype("<u4").tobytes()), len(ids[k]) // width[k], g << 32 | number, offset, window[0], g * first_step + step)
                for name, v in zip(rows, values, strict=True):
                    rows[name].append(v)
                offset += n
        return pa.table({n: pa.array(rows[n], t) for n, t in PIECES})

    tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // TASK_BYTES))
    return tokens.repartition(tasks, "g").groupBy("g").applyInArrow(run, ", ".join(f"{n} long" for n, _ in PIECES))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
