"""Token counts by a whole-token shortcut.

Offline, once per vocabulary: every vocabulary string that ends a word is encoded on its own by the
library; those that come back as that one token are proven whole. A text is then cut into
pre-tokens; proven ones count 1 without any merging, and only the others are merged, once per
distinct pre-token and worker, by the library.

Cutting is done with a pattern over the characters for which it is proven equal to the library's
(`SAFE`: ASCII, Latin-1 and Latin Extended-A but for the few with special case, composition or
space rules). Texts with any other character, or with a special token's string, are counted whole by
the library itself, so every count equals the library's.

Defined results: a null text counts as empty and has no tokens; nulls and repeats of doc_id change
nothing; an empty table gives no rows. Extra columns don't pass.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saltmarsh.llm.common import slices, table

#: Characters outside of these lead to the library: controls 1C-1F and 85 (a space or not, as engines
#: differ), superscript and fraction digits, and I with dot (its lower case has two characters).
UNSAFE = re.compile("[^\x00-\x1b\x20-\x84\x86-\xb1\xb4-\xb8\xba\xbb\xbf-įı-ſ]")
_LETTER = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-ſ"
PRETOKEN = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[0-9]|[^\\s0-9{_LETTER}]+")
#: Distinct merged pre-tokens a worker remembers before it starts anew (about 150 bytes each).
REMEMBERED = 1_000_000
OVER = 2048


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=2)
def library(path: str):
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(maxsize=2)
def prove(path: str) -> frozenset[str]:
    """The pre-tokens that encode alone as one token. Every vocabulary string is put to the library."""
    lib = library(path)
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    suffix, alphabet = model["end_of_word_suffix"], byte_alphabet()
    found = []
    for word in model["vocab"]:
        if not word.endswith(suffix):
            continue
        try:
            text = bytes(alphabet[c] for c in word[: -len(suffix)]).decode()
        except (KeyError, UnicodeDecodeError):
            continue
        if not UNSAFE.search(text) and PRETOKEN.fullmatch(text) and PRETOKEN.findall(text.lower()) == [text]:
            found.append(text)
    lengths = [len(e) for e in lib.encode_batch(found, add_special_tokens=False)]
    return frozenset(t for t, n in zip(found, lengths, strict=True) if n == 1)


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies, inverted."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Counter:
    """Counts the tokens of texts; whole: the proven pre-tokens."""

    def __init__(self, path: str, whole: frozenset[str]):
        self.lib = library(path)
        self.known: dict[str, int] = dict.fromkeys(whole, 1)
        self.whole = len(whole)
        added = [t.content for t in self.lib.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, added))) if added else re.compile(r"(?!)")

    def count(self, texts: list[str]) -> list[int]:
        cut = [None if UNSAFE.search(t) or self.special.search(t) else PRETOKEN.findall(t.lower()) for t in texts]
        if len(self.known) - self.whole > REMEMBERED:
            for k in [k for k in self.known][self.whole :]:
                del self.known[k]
        new = list({w for c in cut if c for w in c if w not in self.known})
        for k in range(0, len(new), 4096):
            part = new[k : k + 4096]
            self.known.update(zip(part, map(len, self.lib.encode_batch_fast(part, add_special_tokens=False)), strict=True))
        get = self.known.__getitem__
        return [len(self.lib.encode(t, add_special_tokens=False).ids) if c is None else sum(map(get, c)) for t, c in zip(texts, cut, strict=True)]


_counters: dict[str, Counter] = {}


def token_counts(docs: DataFrame, path_of: Callable[[], str] = tokenizer_path, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """id, n_bytes, n_tokens. path_of gives the vocabulary's place, on driver and executors alike."""
    source = docs.select(F.col(id_col), F.col(text).alias("_text"))
    schema = source.drop("_text").schema.add("n_bytes", "long").add("n_tokens", "long")
    whole = docs.sparkSession.sparkContext.broadcast(prove(path_of()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = path_of()
        if path not in _counters:
            _counters[path] = Counter(path, whole.value)
        counter = _counters[path]
        for big in batches:
            for batch in slices(big, "_text", 8_000_000):
                column = pa.compute.fill_null(batch.column("_text"), "")
                n = counter.count(column.to_pylist())
                size = pa.compute.cast(pa.compute.binary_length(column), pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(id_col), size, pa.array(n, pa.int64())], names=[id_col, "n_bytes", "n_tokens"])

    return source.mapInArrow(run, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents")).withColumn("over_limit", F.col("n_tokens") > OVER)
