"""Quality rules as a bitmask ledger.

Each rule is evaluated once per document. The ledger row keeps the measurements and one long,
`failures`, whose bit k is set where rule k failed. Policies are versioned sets of rules: applying
one is a bitwise AND with its mask, and what a rule adds to a policy (its ablation) is counted from
the same column without looking at a text again.

Measurements need word positions, so they are taken in numpy on Arrow batches; rules, policies and
ablations are plain column expressions.

Defined results: a null text has no words and every count 0; so has an empty text or one of white
space only. Repeated rows, rows with a null doc_id and ties are judged one by one. Extra columns are
ignored; those of the ledger replace any of the same name. An empty table gives an empty ledger.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saltmarsh.llm import textarrays as ta
from saltmarsh.llm.common import slices

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper_words", "n_stutters")
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_UPPER = np.zeros(256, dtype=bool)
_UPPER[65:91] = True
_LOW = np.zeros(256, dtype=bool)
_LOW[97:123] = True


@dataclass(frozen=True)
class Rule:
    """A failed rule sets bit `bit`. `failed` is an expression over the measurements, without division."""

    bit: int
    name: str
    failed: str


#: Bits are never reused: a changed rule gets a new bit, so old ledgers stay readable.
RULES = (
    Rule(0, "few_words", "n_words < 10"),
    Rule(1, "repeated_windows", "100 * n_repeat_words > 20 * n_words"),
    Rule(2, "symbols", "10 * n_symbols > n_words"),
    Rule(3, "shouting", "10 * n_upper_words > 3 * n_words"),
    Rule(4, "duplicate_lines", "10 * n_dup_lines > 3 * n_lines"),
    Rule(5, "word_length", "word_chars < 2 * n_words or word_chars > 15 * n_words"),
    Rule(6, "many_duplicate_lines", "n_dup_lines >= 3 and 10 * n_dup_lines > 3 * n_lines"),
    Rule(7, "stutters", "10 * n_stutters > 3 * n_words"),
)
#: Version -> bits that count. 1 is the base; the latest is in force. 3 leaves short texts alone in
#: which one line stands twice, and rejects words said over and over.
POLICIES = {1: (0, 1), 2: (0, 1, 2, 3, 4, 5), 3: (0, 1, 2, 3, 5, 6, 7)}
IN_FORCE = max(POLICIES)


def mask(bits: tuple[int, ...]) -> int:
    return sum(1 << b for b in bits)


def measure_texts(column: pa.Array) -> dict[str, np.ndarray]:
    w = ta.words(column)
    n, rows = len(w.start), w.rows
    count = lambda where, weights=None: np.bincount(where, weights, rows).astype(np.int64)
    per_byte = np.repeat(np.arange(rows), np.diff(w.offsets))
    heads = (w.raw & 0xC0) != 0x80
    out = {"n_words": count(w.row), "n_symbols": count(per_byte[_SYMBOL[w.raw]])}
    chars = np.concatenate([[0], np.cumsum(heads)])
    out["word_chars"] = count(w.row, chars[w.end] - chars[w.start])
    upper = np.concatenate([[0], np.cumsum(_UPPER[w.raw])])
    lower = np.concatenate([[0], np.cumsum(_LOW[w.raw])])
    out["n_upper_words"] = count(w.row[(upper[w.end] - upper[w.start] > 1) & (lower[w.end] == lower[w.start])])
    # Lines: cut at \n and at the rows' ends; those without a word don't count.
    cut = np.flatnonzero(w.raw == 10)
    begin = np.unique(np.concatenate([w.offsets[:-1][np.diff(w.offsets) > 0], cut + 1]))
    begin = begin[begin < len(w.raw)]
    at = np.searchsorted(begin, w.start, side="right") - 1
    held = np.unique(at)
    start = begin[held]
    stop = np.append(begin, len(w.raw))[held + 1]
    stop = stop - ((stop > start) & (w.raw[stop - 1] == 10)) if len(stop) else stop
    line_row = np.searchsorted(w.offsets, start, side="right") - 1
    line_hash = ta.hash_runs(w.raw, start, stop - start)
    order = np.lexsort((line_hash, line_row))
    a, b = line_row[order], line_hash[order]
    same = (a[1:] == a[:-1]) & (b[1:] == b[:-1])
    out["n_lines"], out["n_dup_lines"] = count(line_row), count(a[1:][same])
    again = (w.row[1:] == w.row[:-1]) & (w.hash[1:] == w.hash[:-1])
    out["n_stutters"] = count(w.row[1:][again])
    # Words inside five-word windows that occur twice or more in their text.
    first, h = ta.windows(w.hash, w.row, 5)
    owner = w.row[first]
    order = np.lexsort((h, owner))
    a, b = owner[order], h[order]
    same = (a[1:] == a[:-1]) & (b[1:] == b[:-1])
    again = np.zeros(len(order), dtype=bool)
    again[1:] |= same
    again[:-1] |= same
    edge = np.zeros(n + 1, dtype=np.int64)
    twice = first[order[again]]
    np.add.at(edge, twice, 1)
    np.add.at(edge, twice + 5, -1)
    out["n_repeat_words"] = count(w.row[np.cumsum(edge[:-1]) > 0])
    return out


def measure(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text", text_as: str | None = None) -> DataFrame:
    """One row per document: the columns in `keep`, the measurements and, if a name is given for it, the text."""
    keep = tuple(c for c in keep if c not in (*MEASURES, "_text"))
    source = docs.select(*[f"`{c}`" for c in keep], F.col(text).alias("_text"))
    schema = source.drop("_text").schema
    for m in MEASURES:
        schema = schema.add(m, "long")
    if text_as:
        schema = schema.add(text_as, "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "_text"):
                got = measure_texts(batch.column("_text"))
                kept = [batch.column(c) for c in keep]
                passed = [batch.column("_text")] if text_as else []
                yield pa.RecordBatch.from_arrays([*kept, *(pa.array(got[m]) for m in MEASURES), *passed], names=schema.names)

    return source.mapInArrow(run, schema)


def ledger(measured: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Adds `failures`: every rule's bit, set where it failed."""
    bits = [F.when(F.expr(r.failed), F.lit(1 << r.bit)).otherwise(F.lit(0)).cast("long") for r in rules]
    total = bits[0]
    for b in bits[1:]:
        total = total.bitwiseOR(b)
    return measured.withColumn("failures", total)


def rejected(version: int, failures: str = "failures") -> Column:
    """Whether the policy of that version rejects a row of the ledger."""
    return F.col(failures).bitwiseAND(F.lit(mask(POLICIES[version])).cast("long")) != 0


def sole_rule(version: int, failures: str = "failures") -> Column:
    """The rule without which the policy would keep the row: the only one of its rules that failed, else null."""
    within = F.col(failures).bitwiseAND(F.lit(mask(POLICIES[version])).cast("long"))
    return F.coalesce(*[F.when(within == 1 << r.bit, F.lit(r.name)) for r in RULES if r.bit in POLICIES[version]])


def ablations(rows: DataFrame, version: int) -> DataFrame:
    """For each rule of a policy: documents failing it, and those only it rejects (kept without it).

    Counted from distinct failure masks, of which there are at most 2 ** number of rules.
    """
    whole = mask(POLICIES[version])
    per_mask = rows.groupBy(F.col("failures").bitwiseAND(F.lit(whole).cast("long")).alias("m")).agg(F.count(F.lit(1)).alias("n"))
    rule = F.explode(F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(1 << r.bit).cast("long").alias("b")) for r in RULES if r.bit in POLICIES[version]]))
    return (
        per_mask.select("m", "n", rule.alias("r"))
        .groupBy("r.rule")
        .agg(
            F.sum(F.when(F.col("m").bitwiseAND(F.col("r.b")) != 0, F.col("n")).otherwise(0)).alias("failing"),
            F.sum(F.when(F.col("m") == F.col("r.b"), F.col("n")).otherwise(0)).alias("only_this"),
        )
    )


def digest(docs: DataFrame) -> DataFrame:
    rows = ledger(measure(docs))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        rejected(1).alias("base_failed"), (~rejected(IN_FORCE)).alias("kept"), "n_lines", "n_upper_words", "n_stutters", "failures", sole_rule(IN_FORCE).alias("sole_rule"),
    )


#: DuckDB: the same from the words and lines as lists.
_SOLE = " ".join(f"WHEN {1 << r.bit} THEN '{r.name}'" for r in RULES if r.bit in POLICIES[IN_FORCE])
_BITS = " + ".join(f"CASE WHEN {r.failed} THEN {1 << r.bit} ELSE 0 END" for r in RULES)
ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
lines AS (
  SELECT r, unnest(string_split(t, chr(10))) AS line FROM d),
line_counts AS (
  SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
wins AS (
  SELECT r, i, array_to_string(list_slice(w, i, i + 4), ' ') AS win
  FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)),
twice AS (
  SELECT r, unnest(range(i, i + 5)) AS p
  FROM (SELECT r, i, count(*) OVER (PARTITION BY r, win) AS c FROM wins) WHERE c >= 2),
repeats AS (SELECT r, count(DISTINCT p) AS n_repeat_words FROM twice GROUP BY r),
m AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words,
         CAST(len(list_filter(w, lambda x: regexp_matches(x, '[A-Z].*[A-Z]') AND NOT regexp_matches(x, '[a-z]'))) AS BIGINT) AS n_upper_words,
         CAST(len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) AS BIGINT) AS n_stutters
  FROM d LEFT JOIN line_counts USING (r) LEFT JOIN repeats USING (r)),
f AS (
  SELECT *, CAST(BITS AS BIGINT) AS failures
  FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (failures & BASE) <> 0 AS base_failed, (failures & FORCE) = 0 AS kept, n_lines, n_upper_words, n_stutters, failures,
       CASE failures & FORCE SOLE ELSE NULL END AS sole_rule
FROM f
""".replace("BASE", str(mask(POLICIES[1]))).replace("FORCE", str(mask(POLICIES[IN_FORCE]))).replace("SOLE", _SOLE).replace("BITS", _BITS)
