"""An exact set-similarity self-join, of documents as sets of word shingles or of lines as sets of words.

A set's tokens (shingles or words) are put in one global order, rarest first, by a table of counts of
fixed size that a first pass sums over the corpus, so the order needs no shuffle of tokens. Two sets of
Jaccard similarity t or more, of n tokens and m, then share one of the first n - ceil(t n) + 1 tokens of
each (the prefix), have sizes in proportion (length filter), and enough left behind their first common
token (positional filter). What stands behind that token in both may differ by no more than the rest
allows: the suffix filter bounds that difference from below by the bits in which parity sketches of the
two suffixes differ. Each pair that passes is verified once, from the texts.

Sets are known by a hash of 96 bits of their tokens, so equal sets are one class from the start, whose
first member by (doc_id, hash of the text, line) stands for it. A task puts equal sets together before
anything is shuffled, so a set that stands everywhere arrives once a task. Entries (key, class, size,
place, sketch) travel as packed arrays, sorted into slots by key; pairs are made in numpy, slot by slot.

Different sets of similarity 3/4 or more share three tokens at least. So a prefix token that is frequent
in the corpus is no key by itself, for small sets: it is joined with the next tokens, two or three
together, which are rarer. Of the pairs of a key that pass, each class's with the earliest other one comes
first (`pair`); the `more` are looked at only where those leave something open. A key with more than
`CROWD` classes, or with pairs out of proportion to its classes (near copies of one text), passes on
its entries instead of more pairs, for a join of its own (`fitting`) of what is open. A token so
frequent that its entries would fill a task is spread over several slots, and they are all passed on.
Nothing is dropped.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from saltmarsh.llm import blocks
from saltmarsh.llm import textarrays as ta
from saltmarsh.llm.common import durable, few, seen, side_of, slices

BUCKETS, BLOCKS = 1 << 20, 64
#: Occurrences, beyond twice the mean of all buckets, from which a prefix token is joined with the next ones to make keys,
#: and from which its entries are spread over several slots.
FREQUENT, HOT = 10_000, 1_000_000
#: Sets of this many tokens and more also have single keys for frequent tokens; those up to a third more have joined ones.
LONG = 48
#: Classes of one key up to which all its pairs are looked at in its task, and passing pairs a class up to which they are passed on.
CROWD, PAIRS = 4096, 16
#: Entries (34 bytes) a task holds before passing them on; those aimed at per joining task; those a slot holds before it is thinned.
HELD, PER_TASK, THIN = 500_000, 1_000_000, 2_000_000
#: Bytes of text looked at together: their arrays of words, several times as large, stay in a core's cache.
TEXT = 500_000
#: Slots that a task packs rows for; where there are more, rows are dealt in two steps.
MOST_SLOTS = 4096
#: Pairs looked at together.
AT_ONCE = 250_000
AT, PAIR = ["doc_id", "doc_key", "line"], ["k1", "k2", "j1", "j2"]
ENTRIES, SALTED, FIRST, SAME = range(4)
U = np.uint64
_ENTRY = (("gram", "<u4"), ("k1", "<u8"), ("k2", "<u4"), ("sig", "<u8"), ("n", "<u2"), ("place", "<u2"), ("early", "<u4"), ("line", "<u2"))
_MEMBER = (("k1", "<u8"), ("k2", "<u4"), ("n", "<u4"), ("doc_id", "<i8"), ("doc_key", "<i8"), ("line", "<i4"))
_FORM = {ENTRIES: _ENTRY, SALTED: _ENTRY, FIRST: _MEMBER, SAME: _MEMBER}
_WAY = (("slot", "<i4"), ("base", "<i4"))
Columns = dict[str, np.ndarray]


@dataclass(frozen=True)
class Spec:
    """What a set is made of: whole texts or lines, words per token, and the similarity num/den (3/4 or more) to reach."""

    lines: bool = False
    words: int = 5
    num: int = 3
    den: int = 4


def needed(n: Column, m: Column, spec: Spec) -> Column:
    """The least overlap of sets of n and m tokens that reaches the similarity: ceil(t / (1 + t) (n + m))."""
    return F.ceil((n + m) * F.lit(spec.num) / F.lit(spec.num + spec.den))


def lengths_fit(n: Column, m: Column, spec: Spec) -> Column:
    return (n * spec.den >= m * spec.num) & (m * spec.den >= n * spec.num)


def positions_fit(n: Column, i: Column, m: Column, j: Column, spec: Spec) -> Column:
    """Holds at the first common token (i-th and j-th from 0) of every pair that is similar enough."""
    return (F.least(n - i, m - j)) * (spec.num + spec.den) >= (n + m) * spec.num


def suffixes_fit(n: Column, i: Column, a: Column, m: Column, j: Column, b: Column, spec: Spec) -> Column:
    """The suffix filter, at the first common token: the tokens before it all differ, and those behind it at least by
    the bits in which the suffixes' sketches a and b differ."""
    return i + j + F.bit_count(a.bitwiseXOR(b)) <= n + m - 2 * needed(n, m, spec)


def prefix_size(n: np.ndarray, spec: Spec) -> np.ndarray:
    return n + (-n * spec.num) // spec.den + 1


def bucket(token: np.ndarray) -> np.ndarray:
    return (token >> U(64 - 20)).astype(np.int64)


def rarity(counts: np.ndarray) -> np.ndarray:
    """Counts on a logarithmic scale of eighths of a power of two, one byte each."""
    return np.minimum(8 * np.log2(1 + counts.astype(np.float64)), 255).astype(np.uint8)


def excess(counts: np.ndarray) -> np.ndarray:
    """Counts beyond twice the mean: what a bucket holds by chance grows with the corpus, and makes no token frequent."""
    return counts - 2 * counts.mean() if len(counts) else counts


def salts(counts: np.ndarray) -> np.ndarray:
    """Over how many slots the entries of a bucket's tokens go. Nearly all are 1, however large the corpus."""
    return np.maximum(1, np.ceil(excess(counts) / HOT)).astype(np.uint32)


def text_key(text: str = "text") -> Column:
    """Tells apart rows that share a doc_id."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


@dataclass
class Sets:
    """Sets with a token: of each its row, its line number, size and class key; their tokens in global order, rarest first."""

    row: np.ndarray
    line: np.ndarray
    n: np.ndarray
    k1: np.ndarray
    k2: np.ndarray
    owner: np.ndarray
    token: np.ndarray
    place: np.ndarray
    suffix: np.ndarray  # of each token, the parity sketch of what follows it in its set


def unit_tokens(column: pa.Array, spec: Spec) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(unit, token) of all tokens, units ascending; row and line number of each unit. Every unit has a word."""
    w = ta.words(column, lower=True)
    head = np.searchsorted(w.start, w.offsets[:-1])
    if spec.lines:
        breaks = np.flatnonzero(w.raw == 10)
        head = np.concatenate([head, np.searchsorted(w.start, breaks)])
    head = np.unique(head[head < len(w.start)])
    unit = np.repeat(np.arange(len(head)), np.diff(np.append(head, len(w.start))))
    line = np.zeros(len(head), dtype=np.int64)
    if spec.lines:
        line = np.searchsorted(breaks, w.start[head]) - np.searchsorted(breaks, w.offsets[w.row[head]])
    token = w.hash
    if spec.words > 1:
        unit, token = ta.shingles(w.hash, unit, spec.words)
    return unit, token, w.row[head], line


def sets_of(column: pa.Array, spec: Spec, rare: np.ndarray) -> Sets:
    unit, token, row, line = unit_tokens(column, spec)
    order = ta.grouped_order(unit, token, rare[bucket(token)])
    owner, token = unit[order], token[order]
    if len(owner):
        new = np.r_[True, (owner[1:] != owner[:-1]) | (token[1:] != token[:-1])]
        owner, token = owner[new], token[new]
    n = np.bincount(owner, minlength=len(row))
    first = np.cumsum(n) - n
    k1, k2, suffix = (np.zeros(0, dtype=U) for _ in range(3))
    if len(row):
        with np.errstate(over="ignore"):
            k1 = ta.mix(np.add.reduceat(token, first) + n.astype(U))
            k2 = ta.mix(np.add.reduceat((token ^ (token >> U(31))) * (token | U(1)), first), 3) >> U(32)
        upto = np.bitwise_xor.accumulate(U(1) << (token & U(63)))
        suffix = upto ^ upto[first + n - 1][owner]
    return Sets(row, line, n, k1, k2, owner, token, np.arange(len(owner)) - first[owner], suffix)


def token_counts(docs: DataFrame, spec: Spec) -> tuple[np.ndarray, int, int]:
    """How often the tokens of each bucket of hashes stand in all texts; the least and the largest doc_id (0 without rows)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(BUCKETS, dtype=np.int64)
        for whole in batches:
            for batch in slices(whole, "_text", TEXT):
                token = unit_tokens(batch.column("_text"), spec)[1] if spec.words > 1 else ta.words(batch.column("_text"), lower=True).hash
                counts += np.bincount(bucket(token), minlength=BUCKETS)
        yield from blocks.emit(counts[:, None], BLOCKS)

    watch = Observation()
    watched = docs.observe(watch, F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
    counts = blocks.gather(watched.select(F.col("text").alias("_text")).mapInArrow(run, blocks.PARTIAL), BUCKETS, 1, BLOCKS)[:, 0]
    return counts, watch.get["least"] or 0, watch.get["most"] or 0


def keys_of(sets: Sets, spec: Spec, counts: np.ndarray, often: np.ndarray) -> tuple[np.ndarray, ...]:
    """(key, set, place and index of its last token, bucket or -1) of each join key of each set.

    counts: of each bucket; often: whether tokens of a bucket are frequent. A key of several tokens holds the place its
    last token would have, were those before it neighbours that don't count: so the positional filter reads alike.
    """
    n, token, owner, place = sets.n, sets.token, sets.owner, sets.place
    where, size, total = bucket(token), prefix_size(sets.n, spec), max(int(counts.sum()), 1)
    # Sets of under three tokens are similar to equal ones only.
    head = np.flatnonzero((place < size[owner]) & (n[owner] >= 3))
    frequent = often[where[head]]
    single = head[~frequent | (n[owner[head]] >= LONG)]
    out = [(token[single], owner[single], place[single], single, where[single])]
    start = head[frequent & (n[owner[head]] * spec.num <= LONG * spec.den)]
    last = np.cumsum(n)[owner]  # behind the end of each token's set
    made, at, expected = token[start], start, counts[where[start]].astype(np.float64)
    for depth in (1, 2):
        found, step, way = [], 1, np.arange(len(made))
        while len(way):
            follow = at[way] + step
            inside = follow < last[at[way]]
            way, follow = way[inside], follow[inside]
            inside = place[follow] < size[owner[follow]] + depth
            way, follow = way[inside], follow[inside]
            found.append((way, follow))
            step += 1
        if not found:
            break
        way, follow = (np.concatenate(x) for x in zip(*found, strict=True))
        joined = ta.mix(made[way] ^ ta.mix(token[follow], depth), depth)
        both = expected[way] * counts[where[follow]] / total
        deeper = (both > FREQUENT) & (depth == 1)
        end = follow[~deeper]
        out.append((joined[~deeper], owner[end], place[end] - depth, end, np.full(len(end), -1)))
        made, at, expected = joined[deeper], follow[deeper], both[deeper]
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _blob(columns: Columns, kind: tuple[tuple[str, str], ...], a: int, z: int) -> bytes:
    return b"".join(columns[name][a:z].astype(code, copy=False).tobytes() for name, code in kind)


def _unblob(raw: pa.Buffer, kind: tuple[tuple[str, str], ...]) -> Columns:
    sizes = [np.dtype(code).itemsize for _, code in kind]
    m, at, out = raw.size // sum(sizes), 0, {}
    for (name, code), size in zip(kind, sizes, strict=True):
        out[name] = np.frombuffer(raw, dtype=code, count=m, offset=at)
        at += size * m
    return out


def _join(parts: list[Columns]) -> Columns:
    return {name: np.concatenate([p[name] for p in parts]) for name in parts[0]}


def _small(columns: Columns, kind: tuple[tuple[str, str], ...]) -> Columns:
    """Columns as wide as they travel; others as they are."""
    return columns | {name: columns[name].astype(code, copy=False) for name, code in kind if name in columns}


def _take(columns: Columns, at: np.ndarray) -> Columns:
    return {name: v[at] for name, v in columns.items()}


def firsts(members: Columns, spec: Spec) -> tuple[Columns, Columns]:
    """Of each class the first member, and all others. A line met twice, as its row is repeated, is no other line."""
    members = _take(members, np.lexsort((members["line"], members["doc_key"], members["doc_id"], members["k2"], members["k1"])))
    new = np.r_[True, (members["k1"][1:] != members["k1"][:-1]) | (members["k2"][1:] != members["k2"][:-1])]
    rest = ~new
    if spec.lines:
        lead = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
        rest &= np.logical_or.reduce([members[c] != members[c][lead] for c in AT])
    return _take(members, new), _take(members, rest)


def _rows(kind: int, slot: np.ndarray, base: np.ndarray, columns: Columns, form: tuple[tuple[str, str], ...], run: int = 0) -> Iterator[pa.RecordBatch]:
    """One row of packed columns per run of equal slot and base, or per `run` slots, whose slot and base are packed too."""
    if run:
        columns, form = columns | {"slot": slot, "base": base}, (*form, *_WAY)
        slot = base = slot // run
    cut = np.flatnonzero(np.r_[True, (slot[1:] != slot[:-1]) | (base[1:] != base[:-1])]) if len(slot) else np.zeros(0, dtype=np.int64)
    ends = np.append(cut[1:], len(slot))
    for k in range(0, len(cut), 64):
        at = cut[k : k + 64]
        made = [_blob(columns, form, a, z) for a, z in zip(at, ends[k : k + 64], strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(slot[at].astype(np.int32)), pa.array(np.full(len(at), kind, dtype=np.int8)), pa.array(base[at].astype(np.int32)), pa.array(made, pa.binary())], names=["slot", "kind", "base", "data"])


def slot_and_gram(key: np.ndarray, slots: int) -> tuple[np.ndarray, np.ndarray]:
    """The two parts in which a key of 64 bits travels: the slot comes from its upper half, what tells keys of a slot apart is the lower one."""
    return (ta.mix(key >> U(32), 9) % U(slots)).astype(np.int64), key & U(0xFFFFFFFF)


def _once(e: Columns, by: np.ndarray, base: np.ndarray | None = None) -> Columns:
    """Entries in the order of `by`, each class once a key, with the time of the earliest of its members."""
    names = ["gram", "k1", "k2", "place"]
    if base is not None:
        e, names = e | {"base": base}, ["base", *names]

    def sort(order: np.ndarray) -> tuple[Columns, np.ndarray]:
        out = _take(e, order)
        return out, np.logical_or.reduce([out[c][1:] != out[c][:-1] for c in names])

    if not len(by):
        return e
    order = np.argsort(by)
    out, new = sort(order)
    if np.any(new & (by[order][1:] == by[order][:-1])):  # members of a class may lie apart
        out, new = sort(np.lexsort((*(e[c] for c in names), by)))
    head = np.flatnonzero(np.r_[True, new])
    time = np.minimum.reduceat(out["early"].astype(U) << U(16) | out["line"], head)
    return _take(out, head) | {"early": (time >> U(16)).astype(np.uint32), "line": (time & U(65535)).astype(np.uint16)}


def _send(held: list[tuple[Columns, Columns]], spec: Spec, spread: np.ndarray, slots: int, run: int) -> Iterator[pa.RecordBatch]:
    """What a task has gathered (which is emptied), dealt to slots: entries by key, first members by class, others anywhere."""
    entries, members = _join([h[0] for h in held]), _join([h[1] for h in held])
    held.clear()
    key = entries.pop("key")
    base, entries["gram"] = slot_and_gram(key, slots)
    # Equal sets of this task count once.
    entries = _once(entries, base.astype(U) << U(32) | ta.mix(key ^ entries["k1"], 5) >> U(32), base)
    base = entries.pop("base")
    ways = np.where(entries["bucket"] >= 0, spread[entries["bucket"]], 1).astype(U)
    del key
    plain = np.flatnonzero(ways == U(1))
    if len(plain) == len(ways):
        yield from _rows(ENTRIES, base, base, entries, _ENTRY, run)
    else:
        yield from _rows(ENTRIES, base[plain], base[plain], _take(entries, plain), _ENTRY, run)
        salted = np.flatnonzero(ways > U(1))
        slot = (base[salted] + (ta.mix(entries["k1"][salted], 9) % ways[salted]).astype(np.int64)) % slots
        by_slot = np.lexsort((base[salted], slot))
        salted, slot = salted[by_slot], slot[by_slot]
        yield from _rows(SALTED, slot, base[salted], _take(entries, salted), _ENTRY, run)
    first, rest = firsts(members, spec)
    slot = (first["k1"] % U(slots)).astype(np.int64)
    order = np.argsort(slot, kind="stable")
    yield from _rows(FIRST, slot[order], slot[order], _take(first, order), _MEMBER, run)
    if len(rest["k1"]):
        anywhere = np.full(len(rest["k1"]), int(rest["k1"][0] % U(slots)))
        yield from _rows(SAME, anywhere, anywhere, rest, _MEMBER, run)


def close_pairs(e: Columns, spec: Spec) -> tuple[Columns, Columns, np.ndarray]:
    """Pairs of different classes of one key that pass the filters: of each class that with the earliest other one, and
    the rest; and which entries are of crowded keys, whose rest isn't given. e: sorted by key and size (see `in_order`).

    Of a pair, (k1, k2) is the class met later, by the document's number and the line, as far as these tell.
    """
    rows, t, u = len(e["gram"]), spec.num, spec.num + spec.den
    size, place = e["n"].astype(np.int64), e["place"].astype(np.int64)
    early = e["early"].astype(U) << U(16) | e["line"]
    head = np.flatnonzero(np.r_[True, e["gram"][1:] != e["gram"][:-1]]) if rows else np.zeros(0, dtype=np.int64)
    members = np.diff(np.append(head, rows))
    group = np.repeat(np.arange(len(head)), members)
    crowded, passed = members > CROWD, np.zeros(len(head), dtype=np.int64)
    full = e["n"] == 65535  # so large that the size isn't known
    best, others = np.full(rows, -1), []

    def meet(i: np.ndarray, j: np.ndarray) -> None:
        nonlocal passed, crowded
        both = size[i] + size[j]
        ok = np.minimum(size[i] - place[i], size[j] - place[j]) * u >= both * t
        ok &= (size[j] * spec.den >= size[i] * t) & (size[i] * spec.den >= size[j] * t)
        ok |= full[i] | full[j]
        i, j, both = i[ok], j[ok], both[ok]
        apart = place[i] + place[j] + np.bitwise_count(e["sig"][i] ^ e["sig"][j])
        ok = (apart <= both - 2 * (-(-both * t // u))) | full[i] | full[j]
        ok &= (e["k1"][i] != e["k1"][j]) | (e["k2"][i] != e["k2"][j])
        i, j = i[ok], j[ok]
        swap = early[i] < early[j]
        later, sooner = np.where(swap, j, i), np.where(swap, i, j)
        order = np.lexsort((early[sooner], later))
        later, sooner = later[order], sooner[order]
        passed += np.bincount(group[later], minlength=len(head))
        crowded |= passed > PAIRS * members
        lead = np.r_[True, later[1:] != later[:-1]] if len(later) else np.zeros(0, dtype=bool)
        x, y = later[lead], sooner[lead]
        old = best[x]
        better = (old < 0) | (early[y] < early[old])
        best[x[better]] = y[better]
        beaten = better & (old >= 0)
        for a, b in ((later[~lead], sooner[~lead]), (x[~better], y[~better]), (x[beaten], old[beaten])):
            keep = ~crowded[group[a]]
            others.append((a[keep], b[keep]))

    # Sorted by size, the partners of an entry that are no larger than it are a run, which its place shortens.
    n = np.minimum(size, 4095)
    where = group << 12
    low = np.searchsorted(where | n, where | -(-n * t // spec.den))
    most = np.where(size < 4095, np.clip((size - place) * u // t - size, 0, 4095), 4095)
    high = np.minimum(np.searchsorted(where | n, where | most, side="right"), np.arange(rows))
    count = np.where(crowded[group], 0, np.maximum(high - low, 0))
    upto = np.concatenate([[0], np.cumsum(count)])
    a = 0
    while a < rows:
        z = max(a + 1, int(np.searchsorted(upto, upto[a] + AT_ONCE, side="right")) - 1)
        if upto[z] > upto[a]:
            i = np.repeat(np.arange(a, z), count[a:z])
            meet(i, low[i] + np.arange(len(i)) - (upto[i] - upto[a]))
        a = z
    # Of the largest keys each class is tried against two.
    for k in np.flatnonzero(members > CROWD):
        own = np.arange(head[k], head[k] + members[k])
        for pivot in {int(own[np.argmin(early[own])]), int(own[np.argmin(place[own])])}:
            meet(own, np.full(len(own), pivot))
    later = np.flatnonzero(best >= 0)
    first = (later, best[later])
    rest = tuple(np.concatenate(x) for x in zip(*others, strict=True)) if others else (later[:0], later[:0])
    keep = ~crowded[group[rest[0]]]
    rest = (rest[0][keep], rest[1][keep])
    # Of documents not told apart, either may have the later line: such pairs don't wait.
    same_time = e["early"][rest[0]] == e["early"][rest[1]]
    first = tuple(np.concatenate([f, r[same_time]]) for f, r in zip(first, rest, strict=True))
    rest = tuple(r[~same_time] for r in rest)
    return _pairs(e, *first), _pairs(e, *rest), crowded[group]


def _pairs(e: Columns, i: np.ndarray, j: np.ndarray) -> Columns:
    """The distinct pairs of classes of entries i and j; `gram` holds how early j's was met."""
    pairs = {"k1": e["k1"][i], "k2": e["k2"][i], "j1": e["k1"][j], "j2": e["k2"][j], "gram": e["early"][j].astype(np.int64) << 16 | e["line"][j]}
    pairs = _take(pairs, np.lexsort((pairs["j1"], pairs["k1"])))
    if len(i):
        pairs = _take(pairs, np.r_[True, np.logical_or.reduce([v[1:] != v[:-1] for v in pairs.values()])])
    return pairs


def in_order(e: Columns) -> Columns:
    """Entries by key and size (up to 4095), each class once a key."""
    return _once(e, e["gram"].astype(U) << U(32) | np.minimum(e["n"], 4095).astype(U) << U(20) | e["k1"] >> U(44))


FOUND = "kind string, gram long, k1 long, k2 long, j1 long, j2 long, n int, place int, sig long, doc_id long, doc_key long, line int"
_FOUND = [("kind", pa.string()), *((c, pa.int64()) for c in ("gram", "k1", "k2", "j1", "j2")), ("n", pa.int32()), ("place", pa.int32()), ("sig", pa.int64()), ("doc_id", pa.int64()), ("doc_key", pa.int64()), ("line", pa.int32())]


def _found(kind: str, columns: Columns) -> Iterator[pa.RecordBatch]:
    m = len(next(iter(columns.values())))
    for a in range(0, m, 50_000):
        size = min(50_000, m - a)
        made = [pa.array([kind] * size)]
        for name, t in _FOUND[1:]:
            v = columns.get(name)
            made.append(pa.nulls(size, t) if v is None else pa.array(v[a : a + size].view(np.int64) if v.dtype == np.uint64 else v[a : a + size].astype(np.int64)).cast(t))
        yield pa.RecordBatch.from_arrays(made, names=[n for n, _ in _FOUND])


class Slot:
    """The entries of one slot. Keys too large to be held leave it, now and whenever they come again."""

    def __init__(self, number: int):
        self.number, self.parts, self.size, self.limit, self.crowded = number, [], 0, THIN, np.zeros(0, dtype=np.uint32)

    def add(self, e: Columns) -> Iterator[pa.RecordBatch]:
        self.parts.append(e)
        self.size += len(e["gram"])
        if self.size > self.limit:
            yield from self.thin()

    def thin(self) -> Iterator[pa.RecordBatch]:
        """Puts classes together; keys that are too large to be held leave."""
        e = in_order(_join(self.parts))
        head = np.flatnonzero(np.r_[True, e["gram"][1:] != e["gram"][:-1]])
        size = np.diff(np.append(head, len(e["gram"])))
        many = np.repeat((size > self.limit // 8) | np.isin(e["gram"][head], self.crowded), size)
        if many.any():
            out = _take(e, many)
            yield from crowd(self.number, out)
            self.crowded = np.union1d(self.crowded, out["gram"])
            e = _take(e, ~many)
        self.parts, self.size = [e], len(e["gram"])
        self.limit = max(THIN, 2 * self.size)

    def close(self, spec: Spec) -> Iterator[pa.RecordBatch]:
        yield from self.thin()
        (e,), self.parts = self.parts, []
        if len(e["gram"]):
            first, more, crowded = close_pairs(e, spec)
            yield from _found("pair", first)
            yield from _found("more", more)
            yield from crowd(self.number, _take(e, crowded))


def crowd(base: int, e: Columns) -> Iterator[pa.RecordBatch]:
    return _found("crowd", {**e, "gram": np.int64(base) << np.int64(32) | e["gram"].astype(np.int64)})


def dealt(batches: Iterator[pa.RecordBatch], spec: Spec, tables: tuple[np.ndarray, ...], least: int, coarse: int, slots: int, runs: int) -> Iterator[pa.RecordBatch]:
    """Packed rows of the sets of a task's texts (doc_id, _text, doc_key), gathered until `HELD`. tables: rarity, salts,
    counts and frequency of each bucket. doc_ids are told apart beyond the least one, without their `coarse` lowest bits."""
    rare, spread, counts, often = tables
    held: list[tuple[Columns, Columns]] = []
    size = 0
    for whole in batches:
        for batch in slices(whole, "_text", TEXT):
            sets = sets_of(batch.column("_text"), spec, rare)
            if not spec.lines and len(sets.row) < batch.num_rows:
                wordless = np.setdiff1d(np.arange(batch.num_rows), sets.row)
                none = {c: np.zeros(len(wordless), dtype=U) for c in ("k1", "k2", "n", "line")} | {c: batch.column(c).to_numpy()[wordless] for c in ("doc_id", "doc_key")}
                anywhere = np.full(len(wordless), int(none["doc_key"][0]) % slots)
                yield from _rows(SAME, anywhere, anywhere, none, _MEMBER, runs)
            if not len(sets.row):
                continue
            key, own, place, token, where = keys_of(sets, spec, counts, often)
            entries = {"key": key, "bucket": where.astype(np.int32), "k1": sets.k1[own], "k2": sets.k2[own], "sig": sets.suffix[token], "n": np.minimum(sets.n[own], 65535), "place": np.minimum(place, 65535)}
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            early = (ids.view(U) - U(least & 0xFFFFFFFFFFFFFFFF)) >> U(coarse)
            entries |= {"early": early[sets.row[own]], "line": np.minimum(sets.line[own], 65535)}
            ids, keys = (batch.column(c).to_numpy(zero_copy_only=False)[sets.row] for c in ("doc_id", "doc_key"))
            held.append((_small(entries, _ENTRY), _small({"k1": sets.k1, "k2": sets.k2, "n": sets.n, "doc_id": ids, "doc_key": keys, "line": sets.line}, _MEMBER)))
            size += len(key) + len(sets.row)
            if size >= HELD:
                yield from _send(held, spec, spread, slots, runs)
                held, size = [], 0
    if held:
        yield from _send(held, spec, spread, slots, runs)


def join_sets(docs: DataFrame, spec: Spec, most_slots: int = MOST_SLOTS) -> DataFrame:
    """Rows of FOUND, stored, from docs (doc_id, text; no null doc_id).

    `pair`: classes that may be similar (k1, k2 and j1, j2). `more`: others, of which (k1, k2) is the later one for certain.
    `crowd`: entries of crowded keys, all of whose pairs count. `first`: the member that
    stands for each class. `same`: all other members, and whole texts without a word, of size 0.
    """
    spark = docs.sparkSession
    counts, least, most = token_counts(docs, spec)
    coarse = max(0, (most - least).bit_length() - 32)
    partitions = int(max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(counts.sum()) / 4 / PER_TASK + 1))
    slots = partitions * 4
    # A task's rows go to so many slots at most; beyond, to runs of slots, whose tasks deal them on.
    runs = 0 if slots <= most_slots else math.ceil(slots / most_slots)
    tables = spark.sparkContext.broadcast((rarity(counts), salts(counts), counts, excess(counts) > FREQUENT))
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("_text"), text_key().alias("doc_key"))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return dealt(batches, spec, tables.value, least, coarse, slots, runs)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: dict[int, Slot] = {}
        first: list[Columns] = []
        for batch in batches:
            for slot, kind, base, data in zip(*(batch.column(c).to_pylist() for c in ("slot", "kind", "base")), batch.column("data"), strict=True):
                got = _unblob(data.as_buffer(), _FORM[kind])
                if kind == ENTRIES:
                    yield from at.setdefault(slot, Slot(slot)).add(got)
                elif kind == SALTED:
                    yield from crowd(base, got)
                elif kind == FIRST:
                    first.append(got)
                else:
                    yield from _found("same", got)
        for slot in at.values():
            yield from slot.close(spec)
        if first:
            kept, rest = firsts(_join(first), spec)
            yield from _found("first", kept)
            yield from _found("same", rest)

    def regroup(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Runs of slots, dealt on to their slots."""
        held: dict[int, list[tuple[Columns, np.ndarray, np.ndarray]]] = {}
        size = 0

        def out() -> Iterator[pa.RecordBatch]:
            for kind, parts in held.items():
                slot, base = (np.concatenate([p[k] for p in parts]) for k in (1, 2))
                order = np.lexsort((base, slot))
                yield from _rows(kind, slot[order], base[order], _take(_join([p[0] for p in parts]), order), _FORM[kind])

        for batch in batches:
            for kind, data in zip(batch.column("kind").to_pylist(), batch.column("data"), strict=True):
                got = _unblob(data.as_buffer(), (*_FORM[kind], *_WAY))
                slot, base = (got.pop(c).astype(np.int64) for c in ("slot", "base"))
                held.setdefault(kind, []).append((got, slot, base))
                size += len(slot)
                if size >= HELD:
                    yield from out()
                    held, size = {}, 0
        yield from out()

    form = "slot int, kind tinyint, base int, data binary"
    packed = source.mapInArrow(send, form)
    if runs:
        # Any number of tasks may share a run: each gathers what many tasks have of it.
        packed = packed.repartition(partitions, "slot", F.pmod(F.spark_partition_id(), F.lit(math.ceil(partitions / most_slots)))).mapInArrow(regroup, form)
    return durable(packed.repartition(partitions, "slot").mapInArrow(meet, FOUND), crowd=F.count_if(F.col("kind") == "crowd"))


def classes_of(found: DataFrame) -> DataFrame:
    """(k1, k2, at): each class and its first member."""
    return found.where("kind = 'first'").select("k1", "k2", F.struct(*AT).alias("at"))


def fitting(x: DataFrame, y: DataFrame, different: str, spec: Spec) -> DataFrame:
    """Distinct pairs of classes (k1, k2 from x, j1, j2 from y; columns of crowded entries and more) that share a key, are
    different, also as `different` says (columns prefixed x_ and y_), and pass the filters."""
    x, y = x.select([F.col(c).alias(f"x_{c}") for c in x.columns]), y.select([F.col(c).alias(f"y_{c}") for c in y.columns])
    n, i, a, m, j, b = (F.col(c) for c in ("x_n", "x_place", "x_sig", "y_n", "y_place", "y_sig"))
    huge = (n == 65535) | (m == 65535)
    fits = huge | (lengths_fit(n, m, spec) & positions_fit(n, i, m, j, spec) & suffixes_fit(n, i, a, m, j, b, spec))
    joined = x.join(y, (F.col("x_gram") == F.col("y_gram")) & F.expr(f"(x_k1 <> y_k1 or x_k2 <> y_k2) and {different}") & fits)
    return joined.select(F.col("x_k1").alias("k1"), F.col("x_k2").alias("k2"), F.col("y_k1").alias("j1"), F.col("y_k2").alias("j2")).distinct()


def earliest(found: DataFrame) -> DataFrame:
    """Of each class one of its `pair`s: that with the earliest other class of all keys."""
    one = found.where("kind = 'pair'").groupBy("k1", "k2").agg(F.min(F.struct("gram", "j1", "j2")).alias("p"))
    return durable(one.select("k1", "k2", "p.j1", "p.j2"))


def crowd_entries(found: DataFrame) -> DataFrame:
    return found.where("kind = 'crowd'").select("gram", "k1", "k2", "n", "place", "sig").distinct()


CHECKED = "k1 long, k2 long, at struct<doc_id:long,doc_key:long,line:int>, j1 long, j2 long, other struct<doc_id:long,doc_key:long,line:int>"


def checked(pairs: DataFrame, classes: DataFrame, docs: DataFrame, spec: Spec) -> DataFrame:
    """(k1, k2, at, j1, j2, other): those of distinct, stored pairs (k1, k2, j1, j2) that are similar enough.

    Each text is cut once, where it is read; what is cut out goes straight to the class it is compared with.
    """
    # Few pairs go to the classes, which are read once for both members; only many make the classes move.
    if not seen(pairs):
        return docs.sparkSession.createDataFrame([], CHECKED)
    light = F.broadcast if few(pairs) else lambda df: df
    ends = pairs.select("k1", "k2").union(pairs.select("j1", "j2"))
    met = durable(classes.join(F.broadcast(ends) if few(pairs, times=2) else ends, ["k1", "k2"], "left_semi").select("k1", "k2", "at"))
    side = lambda a, b, at: side_of(met).select(F.col("k1").alias(a), F.col("k2").alias(b), F.col("at").alias(at))
    both = durable(pairs.join(side("k1", "k2", "at"), ["k1", "k2"]).join(side("j1", "j2", "other"), ["j1", "j2"]).select("k1", "k2", "at", "j1", "j2", "other"))
    if not seen(both):
        return both
    nobody = [F.lit(None).cast("long").alias(c) for c in ("k1", "k2")]
    asked = both.select("at.*", "k1", "k2", "j1", "j2").union(both.select("other.*", *nobody, "j1", "j2").distinct())
    of_doc = asked.groupBy("doc_id", "doc_key").agg(F.collect_list(F.struct("line", *PAIR)).alias("_want"))
    if few(both, times=2):  # both members of a pair ask
        of_doc = F.broadcast(of_doc)
    keyed = docs.select("doc_id", F.col("text").alias("_text"), text_key().alias("doc_key")).join(of_doc, ["doc_id", "doc_key"]).select("doc_id", "doc_key", "_text", "_want")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()  # a row that is repeated in the table counts once a task
        for whole in batches:
            for batch in slices(whole, "_text"):
                ids = list(zip(batch.column("doc_id").to_pylist(), batch.column("doc_key").to_pylist(), strict=True))
                new = dict.fromkeys(ids, True) | dict.fromkeys(seen.intersection(ids), False)
                batch = batch.filter(pa.array([new.pop(i, False) for i in ids]))
                seen.update(ids)
                wants, texts = batch.column("_want"), []
                where = pa.compute.list_parent_indices(wants).to_numpy()
                line = wants.flatten().field("line").to_numpy()
                ends = np.flatnonzero(np.r_[where[1:] != where[:-1], True])
                start = 0
                for k, end in zip(where[ends].tolist(), (ends + 1).tolist(), strict=True):
                    text = batch.column("_text")[k].as_py()
                    lines = text.split("\n") if spec.lines else [text]
                    texts += [lines[i] for i in line[start:end].tolist()]
                    start = end
                yield pa.RecordBatch.from_arrays([*(wants.flatten().field(c) for c in PAIR), pa.array(texts, pa.string())], names=[*PAIR, "text"])

    texts = durable(keyed.mapInArrow(cut, "k1 long, k2 long, j1 long, j2 long, text string"))
    one = texts.where("k1 is not null").withColumnRenamed("text", "_a")
    other = texts.where("k1 is null").select("j1", "j2", F.col("text").alias("_b"))
    similar = similar_texts(one.join(other, ["j1", "j2"]).select(*PAIR, "_a", "_b"), spec).distinct()
    return light(both).join(similar, PAIR).select("k1", "k2", "at", "j1", "j2", "other")


def overlaps(a: pa.Array, b: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For rows of two texts: the sizes of both sets and of their intersection."""
    rows = len(a)
    sides = []
    for column in (a, b):
        w = ta.words(column, lower=True)
        sides.append(ta.shingle_sets(w.hash, w.row, words))
    owner = np.concatenate([sides[0][0], sides[1][0]])
    token = np.concatenate([sides[0][1], sides[1][1]])
    order = ta.grouped_order(owner, token)
    owner, token = owner[order], token[order]
    twice = (owner[1:] == owner[:-1]) & (token[1:] == token[:-1])
    return (*(np.bincount(s[0], minlength=rows) for s in sides), np.bincount(owner[1:][twice], minlength=rows))


def similar_texts(pairs: DataFrame, spec: Spec) -> DataFrame:
    """The rows of pairs whose texts `_a` and `_b` are similar enough, without these two."""
    kept = [c for c in pairs.columns if c not in ("_a", "_b")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for half in slices(whole, "_a", TEXT):
                for batch in slices(half, "_b", TEXT):
                    n, m, shared = overlaps(batch.column("_a"), batch.column("_b"), spec.words)
                    holds = pa.array((shared > 0) & (spec.den * shared >= spec.num * (n + m - shared)))
                    yield pa.RecordBatch.from_arrays([batch.column(c).filter(holds) for c in kept], names=kept)

    return pairs.mapInArrow(run, pairs.select(*kept).schema)
