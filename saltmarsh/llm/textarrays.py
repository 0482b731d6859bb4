"""Words, lines and word shingles of whole texts as numpy arrays.

Everything works on the UTF-8 bytes of an Arrow string column, a run of rows at a time, so no
Python object is made per word. Words are runs of bytes other than space and 0x09-0x0D, which in
UTF-8 is the same as splitting the decoded text at these six characters. Hashes have 64 bits.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U = np.uint64
_rng = np.random.default_rng(20240817)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.int64).astype(U) * U(2) + U(1)
#: Masks of the first 0 to 8 bytes of eight.
_FIRST = np.array([(1 << (8 * k)) - 1 for k in range(9)], dtype=U)
_BASE = U(0x9E3779B97F4A7C15)
_STEP = _rng.integers(1, 2**63, 64, dtype=np.int64).astype(U) * U(2) + U(1)
_pow = np.ones(1, dtype=U)


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijection of 64-bit values whose output bits all depend on all input bits."""
    with np.errstate(over="ignore"):
        x = x + U((seed * 2 + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
        return x ^ (x >> U(31))


def _powers(n: int) -> np.ndarray:
    global _pow
    if len(_pow) < n:
        with np.errstate(over="ignore"):
            _pow = np.concatenate([np.ones(1, dtype=U), np.cumprod(np.full(max(n, 1024), _BASE, dtype=U))])
    return _pow[:n]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all rows of a string column (null: empty) and the n+1 offsets of the rows in them."""
    column = pa.compute.fill_null(column, "").cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def hash_runs(raw: np.ndarray, starts: np.ndarray, lengths: np.ndarray, lower: bool = False) -> np.ndarray:
    """A hash of each run of bytes; runs are disjoint, ascending and not empty. lower: A-Z count as a-z.

    Runs of up to 64 bytes are read eight bytes at a time; longer ones by a polynomial over all bytes.
    """
    if not len(starts):
        return np.zeros(0, dtype=U)
    data = np.zeros(len(raw) + 8, dtype=np.uint8)
    data[:-8] = raw
    if lower:
        data |= ((data - np.uint8(65)) < 26).view(np.uint8) << np.uint8(5)
    eight = np.ndarray((len(raw) + 1,), dtype="<u8", buffer=data, strides=(1,))
    with np.errstate(over="ignore"):
        h = mix((eight[starts] & _FIRST[np.minimum(lengths, 8)]) ^ (lengths.astype(U) * _BASE), 5)
        more = np.flatnonzero((lengths > 8) & (lengths <= 64))
        done = 8
        while len(more):
            left = lengths[more] - done
            h[more] = mix(h[more] ^ (eight[starts[more] + done] & _FIRST[np.minimum(left, 8)]), 6)
            more, done = more[left > 8], done + 8
    long = np.flatnonzero(lengths > 64)
    if len(long):
        at, size = starts[long], lengths[long]
        first = np.cumsum(size) - size
        h[long] = hash_bytes(data[np.repeat(at - first, size) + np.arange(int(size.sum()))], size)
    return h


def hash_bytes(data: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A hash of each of the runs that follow each other in data without a gap."""
    first = np.cumsum(lengths) - lengths
    within = np.arange(len(data)) - np.repeat(first, lengths)
    with np.errstate(over="ignore"):
        terms = _BYTE[data] * _powers(int(lengths.max()))[within]
        return mix(np.add.reduceat(terms, first) + lengths.astype(U))


def grouped_order(group: np.ndarray, value: np.ndarray, rank: np.ndarray | None = None) -> np.ndarray:
    """The order by group (ascending numbers), rank (a byte, if given) and value: np.lexsort's, sooner.

    One 64-bit key of the group, the rank and the value's upper bits is sorted; where it doesn't tell
    different values of a group apart, lexsort does.
    """
    if not len(group):
        return np.zeros(0, dtype=np.int64)
    near = (group - group[0]).astype(U)
    if near[-1] < U(1 << 20):
        key = near << U(44)
        key |= value >> U(20) if rank is None else (rank.astype(U) << U(36)) | (value >> U(28))
        order = np.argsort(key)
        key, value_ = key[order], value[order]
        if not np.any((key[1:] == key[:-1]) & (value_[1:] != value_[:-1])):
            return order
    return np.lexsort((value, group) if rank is None else (value, rank, group))


@dataclass
class Words:
    """Words in the order of the texts. row: the row each belongs to; start, end: its bytes."""

    raw: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    hash: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1


def words(column: pa.Array, lower: bool = False) -> Words:
    raw, offsets = utf8(column)
    return words_of(raw, offsets, lower)


def words_of(raw: np.ndarray, offsets: np.ndarray, lower: bool = False) -> Words:
    # Not a space, and not 9 to 13: what is below 9 comes out large.
    inside = np.zeros(len(raw) + 2, dtype=bool)
    inside[1:-1] = ((raw - np.uint8(9)) > 4) & (raw != 32)
    turns = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = turns[::2], turns[1::2]
    # A word doesn't go on in the next text.
    met = np.unique(offsets[inside[offsets] & inside[offsets + 1]])
    if len(met):
        start, end = np.insert(start, np.searchsorted(start, met), met), np.insert(end, np.searchsorted(end, met), met)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(np.searchsorted(start, offsets)))
    return Words(raw, offsets, start, end, row, hash_runs(raw, start, end - start, lower))


def windows(hashes: np.ndarray, group: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of each run of `size` words inside one group (group: ascending numbers)."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=U)
    with np.errstate(over="ignore"):
        total = hashes[:n] * _STEP[0]
        for k in range(1, size):
            total = total + hashes[k : n + k] * _STEP[k]
    start = np.flatnonzero(group[:n] == group[size - 1 :])
    return start, mix(total[start], size)


def shingles(hashes: np.ndarray, group: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of each group, repeats included, as (group, shingle) with groups ascending.

    A group with 1 to size-1 words has one shingle, the whole sequence; one without words has none.
    """
    start, shingle = windows(hashes, group, size)
    owner = group[start]
    if len(hashes):
        head = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        count = np.diff(np.r_[head, len(group)])
        short = count < size
        for k in range(1, size):
            at = head[short & (count == k)]
            if len(at):
                with np.errstate(over="ignore"):
                    total = hashes[at] * _STEP[0]
                    for j in range(1, k):
                        total = total + hashes[at + j] * _STEP[j]
                owner = np.concatenate([owner, group[at]])
                shingle = np.concatenate([shingle, mix(total, k)])
    if len(owner) > len(start):
        by_owner = np.argsort(owner, kind="stable")
        owner, shingle = owner[by_owner], shingle[by_owner]
    return owner, shingle


def shingle_sets(hashes: np.ndarray, group: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each group, as (group, shingle) sorted by both."""
    owner, shingle = shingles(hashes, group, size)
    order = grouped_order(owner, shingle)
    owner, shingle = owner[order], shingle[order]
    if len(owner):
        new = np.r_[True, (owner[1:] != owner[:-1]) | (shingle[1:] != shingle[:-1])]
        owner, shingle = owner[new], shingle[new]
    return owner, shingle
