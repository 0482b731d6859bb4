"""Minimal perfect hashing of 64-bit keys, built shard by shard and looked up for all shards at once.

A shard places its keys in levels of bits, twice as many as there are keys left: a key that no other one
meets at its place stays, the others go on to the next level. The n-th set bit of all levels is slot n,
so n keys get the slots 0 to n - 1. A key that was never placed may find a slot too: whoever looks up
keys that may be others compares them with the key kept for the slot.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from saltmarsh.llm import textarrays as ta

U = np.uint64
#: Shards are told apart by the upper bits of a hash of the key, so each has about the same share of the keys.
SHARD_BITS = 10
SHARDS = 1 << SHARD_BITS
_LEVELS = 64


def shard_of(keys: np.ndarray) -> np.ndarray:
    return (ta.mix(keys, 101) >> U(64 - SHARD_BITS)).astype(np.int64)


def _place(keys: np.ndarray, level: int, size: np.ndarray | int) -> np.ndarray:
    return (ta.mix(keys, level) % np.asarray(size, dtype=U)).astype(np.int64)


@dataclass
class Levels:
    """The levels of one shard: their sizes, and the bits of all of them."""

    sizes: list[int]
    bits: np.ndarray

    @classmethod
    def build(cls, keys: np.ndarray) -> Levels:
        """Of distinct keys."""
        sizes, bits, left = [], [], keys
        while len(left):
            if len(sizes) == _LEVELS:
                raise ValueError("keys repeat")
            size = 2 * len(left)
            at = _place(left, len(sizes), size)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            bits.append(alone)
            left = left[~alone[at]]
        return cls(sizes, np.concatenate(bits) if bits else np.zeros(0, dtype=bool))

    def dump(self) -> tuple[bytes, bytes]:
        return np.array(self.sizes, dtype="<u4").tobytes(), np.packbits(self.bits).tobytes()

    @classmethod
    def load(cls, sizes: bytes, bits: bytes) -> Levels:
        n = np.frombuffer(sizes, dtype="<u4").astype(np.int64)
        return cls(n.tolist(), np.unpackbits(np.frombuffer(bits, dtype=np.uint8), count=int(n.sum())).astype(bool))


class PerfectHash:
    """Slots of the keys of some shards: 0 to the number of their keys - 1, shard by shard."""

    def __init__(self, shards: dict[int, Levels]):
        deep = max([len(s.sizes) for s in shards.values()], default=0)
        self.size = np.zeros((deep, SHARDS), dtype=np.int64)
        self.start = np.zeros((deep, SHARDS), dtype=np.int64)
        at, bits = 0, []
        for number in sorted(shards):
            for level, size in enumerate(shards[number].sizes):
                self.size[level, number], self.start[level, number] = size, at
                at += size
            bits.append(shards[number].bits)
        self.bits = np.concatenate(bits) if bits else np.zeros(0, dtype=bool)
        self.before = np.cumsum(self.bits, dtype=np.int64 if len(self.bits) > 2**31 else np.int32) - self.bits

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; -1 for some of those that were never placed."""
        out = np.full(len(keys), -1, dtype=np.int64)
        left, where = np.arange(len(keys)), shard_of(keys)
        for level in range(len(self.size)):
            size = self.size[level][where[left]]
            left = left[size > 0]
            if not len(left):
                break
            at = self.start[level][where[left]] + _place(keys[left], level, size[size > 0])
            found = self.bits[at]
            out[left[found]] = self.before[at[found]]
            left = left[~found]
        return out
