"""Minimal perfect hash over 128-bit keys with compact fingerprint and count arrays.

Levels of bit arrays: each level places the keys that no other key meets at their position and
passes the rest on. A key's index is the number of set bits before its own. An index without a
check would be meaningless for a foreign key, so 32 bits of the key are stored at each index.
"""

from __future__ import annotations

import numpy as np

from candlewick.llm.common import splitmix

GAMMA, LEVELS, MOST_COUNT = 2.0, 64, 0xFFFF


def _positions(a: np.ndarray, b: np.ndarray, level: int, size: int) -> np.ndarray:
    seed = np.uint64(0x9E3779B97F4A7C15 * (2 * level + 1) % (1 << 64))
    return (splitmix(splitmix(a ^ seed) + b) % np.uint64(size)).astype(np.int64)


def check_bits(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (splitmix(a + splitmix(b)) >> np.uint64(32)).astype(np.uint32)


def build(a: np.ndarray, b: np.ndarray, counts: np.ndarray) -> dict[str, bytes]:
    """Serialise distinct keys (a, b: uint64) and their counts, which saturate at 65,535."""
    left, sizes, bits = np.arange(len(a)), [], []
    for level in range(LEVELS):
        if not len(left):
            break
        size = -(-max(64, int(GAMMA * len(left))) // 64) * 64
        at = _positions(a[left], b[left], level, size)
        once = np.bincount(at, minlength=size) == 1
        sizes.append(size)
        bits.append(once)
        left = left[~once[at]]
    if len(left):
        raise ValueError("the keys are not distinct")
    packed = np.packbits(np.concatenate(bits)) if bits else np.empty(0, np.uint8)
    blob = {"sizes": np.array(sizes, np.int64).tobytes(), "bits": packed.tobytes()}
    index = PerfectHash(**blob, checks=b"", counts=b"").index(a, b)
    checks, kept = np.zeros(len(a), np.uint32), np.zeros(len(a), np.uint16)
    checks[index] = check_bits(a, b)
    kept[index] = np.minimum(counts, MOST_COUNT)
    return blob | {"checks": checks.tobytes(), "counts": kept.tobytes()}


class PerfectHash:
    def __init__(self, sizes: bytes, bits: bytes, checks: bytes, counts: bytes):
        self.sizes = np.frombuffer(sizes, np.int64)
        self.bits = np.unpackbits(np.frombuffer(bits, np.uint8)).astype(bool)
        self.rank = np.cumsum(self.bits) - self.bits
        self.checks = np.frombuffer(checks, np.uint32)
        self.counts = np.frombuffer(counts, np.uint16)

    def index(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Index of every key, -1 where no level has a bit for it."""
        out, left, start = np.full(len(a), -1, np.int64), np.arange(len(a)), 0
        for level, size in enumerate(self.sizes.tolist()):
            if not len(left):
                break
            at = start + _positions(a[left], b[left], level, size)
            hit = self.bits[at]
            out[left[hit]] = self.rank[at[hit]]
            left, start = left[~hit], start + size
        return out

    def count(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Stored count of every key, 0 for keys whose check bits differ."""
        index = self.index(a, b)
        out = np.zeros(len(a), np.int64)
        known = np.flatnonzero(index >= 0)
        known = known[self.checks[index[known]] == check_bits(a, b)[known]]
        out[known] = self.counts[index[known]]
        return out
