"""Content-defined anchors of all long windows of a text.

The anchor of a window of ``WINDOW`` bytes is its leftmost position whose ``GRAM``-byte string
has the least hash. Equal windows have their anchors at equal offsets, wherever they stand, so
equal windows can be found among windows with equal strings at their anchors. Neighbouring
windows mostly share their anchor: a text has about two anchors for every ``WINDOW - GRAM``
bytes, each with the range of windows it stands for.
"""

from __future__ import annotations

import numpy as np
import xxhash

from candlewick.llm.common import splitmix

WINDOW, GRAM = 400, 128
PRIME = 0x9E3779B97F4A7C15
BYTE = splitmix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes from every position, by doubling (positions near the end hash
    what is left)."""
    h, size, power = BYTE[data], 1, PRIME
    while size < GRAM:
        longer = h * np.uint64(power)
        longer[:-size] += h[size:]
        h, size, power = longer, 2 * size, power * power % (1 << 64)
    return h


def anchors(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """For every text its anchors in order: arrays (text number, anchor, first and last window
    start, gram hash), positions from the start of the text."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(sizes)
    data = np.frombuffer(b"".join(texts), np.uint8)
    starts = np.maximum(sizes - WINDOW + 1, 0)               # windows of each text
    n = int(starts.sum())
    if not n:
        return tuple(np.empty(0, np.int64) for _ in range(4)) + (np.empty(0, np.uint64),)
    h = gram_hashes(data)
    least = (splitmix(h) & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
    width, size = WINDOW - GRAM + 1, 1
    while 2 * size <= width:
        shorter = least.copy()
        np.minimum(least[:-size], least[size:], out=shorter[:-size])
        least, size = shorter, 2 * size
    owner = np.repeat(np.arange(len(texts)), starts)
    at = np.arange(n) - np.repeat(np.cumsum(starts) - starts, starts) + np.repeat(ends - sizes, starts)
    anchor = (np.minimum(least[at], least[at + width - size]) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.flatnonzero((np.diff(anchor, prepend=-1) != 0) | (np.diff(owner, prepend=-1) != 0))
    last = np.append(new[1:], n) - 1
    text, base = owner[new], (ends - sizes)[owner[new]]
    return text, anchor[new] - base, at[new] - base, at[last] - base, splitmix(h[anchor[new]])


def digest(data: bytes) -> int:
    return xxhash.xxh3_64_intdigest(data) - (1 << 63)
