"""Document fingerprints by content-defined chunking.

A gear hash runs over the UTF-8 bytes (6-byte window, the shortest chunk). A chunk ends where the hash matches a
mask: a strict one below the normal size, a loose one beyond it (normalised chunking), at the
latest at the longest size. Boundaries depend on nearby bytes only, so an edit changes the
chunks around it and leaves the others. The sizes hold for all texts; they are small enough that a
text of some 40 bytes has several chunks. The fingerprint is the set of chunk digests with their
lengths: numbers of 48 bits of XXH3 and 6 of the length, ascending, written as 9 characters of 6 bits
each (``ALPHABET``, in the order of its characters) with nothing between them.

Likeness of two fingerprints is their weighted containment: the bytes in common chunks over the
bytes in distinct chunks of the smaller side; two empty texts are alike (1), an empty and another
text are not (0). Null texts count as empty; repeated rows and ties get equal fingerprints; very
long texts are chunked whole.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql.types import StringType, StructField

from candlewick.llm import common as C

SHORTEST, NORMAL, LONGEST = 6, 12, 48
STRICT_BITS, LOOSE_BITS = 4, 2
#: The top 6 bits only: a byte leaves the hash after 6 shifts, so no byte before the chunk counts.
GEAR = (C.splitmix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        >> np.uint64(64 - SHORTEST)).astype(np.uint32) << np.uint32(32 - SHORTEST)


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """h[i] = sum of GEAR[data[i - k]] << k over the last 8 bytes, by doubling; GEAR's low
    bits are 0, so those from the seventh on add nothing."""
    h = GEAR[data]
    for k in (1, 2, 4):
        shifted = np.zeros_like(h)
        shifted[k:] = h[:-k] << np.uint32(k)
        h = h + shifted
    return h


def chunked(texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For every text its chunks in order: numbers (digest and length) and ends in bytes."""
    data = b"".join(texts)
    h = gear_hashes(np.frombuffer(data, np.uint8))
    loose = np.flatnonzero(h < np.uint32(1 << 32 - LOOSE_BITS))
    strict = loose[h[loose] < np.uint32(1 << 32 - STRICT_BITS)].tolist()
    loose = loose.tolist()
    strict.append(1 << 62)
    loose.append(1 << 62)
    digest, out, start = xxhash.xxh3_64_intdigest, [], 0
    for t in texts:
        first, end, numbers, ends = start, start + len(t), [], []
        while start < end:
            cut = strict[bisect_left(strict, start + SHORTEST - 1)] + 1
            if cut > start + NORMAL:
                cut = min(loose[bisect_left(loose, start + NORMAL)] + 1, start + LONGEST)
            cut = min(cut, end)
            numbers.append(digest(data[start:cut]))
            ends.append(cut)
            start = cut
        ends = np.array(ends, np.int64)
        sizes = np.diff(ends, prepend=first).astype(np.uint64)
        out.append(((np.array(numbers, np.uint64) >> np.uint64(16)) << np.uint64(6) | sizes, ends - first))
    return out


def chunk_sets(texts: list[bytes]) -> list[np.ndarray]:
    """For every text the ascending numbers of its distinct chunks."""
    return [np.unique(numbers) for numbers, _ in chunked(texts)]


def edited_sets(own: list[tuple[np.ndarray, np.ndarray]], kept: list[int], edited: list[bytes]) -> list[np.ndarray]:
    """``chunk_sets`` of texts that keep their first ``kept`` bytes of the ``own`` (``chunked``) ones:
    chunks that end there are the same, and chunking goes on after the last of them."""
    same = [int(np.searchsorted(ends, k, side="right")) for (_, ends), k in zip(own, kept)]
    # the end of the old text is no boundary of the new one
    same = [n - (n > 0 and n == len(ends) and ends[-1] < len(t)) for n, (_, ends), t in zip(same, own, edited)]
    starts = [int(ends[n - 1]) if n else 0 for n, (_, ends) in zip(same, own)]
    rest = chunked([t[a:] for t, a in zip(edited, starts)])
    return [np.unique(np.concatenate([numbers[:n], new])) for n, (numbers, _), (new, _) in zip(same, own, rest)]


#: Ascending in ASCII, so that fingerprints sort as their numbers.
ALPHABET = np.frombuffer(b"-0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ_abcdefghijklmnopqrstuvwxyz", np.uint8)
SHIFTS = np.arange(48, -1, -6, dtype=np.uint64)


def as_text(chunks: np.ndarray) -> str:
    return ALPHABET[(chunks[:, None] >> SHIFTS & np.uint64(63)).astype(np.int64)].tobytes().decode()


def parse(fingerprint: str) -> np.ndarray:
    six = np.searchsorted(ALPHABET, np.frombuffer(fingerprint.encode(), np.uint8)).astype(np.uint64)
    return (six.reshape(-1, len(SHIFTS)) << SHIFTS).sum(axis=1, dtype=np.uint64)


def weight(chunks: np.ndarray) -> int:
    """Bytes in the chunks."""
    return int((chunks & np.uint64(63)).sum())


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    return weight(np.intersect1d(a, b, assume_unique=True)) / min(weight(a), weight(b))


def fingerprints(docs: DataFrame, text_col: str = "text",
                 out_col: str = "fingerprint") -> DataFrame:
    """Append every text's fingerprint; extra columns stay, one named ``out_col`` is replaced."""
    def make():
        return lambda texts: [pa.array(list(map(as_text, chunk_sets(texts))), pa.string())]

    return C.with_text_columns(docs, text_col, [StructField(out_col, StringType())], make)
