"""An inverted multi-index over integer vectors, in shards, searched by summed half-scores.

The components are halved; each half has a codebook. A row's cell is the pair of its nearest
codewords. For a query q, no row of cell (a, b) has an inner product above

    (q1 . a + |q1| * radius1[a]) + (q2 . b + |q2| * radius2[b])

where a radius is the largest distance of a shard's rows from their codeword. A search sorts both
lists of half-bounds and visits cells in descending order of their sum with a heap (multi-sequence),
until the caller's certificate says that no unvisited row can change its result: so results are
exact, whatever rows the codebooks were fitted on.

Shards hold about ``SHARD_ROWS`` rows, dealt by a hash of the id, each packed into one row of
arrays sorted by cell.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

#: Rows of a shard; codewords of each half; rows that the codebooks are fitted on, those with the
#: smallest hashes of their ids (every row is indexed); rounds of that fit.
SHARD_ROWS, CODEWORDS, SAMPLE, FIT_ROUNDS = 8192, 16, 4096, 8
#: Rows gathered from consecutive cells before their scores are first taken in one product; each
#: further step takes twice as many.
STEP_ROWS = 512


def fit_half(rows: np.ndarray, codewords: int = CODEWORDS) -> np.ndarray:
    """Lloyd's rounds from evenly spaced rows."""
    if not len(rows):
        return np.zeros((1, rows.shape[1]))
    book = rows[np.linspace(0, len(rows) - 1, min(codewords, len(rows))).astype(np.int64)]
    for _ in range(FIT_ROUNDS):
        code = nearest_code(rows, book)[0]
        for k in np.unique(code):
            book[k] = rows[code == k].mean(axis=0)
    return book


def nearest_code(rows: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(codeword, distance) of every row."""
    code = ((book ** 2).sum(axis=1) - 2 * rows @ book.T).argmin(axis=1)
    return code, np.sqrt(((rows - book[code]) ** 2).sum(axis=1))


def fit_codebooks(rows: DataFrame, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Codebooks of both halves from the ``SAMPLE`` rows with the smallest hashes."""
    some = rows.select("vec", F.xxhash64(F.lit("sample"), "id").alias("h"), "id").orderBy("h", "id").limit(SAMPLE)
    found = np.array([r["vec"] for r in some.collect()], np.float64).reshape(-1, dims)
    return fit_half(found[:, :dims // 2]), fit_half(found[:, dims // 2:])


SHARD = StructType([StructField("shard", LongType())] + [StructField(n, BinaryType()) for n in
                   ("ids", "labels", "vectors", "starts", "radius_a", "radius_b")])


def build_shards(rows: DataFrame, books: tuple[np.ndarray, np.ndarray], shards: int) -> DataFrame:
    """One packed row a shard of ``rows`` (id, label, vec)."""
    a, b = books

    def pack(table: pa.Table) -> pa.Table:
        ids = table.column("id").to_numpy().astype(np.int64)
        labels = table.column("label").to_numpy().astype(np.int64)
        vectors = table.column("vec").combine_chunks().flatten().to_numpy().astype(np.int32).reshape(len(ids), -1)
        half = vectors.shape[1] // 2
        code_a, far_a = nearest_code(vectors[:, :half].astype(np.float64), a)
        code_b, far_b = nearest_code(vectors[:, half:].astype(np.float64), b)
        radius_a, radius_b = np.full(len(a), -1.0), np.full(len(b), -1.0)
        np.maximum.at(radius_a, code_a, far_a)
        np.maximum.at(radius_b, code_b, far_b)
        cell = code_a * len(b) + code_b
        order = np.lexsort((ids, cell))
        starts = np.searchsorted(cell[order], np.arange(len(a) * len(b) + 1)).astype(np.int64)
        blobs = [ids[order], labels[order], vectors[order], starts, radius_a, radius_b]
        return pa.table({"shard": pa.array([table.column("shard")[0].as_py()], pa.int64())}
                        | {f.name: pa.array([x.tobytes()], pa.binary()) for f, x in zip(SHARD.fields[1:], blobs)})

    dealt = rows.select(F.pmod(F.xxhash64("id"), F.lit(shards)).alias("shard"), "id", "label", "vec")
    return dealt.groupBy("shard").applyInArrow(pack, SHARD)


def shard_count(n_rows: int) -> int:
    return max(1, math.ceil(n_rows / SHARD_ROWS))


@dataclass
class Shard:
    """An unpacked shard."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    starts: list[int]
    books: tuple[np.ndarray, np.ndarray]
    radii: tuple[np.ndarray, np.ndarray]
    exact: bool

    @classmethod
    def unpack(cls, blobs: list[bytes], books: tuple[np.ndarray, np.ndarray], dims: int) -> Shard:
        kinds = (np.int64, np.int64, np.int32, np.int64, np.float64, np.float64)
        ids, labels, vectors, starts, ra, rb = (np.frombuffer(x, k) for x, k in zip(blobs, kinds))
        vectors = vectors.reshape(-1, dims)
        most = int(np.abs(vectors.astype(np.int64)).max(initial=0))
        # doubles hold every partial sum exactly up to 2**53; beyond, integers are multiplied
        small = most * most * dims < 1 << 53
        return cls(ids, labels, vectors.astype(np.float64 if small else np.int64), starts.tolist(), books, (ra, rb), small)

    def scores(self, rows: np.ndarray | slice, query: np.ndarray) -> np.ndarray:
        most = int(np.abs(query).max(initial=0))
        if self.exact and most * most * len(query) < 1 << 53:
            return (self.vectors[rows] @ query.astype(np.float64)).astype(np.int64)
        return self.vectors[rows].astype(np.int64) @ query

    def half_bounds(self, query: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each half the codewords that have rows, by descending bound, and the bounds."""
        out, half = [], len(query) // 2
        for part, book, radius in zip((query[:half], query[half:]), self.books, self.radii):
            part = part.astype(np.float64)
            norm = math.sqrt(part @ part)
            bound = book @ part + norm * radius
            # rounding errors of the bound never cut a row off
            bound += 1e-9 * (norm * (np.sqrt((book ** 2).sum(axis=1)) + radius) + 1)
            there = np.flatnonzero(radius >= 0)
            order = there[np.argsort(-bound[there], kind="stable")]
            out.append((order, bound[order]))
        return out

    def visit(self, query: np.ndarray) -> Iterator[tuple[float, np.ndarray, np.ndarray]]:
        """(bound of all that is left, rows, scores) of cells by descending bound."""
        (ka, ba), (kb, bb) = ([x.tolist() for x in half] for half in self.half_bounds(query))
        if not ka or not kb:
            return
        heap, width, starts, step = [(-(ba[0] + bb[0]), 0, 0)], len(self.books[1]), self.starts, STEP_ROWS
        while heap:
            parts, n = [], 0
            while heap and n < step:
                _, i, j = heapq.heappop(heap)
                cell = ka[i] * width + kb[j]
                lo, hi = starts[cell], starts[cell + 1]
                if hi > lo:
                    parts.append(np.arange(lo, hi))
                    n += hi - lo
                # only (i, 0) leads to (i + 1, 0), so every cell enters the heap once
                if j + 1 < len(kb):
                    heapq.heappush(heap, (-(ba[i] + bb[j + 1]), i, j + 1))
                if j == 0 and i + 1 < len(ka):
                    heapq.heappush(heap, (-(ba[i + 1] + bb[0]), i + 1, 0))
            left = -heap[0][0] if heap else -math.inf
            rows = np.concatenate(parts) if parts else np.empty(0, np.int64)
            yield left, rows, self.scores(rows, query)
            step *= 2
