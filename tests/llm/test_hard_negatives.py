import numpy as np
import pytest
from pyspark.sql import functions as F

from candlewick.llm import hard_negatives as H
from candlewick.llm import multi_index as M

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, anchor, dims, positives=5, negatives=5):
    """Score every pair; rows: (id, label, components)."""
    ok = {}
    for i, label, x in rows:
        if i is None or label is None or x is None or len(x) != dims:
            continue
        if any(v is None or not np.isfinite(v) for v in x):
            continue
        r = (label, [max(min(int(np.floor(256 * v)), 1 << 27), -(1 << 27)) for v in x])
        ok[i] = min(ok.get(i, r), r)
    score = lambda a, b: sum(p * q for p, q in zip(a[1], b[1]))
    out = []
    for i, own in ok.items():
        if not anchor(i):
            continue
        other = sorted(((-score(own, r), k, r[0]) for k, r in ok.items() if k != i))
        for s, p, _ in [x for x in other if x[2] == own[0]][:positives]:
            window = [x for x in other if x[2] != own[0] and 80 * -s <= 100 * -x[0] <= 100 * -s]
            out += [(i, p, n + 1, x[1], -s, -x[0]) for n, x in enumerate(window[:negatives])]
    return sorted(out)


def mined(spark, rows, **kw):
    df = spark.createDataFrame([(i, x, l) for i, l, x in rows], SCHEMA)
    return sorted(map(tuple, H.mine(H.prepared(df), F.col("id") % 10 == 0, **kw).collect()))


def clustered(n, dims, seed, labels=3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dims))
    return [(k, int(rng.integers(labels)), (centres[k % 6] + 0.3 * rng.normal(size=dims)).tolist())
            for k in range(n)]


def test_equals_brute_force_over_shards_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(M, "SHARD_ROWS", 60)
    monkeypatch.setattr(H, "BLOCK_ANCHORS", 7)
    rows = clustered(400, 10, 1)
    assert mined(spark, rows) == brute(rows, lambda i: i % 10 == 0, 10)


def test_ties_repeats_nulls_and_odd_values(spark):
    same = [0.5, 0.25, 0.5]
    rows = [(k, k % 2, same) for k in range(40)]                     # all scores tie
    rows += [(3, 0, [0.1, 0.1, 0.1]), (0, 1, [9.0, 9.0, 9.0])]       # repeated ids: the least counts
    rows += [(50, None, same), (None, 1, same), (60, 1, None), (70, 0, [0.1, None, 0.2]),
             (80, 0, [float("nan"), 0.1, 0.2]), (90, 1, [float("inf"), 0.1, 0.2]),
             (100, 0, [0.1, 0.2]), (110, 1, []), (120, 0, [1e30, -1e30, 0.0]),
             (130, 1, [-0.5, -0.5, -0.5]), (140, 1, [0.0, 0.0, 0.0])]
    found = mined(spark, rows)
    assert found == brute(rows, lambda i: i % 10 == 0, 3)
    assert {r[0] for r in found} >= {0, 10, 20, 30} and not {r[0] for r in found} & {50, 60, 70, 80, 90, 100, 110}


def test_empty_tables_and_clashing_columns(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(10, 1, [float("nan")])]) == []
    rows = clustered(60, 4, 2)
    df = (spark.createDataFrame([(i, x, l) for i, l, x in rows], SCHEMA)
          .withColumns({n: F.lit("own") for n in ("id", "vec", "shard", "block", "slot", "rank", "x")}))
    found = sorted(map(tuple, H.mine(H.prepared(df), F.col("id") % 10 == 0).collect()))
    assert found == brute(rows, lambda i: i % 10 == 0, 4)
    assert H.mine(H.prepared(df), F.lit(False)).count() == 0


@pytest.mark.parametrize("dims", [1, 2, 7, 64])
def test_bounds_hold_and_cells_come_in_order(dims):
    rng = np.random.default_rng(dims)
    rows = rng.integers(-200, 200, (500, dims)).astype(np.int32)
    books = (M.fit_half(rows[:, :dims // 2].astype(float)), M.fit_half(rows[:, dims // 2:].astype(float)))
    shard = packed(rows, books)
    for _ in range(5):
        query = rng.integers(-200, 200, dims)
        seen, lefts = [], []
        for left, at, scores in shard.visit(query):
            assert np.array_equal(scores, shard.vectors[at].astype(np.int64) @ query)
            seen.append(at)
            rest = np.setdiff1d(np.arange(500), np.concatenate(seen))
            assert not len(rest) or (shard.vectors[rest].astype(np.int64) @ query).max() <= left
            lefts.append(left)
        assert len(np.concatenate(seen)) == 500 == len(np.unique(np.concatenate(seen)))
        assert lefts == sorted(lefts, reverse=True)


def packed(rows, books):
    half, n = rows.shape[1] // 2, len(rows)
    (ca, fa), (cb, fb) = (M.nearest_code(x.astype(float), b) for x, b in zip((rows[:, :half], rows[:, half:]), books))
    ra, rb = np.full(len(books[0]), -1.0), np.full(len(books[1]), -1.0)
    np.maximum.at(ra, ca, fa)
    np.maximum.at(rb, cb, fb)
    cell = ca * len(books[1]) + cb
    order = np.argsort(cell, kind="stable")
    starts = np.searchsorted(cell[order], np.arange(len(books[0]) * len(books[1]) + 1)).astype(np.int64)
    blobs = (np.arange(n), np.zeros(n, np.int64), rows[order], starts, ra, rb)
    return M.Shard.unpack([x.tobytes() for x in blobs], books, rows.shape[1])


def test_certified_search_stops_early_on_clustered_rows():
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(16, 16)) * 300
    rows = np.concatenate([(c + rng.normal(size=(400, 16))).astype(np.int32) for c in centres])
    books = (M.fit_half(rows[::7, :8].astype(float)), M.fit_half(rows[::7, 8:].astype(float)))
    shard = packed(rows, books)
    visited, query = 0, rows[0].astype(np.int64)
    for left, at, scores in shard.visit(query):
        visited += len(at)
        if np.sort(scores)[-5] > left:
            break
    assert visited < len(rows) / 4
