import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from candlewick.llm import centroids as M

SCHEMA = "vec_id long, embedding array<double>"


def brute(rows, clusters=16, rounds=3, dims=4, scale=64):
    kept = []
    for i, x in rows:
        if x is None or len(x) != dims or any(v is None or not np.isfinite(v) for v in x):
            continue
        kept.append((i, [max(min(int(np.floor(scale * v)), M.MOST), -M.MOST) for v in x]))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    order = sorted(kept, key=lambda r: (sha(f"1:{'' if r[0] is None else r[0]}"), r[1]))
    cents = [r[1] for r in order[:clusters]]
    near = lambda x: min(((sum((a - b) ** 2 for a, b in zip(x, c)), k) for k, c in enumerate(cents)))
    for _ in range(rounds):
        groups = {}
        for _, x in kept:
            groups.setdefault(near(x)[1], []).append(x)
        for k, g in groups.items():
            cents[k] = [sum(c) // len(g) for c in zip(*g)]
    got = [(i, *near(x)[::-1]) for i, x in kept]
    inertia = [sum(s for _, k, s in got if k == j) for j in range(len(cents))]
    out = [(i, k, s, inertia[k], sum(inertia), sha(",".join(map(str, cents[k])))) for i, k, s in got]
    return sorted(out, key=str)


def clustered(spark, rows, **kw):
    df = spark.createDataFrame(rows, SCHEMA)
    return sorted(map(tuple, M.cluster(df, **{"dims": 4} | kw).collect()), key=str)


def test_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = [(k, rng.normal(size=4).tolist()) for k in range(3000)]
    assert clustered(spark, rows) == brute(rows)


@pytest.mark.parametrize("clusters,rounds", [(1, 2), (5, 0), (40, 2)])
def test_other_parameters(spark, clusters, rounds):
    rng = np.random.default_rng(clusters)
    rows = [(k, rng.normal(size=4).tolist()) for k in range(60)]
    assert clustered(spark, rows, clusters=clusters, rounds=rounds) == brute(rows, clusters, rounds)


def test_ties_repeats_nulls_and_odd_values(spark):
    rows = [(k // 2, [0.25 * (k % 3), 0.0, -0.25, 1.0]) for k in range(60)]
    rows += [(7, None), (8, [0.1, None, 0.1, 0.1]), (9, [float("nan"), 0.0, 0.0, 0.0]),
             (10, [float("-inf"), 0.0, 0.0, 0.0]), (11, [0.1]), (12, []), (13, [1e30, -1e30, 0.0, 2e6]),
             (None, [1.0, 1.0, 1.0, 1.0])]
    assert clustered(spark, rows) == brute(rows)


def test_few_and_no_rows_and_clashing_columns(spark):
    rows = [(k, [float(k), 0.0, 0.0, 0.0]) for k in range(3)]
    assert clustered(spark, rows) == brute(rows)
    assert clustered(spark, []) == []
    assert clustered(spark, [(1, [1.0])]) == []
    df = spark.createDataFrame(rows, SCHEMA).withColumns(
        {n: F.lit("own") for n in ("id", "vec", "x", "cluster", "distance", "inertia")})
    assert sorted(map(tuple, M.cluster(df, dims=4).collect()), key=str) == brute(rows)


def test_a_table_gather_is_the_squared_distance():
    rng = np.random.default_rng(1)
    values = rng.integers(-50, 50, (200, 5)).astype(np.int32)
    cents = rng.integers(-50, 50, (7, 5))
    cluster, distance = M.nearest(values, cents)
    full = ((values[:, None, :].astype(np.int64) - cents[None]) ** 2).sum(axis=2)
    assert np.array_equal(distance, full.min(axis=1)) and np.array_equal(cluster, full.argmin(axis=1))
