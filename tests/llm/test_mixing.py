import math
import re

import pytest
from pyspark.sql import functions as F

from candlewick.llm import mixing as M, queries as Q


def size(t):
    return len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))


def targets_of(sizes, weights=(3.0, 1.0, 2.0), total=1.5, most=2.0):
    """Targets of sources in order, by the rule read one source at a time."""
    weight = [weights[k % len(weights)] for k in range(len(sizes))]
    left, open_, out = total * sum(sizes), set(range(len(sizes))), [0.0] * len(sizes)
    while open_:
        unit = left / sum(weight[k] for k in open_)
        full = {k for k in open_ if unit * weight[k] >= most * sizes[k]}
        for k in full or open_:
            out[k] = most * sizes[k] if full else unit * weight[k]
        left -= sum(out[k] for k in full)
        open_ = open_ - full if full else set()
    return out


def check(got, rows):
    """rows: (doc_id, text, source); got has one row for each."""
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + size(t)
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    targets = dict(zip(order, targets_of([sizes[s] for s in order])))
    assert len(got) == len(rows)
    taken, most, by = {}, {}, {}
    for r in got:
        s = r["source"]
        assert r["source_size"] == sizes[s] and math.isclose(r["target"], targets[s], abs_tol=1e-9)
        assert r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= 2
        assert abs(r["copies"] - r["rate"]) < 1 + 1e-9
        taken[s] = taken.get(s, 0) + r["taken"]
        most[s] = max(most.get(s, 0), r["size"])
        by.setdefault(s, []).append((r["size"], r["rate"]))
    for s in order:
        assert abs(taken[s] - targets[s]) <= most[s] + 1e-6, s
        # the constraint holds in the rates, and their logs are proportional to size
        assert math.isclose(sum(a * b for a, b in by[s]), targets[s], rel_tol=1e-6, abs_tol=1e-6)
        free = [math.log(b) / a for a, b in by[s] if a and b < 2 - 1e-9]
        if free:
            assert max(free) - min(free) < 1e-9 + 1e-6 * abs(free[0])


def test_query(spark):
    d = "/root/testdata/sf0.01"
    src = {r["doc_id"]: r for r in Q.documents(spark, d).collect()}
    got = Q.op9_mixing(spark, d).collect()
    rows = [(r["doc_id"], r["text"], r["source"]) for r in src.values()]
    check([r.asDict() | {"source": src[r["doc_id"]]["source"]} for r in got], rows)
    assert sorted(got) == sorted(Q.op9_mixing(spark, d).collect())


def test_odd_rows(spark):
    rows = [(1, None, "a"), (1, "x y", "a"), (1, "x y", "a"), (None, "", None), (2, "w " * 5000, None),
            (3, "one two three", "b"), (4, "p q", "b"), (5, "", "c"), (6, "é ê\x0bë", "é")]
    rows += [(10 + i, "t " * (i % 7), "big") for i in range(200)]
    docs = spark.createDataFrame([(*r, "keep") for r in rows], "doc_id long, text string, source string, SIZE string")
    out = M.mix(docs)
    assert out.columns[:3] == ["doc_id", "text", "source"] and "SIZE" not in out.columns
    got = out.collect()
    check(got, rows)
    back = M.repeat_copies(out, ["doc_id", "text", "source"])
    assert back.count() == sum(r["copies"] for r in got)
    assert M.mix(docs.limit(0)).count() == 0


def test_order_of_rows_is_no_input(spark):
    docs = Q.documents(spark, "/root/testdata/sf0.001").select("doc_id", "text", "source")
    order = docs.repartition(7, "text").sortWithinPartitions(M.F.desc("doc_id"))
    columns = ["doc_id", "rate", "copies", "taken"]
    assert (sorted(map(tuple, M.mix(docs).select(columns).collect()))
            == sorted(map(tuple, M.mix(order).select(columns).collect())))


@pytest.mark.parametrize("sizes", [[10, 10, 10], [1, 100, 1], [0, 0], [5], [7, 0, 3, 1000],
                                   [3 ** k for k in range(12)], [2 ** (11 - k) for k in range(12)]])
def test_targets(spark, sizes):
    table = spark.createDataFrame([(f"s{k:03d}", n) for k, n in enumerate(sizes)], "source_key string, words long")
    t = [r["target"] for r in M.source_targets(table).orderBy("source_key").collect()]
    assert all(math.isclose(a, b, rel_tol=1e-12, abs_tol=1e-9) for a, b in zip(t, targets_of(sizes)))
    assert all(a <= 2 * b + 1e-9 for a, b in zip(t, sizes))
    assert math.isclose(sum(t), 1.5 * sum(sizes), abs_tol=1e-9)


def test_a_hundred_thousand_sources(spark):
    n = 100_000
    docs = spark.range(2 * n).select(
        F.col("id").alias("doc_id"), F.repeat(F.lit("w "), (F.col("id") % 5).cast("int")).alias("text"),
        F.format_string("%07d", F.col("id") % n).alias("source"))
    out = M.mix(docs).drop("text").toPandas()
    assert len(out) == 2 * n and out["copies"].between(0, 2).all()
    by = out.groupby("source").agg(size=("source_size", "first"), own=("size", "sum"), target=("target", "first"),
                                   taken=("taken", "sum"), most=("size", "max"))
    assert len(by) == n and (by["size"] == by["own"]).all()
    assert by["target"].tolist() == pytest.approx(targets_of(by["size"].tolist()))
    assert ((by["taken"] - by["target"]).abs() <= by["most"] + 1e-6).all()
