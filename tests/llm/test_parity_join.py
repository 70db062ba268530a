import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from candlewick.llm import parity_join as P

SCHEMA = "doc_id long, text string"


def grams(text, words=3):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\v\f\r":
        low = low.replace(c, " ")
    parts = [w for w in low.split(" ") if w]
    if not parts:
        return frozenset()
    k = min(words, len(parts))
    return frozenset(tuple(parts[i:i + k]) for i in range(len(parts) - k + 1))


def brute(rows, num=90, den=100):
    sets = [grams(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, a in enumerate(sets):
        for j in range(i):
            if a and den * len(a & sets[j]) >= num * len(a | sets[j]):
                root[find(i)] = find(j)
    groups = {}
    for k, (i, _) in enumerate(rows):
        groups.setdefault(find(k), []).append(i)
    least = {k: min((i for i in g if i is not None), default=None) for k, g in groups.items()}
    return sorted(((i, len(sets[k]), least[find(k)]) for k, (i, _) in enumerate(rows)), key=str)


def joined(spark, rows, **kw):
    df = spark.createDataFrame(rows, SCHEMA)
    return sorted(map(tuple, P.near_sets(df, **kw).collect()), key=str)


def families(seed, texts, copies, edits, vocabulary=400):
    """Texts with copies of which each has a few words changed; some copies link, some don't."""
    rnd = random.Random(seed)
    word = lambda: f"w{rnd.randrange(vocabulary)}"
    rows = []
    for _ in range(texts):
        base = [word() for _ in range(rnd.choice([4, 9, 11, 12, 20, 35, 60, 120, 300]))]
        for _ in range(copies):
            own = list(base)
            for _ in range(rnd.randrange(edits + 1)):
                own[rnd.randrange(len(own))] = word()
            rows.append((len(rows) * 7 % 10007, " ".join(own)))
    return rows


@pytest.mark.parametrize("cell", [3, P.CELL])
def test_equals_brute_force(spark, cell):
    rows = families(cell, 12, 14, 6) + families(99, 40, 1, 0)
    found = joined(spark, rows, cell=cell)
    assert found == brute(rows)
    assert len({r[2] for r in found}) < len(rows)


def test_one_large_family_of_partly_linked_copies(spark):
    rows = families(4, 1, 150, 9)
    assert joined(spark, rows, cell=20) == brute(rows)


@pytest.mark.parametrize("num,den", [(1, 1), (4, 5), (1, 2)])
def test_other_likenesses(spark, num, den):
    rows = families(num + den, 8, 8, 5)
    assert joined(spark, rows, num=num, den=den) == brute(rows, num, den)


def test_nulls_empties_case_spaces_ties_and_repeats(spark):
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "One"), (5, "one"), (6, "one two"), (7, "ONE\vTWO"), (8, "one two three"),
            (8, "one two three"), (9, "one  two\nthree"), (None, "ONE TWO THREE"), (None, "lonely words here"),
            (10, "a b c a b c a b c"), (11, "a b c a b c"), (12, "É b c"), (13, "é b c")]
    assert joined(spark, rows) == brute(rows)


def test_empty_table_long_text_and_clashing_columns(spark):
    assert joined(spark, []) == []
    assert joined(spark, [(1, None)]) == [(1, 0, 1)]
    long = " ".join(f"x{k}" for k in range(60_000))
    rows = [(5, long + " end"), (3, long), (9, "x1 x2 x3 x4")]
    assert joined(spark, rows) == [(3, 59998, 3), (5, 59999, 3), (9, 2, 9)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns(
        {c: F.lit("own") for c in ("id", "n", "node", "cells", "key_a", "set_a", "component_id", "grams")})
    assert sorted(map(tuple, P.near_sets(df).collect())) == [(3, 59998, 3), (5, 59999, 3), (9, 2, 9)]


def test_linked_sets_share_a_cell():
    rng = np.random.default_rng(1)
    bands = P.Bands(90, 100)
    for n in [9, 10, 18, 19, 20, 57, 100, 999, 5000]:
        a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        for extra in {1, max(1, n // 19), n // 9}:           # add, drop and swap as many as allowed
            for b in (np.concatenate([a, rng.integers(0, 1 << 63, extra).astype(np.uint64)]), a[extra:],
                      np.concatenate([a[extra // 2:], rng.integers(0, 1 << 63, extra // 2).astype(np.uint64)])):
                b = np.unique(b)
                d = len(np.setxor1d(a, b))
                if len(b) and P.linked(len(a), len(b), d, 90, 100) and d:
                    assert len(np.intersect1d(bands.cells(a), bands.cells(b)))


def test_the_sketch_distance_is_a_lower_bound():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 1 << 63, rng.integers(0, 300)).astype(np.uint64)) for _ in range(30)]
    s = P.sketches(sets, 512)
    for i in range(30):
        for j in range(i):
            assert np.bitwise_count(s[i] ^ s[j]).sum() <= len(np.setxor1d(sets[i], sets[j]))


def test_runs_across_batches():
    rows = [(1, 5), (2, 1), (2, 3), (2, 4), (3, 9), (4, 1), (4, 2)] + [(5, k) for k in range(10)] + [(6, 1)]
    import pyarrow as pa
    for width in (1, 2, 3, 5, 40):
        batches = [pa.RecordBatch.from_pydict({"cell": [r[0] for r in part], "node": [r[1] for r in part],
                                               "n": [10] * len(part)}) for part in
                   (rows[k:k + width] for k in range(0, len(rows), width))]
        out = [r for b in P._meet(4)(batches) for r in b.to_pylist()]
        assert [(r["cell"], r["chunk"], r["many"], r["pivot"], r["members"]) for r in out] == [
            (2, 0, False, 1, [1, 3, 4]), (4, 0, False, 1, [1, 2]), (5, 0, True, 0, [0, 1, 2, 3]),
            (5, 1, True, 0, [4, 5, 6, 7]), (5, 2, True, 0, [8, 9])]
