import random
import re

import pytest
import xxhash

from candlewick.llm import queries as Q, simhash as S
from candlewick.llm.components import components


def slow_fp(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[k:k + 3]).encode(), 42) for k in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(fps, ids):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                root[find(i)] = find(j)
    least = {}
    for i, x in enumerate(ids):
        least.setdefault(find(i), []).append(x)
    return [min((x for x in least[find(i)] if x is not None), default=None) for i in range(len(fps))]


def test_query_matches_brute_force(spark):
    d = "/root/testdata/sf0.01"
    rows = [(r["doc_id"], r["text"]) for r in Q.documents(spark, d).collect()]
    fps = [slow_fp(t) for _, t in rows]
    want = sorted((i, f"{f:016x}", c) for (i, _), f, c in zip(rows, fps, classes(fps, [i for i, _ in rows])))
    assert sorted(map(tuple, Q.op8_simhash(spark, d).collect())) == want
    assert sum(i != c for i, _, c in want) > 10


def test_odd_rows(spark):
    rows = [(None, None), (4, ""), (3, "  \n"), (9, "a b"), (9, "A  b"), (None, "only null"), (7, "x y z " * 9000),
            (8, "x Y z " * 9001), (2, "un deux trois quatre")]
    docs = spark.createDataFrame([(*r, 5) for r in rows], "doc_id long, text string, fp int")
    fps = [slow_fp(t) for _, t in rows]
    want = [(i, f, c) for (i, _), f, c in zip(rows, fps, classes(fps, [i for i, _ in rows]))]
    got = [(r["doc_id"], r["fp"] % (1 << 64), r["component_id"]) for r in S.near_duplicates(docs).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    assert S.near_duplicates(docs.limit(0)).count() == 0


@pytest.mark.parametrize("cell", [4096, 20, 2])
def test_links_of_dense_cells(spark, monkeypatch, cell):
    """Cells above the bound are dealt anew on finer grids and lose no link."""
    monkeypatch.setattr(S, "CELL", cell)
    rng = random.Random(5)
    fps = {0, (1 << 64) - 1}
    for _ in range(12):
        x = rng.getrandbits(64)
        fps.add(x)
        for _ in range(rng.choice([1, 3, 60])):
            y = x
            for b in rng.sample(range(64), rng.choice([1, 2, 3, 4, 6])):
                y ^= 1 << b
            fps.add(y)
    fps = sorted(fps)
    df = spark.createDataFrame([(S._signed(f),) for f in fps], "fp long")
    root = {r["node"] % (1 << 64): r["root"] for r in components(S.links(df)).collect()}
    want = classes(fps, fps)
    for i in range(len(fps)):
        for j in range(i):
            same = root.get(fps[i], (0, i)) == root.get(fps[j], (0, j))
            assert same == (want[i] == want[j])


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 90), (7, 7)], "a long, b long")
    got = {r["node"]: r["root"] for r in components(edges).collect()}
    assert got == {k: 0 for k in range(41)} | {100: 90, 90: 90}
    assert components(edges.limit(0)).count() == 0
