import re
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import pytest

from candlewick.llm import line_dedup as D, perfect_hash as P, queries as Q


def brute(rows, least):
    """rows: (id, text) -> (id, kept text, lines, dropped)."""
    low = {c: c + 32 for c in range(65, 91)}
    key = lambda l: re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+\Z", "", l).translate(low)
    per = Counter(k for _, t in rows for k in {key(l) for l in (t or "").split("\n")} if k)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [l for l in lines if not (key(l) and per[key(l)] >= least)]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


def test_query_matches_sql(spark):
    d = "/root/testdata/sf0.01"
    got = Q.op3_line_dedup(spark, d).toPandas().sort_values("doc_id", ignore_index=True)
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{d}/documents.parquet'")
    sql = con.execute(D.OP3_SQL).df()[got.columns].sort_values("doc_id", ignore_index=True)
    pd.testing.assert_frame_equal(got, sql, check_dtype=False)
    assert got["n_dropped"].sum() > 0


def test_odd_rows(spark):
    rows = [(None, None), (1, ""), (1, ""), (2, "\n\n"), (2, " Top \n\nTop\n"), (2, " Top \n\nTop\n"), (3, "a\rb\n\x0bTOP\x0c"),
            (4, "É\né"), (5, "É\né\ntop"), (6, "x\n" * 9000 + "top"), (None, "y\nÉ"), (7, " top")]
    docs = spark.createDataFrame([(*r, 0, "z") for r in rows], "doc_id long, text string, n_lines int, other string")
    out = D.drop_common_lines(docs, min_documents=3)
    assert out.columns == ["doc_id", "text", "other", "kept_text", "n_lines", "n_dropped"]
    got = [(r["doc_id"], r["kept_text"], r["n_lines"], r["n_dropped"]) for r in out.collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, brute(rows, 3)))
    assert D.drop_common_lines(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        D.dropped_lines(docs, min_documents=0)


def test_common_line_is_dealt_over_copies(spark):
    rows = [(k, f"hot\nown {k}") for k in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = D.drop_common_lines(docs)
    assert {(r["kept_text"], r["n_dropped"]) for r in got.collect()} == {(f"own {k}", 1) for k in range(3000)}


@pytest.mark.parametrize("n", [0, 1, 2, 5000])
def test_perfect_hash(n):
    rng = np.random.default_rng(n)
    a, b = rng.integers(0, 1 << 63, (2, n), dtype=np.uint64)
    a[: n // 2] = a[:1].repeat(n // 2) if n else a[:0]       # equal halves, distinct pairs
    count = rng.integers(1, 100000, n)
    h = P.PerfectHash(**P.build(a, b, count))
    assert sorted(h.index(a, b)) == list(range(n))
    assert (h.count(a, b) == np.minimum(count, 65535)).all()
    assert (h.count(a ^ np.uint64(1), b) == 0).mean() > 0.999 if n else True


def test_long_texts_with_many_common_lines(spark):
    text = "\n".join(f"line {k % 2 * k}" for k in range(60_000))
    own = "\n".join(f"own {k}\nline {k % 2 * k}" for k in range(60_000))
    rows = [(k, text) for k in range(3)] + [(3, own)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r["doc_id"], r["kept_text"], r["n_lines"], r["n_dropped"])
           for r in D.drop_common_lines(docs, min_documents=4).collect()]
    assert sorted(got) == sorted(brute(rows, 4))
