import re
from collections import Counter

import duckdb
import pandas as pd

from candlewick.llm import quality as R, queries as Q


def brute(rows, least, percent):
    """rows: (id, text, host)."""
    hosts = Counter(h for _, _, h in rows)
    norm = lambda l: " ".join(re.findall(r"[^\x20\x09-\x0D]+", l)).translate(
        {c: c + 32 for c in range(65, 91)})
    per = Counter((h, n) for _, t, h in rows for n in {norm(l) for l in (t or "").split("\n")} if n)
    out = []
    for i, t, h in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        win = [tuple(w[k:k + 3]) for k in range(len(w) - 2)]
        many = {x for x, c in Counter(win).items() if c > 1}
        rep = len({k + j for k, x in enumerate(win) if x in many for j in range(3)})
        lines = t.split("\n")
        worded = [l for l in lines if norm(l)]
        gone = [k for k, l in enumerate(lines) if norm(l) and per[h, norm(l)] >= least
                and 100 * per[h, norm(l)] >= percent * hosts[h]]
        left = len(w) - sum(len(norm(lines[k]).split(" ")) for k in gone)
        bad = len(w) < 50 or 100 * rep > 50 * len(w)
        out.append((i, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(worded) - len(set(worded)),
                    rep, tuple(gone), left, bad, not bad and left >= 20 and left >= 0.5 * len(w)))
    return out


def test_query_matches_brute_force_and_sql(spark):
    d = "/root/testdata/sf0.001"
    got = Q.op10_quality(spark, d).toPandas().sort_values("doc_id", ignore_index=True)
    rows = [(r["doc_id"], r["text"], r["source"]) for r in Q.documents(spark, d).collect()]
    want = sorted(brute(rows, R.LEAST_DOCUMENTS, R.HOST_PERCENT))
    assert list(got.itertuples(index=False, name=None)) == [x[:6] + x[7:] for x in want]
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{d}/documents.parquet'")
    sql = con.execute(R.OP10_SQL).df()[got.columns].sort_values("doc_id", ignore_index=True)
    pd.testing.assert_frame_equal(got, sql, check_dtype=False)


def test_odd_rows(spark):
    body = " ".join(f"w{k}" for k in range(60))
    rows = [(None, None, None), (1, "", "h"), (1, "", "h"), (2, "a b a b a b a", None), (3, "x " * 20000, "h")]
    rows += [(10 + k, f"Common  LINE here\n{body} {k}\n\n", "h") for k in range(6)]
    rows += [(30 + k, f"common line here\n{body} {k}\ncommon line here", "g" if k else None) for k in range(3)]
    rows += [(50 + k, body, "same") for k in range(8)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, source string, N_Words int")
    got = R.quality_rules(docs, least_documents=5).collect()
    key = lambda r: (str(r[0]), r[1:])
    assert sorted([tuple(tuple(v) if isinstance(v, list) else v for v in r) for r in got], key=key) == sorted(
        brute(rows, 5, R.HOST_PERCENT), key=key)
    assert R.quality_rules(docs.limit(0)).count() == 0


def test_hosts_of_every_size_lose_shared_lines(spark):
    body = lambda k: " ".join(f"w{k}x{j}" for j in range(60))
    rows = [(k, f"menu of the host\n{body(k)}", "small") for k in range(12)]                  # all of 12
    rows += [(100 + k, body(k + 100) + ("\nrare line" if k < 12 else ""), "large") for k in range(400)]  # 3 %
    rows += [(900 + k, body(k + 900) + ("\nusual line" if k < 12 else ""), "mid") for k in range(100)]   # 12 %
    rows += [(2000 + k, "menu of the host\n" + body(k + 2000), "tiny") for k in range(9)]      # under 10
    rows += [(3000 + k, "the same long paragraph of words " * 9 + f"\n{body(k)[:30]}", "shells") for k in range(15)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r["doc_id"]: r for r in R.quality_rules(docs).collect()}
    assert sorted(tuple(tuple(v) if isinstance(v, list) else v for v in r) for r in got.values()) == sorted(
        brute(rows, R.LEAST_DOCUMENTS, R.HOST_PERCENT))
    lost = {i for i, r in got.items() if r["removed_lines"]}
    assert lost == {*range(12), *range(900, 912), *range(3000, 3015)}
    assert {i for i, r in got.items() if not r["kept"] and not r["base_failed"]} == set()


def test_some_rows_of_the_table_lose_lines_and_depleted_ones_go(spark):
    body = " ".join(f"w{j}" for j in range(55))
    rows = [(k, f"{body}\nonly {k}", "h") for k in range(12)] + [(50 + k, f"{body} {k}", "g") for k in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = {r["doc_id"]: r["kept"] for r in R.quality_rules(docs).collect()}
    assert kept == {k: False for k in range(12)} | {50 + k: True for k in range(12)}
    out = Q.op10_quality(spark, "/root/testdata/sf0.1")
    assert out.where("words_left < n_words").count() > 0
