import hashlib
from collections import Counter

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline as P
from candlewick.llm import queries as Q, simhash
from tests.llm.test_line_dedup import brute as brute_lines
from tests.llm.test_mixing import check as check_mix
from tests.llm.test_simhash import classes, slow_fp

D = "/root/testdata/sf0.001"


def test_against_brute_force(spark):
    docs = Q.documents(spark, D)
    rows = [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()]
    rows = [r for r in rows if any(map(str.isalpha, r[1] or ""))]
    texts = brute_lines([(i, t) for i, t, _ in rows], 10)
    cls = classes([slow_fp(t[1]) for t in texts], [i for i, *_ in rows])
    kept = [(i, t[1], s) for (i, _, s), t, c in zip(rows, texts, cls) if i == c]

    got, out = docs, []
    for name, stage in P.STAGES:
        got = stage(spark, got, D).cache()
        out.append(got)
        if name != P.STAGES[-1][0]:
            assert got.columns == P.COLUMNS
    assert sorted((r["doc_id"], r["text"]) for r in out[0].collect()) == sorted(r[:2] for r in rows)
    assert sorted((r["doc_id"], r["text"]) for r in out[1].collect()) == sorted(t[:2] for t in texts)
    assert all(r["n_chars"] == len(r["text"]) for r in out[1].collect())
    assert sorted((r["doc_id"], r["text"], r["source"]) for r in out[2].collect()) == sorted(kept)
    copies = Counter(r["doc_id"] for r in out[3].collect())
    from candlewick.llm import mixing
    mixed = mixing.mix(out[2]).collect()
    check_mix(mixed, kept)
    assert copies == Counter({r["doc_id"]: r["copies"] for r in mixed if r["copies"]})
    reference = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    text = {i: t for i, t, _ in kept}
    for r in out[4].collect():
        assert r["ids"] == reference.encode(text[r["doc_id"]], add_special_tokens=False).ids
        assert r["n_tokens"] == len(r["ids"])
        assert r["decoded_sha256"] == hashlib.sha256(
            reference.decode(r["ids"], skip_special_tokens=False).encode()).hexdigest()
        assert r["text_sha256"] == hashlib.sha256(text[r["doc_id"]].encode()).hexdigest()
    assert sorted(map(str, P.run(spark, D).collect())) == sorted(map(str, out[4].collect()))


def test_odd_rows(spark):
    rows = [(1, None, None, None, None), (None, "only text here", "en", "a", 3), (2, "", "en", "a", 0),
            (3, "the same row", "en", "a", 1), (3, "the same row", "en", "a", 1), (3, "other text of it", "de", "b", 1),
            (4, "12 34", "en", "b", 5)]
    docs = spark.createDataFrame([(*r, "x") for r in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long, fp string")
    for table in (docs, docs.limit(0)):
        got = table
        for _, stage in P.STAGES:
            got = stage(spark, got, D).cache()
            got.count()
    one = simhash.keep_one(docs.drop("fp")).collect()
    assert sum(r["text"] == "the same row" for r in one) == 1
    assert {r["text"] or "" for r in one} == {r[1] or "" for r in rows}


def test_no_learned_language_keeps_texts_with_letters(spark):
    rows = [(k, t, None, "a", 1) for k, t in enumerate(["plain english", "другой язык", "12 + 34", "", None, "é"] * 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = P.language_id(spark, docs, D)
    assert got.columns == P.COLUMNS
    assert sorted(r["doc_id"] for r in got.collect()) == [k for k, t, *_ in rows if any(map(str.isalpha, t or ""))]
