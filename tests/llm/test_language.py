import zlib

from pyspark.sql import functions as F

from candlewick.llm import language as G, queries as Q


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    truth = {r["doc_id"]: r for r in Q.documents(spark, d).collect()}
    got = Q.op6_language(spark, d).collect()
    assert len(got) == len(truth)
    held = [r for r in got if r["held_out"]]
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1
    right = [r["lang_pred"] == truth[r["doc_id"]]["lang"] for r in held]
    assert sum(right) / len(right) > 0.97
    assert sorted(got) == sorted(Q.op6_language(spark, d).collect())


def test_odd_rows(spark):
    words = {"en": "the cat and that house", "de": "der hund und das haus", "fr": "le chat et cette maison",
             "xx": "qoq zuz qaq zyz", "sv": "katten och det huset"}
    rows = [(k, f"{w} {w} {k % 3}", lang) for lang, w in words.items() for k in range(20)]
    rows += [(None, "the cat", "en"), (1, None, "de"), (2, "123 !?", "fr"), (3, "", "fr"), (4, "house", None)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, lang string, Score int")
    model = G.fit(docs)
    assert model.families == {"germanic": ["de", "en", "sv"], "romance": ["fr"], "xx": ["xx"]}
    out = G.predict(docs, model)
    assert out.columns == ["doc_id", "text", "lang", "lang_pred", "score"]
    for r in out.collect():
        if r["text"] is None or not any(map(str.isalpha, r["text"])):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        elif r["lang"] and r["text"] != "house":
            assert r["lang_pred"] == r["lang"]
    long = docs.limit(1).select(F.lit(1).alias("doc_id"), F.repeat(F.lit("le chat et la maison "), 20000).alias("text"))
    assert G.predict(long, model).first()["lang_pred"] == "fr"
    # nothing or one language learned; an empty table
    none = G.fit(docs.limit(0))
    assert {r["lang_pred"] for r in G.predict(docs, none).collect()} == {"und"}
    one = G.fit(docs.where("lang = 'fr'"))
    assert {r["lang_pred"] for r in G.predict(docs, one).collect()} == {"und", "fr"}
    assert G.predict(docs.limit(0), model).count() == 0


def test_sample_is_bounded_and_stratified(spark):
    docs = spark.range(30000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 100 == 0, "b").otherwise("a").alias("lang"))
    n = {r["lang"]: r["count"] for r in G.sample(docs, 400, "doc_id", "lang").groupBy("lang").count().collect()}
    assert n["b"] == 300 and 300 < n["a"] < 500
