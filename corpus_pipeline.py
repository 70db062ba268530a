"""A training corpus from ``documents``: language ID, line dedup, near-dedup, mixing, encoding and
decoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
read again as the next one's ``docs``; all but the last return the columns of ``documents``.
Null texts leave with the first stage; empty tables pass through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from candlewick.llm import bpe, common, language, line_dedup, mixing, queries, simhash

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can't be told (no letter in the text) go. Where no language can be
    learned, no text has one: then those with a letter stay too."""
    docs = docs.select(*COLUMNS)
    model = language.fit(docs.where(~language.held_out() & F.col("doc_id").isNotNull()))
    if not model.families:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    return language.predict(docs, model).where("lang_pred <> 'und'").select(*COLUMNS)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in ten documents or more go; ``text`` and ``n_chars`` are those of the rest."""
    out = line_dedup.drop_common_lines(docs.select(*COLUMNS))
    return (out.withColumn("text", F.col("kept_text"))
            .withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash class the document with the smallest id stays."""
    return simhash.keep_one(docs.select(*COLUMNS))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixing.repeat_copies(mixing.mix(docs.select(*COLUMNS)), COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and the digests of the text and of what the ids decode to."""
    vocab = queries.byte_vocabulary()
    docs = docs.select(*COLUMNS)
    out = bpe.encode(docs, vocab, bpe.build_lexicon(docs, vocab), decoded_col="decoded")
    return out.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids",
                      F.sha2("text", 256).alias("text_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("language ID", language_id), ("line dedup", line_dedup_stage),
          ("SimHash near-dedup", near_dedup), ("mixing", mix_sources), ("BPE encoding and decoding", encode)]

#: Language models, SimHash classes and BPE ids are beyond SQL; tests/llm/test_pipeline.py holds
#: the result against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table of documents."""
    docs = queries.documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        docs = common.shared_table(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
