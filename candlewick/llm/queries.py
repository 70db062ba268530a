"""The registered queries of the subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField

from candlewick.llm import (bpe, centroids, chunks, hard_negatives, language, licenses, line_dedup, mixing,
                            parity_join, quality, secrets, simhash, successors, suffix_dedup)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


def byte_vocabulary() -> bpe.Vocabulary:
    import public_tokenizers
    return bpe.Vocabulary(public_tokenizers.path("byte_bpe_50k.json"))


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode every text, decode the ids; digests of both."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    vocab = byte_vocabulary()
    out = bpe.encode(docs, vocab, bpe.build_lexicon(docs, vocab), decoded_col="decoded")
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                      F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256)
                      .alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


def edited_text(text: str, following: str) -> str:
    """The last quarter of the code points replaced by the first as many of the next text."""
    quarter = len(text) // 4
    return text[:len(text) - quarter] + following[:quarter]


def _fingerprint_pairs(texts: list[bytes], nexts: list[bytes]) -> list[pa.Array]:
    strings = [t.decode() for t in texts]
    edited = [edited_text(t, n.decode()).encode() for t, n in zip(strings, nexts)]
    kept = [len(t[:len(t) - len(t) // 4].encode()) for t in strings]
    own = chunks.chunked(texts)
    sets = [np.unique(numbers) for numbers, _ in own]
    edited_sets = chunks.edited_sets(own, kept, edited)
    # mostly the next text is the next row's own
    known = [k + 1 < len(texts) and nexts[k] == texts[k + 1] for k in range(len(texts))]
    others = iter(chunks.chunk_sets([n for n, k in zip(nexts, known) if not k]))
    next_sets = [sets[i + 1] if k else next(others) for i, k in enumerate(known)]
    return [pa.array([len(t) for t in strings], pa.int64()),
            pa.array([hashlib.sha256(t).hexdigest() for t in edited], pa.string()),
            pa.array(list(map(chunks.as_text, sets)), pa.string()),
            pa.array(list(map(chunks.as_text, edited_sets)), pa.string()),
            pa.array(list(map(chunks.likeness, sets, edited_sets)), pa.float64()),
            pa.array(list(map(chunks.likeness, sets, next_sets)), pa.float64())]


def op2_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunk fingerprints of every text and of its edited text, and their likeness."""
    fields = [StructField("n_chars", LongType()), StructField("edited_sha256", StringType()),
              StructField("fingerprint", StringType()),
              StructField("edited_fingerprint", StringType()),
              StructField("near_edited", DoubleType()), StructField("near_next", DoubleType())]
    return successors.map_successive(documents(spark, sf_dir), fields, _fingerprint_pairs)


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines found in ten documents or more dropped from every text."""
    out = line_dedup.drop_common_lines(documents(spark, sf_dir).select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped",
                      F.sha2("kept_text", 256).alias("kept_sha256"))


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and templates in every text."""
    out = licenses.scan(documents(spark, sf_dir).select("doc_id", "text"))
    base = F.filter("license_matches", lambda m: m["base"])
    names = lambda a: F.array_join(F.array_sort(F.array_distinct(a["label"])), ",")
    return out.select("doc_id", "n_words", F.size(base).cast("long").alias("n_base"),
                      F.array_min(base["start"]).alias("first_word"),
                      F.array_max(base["start"]).alias("last_word"),
                      names(base).alias("base_labels"),
                      names(F.col("license_matches")).alias("labels"),
                      F.col("license_score").alias("score"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of repeated 400-byte strings removed from every text: the contract's figures, then the
    verdict (``removed``: the text loses bytes), the removed byte ranges and what is left as text."""
    out = suffix_dedup.remove_repeats(documents(spark, sf_dir).select("doc_id", "text"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    ranges = F.transform("spans", lambda s: F.concat(s["start"].cast("string"), F.lit(":"), s["end"].cast("string")))
    return out.select("doc_id", "n_bytes", removed.alias("n_removed"),
                      F.size("spans").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"), (F.size("spans") > 0).alias("removed"),
                      F.array_join(ranges, ",").alias("removed_ranges"),
                      F.make_valid_utf8(F.col("kept").cast("string")).alias("kept_text"))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every text, learned from the documents that are not held out."""
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    model = language.fit(docs.where(~language.held_out() & F.col("doc_id").isNotNull()))
    return (language.predict(docs.drop("lang"), model)
            .select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score"))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base patterns and Markov-scored tokens in every text."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    out = secrets.scan(docs, secrets.train(docs))
    return out.select("doc_id", *[secrets.count_kind("base_spans", k).alias(f"n_{secrets.KINDS[k]}")
                                  for k in range(3)],
                      F.sha2(secrets.span_text("base_spans"), 256).alias("base_sha256"),
                      secrets.span_text("secret_spans").alias("spans"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash classes of all documents."""
    out = simhash.near_duplicates(documents(spark, sf_dir).select("doc_id", "text"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                      "component_id")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entropy-balanced copies of every document."""
    out = mixing.mix(documents(spark, sf_dir).select("doc_id", "text", "source"))
    return out.select("doc_id", "size", "source_size", "target", "taken", "copies", "rate")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures, base rules and the cross-document line verdict of every document."""
    return (quality.quality_rules(documents(spark, sf_dir).select("doc_id", "text", "source"))
            .drop("removed_lines"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every anchor (ids divisible by 100) among all rows; every seventh id gets
    the next label first."""
    rows = embeddings(spark, sf_dir)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(hard_negatives.prepared(rows.withColumn("label", label)), F.col("id") % 100 == 0)


def op12_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 3-word shingle sets are alike to nine tenths."""
    out = parity_join.near_sets(documents(spark, sf_dir).select("doc_id", "text"))
    return out.select("doc_id", F.col("n_grams").alias("n_shingles"), "component_id")


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters of all vectors after three rounds."""
    return centroids.cluster(embeddings(spark, sf_dir))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"op1_bpe": op1_bpe, "op2_chunks": op2_chunks, "op4_licenses": op4_licenses,
            "op3_line_dedup": op3_line_dedup,
            "op5_suffix_dedup": op5_suffix_dedup, "op6_language": op6_language, "op7_secrets": op7_secrets,
            "op8_simhash": op8_simhash, "op9_mixing": op9_mixing, "op10_quality": op10_quality,
            "op11_hard_negatives": op11_hard_negatives, "op12_ngram_join": op12_ngram_join,
            "op13_centroids": op13_centroids}


def oracle_sql() -> dict[str, str]:
    return {"op3_line_dedup": line_dedup.OP3_SQL, "op10_quality": quality.OP10_SQL,
            "op11_hard_negatives": hard_negatives.OP11_SQL, "op12_ngram_join": parity_join.OP12_SQL,
            "op13_centroids": centroids.OP13_SQL}
