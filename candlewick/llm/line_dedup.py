"""Line dedup by a sharded minimal perfect hash.

1. Every line's key (ASCII white space stripped, A-Z lower-cased) is hashed to 128 bits; the
   distinct documents of each hash are counted.
2. Hashes are dealt to shards. Each shard becomes a minimal perfect hash that indexes an array of
   32 check bits and one of counts.
3. Documents probe the arrays: a line's probe goes to its hash's shard and reads one slot of each
   array. Shards that many probes ask for are copied and their probes dealt over the copies, so a
   line that stands in a third of all documents does not gather in one task.
4. Lines whose key stands in ``min_documents`` documents or more are dropped everywhere.

Each row counts as one document. Null and empty texts are one empty line, which is never dropped
(its key has no code point) as no empty line is. Repeated rows and ties of the id are probed
alike; very long texts are split whole; extra columns stay, and those named as an added column
are replaced. An empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import (BinaryType, BooleanType, IntegerType, LongType, StructField,
                               StructType)

from candlewick.llm import common as C
from candlewick.llm.perfect_hash import MOST_COUNT, PerfectHash, build

MIN_DOCUMENTS = 10
SHARD_LINES, SHARDS_PER_PARTITION = 1 << 16, 8
SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def line_keys(text: bytes) -> list[tuple[int, int, int, bool]]:
    """(line number, hash halves, first of its key in the text) of lines with a key."""
    out, seen = [], set()
    for number, line in enumerate(text.translate(LOWER).split(b"\n")):
        key = line.strip(SPACE)
        if key:
            h = xxhash.xxh3_128_intdigest(key)
            out.append((number, (h >> 64) - (1 << 63), (h & (1 << 64) - 1) - (1 << 63), h not in seen))
            seen.add(h)
    return out


def hashed_lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """A row for every line with a key: the row's key, line number, hash, first or not."""
    schema = StructType([StructField("key_a", LongType()), StructField("key_b", LongType()),
                         StructField("line_no", IntegerType()), StructField("hash_a", LongType()),
                         StructField("hash_b", LongType()), StructField("line_first", BooleanType())])

    def run(batches):
        for batch in batches:
            for part in C.slices(batch, 0):
                lines = [line_keys(t) for t in C.texts_of(part, 0)]
                times = np.fromiter(map(len, lines), np.int64, len(lines))
                rows = np.repeat(np.arange(len(lines)), times)
                columns = list(zip(*(x for l in lines for x in l))) or [(), (), (), ()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(1).take(pa.array(rows)), part.column(2).take(pa.array(rows)),
                     pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int64()),
                     pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.bool_())],
                    names=schema.names)

    return docs.select(text_col, *C.row_keys(id_col, text_col)).mapInArrow(run, schema)


def _halves(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    return tuple(table.column(n).to_numpy().astype(np.int64).view(np.uint64)
                 for n in ("hash_a", "hash_b"))


ARRAYS = ("sizes", "bits", "checks", "counts")


def _build_shard(table: pa.Table) -> pa.Table:
    a, b = _halves(table)
    blob = build(a, b, table.column("documents").to_numpy())
    return pa.table({"shard": pa.array([table.column("shard")[0].as_py()], pa.int64())}
                    | {n: pa.array([blob[n]], pa.binary()) for n in ARRAYS})


def build_index(lines: DataFrame, shards: int) -> DataFrame:
    """One row of arrays for each shard of the distinct line hashes."""
    schema = StructType([StructField("shard", LongType())]
                        + [StructField(n, BinaryType()) for n in ARRAYS])
    counts = (lines.where("line_first").groupBy("hash_a", "hash_b")
              .agg(F.count(F.lit(1)).alias("documents"))
              .withColumn("shard", F.pmod("hash_b", F.lit(shards))))
    return counts.groupBy("shard").applyInArrow(_build_shard, schema)


def probe(lines: DataFrame, index: DataFrame, shards: int, least: int, task_lines: int) -> DataFrame:
    """Lines whose stored count is ``least`` or more: ``key_a, key_b, line_no``."""
    wanted = (lines.groupBy(F.pmod("hash_b", F.lit(shards)).alias("shard"))
              .agg(F.ceil(F.count(F.lit(1)) / task_lines).alias("copies")))
    wanted = C.shared_table(wanted, "shard-copies")
    salt = F.pmod(F.xxhash64("key_a", "line_no"), F.col("copies"))
    probes = (lines.withColumn("shard", F.pmod("hash_b", F.lit(shards)))
              .join(wanted, "shard").withColumn("salt", salt)
              .select("shard", "salt", "key_a", "key_b", "line_no", "hash_a", "hash_b"))
    copies = (index.join(wanted, "shard")
              .withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
              .drop("copies"))
    schema = StructType([StructField("key_a", LongType()), StructField("key_b", LongType()),
                         StructField("line_no", IntegerType())])

    def look(asked: pa.Table, arrays: pa.Table) -> pa.Table:
        table = PerfectHash(**{n: arrays.column(n)[0].as_py() for n in ARRAYS})
        hit = table.count(*_halves(asked)) >= least
        return asked.select(schema.names).filter(pa.array(hit))

    return (probes.groupBy("shard", "salt").cogroup(copies.groupBy("shard", "salt"))
            .applyInArrow(look, schema))


def dropped_lines(docs: DataFrame, min_documents: int = MIN_DOCUMENTS, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """``key_a, key_b`` (``row_keys``) and ``dropped``, the numbers of the lines to drop."""
    if not 1 <= min_documents <= MOST_COUNT:
        raise ValueError(f"min_documents must lie in 1 to {MOST_COUNT}")
    spark = docs.sparkSession
    lines = C.shared_table(hashed_lines(docs, id_col, text_col), "lines")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = lines.count()
    shards = max(SHARDS_PER_PARTITION * parts, math.ceil(n / SHARD_LINES))
    index = C.shared_table(build_index(lines, shards), "line-index")
    hits = probe(lines, index, shards, min_documents, max(1, 2 * n // shards))
    return hits.groupBy("key_a", "key_b").agg(F.collect_set("line_no").alias("dropped"))


def drop_common_lines(docs: DataFrame, min_documents: int = MIN_DOCUMENTS,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Append ``kept_text``, ``n_lines`` (before dropping) and ``n_dropped``."""
    hits = C.shared_table(dropped_lines(docs, min_documents, id_col, text_col), "dropped-lines")
    base = C.without(docs, ["kept_text", "n_lines", "n_dropped", "key_a", "key_b", "dropped"])
    keys = C.row_keys(id_col, text_col)
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.split(text, "\n", -1)
    # one split for each text; the numbers that stay come from a hash set, so work is linear
    numbers = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("dropped"))
    kept = F.transform(F.array(lines), lambda own: F.array_join(
        F.transform(numbers, lambda i: F.get(own, i)), "\n"))[0]
    joined = base.withColumns({"key_a": keys[0], "key_b": keys[1]}).join(hits, ["key_a", "key_b"], "left")
    return joined.select(
        *[F.col(f"`{c}`") for c in base.columns],
        F.when(F.isnull("dropped"), text).otherwise(kept).alias("kept_text"),
        F.size(lines).cast("long").alias("n_lines"),
        F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"))


OP3_SQL = f"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                  generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS no FROM documents),
k AS (SELECT *, translate(regexp_replace(line, '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g'),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
c AS (SELECT key FROM k WHERE key <> '' GROUP BY 1 HAVING count(DISTINCT doc_id) >= {MIN_DOCUMENTS}),
m AS (SELECT k.*, c.key IS NOT NULL AS gone FROM k LEFT JOIN c USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY no) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY 1
"""
