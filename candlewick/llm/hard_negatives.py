"""Hard-negative mining with an inverted multi-index.

1. Rows are dealt to shards, each an inverted multi-index (``multi_index``); every row is indexed.
2. Anchors are packed into blocks of ``BLOCK_ANCHORS``; each block meets each shard once, as a
   stated set of queries against all rows. A search visits cells by descending bound and stops when
   its answer is certified: the k-th row found scores above the bound of all that is left.
3. First the positives: the best rows with the anchor's label, best ``positives`` of each shard,
   merged by rank. Then the negatives: for each positive, whose score is now known, the best rows
   of another label in its window; a window is certified when it is full above the bound of what is
   left, or when that bound lies below the window.

What leaves a shard is at most ``positives`` rows, or ``positives * negatives`` rows, an anchor.

Rows with a null id, label or vector, or a null or non-finite component, take no part. Rows that
share an id count once: the least by label, then components. Vectors are compared with those of the
same number of components only, and the most frequent number (the smaller on ties) takes part. Ties
of a score go to the smaller id. Components saturate at 2**27 in absolute value. An anchor without a
positive, or a positive without a row in its window, gives no row; an empty table gives none. Extra
columns are not carried.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from candlewick.llm import common as C
from candlewick.llm import multi_index as M
from candlewick.llm.centroids import integers, whole

POSITIVES, NEGATIVES, SCALE = 5, 5, 256
#: The window: least and most percent of the positive's score.
LEAST, MOST = 80, 100
BLOCK_ANCHORS = 2048


def prepared(vectors: DataFrame, scale: int = SCALE, id_col: str = "vec_id", vector_col: str = "embedding",
             label_col: str = "label") -> DataFrame:
    """``id, label, vec`` of the rows that take part, one an id, before dimensions are compared."""
    x = F.col("x")
    return (vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
                           F.col(vector_col).alias("x"))
            .where(F.col("id").isNotNull() & F.col("label").isNotNull() & whole(x) & (F.size(x) > 0))
            .select("id", "label", integers(x, scale).alias("vec"))
            .groupBy("id").agg(F.min(F.struct("label", "vec")).alias("r")).select("id", "r.label", "r.vec"))


def _anchor_blocks(anchors: DataFrame, blocks: int, extra: tuple[str, ...] = ()) -> DataFrame:
    """Anchors packed by block: ids, labels, vectors and the doubles-free ``extra`` long arrays."""
    names = ["ids", "labels", "vectors", *extra]
    schema = StructType([StructField("block", LongType())] + [StructField(n, BinaryType()) for n in names])

    def pack(table: pa.Table) -> pa.Table:
        flat = lambda n, kind: table.column(n).combine_chunks().flatten().to_numpy().astype(kind)
        blobs = [table.column("id").to_numpy().astype(np.int64), table.column("label").to_numpy().astype(np.int64),
                 flat("vec", np.int32), *(flat(n, np.int64) for n in extra)]
        return pa.table({"block": pa.array([table.column("block")[0].as_py()], pa.int64())}
                        | {n: pa.array([b.tobytes()], pa.binary()) for n, b in zip(names, blobs)})

    return (anchors.withColumn("block", F.pmod(F.xxhash64(F.lit("block"), "id"), F.lit(blocks)))
            .groupBy("block").applyInArrow(pack, schema))


def _meet(shards: DataFrame, blocks: DataFrame, n_shards: int, n_blocks: int) -> DataFrame:
    """Every shard with every block of anchors, each pair a row. The number of partitions is given,
    so adaptive execution does not gather the few, costly rows in one task."""
    parts = int(shards.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = min(n_shards * n_blocks, max(parts, n_shards))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    queries = blocks.select("block", *[F.col(c).alias(f"q_{c}") for c in blocks.columns if c != "block"])
    here = shards.withColumn("block", every(n_blocks)).repartition(parts, "shard", "block")
    there = queries.withColumn("shard", every(n_shards)).repartition(parts, "shard", "block")
    return here.join(there.hint("shuffle_hash"), ["shard", "block"]).drop("block", "shard")


def _search(pairs: DataFrame, schema: StructType, dims: int, books, extra: int,
            one: Callable[[M.Shard, int, int, np.ndarray, list[np.ndarray]], list[np.ndarray]]) -> DataFrame:
    """Run ``one`` (shard, anchor id, its label, its vector, its extra arrays) for every anchor of
    every pair; it returns the columns after ``anchor_id``."""
    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                row = [c[k].as_py() for c in batch.columns]
                shard = M.Shard.unpack(row[:6], books, dims)
                ids, labels = (np.frombuffer(x, np.int64) for x in row[6:8])
                vectors = np.frombuffer(row[8], np.int32).reshape(-1, dims).astype(np.int64)
                more = [np.frombuffer(x, np.int64).reshape(len(ids), -1) for x in row[9:9 + extra]]
                found = [one(shard, int(ids[i]), int(labels[i]), vectors[i], [m[i] for m in more])
                         for i in range(len(ids))]
                times = [len(f[0]) for f in found]
                columns = [np.repeat(ids, times)] + [np.concatenate([f[c] for f in found])
                                                     for c in range(len(schema) - 1)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x).cast(t.type) for x, t in zip(columns, pa_schema)], names=schema.names)

    kinds = {LongType: pa.int64(), IntegerType: pa.int32()}
    pa_schema = [pa.field(f.name, kinds[type(f.dataType)]) for f in schema.fields]
    return pairs.mapInArrow(run, schema)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best: by score, then the smaller id."""
    if len(scores) > 4 * k:
        near = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
    else:
        near = np.arange(len(scores))
    return near[np.lexsort((ids[near], -scores[near]))][:k]


def best_of_label(shard: M.Shard, own: int, label: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, scores) of the k best other rows with the label."""
    ids, scores = np.empty(0, np.int64), np.empty(0, np.int64)
    for left, rows, got in shard.visit(query):
        mine = (shard.labels[rows] == label) & (shard.ids[rows] != own)
        ids, scores = np.concatenate([ids, shard.ids[rows[mine]]]), np.concatenate([scores, got[mine]])
        keep = _best(scores, ids, k)
        ids, scores = ids[keep], scores[keep]
        if len(ids) == k and scores[-1] > left:
            break
    return ids, scores


def best_in_windows(shard: M.Shard, label: int, query: np.ndarray, tops: np.ndarray, least: int, most: int,
                    k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each positive's score the (ids, scores) of the k best rows of another label in its window."""
    found = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in tops]
    open_ = [i for i, top in enumerate(tops.tolist()) if least * top <= most * top]
    for left, rows, got in shard.visit(query) if open_ else ():
        other = shard.labels[rows] != label
        ids, scores = shard.ids[rows[other]], got[other]
        for i in list(open_):
            top = int(tops[i])
            inside = (100 * scores >= least * top) & (100 * scores <= most * top)
            if inside.any():
                both = [np.concatenate([a, b[inside]]) for a, b in zip(found[i], (ids, scores))]
                keep = _best(both[1], both[0], k)
                found[i] = both[0][keep], both[1][keep]
            full = len(found[i][0]) == k and found[i][1][-1] > left
            if full or 100 * left < least * top:
                open_.remove(i)
        if not open_:
            break
    return found


POSITIVE = StructType([StructField(n, LongType()) for n in ("anchor_id", "positive_id", "positive_score")])
NEGATIVE = StructType([StructField("anchor_id", LongType()), StructField("slot", IntegerType()),
                       StructField("negative_id", LongType()), StructField("negative_score", LongType())])
RESULT = StructType([StructField("anchor_id", LongType()), StructField("positive_id", LongType()),
                     StructField("rank", IntegerType()), StructField("negative_id", LongType()),
                     StructField("positive_score", LongType()), StructField("negative_score", LongType())])


def mine(rows: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
         least: int = LEAST, most: int = MOST) -> DataFrame:
    """Hard negatives for the rows of ``rows`` (id, label, vec: long, long, array<int>, see
    ``prepared``) that ``is_anchor`` picks: ``anchor_id, positive_id, rank, negative_id,
    positive_score, negative_score``. Window: least * positive <= 100 * negative <= most * positive."""
    spark = rows.sparkSession
    rows = C.shared_table(rows, "mining-rows")
    sizes = rows.groupBy(F.size("vec").alias("dims")).agg(F.count(F.lit(1)).alias("n"))
    often = sizes.orderBy(F.desc("n"), "dims").first()
    if often is None:
        return spark.createDataFrame([], RESULT)
    dims, n = often["dims"], often["n"]
    rows = rows.where(F.size("vec") == dims)
    books = M.fit_codebooks(rows, dims)
    n_shards = M.shard_count(n)
    shards = C.shared_table(M.build_shards(rows, books, n_shards), "multi-index")
    anchors = rows.where(is_anchor)
    n_anchors = anchors.count()
    if not n_anchors:
        return spark.createDataFrame([], RESULT)
    n_blocks = math.ceil(n_anchors / BLOCK_ANCHORS)

    def first(shard, own, label, query, _):
        return list(best_of_label(shard, own, label, query, positives))

    met = _meet(shards, _anchor_blocks(anchors, n_blocks), n_shards, n_blocks)
    found = _search(met, POSITIVE, dims, books, 0, first)
    rank = lambda *by: F.row_number().over(Window.partitionBy(*by[0]).orderBy(*by[1]))
    top = C.shared_table(
        found.withColumn("slot", rank(["anchor_id"], [F.desc("positive_score"), "positive_id"]) - 1)
        .where(F.col("slot") < positives), "positives")
    # an anchor with fewer positives repeats its last score; those slots are dropped in the join
    scores = (top.groupBy("anchor_id").agg(F.sort_array(F.collect_list("positive_score"), asc=False).alias("s"))
              .select(F.col("anchor_id").alias("id"), F.concat("s", F.array_repeat(
                  F.element_at("s", -1), F.lit(positives) - F.size("s"))).alias("tops")))
    again = anchors.join(scores, "id")

    def second(shard, own, label, query, extra):
        windows = best_in_windows(shard, label, query, extra[0], least, most, negatives)
        times = [len(w[0]) for w in windows]
        return [np.repeat(np.arange(len(windows)), times), np.concatenate([w[0] for w in windows]),
                np.concatenate([w[1] for w in windows])]

    met = _meet(shards, _anchor_blocks(again, n_blocks, ("tops",)), n_shards, n_blocks)
    near = _search(met, NEGATIVE, dims, books, 1, second)
    best = (near.withColumn("rank", rank(["anchor_id", "slot"], [F.desc("negative_score"), "negative_id"]))
            .where(F.col("rank") <= negatives))
    return best.join(top, ["anchor_id", "slot"]).select(*RESULT.names)


OP11_SQL = f"""
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  [CAST(floor({SCALE} * CAST(z AS DOUBLE)) AS DOUBLE) FOR z IN embedding] AS x FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda z: z IS NULL OR NOT isfinite(z))) = 0),
s AS (SELECT a.vec_id AS anchor_id, a.label AS anchor_label, r.vec_id, r.label,
             CAST(list_inner_product(a.x, r.x) AS BIGINT) AS score
      FROM v AS a JOIN v AS r ON a.vec_id <> r.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE label = anchor_label
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {POSITIVES})
SELECT p.anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, s.vec_id AS negative_id,
       positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND s.label <> s.anchor_label
 AND {LEAST} * positive_score <= 100 * s.score AND 100 * s.score <= {MOST} * positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id)
QUALIFY row_number() OVER w <= {NEGATIVES}
"""
