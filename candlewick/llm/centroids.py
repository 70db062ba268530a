"""Centroid clustering of integer vectors with scalar lookup tables.

Every component is an integer, so a squared distance is a sum of one table entry a dimension. In
each round every Arrow batch tabulates, for each dimension, the squared difference between each
integer that occurs in the batch and each centroid; distances are NumPy gathers from these tables,
summed over the dimensions. A batch's table has no more entries than the batch has components, so
memory does not follow the range of the data.

Rounds run as one pass each: a task folds its vectors into exact integer sums, one row a cluster
and dimension, Spark adds them up, and only the centroids (clusters times dimensions numbers) reach
the driver. Sums are decimals, which don't overflow.

Vectors with another number of components than ``dims``, and those that are null or have a null or
non-finite component, take no part. Components are floor(scale * x) and saturate at 2**27 in
absolute value, so that distances fit a long. Repeated rows and ids count as separate vectors; equal
first hashes are ordered by id, then by components; a null id hashes as an empty text. Fewer vectors
than clusters give fewer clusters, an empty table an empty result. Other columns are not carried.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from candlewick.llm import common as C

CLUSTERS, ROUNDS, DIMS, SCALE = 16, 3, 64, 64
#: Components saturate here.
MOST = 1 << 27
#: Rows whose distances are gathered at a time.
BLOCK = 2048


def whole(x: Column) -> Column:
    """All components present and finite."""
    bad = lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))
    return x.isNotNull() & ~F.exists(x, bad)


def integers(x: Column, scale: int) -> Column:
    """floor(scale * component), saturating."""
    clip = lambda v: F.least(F.greatest(F.floor(v), F.lit(-MOST)), F.lit(MOST)).cast("int")
    # limits are applied to the double, before it becomes an integer
    near = lambda v: F.least(F.greatest(v.cast("double") * scale, F.lit(-2.0 * MOST)), F.lit(2.0 * MOST))
    return F.transform(x, lambda v: clip(near(v)))


def prepared(vectors: DataFrame, scale: int = SCALE, dims: int = DIMS, id_col: str = "vec_id",
             vector_col: str = "embedding") -> DataFrame:
    """``id`` and ``vec``, the integer components of the vectors that take part."""
    x = F.col(vector_col)
    return (vectors.select(F.col(id_col).alias("id"), x.alias("x"))
            .where((F.size("x") == dims) & whole(F.col("x")))
            .select("id", integers(F.col("x"), scale).alias("vec")))


def matrix(batch: pa.RecordBatch, column: int, dims: int) -> np.ndarray:
    return batch.column(column).flatten().to_numpy().reshape(-1, dims)


def nearest(values: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(cluster, squared distance) of every row: the nearest centroid, the smaller on ties."""
    total = np.zeros((len(values), len(centroids)), np.int64)
    for d in range(values.shape[1]):
        occurring, at = np.unique(values[:, d], return_inverse=True)
        table = (occurring.astype(np.int64)[:, None] - centroids[None, :, d]) ** 2
        total += table[at]
    best = total.argmin(axis=1)
    return best, total[np.arange(len(values)), best]


def _blocks(batches, dims: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for k in range(0, batch.num_rows, BLOCK):
            part = batch.slice(k, BLOCK)
            if part.num_rows:
                yield part, matrix(part, 1, dims)


def assigned(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``id, cluster, distance`` of every prepared vector."""
    dims = centroids.shape[1]
    schema = StructType([vectors.schema["id"], StructField("cluster", IntegerType()),
                         StructField("distance", LongType())])

    def run(batches):
        for part, values in _blocks(batches, dims):
            cluster, distance = nearest(values, centroids)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(cluster.astype(np.int32)), pa.array(distance)], names=schema.names)

    return vectors.select("id", "vec").mapInArrow(run, schema)


def _sums(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Exact sums of every cluster's vectors: ``cluster, dim, n, total``; one row a cluster and
    dimension from each task."""
    k, dims = centroids.shape
    schema = StructType([StructField("cluster", IntegerType()), StructField("dim", IntegerType()),
                         StructField("n", LongType()), StructField("total", LongType())])

    def run(batches):
        n, total = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for _, values in _blocks(batches, dims):
            cluster = nearest(values, centroids)[0]
            n += np.bincount(cluster, minlength=k)
            order = np.argsort(cluster, kind="stable")
            there, first = np.unique(cluster[order], return_index=True)
            total[there] += np.add.reduceat(values[order].astype(np.int64), first, axis=0)
        rows, cols = np.divmod(np.arange(k * dims), dims)
        some = n[rows] > 0
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows[some].astype(np.int32)), pa.array(cols[some].astype(np.int32)),
             pa.array(n[rows][some]), pa.array(total.ravel()[some])], names=schema.names)

    big = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    return vectors.select("id", "vec").mapInArrow(run, schema).groupBy("cluster", "dim").agg(big("n"), big("total"))


def first_centroids(vectors: DataFrame, clusters: int = CLUSTERS) -> np.ndarray:
    """The vectors with the smallest sha256 of ``1:<id>``, in ascending hash order."""
    name = F.concat(F.lit("1:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    rows = (vectors.select(F.sha2(name, 256).alias("h"), "id", "vec")
            .orderBy("h", "id", "vec").limit(clusters).collect())
    return np.array([r["vec"] for r in rows], np.int64)


def fit(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS) -> np.ndarray:
    """Centroids after ``rounds`` rounds; an empty cluster keeps its centroid."""
    centroids = first_centroids(vectors, clusters)
    for _ in range(rounds if len(centroids) else 0):
        new = centroids.copy()
        for r in _sums(vectors, centroids).collect():
            new[r["cluster"], r["dim"]] = int(r["total"]) // int(r["n"])
        centroids = new
    return centroids


def cluster(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, scale: int = SCALE,
            dims: int = DIMS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``id_col``, ``cluster``, ``distance``, ``cluster_inertia``, ``inertia`` and
    ``centroid_sha256`` (of the components as decimal integers, joined by commas)."""
    own = C.shared_table(prepared(vectors, scale, dims, id_col, vector_col), "integer-vectors")
    centroids = fit(own, clusters, rounds)
    if not len(centroids):
        centroids = np.zeros((1, dims), np.int64)          # nobody is assigned to it
    out = C.shared_table(assigned(own, centroids), "assigned")
    sums = {r["cluster"]: int(r["s"]) for r in out.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    fit_long = lambda v: F.lit(min(v, (1 << 63) - 1)).cast("long")
    by_cluster = F.array(*[fit_long(sums.get(k, 0)) for k in range(len(centroids))])
    digests = F.array(*[F.lit(hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest())
                        for c in centroids])
    at = F.col("cluster") + 1
    return out.select(F.col("id").alias(id_col), "cluster", "distance",
                      F.element_at(by_cluster, at).alias("cluster_inertia"),
                      fit_long(sum(sums.values())).alias("inertia"),
                      F.element_at(digests, at).alias("centroid_sha256"))


def op13_sql(clusters: int = CLUSTERS, rounds: int = ROUNDS, dims: int = DIMS, scale: int = SCALE) -> str:
    """The same in DuckDB, one set of expressions a round."""
    def nearest_sql(r: int) -> str:
        return f"""
d{r} AS (SELECT x.i, c.k, sum((x.v - c.v) * (x.v - c.v)) AS s FROM x JOIN c{r} AS c USING (d) GROUP BY 1, 2),
a{r} AS (SELECT i, CAST(arg_min(k, s * {clusters} + k) AS INTEGER) AS k, CAST(min(s) AS BIGINT) AS s FROM d{r} GROUP BY 1)"""

    steps = []
    for r in range(rounds):
        steps.append(nearest_sql(r) + f""",
t{r} AS (SELECT a.k, x.d, CAST(sum(x.v) AS BIGINT) AS s, count(*) AS n FROM a{r} AS a JOIN x USING (i) GROUP BY 1, 2),
c{r + 1} AS (SELECT c.k, c.d, CASE WHEN t.n IS NULL THEN c.v
              ELSE (t.s - ((t.s % t.n) + t.n) % t.n) // t.n END AS v
       FROM c{r} AS c LEFT JOIN t{r} AS t USING (k, d))""")
    return f"""
WITH e AS (SELECT vec_id, embedding, row_number() OVER (ORDER BY vec_id) AS i FROM embeddings
           WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda z: z IS NULL OR NOT isfinite(z))) = 0),
x AS (SELECT i, unnest(range({dims})) AS d, unnest([CAST(floor({scale} * CAST(z AS DOUBLE)) AS BIGINT) FOR z IN embedding]) AS v FROM e),
s AS (SELECT i, row_number() OVER (ORDER BY sha256('1:' || vec_id), i) - 1 AS k FROM e),
c0 AS (SELECT s.k, x.d, x.v FROM s JOIN x USING (i) WHERE s.k < {clusters}),
{','.join(steps)},{nearest_sql(rounds)},
g AS (SELECT k, sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY d)) AS centroid_sha256 FROM c{rounds} GROUP BY 1)
SELECT e.vec_id, a.k AS cluster, a.s AS distance, CAST(sum(a.s) OVER (PARTITION BY a.k) AS BIGINT) AS cluster_inertia,
       CAST(sum(a.s) OVER () AS BIGINT) AS inertia, g.centroid_sha256
FROM a{rounds} AS a JOIN e USING (i) JOIN g ON g.k = a.k
"""


OP13_SQL = op13_sql()
