"""A pass over rows and their successors in ascending id order, without a global sort in one
task.

Percentiles of the id (as many as there are shuffle partitions, times eight) cut the rows into
blocks; the rows with the smallest id of a block are also sent to the block before it, so every
block knows the successor of its last row. After the last row comes the first. Blocks are sorted
by Spark (which spills) and read as a stream, so they need not fit into memory. Nulls come
first; ties of the id are ordered by text.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from candlewick.llm import common as C

BLOCKS_PER_PARTITION = 8


def map_successive(docs: DataFrame, fields: list[StructField],
                   fn: Callable[[list[bytes], list[bytes]], list[pa.Array]],
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and, for each field, what ``fn(texts, texts + [the next one's])`` returns:
    the second list holds each row's successor at the same position."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = parts * BLOCKS_PER_PARTITION
    cuts = rows.agg(F.percentile_approx("id", [k / n for k in range(1, n)], 50 * n)).first()[0]
    cuts = np.unique(np.array(cuts or [], np.int64))

    @F.pandas_udf("int")
    def block_of(ids: pd.Series) -> pd.Series:
        at = np.searchsorted(cuts, ids.fillna(0).to_numpy(np.int64), side="right")
        return pd.Series(np.where(ids.isna(), 0, at), dtype="int32")

    firsts = (rows.select("id", block_of("id").alias("block")).groupBy("block")
              .agg(F.min("id").alias("id"), F.count_if(F.isnull("id")).alias("nulls"))
              .orderBy("block").collect())      # a row for each block
    if not firsts:
        return spark.createDataFrame([], StructType([StructField(id_col, LongType()), *fields]))
    first = {r["block"]: None if r["nulls"] else r["id"] for r in firsts}
    before = dict(zip(first, [list(first)[-1], *first]))
    copy_to = {str(first[b]): before[b] for b in first}
    placed = rows.withColumn("block", block_of("id"))
    copies = (rows.where(F.coalesce(F.col("id").cast("string"), F.lit("None")).isin(list(copy_to)))
              .withColumn("block", F.element_at(
                  F.create_map(*[F.lit(x) for kv in copy_to.items() for x in kv]),
                  F.coalesce(F.col("id").cast("string"), F.lit("None")))))
    both = (placed.withColumn("copied", F.lit(False))
            .unionByName(copies.withColumn("copied", F.lit(True)))
            .repartition(parts, "block")
            .sortWithinPartitions("block", "copied", F.asc_nulls_first("id"), "text"))
    schema = StructType([StructField(id_col, LongType()), *fields])

    def run(batches):
        kept: list[tuple] = []      # rows of (id, text, block, copied); the last waits
        size = 0

        def ready():
            here = [(a, b) for a, b in zip(kept, kept[1:]) if not a[3]]
            texts, nexts = [a[1] for a, _ in here], [b[1] for _, b in here]
            ids = pa.array([a[0] for a, _ in here], pa.int64())
            return pa.RecordBatch.from_arrays([ids, *fn(texts, nexts)], names=schema.names)

        for batch in batches:
            for part in C.slices(batch, 1):
                cols = [part.column(0).to_pylist(), C.texts_of(part, 1),
                        part.column(2).to_pylist(), part.column(3).to_pylist()]
                for row in zip(*cols):
                    kept.append(row)
                    size += len(row[1])
                    if size > C.SLICE_BYTES and len(kept) > 1:
                        yield ready()
                        kept, size = kept[-1:], len(row[1])
        if len(kept) > 1:
            yield ready()

    return both.select("id", "text", "block", "copied").mapInArrow(run, schema)
