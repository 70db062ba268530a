"""Helpers shared by the document operators: byte-bounded Arrow passes over texts, tables in
the shared folder, and content keys of rows."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType

from candlewick.operators.joins import join_counted   # noqa: F401  (shared with the operators here)
from candlewick.session import scratch_path

SLICE_BYTES = 1 << 20


def slices(batch: pa.RecordBatch, text: int) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each piece holds about ``SLICE_BYTES`` of text (one row at least)."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    block = np.cumsum(sizes.astype(np.int64)) // SLICE_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def texts_of(batch: pa.RecordBatch, text: int) -> list[bytes]:
    """UTF-8 bytes of every text; null is empty."""
    return [x or b"" for x in batch.column(text).cast(pa.binary()).to_pylist()]


def without(df: DataFrame, names: list[str]) -> DataFrame:
    """Drop columns whose names clash (in any case) with those an operator adds."""
    low = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in low])


def with_text_columns(df: DataFrame, text_col: str, fields: list[StructField],
                      make: Callable[[], Callable[[list[bytes]], list[pa.Array]]]) -> DataFrame:
    """Append columns that are computed from whole texts, in byte-bounded Arrow slices.

    ``make()`` runs once per task and returns the function from texts to one Arrow array per
    field. Columns of ``df`` with an added column's name are replaced.
    """
    base = without(df, [f.name for f in fields])
    at = base.columns.index(text_col)
    names = [*base.columns, *(f.name for f in fields)]

    def run(batches):
        fn = make()
        for batch in batches:
            for part in slices(batch, at):
                yield pa.RecordBatch.from_arrays([*part.columns, *fn(texts_of(part, at))],
                                                 names=names)

    return base.mapInArrow(run, StructType([*base.schema.fields, *fields]))


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below the cluster's shared checkpoint folder; it goes when the session ends."""
    return scratch_path(spark, name)


def shared_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: later jobs start from
    the table, whatever executors are lost."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def put_file(spark: SparkSession, name: str, data: bytes) -> str:
    """Write a bounded file into the shared folder and let Spark hand it to every executor;
    tasks find it with ``local_file``."""
    path = shared_path(spark, name)
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    out = fs.create(jvm_path)
    out.write(bytearray(data))
    out.close()
    spark.sparkContext.addFile(jvm_path.toUri().toString() if jvm_path.toUri().getScheme()
                               else "file://" + path)
    return os.path.basename(path)


def local_file(name: str) -> str:
    return SparkFiles.get(name)


def row_keys(id_col: str, text_col: str) -> list[Column]:
    """A 128-bit key of a row's id and text: rows that share it are equal in both."""
    t, i = F.col(text_col), F.col(id_col).cast("string")
    flags = F.concat(F.isnull(t).cast("string"), F.isnull(i).cast("string"))
    return [F.xxhash64(flags, i, t).alias("key_a"),
            F.xxhash64(F.lit("second"), t, i, flags).alias("key_b")]


def list_array(parts: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    """An Arrow list column from one numpy array per row."""
    sizes = np.fromiter((len(p) for p in parts), np.int64, len(parts))
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    flat = np.concatenate(parts) if parts else np.empty(0)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, type=kind))


def splitmix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser on uint64 arrays."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
