"""Continuous landing of JSON price payloads into the partitioned bars table.

The reference polls an HTTP API per ticker and appends one CSV per ticker. Here payload
files dropped into a landing folder are a file stream: each micro-batch explodes the
``prices`` array (S5), routes payloads without it to a rejects folder (S6), parses dates
(F1) and writes them to an ``epoch``- and ``symbol``-partitioned Parquet table (S9). A replayed
micro-batch overwrites its own epoch's partitions, so rows are never doubled; file tracking
comes from the checkpoint location, which must be on shared storage (by default a sub-folder
of ``spark.checkpoint.dir``).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from candlewick.session import checkpoint_dir
from candlewick.sources.files import PRICE_SCHEMA, explode_payload, typed_prices

PAYLOAD_SCHEMA = StructType([StructField("value", StringType())])


def payload_stream(spark: SparkSession, landing: str, max_files: int = 1000) -> DataFrame:
    """Whole-file text stream: one row per payload file (``wholetext``)."""
    return (spark.readStream.format("text").option("wholetext", True)
            .option("maxFilesPerTrigger", max_files).load(landing)
            .withColumn("source_file", F.col("_metadata.file_path")))


def start_price_ingest(spark: SparkSession, landing: str, table: str, rejects: str,
                       checkpoint: str | None = None, trigger_once: bool = False):
    """Start the ingest query; returns the ``StreamingQuery``."""
    ckpt = checkpoint or os.path.join(checkpoint_dir(spark), "price-ingest")

    def batch(df: DataFrame, epoch_id: int) -> None:
        df = df.persist()
        rows, bad = explode_payload(df, "prices", PRICE_SCHEMA, keep=["source_file"])
        rows = typed_prices(rows).drop("source_file").repartition("symbol")
        for out, path, keys in ((rows, table, ["epoch", "symbol"]), (bad, rejects, ["epoch"])):
            (out.withColumn("epoch", F.lit(epoch_id)).write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path))
        df.unpersist()

    w = payload_stream(spark, landing).writeStream.foreachBatch(batch).option(
        "checkpointLocation", ckpt)
    w = w.trigger(availableNow=True) if trigger_once else w.trigger(processingTime="1 minute")
    return w.start()
