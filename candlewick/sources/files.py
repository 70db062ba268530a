"""File sources and sinks (S1-S13) with explicit schemas -- never schema inference.

* One scan of a folder of per-ticker CSV files replaces the reference's file loop; the
  ticker comes from the file name (``_metadata.file_name``) when the rows lack it.
* Sector membership comes from a nested folder tree (sector = folder, ticker = file name
  up to the first ``_``), read as one recursive listing.
* JSON payloads with an array of records are exploded in one pass; payloads without
  the array are routed to a rejects table instead of being silently skipped.
* Sinks write one folder per key (``partitionBy``) instead of one file per ticker.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import (ArrayType, DoubleType, LongType, StringType, StructField,
                               StructType)

from candlewick.session import cut_lineage
from candlewick.functions.dates import parse_date

# Fixed schema of a daily price record (the reference's engineered files, plus the two
# price columns dropped before feature engineering).
PRICE_FIELDS = [
    StructField("id", LongType()),
    StructField("symbol", StringType()),          # text: the ticker INFINITY must stay text
    StructField("trade_date", StringType()),      # parsed with try_to_date (bad -> null)
    StructField("open_price", DoubleType()),
    StructField("high_price", DoubleType()),
    StructField("low_price", DoubleType()),
    StructField("close_price", DoubleType()),
    StructField("volume", DoubleType()),
    StructField("created_at", StringType()),
]
PRICE_SCHEMA = StructType(PRICE_FIELDS)
STOCK_INFO_SCHEMA = StructType([StructField("symbol", StringType()),
                                StructField("market_cap", DoubleType()),
                                StructField("shares_outstanding", DoubleType()),
                                StructField("volume", DoubleType())])


def typed_prices(df: DataFrame) -> DataFrame:
    """Parse the text columns of a price table: date (F1) and ISO-8601 timestamp."""
    parsed = {"trade_date": parse_date(F.col("trade_date")), "created_at": F.try_to_timestamp(F.col("created_at"))}
    return df.withColumns({c: parsed[c] for c in parsed if c in df.columns})


def read_csv(spark: SparkSession, path: str, schema: StructType,
             header: bool = True) -> DataFrame:
    """CSV with a header, any file name (extension-less files included)."""
    return spark.read.schema(schema).option("header", header).option("mode", "PERMISSIVE").csv(path)


def read_macro(spark: SparkSession, path: str) -> DataFrame:
    """S1 + P12: the monthly macro CSV, one row per month.

    Adds ``line_no`` (file order, which the fill of ``year`` needs), trims names, and types
    columns by name: ``year`` (text such as ``2017.0``), ``month_idx``, ``FR_Date``
    (``MM/dd/yyyy``), lower-case ``month``, and doubles for every other column. Text that does
    not parse is null.
    """
    from pyspark.sql import Window
    raw = spark.read.option("header", True).csv(path)
    raw = raw.toDF(*[c.strip() for c in raw.columns]).withColumn("line_no", F.monotonically_increasing_id())
    kinds = {"year": lambda c: c.try_cast("double").cast("int"), "month": lambda c: F.lower(F.trim(c)),
             "month_idx": lambda c: c.try_cast("double").cast("int"),
             "FR_Date": lambda c: F.try_to_timestamp(c, F.lit("MM/dd/yyyy")).cast("date")}
    typed = [kinds.get(c, lambda x: x.try_cast("double"))(F.col(f"`{c}`")).alias(c)
             for c in raw.columns if c != "line_no"]
    order = F.row_number().over(Window.orderBy("line_no"))       # one row a month
    return raw.select(order.cast("int").alias("line_no"), *typed)


CORRUPT = "__corrupt"

#: Tasks that list a folder's subfolders. Spark starts up to 10,000, one a subfolder, each of which
#: takes longer to start than to list it.
LISTING_TASKS = 200


@contextmanager
def few_listing_tasks(spark: SparkSession) -> Iterator[None]:
    """Loads inside list their folders in ``LISTING_TASKS`` tasks, or fewer where the session says so."""
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(int(before), LISTING_TASKS)))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _price_files(spark: SparkSession, folder: str, glob: str, schema: StructType, key_from: str) -> DataFrame:
    """The scan of both readers below: fields, the corrupt line and the file."""
    with_corrupt = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    reader = (spark.read.schema(with_corrupt).option("header", True).option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", CORRUPT).option("recursiveFileLookup", True)
              .option("pathGlobFilter", glob))
    with few_listing_tasks(spark):
        df = reader.csv(folder)
    df = df.withColumns({"__file": F.col("_metadata.file_name"), "__path": F.col("_metadata.file_path")})
    from_file = F.regexp_extract("__file", r"^(.*?)(\.[^.]*)?$", 1)
    # cut at the last slashes: this is done for every row, and a pattern would try each place of the path
    parent = F.substring_index(F.substring_index("__path", "/", -2), "/", 1)
    from_folder = F.url_decode(F.substring_index(parent, "=", -1))
    key = {"file": from_file, "folder": from_folder}[key_from]
    return df.withColumn("symbol", F.coalesce(F.col("symbol"), key) if "symbol" in schema.names else key).drop("__path")


def read_price_folder(spark: SparkSession, folder: str, glob: str = "*.csv",
                      schema: StructType = PRICE_SCHEMA, key_from: str = "file") -> DataFrame:
    """S2 + S4: every ``*.csv`` below a folder in one scan, fields that do not parse being null.

    A row's symbol falls back to the path when the column is empty: to the file name without
    extension (``key_from="file"``), or to the name of the file's folder, without a ``key=`` prefix
    (``"folder"``). The schema is given, so symbols stay text whatever they look like.
    """
    return typed_prices(_price_files(spark, folder, glob, schema, key_from).drop("__file", CORRUPT))


def scan_price_folder(spark: SparkSession, folder: str, glob: str = "*.csv", schema: StructType = PRICE_SCHEMA,
                      key_from: str = "file") -> tuple[DataFrame, DataFrame]:
    """S2 + S4 with rejects: (rows, rejects) of ``read_price_folder``'s files.

    ``rejects`` has ``symbol``, ``file`` and the raw ``line`` of every row with a field that does not
    parse; rows keep them with nulls in those fields. The scan is written once as a shared table that
    both read: a reader of some columns only would not try to parse the others.
    """
    df = cut_lineage(_price_files(spark, folder, glob, schema, key_from))
    rejects = df.where(F.col(CORRUPT).isNotNull()).select(
        "symbol", F.col("__file").alias("file"), F.col(CORRUPT).alias("line"))
    return typed_prices(df.drop("__file", CORRUPT)), rejects


def scan_sector_tree(spark: SparkSession, root: str, leaf: str = "file") -> tuple[DataFrame, DataFrame]:
    """S3: (members, rejects) of a tree ``root/<sector>/<TICKER>_<anything>``.

    ``leaf`` says what the last name is: a file's, or a folder's that holds files (any number).
    ``key=`` prefixes of folders are left out. ``members`` has distinct (sector, symbol); ``rejects`` the
    ``path`` of every file at another depth. Only the file listing is needed: ``binaryFile`` prunes
    the unused ``content`` column, so file bodies are never read.
    """
    with few_listing_tasks(spark):
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path")
    # components below the root, counted, so that the root's name is no pattern
    steps = len(spark._jvm.org.apache.hadoop.fs.Path(root).toUri().getPath().rstrip("/").split("/"))
    last = {"file": -1, "folder": -2}[leaf]
    parts = F.split(F.regexp_replace("path", "^[A-Za-z0-9+.-]+:(//[^/]*)?", ""), "/")
    name = lambda k: F.regexp_replace(F.element_at(parts, k), "^[^=]*=", "")
    stem = F.regexp_extract(name(last), r"^(.*?)(\.[^.]*)?$", 1)
    fits = F.size(parts) == steps + 1 - last
    members = files.where(fits).select(name(last - 1).alias("sector"), F.split(stem, "_")[0].alias("symbol")).distinct()
    return members, files.where(~fits)


def read_sector_tree(spark: SparkSession, root: str) -> DataFrame:
    """S3: (sector, symbol) from ``root/<sector>/<TICKER>_<anything>`` file names."""
    return scan_sector_tree(spark, root)[0]


def explode_payload(payloads: DataFrame, array_field: str, record: StructType,
                    text_col: str = "value", keep: Sequence[str] = ()
                    ) -> tuple[DataFrame, DataFrame]:
    """S5 + S6 + F16: JSON text ``{"<array_field>": [ {...}, ... ]}`` -> one row per record.

    Returns (rows, rejects). A payload without the array (or that is not valid JSON)
    goes to ``rejects`` with its text, instead of stopping the run.
    """
    schema = StructType([StructField(array_field, ArrayType(record))])
    parsed = payloads.withColumn("__p", F.from_json(F.col(text_col), schema))
    ok = F.col("__p").isNotNull() & F.col(f"__p.{array_field}").isNotNull()
    rows = (parsed.where(ok)
                  .select(*keep, F.explode(f"__p.{array_field}").alias("__r"))
                  .select(*keep, "__r.*"))
    rejects = parsed.where(~ok | F.col("__p").isNull()).select(*keep, F.col(text_col))
    return rows, rejects


def date_spine(spark: SparkSession, start: str, end: str) -> DataFrame:
    """S11 ``pd.date_range(start, end)``: one row per day (end is a parameter, never
    'today', so runs are reproducible)."""
    return spark.range(1).select(F.explode(F.sequence(F.to_date(F.lit(start)),
                                                      F.to_date(F.lit(end)),
                                                      F.expr("interval 1 day"))).alias("date"))


def month_end_spine(spark: SparkSession, start: str, end: str) -> DataFrame:
    """S12 ``pd.date_range(start, end, freq='ME')`` with the ``%Y-%m-%d`` text form."""
    bounds = spark.range(1).select(F.to_date(F.lit(start)).alias("lo"),
                                   F.to_date(F.lit(end)).alias("hi"))
    return month_end_spine_between(bounds)


def month_end_spine_between(bounds: DataFrame, lo: str = "lo", hi: str = "hi") -> DataFrame:
    """S12 from a one-row DataFrame of bounds (no driver round trip): month ends in
    [lo, hi], plus the ``yyyy-MM-dd`` text form."""
    months = F.sequence(F.trunc(F.col(lo), "MM"), F.col(hi), F.expr("interval 1 month"))
    spine = (bounds.select(lo, hi, F.explode(months).alias("m"))
                   .select(lo, hi, F.last_day("m").alias("date")))
    return (spine.where((F.col("date") >= F.col(lo)) & (F.col("date") <= F.col(hi)))
                 .select("date", F.date_format("date", "yyyy-MM-dd").alias("date_text")))


def symbol_batches(symbols: DataFrame, batch_size: int, col: str = "symbol") -> DataFrame:
    """Deterministic, gap-free batches of the symbol list (no skipped positions).

    Symbols are range-partitioned and numbered within their partition; a partition's offset
    is the number of symbols before it, from one count a partition. No task holds them all.
    """
    from pyspark.sql import Window
    ranged = cut_lineage(symbols.select(col).distinct().repartitionByRange(col)
                         .withColumn("__part", F.spark_partition_id()))
    sizes = ranged.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    before = F.coalesce(F.sum("__n").over(      # one row a partition
        Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select("__part", before.alias("__before"))
    at = F.row_number().over(Window.partitionBy("__part").orderBy(col)) - 1 + F.col("__before")
    return (ranged.join(offsets, "__part")
            .select(col, F.floor(at / batch_size).cast("int").alias("batch")))


def write_partitioned(df: DataFrame, path: str, key: str | Sequence[str], fmt: str = "parquet",
                      mode: str = "overwrite") -> None:
    """S8 + S9 + S10: one folder per key value; the writer creates folders as needed.

    The cost is in folders and files, not in bytes. So the number of tasks is given: adaptive
    execution would merge small partitions until one task wrote all folders.
    """
    keys = [key] if isinstance(key, str) else list(key)
    spark = df.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    (df.repartition(tasks, *keys).write.mode(mode).partitionBy(*keys).format(fmt)
       .option("header", True).save(path))


def publish(df: DataFrame, path: str, write: Callable[[DataFrame, str], None]) -> None:
    """S8-S10 as an idempotent job: write beside ``path``, then rename. A reader sees no half-written
    table; where ``path`` is there already, or another run publishes it first, it stays as it is."""
    spark = df.sparkSession
    at = lambda p: spark._jvm.org.apache.hadoop.fs.Path(p)
    fs = at(path).getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(at(path)):
        return
    draft = f"{path}.draft-{uuid.uuid4().hex}"
    write(df, draft)
    if fs.exists(at(path)) or not fs.rename(at(draft), at(path)):
        fs.delete(at(draft), True)


def read_partitioned(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Read a table with one folder per key value. The schema holds the key columns too, so their
    types are not guessed from folder names; filters on keys prune folders."""
    return spark.read.schema(schema).parquet(path)


def write_by_range(df: DataFrame, path: str, order: str, files: int) -> None:
    """A table clustered on ``order``: each file holds one range of it, sorted, so that a range
    filter skips files by their statistics."""
    df.repartitionByRange(files, order).sortWithinPartitions(order).write.mode("overwrite").parquet(path)
