"""SparkSession construction and lineage-cut helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str | None = None, app: str = "candlewick",
              shuffle_partitions: int | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the library relies on.

    On a cluster, pass ``master=None`` and let spark-submit decide; the defaults only
    pin what results depend on (UTC session time zone) and enable AQE.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = (b.config("spark.ui.enabled", "false")
          .config("spark.ui.showConsoleProgress", "false")
          .config("spark.sql.session.timeZone", "UTC")
          .config("spark.sql.adaptive.enabled", "true")
          .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
          .config("spark.sql.adaptive.skewJoin.enabled", "true")
          .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
          .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    if master and master.startswith("local"):
        # local mode: the driver JVM is the only executor
        b = b.config("spark.driver.memory", "16g")
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins. Only on a local master may it be unset (tests); a
    fresh scratch folder is then created and registered. On a cluster executors could not
    share such a folder, so an unset one is an error there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="candlewick-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


_scratch: dict[str, str] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, below one folder of this session that Hadoop deletes when
    the driver's JVM ends. Tables there are read as long as results are, so none goes earlier."""
    sc = spark.sparkContext
    root = _scratch.get(sc.applicationId)
    if root is None:
        root = f"{checkpoint_dir(spark)}/candlewick-{uuid.uuid4().hex}"
        path = sc._jvm.org.apache.hadoop.fs.Path(root)
        fs = path.getFileSystem(sc._jsc.hadoopConfiguration())
        fs.mkdirs(path)
        fs.deleteOnExit(path)
        _scratch[sc.applicationId] = root
    return f"{root}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` as a columnar table in the shared folder and read it back: readers take the
    columns they need, and a lost executor sends no work back beyond the table."""
    path = scratch_path(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
