"""Session settings and the shared folder used to cut lineage."""
from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_session(master: str | None = None, partitions: int | None = None, **conf: str) -> SparkSession:
    """A session with the engine's settings; ``conf`` overrides them."""
    builder = SparkSession.builder.appName("silsila")
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    if partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``.

    Only where the setting is absent (tests on one machine) a local folder is made.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = os.path.join(tempfile.gettempdir(), f"silsila-checkpoints-{os.getuid()}")
    context.setCheckpointDir(folder)
    return context.getCheckpointDir() or folder


def materialize(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back, so that a lost executor costs one re-read.

    A Parquet table keeps Catalyst's statistics and column pruning, which ``checkpoint()`` loses.
    """
    spark = df.sparkSession
    path = _stage(spark)
    df.write.mode("overwrite").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stage_path = path
    return out


def counted(df: DataFrame, condition: str = "true") -> tuple[DataFrame, int]:
    """``df`` as a stage, and how many of its rows meet the condition, counted as they are written."""
    seen = Observation()
    out = materialize(df.observe(seen, F.count_if(F.expr(condition)).alias("n")))
    return out, seen.get["n"]


def bucketed(df: DataFrame, column: str) -> DataFrame:
    """``df`` written to the shared folder in sorted buckets of ``column``.

    Joins and groupings on the column read the buckets as they lie: what meets the table is shuffled to its buckets, the
    table itself never again. There are as many buckets as shuffle partitions.
    """
    spark = df.sparkSession
    path, buckets = _stage(spark), int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"silsila_{path.rsplit('-', 1)[1]}"
    writer = df.repartition(buckets, column).write.format("parquet").mode("overwrite").option("path", path)
    writer.bucketBy(buckets, column).sortBy(column).saveAsTable(name)
    out = spark.table(name)
    out._stage_path, out._stage_table = path, name
    return out


def _stage(spark: SparkSession) -> str:
    """A new folder of the shared folder; what nothing has released by then goes when the driver ends."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/stage-{uuid.uuid4().hex}"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(target)
    files.deleteOnExit(target)
    return path


def release(*stages: DataFrame | None) -> None:
    """Deletes the files of stages that nothing reads any more; other DataFrames are left alone."""
    for df in stages:
        path = getattr(df, "_stage_path", None)
        if path:
            if table := getattr(df, "_stage_table", None):
                df.sparkSession.sql(f"DROP TABLE IF EXISTS {table}")
            jvm = df.sparkSession._jvm
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(target, True)
            df._stage_path = None


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores where its files give fewer partitions than there are cores; large inputs stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
