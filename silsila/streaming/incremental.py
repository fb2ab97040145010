"""Incremental runs: file streams with checkpoints, windows over event time, resumable work."""
from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir


def file_stream(spark: SparkSession, folder: str, schema, fmt: str = "parquet", glob: str | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).format(fmt)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(folder)


def run_available(stream: DataFrame, path: str, checkpoint: str, mode: str = "append", fmt: str = "parquet") -> None:
    """Reads all that is available into ``path`` and stops; a later run goes on where this one ended."""
    query = stream.writeStream.format(fmt).option("path", path).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start()
    query.awaitTermination()


def run_batches(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> None:
    query = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start()
    query.awaitTermination()


def tumbling(stream: DataFrame, time: str, width: str, keys: list[str], late: str = "1 day") -> DataFrame:
    """Counts by window and keys; rows later than ``late`` behind the newest are left out of closed windows."""
    return stream.withWatermark(time, late).groupBy(F.window(time, width), *keys).agg(F.count("*").alias("n"))


def sessions(df: DataFrame, time: str, gap: str, keys: list[str]) -> DataFrame:
    """Sessions closed by a pause of ``gap``: start, end and number of rows."""
    rows = df.groupBy(F.session_window(time, gap).alias("s"), *keys).agg(F.count("*").alias("n"))
    return rows.select(*keys, F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"), "n")


def daily_counts_stream(spark: SparkSession, path: str) -> DataFrame:
    """Events by type and day, counted by a stream over the files at ``path`` and read back."""
    base = f"{checkpoint_dir(spark).rstrip('/')}/stream-{uuid.uuid4().hex}"
    schema = spark.read.parquet(path).schema
    folder, name = (path, None) if os.path.isdir(path) else (os.path.dirname(path), os.path.basename(path))
    stream = file_stream(spark, folder, schema, glob=name)
    daily = stream.groupBy("event_type", F.date_trunc("day", "ts").alias("day")).agg(F.count("*").alias("n"))

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{base}/out")  # a complete result takes the place of the one before

    run_batches(daily, keep, f"{base}/state", "complete")
    return spark.read.parquet(f"{base}/out")


def pending(targets: DataFrame, log: DataFrame, key: str) -> DataFrame:
    """Targets without a row of the append log that ended without an error."""
    done = log.where("error is null").select(key).distinct()
    return targets.join(done, key, "left_anti")
