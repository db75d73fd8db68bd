"""Streams of events: exactly-once ingest, thresholds that trigger, and windows."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def source(spark: SparkSession, folder: str, name: str = "events", files: int = 10) -> DataFrame:
    """A table's Parquet files as a stream, ``files`` at a time."""
    at = f"{folder}/{name}.parquet"
    schema = spark.read.parquet(at).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).option("pathGlobFilter", "*.parquet").parquet(at if _is_folder(spark, at) else folder + f"/{name}*.parquet")


def _is_folder(spark: SparkSession, at: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(at)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path).isDirectory()


def first_seen(stream: DataFrame, key: Sequence[str]) -> DataFrame:
    """Every key once, at its first row. The state keeps all keys; with an event time use ``dropDuplicatesWithinWatermark``."""
    return stream.select(*key).dropDuplicates(list(key))


def threshold_crossings(stream: DataFrame, key: str, step: int) -> DataFrame:
    """(key, crossings) whenever a key's number of rows passes a multiple of ``step``; the state is a count for each key."""

    def of(name: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        before = state.get[0] if state.exists else 0
        now = before + sum(map(len, frames))
        state.update((now,))
        if now // step > before // step:
            yield pd.DataFrame({key: [name[0]], "crossings": [now // step]})

    return stream.select(key).groupBy(key).applyInPandasWithState(of, f"`{key}` string, crossings long", "n long", "update", GroupStateTimeout.NoTimeout)


def _timed(stream: DataFrame, time: str) -> DataFrame:
    """The stream with its time in the session's zone, as watermarks ask for."""
    return stream.withColumn(time, F.col(time).cast("timestamp"))


def windowed(stream: DataFrame, size: str, late: str, time: str = "ts", key: str = "event_type") -> DataFrame:
    """(start, key, n) in tumbling windows; rows more than ``late`` behind the latest are dropped."""
    by = _timed(stream, time).withWatermark(time, late).groupBy(F.window(time, size), key).agg(F.count(F.lit(1)).alias("n"))
    return by.select(F.col("window.start").alias("start"), key, "n")


def sessions(stream: DataFrame, gap: str, late: str, time: str = "ts", key: str = "user_id") -> DataFrame:
    """(key, start, end, n) of each key's runs of rows with no longer pause than ``gap``."""
    by = _timed(stream, time).withWatermark(time, late).groupBy(key, F.session_window(time, gap)).agg(F.count(F.lit(1)).alias("n"))
    return by.select(key, F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "n")


def into(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append"):
    """Run all that a stream's source holds now through ``write`` batch by batch; a repeated run goes on where the checkpoint ends."""
    query = stream.writeStream.foreachBatch(write).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def drained(stream: DataFrame, name: str, mode: str = "append", key: str | None = None, order: str | None = None) -> DataFrame:
    """The table that a stream has written when its source is read to the end; of updated keys the row largest by ``order``."""
    spark = stream.sparkSession
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        shared = f"file://{tempfile.mkdtemp(prefix='quillframe-')}"
    at = f"{shared.rstrip('/')}/stream-{name}-{uuid.uuid4().hex}"
    how = "overwrite" if mode == "complete" else "append"
    into(stream, lambda df, i: df.write.mode(how).parquet(f"{at}/table"), f"{at}/checkpoint", mode)
    out = spark.read.schema(stream.schema).parquet(f"{at}/table")
    if key is None:
        return out
    return out.groupBy(key).agg(F.max(order).alias(order))
