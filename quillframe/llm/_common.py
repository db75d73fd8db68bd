"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import json
import re
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from typing import TypeVar

from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

T = TypeVar("T")
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as ``spark.checkpoint.dir`` names it.

    Only a local master (tests) gets a temporary folder when the setting is
    absent; on a cluster an unset folder is an error.
    """
    at = spark.conf.get("spark.checkpoint.dir", None)
    if at:
        return at.rstrip("/")
    sc = spark.sparkContext
    if not sc.master.startswith("local[") and sc.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    at = f"file://{tempfile.mkdtemp(prefix='quillframe-')}"
    spark.conf.set("spark.checkpoint.dir", at)
    return at


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A folder below the shared one that no earlier call returned."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, files: int | None = None) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read again; as few as ``files`` files, for a table that is small beside the input.

    This cuts the lineage at a table that every executor can read, so a lost
    executor costs the tasks it was running and nothing before them.
    """
    spark = df.sparkSession
    at = fresh_dir(spark, name)
    (df.coalesce(files) if files else df).write.parquet(at)
    return spark.read.schema(df.schema).parquet(at)


def _bytes(setting: str) -> int:
    """Bytes of a Spark size such as ``64m`` or ``67108864b``; without a unit it counts bytes."""
    digits, unit = re.fullmatch(r"(-?\d+)\s*([a-z]*)", setting.strip().lower()).groups()
    return int(digits) << {"k": 10, "m": 20, "g": 30, "t": 40}.get(unit[:1], 0)


def constant_table(spark: SparkSession, rows: Iterable[tuple], ddl: str) -> DataFrame:
    """A table of a few rows that are part of the plan, so no Python worker has a hand in it."""
    names = StructType.fromDDL(ddl).names
    whole = json.dumps([dict(zip(names, r)) for r in rows])
    return spark.range(1).select(F.inline(F.from_json(F.lit(whole), f"array<struct<{ddl}>>")))


def small_batches(spark: SparkSession, limit: str = "4m") -> None:
    """Bound the bytes of an Arrow batch, so very long texts do not pile up in a Python worker.

    Spark's own setting of this session is lowered where it is larger than
    ``limit`` or unbounded (not positive), and never raised.
    """
    now = spark.conf.get(_BATCH_BYTES, None)
    if now is None or not 0 < _bytes(now) <= _bytes(limit):
        spark.conf.set(_BATCH_BYTES, limit)


def forgotten(found: Iterator[T], forget: Callable[[], None]) -> Iterator[T]:
    """``found``, and then ``forget``, also if the task fails or ends early: workers are reused, and what one operator looked up must not weigh on the next."""
    try:
        yield from found
    finally:
        forget()
        trim()


def trim() -> None:
    """Give the memory that this process has freed back to the machine, where its C library can."""
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):
        pass


def file_system(uri: str):
    """(pyarrow file system, path) of a folder or file of the shared storage."""
    from pyarrow import fs

    if "://" not in uri and ":/" not in uri:
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    return fs.FileSystem.from_uri(uri)


def task_id() -> tuple[int, int]:
    """(partition id, attempt id) of the running task; zeros outside one."""
    at = TaskContext.get()
    return (at.partitionId(), at.taskAttemptId()) if at else (0, 0)


def partitions(spark: SparkSession, at_least: int = 1) -> int:
    """The number of partitions that shuffles of this session use."""
    return max(at_least, int(spark.conf.get("spark.sql.shuffle.partitions")))


def extended(df: DataFrame, name: str, ddl: str, to: str = "") -> StructType:
    """The schema of a column of ``df`` (named ``to`` if given) followed by those of ``ddl``."""
    return StructType([StructField(to or name, df.schema[name].dataType), *StructType.fromDDL(ddl).fields])


def packed(df: DataFrame, *columns: str) -> DataFrame:
    """(row, *columns): every row of ``df`` as a struct, to travel through an operator in the place of an id."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), *columns)
