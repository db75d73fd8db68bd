"""Sessions and tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def session(name: str = "quillframe", **conf: str) -> SparkSession:
    """The running session, or one with adaptive execution and UTC; ``conf`` adds settings, dots as double underscores."""
    builder = SparkSession.builder.appName(name).config("spark.sql.session.timeZone", "UTC")
    builder = builder.config("spark.sql.adaptive.enabled", "true").config("spark.sql.adaptive.skewJoin.enabled", "true")
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of a folder of Parquet files."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def register(spark: SparkSession, folder: str, names: tuple[str, ...] = TABLES) -> None:
    """Temporary views of the folder's tables, for SQL."""
    for name in names:
        table(spark, folder, name).createOrReplaceTempView(name)


def describe(df: DataFrame) -> list[tuple[str, str, bool]]:
    """(name, type, nullable) of a table's columns."""
    return [(f.name, f.dataType.simpleString(), f.nullable) for f in df.schema.fields]
