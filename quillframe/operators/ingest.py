"""Ingest into a store: content hashes, bridges, and writes that merge with what is there."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def content_key(text: Column) -> Column:
    """The identity of a text: the SHA-256 of its UTF-8 in hex."""
    return F.sha2(text.cast("binary"), 256)


def deduplicated(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(hash, first_id, n): distinct non-empty texts with the smallest id and the number of rows, counted before any shuffle."""
    rows = df.where(F.col(text_col).isNotNull() & (F.col(text_col) != "")).select(id_col, content_key(F.col(text_col)).alias("hash"))
    return rows.groupBy("hash").agg(F.min(id_col).alias("first_id"), F.count(F.lit(1)).alias("n"))


def insert_new(stored: DataFrame, batch: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The rows of a batch to append: keys not stored yet, of each the first in order."""
    fresh = batch.join(stored.select(*key).distinct(), list(key), "left_anti")
    first = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return fresh.withColumn("__n", first).where("__n = 1").drop("__n")


def ingest_counts(stored: DataFrame, batch: DataFrame, id_col: str, hash_col: str) -> DataFrame:
    """(new, duplicate): how many rows of a batch are new and how many are stored already or repeated in the batch."""
    known = stored.select(hash_col).distinct().withColumn("__known", F.lit(True))
    by = batch.groupBy(hash_col).agg(F.count(F.lit(1)).alias("n")).join(known, hash_col, "left")
    new = F.when(F.col("__known").isNull(), 1).otherwise(0)
    return by.agg(F.coalesce(F.sum(new), F.lit(0)).alias("new"), F.coalesce(F.sum(F.col("n") - new), F.lit(0)).alias("duplicate"))


def bridge(df: DataFrame, id_col: str, items: Column, item_name: str) -> DataFrame:
    """(id_col, item) pairs, distinct: one row's items are made distinct in the row already, so no pair is shuffled twice for one row."""
    return (
        df.select(id_col, F.explode(F.array_distinct(items)).alias(item_name)).where(F.col(item_name).isNotNull() & (F.col(item_name) != "")).distinct()
    )


def upsert_sum(stored: DataFrame, batch: DataFrame, key: Sequence[str], value: str) -> DataFrame:
    """The store after adding a batch's values to those of equal keys."""
    both = stored.select(*key, value).unionByName(batch.select(*key, value))
    return both.groupBy(*key).agg(F.sum(value).alias(value))


def latest(df: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The last row of each key; ``order`` sorts the latest first and ends with a unique column."""
    return df.withColumn("__n", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where("__n = 1").drop("__n")


def cascade_delete(children: dict[str, DataFrame], gone: DataFrame, keys: dict[str, str], key: str) -> dict[str, DataFrame]:
    """Child tables without the rows of deleted parents."""
    return {n: df.join(gone.select(F.col(key).alias(keys[n])), keys[n], "left_anti") for n, df in children.items()}


def surname_bridge(persons: DataFrame, id_col: str, surname: Column, bridge: DataFrame) -> DataFrame:
    """(id_col, surname) for persons that the bridge lacks, in one anti-join; names without a surname get none."""
    found = persons.select(id_col, surname.alias("surname")).where(F.coalesce(F.col("surname"), F.lit("")) != "").distinct()
    return found.join(bridge.select(id_col).distinct(), id_col, "left_anti")


def advanced(jobs: DataFrame, key: list[str], results: DataFrame, limit: int) -> DataFrame:
    """Jobs after a round: those with a result become completed, or failed where it has an error, and of the pending the first ``limit`` are in progress.

    Jobs left in progress without a result, as after a crash, are pending again.
    """
    after = jobs.join(results.select(*key, "error"), key, "left").join(results.select(*key).withColumn("__done", F.lit(True)).distinct(), key, "left")
    status = F.when(F.col("__done") & F.col("error").isNotNull(), "failed").when(F.col("__done"), "completed").when(F.col("status") == "in_progress", "pending").otherwise(F.col("status"))
    after = after.select(*key, status.alias("status"))
    first = after.where(F.col("status") == "pending").orderBy(*key).limit(limit).select(*key, F.lit(True).alias("__next"))
    return after.join(first, key, "left").select(*key, F.when(F.col("__next"), "in_progress").otherwise(F.col("status")).alias("status"))


def split_prefixes(df: DataFrame, text: str, limit: int, longest: int) -> DataFrame:
    """(prefix, n): the shortest beginnings that at most ``limit`` texts share, so that every search returns all it finds; ``longest`` ones stay as they are."""
    t = F.lower(F.col(text))
    starts = F.array_distinct(F.transform(F.sequence(F.lit(1), F.lit(longest)), lambda n: F.substring(t, F.lit(1), n)))
    counts = df.where(F.length(text) > 0).select(F.explode(starts).alias("prefix")).groupBy("prefix").agg(F.count(F.lit(1)).alias("n"))
    above = counts.select(F.col("prefix").alias("__up"), F.col("n").alias("__n"))
    up = F.expr("substring(prefix, 1, length(prefix) - 1)")
    found = counts.join(above, up == F.col("__up"), "left")
    crowded = (F.length("prefix") == 1) | (F.col("__n") > limit)
    return found.where(crowded & ((F.col("n") <= limit) | (F.length("prefix") == longest))).select("prefix", "n")


def unfinished(groups: DataFrame, key: str, done: DataFrame) -> DataFrame:
    """Groups that are not done yet."""
    return groups.join(done.select(key).distinct(), key, "left_anti")


def requeued(images: DataFrame, key: str, processed: DataFrame, corrected: DataFrame) -> DataFrame:
    """Images that were processed and not corrected, to be taken again."""
    return images.join(processed.select(key).distinct(), key, "left_semi").join(corrected.select(key).distinct(), key, "left_anti")
