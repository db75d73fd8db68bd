"""Lookups in a store of entities and the entries that name them.

Every limit has an order with a unique last key, so results are the same at
any number of partitions; order and limit together are one top-k step.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def search_counts(entities: DataFrame, links: DataFrame, key: str, link_key: str, name: str, pattern: str, limit: int) -> DataFrame:
    """(key, name, n): entities whose name matches, with the number of their links, most first, ties by key.

    The links are counted by key before the join, so only one row for each
    entity is joined however many links it has.
    """
    counts = links.where(F.col(link_key).isNotNull()).groupBy(F.col(link_key).alias(key)).agg(F.count(F.lit(1)).alias("n"))
    matched = entities.where(F.col(name).ilike(pattern)).select(key, name)
    return matched.join(counts, key, "left").select(key, name, F.coalesce("n", F.lit(0)).alias("n")).orderBy(F.desc("n"), key).limit(limit)


def chain(first: DataFrame, *steps: tuple[DataFrame, str, str]) -> DataFrame:
    """Inner equi-joins one after the other: (table, key so far, key of the table)."""
    out = first
    for other, left, right in steps:
        out = out.join(other, F.col(left) == F.col(right))
    return out


def orphans(parents: DataFrame, children: DataFrame, key: str, child_key: str) -> DataFrame:
    """Parents without children; null keys of children match nothing."""
    return parents.join(children.select(F.col(child_key).alias(key)), key, "left_anti")


def not_in(df: DataFrame, key: str, others: DataFrame, other_key: str) -> DataFrame:
    """Rows whose key is not among the others' (SQL's NOT IN where the others' key has no nulls)."""
    return orphans(df, others.where(F.col(other_key).isNotNull()).distinct(), key, other_key)


def first_per_key(df: DataFrame, key: Sequence[str], order: Sequence[Column], n: int = 1, rank: str | None = None) -> DataFrame:
    """The first n rows of every key in an order; ``rank`` keeps their number under that name."""
    out = df.withColumn(rank or "__rank", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where(
        F.col(rank or "__rank") <= n
    )
    return out if rank else out.drop("__rank")


def with_fallback(requests: DataFrame, request: str, table: DataFrame, key: str) -> DataFrame:
    """Requests joined with the rows of their key; those without any are tried again without a letter at their end."""
    direct = requests.join(table, requests[request] == table[key])
    missed = requests.join(table.select(F.col(key).alias(request)), request, "left_anti")
    shorter = missed.where(F.col(request).rlike("[A-Za-z]$")).withColumn("__short", F.expr(f"left(`{request}`, length(`{request}`) - 1)"))
    again = shorter.join(table, shorter["__short"] == table[key]).drop("__short")
    return direct.unionByName(again)


def zero_padded(column: Column, widths: Sequence[int] = (2, 3)) -> Column:
    """A number's spellings: as it is, and with zeros in front up to each width."""
    text = column.cast("string")
    return F.array_distinct(F.array(text, *[F.when(F.length(text) < w, F.lpad(text, w, "0")).otherwise(text) for w in widths]))


def any_of_names(df: DataFrame, names: Sequence[str], wanted: DataFrame, wanted_name: str) -> DataFrame:
    """Distinct rows with any of several name columns equal to a wanted one, case aside: one equi-join for each column."""
    target = wanted.select(F.lower(wanted_name).alias("__name")).distinct()
    parts = [df.join(target, F.lower(n) == F.col("__name"), "left_semi") for n in names]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.distinct()


def null_safe_match(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join on keys of which nulls equal each other."""
    right = b.select(*[F.col(k).alias(f"__{k}") if k in keys else F.col(k) for k in b.columns])
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"__{k}"))
    return a.join(right, on).drop(*[f"__{k}" for k in keys])


def by_listed_order(column: Column, values: Sequence[str]) -> Column:
    """A rank for each of some values, in their order; others come after them."""
    out = F.when(column == values[0], 0)
    for i, v in enumerate(values[1:], 1):
        out = out.when(column == v, i)
    return out.otherwise(len(values))


def overlay(base: DataFrame, changes: DataFrame, key: Sequence[str], column: str) -> DataFrame:
    """``base`` with ``column`` taken from ``changes`` where that has a row and value for the key, and ``source`` telling which."""
    new = changes.select(*key, F.col(column).alias("__new"))
    return base.join(new, list(key), "left").withColumn(
        "source", F.when(F.col("__new").isNotNull(), "changed").otherwise("original")
    ).withColumn(column, F.coalesce("__new", column)).drop("__new")


def _blocks(df: DataFrame, key: str, vector: str, size: int, name: str) -> DataFrame:
    """Rows packed into about ``size`` a block: (<name>_ids, <name>_flat)."""
    n = max(1, -(-df.count() // size))
    packed = df.groupBy(F.pmod(F.xxhash64(key), F.lit(n)).alias("b")).agg(F.collect_list(F.struct(F.col(key).alias("id"), F.col(vector).alias("v"))).alias("rows"))
    return packed.select(F.col("rows.id").alias(f"{name}_ids"), F.flatten("rows.v").alias(f"{name}_flat"))


def nearest_by_cosine(queries: DataFrame, rows: DataFrame, key: str, vector: str, keep: int, digits: int = 6, block: int = 1024) -> DataFrame:
    """(query, key, score, place): of every query the ``keep`` other rows with the largest cosine, rounded, ties to the smaller key.

    Every query meets every row, a block of each at a time as one product of
    matrices. A block gives what could tie with its ``keep``-th after rounding.
    Vectors are not null; the score is null where one is zero.
    """
    kind = rows.schema[key].dataType.simpleString()

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                ids, flat, others, flats = (batch[c][r].values for c in ("q_ids", "q_flat", "r_ids", "r_flat"))
                q, e = (f.to_numpy(zero_copy_only=False).astype(float).reshape(len(i), -1) for i, f in ((ids, flat), (others, flats)))
                norms = np.outer(np.sqrt((q * q).sum(1)), np.sqrt((e * e).sum(1)))
                s = np.divide(q @ e.T, norms, out=np.full(norms.shape, -np.inf), where=norms > 0)
                mine, other = ids.to_numpy(zero_copy_only=False), others.to_numpy(zero_copy_only=False)
                same = mine[:, None] == other[None, :]
                ranked = np.where(same, -np.inf, s)
                least = np.partition(ranked, max(0, s.shape[1] - keep), axis=1)[:, max(0, s.shape[1] - keep)] - 2 * 10.0**-digits
                i, j = np.nonzero((ranked >= least[:, None]) & ~same)
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(i)), others.take(pa.array(j)), pa.array(s[i, j])], names=["query", key, "score"])

    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pairs = _blocks(rows, key, vector, block, "r").repartition(n).crossJoin(_blocks(queries, key, vector, block, "q"))
    found = pairs.mapInArrow(of, f"query {kind}, `{key}` {kind}, score double")
    scored = found.withColumn("score", F.when(F.col("score") > float("-inf"), F.round("score", digits)))
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), key))
    return scored.withColumn("place", place).where(F.col("place") <= keep)
