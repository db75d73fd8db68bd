"""Connected components of a link table, by alternating star contractions.

Each round replaces links by shorter ones towards the smallest node seen, as
two aggregations with a join each; no node's links are gathered in one place,
so a hub that holds a third of all links costs no more than its share.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import written


def _state(links: DataFrame) -> tuple[int, int]:
    row = links.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return row["n"], row["x"] or 0


def _large_star(links: DataFrame) -> DataFrame:
    """Each neighbour above a node is linked to the smallest node around that node."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    return (
        both.where(F.col("v") > F.col("u"))
        .join(least, "u")
        .select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
        .where(F.col("u") != F.col("v"))
        .distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    """Each node and its neighbours below it are linked to the smallest of them."""
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return (
        moved.unionByName(least.select("u", F.col("m").alias("v")))
        .where(F.col("u") != F.col("v"))
        .distinct()
    )


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``links`` (u, v); root is the component's smallest node.

    ``links`` may hold both directions, repeats and self-links (a node with only
    self-links is its own root); nulls on either side are no link. An empty
    table gives an empty table. The rounds needed grow with the logarithm of
    the longest chain; more than ``max_rounds`` raises an error instead of
    returning parts of a component.
    """
    links = links.select("u", "v").where(F.col("u").isNotNull() & F.col("v").isNotNull())
    alone = links.where(F.col("u") == F.col("v")).select("u").distinct()
    now = written(
        links.where(F.col("u") != F.col("v"))
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct(),
        "links",
    )
    before = _state(now)
    for _ in range(max_rounds if before[0] else 0):
        now = written(_small_star(_large_star(now)), "links")
        after = _state(now)
        if after == before:
            break
        before = after
    else:
        if before[0]:
            raise RuntimeError(f"components: no fixed point in {max_rounds} rounds")
    roots = now.select(F.col("v").alias("u")).distinct().withColumn("v", F.col("u"))
    tied = now.unionByName(roots)
    return tied.unionByName(
        alone.join(tied, "u", "left_anti").select("u", F.col("u").alias("v"))
    ).select(F.col("u").alias("node"), F.col("v").alias("root"))
