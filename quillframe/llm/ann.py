"""Approximate nearest neighbours by inner product: an inverted file with product quantisation.

Coarse centroids split the vectors into lists; what a vector differs from its
centroid is coded by product quantisation. A query visits the lists whose
centroids are nearest, estimates every vector in them from a table of its
products with the code words (asymmetric distances), and keeps those that can,
by their coding errors, be among the nearest of all that were estimated. These
alone are fetched and ranked by their exact products.

Equal vectors are one entry of the index, with the smallest ids that have it,
so a vector that a third of all rows share costs no more than another. Only
codes and queries are dealt to the scan, in shards of whole lists (a crowded
list is several) and groups of queries, so that codes travel once for
thousands of queries. Centroids and code books are fitted on a bounded sample,
and so is the number of lists to visit; all vectors are indexed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._common import partitions, small_batches, written

SAMPLE = 16_384  # vectors that the index is fitted on; a sixteenth of them is the most lists there can be
PARTS = 32
WORDS = 256
TARGET = 0.97
MARGIN = 3.0
SHARD = 1 << 16
GROUP = 1 << 12
_CELLS = 1 << 22  # estimates held at once
_PROBE_QUERIES = 200


@dataclass
class Index:
    """Coarse centroids, code books by part (dimensions cut evenly), and how many lists, and with how many of the sample, a query visits."""

    centroids: np.ndarray
    books: list[np.ndarray]
    cuts: list[int]
    probes: int
    sizes: np.ndarray
    least: int

    def assign(self, x: np.ndarray) -> np.ndarray:
        """The list of each vector, by least distance."""
        return nearest(x, self.centroids)

    def code(self, x: np.ndarray, lists: np.ndarray) -> np.ndarray:
        rest = x - self.centroids[lists]
        return np.stack([nearest(rest[:, a:b], book) for a, b, book in zip(self.cuts, self.cuts[1:], self.books)], axis=1).astype(np.uint8)

    def visits(self, q: np.ndarray) -> np.ndarray:
        """Whether each query (rows) visits each list: those of the centroids with the largest product, which by itself orders them."""
        order = np.argsort(-(q @ self.centroids.T), axis=1, kind="stable")
        enough = np.argmax(np.cumsum(self.sizes[order], axis=1) >= min(self.least, self.sizes.sum()), axis=1)
        inside = np.arange(order.shape[1])[None, :] <= np.maximum(enough, self.probes - 1)[:, None]
        out = np.zeros(order.shape, bool)
        np.put_along_axis(out, order, inside, axis=1)
        return out

    def tables(self, q: np.ndarray) -> list[np.ndarray]:
        """For each part, the products of its code words (rows) with queries (columns)."""
        return [(book @ q[:, a:b].T).astype(np.float32) for a, b, book in zip(self.cuts, self.cuts[1:], self.books)]

    def rebuilt(self, lists: np.ndarray, codes: np.ndarray) -> np.ndarray:
        return self.centroids[lists] + np.concatenate([book[codes[:, j]] for j, book in enumerate(self.books)], axis=1)


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    half = 0.5 * np.square(centres).sum(axis=1)
    return np.concatenate([(x[i:i + 4096] @ centres.T - half).argmax(axis=1) for i in range(0, len(x), 4096)] or [np.zeros(0, np.int64)])


def k_means(x: np.ndarray, k: int, rng: np.random.Generator, steps: int = 10) -> np.ndarray:
    """At most k centres of the rows of x."""
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(steps):
        own = nearest(x, centres)
        sizes = np.bincount(own, minlength=len(centres))
        order = np.argsort(own, kind="stable")
        filled = sizes > 0
        starts = np.concatenate(([0], np.cumsum(sizes)))[:-1][filled]
        centres[filled] = np.add.reduceat(x[order], starts, axis=0) / sizes[filled, None]
        if (~filled).any():
            centres[~filled] = x[rng.choice(len(x), int((~filled).sum()))]
    return centres


def fit(sample: np.ndarray, total: int, k: int, target: float = TARGET, seed: int = 4) -> Index:
    """An index from a sample of ``total`` vectors, visiting as many lists as the sample's k nearest need for ``target`` recall."""
    rng = np.random.default_rng(seed)
    dim = sample.shape[1]
    lists = int(max(1, min(len(sample) // 16, round(total**0.5))))
    centroids = k_means(sample, lists, rng)
    own = nearest(sample, centroids)
    rest = sample - centroids[own]
    parts = min(PARTS, dim)
    cuts = [dim * i // parts for i in range(parts + 1)]
    books = [k_means(rest[:, a:b], WORDS, rng, 6) for a, b in zip(cuts, cuts[1:])]
    queries = sample[rng.choice(len(sample), min(_PROBE_QUERIES, len(sample)), replace=False)]
    products = queries @ sample.T
    n = min(len(sample), max(1, min(k + 1, round((k + 1) * max(1.0, len(sample) / total)))))
    best = own[np.argpartition(-products, n - 1, axis=1)[:, :n]]
    place = np.empty((len(queries), len(centroids)), np.int64)
    np.put_along_axis(place, np.argsort(-(queries @ centroids.T), axis=1), np.arange(len(centroids))[None, :], axis=1)
    needed = np.sort(np.take_along_axis(place, best, axis=1).ravel())
    probes = int(needed[min(len(needed) - 1, int(np.ceil(target * len(needed))))]) + 1
    return Index(centroids, books, cuts, probes, np.bincount(own, minlength=len(centroids)), k + 1)


def usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v) of the rows with an id and a vector that is not null, empty or zero and has finite components only."""
    v = F.col("v")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (
        df.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v"))
        .where(F.col("id").isNotNull() & v.isNotNull() & (F.size(v) > 0))
        .where(fine & F.exists(v, lambda x: x != 0))
    )


def distinct_vectors(vectors: DataFrame, k: int) -> DataFrame:
    """(entry, v, members): each vector once, with the k + 1 smallest ids that have it and how many rows each.

    No more of equal vectors can be among a row's k nearest, as ties go to the smaller id.
    """
    by_id = vectors.groupBy("v", "id").agg(F.count(F.lit(1)).alias("n"))
    first = by_id.withColumn("at", F.row_number().over(Window.partitionBy("v").orderBy("id"))).where(F.col("at") <= k + 1)
    found = first.groupBy("v").agg(F.array_sort(F.collect_list(F.struct("id", "n"))).alias("members"))
    return written(found.select(F.monotonically_increasing_id().alias("entry"), "v", "members"), "vectors")


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    flat = column.flatten() if isinstance(column, pa.Array) else column.combine_chunks().flatten()
    return np.asarray(flat, np.float64).reshape(len(column), -1)


def scan(index: Index, k: int, entries: pa.Table, queries: pa.Table) -> pa.Table:
    """(query, entry, guess, most) of what the queries' estimates leave possible among coded entries of one shard.

    ``most`` is the estimate and ``MARGIN`` times its standard error; it must
    reach the query's floor, and the k + 1-st best estimate here.
    """
    lists = entries["list"].to_numpy()
    order = np.argsort(lists, kind="stable")
    lists, ids = lists[order], entries["entry"].to_numpy()[order]
    codes = np.frombuffer(b"".join(entries["code"].to_pylist()), np.uint8).reshape(len(ids), -1)[order]
    error = entries["error"].to_numpy()[order].astype(np.float32)
    starts = np.concatenate(([0], np.nonzero(np.diff(lists))[0] + 1, [len(lists)]))
    asks, floors = queries["entry"].to_numpy(), queries["floor"].to_numpy()
    q = _matrix(queries["v"])
    visits = np.unpackbits(np.frombuffer(b"".join(queries["lists"].to_pylist()), np.uint8).reshape(len(q), -1), axis=1).astype(bool)
    out: list[tuple[np.ndarray, ...]] = []
    step = max(1, _CELLS // len(ids))
    for at in range(0, len(asks), step):
        part = q[at:at + step]
        go, tables = visits[at:at + step], index.tables(part)
        base = (index.centroids @ part.T).astype(np.float32)
        guess = np.full((len(ids), len(part)), -np.inf, np.float32)
        for a, b in zip(starts, starts[1:]):
            on = np.nonzero(go[:, lists[a]])[0]
            if len(on):
                sums = np.repeat(base[[lists[a]]][:, on], b - a, axis=0)
                for j, table in enumerate(tables):
                    sums += (table if len(on) == len(part) else table[:, on])[codes[a:b, j]]
                guess[a:b, on] = sums
        least = floors[at:at + step].astype(np.float32)
        if len(ids) > k + 1:
            least = np.maximum(least, np.partition(guess, len(ids) - k - 1, axis=0)[len(ids) - k - 1])
        most = guess + error[:, None] * np.linalg.norm(part, axis=1).astype(np.float32)
        row, column = np.nonzero((most >= least) & (guess > -np.inf))
        out.append((asks[at + column], ids[row], guess[row, column], most[row, column]))
    columns = [np.concatenate(x) for x in zip(*out)]
    return pa.table(dict(zip(("query", "entry", "guess", "most"), map(pa.array, columns))))


def search(
    df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 20, every: int = 20,
    sample: int = SAMPLE, shard: int = SHARD, group: int = GROUP,
) -> DataFrame:
    """(query_id, rank, id_col, score): for every row whose id ``every`` divides, the k rows of largest product found.

    A row is no neighbour of itself, that is of its id. Products are exact, in
    double precision; nearest first, equal products by smaller id. Null, empty
    or zero vectors, and those with null or non-finite components, take no
    part, nor do null ids or vectors of another than the commonest length, for
    which there is no product. Of rows that repeat an id and vector each is a
    candidate, and a query once; an id with several vectors asks with the
    smallest of them. Other columns are ignored; an empty table gives an empty one.
    """
    spark = df.sparkSession
    small_batches(spark)
    vectors = usable(df, id_col, vector_col)
    lengths = vectors.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").first()
    empty = spark.createDataFrame([], "query_id long, rank int, id long, score double").withColumnRenamed("id", id_col)
    if lengths is None:
        return empty
    dim = lengths["d"]
    vectors = vectors.where(F.size("v") == dim)
    entries = distinct_vectors(vectors, k)
    total = entries.count()
    share = min(1.0, sample / total)
    chosen = entries.where(F.pmod(F.xxhash64("v", F.lit(4)), F.lit(1 << 20)) < share * (1 << 20)).select("v")
    rows = chosen.toPandas()["v"].tolist() or [r["v"] for r in entries.select("v").limit(1).collect()]
    known = np.array(sorted(map(tuple, rows)), np.float64)
    index = spark.sparkContext.broadcast(fit(known, total, k))
    some = spark.sparkContext.broadcast(known)
    kind = entries.schema["v"].dataType.simpleString()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column(1))
                own = index.value.assign(x)
                codes = index.value.code(x, own)
                error = MARGIN * np.sqrt(np.square(x - index.value.rebuilt(own, codes)).mean(axis=1))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(own.astype(np.int32)), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(error.astype(np.float32))],
                    names=["entry", "list", "code", "error"],
                )

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The k + 1-st best estimate among the sample's vectors in the lists visited: the scan finds as many at least.
        own = index.value.assign(some.value)
        seen = index.value.rebuilt(own, index.value.code(some.value, own)).astype(np.float32)
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                q = _matrix(part.column(1))
                go = index.value.visits(q)
                guess = np.where(go[:, own], q.astype(np.float32) @ seen.T, np.float32(-np.inf))
                n = guess.shape[1]
                floor = np.partition(guess, n - k - 1, axis=1)[:, n - k - 1].astype(np.float64) if n > k else np.full(len(q), -np.inf)
                floor -= 1e-4 * np.linalg.norm(q, axis=1) * np.abs(seen).max()
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(floor), pa.array([x.tobytes() for x in np.packbits(go, axis=1)], pa.binary())], names=["entry", "v", "floor", "lists"]
                )

    coded = written(entries.select("entry", "v").mapInArrow(place, "entry long, list int, code binary, error float"), "codes")
    asking = vectors.where(F.pmod("id", F.lit(every)) == 0).groupBy("id").agg(F.min("v").alias("v"))
    asking = written(asking.join(entries.select("entry", "v"), "v").select("id", "entry"), "asking")
    queries = written(
        entries.join(asking.select("entry").distinct(), "entry", "left_semi").select("entry", "v").mapInArrow(ask, f"entry long, v {kind}, floor double, lists binary"), "queries"
    )
    asked = queries.count()
    if not asked:
        return empty
    shards, groups = partitions(spark, -(-total // shard)), -(-asked // group)
    sizes = coded.groupBy("list").agg(F.count(F.lit(1)).alias("n"))  # at most a sixteenth of ``sample`` rows
    sizes = sizes.select("list", F.ceil(F.col("n") * shards / total).alias("pieces"))
    spread = lambda n, *cols: F.pmod(F.xxhash64(*cols), n).cast("int")
    left = coded.join(F.broadcast(sizes), "list").select(
        spread(F.lit(shards), F.col("list"), spread(F.col("pieces"), F.col("entry"))).alias("shard"),
        F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"), "entry", "list", "code", "error",
    )
    right = queries.select(
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), spread(F.lit(groups), F.col("entry")).alias("group"), "entry", "v", "floor", "lists"
    )

    def near(a: pa.Table, b: pa.Table) -> pa.Table:
        if a.num_rows and b.num_rows:
            return scan(index.value, k, a, b)
        return pa.table({"query": pa.array([], pa.int64()), "entry": pa.array([], pa.int64()), "guess": pa.array([], pa.float32()), "most": pa.array([], pa.float32())})

    pair = ["shard", "group"]
    found = left.groupBy(*pair).cogroup(right.groupBy(*pair)).applyInArrow(near, "query long, entry long, guess float, most float")
    of_query = Window.partitionBy("query")
    found = found.withColumn("at", F.row_number().over(of_query.orderBy(F.desc("guess"), "entry")))
    found = found.withColumn("floor", F.max(F.when(F.col("at") == k + 1, F.col("guess"))).over(of_query))
    found = written(found.where(F.col("floor").isNull() | (F.col("most") >= F.col("floor"))).select("query", "entry"), "possible")

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                scores = np.einsum("ij,ij->i", _matrix(batch.column(2)), _matrix(batch.column(3)))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(scores)], names=["query", "members", "score"])

    fetched = found.join(entries, "entry").select("query", "members", "v")
    fetched = fetched.join(queries.select(F.col("entry").alias("query"), F.col("v").alias("q")), "query").select("query", "members", "v", "q")
    scored = fetched.mapInArrow(products, "query long, members array<struct<id: long, n: long>>, score double")
    scored = scored.select("query", "score", F.explode("members").alias("m"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return (
        asking.select(F.col("id").alias("query_id"), F.col("entry").alias("query")).join(scored, "query")
        .select("query_id", "score", F.col("m.id").alias("id"), F.least(F.col("m.n"), F.lit(k)).cast("int").alias("n"))
        .where(F.col("id") != F.col("query_id"))
        .select("query_id", "score", "id", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("copy"))
        .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        .select("query_id", "rank", F.col("id").alias(id_col), "score")
    )
