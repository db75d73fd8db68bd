"""Mixing sources to target weights by entropy balancing.

Every document gets a rate between 0 and ``cap``: of all rates whose words meet
the source's target, those closest to equal rates in (bounded) relative
entropy, which are exponentially tilted odds, rate / (cap - rate) =
exp(lambda * size). The convex dual has one multiplier for each source's word
constraint; Newton steps, each a grouped aggregation over all sources at once
and kept within a bracket, solve it. Rates are then rounded to whole copies by
one threshold per source on hashed priorities, below the target, and single
documents, taken once more or less, close the gap until it is at most a
thousandth or no document makes it smaller.

Everything here is DataFrame operations. Sources are handled as rows, never
gathered in the driver; a source that holds a third of all rows is aggregated
before any shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._common import partitions, written

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
_BUCKETS = 4096
_FILES = 8  # of tables with a row for each source
_FLAT = 60.0  # exp(-60) is nothing beside 1


def n_words(text: Column) -> Column:
    """Number of runs without ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def ranked(sources: DataFrame, name: str = "source") -> DataFrame:
    """``sources`` (distinct) with ``place``: 0, 1, ... by code point, null last.

    The rows are ranged over partitions and numbered in each; only the
    partitions' counts, one row for each, are summed in one place.
    """
    spark = sources.sparkSession
    order = F.col(name).asc_nulls_last()
    dealt = written(
        sources.repartitionByRange(partitions(spark), order).withColumn("part", F.spark_partition_id()), "sources"
    )
    counts = dealt.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("part", F.coalesce(before, F.lit(0)).alias("offset"))
    own = F.row_number().over(Window.partitionBy("part").orderBy(order)) - 1
    return dealt.withColumn("own", own).join(offsets, "part").withColumn("place", F.col("own") + F.col("offset")).drop(
        "part", "own", "offset"
    )


def targets(sources: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """(source, total, docs, target) from (source, total, docs).

    The sources in order weigh ``weights``, repeating, and share ``share`` times
    all words. A target stops at ``cap`` times its source's words and the excess
    is shared again by weight until none is above.
    """
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    table = written(ranked(sources).select("source", "total", "docs", weight.alias("weight")), "weights", _FILES).withColumn(
        "most", cap * F.col("total")
    )
    row = table.agg(F.sum("total").alias("t"), F.sum("weight").alias("w")).first()
    level = share * (row["t"] or 0) / row["w"] if row["w"] else 0.0
    while True:
        full = F.col("most") <= F.lit(level) * F.col("weight")
        row = table.agg(
            F.sum(F.when(full, F.col("most"))).alias("full"), F.sum(F.when(~full, F.col("weight"))).alias("w"),
            F.sum("total").alias("t"),
        ).first()
        if not row["w"]:
            break
        raised = (share * row["t"] - (row["full"] or 0.0)) / row["w"]
        if raised <= level * (1 + 1e-15):
            break
        level = raised
    return table.select("source", "total", "docs", F.least("most", F.lit(level) * F.col("weight")).alias("target"))


def _rate(tilt: Column, scaled: Column, cap: float) -> Column:
    return cap / (1 + F.exp(-F.greatest(F.lit(-_FLAT * 10), F.least(F.lit(_FLAT * 10), tilt * scaled))))


def tilts(sizes: DataFrame, goals: DataFrame, cap: float = 2.0, max_steps: int = 100) -> DataFrame:
    """``goals`` with ``mean`` and the multiplier ``tilt`` of each source, null where every document is taken ``cap`` times or never.

    ``sizes`` has (source, size, n), n documents of a size. Newton steps on the
    dual run for all sources together until each misses its target by less than
    half a word or a millionth, a bracket halving any step that leaves it.
    """
    same = lambda a, b: a["source"].eqNullSafe(b["source"])
    inner = (F.col("target") > 0) & (F.col("target") < cap * F.col("total") * (1 - 1e-12))
    least = sizes.where("size > 0").groupBy("source").agg(F.min("size").alias("least"))
    start = goals.join(least.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")), "left").drop("s")
    ratio = F.col("target") / F.col("total")
    state = written(
        start.withColumn("mean", F.when(F.col("total") > 0, F.col("total") / F.col("docs")))
        .withColumn("wide", _FLAT * F.col("mean") / F.col("least"))
        .select(
            "source", "total", "docs", "target", "mean",
            F.when(inner, F.log(ratio / (cap - ratio))).alias("tilt"),
            F.when(inner, -F.col("wide")).alias("low"), F.when(inner, F.col("wide")).alias("high"),
            (~inner | F.col("total").isNull()).alias("done"),
        ),
        "tilts", _FILES,
    )
    for _ in range(max_steps):
        if state.where(~F.col("done")).isEmpty():
            return state.select("source", "total", "docs", "target", "mean", "tilt")
        open_ = state.where(~F.col("done"))
        a, b = sizes.where("size > 0").alias("a"), open_.select("source", "tilt", "mean").alias("b")
        scaled = F.col("size") / F.col("mean")
        rate = _rate(F.col("tilt"), scaled, cap)
        words = F.col("n") * F.col("size")
        sums = (
            a.join(b, F.col("a.source").eqNullSafe(F.col("b.source")))
            .select(F.col("a.source").alias("s"), (words * rate).alias("w"), (words * scaled * rate * (1 - rate / cap)).alias("slope"))
            .groupBy("s").agg(F.sum("w").alias("w"), F.sum("slope").alias("slope"))
        )
        now = state.join(sums, F.col("source").eqNullSafe(F.col("s")), "left")
        gap = F.col("w") - F.col("target")
        near = F.abs(gap) <= F.greatest(F.lit(0.5), F.col("target") * 1e-6)
        low = F.when(gap < 0, F.col("tilt")).otherwise(F.col("low"))
        high = F.when(gap > 0, F.col("tilt")).otherwise(F.col("high"))
        step = F.col("tilt") - F.try_divide(gap, F.col("slope"))
        inside = (step > F.col("lo")) & (step < F.col("hi"))
        state = written(
            now.withColumn("lo", low).withColumn("hi", high).select(
                "source", "total", "docs", "target", "mean",
                F.when(F.col("done") | near, F.col("tilt")).when(inside, step).otherwise((F.col("lo") + F.col("hi")) / 2).alias("tilt"),
                F.col("lo").alias("low"), F.col("hi").alias("high"), (F.col("done") | near).alias("done"),
            ),
            "tilts", _FILES,
        )
    raise RuntimeError(f"tilts: no solution in {max_steps} steps")


def _rated(sized: DataFrame, state: DataFrame, cap: float) -> DataFrame:
    """``sized`` (row, id, source, size) with the source's state, rate, whole and bucketed priority of the part left."""
    s = state.withColumnRenamed("source", "s")
    found = sized.join(s, F.col("source").eqNullSafe(F.col("s")), "left").drop("s")
    rate = F.when(F.col("size") == 0, F.lit(0.0)).when(
        F.col("tilt").isNotNull(), _rate(F.col("tilt"), F.col("size") / F.col("mean"), cap)
    ).otherwise(F.when(F.col("target") > 0, F.lit(cap)).otherwise(F.lit(0.0)))
    found = found.withColumn("rate", rate).withColumn("whole", F.floor("rate"))
    part = F.col("rate") - F.col("whole")
    uniform = (F.pmod(F.xxhash64("id", "size", F.lit(6)), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    # of priorities uniform / part, at most 1 for a share `part` of documents; here as p / (1 + p), at most 1/2
    order = F.when(part > 0, uniform / (uniform + part)).otherwise(F.lit(1.0))
    found = found.withColumn("order", order)
    return found.withColumn("bucket", F.floor(F.col("order") * _BUCKETS))


def _key() -> Column:
    """What orders the documents of a bucket; equal keys are taken together."""
    return F.struct("order", "id", "size")


def thresholds(sized: DataFrame, state: DataFrame, cap: float = 2.0) -> DataFrame:
    """``state`` with, for each source, the bucket in which its words reach the target, the last document of
    that bucket that still fits, and the documents taken once more or less to close what remains after it."""
    rated = _rated(sized, state, cap)
    by = rated.groupBy("source", "bucket").agg(
        F.sum(F.col("whole") * F.col("size")).alias("w"), F.sum(F.when(F.col("order") < 1, F.col("size"))).alias("more")
    )
    w = Window.partitionBy("source")
    upto = w.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    by = by.withColumn("sure", F.sum("w").over(w)).withColumn("more", F.coalesce("more", F.lit(0))).withColumn(
        "reached", F.col("sure") + F.sum("more").over(upto)
    )
    goal = state.select(F.col("source").alias("s"), F.col("target").alias("goal"))
    by = by.join(goal, F.col("source").eqNullSafe(F.col("s")))
    crossed = (
        by.where(F.col("reached") >= F.col("goal"))
        .groupBy("source").agg(F.min_by(F.struct("bucket", (F.col("goal") - F.col("reached") + F.col("more")).alias("left")), "bucket").alias("x"))
        .select(F.col("source").alias("s"), F.col("x.bucket").alias("crossing"), F.col("x.left").alias("left"))
    )
    state = state.join(written(crossed, "crossed"), F.col("source").eqNullSafe(F.col("s")), "left").drop("s")
    state = written(state.withColumn("crossing", F.coalesce("crossing", F.lit(_BUCKETS + 1))), "crossings", _FILES)
    edge = _rated(sized, state, cap).where((F.col("order") < 1) & (F.col("bucket") == F.col("crossing")))
    sofar = w.orderBy("order", "id", "size").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    cuts = (
        edge.withColumn("upto", F.sum("size").over(sofar)).where(F.col("upto") <= F.col("left"))
        .groupBy("source").agg(F.max(_key()).alias("cut")).withColumnRenamed("source", "s")
    )
    cuts = written(cuts, "cuts")
    state = written(state.join(cuts, F.col("source").eqNullSafe(F.col("s")), "left").drop("s"), "thresholds", _FILES)
    flip = "struct<id: {}, order: double, size: bigint, sign: int>".format(sized.schema["id"].dataType.simpleString())
    state = state.withColumn("flips", F.from_json(F.lit("[]"), f"array<{flip}>"))
    while True:  # every round makes some gap smaller, and gaps are whole words apart
        first = _first(sized, state, cap)
        taken = first.groupBy("source").agg(F.sum(F.col("copies") * F.col("size")).alias("w"))
        gaps = written(
            taken.join(goal, F.col("source").eqNullSafe(F.col("s"))).select(F.col("source").alias("s"), (F.col("goal") - F.col("w")).alias("gap"), "goal")
            .where(F.abs("gap") > F.greatest(F.lit(0.5), F.col("goal") * 1e-3)),
            "gaps", _FILES,
        )
        if gaps.isEmpty():
            break
        left = F.abs(F.col("gap") - F.col("sign") * F.col("size"))
        best = (
            first.where(F.col("order") < 1).withColumn("sign", F.when(F.col("copies") > F.col("whole"), -1).otherwise(1))
            .join(gaps, F.col("source").eqNullSafe(F.col("s"))).where(left < F.abs("gap"))
            .groupBy("source").agg(F.min_by(F.struct("id", "order", "size", "sign"), F.struct(left, "order", "id")).alias("best"))
            .withColumnRenamed("source", "s")
        )
        best = written(best, "flips", _FILES)
        if best.isEmpty():
            break
        added = F.when(F.col("best").isNotNull(), F.concat("flips", F.array("best"))).otherwise(F.col("flips"))
        state = written(state.join(best, F.col("source").eqNullSafe(F.col("s")), "left").withColumn("flips", added).drop("s", "best"), "thresholds", _FILES)
    return state


def _first(sized: DataFrame, state: DataFrame, cap: float) -> DataFrame:
    """``sized`` rated, with ``copies``: the whole part of the rate, and one more up to the source's threshold."""
    rated = _rated(sized, state, cap)
    part = F.col("order") < 1  # whole rates are settled: a source taken cap times has no document at its threshold
    fits = F.col("cut").isNotNull() & (_key() <= F.col("cut"))
    more = part & ((F.col("bucket") < F.col("crossing")) | (F.col("bucket") == F.col("crossing")) & fits)
    found = rated.withColumn("copies", (F.col("whole") + more.cast("int")).cast("int"))
    hit = lambda f: f["id"].eqNullSafe(F.col("id")) & (f["order"] == F.col("order")) & (f["size"] == F.col("size"))
    flipped = F.aggregate("flips", F.lit(0), lambda n, f: n + F.when(hit(f), f["sign"]).otherwise(0))
    return found.withColumn("copies", F.least(F.greatest(F.col("copies") + flipped, F.col("whole")), F.col("whole") + part.cast("int")).cast("int"))


def copies(sized: DataFrame, state: DataFrame, cap: float = 2.0) -> DataFrame:
    """``sized`` with total, target, rate and ``copies``."""
    return _first(sized, state, cap).select(*sized.columns, "total", "target", "rate", "copies")


def plan(sized: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """The state that ``copies`` needs, from (id, source, size) of all documents."""
    sizes = written(sized.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "sizes")
    totals = sizes.groupBy("source").agg(
        F.sum(F.col("size") * F.col("n")).alias("total"), F.sum(F.when(F.col("size") > 0, F.col("n")).otherwise(0)).alias("docs")
    )
    return thresholds(sized, tilts(sizes, written(targets(totals, weights, share, cap), "targets", _FILES), cap), cap)


def mix(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: Sequence[float] = WEIGHTS, share: float = 1.5, cap: float = 2.0,
) -> DataFrame:
    """(id_col, size, source_size, target, taken, copies, rate) for every row.

    Size counts words (null text: 0). A null source is a source of its own, the
    last. Documents of size 0 and sources without words take nothing. Rows that
    repeat an id are documents each. Priorities come from a hash of id and size,
    so reruns agree. Other columns are ignored; an empty table gives an empty one.
    """
    sized = written(
        df.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), n_words(F.col(text_col)).alias("size")),
        "words",
    )
    found = copies(sized, plan(sized, weights, share, cap), cap)
    return found.select(
        F.col("id").alias(id_col), "size", F.col("total").alias("source_size"), "target",
        (F.col("copies") * F.col("size")).alias("taken"), "copies", "rate",
    )


def mixed_rows(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: Sequence[float] = WEIGHTS, share: float = 1.5, cap: float = 2.0,
) -> DataFrame:
    """The mix itself: ``df``'s rows, each as often as it is taken, with ``df``'s columns.

    Nulls, empty texts, repeated rows and empty tables are as in ``mix``; a row
    that is not taken is left out. The texts are read once for the words and
    once for the rows, and never shuffled.
    """
    # Exploding an array of one keeps the optimizer from counting a text's words again in every expression that uses their number.
    sized = df.select(
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), F.col(id_col).alias("id"),
        F.col(source_col).cast("string").alias("source"), F.explode(F.array(n_words(F.col(text_col)))).alias("size"),
    )
    small = written(sized.select("id", "source", "size"), "words")
    found = copies(sized, plan(small, weights, share, cap), cap)
    return found.select("row", F.explode(F.array_repeat(F.lit(1), F.col("copies"))).alias("copy")).select("row.*")
