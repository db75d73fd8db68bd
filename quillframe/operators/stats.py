"""Statistics: frequencies, rollups at several grains, confusion counts, costs."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def frequencies(df: DataFrame, value: Column, name: str = "value", limit: int | None = None) -> DataFrame:
    """(value, n): non-empty values by how often they occur, most first, ties by value."""
    rows = df.select(value.cast("string").alias(name)).where((F.col(name) != ""))
    out = rows.groupBy(name).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), name)
    return out.limit(limit) if limit else out


def conditional_counts(df: DataFrame, by: Sequence[str], cases: dict[str, Column]) -> DataFrame:
    """Rows of each group, and of them those that meet each condition."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *[F.count_if(c).alias(n) for n, c in cases.items()])


def rollup_grains(df: DataFrame, a: str, b: str, value: str, matched: str, case: str) -> DataFrame:
    """Statistics over everything, by ``a``, by ``b`` and by both: grouping sets over counts of equal values, and over distinct cases.

    (grain, a, b, total, matches, accuracy, mean, median, least, most, spread,
    cases). Empty groups do not occur; one row has spread 0. Means and the like
    are rounded half to even at 4 places, accuracy in percent at 2.
    """
    sets = [[], [F.col(a)], [F.col(b)], [F.col(a), F.col(b)]]
    values = df.groupBy(a, b, F.col(value).alias("__v")).agg(F.count(F.lit(1)).alias("__n"), F.count_if(F.col(matched)).alias("__m"))
    centre = values.agg(F.sum(F.col("__v") * F.col("__n")).alias("s"), F.sum(F.when(F.col("__v").isNotNull(), F.col("__n"))).alias("n"))
    values = values.crossJoin(F.broadcast(centre.select(F.try_divide("s", "n").alias("__c"))))  # of one row; sums of squares are taken around it
    n, known = F.sum("__n"), F.sum(F.when(F.col("__v").isNotNull(), F.col("__n")))
    off = (F.col("__v") - F.col("__c")) * F.col("__n")
    square = F.greatest(F.sum(off * (F.col("__v") - F.col("__c"))) - F.sum(off) * F.sum(off) / known, F.lit(0.0))
    of_values = values.groupingSets(sets, a, b).agg(
        F.grouping_id().alias("__grain"), n.alias("total"), F.sum("__m").alias("matches"), F.bround(100.0 * F.sum("__m") / n, 2).alias("accuracy"),
        F.bround(F.sum(F.col("__v") * F.col("__n")) / known, 4).alias("mean"), F.bround(F.percentile("__v", 0.5, F.col("__n")), 4).alias("median"),
        F.bround(F.min("__v"), 4).alias("least"), F.bround(F.max("__v"), 4).alias("most"),
        F.bround(F.when(known > 1, F.sqrt(square / (known - 1))).otherwise(0.0), 4).alias("spread"),
    )
    of_cases = df.select(a, b, case).distinct().groupingSets(sets, a, b).agg(F.grouping_id().alias("__g"), F.count_distinct(case).alias("cases"))
    of_cases = of_cases.withColumnsRenamed({a: "__a", b: "__b"})
    same = (F.col("__grain") == F.col("__g")) & F.col(a).eqNullSafe(F.col("__a")) & F.col(b).eqNullSafe(F.col("__b"))
    out = of_values.join(of_cases, same)
    names = F.array(*map(F.lit, (f"{a},{b}", a, b, "all")))
    figures = ("total", "matches", "accuracy", "mean", "median", "least", "most", "spread", "cases")
    return out.select(F.element_at(names, (F.col("__grain") + 1).cast("int")).alias("grain"), a, b, *figures)


def histogram(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """(by, value, n, share): how often each value occurs in a group, and its share of the group."""
    counts = df.groupBy(*by, value).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(*by)))


def confusion(pairs: DataFrame, truth: str, read: str) -> DataFrame:
    """(truth_char, read_char, n) over aligned characters of pairs of texts; ``[MISS]`` for one that was not read. Insertions are passed over."""
    from difflib import SequenceMatcher

    def of(frames):
        for frame in frames:
            rows = []
            for a, b in zip(frame.a.fillna(""), frame.b.fillna("")):
                for op, i1, i2, j1, j2 in SequenceMatcher(None, a, b, autojunk=False).get_opcodes():
                    if op == "insert":
                        continue
                    got = b[j1:j2]
                    rows += [(c, got[k] if k < len(got) else "[MISS]") for k, c in enumerate(a[i1:i2])]
            yield pd.DataFrame(rows, columns=["truth_char", "read_char"], dtype=object).value_counts().rename("n").reset_index()

    seen = pairs.select(F.col(truth).alias("a"), F.col(read).alias("b")).mapInPandas(of, "truth_char string, read_char string, n long")
    return seen.groupBy("truth_char", "read_char").agg(F.sum("n").alias("n"))


def confusion_profile(counts: DataFrame, least: int = 3) -> DataFrame:
    """(truth_char, total, accuracy): characters seen ``least`` times at least and not always read right, worst first."""
    right = F.sum(F.when(F.col("truth_char") == F.col("read_char"), F.col("n")).otherwise(0))
    by = counts.groupBy("truth_char").agg(F.sum("n").alias("total"), right.alias("right"))
    accuracy = F.bround(100.0 * F.col("right") / F.col("total"), 2).alias("accuracy")
    return by.where((F.col("total") >= least) & (F.col("right") < F.col("total"))).select("truth_char", "total", accuracy).orderBy(
        "accuracy", F.desc("total"), "truth_char"
    )


def token_costs(df: DataFrame, by: Sequence[str], prompt: str, cached: str, answer: str, rate_in: float, rate_out: float) -> DataFrame:
    """Token sums and their cost at rates per million: cached prompt tokens are free."""
    billed = F.sum(F.col(prompt) - F.col(cached))
    out = F.sum(answer)
    return df.groupBy(*by).agg(
        F.sum(prompt).alias("prompt_tokens"), F.sum(cached).alias("cached_tokens"), out.alias("answer_tokens"),
        F.round(billed * rate_in / 1e6 + out * rate_out / 1e6, 6).alias("cost"),
    )


def accuracy_band(percent: Column) -> Column:
    return F.when(percent >= 90, "high").when(percent >= 75, "good").when(percent >= 50, "fair").otherwise("low")


def distribution(df: DataFrame, value: str, percentiles: Sequence[int] = (25, 50, 75, 90, 95, 99)) -> DataFrame:
    """One row: mean, median, population spread and percentiles of a column."""
    exact = [F.percentile(value, F.lit(p / 100)).alias(f"p{p}") for p in percentiles]
    return df.agg(F.avg(value).alias("mean"), F.median(value).alias("median"), F.stddev_pop(value).alias("spread"), *exact)
