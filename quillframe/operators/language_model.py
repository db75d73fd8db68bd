"""Backoff language models as tables: estimation, class expansion in context, scoring by joins, sampling weights, generation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .corpus import weighted_draws

BEGIN, END = "<s>", "</s>"
NONE = -99.0  # the logarithm that stands for no probability


def marked(text: Column, pattern: str = "[a-z]+") -> Column:
    """The tokens of a text between marks of its beginning and end."""
    found = F.regexp_extract_all(F.coalesce(F.lower(text), F.lit("")), F.lit(f"({pattern})"), F.lit(1))
    return F.concat(F.array(F.lit(BEGIN)), found, F.array(F.lit(END)))


def runs(tokens: Column, n: int) -> Column:
    """The runs of n tokens of an array as structs w1 to wn; none where it is shorter."""
    starts = F.when(F.size(tokens) >= n, F.sequence(F.lit(1), F.greatest(F.size(tokens) - (n - 1), F.lit(1)))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.struct(*[F.element_at(tokens, (i + k).cast("int")).alias(f"w{k + 1}") for k in range(n)]))


def _counts(df: DataFrame, tokens: str, n: int) -> DataFrame:
    words = [f"w{k + 1}" for k in range(n)]
    return df.select(F.explode(runs(F.col(tokens), n)).alias("r")).select("r.*").groupBy(*words).agg(F.count(F.lit(1)).alias("n"))


def _log(x: Column) -> Column:
    return F.when(x > 0, F.log10(x)).otherwise(F.lit(NONE))


def backoff_model(df: DataFrame, tokens: str, discount: float = 0.5) -> DataFrame:
    """(order, w1, w2, w3, log_prob, backoff): a trigram model with an absolute discount.

    Seen n-grams lose ``discount`` counts; what a context loses is shared among
    the words not seen after it as the next shorter context has them.
    Unigrams are relative frequencies of all but the mark of the beginning,
    which has a row for its backoff only.
    """
    one = _counts(df, tokens, 1).where(F.col("w1") != BEGIN)
    all_ = one.agg(F.sum("n").alias("all"))  # one row
    one = one.crossJoin(F.broadcast(all_)).select("w1", (F.col("n") / F.col("all")).alias("p"))

    def seen(n: int) -> DataFrame:
        counts, context = _counts(df, tokens, n), [f"w{k + 1}" for k in range(n - 1)]
        totals = counts.groupBy(*context).agg(F.sum("n").alias("total"), (discount * F.count(F.lit(1)) / F.sum("n")).alias("left"))
        return counts.join(totals, context).withColumn("p", (F.col("n") - discount) / F.col("total"))

    two, three = seen(2), seen(3)
    shorter = two.join(one.select(F.col("w1").alias("w2"), F.col("p").alias("q")), "w2")
    rest = shorter.groupBy("w1").agg(F.max("left").alias("left"), (1 - F.sum("q")).alias("free"))
    one = one.join(rest, "w1", "full").select(
        F.lit(1).alias("order"), "w1", F.lit(None).cast("string").alias("w2"), F.lit(None).cast("string").alias("w3"), _log(F.coalesce("p", F.lit(0.0))).alias("log_prob"),
        F.when(F.col("left").isNotNull(), _log(F.when(F.col("free") > 1e-9, F.col("left") / F.col("free")))).alias("backoff"),
    )
    shorter = three.join(two.select(F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("p").alias("q")), ["w2", "w3"])
    rest = shorter.groupBy("w1", "w2").agg(F.max("left").alias("left"), (1 - F.sum("q")).alias("free"))
    two = two.drop("left").join(rest, ["w1", "w2"], "left").select(
        F.lit(2).alias("order"), "w1", "w2", F.lit(None).cast("string").alias("w3"), _log(F.col("p")).alias("log_prob"),
        F.when(F.col("left").isNotNull(), _log(F.when(F.col("free") > 1e-9, F.col("left") / F.col("free")))).alias("backoff"),
    )
    three = three.select(F.lit(3).alias("order"), "w1", "w2", "w3", _log(F.col("p")).alias("log_prob"), F.lit(None).cast("double").alias("backoff"))
    return one.unionByName(two).unionByName(three)


def backoff_scores(df: DataFrame, id_col: str, tokens: str, model: DataFrame, unknown: float = -7.0) -> DataFrame:
    """(id_col, n, log_prob): the log10 probability of every row's tokens, marks included, by joins with the model's tables.

    A trigram that is not seen falls back to the bigram with its context's
    backoff, and that to the unigram; a word without one weighs ``unknown``.
    """
    s = F.concat(F.array(F.lit(BEGIN)), F.col(tokens))  # a row's first word has the mark twice before it
    at = df.select(id_col, F.explode(runs(s, 3)).alias("r")).select(id_col, "r.*")
    part = lambda n, **names: model.where(F.col("order") == n).select(*[F.col(old).alias(new) for new, old in names.items()])
    at = at.join(part(3, w1="w1", w2="w2", w3="w3", p3="log_prob"), ["w1", "w2", "w3"], "left")
    at = at.join(part(2, w1="w1", w2="w2", b2="backoff"), ["w1", "w2"], "left")
    at = at.join(part(2, w2="w1", w3="w2", p2="log_prob"), ["w2", "w3"], "left")
    at = at.join(part(1, w2="w1", b1="backoff"), "w2", "left").join(part(1, w3="w1", p1="log_prob"), "w3", "left")
    low = F.coalesce("p2", F.coalesce("b1", F.lit(0.0)) + F.coalesce("p1", F.lit(unknown)))
    p = F.coalesce("p3", F.coalesce("b2", F.lit(0.0)) + low)
    return at.groupBy(id_col).agg(F.count(F.lit(1)).alias("n"), F.sum(p).alias("log_prob"))


def expand_contexts(bigrams: DataFrame, names: DataFrame, label: str, contexts: int = 50, most: int = 1000, name: str = "token", frequency: str = "n") -> DataFrame:
    """Bigrams (w1, w2, log_prob) with those of a class's label, the ``contexts`` likeliest, made anew for its ``most`` commonest names.

    A name's bigram weighs the label's and the logarithm of the name's share;
    ones that exist are passed over. Both lists are bounded by their parameters.
    """
    total = names.agg(F.sum(frequency).alias("__total"))  # one row
    top = names.orderBy(F.desc(frequency), name).limit(most).crossJoin(F.broadcast(total))
    top = top.select(F.col(name).alias("__name"), F.log10(F.col(frequency) / F.col("__total")).alias("__share"))
    likely = bigrams.where((F.col("w1") == label) | (F.col("w2") == label)).orderBy(F.desc("log_prob"), "w1", "w2").limit(contexts)
    put = lambda c: F.when(F.col(c) == label, F.col("__name")).otherwise(F.col(c)).alias(c)
    made = likely.crossJoin(F.broadcast(top)).select(put("w1"), put("w2"), (F.col("log_prob") + F.col("__share")).alias("log_prob"))
    made = made.groupBy("w1", "w2").agg(F.max("log_prob").alias("log_prob"))
    return bigrams.select("w1", "w2", "log_prob").unionByName(made.join(bigrams, ["w1", "w2"], "left_anti"))


def tempered(df: DataFrame, by: Sequence[str], weight: str, order: Sequence[Column], temperature: float = 1.0, top: int | None = None) -> DataFrame:
    """``df`` with ``share``: of its group's ``top`` rows in order, weights raised to 1 / temperature as shares of their sum."""
    w = Window.partitionBy(*by)
    if top is not None:
        df = df.withColumn("__place", F.row_number().over(w.orderBy(*order))).where(F.col("__place") <= top).drop("__place")
    power = F.pow(F.col(weight).cast("double"), F.lit(1 / temperature))
    return df.withColumn("share", power / F.sum(power).over(w))


def generate(transitions: DataFrame, starts: DataFrame, id_col: str, steps: int, seed: int = 7) -> DataFrame:
    """(id_col, words): for each start (id_col, state of two words) the words that transitions (state, next, n) draw, until the mark of the end or ``steps`` words."""
    now = starts.select(id_col, "state", F.array().cast("array<string>").alias("words"), F.lit(False).alias("over"))
    for step in range(steps):
        drawn = weighted_draws(transitions, "state", "n", [F.col("next")], now.where(~F.col("over")).select(id_col, "state"), id_col, seed + step)
        now = now.join(drawn.select(id_col, "next"), id_col, "left")
        stop = F.col("over") | F.col("next").isNull() | (F.col("next") == END)
        now = now.select(
            id_col, F.when(stop, F.col("state")).otherwise(F.concat_ws(" ", F.substring_index("state", " ", -1), "next")).alias("state"),
            F.when(stop, F.col("words")).otherwise(F.concat("words", F.array("next"))).alias("words"), stop.alias("over"),
        )
    return now.select(id_col, "words")
