"""Corpus tables: tokens, n-grams, lexica, class substitution, language-model tables, splits and samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import symbol_ngrams, to_symbols


def tokens(df: DataFrame, id_col: str, text_col: str, pattern: str = r"[A-Za-z]+", lower: bool = True) -> DataFrame:
    """(id_col, pos, token): matches of a pattern in order, from 0."""
    text = F.lower(text_col) if lower else F.col(text_col)
    return df.select(id_col, F.posexplode(F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1))).alias("pos", "token"))


def character_counts(df: DataFrame, text_col: str) -> DataFrame:
    """(char, n) over all texts; a text's characters are counted without gathering them."""
    chars = df.select(F.explode(F.split(text_col, "")).alias("char")).where(F.col("char") != "")
    return chars.groupBy("char").agg(F.count(F.lit(1)).alias("n"))


def lexicon(df: DataFrame, text_col: str) -> DataFrame:
    """(word, n): lower-case words with a letter in them, most frequent first, then by word."""
    words = df.select(F.explode(F.regexp_extract_all(F.lower(text_col), F.lit(r"([a-z0-9_]+)"), F.lit(1))).alias("word"))
    return words.where(F.col("word").rlike("[a-z]")).groupBy("word").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "word")


def ngram_counts(df: DataFrame, symbols: Column, longest: int, least: int) -> DataFrame:
    """(length, ngram, n) of runs of 1 to ``longest`` symbols that occur ``least`` times: one pass for all lengths."""

    def of(n: int) -> Column:
        return F.transform(symbol_ngrams(symbols, n), lambda g: F.struct(F.lit(n).alias("length"), g.alias("ngram")))

    each = [of(n) for n in range(1, longest + 1)]
    rows = df.select(F.explode(F.concat(*each)).alias("g")).select("g.length", "g.ngram")
    return rows.groupBy("length", "ngram").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)


def transitions(words: DataFrame, doc: str, pos: str, token: str, state: int = 2, begin: str = "<s>", end: str = "</s>") -> DataFrame:
    """(state, next, n): how often a token follows the ``state`` before it; texts begin and end with marks."""
    w = Window.partitionBy(doc).orderBy(pos)
    before = [F.coalesce(F.lag(token, i).over(w), F.lit(begin)) for i in range(state, 0, -1)]
    steps = words.select(F.concat_ws(" ", *before).alias("state"), F.col(token).alias("next"))
    last = words.withColumn("__after", F.lead(token).over(w)).withColumn(
        "__state", F.concat_ws(" ", *[F.coalesce(F.lag(token, i).over(w), F.lit(begin)) for i in range(state - 1, 0, -1)], F.col(token))
    )
    closing = last.where(F.col("__after").isNull()).select(F.col("__state").alias("state"), F.lit(end).alias("next"))
    return steps.unionByName(closing).groupBy("state", "next").agg(F.count(F.lit(1)).alias("n"))


def context_flags(words: DataFrame, doc: str, pos: str, token: str, before: Sequence[str], after: Sequence[str], reach: int = 3) -> DataFrame:
    """``words`` with ``in_context``: one of ``before`` within ``reach`` tokens ahead of it, or one of ``after`` behind."""
    w = Window.partitionBy(doc).orderBy(pos)
    hit = F.lit(False)
    for i in range(1, reach + 1):
        hit = hit | F.coalesce(F.lag(token, i).over(w).isin(*before), F.lit(False)) | F.coalesce(F.lead(token, i).over(w).isin(*after), F.lit(False))
    return words.withColumn("in_context", hit)


def classify(words: DataFrame, token: str, classes: Sequence[tuple[str, DataFrame]], excluded: DataFrame | None = None) -> DataFrame:
    """``words`` with ``class``: the first class in order whose table (``token``) has the word, none for an excluded one."""
    out, found = words, []
    for i, (name, table) in enumerate(classes):
        out = out.join(table.select(token).distinct().withColumn(f"__{i}", F.lit(name)), token, "left")
        found.append(F.col(f"__{i}"))
    label = F.coalesce(*found)
    if excluded is not None:
        out = out.join(excluded.select(token).distinct().withColumn("__x", F.lit(True)), token, "left")
        label = F.when(F.col("__x").isNull(), label)
    return out.withColumn("class", label).select(*words.columns, "class")


def substituted_text(classified: DataFrame, doc: str, pos: str, token: str) -> DataFrame:
    """(doc, text, replaced): tokens in order, a class in place of its words."""
    word = F.coalesce(F.concat(F.lit("<"), F.col("class"), F.lit(">")), F.col(token)).alias("w")
    lists = classified.groupBy(doc).agg(F.array_sort(F.collect_list(F.struct(F.col(pos).alias("p"), word))).alias("all"), F.count("class").alias("replaced"))
    return lists.select(doc, F.array_join(F.col("all.w"), " ").alias("text"), "replaced")


def expand_class(
    unigrams: DataFrame, names: DataFrame, label: str, token: str = "token", log_prob: str = "log_prob", frequency: str = "n", top: int = 1000,
) -> DataFrame:
    """Unigrams with a class spread over its names: log10 p(class) + log10 of a name's share; tokens already there are passed over.

    The label keeps what the names besides the ``top`` most frequent (ties by
    name) have of it, and goes if that is nothing.
    """
    p = unigrams.where(F.col(token) == label).agg(F.max(log_prob).alias("__p"))
    totals = names.agg(F.sum(frequency).alias("__total"))
    most = names.orderBy(F.desc(frequency), token).limit(top).agg(F.sum(frequency).alias("__top"))
    one = p.crossJoin(F.broadcast(totals)).crossJoin(F.broadcast(most))  # one row
    share = F.log10(F.col(frequency) / F.col("__total"))
    added = names.select(token, frequency).crossJoin(F.broadcast(one)).select(token, (F.col("__p") + share).alias(log_prob)).join(unigrams, token, "left_anti")
    rest = one.where(F.col("__top") < F.col("__total")).select(F.lit(label).alias(token), (F.col("__p") + F.log10(1 - F.col("__top") / F.col("__total"))).alias(log_prob))
    return unigrams.where(F.col(token) != label).select(token, log_prob).unionByName(rest).unionByName(added)


def ngram_model(words: DataFrame, doc: str, pos: str, token: str) -> DataFrame:
    """(first, second, n, log_prob): maximum-likelihood bigrams, log10."""
    w = Window.partitionBy(doc).orderBy(pos)
    pairs = words.withColumn("second", F.lead(token).over(w)).where(F.col("second").isNotNull()).withColumnRenamed(token, "first")
    counts = pairs.groupBy("first", "second").agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy("first").agg(F.sum("n").alias("__total"))
    return counts.join(totals, "first").select("first", "second", "n", F.log10(F.col("n") / F.col("__total")).alias("log_prob"))


def cumulative_shares(df: DataFrame, by: Sequence[str], weight: str, order: Sequence[Column]) -> DataFrame:
    """``df`` with ``share`` of its group's weight and ``upto``, the shares summed in order."""
    w = Window.partitionBy(*by)
    share = F.col(weight) / F.sum(weight).over(w)
    upto = F.sum(weight).over(w.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)) / F.sum(weight).over(w)
    return df.withColumn("share", share).withColumn("upto", upto)


def weighted_draws(df: DataFrame, by: str, weight: str, order: Sequence[Column], draws: DataFrame, draw_id: str, seed: int = 7) -> DataFrame:
    """For every draw of a group one of its rows, with probability by whole ``weight``: the row whose stretch of the weights laid end to end holds a hash of the draw's id.

    Rows and draws of a group are put in one order, in which a draw takes the
    last row before it, so no draw meets every row.
    """
    w = Window.partitionBy(by)
    rows = df.where(F.col(weight) > 0)
    rows = rows.withColumn("__at", F.sum(weight).over(w.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)) - F.col(weight))
    totals = rows.groupBy(by).agg(F.sum(weight).alias("__total"))
    u = F.conv(F.substring(F.md5(F.concat_ws(":", F.col(draw_id).cast("string"), F.lit(seed)).cast("binary")), 1, 15), 16, 10).cast("long")
    asked = draws.join(totals, by).select(by, F.pmod(u, F.col("__total")).alias("__at"), F.lit(1).alias("__kind"), F.struct(*draws.columns).alias("__draw"))
    others = [c for c in df.columns if c != by]
    laid = rows.select(by, "__at", F.lit(0).alias("__kind"), F.struct(*others).alias("__row"))
    both = laid.unionByName(asked, allowMissingColumns=True)
    last = F.last("__row", ignorenulls=True).over(w.orderBy("__at", "__kind").rowsBetween(Window.unboundedPreceding, 0))
    return both.withColumn("__row", last).where(F.col("__kind") == 1).select("__draw.*", *[F.col("__row")[c].alias(c) for c in others if c not in draws.columns])


def nucleus(df: DataFrame, by: Sequence[str], weight: str, order: Sequence[Column], mass: float = 0.9) -> DataFrame:
    """The smallest beginning of each group, in order, that holds ``mass`` of its weight."""
    return cumulative_shares(df, by, weight, order).where(F.col("upto") - F.col("share") < mass)


def split_by_hash(df: DataFrame, id_col: str, seed: int = 42, parts: Sequence[tuple[str, float]] = (("train", 0.8), ("val", 0.1), ("test", 0.1))) -> DataFrame:
    """``df`` with ``split``: an md5 of id and seed, as a share of all its values, decides each row alone, so rows never move."""
    u = F.conv(F.substring(F.md5(F.concat_ws(":", F.col(id_col).cast("string"), F.lit(seed)).cast("binary")), 1, 8), 16, 10).cast("double") / float(1 << 32)
    out, upto = None, 0.0
    for name, share in parts[:-1]:
        upto += share
        out = F.when(u < upto, name) if out is None else out.when(u < upto, name)
    return df.withColumn("split", out.otherwise(parts[-1][0]) if out is not None else F.lit(parts[-1][0]))


def missing_symbols(df: DataFrame, text_col: str, required: Sequence[str]) -> DataFrame:
    """(symbol): required characters that no text has."""
    spark = df.sparkSession
    wanted = spark.createDataFrame([(c,) for c in required], "symbol string")
    found = df.select(F.explode(F.array_distinct(F.split(text_col, ""))).alias("symbol")).distinct()
    return wanted.join(found, "symbol", "left_anti")


def training_lines(df: DataFrame, read: str, corrected: str, polygon: str | None = None, threshold: float = 0.5, alphabet: str = r"^[ &'\-;A-Za-z]*$") -> DataFrame:
    """Lines fit for training: both texts, four characters, the alphabet, and near enough.

    A threshold below 1 is a similarity, from 1 on a number of edits.
    """
    d = F.levenshtein(read, corrected)
    near = (1 - d / F.greatest(F.length(read), F.length(corrected), F.lit(1)) >= threshold) if threshold < 1 else (d <= threshold)
    fit = (F.coalesce(F.col(read), F.lit("")) != "") & (F.length(corrected) >= 4) & F.col(corrected).rlike(alphabet) & near
    return df.where(fit & F.col(polygon).isNotNull() if polygon else fit)


def replication(df: DataFrame, id_col: str, text_col: str, least: int, excluded: Sequence[str] = ()) -> DataFrame:
    """(id_col, copies): copies by which every symbol of a text, but those ``excluded``, reaches ``least`` occurrences.

    A text is repeated for its rarest symbol; without a symbol to repeat it for, it stays once.
    """
    has = df.select(id_col, F.explode(F.array_distinct(to_symbols(F.col(text_col)))).alias("symbol"))
    total = df.select(F.explode(to_symbols(F.col(text_col))).alias("symbol")).groupBy("symbol").agg(F.count(F.lit(1)).alias("n"))
    need = total.where(~F.col("symbol").isin(*excluded)).select("symbol", F.ceil(F.lit(least) / F.col("n")).cast("int").alias("copies"))
    most = has.join(need, "symbol").groupBy(id_col).agg(F.max("copies").alias("copies"))
    return df.select(id_col).join(most, id_col, "left").select(id_col, F.coalesce("copies", F.lit(1)).alias("copies"))
