"""Writers: documents, lists of symbols, n-gram and ARPA files, dataset splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def json_documents(df: DataFrame, path: str, by: list[str] | None = None) -> None:
    """JSON lines with null fields kept, in a folder for each value of ``by``."""
    writer = df.write.mode("overwrite").option("ignoreNullFields", False)
    (writer.partitionBy(*by) if by else writer).json(path)


def splits(df: DataFrame, path: str, column: str = "split") -> None:
    df.write.mode("overwrite").partitionBy(column).parquet(path)


def ngrams(df: DataFrame, path: str, kind: str = "csv") -> None:
    """n-gram counts as tab-separated, JSON or plain text files."""
    if kind == "csv":
        df.write.mode("overwrite").option("sep", "\t").csv(path)
    elif kind == "json":
        df.write.mode("overwrite").json(path)
    else:
        df.select(F.concat_ws("\t", *[F.col(c).cast("string") for c in df.columns]).alias("value")).write.mode("overwrite").text(path)


def symbols(df: DataFrame, column: str, path: str, first: tuple[str, ...] = ("<ctc>",)) -> None:
    """One file of ``symbol index`` lines: the fixed ones, then the table's in order. An alphabet is small."""
    spark = df.sparkSession
    fixed = spark.createDataFrame([(s, i) for i, s in enumerate(first)], "symbol string, at int")
    rest = df.select(F.col(column).alias("symbol")).distinct().join(fixed, "symbol", "left_anti")
    rest = rest.select("symbol", (F.row_number().over(Window.orderBy("symbol")) + len(first) - 1).alias("at"))
    fixed.unionByName(rest).coalesce(1).sortWithinPartitions("at").select(F.format_string("%s %d", "symbol", "at").alias("value")).write.mode("overwrite").text(path)


def lexicon(df: DataFrame, word: str, path: str) -> None:
    """Lines ``word c h a r s`` in order of words."""
    chars = F.array_join(F.filter(F.split(word, ""), lambda c: c != ""), " ")
    df.select(word).distinct().orderBy(word).select(F.concat_ws(" ", word, chars).alias("value")).write.mode("overwrite").text(path)


def _number(x: Column) -> Column:
    """Seven significant digits without closing zeros; below 1e-4 and from 1e7 with an exponent of two digits."""
    plain = lambda y: F.regexp_replace(F.regexp_replace(F.format_string("%.12f", y), r"(\.\d*?)0+$", "$1"), r"\.$", "")
    scale = lambda y: F.floor(F.log10(F.abs(y)))
    ten = F.pow(F.lit(10.0), 6 - scale(x))
    near = F.when(x == 0, F.lit(0.0)).otherwise(F.round(x * ten) / ten)
    power = scale(near).cast("int")
    exponent = F.concat(F.when(power < 0, "-").otherwise("+"), F.lpad(F.abs(power).cast("string"), 2, "0"))
    return F.when((near != 0) & ((power < -4) | (power >= 7)), F.concat(plain(near / F.pow(F.lit(10.0), power)), F.lit("e"), exponent)).otherwise(plain(near))


def arpa(df: DataFrame, path: str, specials: tuple[str, ...] = ("<unk>", "<s>", "</s>"), floor: float = -99.0) -> None:
    """An ARPA file of (order, words, log_prob, backoff): counts, then each order with special words first and likelier ones before others.

    Rows are sorted over all tasks; the parts, read in the order of their names, are the file. Special words come first, whatever they weigh.
    """
    spark = df.sparkSession
    counts = {r["order"]: r["n"] for r in df.groupBy("order").agg(F.count(F.lit(1)).alias("n")).collect()}
    head = "\\data\\\n" + "\n".join(f"ngram {o}={counts[o]}" for o in sorted(counts)) + "\n"
    marks = [(0, 0, head)] + [(o, 0, f"\\{o}-grams:") for o in sorted(counts)] + [(o, 3, "") for o in sorted(counts)] + [(max(counts, default=0) + 1, 0, "\\end\\")]
    frame = spark.createDataFrame(marks, "o int, kind int, value string").select("o", "kind", F.lit(0.0).alias("p"), F.lit("").alias("w"), "value")
    text = F.array_join("words", " ")
    p = F.greatest(F.col("log_prob"), F.lit(floor))
    value = F.concat_ws("\t", _number(p), text, F.when(F.col("backoff").isNotNull(), _number(F.col("backoff"))))
    rows = df.select(F.col("order").cast("int").alias("o"), F.when(text.isin(*specials), 1).otherwise(2).alias("kind"), (-p).alias("p"), text.alias("w"), value.alias("value"))
    frame.unionByName(rows).orderBy("o", "kind", "p", "w").select("value").write.mode("overwrite").text(path)
