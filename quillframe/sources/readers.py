"""Readers: nested JSON trees, line files, recogniser output, n-gram and ARPA files, HTML entries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.text import from_symbols


def json_documents(spark: SparkSession, folder: str, name: str = "*.json", schema: StructType | str | None = None) -> DataFrame:
    """Documents of all files of a name below a folder, with their ``path``; a schema saves reading them twice."""
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", name).option("multiLine", True)
    reader = reader.schema(schema) if schema else reader
    return reader.json(folder).withColumn("path", F.col("_metadata.file_path"))


def column_values(df: DataFrame, column: str) -> DataFrame:
    """One column's values, trimmed, without empty ones."""
    return df.select(F.trim(column).alias(column)).where(F.col(column) != "")


def min_words(df: DataFrame, text: str, n: int = 2) -> DataFrame:
    return df.where(F.size(F.filter(F.split(F.trim(text), r"\s+"), lambda w: w != "")) >= n)


def text_lines(spark: SparkSession, path: str, skip: str | None = "aug") -> DataFrame:
    """(image, text) of lines ``path text``, cut at the first space; images with ``skip`` in their path are left out."""
    line = F.col("value")
    out = spark.read.text(path).select(F.regexp_extract(line, r"^(\S+) (.*)$", 1).alias("image"), F.regexp_extract(line, r"^(\S+) (.*)$", 2).alias("text"))
    out = out.where("image <> ''")
    return out.where(~F.lower("image").contains(skip)) if skip else out


def recogniser_lines(spark: SparkSession, path: str) -> DataFrame:
    """(image, confidences, text) of lines ``path ['0.9', ...] c h a r s``, the list optional."""
    pattern = r"^(\S+)\s+(?:\[([^\]]*)\]\s+)?(.*)$"
    line = F.col("value")
    numbers = F.regexp_extract_all(F.regexp_extract(line, pattern, 2), F.lit(r"(\d+(?:\.\d+)?)"), F.lit(1))
    return spark.read.text(path).where(line.rlike(pattern)).select(
        F.regexp_extract(line, pattern, 1).alias("image"), F.transform(numbers, lambda x: x.cast("double")).alias("confidences"),
        from_symbols(F.regexp_extract(line, pattern, 3)).alias("text"),
    )


def word_confidences(text: Column, confidences: Column) -> Column:
    """array<struct(word, confidence)>: a null confidence where they are too few, no more than there are words."""
    words = F.filter(F.split(F.trim(text), r"\s+"), lambda w: w != "")
    return F.transform(words, lambda w, i: F.struct(w.alias("word"), F.get(confidences, i).alias("confidence")))


def layout_lines(spark: SparkSession, folder: str, name: str = "*.json") -> DataFrame:
    """(path, line_id, boundary, baseline, box) of layout files' lines."""
    schema = "lines array<struct<id: string, boundary: array<array<int>>, baseline: array<array<int>>>>"
    lines = json_documents(spark, folder, name, schema).select("path", F.explode("lines").alias("l"))
    return lines.select("path", F.col("l.id").alias("line_id"), "l.boundary", "l.baseline", bounding_box(F.col("l.boundary")).alias("box"))


def bounding_box(polygon: Column) -> Column:
    """[x0, y0, x1, y1] of an array of points; null without points."""
    x, y = F.transform(polygon, lambda p: p[0]), F.transform(polygon, lambda p: p[1])
    return F.when(F.size(polygon) > 0, F.array(F.array_min(x), F.array_min(y), F.array_max(x), F.array_max(y)))


def with_geometry(lines: DataFrame, geometry: DataFrame, key: str, keep_unmatched: bool = False) -> DataFrame:
    """Lines with their geometry; those without any are dropped, or kept with nulls."""
    return lines.join(geometry, key, "left" if keep_unmatched else "inner")


def ngram_file(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", schema="ngram string, length int, n long", quote="")


def arpa(spark: SparkSession, path: str) -> DataFrame:
    """(order, words, log_prob, backoff) of an ARPA file, read as one file: its sections have to be seen in order.

    A file is far smaller than a corpus; for many use ``recursiveFileLookup``
    and one file to a task.
    """
    whole = spark.read.option("wholetext", True).text(path)
    lines = whole.select(F.posexplode(F.split("value", r"\r?\n")).alias("at", "line"), F.input_file_name().alias("file"))
    section = F.nullif(F.regexp_extract("line", r"^\\(\d+)-grams:", 1), F.lit(""))
    w = Window.partitionBy("file").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    rows = lines.withColumn("order", F.last(section.cast("int"), ignorenulls=True).over(w))
    rows = rows.where(F.col("order").isNotNull() & ~F.col("line").startswith("\\") & (F.trim("line") != ""))
    cells = F.split("line", r"\t")
    return rows.select("order", F.split(cells[1], " ").alias("words"), cells[0].cast("double").alias("log_prob"), F.try_element_at(cells, F.lit(3)).cast("double").alias("backoff"))


def symbol_file(spark: SparkSession, path: str) -> DataFrame:
    cells = F.split("value", " ")
    return spark.read.text(path).where("value <> ''").select(cells[0].alias("symbol"), cells[1].cast("int").alias("idx"))


def html_entries(df: DataFrame, id_col: str, html_col: str) -> DataFrame:
    """(id_col, lang, title, items): a page's language, title and number of list items, by patterns."""
    return df.select(
        id_col, F.regexp_extract(html_col, '<html[^>]*lang="([a-z]+)"', 1).alias("lang"),
        F.regexp_extract(html_col, "(?s)<title>(.*?)</title>", 1).alias("title"), F.regexp_count(html_col, F.lit("<li>")).cast("long").alias("items"),
    )


def layout_names(df: DataFrame, name: str) -> DataFrame:
    """(group_id, n, first_name): names grouped by what they have up to their last digit."""
    group = F.regexp_extract(name, r"(?s)^(.*[0-9])", 1)
    rows = df.select(group.alias("group_id"), F.col(name).alias("name")).where("group_id <> ''")
    return rows.groupBy("group_id").agg(F.count(F.lit(1)).alias("n"), F.min("name").alias("first_name"))
