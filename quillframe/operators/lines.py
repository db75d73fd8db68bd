"""Lines of pages and the records made of them: keys, order, names in lines, corrections, marks, coverage of splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import collapsed, filled


def position_keys(df: DataFrame, by: Sequence[str], order: Sequence[Column], name: str = "key") -> DataFrame:
    """``df`` with ``L01``, ``L02``, ... in order within each group."""
    place = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn(name, F.format_string("L%02d", place))


def top_down(df: DataFrame, by: Sequence[str], top: str, tie: str, missing_first: bool = True) -> DataFrame:
    """``df`` with ``place`` from the top of each page; lines without a box as if at 0, or after all others."""
    y = F.coalesce(F.col(top).cast("double"), F.lit(0.0 if missing_first else float("inf")))
    return df.withColumn("place", F.row_number().over(Window.partitionBy(*by).orderBy(y, tie)))


def consolidated(lines: DataFrame, corrections: DataFrame, by: Sequence[str], text: str, corrected: str) -> DataFrame:
    """Lines with their correction by page and key, their own text where there is none, and whether there is one."""
    found = lines.join(corrections.select(*by, corrected), list(by), "left")
    return found.withColumn("final", F.coalesce(F.col(corrected), F.col(text))).withColumn("is_corrected", F.col(corrected).isNotNull())


def names_in_lines(names: DataFrame, name: str, lines: DataFrame, line_id: str, text: str, most: int = 5) -> DataFrame:
    """(name, line_id, place): the first ``most`` lines, by id, that hold a name as whole words, case aside.

    A line's words are looked up by the first word of each name, and only then
    is the whole name searched, so no line meets every name.
    """
    words = lambda x: F.array_remove(F.split(F.lower(F.regexp_replace(filled(x), r"(?U)\W+", " ")), " "), "")
    wanted = names.select(F.col(name).alias("name"), words(F.col(name)).alias("__n")).where(F.size("__n") > 0).distinct()
    wanted = wanted.withColumn("__w", F.element_at("__n", 1))
    found = lines.select(line_id, words(F.col(text)).alias("__l")).withColumn("__w", F.explode(F.array_distinct("__l")))
    padded = lambda c: F.concat(F.lit(" "), F.array_join(c, " "), F.lit(" "))
    hits = found.join(wanted, "__w").where(F.contains(padded("__l"), padded("__n"))).select("name", line_id).distinct()
    return hits.withColumn("place", F.row_number().over(Window.partitionBy("name").orderBy(line_id))).where(F.col("place") <= most)


def looked_up(wanted: DataFrame, key: str, corrections: DataFrame, order: str, roles: Sequence[str], value: str) -> DataFrame:
    """(key, value, role) of each wanted text: from the first of ``roles`` that has it, of that the first correction in order."""
    plain = lambda c: F.lower(F.trim(F.col(c)))
    sides = [corrections.select(plain(r).alias("__k"), F.lit(i).alias("__i"), F.lit(r).alias("role"), F.col(order).alias("__o"), value) for i, r in enumerate(roles)]
    all_ = sides[0]
    for side in sides[1:]:
        all_ = all_.unionByName(side)
    first = all_.groupBy("__k").agg(F.min_by(F.struct(value, "role"), F.struct("__i", "__o", value)).alias("x"))
    return wanted.join(first, plain(key) == F.col("__k")).select(key, F.col("x")[value].alias(value), F.col("x.role").alias("role"))


def marked_by_confidence(text: Column, confidence: Column, low: float = 0.5, high: float = 0.9) -> Column:
    """A text whose words are put in [[ ]] below ``low`` and in [ ] below ``high``, by a map from bare lower-case words to confidence."""
    bare = lambda w: F.lower(F.regexp_replace(w, r"^[.,;:!?()\[\]{}]+|[.,;:!?()\[\]{}]+$", ""))

    def one(w: Column) -> Column:
        c = F.element_at(confidence, bare(w))
        return F.when(c < low, F.concat(F.lit("[["), w, F.lit("]]"))).when(c < high, F.concat(F.lit("["), w, F.lit("]"))).otherwise(w)

    return F.array_join(F.transform(F.filter(F.split(collapsed(text), " "), lambda w: w != ""), one), " ")


def covered(df: DataFrame, id_col: str, text: str, split: str, required: Sequence[str], order: Sequence[str] = ("val", "test"), into: str = "train") -> DataFrame:
    """``df`` with rows moved to ``into`` so that it has every required character that any row has.

    A row moves if it is the first, by split and id, with a character that ``into`` lacks.
    """
    chars = df.select(id_col, split, F.explode(F.array_distinct(F.split(text, ""))).alias("__c")).where(F.col("__c").isin(*required))
    rank = F.array_position(F.array(*map(F.lit, order)), F.col(split))
    first = chars.groupBy("__c").agg(F.count_if(F.col(split) == into).alias("__has"), F.min(F.when(rank > 0, F.struct(rank.alias("r"), F.col(id_col).alias("id")))).alias("__f"))
    moved = first.where((F.col("__has") == 0) & F.col("__f").isNotNull()).select(F.col("__f.id").alias(id_col)).distinct().withColumn("__m", F.lit(True))
    return df.join(moved, id_col, "left").withColumn(split, F.when(F.col("__m") & F.col(split).isin(*order), into).otherwise(F.col(split))).select(*df.columns)


def collapsed_labels(labels: Column, blank: int = 0) -> Column:
    """What a recogniser's best label of each moment reads: repeats once, without blanks."""
    return F.filter(labels, lambda x, i: (x != blank) & F.when(i == 0, True).otherwise(x != F.get(labels, i - 1)))


def right_angle(angle: Column) -> Column:
    """The nearest of 0, 90, 180 and 270 degrees; halfway the smaller."""
    turned = F.pmod(angle, F.lit(360))
    return F.when(turned > 315, 0).when(turned == 315, 0).otherwise((F.ceil((turned - 45) / 90) * 90)).cast("int")


def nearest_to_centre(df: DataFrame, by: str, id_col: str, vector: str, share: float = 0.01) -> DataFrame:
    """(by, id_col, distance, place): of each group the ``share`` nearest to its mean vector, one at least."""
    parts = df.select(by, id_col, F.posexplode(vector).alias("__i", "__x")).withColumn("__x", F.col("__x").cast("double"))
    means = parts.groupBy(by, "__i").agg(F.avg("__x").alias("__m"))
    off = parts.join(means, [by, "__i"]).groupBy(by, id_col).agg(F.sqrt(F.sum((F.col("__x") - F.col("__m")) * (F.col("__x") - F.col("__m")))).alias("distance"))
    sizes = off.groupBy(by).agg(F.ceil(F.count(F.lit(1)) * share).alias("__n"))
    placed = off.withColumn("place", F.row_number().over(Window.partitionBy(by).orderBy("distance", id_col)))
    return placed.join(sizes, by).where(F.col("place") <= F.col("__n")).drop("__n")


def first_of_each(tables: Sequence[DataFrame], key: str, columns: Sequence[str]) -> DataFrame:
    """Rows of several tables, of equal keys that of the first table that has it (of one table the least row)."""
    all_ = None
    for i, table in enumerate(tables):
        part = table.select(key, *columns).withColumn("__i", F.lit(i))
        all_ = part if all_ is None else all_.unionByName(part)
    least = all_.groupBy(key).agg(F.min(F.struct("__i", *columns)).alias("x"))
    return least.select(key, *[F.col("x")[c].alias(c) for c in columns])


def person_name(first: Column, last: Column) -> Column:
    return F.trim(F.concat(filled(first), F.lit(" "), filled(last)))


def agent_text(first: Column, last: Column, role: Column, occupation: Column, status: Column) -> Column:
    """One sentence for each part of a person's record, empty where it lacks it."""
    part = lambda label, x: F.concat(F.lit(f"{label}: "), filled(x), F.lit("."))
    return F.concat_ws(" ", part("Person", person_name(first, last)), part("Role", role), part("Occupation", occupation), part("Status", status))


def date_text(dates: Column) -> Column:
    """``day (kind); ...`` of an array of structs (Date, DateType); entries without a date are passed over."""
    one = lambda d: F.when(filled(d["DateType"]) == "", d["Date"]).otherwise(F.concat(d["Date"], F.lit(" ("), d["DateType"], F.lit(")")))
    return F.array_join(F.transform(F.filter(dates, lambda d: filled(d["Date"]) != ""), one), "; ")
