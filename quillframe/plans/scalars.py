"""Scalar normalisers over values made from the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import calendar, text
from ..session import table as t


def phonetic_groups(spark: SparkSession, d: str) -> DataFrame:
    """Words of part names by how they sound."""
    words = t(spark, d, "part").select(F.explode(F.split("p_name", " ")).alias("word")).distinct()
    return words.select(text.phonetic_code(F.col("word")).alias("code"), "word").groupBy("code").agg(F.count(F.lit(1)).alias("n"), F.min("word").alias("first_word"))


def regnal_calendar(spark: SparkSession, d: str) -> DataFrame:
    rolls = t(spark, d, "part").select((F.pmod("p_partkey", F.lit(110)) + 545).cast("int").alias("roll")).distinct()
    year, term = calendar.roll_year(F.col("roll")), calendar.roll_term(F.col("roll"))
    return rolls.select(F.col("roll").cast("long").alias("roll"), year.cast("long").alias("year"), term.alias("term"), calendar.regnal_year(year, term).alias("regnal"))


def normalise_money(spark: SparkSession, d: str) -> DataFrame:
    n = F.floor("o_totalprice").cast("string")
    k = F.col("o_orderkey") % 6
    raw = F.when(k == 0, F.concat(F.lit("£"), n)).when(k == 1, F.concat(n, F.lit("l"))).when(k == 2, F.concat(n, F.lit("s 5d"))).when(k == 3, n).when(k == 4, F.concat(n, F.lit(" marks"))).otherwise("none")
    return t(spark, d, "orders").select("o_orderkey", text.money(raw).alias("sum"))


def normalise_writ_date(spark: SparkSession, d: str) -> DataFrame:
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    return t(spark, d, "orders").select(
        "o_orderkey", text.without_parentheses(F.concat("o_orderpriority", F.lit(" (account)"))).alias("writ"),
        text.dates(F.concat(day, F.lit(" 00:00:00 (initial); ;"), day, F.lit(" (due)"))).alias("dates"),
    )


def name_parts(spark: SparkSession, d: str) -> DataFrame:
    name = F.concat(F.lit("William de "), F.initcap(F.regexp_replace("c_name", "[^A-Za-z]+", " ")), F.lit(" de Lacy de-la De, de"))
    return t(spark, d, "customer").select(
        "c_custkey", text.without_particle(name).alias("plain"), text.last_word(name).alias("surname"), text.first_word(name).alias("forename"),
        text.squeezed(name).alias("squeezed"), text.shortened(name, 20).alias("short"), text.safe_key(F.col("c_name")).alias("key"),
    )


def forenames(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey") % 4
    name = F.when(k == 0, F.concat(F.lit("Sir "), "c_mktsegment")).when(k == 1, F.concat(F.lower("c_mktsegment"), F.lit(", clerk"))).when(k == 2, F.concat("c_mktsegment", F.lit(" (the elder)"))).otherwise("X")
    return t(spark, d, "customer").select(text.forename(name).alias("forename")).where("forename IS NOT NULL").groupBy("forename").agg(F.count(F.lit(1)).alias("n"))


def latin_forms(spark: SparkSession, d: str) -> DataFrame:
    words = t(spark, d, "part").select(F.explode(F.split("p_name", " ")).alias("word")).distinct()
    form = F.concat(F.upper("word"), F.lit("jv'"))
    return words.select("word", text.latin_form(form).alias("form"))


def letter_variant_counts(spark: SparkSession, d: str) -> DataFrame:
    words = t(spark, d, "nation").select(F.lower("n_name").alias("word"))
    v = text.letter_variants(F.col("word"))
    return words.select("word", F.size(v).cast("long").alias("n"), F.element_at(v, 1).alias("first"))


def sentence_split(spark: SparkSession, d: str) -> DataFrame:
    """Sentences of documents, counted; titles and initials do not end one."""
    s = text.sentences(F.col("text"))
    return t(spark, d, "documents").select("doc_id", F.size(s).cast("long").alias("n"), F.length(F.element_at(s, 1)).cast("long").alias("first_length"))


def symbol_round_trip(spark: SparkSession, d: str) -> DataFrame:
    joined = F.array_join(text.to_symbols(F.col("n_name")), " ")
    return t(spark, d, "nation").select("n_name", joined.alias("symbols"), text.from_symbols(joined).alias("back"))


def bbox_arrays(spark: SparkSession, d: str) -> DataFrame:
    """Boxes of polygons made from a line's numbers, widened to the left."""
    point = lambda x, y: F.array(F.col(x).cast("int"), F.col(y).cast("int"))
    lines = t(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", F.array(point("l_partkey", "l_quantity"), point("l_suppkey", "l_linenumber"), point("l_quantity", "l_extendedprice")).alias("polygon")
    )
    xs, ys = F.transform("polygon", lambda p: p[0]), F.transform("polygon", lambda p: p[1])
    return lines.select(
        "l_orderkey", F.col("l_linenumber").cast("long").alias("l_linenumber"), F.greatest(F.array_min(xs) - 10, F.lit(0)).cast("long").alias("x0"), F.array_min(ys).cast("long").alias("y0"),
        F.array_max(xs).cast("long").alias("x1"), F.array_max(ys).cast("long").alias("y1"),
    )


def join_locations(spark: SparkSession, d: str) -> DataFrame:
    n, r = t(spark, d, "nation"), t(spark, d, "region")
    both = n.join(r, F.col("n_regionkey") == F.col("r_regionkey"), "left")
    blank = F.when(F.col("n_nationkey") % 2 == 0, "  ").otherwise(F.col("r_name"))
    place = text.joined(F.col("n_name"), blank)
    return both.select("n_nationkey", place.alias("place"), text.generic_place(F.when(F.col("n_nationkey") == 1, "Eng, land").otherwise(place)).alias("generic"))


def image_names(spark: SparkSession, d: str) -> DataFrame:
    """File names parsed to roll and rotulus, augmented ones to their base."""
    k = F.col("p_partkey")
    name = F.when(k % 3 == 0, F.concat(F.lit("CP 40-"), 555 + k % 90, F.lit(" "), F.lpad((k % 400).cast("string"), 3, "0"), F.lit("-a.jpg"))).when(
        k % 3 == 1, F.concat(F.lit("img_"), k, F.lit("_aug_"), k % 5)
    ).otherwise("none")
    part = text.roll_number(name)
    return t(spark, d, "part").select("p_partkey", part["roll"].alias("roll"), part["rotulus"].alias("rotulus"), text.base_image(name).alias("base"))


def unfenced_json(spark: SparkSession, d: str) -> DataFrame:
    e = t(spark, d, "events")
    fenced = F.concat(F.lit("```json\n"), "props", F.lit("\n```"))
    return e.select("event_id", F.get_json_object(text.unfenced(fenced), "$.k").cast("long").alias("k"))


_CODE = "regexp_replace(translate(regexp_replace(upper(word), '[^A-Z]', '', 'g'), 'AEIOUHWYBFPVCGJKQSXZDTLMNR', '00000000111122222222334556'), '0+', '0', 'g')"
for _k in "123456":
    _CODE = f"regexp_replace({_CODE}, '{_k}+', '{_k}', 'g')"

CATALOGUE = {
    "phonetic_groups": (phonetic_groups, f"WITH w AS (SELECT DISTINCT unnest(string_split(p_name, ' ')) AS word FROM part), c AS (SELECT word, regexp_replace(upper(word), '[^A-Z]', '', 'g') AS l, replace(substr({_CODE}, 2), '0', '') AS t FROM w) SELECT CASE WHEN l = '' THEN '' ELSE rpad(substr(l, 1, 1) || substr(t, 1, 3), 4, '0') END AS code, count(*) AS n, min(word) AS first_word FROM c GROUP BY 1"),
    "regnal_calendar": (regnal_calendar, "WITH r AS (SELECT DISTINCT p_partkey % 110 + 545 AS roll FROM part), y AS (SELECT roll, CASE WHEN roll BETWEEN 555 AND 650 THEN 1399 + (roll - 552) // 4 END AS year, CASE WHEN roll BETWEEN 555 AND 650 THEN (['Hilary', 'Easter', 'Trinity', 'Michaelmas'])[(roll - 552) % 4 + 1] END AS term FROM r) SELECT roll, CAST(year AS BIGINT) AS year, term, CASE WHEN year IS NULL THEN NULL WHEN year > 1422 OR (year = 1422 AND term = 'Michaelmas') THEN (year - 1422 + CASE WHEN term = 'Michaelmas' THEN 1 ELSE 0 END) || ' Henry VI' WHEN year > 1413 OR (year = 1413 AND term <> 'Hilary') THEN (year - 1413 + CASE WHEN term <> 'Hilary' THEN 1 ELSE 0 END) || ' Henry V' ELSE (year - 1399 + CASE WHEN term = 'Michaelmas' THEN 1 ELSE 0 END) || ' Henry IV' END AS regnal FROM y"),
    "normalise_money": (normalise_money, "SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN CAST(floor(o_totalprice) AS BIGINT) || ' pounds' WHEN 1 THEN CAST(floor(o_totalprice) AS BIGINT) || ' pounds' WHEN 2 THEN CAST(floor(o_totalprice) AS BIGINT) || ' shillings' WHEN 3 THEN CAST(floor(o_totalprice) AS BIGINT) || ' pounds' WHEN 4 THEN CAST(floor(o_totalprice) AS BIGINT) || ' marks' ELSE '' END AS sum FROM orders"),
    "normalise_writ_date": (normalise_writ_date, "SELECT o_orderkey, o_orderpriority AS writ, strftime(o_orderdate, '%Y-%m-%d') || '; ' || strftime(o_orderdate, '%Y-%m-%d') AS dates FROM orders"),
    "name_parts": (name_parts, "WITH n AS (SELECT c_custkey, c_name, trim(regexp_replace(c_name, '[^A-Za-z]+', ' ', 'g')) AS m FROM customer), x AS (SELECT *, upper(substr(m, 1, 1)) || lower(substr(m, 2)) AS i FROM n) SELECT c_custkey, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace('William de ' || i || ' de Lacy de-la De, de', '\\s+de\\s+', ' ', 'gi'), '\\s+de\\b', ' ', 'gi'), '\\bde\\s+', ' ', 'gi'), '\\s+', ' ', 'g')) AS plain, 'de' AS surname, 'William' AS forename, lower('Williamde' || i || 'deLacyde-laDe,de') AS squeezed, substr('William de ' || i || CASE WHEN regexp_matches(c_name, '[^A-Za-z]$') THEN ' ' ELSE '' END || ' de Lacy', 1, 20) || '...' AS short, regexp_replace(c_name, '[^A-Za-z0-9_-]', '_', 'g') AS key FROM x"),
    "forenames": (forenames, "WITH x AS (SELECT CASE c_custkey % 4 WHEN 3 THEN NULL ELSE upper(substr(c_mktsegment, 1, 1)) || lower(substr(c_mktsegment, 2)) END AS forename FROM customer) SELECT forename, count(*) AS n FROM x WHERE forename IS NOT NULL GROUP BY 1"),
    "latin_forms": (latin_forms, "WITH w AS (SELECT DISTINCT unnest(string_split(p_name, ' ')) AS word FROM part) SELECT word, translate(lower(word), 'jv', 'iu') || 'iu' AS form FROM w"),
    "letter_variant_counts": (letter_variant_counts, "SELECT lower(n_name) AS word, CAST(2 ** length(regexp_replace(lower(n_name), '[^ijuv]', '', 'g')) AS BIGINT) AS n, translate(lower(n_name), 'jv', 'iu') AS first FROM nation"),
    "sentence_split": (sentence_split, None),
    "symbol_round_trip": (symbol_round_trip, "SELECT n_name, trim(regexp_replace(replace(regexp_replace(n_name, '(.)', '\\1 ', 'g'), '  ', '<space> '), '\\s+$', '')) AS symbols, n_name AS back FROM nation"),
    "bbox_arrays": (bbox_arrays, "WITH x AS (SELECT l_orderkey, l_linenumber, CAST(floor(l_quantity) AS BIGINT) AS q, l_partkey AS p, l_suppkey AS s, CAST(floor(l_extendedprice) AS BIGINT) AS e FROM lineitem) SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, greatest(least(p, s, q) - 10, 0) AS x0, least(q, l_linenumber, e) AS y0, greatest(p, s, q) AS x1, greatest(q, l_linenumber, e) AS y1 FROM x"),
    "join_locations": (join_locations, "SELECT n_nationkey, CASE WHEN n_nationkey % 2 = 0 THEN n_name ELSE n_name || ', ' || r_name END AS place, n_nationkey = 1 AS generic FROM nation JOIN region ON n_regionkey = r_regionkey"),
    "image_names": (image_names, "SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN CAST(555 + p_partkey % 90 AS VARCHAR) END AS roll, CASE WHEN p_partkey % 3 = 0 THEN lpad(CAST(p_partkey % 400 AS VARCHAR), 3, '0') END AS rotulus, CASE p_partkey % 3 WHEN 0 THEN 'CP 40-' || (555 + p_partkey % 90) || ' ' || lpad(CAST(p_partkey % 400 AS VARCHAR), 3, '0') || '-a.jpg' WHEN 1 THEN 'img_' || p_partkey ELSE 'none' END AS base FROM part"),
    "unfenced_json": (unfenced_json, "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events"),
}
