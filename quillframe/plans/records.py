"""Lines, records, jobs and typed corrections over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import last_word
from ..operators import ingest, lines, quality, resolve
from ..session import table as t


def line_keys(spark: SparkSession, d: str) -> DataFrame:
    keyed = lines.position_keys(t(spark, d, "lineitem").select("l_orderkey", "l_linenumber"), ["l_orderkey"], [F.col("l_linenumber")])
    return keyed.select("l_orderkey", F.col("l_linenumber").cast("long").alias("l_linenumber"), "key")


def vertical_lines(spark: SparkSession, d: str) -> DataFrame:
    """Events of users from the top, those without a box first and last."""
    y = F.when(F.col("event_id") % 3 != 0, F.floor("value"))
    boxes = t(spark, d, "events").select("user_id", F.col("event_id").alias("line"), y.alias("y"))
    first = lines.top_down(boxes, ["user_id"], "y", "line").withColumnRenamed("place", "first")
    last = lines.top_down(boxes, ["user_id"], "y", "line", missing_first=False).select("user_id", "line", F.col("place").alias("last"))
    both = first.join(last, ["user_id", "line"])
    return both.select("user_id", "line", F.col("first").cast("long").alias("first"), F.col("last").cast("long").alias("last"))


def consolidated_lines(spark: SparkSession, d: str) -> DataFrame:
    """Events of users by position, every second one corrected."""
    x = t(spark, d, "events").select("user_id", "event_id", F.col("event_type").alias("text"))
    keyed = lines.position_keys(x, ["user_id"], [F.col("event_id")])
    fixed = keyed.where("key = 'L02'").select("user_id", "key", F.upper("text").alias("corrected"))
    return lines.consolidated(keyed, fixed, ["user_id", "key"], "text", "corrected").select("user_id", "key", "final", "is_corrected")


def name_containment(spark: SparkSession, d: str) -> DataFrame:
    """The first five turns that hold two neighbouring words that begin some benchmark text."""
    names = t(spark, d, "benchmark").select(F.concat_ws(" ", F.slice(F.regexp_extract_all(F.lower("text"), F.lit("([a-z]+)"), F.lit(1)), 1, 1)).alias("name")).where("name <> ''")
    turns = t(spark, d, "conversations").select(F.concat_ws("-", "conv_id", "turn").alias("id"), F.regexp_replace(F.lower("text"), "[^a-z]+", " ").alias("text"))
    found = lines.names_in_lines(names, "name", turns, "id", "text")
    return found.select("name", "id", F.col("place").cast("long").alias("place"))


def probability_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Part words looked up as the first, second, or last word of a name, in this order."""
    word = lambda n: F.element_at(F.split("p_name", " "), n)
    fixed = t(spark, d, "part").select("p_partkey", word(1).alias("original"), F.upper(word(2)).alias("corrected"), word(-1).alias("best"), F.col("p_size").cast("long").alias("p"))
    wanted = t(spark, d, "part").select(F.explode(F.split("p_name", " ")).alias("word")).distinct()
    return lines.looked_up(wanted, "word", fixed, "p_partkey", ["original", "corrected", "best"], "p")


def confidence_marks(spark: SparkSession, d: str) -> DataFrame:
    """Benchmark texts with words marked by how sure they are, as their length has it."""
    bare = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit("([a-z]+)"), F.lit(1)))
    sure = F.map_from_entries(F.transform(bare, lambda w: F.struct(w, (F.length(w) % 10) / F.lit(10.0))))
    plain = F.regexp_replace(F.lower("text"), "[^a-z]+", " ")
    return t(spark, d, "benchmark").select("item_id", lines.marked_by_confidence(plain, sure).alias("marked"))


def split_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Nations dealt to splits, with those moved that alone hold a letter."""
    k = F.col("n_nationkey")
    split = F.when(k % 5 == 0, "train").when(k % 2 == 0, "val").otherwise("test")
    named = t(spark, d, "nation").select("n_nationkey", F.concat("n_name", F.chr((F.lit(97) + k % 11).cast("int"))).alias("text"), split.alias("split"))
    return lines.covered(named, "n_nationkey", "text", "split", list("abcdefghijklmnopqrstuvwxyz"))


def ctc_collapse(spark: SparkSession, d: str) -> DataFrame:
    """Users' events as labels of moments, repeats once and zeros left out."""
    label = F.pmod(F.floor("value"), F.lit(3)).cast("int")
    x = t(spark, d, "events").groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("event_id", label.alias("k")))).alias("a"))
    return x.select("user_id", F.concat_ws(" ", lines.collapsed_labels(F.col("a.k")).cast("array<string>")).alias("labels"))


def right_angles(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "part").select("p_partkey", lines.right_angle((F.col("p_partkey") * 7 - 500).cast("int")).cast("long").alias("angle"))


def typical_vectors(spark: SparkSession, d: str) -> DataFrame:
    """Of each label's vectors the tenth that is nearest to their mean."""
    e = t(spark, d, "embeddings")
    near = lines.nearest_to_centre(e, "label", "vec_id", "embedding", 0.1)
    return near.select(F.col("label").cast("long").alias("label"), "vec_id", F.round("distance", 6).alias("distance"))


def first_of_sources(spark: SparkSession, d: str) -> DataFrame:
    """Customers and suppliers by number; where both have it, the customer."""
    c = t(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"))
    s = t(spark, d, "supplier").select((F.col("s_suppkey") * 3).alias("k"), F.col("s_name").alias("name"))
    return lines.first_of_each([s, c], "k", ["name"])


def agent_texts(spark: SparkSession, d: str) -> DataFrame:
    status = F.when(F.col("c_custkey") % 3 != 0, F.lower("c_mktsegment"))
    return t(spark, d, "customer").select("c_custkey", lines.agent_text(F.lit("John"), F.col("c_name"), F.lit(None).cast("string"), F.lit("clerk"), status).alias("text"))


def date_texts(spark: SparkSession, d: str) -> DataFrame:
    day = F.when(F.col("o_orderkey") % 5 != 0, F.date_format("o_orderdate", "yyyy-MM-dd"))
    entry = F.struct("o_orderkey", day.alias("Date"), F.when(F.col("o_orderkey") % 2 == 1, F.col("o_orderstatus")).alias("DateType"))
    x = t(spark, d, "orders").groupBy("o_custkey").agg(F.array_sort(F.collect_list(entry)).alias("dates"))
    return x.select("o_custkey", lines.date_text(F.col("dates")).alias("dates"))


def surname_backfill(spark: SparkSession, d: str) -> DataFrame:
    """Surnames of the customers that the bridge, here of even numbers, lacks."""
    c = t(spark, d, "customer").select("c_custkey", "c_name")
    return ingest.surname_bridge(c, "c_custkey", last_word(F.replace("c_name", F.lit("#"), F.lit(" "))), c.where("c_custkey % 2 = 0").select("c_custkey"))


def job_round(spark: SparkSession, d: str) -> DataFrame:
    """Jobs of year and priority after a round of results."""
    jobs = t(spark, d, "orders").select(F.year("o_orderdate").cast("long").alias("year"), F.col("o_orderpriority").alias("prefix")).distinct()
    k = F.col("year") % 4
    jobs = jobs.withColumn("status", F.when(k == 0, "pending").when(k == 1, "in_progress").when(k == 2, "completed").otherwise("in_progress"))
    results = jobs.where("year % 4 = 1").select("year", "prefix", F.when(F.col("prefix") == "1-URGENT", "timeout").alias("error"))
    return ingest.advanced(jobs, ["year", "prefix"], results, 3)


def prefix_jobs(spark: SparkSession, d: str) -> DataFrame:
    """Beginnings of part names that at most 30 parts share, up to ten letters."""
    return ingest.split_prefixes(t(spark, d, "part"), "p_name", 30, 10)


def work_left(spark: SparkSession, d: str) -> DataFrame:
    """Orders not done yet, and those processed but not corrected."""
    o = t(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    left = ingest.unfinished(o, "o_orderkey", o.where("o_orderstatus = 'F'")).select("o_orderkey", F.lit("unfinished").alias("kind"))
    again = ingest.requeued(o, "o_orderkey", o.where("o_orderkey % 3 = 0"), o.where("o_orderkey % 2 = 0")).select("o_orderkey", F.lit("again").alias("kind"))
    return left.unionByName(again)


def _forms(spark: SparkSession, d: str) -> DataFrame:
    part = t(spark, d, "part").select(F.explode(F.split(F.lower("p_name"), " ")).alias("w"))
    n = part.where("w <> ''").groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    kinds = F.explode(F.array(F.lit("forename"), F.lit("place")))
    form = F.when(F.col("kind") == "forename", F.concat("w", F.lit("us"))).otherwise(F.col("w"))
    return n.select(kinds.alias("kind"), "w", "n").select("kind", form.alias("form"), F.col("w").alias("english"), F.when(F.col("kind") == "forename", "nom").alias("declension"), "n")


def _entities(spark: SparkSession, d: str) -> DataFrame:
    forms = _forms(spark, d)
    text = F.when(F.col("n") % 3 == 0, F.translate("form", "aeo", "eoa")).when(F.col("n") % 3 == 1, F.col("english")).otherwise(F.expr("concat(left(form, length(form) - 1), 'm')"))
    return forms.select(F.concat_ws(":", "kind", "form").alias("entity"), "kind", text.alias("text"), F.when(F.col("n") % 2 == 0, "nom").alias("declension"))


def typed_candidates(spark: SparkSession, d: str) -> DataFrame:
    found = resolve.typed_candidates(_entities(spark, d), resolve.typed_dictionary(_forms(spark, d)))
    return found.select("entity", "term", "english", F.col("distance").cast("long").alias("distance"), "n", "origin", F.col("place").cast("long").alias("place"))


def applied_best(spark: SparkSession, d: str) -> DataFrame:
    """Misread names put right in the line they stand in."""
    entities = _entities(spark, d)
    scored = resolve.select_best(resolve.typed_candidates(entities, resolve.typed_dictionary(_forms(spark, d)), endings=("us", "um", "m")), "entity", "term", "n", total=1000, kinds=10)
    placed = entities.withColumn("line", F.concat(F.lit("In "), F.upper("text"), F.lit(" on "), F.col("kind")))
    out = resolve.applied(placed, scored.where("rank = 1"), "line")
    return out.select("entity", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"), "original", "corrected", "status")


def refilled_scores(spark: SparkSession, d: str) -> DataFrame:
    stored = t(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 4 != 0, F.col("o_totalprice")).alias("loss"))
    fresh = t(spark, d, "orders").where("o_orderkey % 8 = 0").select("o_orderkey", (F.col("o_totalprice") * 2).alias("loss"))
    return resolve.rescored(stored, fresh, ["o_orderkey"], "loss")


def junk_names(spark: SparkSession, d: str) -> DataFrame:
    """Customers whose made-up name is no name."""
    k = F.col("c_custkey") % 9
    made = F.when(k == 0, "J-").when(k == 1, "Jo").when(k == 2, "Jx").when(k == 3, "a_b").when(k == 4, "-a").when(k == 5, "a--b").when(k == 6, "A-b").otherwise(F.col("c_mktsegment"))
    return quality.junk_names(t(spark, d, "customer").select("c_custkey", made.alias("name")), "name")


_FORMS = "v AS (SELECT w, count(*) AS n FROM (SELECT unnest(string_split(lower(p_name), ' ')) AS w FROM part) WHERE w <> '' GROUP BY 1), f AS (SELECT 'forename' AS kind, w || 'us' AS form, w AS english, 'nom' AS declension, n FROM v UNION ALL SELECT 'place', w, w, NULL, n FROM v), e AS (SELECT kind || ':' || form AS entity, kind, CASE n % 3 WHEN 0 THEN translate(form, 'aeo', 'eoa') WHEN 1 THEN english ELSE left(form, length(form) - 1) || 'm' END AS text, CASE WHEN n % 2 = 0 THEN 'nom' END AS declension FROM f)"
_LIMIT = "CASE WHEN length(e.text) <= 3 THEN 0 WHEN length(e.text) <= 5 THEN 1 ELSE 2 END"

CATALOGUE = {
    "line_keys": (line_keys, "SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, printf('L%02d', row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber)) AS key FROM lineitem"),
    "vertical_lines": (vertical_lines, "WITH x AS (SELECT user_id, event_id AS line, CASE WHEN event_id % 3 <> 0 THEN floor(value) END AS y FROM events) SELECT user_id, line, row_number() OVER (PARTITION BY user_id ORDER BY coalesce(y, 0), line) AS first, row_number() OVER (PARTITION BY user_id ORDER BY y NULLS LAST, line) AS last FROM x"),
    "consolidated_lines": (consolidated_lines, "WITH x AS (SELECT user_id, event_type AS text, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS i FROM events) SELECT user_id, printf('L%02d', i) AS key, CASE WHEN i = 2 THEN upper(text) ELSE text END AS final, i = 2 AS is_corrected FROM x"),
    "name_containment": (name_containment, "WITH n AS (SELECT DISTINCT regexp_extract(lower(text), '[a-z]+') AS name FROM benchmark), l AS (SELECT conv_id || '-' || turn AS id, ' ' || trim(regexp_replace(lower(text), '[^a-z]+', ' ', 'g')) || ' ' AS x FROM conversations), h AS (SELECT DISTINCT name, id FROM n JOIN l ON contains(x, ' ' || name || ' ') WHERE name <> '') SELECT name, id, row_number() OVER (PARTITION BY name ORDER BY id) AS place FROM h QUALIFY place <= 5"),
    "probability_lookup": (probability_lookup, "WITH w AS (SELECT DISTINCT unnest(string_split(p_name, ' ')) AS word FROM part), s AS (SELECT 1 AS i, 'original' AS role, split_part(p_name, ' ', 1) AS k, p_partkey, p_size FROM part UNION ALL SELECT 2, 'corrected', split_part(p_name, ' ', 2), p_partkey, p_size FROM part UNION ALL SELECT 3, 'best', split_part(p_name, ' ', -1), p_partkey, p_size FROM part) SELECT word, CAST(p_size AS BIGINT) AS p, role FROM w JOIN s ON lower(trim(word)) = lower(trim(k)) QUALIFY row_number() OVER (PARTITION BY word ORDER BY i, p_partkey) = 1"),
    "confidence_marks": (confidence_marks, "SELECT item_id, array_to_string(list_transform(regexp_extract_all(lower(text), '[a-z]+'), lambda w: CASE WHEN length(w) % 10 < 5 THEN '[[' || w || ']]' WHEN length(w) % 10 < 9 THEN '[' || w || ']' ELSE w END), ' ') AS marked FROM benchmark"),
    "split_coverage": (split_coverage, "WITH x AS (SELECT n_nationkey, n_name || chr(CAST(97 + n_nationkey % 11 AS INT)) AS text, CASE WHEN n_nationkey % 5 = 0 THEN 'train' WHEN n_nationkey % 2 = 0 THEN 'val' ELSE 'test' END AS split FROM nation), c AS (SELECT DISTINCT n_nationkey, split, unnest(string_split(text, '')) AS c FROM x), f AS (SELECT c, n_nationkey FROM c WHERE c BETWEEN 'a' AND 'z' AND c NOT IN (SELECT c FROM c WHERE split = 'train') QUALIFY row_number() OVER (PARTITION BY c ORDER BY split = 'test', n_nationkey) = 1) SELECT n_nationkey, text, CASE WHEN n_nationkey IN (SELECT n_nationkey FROM f) THEN 'train' ELSE split END AS split FROM x"),
    "ctc_collapse": (ctc_collapse, "WITH x AS (SELECT user_id, event_id, CAST(floor(value) - 3 * floor(floor(value) / 3) AS INT) AS k FROM events), y AS (SELECT *, lag(k) OVER (PARTITION BY user_id ORDER BY event_id) AS b FROM x) SELECT user_id, coalesce(string_agg(CAST(k AS VARCHAR), ' ' ORDER BY event_id) FILTER (k <> 0 AND k IS DISTINCT FROM b), '') AS labels FROM y GROUP BY 1"),
    "right_angles": (right_angles, "WITH x AS (SELECT p_partkey, ((p_partkey * 7 - 500) % 360 + 360) % 360 AS a FROM part) SELECT p_partkey, CAST(CASE WHEN a <= 45 OR a >= 315 THEN 0 WHEN a <= 135 THEN 90 WHEN a <= 225 THEN 180 ELSE 270 END AS BIGINT) AS angle FROM x"),
    "typical_vectors": (typical_vectors, "WITH p AS (SELECT label, vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings), m AS (SELECT label, i, avg(CAST(x AS DOUBLE)) AS m FROM p GROUP BY 1, 2), o AS (SELECT p.label, vec_id, sqrt(sum((x - m) * (x - m))) AS distance FROM p JOIN m ON p.label = m.label AND p.i = m.i GROUP BY 1, 2) SELECT CAST(label AS BIGINT) AS label, vec_id, round(distance, 6) AS distance FROM o QUALIFY row_number() OVER (PARTITION BY label ORDER BY distance, vec_id) <= ceil(count(*) OVER (PARTITION BY label) * 0.1)"),
    "first_of_sources": (first_of_sources, "SELECT s_suppkey * 3 AS k, s_name AS name FROM supplier UNION ALL SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT s_suppkey * 3 FROM supplier)"),
    "agent_texts": (agent_texts, "SELECT c_custkey, 'Person: John ' || c_name || '. Role: . Occupation: clerk. Status: ' || CASE WHEN c_custkey % 3 <> 0 THEN lower(c_mktsegment) ELSE '' END || '.' AS text FROM customer"),
    "date_texts": (date_texts, "SELECT o_custkey, coalesce(string_agg(strftime(o_orderdate, '%Y-%m-%d') || CASE WHEN o_orderkey % 2 = 1 THEN ' (' || o_orderstatus || ')' ELSE '' END, '; ' ORDER BY o_orderkey) FILTER (o_orderkey % 5 <> 0), '') AS dates FROM orders GROUP BY 1"),
    "surname_backfill": (surname_backfill, "SELECT c_custkey, split_part(replace(c_name, '#', ' '), ' ', -1) AS surname FROM customer WHERE c_custkey % 2 <> 0"),
    "job_round": (job_round, "WITH j AS (SELECT DISTINCT CAST(year(o_orderdate) AS BIGINT) AS year, o_orderpriority AS prefix FROM orders), s AS (SELECT *, CASE year % 4 WHEN 0 THEN 'pending' WHEN 2 THEN 'completed' WHEN 3 THEN 'pending' WHEN 1 THEN CASE WHEN prefix = '1-URGENT' THEN 'failed' ELSE 'completed' END END AS status FROM j), r AS (SELECT year, prefix, row_number() OVER (ORDER BY year, prefix) AS i FROM s WHERE status = 'pending') SELECT s.year, s.prefix, CASE WHEN i <= 3 THEN 'in_progress' ELSE status END AS status FROM s LEFT JOIN r ON s.year = r.year AND s.prefix = r.prefix"),
    "prefix_jobs": (prefix_jobs, "WITH x AS (SELECT DISTINCT p_partkey, substr(lower(p_name), 1, l) AS prefix FROM part, (SELECT unnest(range(1, 11)) AS l)), c AS (SELECT prefix, count(*) AS n FROM x GROUP BY 1) SELECT c.prefix, c.n FROM c LEFT JOIN c AS u ON u.prefix = left(c.prefix, length(c.prefix) - 1) WHERE (length(c.prefix) = 1 OR u.n > 30) AND (c.n <= 30 OR length(c.prefix) = 10)"),
    "work_left": (work_left, "SELECT o_orderkey, 'unfinished' AS kind FROM orders WHERE o_orderstatus <> 'F' UNION ALL SELECT o_orderkey, 'again' FROM orders WHERE o_orderkey % 3 = 0 AND o_orderkey % 2 <> 0"),
    "typed_candidates": (typed_candidates, f"WITH {_FORMS}, m AS (SELECT e.entity, f.form AS term, f.english, f.n, least(levenshtein(e.text, f.form), levenshtein(replace(e.text, 'j', 'i'), replace(f.form, 'j', 'i'))) AS distance, CASE WHEN e.text = f.form AND (e.declension IS NULL OR f.declension IS NULL OR e.declension = f.declension) THEN 'exact' WHEN e.text = f.english THEN 'english' WHEN least(levenshtein(e.text, f.form), levenshtein(replace(e.text, 'j', 'i'), replace(f.form, 'j', 'i'))) <= {_LIMIT} THEN 'edit' END AS origin FROM e JOIN f ON e.kind = f.kind) SELECT entity, term, english, CAST(distance AS BIGINT) AS distance, n, origin, row_number() OVER (PARTITION BY entity ORDER BY distance, n DESC, term) AS place FROM m WHERE origin IS NOT NULL QUALIFY place <= 50"),
    "applied_best": (applied_best, None),
    "refilled_scores": (refilled_scores, "SELECT o_orderkey, CASE WHEN o_orderkey % 4 <> 0 THEN o_totalprice WHEN o_orderkey % 8 = 0 THEN o_totalprice * 2 END AS loss, o_orderkey % 8 = 0 AS rescored FROM orders"),
    "junk_names": (junk_names, "SELECT c_custkey, ['J-', 'Jx', 'a_b', '-a', 'a--b'][list_position([0, 2, 3, 4, 5], c_custkey % 9)] AS name FROM customer WHERE c_custkey % 9 IN (0, 2, 3, 4, 5)"),
}
