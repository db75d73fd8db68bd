"""Lookups, joins, aggregates, ingest and documents over the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import documents, ingest, lookup, quality, stats
from ..session import table as t

_long = lambda *names: [F.col(n).cast("long").alias(n) for n in names]


def search_topk_left_count(spark: SparkSession, d: str) -> DataFrame:
    """Parts by name with the number of lines that sold them."""
    return lookup.search_counts(t(spark, d, "part"), t(spark, d, "lineitem"), "p_partkey", "l_partkey", "p_name", "%a%", 100)


def three_way_lookup(spark: SparkSession, d: str) -> DataFrame:
    """The first orders of a nation's customers."""
    nation = t(spark, d, "nation").where(F.col("n_nationkey") == 3)
    joined = lookup.chain(t(spark, d, "orders"), (t(spark, d, "customer"), "o_custkey", "c_custkey"), (nation, "c_nationkey", "n_nationkey"))
    return joined.select("o_orderkey", "c_name", "n_name", F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_day")).orderBy("o_day", "o_orderkey").limit(50)


def bridge_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Distinct brands of what each supplier ships."""
    lines = t(spark, d, "lineitem").select("l_suppkey", "l_partkey").distinct()
    return lookup.chain(lines, (t(spark, d, "part"), "l_partkey", "p_partkey"), (t(spark, d, "supplier"), "l_suppkey", "s_suppkey")).select("s_name", "p_brand").distinct()


def missing_children_anti(spark: SparkSession, d: str) -> DataFrame:
    return lookup.orphans(t(spark, d, "customer"), t(spark, d, "orders"), "c_custkey", "o_custkey").select("c_custkey", "c_name")


def not_in_distinct_anti(spark: SparkSession, d: str) -> DataFrame:
    returned = t(spark, d, "lineitem").where(F.col("l_returnflag") == "R")
    return lookup.not_in(t(spark, d, "part"), "p_partkey", returned, "l_partkey").select("p_partkey")


def semi_membership(spark: SparkSession, d: str) -> DataFrame:
    urgent = t(spark, d, "orders").where(F.col("o_orderpriority").startswith("1")).select(F.col("o_custkey").alias("c_custkey"))
    return t(spark, d, "customer").join(urgent, "c_custkey", "left_semi").select("c_custkey", "c_mktsegment")


def distinct_reference_dedupe(spark: SparkSession, d: str) -> DataFrame:
    """One order of each customer of a segment: the smallest key."""
    joined = lookup.chain(t(spark, d, "orders"), (t(spark, d, "customer"), "o_custkey", "c_custkey"))
    return joined.select("c_custkey", "c_mktsegment", "o_orderkey").distinct().groupBy("c_custkey", "c_mktsegment").agg(F.min("o_orderkey").alias("o_orderkey"))


def freq_left_join(spark: SparkSession, d: str) -> DataFrame:
    n = t(spark, d, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count(F.lit(1)).alias("n"))
    return t(spark, d, "nation").join(n, "n_nationkey", "left").select("n_name", F.coalesce("n", F.lit(0)).alias("n"))


def freq_distinct_having(spark: SparkSession, d: str) -> DataFrame:
    joined = lookup.chain(t(spark, d, "orders"), (t(spark, d, "customer"), "o_custkey", "c_custkey"))
    return joined.groupBy("c_nationkey").agg(F.count_distinct("o_custkey").alias("buyers"), F.count(F.lit(1)).alias("orders")).where("buyers > 1")


def status_counts(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "orders").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


def progress_casesum(spark: SparkSession, d: str) -> DataFrame:
    s = F.col("o_orderstatus")
    return stats.conditional_counts(t(spark, d, "orders"), ["o_orderpriority"], {"done": s == "F", "open": s == "O", "pending": s == "P"})


def global_stats(spark: SparkSession, d: str) -> DataFrame:
    day = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    return t(spark, d, "events").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("user_id").alias("users"), day(F.min("ts")).alias("first"), day(F.max("ts")).alias("last"),
        F.round(F.min("value"), 6).alias("least"), F.round(F.max("value"), 6).alias("most"),
    )


def enum_values_topn(spark: SparkSession, d: str) -> DataFrame:
    return stats.frequencies(t(spark, d, "part"), F.col("p_type"), "p_type", 25)


def first_word_freq(spark: SparkSession, d: str) -> DataFrame:
    return stats.frequencies(t(spark, d, "part"), F.substring_index("p_name", " ", 1), "word")


def custom_case_order(spark: SparkSession, d: str) -> DataFrame:
    by = t(spark, d, "orders").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    return by.withColumn("place", lookup.by_listed_order(F.col("o_orderpriority"), ["5-LOW", "3-MEDIUM", "1-URGENT"]).cast("long")).orderBy("place", "o_orderpriority")


def null_safe_match(spark: SparkSession, d: str) -> DataFrame:
    """Documents paired with label classes by quality, unlabelled with unlabelled."""
    docs = t(spark, d, "documents").join(t(spark, d, "labels"), "doc_id", "left").select("doc_id", "quality")
    classes = docs.groupBy("quality").agg(F.count(F.lit(1)).alias("n"))
    return lookup.null_safe_match(docs, classes, ["quality"]).select("doc_id", F.col("quality").cast("long").alias("quality"), "n")


def rotulus_variants(spark: SparkSession, d: str) -> DataFrame:
    keys = t(spark, d, "nation").select("n_name", F.explode(lookup.zero_padded(F.col("n_nationkey"))).alias("spelling"))
    wanted = t(spark, d, "region").select(F.lpad(F.col("r_regionkey").cast("string"), 3, "0").alias("spelling"), "r_name")
    return keys.join(wanted, "spelling").select("n_name", "r_name", "spelling")


def fallback_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Keys with a letter behind every third number, found without it."""
    key = F.col("n_nationkey").cast("string")
    asked = t(spark, d, "nation").select(F.when(F.col("n_nationkey") % 3 == 0, F.concat(key, F.lit("d"))).otherwise(key).alias("request"))
    store = t(spark, d, "nation").select(key.alias("code"), "n_name")
    return lookup.with_fallback(asked, "request", store, "code")


def or_lookup_union(spark: SparkSession, d: str) -> DataFrame:
    wanted = t(spark, d, "region").select(F.lower("r_name").alias("name")).unionByName(t(spark, d, "nation").where("n_nationkey < 5").select(F.lower("n_name").alias("name")))
    both = t(spark, d, "nation").join(t(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "n_name", "r_name")
    return lookup.any_of_names(both, ["n_name", "r_name"], wanted, "name")


def garbage_filter(spark: SparkSession, d: str) -> DataFrame:
    return quality.token_flags(t(spark, d, "documents"), "text", ("the", "and", "der", "die", "que"))


def nested_case_document(spark: SparkSession, d: str) -> DataFrame:
    """Orders as documents of their lines and customer, flattened to compare."""
    orders = t(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    nested = documents.attach_list(
        orders, t(spark, d, "lineitem"), "o_orderkey", "l_orderkey",
        {"line": F.col("l_linenumber"), "part": F.col("l_partkey"), "flag": F.col("l_returnflag")}, "line", "lines",
    )
    customers = t(spark, d, "customer").select(F.col("c_custkey").alias("k"), "c_name", "c_mktsegment")
    named = documents.attach_first(nested, customers, "o_custkey", "k", ["c_name", "c_mktsegment"], "k")
    flags = F.array_join(F.array_sort(F.array_distinct(F.col("lines.flag"))), ",")
    return named.select(
        "o_orderkey", "c_name", "c_mktsegment", F.size("lines").cast("long").alias("n_lines"), flags.alias("flags"),
        F.array_join(F.transform("lines", lambda x: x["part"].cast("string")), ",").alias("parts"),
    )


def doc_roundtrip_json(spark: SparkSession, d: str) -> DataFrame:
    packed = t(spark, d, "events").select("event_id", documents.to_document(F.struct("event_type", "value", "props")).alias("doc"))
    inner = documents.field(F.col("doc"), "$.props")
    return packed.select("event_id", documents.field(F.col("doc"), "$.event_type").alias("event_type"), F.try_to_number(documents.field(inner, "$.k"), F.lit("999999")).cast("long").alias("k"))


def hash_dedup_ingest(spark: SparkSession, d: str) -> DataFrame:
    return ingest.deduplicated(t(spark, d, "documents"), "doc_id", "text")


def ingest_batch_counts(spark: SparkSession, d: str) -> DataFrame:
    """A batch of half the documents on a store of a third of them."""
    keyed = t(spark, d, "documents").select("doc_id", ingest.content_key(F.col("text")).alias("hash"))
    return ingest.ingest_counts(keyed.where("doc_id % 3 = 0"), keyed.where("doc_id % 2 = 0"), "doc_id", "hash")


def insert_new_rows(spark: SparkSession, d: str) -> DataFrame:
    e = t(spark, d, "events").select("user_id", "event_type", "event_id")
    return ingest.insert_new(e.where("event_id % 2 = 0"), e.where("event_id % 2 = 1"), ["user_id", "event_type"], [F.col("event_id")])


def bridge_fanout(spark: SparkSession, d: str) -> DataFrame:
    words = F.regexp_extract_all(F.lower("text"), F.lit("([a-z]+)"), F.lit(1))
    return ingest.bridge(t(spark, d, "documents"), "doc_id", words, "word").groupBy("word").agg(F.count(F.lit(1)).alias("docs"), F.min("doc_id").alias("first_doc"))


def upsert_frequency(spark: SparkSession, d: str) -> DataFrame:
    by = lambda w: t(spark, d, "orders").where(w).groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    return ingest.upsert_sum(by("o_orderkey % 2 = 0"), by("o_orderkey % 2 = 1"), ["o_orderpriority"], "n")


def latest_per_key(spark: SparkSession, d: str) -> DataFrame:
    return ingest.latest(t(spark, d, "events"), ["user_id", "event_type"], [F.desc("ts"), F.desc("event_id")]).select("user_id", "event_type", "event_id")


def cascade_delete(spark: SparkSession, d: str) -> DataFrame:
    gone = t(spark, d, "customer").where("c_acctbal < 0")
    left = ingest.cascade_delete({"orders": t(spark, d, "orders")}, gone, {"orders": "o_custkey"}, "c_custkey")["orders"]
    return left.select("o_orderkey", "o_custkey")


def line_overlay(spark: SparkSession, d: str) -> DataFrame:
    """Line prices overridden by a second reading of every fifth order."""
    lines = t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    read = lines.where("l_orderkey % 5 = 0").withColumn("l_returnflag", F.concat("l_returnflag", F.lit("*")))
    return lookup.overlay(lines, read, ["l_orderkey", "l_linenumber"], "l_returnflag").select(*_long("l_orderkey", "l_linenumber"), "l_returnflag", "source")


def rollup_four_grain(spark: SparkSession, d: str) -> DataFrame:
    facts = t(spark, d, "lineitem").select(
        "l_returnflag", "l_linestatus", F.col("l_discount").alias("score"), (F.col("l_discount") >= 0.05).alias("hit"), "l_orderkey",
    )
    return stats.rollup_grains(facts, "l_returnflag", "l_linestatus", "score", "hit", "l_orderkey")


def basis_histogram(spark: SparkSession, d: str) -> DataFrame:
    out = stats.histogram(t(spark, d, "orders"), ["o_orderstatus"], "o_orderpriority")
    return out.withColumn("share", F.round("share", 9))


def replication_distribution(spark: SparkSession, d: str) -> DataFrame:
    n = t(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
    return stats.distribution(n, "n").select(*[F.round(c, 6).alias(c) for c in ("mean", "median", "spread", "p25", "p50", "p75", "p90", "p95", "p99")])


def cost_rollup(spark: SparkSession, d: str) -> DataFrame:
    """Characters as tokens: answers are the assistant's, every third turn is cached."""
    c = t(spark, d, "conversations").select(
        "role", F.length("text").cast("long").alias("prompt"), F.when(F.col("turn") % 3 == 0, F.length("text")).otherwise(0).cast("long").alias("cached"),
        F.when(F.col("role") == "assistant", F.length("text")).otherwise(0).cast("long").alias("answer"),
    )
    return stats.token_costs(c, ["role"], "prompt", "cached", "answer", 0.25, 1.50)


def validation_issues(spark: SparkSession, d: str) -> DataFrame:
    return quality.issue_summary(quality.conversation_issues(t(spark, d, "conversations")), "conv_id")


def accuracy_bands(spark: SparkSession, d: str) -> DataFrame:
    by = t(spark, d, "lineitem").groupBy("l_suppkey").agg(F.round(100.0 * F.count_if(F.col("l_returnflag") != "R") / F.count(F.lit(1)), 6).alias("percent"))
    return by.select("l_suppkey", "percent", stats.accuracy_band(F.col("percent")).alias("band"))


def set_operations(spark: SparkSession, d: str) -> DataFrame:
    """Nations of customers and of suppliers: in both, in one only, in any."""
    a, b = t(spark, d, "customer").select(F.col("c_nationkey").alias("k")), t(spark, d, "supplier").select(F.col("s_nationkey").alias("k"))
    named = lambda df, n: df.select(F.col("k").cast("long").alias("k"), F.lit(n).alias("kind"))
    return named(a.intersect(b), "both").unionByName(named(a.subtract(b), "first")).unionByName(named(a.union(b).distinct(), "any"))


def bottom_k(spark: SparkSession, d: str) -> DataFrame:
    by = t(spark, d, "lineitem").groupBy("l_partkey").agg(F.round(F.avg("l_discount"), 6).alias("score"))
    return by.orderBy("score", "l_partkey").limit(15)


_GRAIN = """SELECT CASE GROUPING(l_returnflag) * 2 + GROUPING(l_linestatus) WHEN 0 THEN 'l_returnflag,l_linestatus' WHEN 1 THEN 'l_returnflag' WHEN 2 THEN 'l_linestatus' ELSE 'all' END AS grain,
 l_returnflag, l_linestatus, count(*) AS total, count(*) FILTER (l_discount >= CAST(0.05 AS DOUBLE)) AS matches,
 round_even(CAST(100.0 AS DOUBLE) * count(*) FILTER (l_discount >= CAST(0.05 AS DOUBLE)) / count(*), 2) AS accuracy, round_even(avg(l_discount), 4) AS mean,
 round_even(median(l_discount), 4) AS median, round_even(min(l_discount), 4) AS least, round_even(max(l_discount), 4) AS most,
 round_even(coalesce(stddev_samp(l_discount), 0), 4) AS spread, count(DISTINCT l_orderkey) AS cases
 FROM lineitem GROUP BY GROUPING SETS ((), (l_returnflag), (l_linestatus), (l_returnflag, l_linestatus))"""

CATALOGUE = {
    "search_topk_left_count": (search_topk_left_count, "SELECT p_partkey, p_name, count(l_partkey) AS n FROM part LEFT JOIN lineitem ON p_partkey = l_partkey WHERE p_name ILIKE '%a%' GROUP BY 1, 2 ORDER BY n DESC, p_partkey LIMIT 100"),
    "three_way_lookup": (three_way_lookup, "SELECT o_orderkey, c_name, n_name, strftime(o_orderdate, '%Y-%m-%d') AS o_day FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE n_nationkey = 3 ORDER BY o_day, o_orderkey LIMIT 50"),
    "bridge_lookup": (bridge_lookup, "SELECT DISTINCT s_name, p_brand FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey"),
    "missing_children_anti": (missing_children_anti, "SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)"),
    "not_in_distinct_anti": (not_in_distinct_anti, "SELECT p_partkey FROM part WHERE p_partkey NOT IN (SELECT DISTINCT l_partkey FROM lineitem WHERE l_returnflag = 'R')"),
    "semi_membership": (semi_membership, "SELECT c_custkey, c_mktsegment FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority LIKE '1%')"),
    "distinct_reference_dedupe": (distinct_reference_dedupe, "SELECT c_custkey, c_mktsegment, min(o_orderkey) AS o_orderkey FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2"),
    "freq_left_join": (freq_left_join, "SELECT n_name, count(c_custkey) AS n FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY n_nationkey, n_name"),
    "freq_distinct_having": (freq_distinct_having, "SELECT c_nationkey, count(DISTINCT o_custkey) AS buyers, count(*) AS orders FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1 HAVING count(DISTINCT o_custkey) > 1"),
    "status_counts": (status_counts, "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1"),
    "progress_casesum": (progress_casesum, "SELECT o_orderpriority, count(*) AS n, count(*) FILTER (o_orderstatus = 'F') AS done, count(*) FILTER (o_orderstatus = 'O') AS open, count(*) FILTER (o_orderstatus = 'P') AS pending FROM orders GROUP BY 1"),
    "global_stats": (global_stats, "SELECT count(*) AS n, count(DISTINCT user_id) AS users, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS first, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last, round(min(value), 6) AS least, round(max(value), 6) AS most FROM events"),
    "enum_values_topn": (enum_values_topn, "SELECT p_type, count(*) AS n FROM part WHERE p_type <> '' GROUP BY 1 ORDER BY n DESC, p_type LIMIT 25"),
    "first_word_freq": (first_word_freq, "SELECT split_part(p_name, ' ', 1) AS word, count(*) AS n FROM part WHERE split_part(p_name, ' ', 1) <> '' GROUP BY 1"),
    "custom_case_order": (custom_case_order, "SELECT o_orderpriority, count(*) AS n, CAST(CASE o_orderpriority WHEN '5-LOW' THEN 0 WHEN '3-MEDIUM' THEN 1 WHEN '1-URGENT' THEN 2 ELSE 3 END AS BIGINT) AS place FROM orders GROUP BY 1"),
    "null_safe_match": (null_safe_match, "WITH d AS (SELECT doc_id, quality FROM documents LEFT JOIN labels USING (doc_id)), c AS (SELECT quality, count(*) AS n FROM d GROUP BY 1) SELECT d.doc_id, CAST(d.quality AS BIGINT) AS quality, c.n FROM d JOIN c ON d.quality IS NOT DISTINCT FROM c.quality"),
    "rotulus_variants": (rotulus_variants, "SELECT n_name, r_name, lpad(CAST(r_regionkey AS VARCHAR), 3, '0') AS spelling FROM nation JOIN region ON n_nationkey = r_regionkey"),
    "fallback_lookup": (fallback_lookup, "SELECT CASE WHEN n_nationkey % 3 = 0 THEN n_nationkey || 'd' ELSE CAST(n_nationkey AS VARCHAR) END AS request, CAST(n_nationkey AS VARCHAR) AS code, n_name FROM nation"),
    "or_lookup_union": (or_lookup_union, "WITH w AS (SELECT lower(r_name) AS n FROM region UNION SELECT lower(n_name) FROM nation WHERE n_nationkey < 5) SELECT DISTINCT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey WHERE lower(n_name) IN (SELECT n FROM w) OR lower(r_name) IN (SELECT n FROM w)"),
    "garbage_filter": (garbage_filter, "WITH x AS (SELECT unnest(regexp_extract_all(lower(text), '[a-z0-9_-]+')) AS token FROM documents) SELECT token, count(*) AS n, token IN ('the', 'and', 'der', 'die', 'que') AS stop_word, length(token) = 1 AS single, length(token) < 3 AS short, regexp_matches(token, '_|--|^-|-$') AS odd FROM x GROUP BY 1"),
    "nested_case_document": (nested_case_document, "WITH l AS (SELECT l_orderkey, count(*) AS n, string_agg(DISTINCT l_returnflag, ',' ORDER BY l_returnflag) AS flags, string_agg(CAST(l_partkey AS VARCHAR), ',' ORDER BY l_linenumber, l_partkey, l_returnflag) AS parts FROM lineitem GROUP BY 1) SELECT o_orderkey, c_name, c_mktsegment, coalesce(n, 0) AS n_lines, coalesce(flags, '') AS flags, coalesce(parts, '') AS parts FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN l ON o_orderkey = l_orderkey"),
    "doc_roundtrip_json": (doc_roundtrip_json, "SELECT event_id, event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events"),
    "hash_dedup_ingest": (hash_dedup_ingest, "SELECT sha256(text) AS hash, min(doc_id) AS first_id, count(*) AS n FROM documents WHERE text <> '' GROUP BY 1"),
    "ingest_batch_counts": (ingest_batch_counts, "WITH s AS (SELECT DISTINCT text FROM documents WHERE doc_id % 3 = 0), b AS (SELECT text, count(*) AS n FROM documents WHERE doc_id % 2 = 0 GROUP BY 1) SELECT count(*) FILTER (s.text IS NULL) AS new, CAST(sum(b.n) - count(*) FILTER (s.text IS NULL) AS BIGINT) AS duplicate FROM b LEFT JOIN s ON b.text = s.text"),
    "insert_new_rows": (insert_new_rows, "SELECT user_id, event_type, min(event_id) AS event_id FROM events e WHERE event_id % 2 = 1 AND NOT EXISTS (SELECT 1 FROM events o WHERE o.event_id % 2 = 0 AND o.user_id = e.user_id AND o.event_type = e.event_type) GROUP BY 1, 2"),
    "bridge_fanout": (bridge_fanout, "WITH x AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS word FROM documents) SELECT word, count(*) AS docs, min(doc_id) AS first_doc FROM x GROUP BY 1"),
    "upsert_frequency": (upsert_frequency, "SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1"),
    "latest_per_key": (latest_per_key, "SELECT user_id, event_type, event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1"),
    "cascade_delete": (cascade_delete, "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)"),
    "line_overlay": (line_overlay, "WITH r AS (SELECT l_orderkey AS k, l_linenumber AS m, l_returnflag || '*' AS f FROM lineitem WHERE l_orderkey % 5 = 0) SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, coalesce(f, l_returnflag) AS l_returnflag, CASE WHEN f IS NULL THEN 'original' ELSE 'changed' END AS source FROM lineitem LEFT JOIN r ON l_orderkey = k AND l_linenumber = m"),
    "rollup_four_grain": (rollup_four_grain, _GRAIN),
    "basis_histogram": (basis_histogram, "SELECT o_orderstatus, o_orderpriority, count(*) AS n, round(CAST(count(*) AS DOUBLE) / sum(count(*)) OVER (PARTITION BY o_orderstatus), 9) AS share FROM orders GROUP BY 1, 2"),
    "replication_distribution": (replication_distribution, "WITH x AS (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey) SELECT round(avg(n), 6) AS mean, round(median(n), 6) AS median, round(stddev_pop(n), 6) AS spread, round(quantile_cont(n, 0.25), 6) AS p25, round(quantile_cont(n, 0.5), 6) AS p50, round(quantile_cont(n, 0.75), 6) AS p75, round(quantile_cont(n, 0.9), 6) AS p90, round(quantile_cont(n, 0.95), 6) AS p95, round(quantile_cont(n, 0.99), 6) AS p99 FROM x"),
    "cost_rollup": (cost_rollup, "WITH x AS (SELECT role, length(text) AS p, CASE WHEN turn % 3 = 0 THEN length(text) ELSE 0 END AS c, CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END AS a FROM conversations) SELECT role, CAST(sum(p) AS BIGINT) AS prompt_tokens, CAST(sum(c) AS BIGINT) AS cached_tokens, CAST(sum(a) AS BIGINT) AS answer_tokens, round(CAST(sum(p - c) AS DOUBLE) * CAST(0.25 AS DOUBLE) / 1e6 + CAST(sum(a) AS DOUBLE) * CAST(1.5 AS DOUBLE) / 1e6, 6) AS cost FROM x GROUP BY 1"),
    "validation_issues": (validation_issues, "WITH w AS (SELECT conv_id, turn, role, text FROM conversations), i AS (SELECT conv_id, 'empty_text' AS issue, 'critical' AS severity FROM w WHERE text IS NULL OR trim(text) = '' UNION ALL SELECT conv_id, 'unknown_role', 'critical' FROM w WHERE role IS NULL OR role NOT IN ('system', 'user', 'assistant') UNION ALL SELECT conv_id, 'not_one_sentence', 'minor' FROM w WHERE length(text) > 50 AND NOT regexp_matches(text, '[.!?]') UNION ALL SELECT conv_id, 'no_answer', 'major' FROM w GROUP BY 1 HAVING count(*) FILTER (role = 'assistant') = 0) SELECT conv_id, count(*) AS issues, count(*) FILTER (severity = 'critical') AS critical, string_agg(DISTINCT issue, ',' ORDER BY issue) AS kinds FROM i GROUP BY 1"),
    "accuracy_bands": (accuracy_bands, "WITH x AS (SELECT l_suppkey, round(CAST(100.0 AS DOUBLE) * count(*) FILTER (l_returnflag <> 'R') / count(*), 6) AS percent FROM lineitem GROUP BY 1) SELECT *, CASE WHEN percent >= 90 THEN 'high' WHEN percent >= 75 THEN 'good' WHEN percent >= 50 THEN 'fair' ELSE 'low' END AS band FROM x"),
    "set_operations": (set_operations, "SELECT CAST(c_nationkey AS BIGINT) AS k, 'both' AS kind FROM (SELECT c_nationkey FROM customer INTERSECT SELECT s_nationkey FROM supplier) UNION ALL SELECT CAST(c_nationkey AS BIGINT), 'first' FROM (SELECT c_nationkey FROM customer EXCEPT SELECT s_nationkey FROM supplier) UNION ALL SELECT CAST(c_nationkey AS BIGINT), 'any' FROM (SELECT c_nationkey FROM customer UNION SELECT s_nationkey FROM supplier)"),
    "bottom_k": (bottom_k, "SELECT l_partkey, round(avg(l_discount), 6) AS score FROM lineitem GROUP BY 1 ORDER BY score, l_partkey LIMIT 15"),
}
