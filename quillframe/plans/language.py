"""Backoff language models over the documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import language_model as lm
from ..operators import trigrams
from ..session import table as t


def _sequences(spark: SparkSession, d: str, name: str, key: str) -> DataFrame:
    return t(spark, d, name).select(key, lm.marked(F.col("text")).alias("s"))


def backoff_trigrams(spark: SparkSession, d: str) -> DataFrame:
    """A trigram model of all documents."""
    out = trigrams.backoff_model(_sequences(spark, d, "documents", "doc_id"), "s")
    return out.select(F.col("order").cast("long").alias("order"), "w1", "w2", "w3", (F.round("log_prob", 6) + 0.0).alias("log_prob"), (F.round("backoff", 5) + 0.0).alias("backoff"))


def backoff_scoring(spark: SparkSession, d: str) -> DataFrame:
    """The turns of all conversations as likely as the documents' model finds them."""
    turns = t(spark, d, "conversations").select(F.concat_ws("-", "conv_id", "turn").alias("id"), lm.marked(F.col("text")).alias("s"))
    return trigrams.backoff_scores(_sequences(spark, d, "documents", "doc_id"), "s", turns, "id", "s").select("id", "n", F.round("log_prob", 4).alias("log_prob"))


def context_expansion(spark: SparkSession, d: str) -> DataFrame:
    """Bigrams of orders' priority and state, the urgent ones' anew for market segments."""
    n = t(spark, d, "orders").groupBy(F.col("o_orderpriority").alias("w1"), F.col("o_orderstatus").alias("w2")).agg(F.count(F.lit(1)).alias("n"))
    total = n.groupBy("w1").agg(F.sum("n").alias("all"))
    bigrams = n.join(total, "w1").select("w1", "w2", F.log10(F.col("n") / F.col("all")).alias("log_prob"))
    names = t(spark, d, "customer").groupBy(F.col("c_mktsegment").alias("token")).agg(F.count(F.lit(1)).alias("n"))
    return lm.expand_contexts(bigrams, names, "1-URGENT", contexts=2, most=3).select("w1", "w2", F.round("log_prob", 9).alias("log_prob"))


def tempered_shares(spark: SparkSession, d: str) -> DataFrame:
    n = t(spark, d, "part").groupBy("p_brand", "p_type").agg(F.count(F.lit(1)).alias("n"))
    out = lm.tempered(n, ["p_brand"], "n", [F.desc("n"), F.col("p_type")], temperature=0.7, top=4)
    return out.select("p_brand", "p_type", F.round("share", 9).alias("share"))


def _marked(table: str, key: str) -> str:
    return f"SELECT {key} AS id, ['<s>'] || regexp_extract_all(lower(coalesce(text, '')), '[a-z]+') || ['</s>'] AS s FROM {table}"


# Tokens of the documents by position, counts of runs of one to three, and the probabilities and leftovers of the model.
_MODEL = f"""d AS ({_marked('documents', 'doc_id')}),
t1 AS (SELECT unnest(s[2:]) AS w1 FROM d),
r2 AS (SELECT unnest(list_transform(range(1, len(s)), lambda i: [s[i], s[i + 1]])) AS r FROM d),
r3 AS (SELECT unnest(list_transform(range(1, len(s) - 1), lambda i: [s[i], s[i + 1], s[i + 2]])) AS r FROM d),
one AS (SELECT w1, CAST(count(*) AS DOUBLE) / sum(count(*)) OVER () AS p FROM t1 GROUP BY 1),
two AS (SELECT r[1] AS w1, r[2] AS w2, (count(*) - CAST(0.5 AS DOUBLE)) / sum(count(*)) OVER (PARTITION BY r[1]) AS p, sum(count(*)) OVER (PARTITION BY r[1]) AS t FROM r2 GROUP BY r),
three AS (SELECT r[1] AS w1, r[2] AS w2, r[3] AS w3, (count(*) - CAST(0.5 AS DOUBLE)) / sum(count(*)) OVER (PARTITION BY r[1], r[2]) AS p, sum(count(*)) OVER (PARTITION BY r[1], r[2]) AS t FROM r3 GROUP BY r),
b1 AS (SELECT two.w1, CAST(0.5 AS DOUBLE) * count(*) / max(two.t) AS l, 1 - sum(one.p) AS f FROM two JOIN one ON two.w2 = one.w1 GROUP BY 1),
b2 AS (SELECT three.w1, three.w2, CAST(0.5 AS DOUBLE) * count(*) / max(three.t) AS l, 1 - sum(two.p) AS f FROM three JOIN two ON three.w2 = two.w1 AND three.w3 = two.w2 GROUP BY 1, 2),
m1 AS (SELECT coalesce(one.w1, b1.w1) AS w1, CASE WHEN p > 0 THEN log10(p) ELSE -99 END AS log_prob, CASE WHEN l IS NULL THEN NULL WHEN f > 1e-9 AND l > 0 THEN log10(l / f) ELSE -99 END AS backoff FROM one FULL JOIN b1 ON one.w1 = b1.w1),
m2 AS (SELECT two.w1, two.w2, log10(p) AS log_prob, CASE WHEN l IS NULL THEN NULL WHEN f > 1e-9 AND l > 0 THEN log10(l / f) ELSE -99 END AS backoff FROM two LEFT JOIN b2 ON two.w1 = b2.w1 AND two.w2 = b2.w2),
m3 AS (SELECT w1, w2, w3, log10(p) AS log_prob FROM three)"""

CATALOGUE = {
    "backoff_trigrams": (backoff_trigrams, f"WITH {_MODEL} SELECT CAST(1 AS BIGINT) AS \"order\", w1, CAST(NULL AS VARCHAR) AS w2, CAST(NULL AS VARCHAR) AS w3, round(log_prob, 6) + CAST(0 AS DOUBLE) AS log_prob, round(backoff, 5) + CAST(0 AS DOUBLE) AS backoff FROM m1 UNION ALL SELECT 2, w1, w2, NULL, round(log_prob, 6) + CAST(0 AS DOUBLE), round(backoff, 5) + CAST(0 AS DOUBLE) FROM m2 UNION ALL SELECT 3, w1, w2, w3, round(log_prob, 6) + CAST(0 AS DOUBLE), NULL FROM m3"),
    "backoff_scoring": (backoff_scoring, f"WITH {_MODEL}, c AS (SELECT id, ['<s>'] || s AS s FROM ({_marked('conversations', 'conv_id || chr(45) || turn')})), x AS (SELECT id, unnest(list_transform(range(1, len(s) - 1), lambda i: [s[i], s[i + 1], s[i + 2]])) AS r FROM c) SELECT id, count(*) AS n, round(sum(coalesce(m3.log_prob, coalesce(k2.backoff, 0) + coalesce(m2.log_prob, coalesce(k1.backoff, 0) + coalesce(m1.log_prob, -7)))), 4) AS log_prob FROM x LEFT JOIN m3 ON r[1] = m3.w1 AND r[2] = m3.w2 AND r[3] = m3.w3 LEFT JOIN m2 AS k2 ON r[1] = k2.w1 AND r[2] = k2.w2 LEFT JOIN m2 ON r[2] = m2.w1 AND r[3] = m2.w2 LEFT JOIN m1 AS k1 ON r[2] = k1.w1 LEFT JOIN m1 ON r[3] = m1.w1 GROUP BY 1"),
    "context_expansion": (context_expansion, "WITH b AS (SELECT o_orderpriority AS w1, o_orderstatus AS w2, log10(CAST(count(*) AS DOUBLE) / sum(count(*)) OVER (PARTITION BY o_orderpriority)) AS p FROM orders GROUP BY 1, 2), n AS (SELECT c_mktsegment AS t, log10(CAST(count(*) AS DOUBLE) / sum(count(*)) OVER ()) AS s, count(*) AS n FROM customer GROUP BY 1), k AS (SELECT * FROM b WHERE w1 = '1-URGENT' ORDER BY p DESC, w2 LIMIT 2), m AS (SELECT * FROM n ORDER BY n DESC, t LIMIT 3) SELECT w1, w2, round(p, 9) AS log_prob FROM b UNION ALL SELECT t, w2, round(p + s, 9) FROM k, m"),
    "tempered_shares": (tempered_shares, "WITH x AS (SELECT p_brand, p_type, pow(CAST(count(*) AS DOUBLE), 1 / CAST(0.7 AS DOUBLE)) AS p FROM part GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY count(*) DESC, p_type) <= 4) SELECT p_brand, p_type, round(p / sum(p) OVER (PARTITION BY p_brand), 9) AS share FROM x"),
}
