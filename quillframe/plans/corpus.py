"""Corpus statistics and language-model tables over the documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import symbol_ngrams
from ..operators import corpus, runs
from ..session import table as t


def char_freq(spark: SparkSession, d: str) -> DataFrame:
    return corpus.character_counts(t(spark, d, "documents"), "text")


def lexicon(spark: SparkSession, d: str) -> DataFrame:
    return corpus.lexicon(t(spark, d, "documents"), "text")


def char_ngrams(spark: SparkSession, d: str) -> DataFrame:
    """Letter n-grams of part names up to four long."""
    out = corpus.ngram_counts(t(spark, d, "part"), F.col("p_name"), 4, 20)
    return out.withColumn("length", F.col("length").cast("long"))


def _words(spark: SparkSession, d: str) -> DataFrame:
    return corpus.tokens(t(spark, d, "part"), "p_partkey", "p_name", "[a-z]+")


def token_context_flags(spark: SparkSession, d: str) -> DataFrame:
    flagged = corpus.context_flags(corpus.tokens(t(spark, d, "benchmark"), "item_id", "text", "[a-z]+"), "item_id", "pos", "token", ("the",), ("of",))
    return flagged.select("item_id", F.col("pos").cast("long").alias("pos"), "token", "in_context")


def _classes(spark: SparkSession, d: str):
    firsts = t(spark, d, "part").select(F.substring_index("p_name", " ", 1).alias("token")).distinct()
    lasts = t(spark, d, "part").select(F.substring_index("p_name", " ", -1).alias("token")).distinct()
    return [("first", firsts), ("last", lasts)]


def placeholder_substitution(spark: SparkSession, d: str) -> DataFrame:
    """Part names with words that begin some name as one class, words that end one as another."""
    drop = spark.createDataFrame([("the",), ("of",)], "token string")
    marked = corpus.classify(_words(spark, d), "token", _classes(spark, d), drop)
    return corpus.substituted_text(marked, "p_partkey", "pos", "token")


def placeholder_counts(spark: SparkSession, d: str) -> DataFrame:
    marked = corpus.classify(_words(spark, d), "token", list(reversed(_classes(spark, d))))
    return marked.where("class IS NOT NULL").groupBy("class").agg(F.count(F.lit(1)).alias("n"))


def markov_transitions(spark: SparkSession, d: str) -> DataFrame:
    return corpus.transitions(_words(spark, d), "p_partkey", "pos", "token", state=2)


def bigram_model(spark: SparkSession, d: str) -> DataFrame:
    return corpus.ngram_model(_words(spark, d), "p_partkey", "pos", "token").withColumn("log_prob", F.round("log_prob", 9))


def class_lm_expand(spark: SparkSession, d: str) -> DataFrame:
    """Priorities as unigrams, the urgent one spread over market segments."""
    n = t(spark, d, "orders").groupBy(F.col("o_orderpriority").alias("token")).agg(F.count(F.lit(1)).alias("n"))
    total = n.agg(F.sum("n").alias("all"))
    unigrams = n.crossJoin(F.broadcast(total)).select("token", F.log10(F.col("n") / F.col("all")).alias("log_prob"))
    names = t(spark, d, "customer").groupBy(F.col("c_mktsegment").alias("token")).agg(F.count(F.lit(1)).alias("n"))
    return corpus.expand_class(unigrams, names, "1-URGENT", top=3).withColumn("log_prob", F.round("log_prob", 9))


def cumulative_weights(spark: SparkSession, d: str) -> DataFrame:
    n = t(spark, d, "part").groupBy("p_brand", "p_type").agg(F.count(F.lit(1)).alias("n"))
    out = corpus.cumulative_shares(n, ["p_brand"], "n", [F.desc("n"), F.col("p_type")])
    return out.select("p_brand", "p_type", "n", F.round("share", 9).alias("share"), F.round("upto", 9).alias("upto"))


def nucleus_cut(spark: SparkSession, d: str) -> DataFrame:
    n = t(spark, d, "part").groupBy("p_brand", "p_type").agg(F.count(F.lit(1)).alias("n"))
    return corpus.nucleus(n, ["p_brand"], "n", [F.desc("n"), F.col("p_type")], 0.75).select("p_brand", "p_type", "n")


def weighted_sample(spark: SparkSession, d: str) -> DataFrame:
    """A part type drawn for each part, by how frequent types are in its brand."""
    n = t(spark, d, "part").groupBy("p_brand", "p_type").agg(F.count(F.lit(1)).alias("n"))
    draws = t(spark, d, "part").select("p_partkey", "p_brand")
    return corpus.weighted_draws(n, "p_brand", "n", [F.col("p_type")], draws, "p_partkey").select("p_partkey", "p_brand", "p_type")


def split_hash(spark: SparkSession, d: str) -> DataFrame:
    return corpus.split_by_hash(t(spark, d, "documents").select("doc_id"), "doc_id")


def symbol_coverage(spark: SparkSession, d: str) -> DataFrame:
    return corpus.missing_symbols(t(spark, d, "part"), "p_name", list("abcdefghijklmnopqrstuvwxyz0123456789#&"))


def replication_copies(spark: SparkSession, d: str) -> DataFrame:
    out = corpus.replication(t(spark, d, "nation"), "n_nationkey", "n_name", 60)
    return out.select("n_nationkey", F.col("copies").cast("long").alias("copies"))


def training_lines(spark: SparkSession, d: str) -> DataFrame:
    """Part names read with every e as c, where that is near enough."""
    lines = t(spark, d, "part").select("p_partkey", F.col("p_name").alias("corrected"), F.translate("p_name", "e", "c").alias("read"))
    return corpus.training_lines(lines, "read", "corrected", threshold=0.9).select("p_partkey")


def ngram_occurrences(spark: SparkSession, d: str) -> DataFrame:
    """At most three parts for each letter trigram of nation names, found by equal n-grams, not by search."""
    wanted = t(spark, d, "nation").select(F.explode(F.array_distinct(symbol_ngrams(F.lower("n_name"), 3))).alias("gram")).distinct()
    grams = t(spark, d, "part").select("p_partkey", F.explode(F.array_distinct(symbol_ngrams(F.col("p_name"), 3))).alias("gram"))
    place = F.row_number().over(Window.partitionBy("gram").orderBy("p_partkey"))
    return grams.join(wanted, "gram").withColumn("place", place).where("place <= 3").select("gram", "p_partkey")


def _symbols(spark: SparkSession, d: str) -> DataFrame:
    """Documents' symbols as a column, so that a run is a slice of it and a long text is not cut anew for each."""
    return t(spark, d, "documents").select("doc_id", F.regexp_extract_all("text", F.lit("(<[^>]*>|[^ ])"), F.lit(1)).alias("s"))


def _runs(n: int) -> Column:
    starts = F.when(F.size("s") >= n, F.sequence(F.lit(1), F.greatest(F.size("s") - n + 1, F.lit(1)))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.array_join(F.slice("s", i, n), ""))


def document_char_ngrams(spark: SparkSession, d: str) -> DataFrame:
    """Letter n-grams of all documents up to five long."""
    return runs.symbol_runs(t(spark, d, "documents"), "text", 5, 20)


def _document_words(spark: SparkSession, d: str) -> DataFrame:
    return corpus.tokens(t(spark, d, "documents"), "doc_id", "text", "[a-z]+")


def document_transitions(spark: SparkSession, d: str) -> DataFrame:
    return corpus.transitions(_document_words(spark, d), "doc_id", "pos", "token", state=2)


def document_bigrams(spark: SparkSession, d: str) -> DataFrame:
    return corpus.ngram_model(_document_words(spark, d), "doc_id", "pos", "token").withColumn("log_prob", F.round("log_prob", 9))


def _document_classes(spark: SparkSession, d: str):
    words = _document_words(spark, d)
    lasts = words.groupBy("doc_id").agg(F.max_by("token", "pos").alias("token")).select("token").distinct()
    return [("first", words.where("pos = 0").select("token").distinct()), ("last", lasts)]


def document_placeholders(spark: SparkSession, d: str) -> DataFrame:
    """Documents with words that begin some document as one class, words that end one as another."""
    drop = spark.createDataFrame([("the",), ("of",)], "token string")
    marked = corpus.classify(_document_words(spark, d), "token", _document_classes(spark, d), drop)
    return corpus.substituted_text(marked, "doc_id", "pos", "token")


def document_placeholder_counts(spark: SparkSession, d: str) -> DataFrame:
    marked = corpus.classify(_document_words(spark, d), "token", list(reversed(_document_classes(spark, d))))
    return marked.where("class IS NOT NULL").groupBy("class").agg(F.count(F.lit(1)).alias("n"))


def document_ngram_occurrences(spark: SparkSession, d: str) -> DataFrame:
    """All documents that have a letter trigram of part names, for each trigram."""
    wanted = t(spark, d, "part").select(F.explode(F.array_distinct(symbol_ngrams(F.col("p_name"), 3))).alias("gram")).distinct()
    grams = _symbols(spark, d).select("doc_id", F.explode(F.array_distinct(_runs(3))).alias("gram"))
    return grams.join(wanted, "gram").select("gram", "doc_id")


_W = "w AS (SELECT p_partkey, unnest(regexp_extract_all(lower(p_name), '[a-z]+')) AS token, generate_subscripts(regexp_extract_all(lower(p_name), '[a-z]+'), 1) - 1 AS pos FROM part)"
_D = _W.replace("p_partkey", "doc_id").replace("p_name", "text").replace("FROM part", "FROM documents") + ", f AS (SELECT DISTINCT token AS t FROM w WHERE pos = 0), l AS (SELECT DISTINCT arg_max(token, pos) AS t FROM w GROUP BY doc_id)"

CATALOGUE = {
    "char_freq": (char_freq, "WITH x AS (SELECT unnest(string_split(text, '')) AS char FROM documents) SELECT char, count(*) AS n FROM x WHERE char <> '' GROUP BY 1"),
    "lexicon": (lexicon, "WITH x AS (SELECT unnest(regexp_extract_all(lower(text), '[a-z0-9_]+')) AS word FROM documents) SELECT word, count(*) AS n FROM x WHERE regexp_matches(word, '[a-z]') GROUP BY 1"),
    "char_ngrams": (char_ngrams, "WITH p AS (SELECT replace(p_name, ' ', '') AS s FROM part), g AS (SELECT length, unnest(list_transform(range(1, greatest(length(s) - length + 2, 1)), lambda i: substr(s, i, length))) AS ngram FROM p, (SELECT unnest([1, 2, 3, 4]) AS length)) SELECT CAST(length AS BIGINT) AS length, ngram, count(*) AS n FROM g GROUP BY 1, 2 HAVING count(*) >= 20"),
    "token_context_flags": (token_context_flags, "WITH w AS (SELECT item_id, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS token, generate_subscripts(regexp_extract_all(lower(text), '[a-z]+'), 1) - 1 AS pos FROM benchmark) SELECT item_id, CAST(pos AS BIGINT) AS pos, token, coalesce(bool_or(token = 'the') OVER (PARTITION BY item_id ORDER BY pos ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING), FALSE) OR coalesce(bool_or(token = 'of') OVER (PARTITION BY item_id ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND 3 FOLLOWING), FALSE) AS in_context FROM w"),
    "placeholder_substitution": (placeholder_substitution, f"WITH {_W}, f AS (SELECT DISTINCT split_part(p_name, ' ', 1) AS t FROM part), l AS (SELECT DISTINCT split_part(p_name, ' ', -1) AS t FROM part), c AS (SELECT p_partkey, pos, token, CASE WHEN token IN ('the', 'of') THEN NULL WHEN token IN (SELECT t FROM f) THEN 'first' WHEN token IN (SELECT t FROM l) THEN 'last' END AS class FROM w) SELECT p_partkey, string_agg(coalesce('<' || class || '>', token), ' ' ORDER BY pos) AS text, count(class) AS replaced FROM c GROUP BY 1"),
    "placeholder_counts": (placeholder_counts, f"WITH {_W}, f AS (SELECT DISTINCT split_part(p_name, ' ', 1) AS t FROM part), l AS (SELECT DISTINCT split_part(p_name, ' ', -1) AS t FROM part), c AS (SELECT CASE WHEN token IN (SELECT t FROM l) THEN 'last' WHEN token IN (SELECT t FROM f) THEN 'first' END AS class FROM w) SELECT class, count(*) AS n FROM c WHERE class IS NOT NULL GROUP BY 1"),
    "markov_transitions": (markov_transitions, f"WITH {_W}, e AS (SELECT p_partkey, pos, token FROM w UNION ALL SELECT p_partkey, max(pos) + 1, '</s>' FROM w GROUP BY 1), s AS (SELECT token, coalesce(lag(token, 2) OVER o, '<s>') || ' ' || coalesce(lag(token, 1) OVER o, '<s>') AS state FROM e WINDOW o AS (PARTITION BY p_partkey ORDER BY pos)) SELECT state, token AS next, count(*) AS n FROM s GROUP BY 1, 2"),
    "bigram_model": (bigram_model, f"WITH {_W}, p AS (SELECT token AS first, lead(token) OVER (PARTITION BY p_partkey ORDER BY pos) AS second FROM w), c AS (SELECT first, second, count(*) AS n FROM p WHERE second IS NOT NULL GROUP BY 1, 2) SELECT first, second, n, round(log10(CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY first)), 9) AS log_prob FROM c"),
    "class_lm_expand": (class_lm_expand, "WITH o AS (SELECT o_orderpriority AS token, log10(CAST(count(*) AS DOUBLE) / sum(count(*)) OVER ()) AS p FROM orders GROUP BY 1), c AS (SELECT c_mktsegment AS token, log10(CAST(count(*) AS DOUBLE) / sum(count(*)) OVER ()) AS s FROM customer GROUP BY 1) SELECT token, round(p, 9) AS log_prob FROM o WHERE token <> '1-URGENT' UNION ALL SELECT o.token, round(o.p + log10(1 - (SELECT sum(n) FROM (SELECT count(*) AS n FROM customer GROUP BY c_mktsegment ORDER BY n DESC, c_mktsegment LIMIT 3)) / (SELECT CAST(count(*) AS DOUBLE) FROM customer)), 9) FROM o WHERE o.token = '1-URGENT' UNION ALL SELECT c.token, round(o.p + c.s, 9) FROM c, o WHERE o.token = '1-URGENT' AND c.token NOT IN (SELECT token FROM o)"),
    "cumulative_weights": (cumulative_weights, "WITH x AS (SELECT p_brand, p_type, count(*) AS n FROM part GROUP BY 1, 2) SELECT p_brand, p_type, n, round(CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY p_brand), 9) AS share, round(CAST(sum(n) OVER (PARTITION BY p_brand ORDER BY n DESC, p_type ROWS UNBOUNDED PRECEDING) AS DOUBLE) / sum(n) OVER (PARTITION BY p_brand), 9) AS upto FROM x"),
    "nucleus_cut": (nucleus_cut, "WITH x AS (SELECT p_brand, p_type, count(*) AS n FROM part GROUP BY 1, 2), y AS (SELECT *, sum(n) OVER (PARTITION BY p_brand ORDER BY n DESC, p_type ROWS UNBOUNDED PRECEDING) AS upto, sum(n) OVER (PARTITION BY p_brand) AS total FROM x) SELECT p_brand, p_type, n FROM y WHERE CAST(upto AS DOUBLE) / total - CAST(n AS DOUBLE) / total < CAST(0.75 AS DOUBLE)"),
    "weighted_sample": (weighted_sample, "WITH n AS (SELECT p_brand, p_type, count(*) AS n FROM part GROUP BY 1, 2), c AS (SELECT *, sum(n) OVER (PARTITION BY p_brand ORDER BY p_type ROWS UNBOUNDED PRECEDING) AS upto, sum(n) OVER (PARTITION BY p_brand) AS total FROM n), u AS (SELECT p_partkey, p_brand, CAST(('0x' || substr(md5(p_partkey || ':7'), 1, 15)) AS BIGINT) AS u FROM part) SELECT p_partkey, u.p_brand, p_type FROM u JOIN c ON u.p_brand = c.p_brand AND u.u % CAST(total AS BIGINT) < upto AND u.u % CAST(total AS BIGINT) >= upto - n"),
    "split_hash": (split_hash, "WITH x AS (SELECT doc_id, CAST(('0x' || substr(md5(doc_id || ':42'), 1, 8)) AS BIGINT) / CAST(4294967296 AS DOUBLE) AS u FROM documents) SELECT doc_id, CASE WHEN u < CAST(0.8 AS DOUBLE) THEN 'train' WHEN u < CAST(0.9 AS DOUBLE) THEN 'val' ELSE 'test' END AS split FROM x"),
    "symbol_coverage": (symbol_coverage, "SELECT s AS symbol FROM (SELECT unnest(string_split('abcdefghijklmnopqrstuvwxyz0123456789#&', '')) AS s) WHERE s NOT IN (SELECT unnest(string_split(p_name, '')) FROM part)"),
    "replication_copies": (replication_copies, "WITH s AS (SELECT n_nationkey, unnest(string_split(n_name, '')) AS c FROM nation), t AS (SELECT c, CAST(ceil(60.0 / count(*)) AS BIGINT) AS k FROM s GROUP BY 1) SELECT n_nationkey, max(k) AS copies FROM s JOIN t USING (c) GROUP BY 1"),
    "training_lines": (training_lines, "SELECT p_partkey FROM part WHERE length(p_name) >= 4 AND regexp_matches(p_name, '^[ &''\\-;A-Za-z]*$') AND 1 - levenshtein(replace(p_name, 'e', 'c'), p_name) / CAST(length(p_name) AS DOUBLE) >= CAST(0.9 AS DOUBLE)"),
    "ngram_occurrences": (ngram_occurrences, "WITH a AS (SELECT replace(lower(n_name), ' ', '') AS s FROM nation), w AS (SELECT DISTINCT unnest(list_transform(range(1, greatest(length(s) - 1, 1)), lambda i: substr(s, i, 3))) AS gram FROM a), b AS (SELECT p_partkey, replace(p_name, ' ', '') AS s FROM part), g AS (SELECT DISTINCT p_partkey, unnest(list_transform(range(1, greatest(length(s) - 1, 1)), lambda i: substr(s, i, 3))) AS gram FROM b) SELECT gram, p_partkey FROM g JOIN w USING (gram) QUALIFY row_number() OVER (PARTITION BY gram ORDER BY p_partkey) <= 3"),
    "document_char_ngrams": (document_char_ngrams, None),
    "document_transitions": (document_transitions, f"WITH {_D}, e AS (SELECT doc_id, pos, token FROM w UNION ALL SELECT doc_id, max(pos) + 1, '</s>' FROM w GROUP BY 1), s AS (SELECT token, coalesce(lag(token, 2) OVER o, '<s>') || ' ' || coalesce(lag(token, 1) OVER o, '<s>') AS state FROM e WINDOW o AS (PARTITION BY doc_id ORDER BY pos)) SELECT state, token AS next, count(*) AS n FROM s GROUP BY 1, 2"),
    "document_bigrams": (document_bigrams, f"WITH {_D}, p AS (SELECT token AS first, lead(token) OVER (PARTITION BY doc_id ORDER BY pos) AS second FROM w), c AS (SELECT first, second, count(*) AS n FROM p WHERE second IS NOT NULL GROUP BY 1, 2) SELECT first, second, n, round(log10(CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY first)), 9) AS log_prob FROM c"),
    "document_placeholders": (document_placeholders, f"WITH {_D}, c AS (SELECT doc_id, pos, token, CASE WHEN token IN ('the', 'of') THEN NULL WHEN token IN (SELECT t FROM f) THEN 'first' WHEN token IN (SELECT t FROM l) THEN 'last' END AS class FROM w) SELECT doc_id, string_agg(coalesce('<' || class || '>', token), ' ' ORDER BY pos) AS text, count(class) AS replaced FROM c GROUP BY 1"),
    "document_placeholder_counts": (document_placeholder_counts, f"WITH {_D}, c AS (SELECT CASE WHEN token IN (SELECT t FROM l) THEN 'last' WHEN token IN (SELECT t FROM f) THEN 'first' END AS class FROM w) SELECT class, count(*) AS n FROM c WHERE class IS NOT NULL GROUP BY 1"),
    "document_ngram_occurrences": (document_ngram_occurrences, None),
}
