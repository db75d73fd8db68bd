"""Entity resolution, linkage, similarity and sources over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import similarity
from ..functions.text import levenshtein_similarity
from ..operators import corpus, linkage, lookup, nearest, resolve, stats
from ..session import table as t
from ..sources.readers import html_entries, layout_names
from ..streaming import events


def levenshtein_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of nation names by edits, a hundred pairs of fixed rows."""
    a = t(spark, d, "nation").select(F.lower("n_name").alias("a"))
    pairs = a.join(a.select(F.col("a").alias("b")), F.col("a") < F.col("b"))
    return pairs.select("a", "b", F.levenshtein("a", "b").cast("long").alias("edits"), F.round(levenshtein_similarity(F.col("a"), F.col("b")), 9).alias("similarity"))


def _vocabulary(spark: SparkSession, d: str) -> DataFrame:
    words = t(spark, d, "part").select(F.explode(F.split(F.lower("p_name"), " ")).alias("term"))
    return words.where("term <> ''").groupBy("term").agg(F.count(F.lit(1)).alias("n"))


def _lexicon(spark: SparkSession, d: str) -> DataFrame:
    """The words of all documents."""
    words = corpus.tokens(t(spark, d, "documents"), "doc_id", "text", "[a-z]+")
    return words.groupBy(F.col("token").alias("term")).agg(F.count(F.lit(1)).alias("n"))


def _misread(spark: SparkSession, d: str, vocabulary=_vocabulary) -> DataFrame:
    """Nation names' and terms' spellings with a letter changed or left out."""
    v = vocabulary(spark, d)
    changed = v.select(F.translate("term", "aeo", "eoa").alias("word"))
    shorter = v.select(F.expr("concat(left(term, 2), substring(term, 4))").alias("word"))
    return changed.unionByName(shorter).where("word <> ''").distinct()


def _candidates(spark: SparkSession, d: str, vocabulary=_vocabulary) -> DataFrame:
    return resolve.edit_candidates(_misread(spark, d, vocabulary), "word", resolve.delete_keys(vocabulary(spark, d), "term"), "term")


def delete_neighbourhood_join(spark: SparkSession, d: str) -> DataFrame:
    return _candidates(spark, d).select("word", "term", F.col("distance").cast("long").alias("distance"))


def document_delete_join(spark: SparkSession, d: str) -> DataFrame:
    """Misread words of all documents with the words within their edits."""
    return _candidates(spark, d, _lexicon).select("word", "term", F.col("distance").cast("long").alias("distance"))


def _scored(spark: SparkSession, d: str, vocabulary=_vocabulary) -> DataFrame:
    v = vocabulary(spark, d)
    sums = v.agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds")).first()
    near = resolve.nearest_terms(_candidates(spark, d, vocabulary), "word", "term", "n", 50)
    return resolve.select_best(
        near, "word", "term", "n", original=F.col("term") == F.col("word"), total=sums["total"] or 0, kinds=sums["kinds"]
    )


def _bayes(scored: DataFrame) -> DataFrame:
    rounded = [F.round(c, 9).alias(c) for c in ("log_prior", "score", "probability")]
    return scored.select("word", "term", F.col("distance").cast("long").alias("distance"), *rounded, F.col("rank").cast("long").alias("rank"))


def bayes_select(spark: SparkSession, d: str) -> DataFrame:
    """Misread words with every candidate's score and probability."""
    return _bayes(_scored(spark, d))


def document_bayes_select(spark: SparkSession, d: str) -> DataFrame:
    return _bayes(_scored(spark, d, _lexicon))


def _unsure(scored: DataFrame) -> DataFrame:
    low = resolve.low_confidence(scored, "word", "term")
    return low.select("word", "best", F.round("probability", 9).alias("probability"), F.array_join("others", ",").alias("others"))


def lowconf_topalts(spark: SparkSession, d: str) -> DataFrame:
    return _unsure(_scored(spark, d))


def document_lowconf_topalts(spark: SparkSession, d: str) -> DataFrame:
    return _unsure(_scored(spark, d, _lexicon))


def nearest_fifty(spark: SparkSession, d: str) -> DataFrame:
    """The two nearest terms; fifty are kept by document_nearest_terms."""
    near = resolve.nearest_terms(_candidates(spark, d), "word", "term", "n", 2)
    return near.select("word", "term", F.col("place").cast("long").alias("place"))


def document_nearest_terms(spark: SparkSession, d: str) -> DataFrame:
    near = resolve.nearest_terms(_candidates(spark, d, _lexicon), "word", "term", "n", 50)
    return near.select("word", "term", F.col("place").cast("long").alias("place"))


def applied_corrections(spark: SparkSession, d: str) -> DataFrame:
    """Every part's name with its first two words put right by a list of pairs."""
    pairs = F.array(F.struct(F.substring_index("p_name", " ", 1).alias("original"), F.lit("A").alias("corrected")), F.struct(F.lit(" ").alias("original"), F.lit("_").alias("corrected")))
    return t(spark, d, "part").select("p_partkey", resolve.substituted(F.col("p_name"), pairs).alias("text"))


def _parties(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    c = t(spark, d, "customer").select(
        F.col("c_nationkey").alias("county"), "c_custkey", F.concat(F.lit("John "), F.initcap("c_mktsegment"), F.lit(" "), F.col("c_custkey").cast("string")).alias("name")
    )
    return c, c.select("county", F.col("c_custkey").alias("other"), F.translate("name", "aeo", "eoa").alias("other_name"))


def case_match_blocked(spark: SparkSession, d: str) -> DataFrame:
    """Customers matched with misread copies in their nation."""
    a, b = _parties(spark, d)
    whole = levenshtein_similarity(F.col("name"), F.col("other_name"))
    score = linkage.party_score(linkage.name_similarity(F.col("name"), F.col("other_name")), whole)
    found = linkage.best_by_text(a, b, "county", "c_custkey", "other", "name", "other_name", score, 0.3, linkage.PARTY_WHOLE)
    return found.select("c_custkey", "other", F.round("score", 6).alias("score"))


def assign_hungarian(spark: SparkSession, d: str) -> DataFrame:
    return nearest.assign_texts(*_parties(spark, d), "county", "c_custkey", "other", "name", "other_name", 0.6)


def assign_greedy(spark: SparkSession, d: str) -> DataFrame:
    return nearest.assign_texts(*_parties(spark, d), "county", "c_custkey", "other", "name", "other_name", 0.5, nearest.greedy, strict=True)


def _compared(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey") % 5
    field = F.element_at(F.array(*map(F.lit, ("Agent Occupation", "Event Date", "Damages Claimed", "Case Type", "Agent Status"))), (k + 1).cast("int"))
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    truth = F.when(k == 0, "clerk and mercer").when(k == 1, F.concat(day, F.lit(" (initial)"))).when(k == 2, F.concat(F.lit("£"), F.col("o_custkey").cast("string"))).when(k == 3, "Debt account").otherwise("")
    other = F.when(k == 0, F.when(F.col("o_orderkey") % 2 == 0, "mercer").otherwise("and")).when(k == 1, day).when(k == 2, F.concat(F.col("o_custkey").cast("string"), F.lit("l"))).when(k == 3, F.when(F.col("o_orderkey") % 2 == 0, "debt").otherwise("")).otherwise("citizen")
    facts = t(spark, d, "orders").select("o_orderkey", field.alias("field"), truth.alias("truth"), other.alias("other"))
    return linkage.compare_fields(facts, "truth", "other", "field")


def _by_rule(compared: DataFrame) -> DataFrame:
    return compared.groupBy("field", "basis", "is_match").agg(F.count(F.lit(1)).alias("n"))


def field_compare_ladder(spark: SparkSession, d: str) -> DataFrame:
    """Fields of orders against copies that differ in ways the rules forgive or not, rolled up by rule; without the ratio rule, which no SQL follows."""
    return _by_rule(_compared(spark, d).where(F.col("basis") != "ratio"))


def field_compare_all(spark: SparkSession, d: str) -> DataFrame:
    """The same over all orders, with those that the ratio rule decides."""
    return _by_rule(_compared(spark, d))


def ratio_similarity(spark: SparkSession, d: str) -> DataFrame:
    p = t(spark, d, "part")
    return p.select("p_partkey", similarity.sequence_ratio(F.col("p_name"), F.translate("p_name", "aeo", "eoa")).alias("ratio"))


def palaeographic_distance(spark: SparkSession, d: str) -> DataFrame:
    p = t(spark, d, "part")
    other = F.translate("p_name", "iun", "jvu")
    return p.select(
        "p_partkey", similarity.palaeographic_distance(F.col("p_name"), other).alias("distance"), similarity.palaeographic_similarity(F.col("p_name"), other).alias("similarity")
    )


def entity_positions(spark: SparkSession, d: str) -> DataFrame:
    p = t(spark, d, "part")
    at = similarity.entity_position(F.translate(F.substring_index("p_name", " ", -1), "a", "e"), F.col("p_name"))
    return p.select("p_partkey", at.alias("at")).select("p_partkey", "at.start", "at.end")


def cosine_topk(spark: SparkSession, d: str) -> DataFrame:
    """The three nearest of a label's vectors to every vector whose id 50 divides."""
    e = t(spark, d, "embeddings").select("vec_id", "label", "embedding")
    q = e.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query"), "label", F.col("embedding").alias("q"))
    scored = q.join(e, "label").where("query <> vec_id").select("query", "vec_id", F.round(similarity.cosine(F.col("q"), F.col("embedding")), 6).alias("score"))
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
    return scored.withColumn("place", place).where("place <= 3").select("query", "vec_id", "score", F.col("place").cast("long").alias("place"))


def cosine_topk_all(spark: SparkSession, d: str) -> DataFrame:
    """The three nearest of all vectors to every vector whose id 20 divides."""
    e = t(spark, d, "embeddings").where("embedding IS NOT NULL").select("vec_id", "embedding")
    near = lookup.nearest_by_cosine(e.where("vec_id % 20 = 0"), e, "vec_id", "embedding", 3)
    return near.withColumn("place", F.col("place").cast("long"))


def confusion_matrix(spark: SparkSession, d: str) -> DataFrame:
    pairs = t(spark, d, "part").select(F.col("p_name").alias("a"), F.translate("p_name", "e", "c").alias("b"))
    return stats.confusion(pairs, "a", "b")


def confusion_profile(spark: SparkSession, d: str) -> DataFrame:
    return stats.confusion_profile(confusion_matrix(spark, d))


def html_entry_parse(spark: SparkSession, d: str) -> DataFrame:
    return html_entries(t(spark, d, "pages"), "page_id", "html")


def layout_groups(spark: SparkSession, d: str) -> DataFrame:
    """Pages' paths grouped as image groups are."""
    return layout_names(t(spark, d, "pages"), "url")


def stream_dedup_events(spark: SparkSession, d: str) -> DataFrame:
    """A stream of events by type and user, each kept once; the table when the stream has read all."""
    return events.drained(events.first_seen(events.source(spark, d), ["user_id", "event_type"]), "dedup")


def stream_threshold(spark: SparkSession, d: str) -> DataFrame:
    """How often each event type's count has passed a multiple of 100."""
    return events.drained(events.threshold_crossings(events.source(spark, d), "event_type", 100), "threshold", mode="update", key="event_type", order="crossings")


def stream_windows(spark: SparkSession, d: str) -> DataFrame:
    """Counts of events in windows of an hour, with late events allowed for; an extension."""
    out = events.drained(events.windowed(events.source(spark, d), "1 hour", "1000 days"), "windows", mode="complete")
    return out.select(F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("start"), "event_type", "n")


_V = "v AS (SELECT term, count(*) AS n FROM (SELECT unnest(string_split(lower(p_name), ' ')) AS term FROM part) WHERE term <> '' GROUP BY 1), m AS (SELECT DISTINCT word FROM (SELECT translate(term, 'aeo', 'eoa') AS word FROM v UNION ALL SELECT substr(term, 1, 2) || substr(term, 4) FROM v) WHERE word <> ''), c AS (SELECT word, term, n, levenshtein(word, term) AS distance FROM m, v WHERE levenshtein(word, term) <= CASE WHEN length(word) <= 3 THEN 0 WHEN length(word) <= 5 THEN 1 ELSE 2 END), k AS (SELECT *, row_number() OVER (PARTITION BY word ORDER BY distance, n DESC, term) AS place FROM c)"
_S = _V + ", p AS (SELECT *, ln((n + 1) / CAST((SELECT sum(n) + count(*) FROM v) AS DOUBLE)) AS log_prior FROM k WHERE place <= 50), s AS (SELECT *, log_prior - CAST(1.5 AS DOUBLE) * distance + CASE WHEN term = word THEN CAST(0.5 AS DOUBLE) ELSE 0 END AS score FROM p), x AS (SELECT *, exp(score - max(score) OVER (PARTITION BY word)) AS e FROM s), r AS (SELECT word, term, distance, log_prior, score, e / sum(e) OVER (PARTITION BY word) AS probability, row_number() OVER (PARTITION BY word ORDER BY score DESC, term) AS rank FROM x)"

CATALOGUE = {
    "levenshtein_pairs": (levenshtein_pairs, "SELECT lower(a.n_name) AS a, lower(b.n_name) AS b, levenshtein(lower(a.n_name), lower(b.n_name)) AS edits, round(1 - levenshtein(lower(a.n_name), lower(b.n_name)) / CAST(greatest(length(a.n_name), length(b.n_name)) AS DOUBLE), 9) AS similarity FROM nation a, nation b WHERE lower(a.n_name) < lower(b.n_name)"),
    "delete_neighbourhood_join": (delete_neighbourhood_join, f"WITH {_V} SELECT word, term, distance FROM c"),
    "nearest_terms": (nearest_fifty, f"WITH {_V} SELECT word, term, place FROM k WHERE place <= 2"),
    "bayes_select": (bayes_select, f"WITH {_S} SELECT word, term, distance, round(log_prior, 9) AS log_prior, round(score, 9) AS score, round(probability, 9) AS probability, rank FROM r"),
    "lowconf_topalts": (lowconf_topalts, f"WITH {_S} SELECT word, max(term) FILTER (rank = 1) AS best, round(max(probability) FILTER (rank = 1), 9) AS probability, coalesce(string_agg(term, ',' ORDER BY rank) FILTER (rank BETWEEN 2 AND 4), '') AS others FROM r GROUP BY 1 HAVING max(probability) FILTER (rank = 1) < CAST(0.9 AS DOUBLE)"),
    **{q.__name__: (q, None) for q in (document_delete_join, document_nearest_terms, document_bayes_select, document_lowconf_topalts)},
    "applied_corrections": (applied_corrections, "SELECT p_partkey, replace(replace(p_name, split_part(p_name, ' ', 1), 'A'), ' ', '_') AS text FROM part"),
    "case_match_blocked": (case_match_blocked, None),
    "assign_hungarian": (assign_hungarian, None),
    "assign_greedy": (assign_greedy, None),
    "field_compare_ladder": (field_compare_ladder, "WITH x AS (SELECT CASE o_orderkey % 5 WHEN 0 THEN 'Agent Occupation' WHEN 1 THEN 'Event Date' WHEN 2 THEN 'Damages Claimed' WHEN 3 THEN 'Case Type' ELSE 'Agent Status' END AS field, CASE o_orderkey % 5 WHEN 0 THEN CASE WHEN o_orderkey % 2 = 0 THEN 'special_rule' ELSE 'ratio' END WHEN 1 THEN 'date_normalization' WHEN 2 THEN 'exact_match' WHEN 3 THEN CASE WHEN o_orderkey % 2 = 0 THEN 'special_rule' ELSE 'one_empty' END ELSE CASE WHEN TRUE THEN 'special_rule' END END AS basis FROM orders) SELECT field, basis, basis <> 'one_empty' AS is_match, count(*) AS n FROM x WHERE basis <> 'ratio' GROUP BY 1, 2, 3"),
    "field_compare_all": (field_compare_all, None),
    "ratio_similarity": (ratio_similarity, None),
    "palaeographic_distance": (palaeographic_distance, None),
    "entity_positions": (entity_positions, None),
    "cosine_topk": (cosine_topk, "WITH e AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings), s AS (SELECT q.vec_id AS query, e.vec_id, round(list_cosine_similarity(q.v, e.v), 6) AS score FROM e q JOIN e ON q.label = e.label AND q.vec_id <> e.vec_id WHERE q.vec_id % 50 = 0) SELECT query, vec_id, score, row_number() OVER (PARTITION BY query ORDER BY score DESC, vec_id) AS place FROM s QUALIFY place <= 3"),
    "cosine_topk_all": (cosine_topk_all, "WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings WHERE embedding IS NOT NULL), s AS (SELECT q.vec_id AS query, e.vec_id, round(list_cosine_similarity(q.v, e.v), 6) AS score FROM e q JOIN e ON q.vec_id <> e.vec_id WHERE q.vec_id % 20 = 0) SELECT query, vec_id, score, row_number() OVER (PARTITION BY query ORDER BY score DESC, vec_id) AS place FROM s QUALIFY place <= 3"),
    "confusion_matrix": (confusion_matrix, "WITH c AS (SELECT unnest(string_split(p_name, '')) AS truth_char FROM part) SELECT truth_char, CASE WHEN truth_char = 'e' THEN 'c' ELSE truth_char END AS read_char, count(*) AS n FROM c GROUP BY 1, 2"),
    "confusion_profile": (confusion_profile, "WITH c AS (SELECT unnest(string_split(p_name, '')) AS truth_char FROM part) SELECT truth_char, count(*) AS total, CAST(0.0 AS DOUBLE) AS accuracy FROM c WHERE truth_char = 'e' GROUP BY 1 HAVING count(*) >= 3"),
    "html_entry_parse": (html_entry_parse, "SELECT page_id, regexp_extract(html, '<html[^>]*lang=\"([a-z]+)\"', 1) AS lang, regexp_extract(html, '(?s)<title>(.*?)</title>', 1) AS title, CAST(len(regexp_extract_all(html, '<li>')) AS BIGINT) AS items FROM pages"),
    "layout_groups": (layout_groups, "WITH x AS (SELECT regexp_extract(url, '^(.*[0-9])', 1) AS g, url FROM pages) SELECT g AS group_id, count(*) AS n, min(url) AS first_name FROM x WHERE g <> '' GROUP BY 1"),
    "stream_dedup_events": (stream_dedup_events, "SELECT DISTINCT user_id, event_type FROM events"),
    "stream_threshold": (stream_threshold, "SELECT event_type, CAST(count(*) // 100 AS BIGINT) AS crossings FROM events GROUP BY 1 HAVING count(*) >= 100"),
    "stream_windows": (stream_windows, "SELECT strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H:%M:%S') AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2"),
}
