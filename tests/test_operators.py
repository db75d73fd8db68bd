"""Operators on small hand-made tables."""

import itertools
import random

import numpy as np
from pyspark.sql import functions as F

from quillframe.functions.similarity import palaeographic_distance, weighted_distance
from quillframe.operators import corpus, documents, ingest, linkage, lookup, resolve, stats
from quillframe.sources import readers, writers


def test_search_counts_keeps_entities_without_links(spark):
    e = spark.createDataFrame([(1, "Ab"), (2, "xb"), (3, "c")], "id long, name string")
    links = spark.createDataFrame([(1,), (1,), (None,)], "e long")
    assert [tuple(r) for r in lookup.search_counts(e, links, "id", "e", "name", "%B%", 10).collect()] == [(1, "Ab", 2), (2, "xb", 0)]


def test_fallback_is_tried_only_where_nothing_was_found(spark):
    req = spark.createDataFrame([("277d",), ("4",), ("9x",)], "request string")
    store = spark.createDataFrame([("277", "a"), ("4", "b")], "code string, v string")
    assert sorted(tuple(r) for r in lookup.with_fallback(req, "request", store, "code").collect()) == [("277d", "277", "a"), ("4", "4", "b")]


def test_nested_lists_are_empty_not_null(spark):
    p = spark.createDataFrame([(1,), (2,)], "k long")
    c = spark.createDataFrame([(1, 2, "b"), (1, 1, "a")], "k long, o int, v string")
    got = documents.attach_list(p, c, "k", "k", {"o": F.col("o"), "v": F.col("v")}, "o", "all").orderBy("k").collect()
    assert [[x["v"] for x in r["all"]] for r in got] == [["a", "b"], []]
    doc = p.select(documents.to_document(F.struct("k", F.lit(None).cast("string").alias("n"))).alias("d")).first()[0]
    assert doc == '{"k":1,"n":null}'


def test_agents_of_other_layouts(spark):
    df = spark.sql("""SELECT 1 AS id, array(named_struct('AgentName', 'A', 'AgentRole', 'PLAINTIFF')) AS TblAgents, CAST(NULL AS array<struct<name: string>>) AS entities
        UNION ALL SELECT 2, NULL, array(named_struct('name', 'B')) UNION ALL SELECT 3, NULL, NULL""")
    layouts = [("TblAgents", {"name": "AgentName", "role": "AgentRole"}), ("entities", {"name": "name"}), ("missing", {"name": "x"})]
    got = documents.canonical_agents(df, "id", layouts, {"plaintiff": "Plaintiff"}).orderBy("id").collect()
    assert [[tuple(a) for a in r.agents] for r in got] == [[("A", "Plaintiff", None)], [("B", None, None)], []]


def test_insert_new_and_counts(spark):
    stored = spark.createDataFrame([("a",)], "k string")
    batch = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3)], "k string, id long")
    assert [tuple(r) for r in ingest.insert_new(stored, batch, ["k"], [F.col("id")]).collect()] == [("b", 2)]
    assert tuple(ingest.ingest_counts(stored, batch, "id", "k").first()) == (1, 2)
    assert tuple(ingest.ingest_counts(stored, batch.limit(0), "id", "k").first()) == (0, 0)


def test_delete_join_equals_all_pairs(spark):
    from quillframe.functions.text import edit_limit

    rng = random.Random(1)
    words = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(1, 8))) for _ in range(120)})
    v = spark.createDataFrame([(w,) for w in words], "term string")
    q = spark.createDataFrame([(w,) for w in words[::3]], "word string")
    got = {(r.word, r.term) for r in resolve.edit_candidates(q, "word", resolve.delete_keys(v, "term"), "term").collect()}
    want = {(r.word, r.term) for r in q.crossJoin(v).where(F.levenshtein("word", "term") <= edit_limit(F.col("word"))).collect()}
    assert got == want


def test_selection(spark):
    c = spark.createDataFrame([("e", "john", 90, 1), ("e", "jon", 0, 0)], "entity string, term string, n long, distance int")
    rows = resolve.select_best(c, "entity", "term", "n", original=F.col("term") == "jon", total=100, kinds=10).orderBy("rank").collect()
    assert abs(sum(r.probability for r in rows) - 1) < 1e-12 and rows[0].term == "john"
    assert resolve.low_confidence(resolve.select_best(c, "entity", "term", "n", total=100, kinds=10), "entity", "term", 1.0).first().others == ["jon"]


def test_hungarian_is_optimal():
    rng = np.random.default_rng(0)
    for _ in range(100):
        s = rng.random((rng.integers(1, 5), rng.integers(1, 5)))
        n, m = s.shape
        k = min(n, m)
        best = max(sum(s[i, j] for i, j in zip(r, c)) for r in itertools.combinations(range(n), k) for c in itertools.permutations(range(m), k))
        assert abs(best - sum(s[p] for p in linkage.hungarian(s))) < 1e-9
    assert linkage.greedy(np.array([[0.9, 0.8], [0.9, 0.1]])) == [(0, 0), (1, 1)]
    assert linkage.hungarian(np.array([[0.9, 0.8], [0.9, 0.1]])) == [(0, 1), (1, 0)]


def test_field_rules(spark):
    cases = [
        ("Agent Name", "John de Smith", "Jon Smyth", "soundex", True), ("Event Date", "1400-01-02 (x)", "1400-01-02", "date_normalization", True),
        ("Event Place", "London, England", "london", "special_rule", True), ("Case Type", "unjust detention", "detinue", "special_rule", True),
        ("Agent Status", "", "knight", "special_rule", True), ("Agent Location", "London", "", "special_rule", True),
        ("Damages Claimed", "£40", "40l", "exact_match", True), ("Other", None, "", "both_empty", True), ("Other", "x", None, "one_empty", False),
        ("Other", "abc", "abd", "ratio", False),
    ]
    df = spark.createDataFrame([c[:3] for c in cases], "field string, a string, b string")
    got = linkage.compare_fields(df, "a", "b", "field").collect()
    assert [(r.basis, r.is_match) for r in got] == [c[3:] for c in cases]


def test_confusion_counts_misses(spark):
    df = spark.createDataFrame([("abc", "axc"), ("ab", "a"), (None, "z")], "t string, r string")
    got = {(r.truth_char, r.read_char): r.n for r in stats.confusion(df, "t", "r").collect()}
    assert got == {("a", "a"): 2, ("b", "x"): 1, ("c", "c"): 1, ("b", "[MISS]"): 1}
    assert [tuple(r) for r in stats.confusion_profile(stats.confusion(df, "t", "r"), 2).collect()] == [("b", 2, 0.0)]


def test_weighted_draws_follow_weights(spark):
    table = spark.createDataFrame([("g", "a", 9), ("g", "b", 1)], "g string, v string, w long")
    draws = spark.range(2000).select(F.col("id"), F.lit("g").alias("g"))
    got = {r.v: r["count"] for r in corpus.weighted_draws(table, "g", "w", [F.col("v")], draws, "id").groupBy("v").count().collect()}
    assert sum(got.values()) == 2000 and 140 < got["b"] < 260


def test_split_is_stable_under_additions(spark):
    few = {r.id: r.split for r in corpus.split_by_hash(spark.range(50), "id").collect()}
    many = {r.id: r.split for r in corpus.split_by_hash(spark.range(500), "id").collect()}
    assert all(many[k] == v for k, v in few.items()) and set(many.values()) == {"train", "val", "test"}


def test_palaeographic_udf_equals_function(spark):
    df = spark.createDataFrame([("in", "m"), ("", None), ("Willelmus", "Willelmvs")], "a string, b string")
    assert [r[0] for r in df.select(palaeographic_distance(F.col("a"), F.col("b"))).collect()] == [weighted_distance("in", "m"), 0.0, weighted_distance("Willelmus", "Willelmvs")]


def test_line_files(spark, tmp_path):
    (tmp_path / "a.txt").write_text("train/x.png a b <space> c\ntrain/x_aug_1.png z\nbroken\n")
    assert [tuple(r) for r in readers.text_lines(spark, f"{tmp_path}/a.txt").collect()] == [("train/x.png", "a b <space> c")]
    (tmp_path / "h.txt").write_text("p/u.png ['0.93', '0.87'] c h <space> t\np/v.png a b\n")
    got = readers.recogniser_lines(spark, f"{tmp_path}/h.txt").collect()
    assert [(r.image, r.confidences, r.text) for r in got] == [("p/u.png", [0.93, 0.87], "ch t"), ("p/v.png", [], "ab")]
    words = spark.createDataFrame([("a b c", [0.5])], "t string, c array<double>").select(readers.word_confidences(F.col("t"), F.col("c"))).first()[0]
    assert [tuple(w) for w in words] == [("a", 0.5), ("b", None), ("c", None)]


def test_arpa_round_trip(spark, tmp_path):
    text = "\\data\\\nngram 1=3\nngram 2=1\n\n\\1-grams:\n-1.5\t<s>\t-0.3\n-0.5\ta\n-2\t</s>\n\n\\2-grams:\n-0.25\t<s> a\n\n\\end\\\n"
    (tmp_path / "m.arpa").write_text(text)
    m = readers.arpa(spark, f"{tmp_path}/m.arpa")
    got = sorted((r.order, tuple(r.words), r.log_prob, r.backoff) for r in m.collect())
    assert got == [(1, ("</s>",), -2.0, None), (1, ("<s>",), -1.5, -0.3), (1, ("a",), -0.5, None), (2, ("<s>", "a"), -0.25, None)]
    writers.arpa(m, f"{tmp_path}/out")
    again = readers.arpa(spark, f"{tmp_path}/out")
    assert sorted((r.order, tuple(r.words), r.log_prob, r.backoff) for r in again.collect()) == got


def test_json_documents(spark, tmp_path):
    for k in ("a", "b"):
        (tmp_path / k).mkdir()
        (tmp_path / k / "master_record.json").write_text('{\n "id": "%s"\n}' % k)
        (tmp_path / k / "other.json").write_text('{"id": "no"}')
    assert sorted(r.id for r in readers.json_documents(spark, str(tmp_path), "master_record.json", "id string").collect()) == ["a", "b"]


def test_streams_go_on_where_they_ended(spark, tmp_path):
    from quillframe.streaming import events

    src = tmp_path / "events.parquet"
    part = lambda lo, hi: spark.range(lo, hi).select(F.concat(F.lit("t"), F.col("id") % 2).alias("event_type"), F.timestamp_seconds(F.col("id") * 60).alias("ts"), F.col("id").alias("user_id"))
    part(0, 30).write.parquet(str(src))
    seen = []
    run = lambda: events.into(events.first_seen(events.source(spark, str(tmp_path)), ["event_type", "user_id"]), lambda df, i: seen.append(df.count()), f"{tmp_path}/cp")
    run()
    part(20, 40).write.mode("append").parquet(str(src))
    run()
    assert sum(seen) == 40
    s = events.drained(events.sessions(events.source(spark, str(tmp_path)), "30 seconds", "1 day"), "sessions", mode="complete")
    assert s.agg(F.sum("n")).first()[0] == 50
