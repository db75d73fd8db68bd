"""Backoff models, generation and corrections on small tables."""

import math

import pytest
from pyspark.sql import functions as F

from quillframe.operators import language_model as lm
from quillframe.operators import lines, resolve
from quillframe.sources.writers import _number


@pytest.fixture(scope="module")
def model(spark):
    texts = spark.createDataFrame([(1, "a b a b c"), (2, "a c"), (3, None)], "id long, text string").select("id", lm.marked(F.col("text")).alias("s"))
    return texts, lm.backoff_model(texts, "s").cache()


def test_probabilities_after_a_context_sum_to_one(model):
    rows = model[1].collect()
    one = {r.w1: r for r in rows if r.order == 1}
    two = {(r.w1, r.w2): r for r in rows if r.order == 2}
    vocabulary = [w for w in one if w != "<s>"]
    assert sum(10 ** one[w].log_prob for w in vocabulary) == pytest.approx(1)
    p2 = lambda u, v: two[u, v].log_prob if (u, v) in two else one[u].backoff + one[v].log_prob
    for u in ("a", "b", "<s>"):
        assert sum(10 ** p2(u, v) for v in vocabulary) == pytest.approx(1)
    three = {(r.w1, r.w2, r.w3): r.log_prob for r in rows if r.order == 3}
    assert sum(10 ** three.get(("a", "b", w), two["a", "b"].backoff + p2("b", w)) for w in vocabulary) == pytest.approx(1)


def test_scores_fall_back(spark, model):
    _, table = model
    asked = spark.createDataFrame([(1, "a c"), (2, "c c"), (3, "zz"), (4, "")], "id long, text string").select("id", lm.marked(F.col("text")).alias("s"))
    got = {r.id: r for r in lm.backoff_scores(asked, "id", "s", table, unknown=-5.0).collect()}
    assert got[1].n == 3 and got[1].log_prob > got[2].log_prob > -99 and got[3].log_prob < -5 and got[4].n == 1
    assert all(math.isfinite(r.log_prob) for r in got.values())


def test_generation_follows_transitions(spark):
    steps = spark.createDataFrame([("<s> <s>", "a", 3), ("<s> a", "b", 1), ("a b", "</s>", 1), ("a b", "c", 1), ("b c", "</s>", 1)], "state string, next string, n long")
    starts = spark.range(60).select("id", F.lit("<s> <s>").alias("state"))
    got = {r.id: r.words for r in lm.generate(steps, starts, "id", 5).collect()}
    assert set(map(tuple, got.values())) == {("a", "b"), ("a", "b", "c")}
    assert got == {r.id: r.words for r in lm.generate(steps, starts.repartition(3), "id", 5).collect()}


def test_typed_candidates_by_stem_and_letters(spark):
    forms = spark.createDataFrame([("forename", "Johannes", "John", "nom", 9), ("forename", "Johannem", "John", "acc", 5), ("forename", "Ivo", "Ives", "nom", 2), ("place", "Johannes", "x", None, 1)], "kind string, form string, english string, declension string, n long")
    asked = spark.createDataFrame([(1, "forename", "johannes", "nom"), (2, "forename", "john", None), (3, "forename", "Iohannis", "gen"), (4, "place", "Johannes", None), (5, "forename", "Johannorum", None), (6, "forename", None, None)], "entity long, kind string, text string, declension string")
    found = resolve.typed_candidates(asked, resolve.typed_dictionary(forms), endings=("is", "orum"))
    got = {(r.entity, r.term): (r.distance, r.origin, r.place) for r in found.collect()}
    assert got[1, "Johannes"] == (0, "exact", 1) and got[1, "Johannem"][1] == "edit"
    assert got[2, "Johannes"][1] == "english" and got[3, "Johannes"][:2] == (1, "edit") and got[4, "Johannes"] == (0, "exact", 1)
    assert not any(e == 6 for e, _ in got) and {t for e, t in got if e == 4} == {"Johannes"}


def test_corrections_are_placed(spark):
    asked = spark.createDataFrame([(1, "forename", "Jon", "Idem JON de Bury"), (2, "place", "bury", "Idem JON de Bury"), (3, "place", "Xyz", "nothing here")], "entity long, kind string, text string, line string")
    best = spark.createDataFrame([(1, "John"), (2, "Bury")], "entity long, term string")
    got = {r.entity: (r.start, r.end, r.original, r.corrected, r.status) for r in resolve.applied(asked, best, "line").collect()}
    assert got == {1: (5, 8, "JON", "John", "bayesian_corrected"), 2: (12, 16, "Bury", "Bury", "original"), 3: (None, None, "Xyz", "Xyz", "original")}


def test_numbers_have_seven_digits(spark):
    values = [-1.23456789, -0.5, 0.0, -10.0, -99.0, 1234567.8, 12345678.9, 0.00012345678, 0.000012345678, -2.30258509, 1e-7, 0.1 + 0.2]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "x double").select(_number(F.col("x"))).collect()]
    assert got == ["%.7g" % v for v in values]


def test_marks_and_collapsed_labels(spark):
    row = spark.range(1).select(
        lines.marked_by_confidence(F.lit(" Sure, (unsure) none low."), F.create_map(F.lit("sure"), F.lit(0.95), F.lit("unsure"), F.lit(0.7), F.lit("low"), F.lit(0.1))).alias("m"),
        lines.collapsed_labels(F.array(*map(F.lit, (0, 3, 3, 0, 3, 2, 2)))).alias("l"),
    ).first()
    assert row.m == "Sure, [(unsure)] none [[low.]]" and row.l == [3, 3, 2]


def test_models_dealt_to_many_tasks_equal_those_by_joins(spark, sf, monkeypatch):
    """Slots of few runs, so that common words have several and blobs are many."""
    from quillframe.operators import trigrams

    monkeypatch.setattr(trigrams, "SHARE", 500)
    texts = spark.read.parquet(f"{sf}/documents.parquet").limit(60).select("doc_id", lm.marked(F.col("text")).alias("s")).cache()
    asked = spark.createDataFrame([("1", "the of zzzz the"), ("2", "of the and in the"), ("3", None)], "id string, text string").select("id", lm.marked(F.col("text")).alias("s"))
    plan, _ = trigrams._plan(texts, "s")
    assert plan.slots > 5 and (plan.spread > 1).sum() > 2
    row = lambda r: (r.order, r.w1, r.w2, r.w3)
    old = lm.backoff_model(texts, "s").cache()
    want, found = {row(r): r for r in old.collect()}, trigrams.backoff_model(texts, "s").collect()
    got = {row(r): r for r in found}
    assert got.keys() == want.keys() and len(found) == len(got)
    for k, r in want.items():
        assert got[k].log_prob == pytest.approx(r.log_prob, abs=1e-9) and (got[k].backoff is None) == (r.backoff is None)
        assert r.backoff is None or got[k].backoff == pytest.approx(r.backoff, abs=1e-6)
    scored = {r.id: (r.n, r.log_prob) for r in trigrams.backoff_scores(texts, "s", asked, "id", "s").collect()}
    assert scored == {r.id: (r.n, pytest.approx(r.log_prob)) for r in lm.backoff_scores(asked, "id", "s", old).collect()}


@pytest.mark.parametrize("name", ["backoff_trigrams", "backoff_scoring"])
def test_backoff_queries_shuffle_packed_runs(spark, sf, name):
    from quillframe import plans

    plan = plans.queries()[name](spark, sf)._jdf.queryExecution().analyzed().toString()
    assert "MapInArrow" in plan and "Join" not in plan
