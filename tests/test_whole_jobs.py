"""Queries and operators take all of their input: tests of work that was once left out."""

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillframe import plans
from quillframe.llm import licences
from quillframe.functions.text import last_word, levenshtein_similarity, phonetic_code, squeezed
from quillframe.operators import linkage, nearest


@pytest.mark.parametrize("name", ["case_match_blocked", "assign_hungarian", "assign_greedy"])
def test_linkage_takes_every_customer(spark, sf, name):
    got = sorted(r.c_custkey for r in plans.queries()[name](spark, sf).select("c_custkey").collect())
    assert got == sorted(r.c_custkey for r in spark.read.parquet(f"{sf}/customer.parquet").collect())


def test_best_in_block_with_a_bound_equals_all_pairs(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abrstj") for _ in range(rng.randint(1, 8)))
    rows = [(i, i % 3, rng.choice(["", f"{word()} {word()}", f"{word()} de  {word()}"])) for i in range(90)]
    sounds = lambda df, name, p: df.withColumns({
        f"{p}_code": phonetic_code(last_word(F.col(name))), f"{p}_surname": squeezed(last_word(F.col(name))), f"{p}_whole": squeezed(F.col(name))})
    a = sounds(spark.createDataFrame(rows[:45], "i long, block long, name string"), "name", "a")
    b = sounds(spark.createDataFrame(rows[45:], "j long, block long, other string"), "other", "b")
    whole = levenshtein_similarity(F.col("name"), F.col("other"))
    score = linkage.party_score(linkage.name_similarity(F.col("name"), F.col("other")), whole)
    bound = linkage.party_score(linkage.name_bound(*(F.col(f"{s}_{p}") for p in ("code", "surname", "whole") for s in "ab")), whole)
    assert a.join(b, "block").where(bound < score - 1e-9).count() == 0
    found = [{(r.i, r.j, r.score) for r in linkage.best_in_block(a, b, "block", "i", "j", score, 0.3, x).collect()} for x in (None, bound)]
    assert found[0] == found[1] and len(found[0]) > 30


def test_cosine_search_takes_every_twentieth_vector_against_all(spark, sf):
    got = plans.queries()["cosine_topk_all"](spark, sf).collect()
    e = spark.read.parquet(f"{sf}/embeddings.parquet").toPandas()
    label, v = dict(zip(e.vec_id, e.label)), np.stack(e.embedding).astype(float)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    want = {}
    for q in [i for i, k in enumerate(e.vec_id) if k % 20 == 0]:
        scores = sorted((-round(float(v[q] @ v[j]), 6), int(e.vec_id[j])) for j in range(len(v)) if j != q)[:3]
        want[int(e.vec_id[q])] = [k for _, k in scores]
    assert {q: [r.vec_id for r in sorted(got, key=lambda r: r.place) if r.query == q] for q in want} == want
    assert len(got) == 3 * len(want) and any(label[r.query] != label[r.vec_id] for r in got)


def test_licence_headers_and_files_are_compared_whole(spark):
    full = lambda name: licences._full(name)
    body = "\n".join(f"value{i} = compute{i}(alpha, beta)" for i in range(40))
    comment = lambda text: "\n".join(f"# {x}".rstrip() for x in text.split("\n"))
    gpl = "This program is free software; you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\nthe Free Software Foundation; either version 2 of the License, or\n(at your option) any later version.\n\nThis program is distributed in the hope that it will be useful,\nbut WITHOUT ANY WARRANTY; without even the implied warranty of\nMERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the\nGNU General Public License for more details."
    bsd = "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met:"
    rows = [
        (1, "MIT License\n\nCopyright (c) 2020 Ann Other\n\n" + full("MIT"), "m/LICENSE"), (2, body, "m/src/x"),
        (3, comment(gpl) + "\n\n" + body, "g/x"), (4, body, "g/y"), (5, comment(bsd) + "\n\n" + body, "b/x"),
        (6, full("GPL-3.0"), "p/COPYING"), (7, body, "p/q/x"), (8, "GNU LESSER GENERAL PUBLIC LICENSE\n\n" + body, "l/x"), (9, full("Apache-2.0").replace("\n", "\r\n"), "a/LICENSE"), (10, body, "a/x"),
    ]
    got = {r.id: (r.licence, r.origin) for r in licences.scan(spark.createDataFrame(rows, "id long, text string, path string"), "id", "text", F.col("path")).collect()}
    assert got == {
        1: ("MIT", "own"), 2: ("MIT", "inherited"), 3: ("GPL-2.0", "own"), 4: (None, "none"), 5: ("BSD-3-Clause", "own"),
        6: ("GPL-3.0", "own"), 7: ("GPL-3.0", "inherited"), 8: ("LGPL-3.0", "own"), 9: ("Apache-2.0", "own"), 10: ("Apache-2.0", "inherited"),
    }


def _texts(rng, rows, letters="abé"):
    return [(i, i % 2, "".join(rng.choice(letters) for _ in range(rng.randint(0, 6)))) for i in range(rows)]


def test_assignments_by_text_equal_those_of_all_pairs(spark):
    rng = random.Random(5)
    a = spark.createDataFrame(_texts(rng, 70) + [(900, 1, None), (901, None, "ab")], "i long, block long, name string")
    b = spark.createDataFrame(_texts(rng, 50) + [(900, 0, None)], "j long, block long, other string")
    pairs = a.join(b, "block").withColumn("score", levenshtein_similarity(F.col("name"), F.col("other"))).where("name is not null and other is not null")
    for least, fast, slow, strict in ((0.6, nearest.hungarian, linkage.hungarian, False), (0.5, nearest.greedy, linkage.greedy, True)):
        got = nearest.assign_texts(a, b, "block", "i", "j", "name", "other", least, fast, strict)
        want = linkage.assign(pairs, "block", "i", "j", "score", least, slow, strict)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() > 10


def test_best_by_text_equals_all_pairs(spark):
    rng = random.Random(6)
    a = spark.createDataFrame(_texts(rng, 70), "i long, block long, name string")
    b = spark.createDataFrame(_texts(rng, 50), "j long, block long, other string")
    score = linkage.party_score(linkage.name_similarity(F.col("name"), F.col("other")), levenshtein_similarity(F.col("name"), F.col("other")))
    got = linkage.best_by_text(a, b, "block", "i", "j", "name", "other", score, 0.3, linkage.PARTY_WHOLE)
    want = linkage.best_in_block(a, b, "block", "i", "j", score, 0.3)
    assert {(r.i, r.j, r.score) for r in got.collect()} == {(r.i, r.j, r.score) for r in want.collect()} and got.count() > 30


@pytest.mark.parametrize("name", ["case_match_blocked", "assign_hungarian", "assign_greedy"])
def test_linkage_compares_far_fewer_than_all_pairs(spark, tmp_path, name):
    """3,000 customers of one nation, whose nine million pairs took minutes."""
    names = spark.range(3000).select(F.col("id").alias("c_custkey"), F.lit(1).alias("c_nationkey"), F.element_at(F.array(*map(F.lit, ("BUILDING", "HOUSEHOLD"))), (F.col("id") % 2 + 1).cast("int")).alias("c_mktsegment"))
    names.write.parquet(f"{tmp_path}/customer.parquet")
    start = time.time()
    got = plans.queries()[name](spark, str(tmp_path)).collect()
    assert len(got) == 3000 and all(r.c_custkey == r.other for r in got) and time.time() - start < 30
