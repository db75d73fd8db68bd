"""The corpus and dictionary queries over the documents' text."""

from collections import Counter, defaultdict
import re

from quillframe import plans


def test_nearest_terms_come_from_the_documents_and_fifty_are_kept(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").toPandas().text
    n = Counter(w for text in docs for w in re.findall("[a-z]+", text.lower()))
    got = defaultdict(dict)
    for r in plans.queries()["document_nearest_terms"](spark, sf).collect():
        got[r.word][r.place] = r.term
    assert max(map(len, got.values())) > 2 and all(t in n for p in got.values() for t in p.values())

    def edits(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            above, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                above, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, above + (x != y))
        return row[-1]

    longest = max(got, key=lambda w: (len(got[w]), w))
    for word in sorted(got)[:: len(got) // 3][:3] + [longest]:
        limit = 0 if len(word) <= 3 else 1 if len(word) <= 5 else 2
        near = sorted((edits(word, t), -k, t) for t, k in n.items() if abs(len(t) - len(word)) <= limit)
        assert [got[word][p] for p in sorted(got[word])] == [t for e, _, t in near if e <= limit][:50]


def symbols(text):
    return re.findall("<[^>]*>|[^ ]", text)


def test_searched_trigrams_occur_and_are_not_cut_at_three(spark, sf):
    got = {(r.gram, r.doc_id) for r in plans.queries()["document_ngram_occurrences"](spark, sf).collect()}
    runs = lambda text: {"".join(s[i:i + 3]) for s in [symbols(text)] for i in range(len(s) - 2)}
    wanted = {g for name in spark.read.parquet(f"{sf}/part.parquet").toPandas().p_name for g in runs(name)}
    docs = spark.read.parquet(f"{sf}/documents.parquet").toPandas()
    assert got == {(g, k) for k, text in zip(docs.doc_id, docs.text) for g in runs(text) & wanted}
    assert max(Counter(g for g, _ in got).values()) > 3


def test_letter_ngrams_of_documents_up_to_five(spark, sf):
    got = {(r.length, r.ngram): r.n for r in plans.queries()["document_char_ngrams"](spark, sf).collect()}
    want = Counter()
    for text in spark.read.parquet(f"{sf}/documents.parquet").toPandas().text:
        s = symbols(text)
        for n in range(1, 6):
            want.update((n, "".join(s[i:i + n])) for i in range(len(s) - n + 1))
    assert got == {k: n for k, n in want.items() if n >= 20}


def test_letter_runs_of_many_symbols_and_tags(spark):
    """As many symbols as no packed key holds, tags, and ends that are none."""
    from quillframe.operators import runs

    many = "".join(chr(0x4E00 + i) for i in range(9000))
    for texts in ([many, many[::-1] + "a", "x"], ["a <b c> d<>e < f", "ab<b c>\nab> <", "", None, "\U0001F600 a a a a a a"]):
        want = Counter()
        for s in map(symbols, filter(None, texts)):
            want.update((n, "".join(s[i:i + n])) for n in range(1, 6) for i in range(len(s) - n + 1))
        got = runs.symbol_runs(spark.createDataFrame([(x,) for x in texts], "text string"), "text", 5, 1)
        assert {(r.length, r.ngram): r.n for r in got.collect()} == want


def test_letter_runs_are_counted_before_they_are_shuffled(spark, sf):
    plan = plans.queries()["document_char_ngrams"](spark, sf)._jdf.queryExecution().analyzed().toString()
    assert "MapInArrow" in plan and "Generate" not in plan
