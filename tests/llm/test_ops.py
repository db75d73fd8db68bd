"""Each operator on small tables: against brute force, and with nulls, empty and long texts, ties, repeats, no rows and clashing columns."""

import base64
import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillframe.llm import ann, html_crf, langid, licences, media, mixing, pieces, queries, simhash, toxicity, warc
from quillframe.llm.components import components

LONG = "wörd " * 30_000


def docs_table(spark, rows, more="score double, text_hash string, row string, id long"):
    extra = [None] * 4
    return spark.createDataFrame([(*r, *extra) for r in rows], f"doc_id long, text string, source string, {more}")


ODD = [(1, None, "a"), (2, "", None), (3, "  \n\t", "a"), (4, LONG, "b"), (5, "same text here now", "a"), (5, "same text here now", "a"), (None, "no id", "c"), (6, "😀 ß é", "c")]


# --- components, SimHash


def test_components_follow_chains_and_hubs(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (200, 200), (None, 3)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 140)} | {200: 200}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def brute_fingerprint(text, n=4):
    import xxhash

    words = [w for w in re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))]
    if not words:
        return 0
    grams = [" ".join(words[i:i + n]) for i in range(len(words) - n + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints(spark):
    for text in (None, "", " \n", "A b", "a B c d", "Ä b c d e", LONG[:5000], "x y z w " * 9):
        assert simhash.fingerprint(text) == brute_fingerprint(text)


def test_simhash_against_all_pairs(spark, sf):
    table = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").toPandas()
    got = queries.op9_simhash(spark, sf).toPandas().set_index("doc_id")
    prints = {i: brute_fingerprint(t) for i, t in zip(table.doc_id, table.text)}
    root = {i: i for i in prints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(prints)
    for a in ids:
        for b in ids:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= 4:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    assert {i: f"{p:016x}" for i, p in prints.items()} == got.fingerprint.to_dict()
    assert {i: find(i) for i in ids} == got.component_id.to_dict()


def test_links_lose_no_pair(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 12, dtype=np.uint64)
    values = set(base.tolist())
    for b in base.tolist():
        for _ in range(25):
            flips = rng.choice(64, rng.integers(1, 6), replace=False)
            values.add(b ^ int(sum(1 << int(f) for f in flips)))
    signed = [v - 2**64 if v >= 2**63 else v for v in values]
    found = {tuple(sorted((r.u, r.v))) for r in simhash.links(spark.createDataFrame([(v,) for v in signed], "fp long"), 4).collect()}
    want = {tuple(sorted((a, b))) for a in signed for b in signed if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 4}
    assert found == want


def test_simhash_odd_rows(spark):
    got = simhash.simhash_components(docs_table(spark, ODD)).collect()
    by = defaultdict(list)
    for r in got:
        by[r.doc_id].append((r.fp, r.component_id))
    assert by[1] == by[2] == by[3] == [(0, 1)] and by[5] == [by[5][0]] * 2 and len(got) == len(ODD)
    kept = simhash.keep_one(docs_table(spark, ODD))
    assert Counter(r.doc_id for r in kept.collect()) == Counter([1, 4, 5, 6, None])
    assert kept.columns == docs_table(spark, ODD).columns
    assert simhash.simhash_components(docs_table(spark, [])).count() == 0


# --- media


def test_media_round_trip(spark):
    got = media.media_round_trip(docs_table(spark, ODD)).collect()
    want = Counter()
    for i, text, _ in ODD:
        p = (text or "").encode()
        p += b"\xff" * (max(576, -(-len(p) // 576) * 576) - len(p))
        want[(i, len((text or "").encode()), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-32:]), len(p) + 44)] += 1
    assert Counter((r.doc_id, r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32, r.media_bytes) for r in got) == want
    features = defaultdict(set)
    for r in got:
        features[r.payload_sha256].add((r.feature, r.media_sha256))
    assert all(len(v) == 1 for v in features.values())
    assert media.media_round_trip(docs_table(spark, [])).count() == 0


def test_archives_split_by_bytes_and_retry_members(spark, tmp_path):
    at = f"file://{tmp_path}/media"
    table = spark.range(300).select(F.col("id"), F.repeat(F.col("id").cast("string"), 500).alias("t"))
    assert media.write_archives(table, at, "id", "t", archive_bytes=20_000) == 300
    whole = media.read_archives(spark, at, splitBytes=3000)
    assert whole.count() == 300 and whole.select("member", "archive").distinct().count() == 300
    assert whole.rdd.getNumPartitions() > 4
    archive = whole.first().archive
    with open(archive, "r+b") as f:
        f.seek(whole.where(F.col("archive") == archive).agg(F.min("offset")).first()[0] + 60)
        f.write(b"\x00\xff\x00\xff\x00\xff")
    rows = media.read_archives(spark, at, onError="null", retries=1)
    assert rows.where("error IS NOT NULL").count() == 1 and rows.where("media IS NOT NULL").count() == 299
    with pytest.raises(Exception, match="at "):
        media.read_archives(spark, at).count()


def test_a_member_is_read_again_alone():
    import io
    import zipfile

    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("a", b"x" * 100)
    info = zipfile.ZipFile(buffer).infolist()[0]

    class Flaky:
        opened = 0

        def open_input_file(self, name):
            self.opened += 1
            if self.opened < 3:
                raise OSError("gone")
            return io.BytesIO(buffer.getvalue())

    fs = Flaky()
    args = (info.header_offset, info.compress_size, info.compress_type, info.CRC)
    with pytest.raises(OSError):
        media.read_member(fs, "f", *args, 0)
    assert media.read_member(fs, "f", *args, 2) == b"x" * 100


# --- WARC


def test_warc_round_trip(spark):
    rows = [(3, "u", "same"), (1, None, "same"), (2, "x y", "other"), (2, "x y", "other"), (4, "u", None), (5, "u", ""), (None, "u", "alone"), (None, "u", "same"), (7, "u", LONG)]
    table = spark.createDataFrame([(*r, 0, "x") for r in rows], "page_id long, url string, html string, sha int, payload string")
    got = warc.warc_round_trip(table, file_bytes=2000).collect()
    least = {"same": 1, "other": 2, "": 4}
    want = Counter()
    for i, _, html in rows:
        p = (html or "").encode()
        first = least.get(html or "")
        revisit = first is not None and i != first
        want[(i, len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), "revisit" if revisit else "response", first if revisit else None)] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == want
    small = warc.warc_round_trip(table, min_bytes=5).where("record_type = 'revisit'").count()
    assert small == 0  # "other" is repeated by the same id only
    assert warc.warc_round_trip(table.limit(0)).count() == 0


def test_warc_ids_of_any_characters(spark):
    rows = [("a b ", "x"), (" a", "x"), ("line\r\nend: 1", "x"), ("%41", "y"), ("é😀", "y"), ("", "z")]
    got = warc.warc_round_trip(spark.createDataFrame([(i, "u", t) for i, t in rows], "page_id string, url string, html string")).collect()
    least = {t: min(i for i, u in rows if u == t) for _, t in rows}
    assert {(r.page_id, r.refers_to) for r in got} == {(i, None if least[t] == i else least[t]) for i, t in rows}
    with pytest.raises(ValueError, match="length"):
        list(warc.records(iter([b"WARC/1.1\r\nWARC-Type: response\r\n\r\nbody"])))


def test_queries_over_whole_tables(spark, sf):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    media_rows = queries.op2_media_columns(spark, sf).collect()
    assert {r.doc_id: r.n_bytes for r in media_rows} == {i: len((d.text or "").encode()) for i, d in docs.items()}
    for r in media_rows[:50]:
        payload = (docs[r.doc_id].text or "").encode()
        payload += b"\xff" * (max(576, -(-len(payload) // 576) * 576) - len(payload))
        assert (r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]))
    mixed = queries.op6_mixing(spark, sf).collect()
    assert {r.doc_id: r["size"] for r in mixed} == {i: len(re.findall(r"[^\x20\x09-\x0D]+", d.text or "")) for i, d in docs.items()}
    totals = Counter()
    for r in mixed:
        totals[docs[r.doc_id].source] += r["size"]
    want = brute_targets(totals)
    assert all(r.source_size == totals[docs[r.doc_id].source] and r.target == pytest.approx(want[docs[r.doc_id].source]) for r in mixed)
    pages = {r.page_id: (r.html or "").encode() for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    first = {}
    for i in sorted(pages):
        first.setdefault(pages[i], i)
    for r in queries.op7_warc(spark, sf).collect():
        p = pages[r.page_id]
        revisit = first[p] != r.page_id
        assert (r.payload_bytes, r.payload_digest) == (len(p), base64.b32encode(hashlib.sha1(p).digest()).decode())
        assert (r.record_type, r.refers_to) == (("revisit", first[p]) if revisit else ("response", None))


def test_inflate_and_records_refuse_what_is_cut_short():
    import io

    body = b"".join(warc.record(str(i), "u", b"p" * i * 1000, "D", None) for i in range(9))
    engine = zlib.compressobj(9, zlib.DEFLATED, 31)
    one = engine.compress(body) + engine.flush()
    for raw in (one, one + one):
        assert b"".join(warc.inflate(io.BytesIO(raw).read)) == body * (len(raw) // len(one))
    assert len(list(warc.records(iter([body[:100], body[100:]])))) == 9
    with pytest.raises(ValueError):
        list(warc.inflate(io.BytesIO(one[:-20]).read))
    with pytest.raises(ValueError):
        list(warc.records(iter([body[:-50]])))


# --- mixing


def brute_targets(totals):
    weights = (5, 2, 1)
    names = sorted((s for s in totals if s is not None), key=lambda s: s.encode()) + ([None] if None in totals else [])
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    left, out, free = 1.5 * sum(totals.values()), {}, set(names)
    while free:
        share = left / sum(w[s] for s in free)
        full = {s for s in free if 2 * totals[s] <= share * w[s]}
        if not full:
            return out | {s: share * w[s] for s in free}
        for s in full:
            out[s] = 2.0 * totals[s]
            left -= out[s]
        free -= full
    return out


def test_mixing_meets_targets(spark, sf):
    table = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "source")
    got = mixing.mix(table).toPandas().set_index("doc_id")
    docs = table.toPandas()
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t)) for i, t in zip(docs.doc_id, docs.text)}
    assert got["size"].to_dict() == size
    source = dict(zip(docs.doc_id, docs.source))
    totals = Counter()
    for i, n in size.items():
        totals[source[i]] += n
    want = brute_targets(totals)
    for i, r in got.iterrows():
        assert r.source_size == totals[source[i]] and r.target == pytest.approx(want[source[i]], rel=1e-9)
        assert r.taken <= 2 * size[i] and r.taken in (0, size[i], 2 * size[i])
    taken = got.groupby(got.index.map(source)).taken.sum()
    for s, t in want.items():
        largest = max(n for i, n in size.items() if source[i] == s)
        assert abs(taken[s] - t) <= max(0.001 * t, largest / 2)  # ten documents a source here
    again = mixing.mix(table.repartition(3)).toPandas().set_index("doc_id")
    assert again.taken.to_dict() == got.taken.to_dict()
    assert len(mixing.mixed_rows(table).collect()) == int(got.copies.sum())


def test_mixing_tilts_solve_the_dual(spark):
    rows = [(i, "w " * (1 + i % 37), f"s{i % 4}") for i in range(800)]
    got = mixing.mix(docs_table(spark, rows)).toPandas()
    by = (got.rate * got["size"]).groupby(got.doc_id % 4).sum()
    target = got.groupby(got.doc_id % 4).target.first()
    assert np.allclose(by, target, rtol=1e-6, atol=0.5)
    one = got[(got.doc_id % 4 == 2) & (got.rate < 2)]
    odds = np.log(one.rate / (2 - one.rate))
    assert np.allclose(odds / one["size"], (odds / one["size"]).iloc[0])  # exponential in size
    assert np.allclose(got.taken.groupby(got.doc_id % 4).sum(), target, rtol=0.01)


def test_mixing_odd_rows(spark):
    got = mixing.mix(docs_table(spark, ODD)).collect()
    assert len(got) == len(ODD)
    assert all(r.taken == 0 for r in got if r.doc_id in (1, 2, 3))
    assert len({(r.taken, r.target) for r in got if r.doc_id == 5}) == 1
    assert mixing.mix(docs_table(spark, [])).count() == 0
    assert mixing.mix(docs_table(spark, [(1, None, None)])).first().taken == 0
    rows = Counter({r.doc_id: 0 for r in got})
    for r in got:
        rows[r.doc_id] += r.copies
    mixed = mixing.mixed_rows(docs_table(spark, ODD))
    assert Counter(r.doc_id for r in mixed.collect()) == +rows and mixed.columns == docs_table(spark, ODD).columns
    assert mixing.mixed_rows(docs_table(spark, [])).count() == 0


def test_mixing_takes_equal_rows_alike_and_closes_gaps(spark):
    rows = [(i % 300, "w " * (1 + i % 11), f"s{i % 3}") for i in range(900)] + [(5000, "w " * 4, "s1")] * 300
    got = mixing.mix(docs_table(spark, rows)).toPandas()
    assert (got[got.doc_id == 5000].copies.nunique()) == 1
    by = got.groupby("target").taken.sum()
    assert all(abs(t - n) <= max(0.002 * t, 1200 * (t == got[got.doc_id == 5000].target.iloc[0])) for t, n in by.items())
    assert len(by) == 3


# --- language


def lang_table(spark):
    en, de, ru = "the and of that with this from which have".split(), "der und die das nicht mit für auch sich".split(), "и не что это как его она для они".split()
    rows = []
    for i in range(90):
        words, lang = ((en, "en"), (de, "de"), (ru, "ru"))[i % 3]
        rows.append((i, " ".join(words[(i * 7 + j) % 9] for j in range(20)), lang))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_language_spans_and_odd_rows(spark):
    model = langid.train(lang_table(spark))
    assert model.langs == ["de", "en", "ru"] and model.by_script["Cyrillic"] == [2]
    mixed = "the and of that with this from which have " * 3 + "der und die das nicht mit für auch sich " * 2
    rows = [(1, mixed), (2, None), (3, "12 !?"), (4, "и не что"), (5, "漢字"), (None, "the and"), (6, "the and"), (6, "the and"), (7, "the " * 50_000)]
    got = langid.detect(spark.createDataFrame([(*r, 1.0, "x") for r in rows], "doc_id long, text string, score double, lang_pred string"), model, with_spans=True).collect()
    by = {(r.doc_id, r.lang_pred): r for r in got}
    assert len(got) == len(rows)
    assert [(s.lang, mixed[s.start:s.end].split()[0]) for s in by[1, "en"].spans] == [("en", "the"), ("de", "der")]
    assert by[2, "und"].score == by[3, "und"].score == 0.0 and by[4, "ru"].score > 0.9 and (6, "en") in by and (7, "en") in by
    assert all(0 <= r.score <= 1 for r in got) and any(r.doc_id == 5 and r.lang_pred in model.langs for r in got)
    empty = langid.train(lang_table(spark).limit(0))
    assert {r.lang_pred for r in langid.detect(lang_table(spark), empty).collect()} == {"und"}
    assert langid.detect(lang_table(spark).limit(0), model).count() == 0


def test_letters_are_those_of_unicode(spark):
    model = langid.train(lang_table(spark))
    rows = [(1, "² ½ ① Ⅷ ٣ 12_34"), (2, "the²and ①"), (3, "İstanbul the and"), (4, "_the_and_")]
    got = {r.doc_id: r for r in langid.detect(spark.createDataFrame(rows, "doc_id long, text string"), model, with_spans=True).collect()}
    assert (got[1].lang_pred, got[1].score, got[1].n_spans) == ("und", 0.0, 0)
    assert got[2].lang_pred == got[4].lang_pred == "en"
    assert langid.words_of("a²b ①x_y 3ü½") == ["a", "b", "x", "y", "ü"]
    assert got[3].spans[-1].end == 16


def brute_language(model, text):
    """Language and score from the model's tables by a plain dynamic program over all words."""
    import math

    low = text.lower()
    words = re.findall("L+", "".join("L" if c.isalpha() else " " for c in low))
    at, names = 0, []
    for w in words:
        at = next(i for i in range(at, len(low)) if low[i].isalpha())
        names.append(low[at:at + len(w)])
        at += len(w)
    if not names:
        return "und", 0.0
    posts = []
    for w in names:
        edged, k = f"^{w}$", len(model.langs)
        sums = [0.0] * k
        for n in (1, 2, 3):
            for i in range(len(edged) - n + 1):
                row = model.logs[model.rows.get(edged[i:i + n], len(model.logs) - 1)]
                sums = [s + float(x) / 3 for s, x in zip(sums, row)]
        seen = {i for c in w for i in model.by_script.get(langid.script(c), ())}
        may = [not seen or i in seen for i in range(k)]
        top = max(s for s, m in zip(sums, may) if m)
        norm = math.log(sum(math.exp(s - top) for s, m in zip(sums, may) if m))
        posts.append([max(s - top - norm, langid.FLOOR) if m else langid.BARRED for s, m in zip(sums, may)])
    total, back = posts[0], []
    for row in posts[1:]:
        came = [max(range(k), key=lambda j: total[j] - langid.PENALTY * (i != j)) for i in range(k)]
        back.append(came)
        total = [total[j] - langid.PENALTY * (i != j) + row[i] for i, j in enumerate(came)]
    path = [max(range(k), key=total.__getitem__)]
    for came in reversed(back):
        path.append(came[path[-1]])
    path.reverse()
    weight = [sum(len(w) for w, p in zip(names, path) if p == i) for i in range(k)]
    best = max(range(k), key=weight.__getitem__)
    score = sum(math.exp(r[best]) * len(w) for r, w, p in zip(posts, names, path) if p == best) / sum(map(len, names))
    return model.langs[best], score


def test_language_query_against_brute_force(spark, sf):
    table = spark.read.parquet(f"{sf}/documents.parquet")
    model = langid.train(table, "text", "lang", usable=queries.fold("doc_id", 4) != 2)
    text = {r.doc_id: r.text or "" for r in table.collect()}
    for r in queries.op10_language_id(spark, sf).collect():
        lang, score = brute_language(model, text[r.doc_id])
        assert r.lang_pred == lang and r.score == pytest.approx(score, abs=1e-3)


def test_viterbi_is_the_best_path():
    import itertools

    rng = np.random.default_rng(2)
    for _ in range(60):
        s = rng.normal(0, 2, (rng.integers(1, 6), 3)).astype(np.float32)
        path = langid.viterbi(s, 1.5)
        value = lambda p: sum(s[i, k] for i, k in enumerate(p)) - 1.5 * sum(a != b for a, b in zip(p, p[1:]))
        assert value(path) == pytest.approx(max(value(p) for p in itertools.product(range(3), repeat=len(s))), abs=1e-4)


def test_language_held_out(spark):
    got = queries.op10_language_id(spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang"), "doc_id").toPandas()
    assert (got.held_out == got.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 4 == 2)).all()
    held = got[got.held_out & got.lang.notna()]
    assert (held.lang == held.lang_pred).mean() > 0.98


# --- toxicity


def test_factorization_machine_learns_what_two_terms_mean_together():
    rng = np.random.default_rng(0)
    words = [[f"w{j}" for j in rng.integers(0, 60, 12)] for _ in range(1500)]
    labels = np.zeros(1500, np.int8)
    for i, ws in enumerate(words):
        insult, group = rng.random() < 0.4, rng.random() < 0.4
        ws += ["vermin"] * insult + ["folk"] * group
        labels[i] = insult and group
    hashed = [np.unique(np.array([t for w in set(ws) for t in toxicity.terms(w)], np.int32)) for ws in words]
    model = toxicity.fit(hashed, labels)
    assert model.score("w1 vermin w2 folk") > 0.9
    assert max(model.score("w1 vermin w2"), model.score("w3 folk"), model.score("w1"), model.score("")) < 0.3


def hashed_terms(words):
    return np.unique(np.array([t for w in set(words) for t in toxicity.terms(w)], np.int32))


@pytest.mark.parametrize("vocabulary", [60, 3000])
def test_factorization_machine_learns_an_exclusive_or(vocabulary):
    rng = np.random.default_rng(1)
    texts, labels = [], []
    for _ in range(4000):
        a, b = (rng.random(2) < 0.5).tolist()
        texts.append([f"w{j}" for j in rng.integers(0, vocabulary, 12)] + ["vermin"] * a + ["folk"] * b)
        labels.append(int(a != b))
    model = toxicity.fit([hashed_terms(t) for t in texts[:3000]], np.array(labels[:3000], np.int8))
    right = [(model.score(" ".join(t)) >= 0.5) == y for t, y in zip(texts[3000:], labels[3000:])]
    assert np.mean(right) > 0.97


def test_scores_are_the_sum_over_pairs(spark, sf):
    import itertools
    import math

    table = spark.read.parquet(f"{sf}/documents.parquet")
    model = toxicity.train(table, spark.read.parquet(f"{sf}/labels.parquet"), "doc_id", "text", "toxic", usable=queries.fold("doc_id", 3) != 1)
    assert len(model.rows) > 3
    text = {r.doc_id: r.text or "" for r in table.collect()}
    for r in queries.op1_toxicity(spark, sf).collect():
        on = sorted({model.rows[t] for w in re.findall(r"\w+", text[r.doc_id].lower()) for t in toxicity.terms(w) if t in model.rows})
        z = model.bias + sum(model.weights[i] for i in on) + sum(float(model.factors[i] @ model.factors[j]) for i, j in itertools.combinations(on, 2))
        want = 1 / (1 + math.exp(-min(max(z, -30), 30)))
        assert r.score == pytest.approx(want, abs=1e-9) and r.predicted == int(r.score >= 0.7)


def test_words_of_long_texts_are_whole(monkeypatch):
    text = "Alpha beta " * 50 + "x" * 300 + " ΣΑΣ end"
    whole = toxicity.words_of(text)
    monkeypatch.setattr(toxicity, "_SLICE", 7)
    assert toxicity.words_of(text) == whole == set(re.findall(r"\w+", text.lower())) and toxicity.words_of(None) == set()


def test_toxicity_odd_rows_and_training(spark):
    rows = [(i, "good calm text" + (" awful" if i % 4 == 0 else "") + f" n{i % 7}", "s") for i in range(200)]
    labels = spark.createDataFrame([(i, int(i % 4 == 0), "x") for i in range(200)] + [(None, 1, ""), (3, None, ""), (0, 0, "")], "doc_id long, toxic int, text string")
    model = toxicity.train(docs_table(spark, rows), labels)
    got = {r.doc_id: r.score for r in toxicity.scores(docs_table(spark, [*ODD, (9, "Awful", "s"), (10, LONG + " AWFUL", "s")]), model).collect()}
    assert got[9] > 0.7 and got[10] > 0.7 and max(v for k, v in got.items() if k not in (9, 10)) < 0.5
    assert got[1] == got[2] and all(0 <= v <= 1 for v in got.values())
    none = toxicity.train(docs_table(spark, rows), labels.limit(0))
    assert toxicity.scores(docs_table(spark, []), none).count() == 0 and 0 <= none.score("x") <= 1


def test_toxicity_held_out(spark):
    got = queries.op1_toxicity(spark, "/root/testdata/sf0.1").join(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"), "doc_id").toPandas()
    held = got[got.held_out]
    assert len(held) > 1000 and ((got.score >= 0.7) == (got.predicted == 1)).all()
    assert held[held.predicted == 1].toxic.mean() > 0.97
    good = held[(held.toxic == 1) & (held.quality == 1)]
    assert good.predicted.mean() > 0.85


# --- SentencePiece


@pytest.fixture(scope="module")
def bpe(spark):
    return queries.piece_model(spark)


def test_pieces_equal_the_library(bpe):
    import random

    import public_tokenizers
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    rng = random.Random(5)
    known = list(bpe.ids)
    texts = ["", " ", "  a  b ", "Hello wörld\n", "😀▁x", "a" * 3000] + ["".join(rng.choice(known) for _ in range(6)).replace("▁", rng.choice([" ", ""])) for _ in range(300)]
    for x in texts:
        assert bpe.encode(x) == lib.encode(x)
        if "▁" not in x:
            assert bpe.decode(bpe.encode(x)) == x
    for x in texts[-60:]:
        for size in (1, 5, 13):
            n = bpe.normal(x)
            assert bpe.scan(n, size) == lib.encode(x)


def test_matrices_combine_associatively(bpe):
    text = bpe.normal("thequickbrownfoxjumpsoverthelazydog" * 2)
    k, n = bpe.longest, 17
    parts = [(text[max(0, c - k):c], text[c:c + n], text[c + n:c + n + k]) for c in range(0, len(text), n)]
    a, b, c, d = [pieces.chunk_matrix(bpe, *p) for p in parts[:4]]
    left = pieces.combine(pieces.combine(a, b), pieces.combine(c, d))
    assert left == pieces.combine(pieces.combine(pieces.combine(a, b), c), d) == pieces.combine(a, pieces.combine(b, pieces.combine(c, d)))


def test_unigram_scan_is_the_best_segmentation():
    scores = {"▁a": -1.0, "▁": -2.5, "a": -2.0, "b": -2.2, "ab": -2.9, "ba": -3.0, "aba": -4.0, "bb": -5.5}
    names = ["<unk>", *scores]
    m = pieces.Model({p: i for i, p in enumerate(names) if i}, [0.0, *scores.values()], [None, *scores], [], 0, False, True, 3)

    def brute(s):
        best = {0: (0.0, ())}
        for j in range(1, len(s) + 1):
            best[j] = max((best[i][0] + scores[s[i:j]], best[i][1] + (s[i:j],)) for i in range(max(0, j - 3), j) if s[i:j] in scores and i in best)
        return best[len(s)]

    import random

    rng = random.Random(1)
    for _ in range(40):
        s = "▁" + "".join(rng.choice("ab") for _ in range(rng.randint(1, 14)))
        for size in (2, 3, 7, 50):
            got = m.scan(s, size)
            assert "".join(m.text(p) for p in got) == s
            assert sum(m.weight(p) for p in got) == pytest.approx(brute(s)[0])


def test_chunk_matrices_equal_those_made_piece_by_piece(bpe):
    import random

    rng = random.Random(8)
    text = bpe.normal("".join(rng.choice(["the", "quick", " ", "  ", "fox", "\n", "wörd", "😀", "ation"]) for _ in range(400)))
    several = 0
    for before, body, after in pieces.chunks(bpe, text, 61):
        starts = bpe.entries(before + body + after, len(before)) if before else [(0, pieces._START)]
        whole = {s: row for s, row in bpe.ways(body + after, len(body), starts).items() if row}
        assert bpe.matrix(body + after, len(body), starts) == whole
        several += len(starts) > 1 and len({e for row in whole.values() for e in row}) > 1
    assert several > 10


def test_encode_tables(spark, bpe):
    import public_tokenizers
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    giant = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").orderBy(F.length("text").desc()).first().text
    rows = [*ODD, (8, "x" * 5000, "s"), (9, "ab" * 3000, "s"), (10, giant, "s"), (10, giant, "s"), (11, " \n" * 4000, "s")]
    for fan in (2, 64):  # levels of matrices of matrices
        got = pieces.encode(docs_table(spark, rows), bpe, giant=2000, size=700, fan=fan, with_text=True)
        table = got.collect()
        assert Counter((r.doc_id, tuple(r.ids)) for r in table) == Counter((i, tuple(lib.encode(t or ""))) for i, t, _ in rows)
        assert Counter((r.doc_id, r.text) for r in table) == Counter((i, t or "") for i, t, _ in rows)
    back = Counter((r.doc_id, r.text) for r in pieces.decode(got, bpe).collect())
    assert back == Counter((i, t or "") for i, t, _ in rows)
    odd = spark.createDataFrame([(1, None), (2, []), (3, [None, 13])], "doc_id long, ids array<int>")
    assert pieces.decode(odd, bpe).count() == 3
    for wrong in (-1, 10**6):
        with pytest.raises(Exception, match="outside the vocabulary"):
            pieces.decode(spark.createDataFrame([(1, [wrong])], "doc_id long, ids array<int>"), bpe).collect()
    assert pieces.encode(docs_table(spark, []), bpe).count() == 0


def test_sentencepiece_query(spark, sf):
    import public_tokenizers
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    text = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = queries.op8_sentencepiece(spark, sf).collect()
    assert len(got) == len(text)
    for r in got:
        assert r.ids == lib.encode(text[r.doc_id]) and r.n_tokens == len(r.ids) and r.decoded_sha256 == hashlib.sha256(text[r.doc_id].encode()).hexdigest()


# --- nearest neighbours


@pytest.mark.parametrize("size", ["sf0.01", "sf0.1"])
def test_nearest_recall_and_order(spark, size):
    sf = f"/root/testdata/{size}"
    got = queries.op4_nearest(spark, sf).toPandas()
    e = spark.read.parquet(f"{sf}/embeddings.parquet").toPandas()
    x, ids = np.stack(e.embedding).astype(float), e.vec_id.to_numpy()
    hits = total = 0
    for q in ids[ids % 20 == 0]:
        s = x @ x[ids == q][0]
        best = [i for i in np.lexsort((ids, -s)) if ids[i] != q][:20]
        mine = got[got.query_id == q].sort_values("rank")
        assert list(mine["rank"]) == list(range(1, 21)) and (np.diff(mine.score) <= 0).all()
        assert np.allclose(mine.score, [s[ids == i][0] for i in mine.vec_id], atol=1e-12)
        hits += len(set(ids[best]) & set(mine.vec_id))
        total += 20
    assert hits / total >= 0.9


def test_nearest_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, None), (1, [0.0, 0.0]), (2, [1.0, None]), (3, [nan, 1.0]), (4, [1.0, 2.0]), (5, [1.0, 2.0]), (None, [1.0, 1.0]), (6, [1.0]), (7, [inf, 1.0]), (40, [0.5, 0.5]), (8, [])]
    table = spark.createDataFrame([(*r, 0, 1) for r in rows], "vec_id long, embedding array<float>, list int, block int")
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in ann.search(table).collect())
    assert got == [(0, 1, 4, 1.0), (0, 2, 5, 1.0), (0, 3, 40, 0.5), (40, 1, 4, 1.5), (40, 2, 5, 1.5), (40, 3, 0, 0.5)]
    assert ann.search(table.limit(0)).count() == 0


def test_nearest_among_many_equal_vectors(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(900, 8))
    x[100:400] = x[100]
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(120, x[100].tolist())] * 30 + [(40, x[3].tolist())], "vec_id long, embedding array<double>")
    got = ann.search(table, shard=100, group=7).toPandas()
    assert len(got) == 45 * 20
    ids = np.concatenate((np.arange(900), [120] * 30, [40]))
    every = np.concatenate((x, x[[100] * 30], x[[3]]))
    hits = 0
    for q in range(0, 900, 20):
        v = min(every[ids == q].tolist())
        s = every @ np.array(v)
        best = [i for i in np.lexsort((ids, -s)) if ids[i] != q][:20]
        mine = got[got.query_id == q].sort_values("rank")
        assert np.allclose(mine.score, np.sort(mine.score)[::-1]) and q not in set(mine.vec_id)
        hits += sum((Counter(ids[best].tolist()) & Counter(mine.vec_id.tolist())).values())
        if 100 <= q < 400:
            assert list(mine.vec_id) == ids[best].tolist() or not np.allclose(s[best], s[best][0])
    assert hits / len(got) > 0.95


def test_nearest_in_one_crowded_list(spark):
    rng = np.random.default_rng(1)
    x = np.concatenate([np.tile(rng.normal(size=8), (300, 1)) + rng.normal(0, 1e-3, (300, 8)), rng.normal(size=(200, 8))])
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = ann.search(table, shard=64, group=4).toPandas()
    hits = 0
    for q in range(0, 500, 20):
        s = x @ x[q]
        s[q] = -np.inf
        hits += len(set(np.lexsort((np.arange(500), -s))[:20]) & set(got[got.query_id == q].vec_id))
    assert hits / (25 * 20) >= 0.9 and len(got) == 500


# --- HTML


@pytest.mark.parametrize("page,text", [
    (None, ""), ("", ""), ("<html><body><nav>a b</nav></body></html>", ""),
    ("<nav><a href=x>Home page</a></nav><article><h1>A  title</h1><p>Some &amp; text,\n of it.<br>More text &lt;here&gt; now.<p>Then another one.</article><footer>&copy; me all rights</footer>",
     "A title\nSome & text, of it. More text <here> now.\nThen another one."),
    ('<script>var t="</p>";</script><style>p{}</style><main><h1>Some title</h1><p>First sentence of the text.</p><div class="ad">Buy this now!</div><p>Second sentence of it.</p></main><div class="comments"><p>I like this.</p></div>',
     "Some title\nFirst sentence of the text.\nSecond sentence of it."),
    ("<article><p>Cut off in the mid", "Cut off in the mid"),
    ("<article><h1>A title of it</h1><p>Before <math><mi>x</mi></math> after, some words.</p><noscript><p>Plain words for all of you.</p></noscript><p>The area <svg><text>A</text></svg> is <object>large</object>.</p></article><footer>Legal</footer>",
     "A title of it\nBefore x after, some words.\nPlain words for all of you.\nThe area A is large."),
])
def test_main_text(page, text):
    assert html_crf.default_model().main_text(page) == text


def test_field_held_out_accuracy_and_best_path():
    import itertools

    model = html_crf.default_model()
    right = total = 0
    for page in html_crf.labelled_pages(150, seed=99):
        found = html_crf.blocks(page)
        labels = model.decode(found)
        right += sum(y == b.gold for y, b in zip(labels, found))
        total += len(found)
        if len(found) <= 9:
            e = model.emissions(found)
            value = lambda p: model.start[p[0]] + sum(x for x, y in zip(e, p) if y) + sum(model.moves[a][b] for a, b in zip(p, p[1:]))
            assert value(labels) == pytest.approx(max(map(value, itertools.product((0, 1), repeat=len(found)))))
    assert right / total > 0.97


def test_weights_of_ancestors_are_the_sum_of_their_features():
    model = html_crf.default_model()
    for page in html_crf.labelled_pages(60, seed=3) + ["<div><p>a<div>b</p></div>" * 50, "<table><tr><td>a<td>b<tr><td><ul><li>c<li>d</table>e", "<nav" * 9 + "<p>x<a>y<a>z</p>"]:
        slow, fast = html_crf.blocks(page), html_crf.blocks(page, model.weights)
        assert [(b.text, b.linked, b.gold) for b in slow] == [(b.text, b.linked, b.gold) for b in fast]
        assert np.allclose(model.emissions(slow), model.emissions(fast))


def test_tags_end_where_quotes_allow():
    import random

    rng = random.Random(4)

    def plain(page, i):
        quote = ""
        for at in range(i, len(page)):
            c = page[at]
            if quote:
                quote = "" if c == quote else quote
            elif c in "\"'":
                quote = c
            elif c == ">":
                return at
        return -1

    for _ in range(300):
        page = "".join(rng.choice("a >\"'<") for _ in range(rng.randint(1, 30)))
        ends = html_crf._Ends(page)
        for i in range(len(page) + 1):
            assert ends.after(i) == plain(page, i)


@pytest.mark.parametrize("unit", ["<p class='x ", "<a ", "<!", "<?x", "<script ", "<div><b>", "</x>", "<div></p><b>", "<li><div>", "<title><p>", "<svg><title>", "<!--", "<a<a", "&", "<ul><li><b><div></div>", "<table><tr><td>x"])
def test_hostile_pages_take_time_in_proportion(unit):
    import time

    model = html_crf.default_model()

    def seconds(n):
        began = time.process_time()
        model.main_text("<article><p>Some text of it.</p>" + unit * (n // len(unit)))
        return time.process_time() - began

    seconds(50_000)
    assert seconds(1_000_000) < 8


def test_deep_ancestors_count():
    model = html_crf.default_model()
    page = "<nav>" + "<div>" * 500 + "Home page and more" + "</div>" * 500 + "</nav><article><p>This is the text of it.</p></article>"
    assert "in nav" in html_crf.blocks(page)[0].above and model.main_text(page) == "This is the text of it."


def test_extraction_of_the_pages(spark, sf):
    import html

    pages = spark.read.parquet(f"{sf}/pages.parquet").toPandas().set_index("page_id")
    for r in queries.op5_html_extraction(spark, sf).collect():
        inner = re.search(r"<article>(.*?)(?:</article>|$)", pages.html[r.page_id], re.S)[1]
        parts = [" ".join(html.unescape(re.sub(r"</?b>", "", x.replace("<br>", " "))).split()) for x in re.split(r"</?(?:h1|p)>", inner)]
        assert r.text == "\n".join(p for p in parts if p) and r.n_chars == len(r.text) and r.url == pages.url[r.page_id]


def test_extraction_odd_rows(spark):
    rows = [(1, None, None), (1, None, None), (None, "u", "<p>" * 3000 + "A text of some words."), (2, "u", "<" * 2000), (3, "u", "<a '" * 500), (4, "u", f"<article><p>{LONG}</p></article>")]
    table = spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, html string, text string, row string")
    got = html_crf.extract(table).select("row.page_id", "text").collect()
    assert len(got) == len(rows) and next(r.text for r in got if r.page_id == 4) == LONG.strip()
    assert html_crf.extract(table.limit(0)).count() == 0


# --- licences


def test_licences_are_inherited_from_the_nearest_directory(spark):
    mit, nc, apache = "Released under the MIT License.", "Licensed under CC BY-NC 4.0.", "Licensed under the Apache License, Version 2.0."
    body = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    rows = [(1, mit, "a/LICENSE"), (2, body, "a/b/c/x"), (3, None, "a/y"), (4, f"{nc}\n{body}", "a/b/z"), (5, "zz", "q"), (6, "the license of", "q/r"), (None, "zz", None),
            (7, apache, "LICENSE"), (2, body, "a/b/c/x"), (8, f"{body}\r\n{mit.upper()}", "w"), (9, "MIT License was not released under it by them", "v/w")]
    table = spark.createDataFrame([(*r, 0.5, "k") for r in rows], "doc_id long, text string, path string, score double, key string")
    got = Counter((r.doc_id, r.licence, r.origin, r.licence_dir) for r in licences.scan(table, "doc_id", "text", F.col("path")).collect())
    assert got == Counter([
        (1, "MIT", "own", None), (2, "MIT", "inherited", "a"), (2, "MIT", "inherited", "a"), (3, "MIT", "inherited", "a"), (4, "CC-BY-NC-4.0", "own", None),
        (5, "Apache-2.0", "inherited", ""), (6, "Apache-2.0", "inherited", ""), (None, None, "none", None), (7, "Apache-2.0", "own", None), (8, "MIT", "own", None),
        (9, "Apache-2.0", "inherited", ""),
    ])
    assert licences.scan(table.limit(0), "doc_id", "text", F.col("path")).count() == 0


def test_licence_lines_against_brute_force(spark, sf):
    import math

    table = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    docs = table.toPandas().text.tolist()
    bag = lambda s: Counter(re.findall("[a-z0-9]+", s.lower()))
    temps = [(name, bag(line)) for name, line in licences.TEMPLATES]
    vocabulary = {t for _, b in temps for t in b}
    seen = Counter(t for d in docs for t in set(bag(d)) & vocabulary)
    idf = lambda t: math.log((1 + len(docs)) / (1 + (seen[t] if t in vocabulary else 1))) + 1
    want = {}
    for line in {x for d in docs for x in re.split(r"\r\n|\r|\n", d)}:
        b = bag(line)
        norm = math.sqrt(sum((n * idf(t)) ** 2 for t, n in b.items()))
        scores = [(round(min(1.0, sum(n * idf(t) * c[t] * idf(t) for t, n in b.items()) / norm / math.sqrt(sum((n * idf(t)) ** 2 for t, n in c.items()))), 9), -i) for i, (_, c) in enumerate(temps)] if norm else []
        if scores and max(scores)[0] >= licences.THRESHOLD:
            want[line] = (temps[-max(scores)[1]][0], max(scores)[0])
    got = {r.line: (r.licence, r.score) for r in licences.scan_lines(table, "text").collect()}
    assert got == want and len(got) >= 2


def rewrapped(text, width, lead=""):
    import textwrap

    return "\n".join(lead + line for p in text.split("\n\n") for line in [*textwrap.wrap(" ".join(p.split()), width), ""])


def test_real_licences_are_recognised_and_inherited(spark):
    full = licences._full
    code = "import os\n\n\ndef run(x):\n    return os.path.join(x, 'a')\n" * 20
    notice = " ".join(licences._NOTICE).format("", "3")
    rows = [
        (1, "Copyright (c) 2020 A. Nother\n\n" + full("MIT"), "mit/LICENSE"), (2, code, "mit/src/x.py"),
        (3, rewrapped(full("BSD-3-Clause"), 60), "bsd/COPYING"), (4, code, "bsd/a/b/c/x.py"),
        (5, full("Apache-2.0"), "ap/LICENSE.txt"), (6, full("GPL-2.0"), "ap/gpl/COPYING"), (7, code, "ap/gpl/x"), (8, code, "ap/y"),
        (9, rewrapped(notice, 70, "# ") + "\n" + code, "q/z.py"), (10, code, "q/w.py"), (11, full("MPL-2.0"), "mpl/L"), (12, rewrapped(full("ISC"), 50), "isc/L"),
        (13, None, "mit/none"), (14, "", "bsd/empty"), (15, LONG, "mit/src/long"), (16, LONG + "\nSPDX-License-Identifier: MIT\n" + LONG, "q/long"), (17, code, None), (None, full("MIT"), "n/L"),
    ]
    got = {r.doc_id: (r.licence, r.origin) for r in licences.scan(spark.createDataFrame(rows, "doc_id long, text string, path string"), "doc_id", "text", F.col("path")).collect()}
    assert got == {
        1: ("MIT", "own"), 2: ("MIT", "inherited"), 3: ("BSD-3-Clause", "own"), 4: ("BSD-3-Clause", "inherited"), 5: ("Apache-2.0", "own"), 6: ("GPL-2.0", "own"),
        7: ("GPL-2.0", "inherited"), 8: ("Apache-2.0", "inherited"), 9: ("GPL-3.0", "own"), 10: (None, "none"), 11: ("MPL-2.0", "own"), 12: ("ISC", "own"),
        13: ("MIT", "inherited"), 14: ("BSD-3-Clause", "inherited"), 15: ("MIT", "inherited"), 16: ("MIT", "own"), 17: (None, "none"), None: ("MIT", "own"),
    }


def test_licence_query_against_brute_force(spark, sf):
    import math

    docs = {r.doc_id: (r.text, r.source) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    bag = lambda s: Counter(re.findall("[a-z0-9]+", s.lower()))
    temps = [(name, bag(text)) for name, text in licences.TEMPLATES + licences.BLOCKS]
    vocabulary = {t for _, b in temps for t in b}
    seen = Counter(t for text, _ in docs.values() for t in set(bag(text or "")) & vocabulary)
    idf = lambda t: math.log((1 + len(docs)) / (1 + (seen[t] if t in vocabulary else 1))) + 1
    weigh = lambda b: {t: (1 + math.log(n)) * idf(t) for t, n in b.items()}
    norm = lambda v: math.sqrt(sum(x * x for x in v.values()))
    sides = [(name, weigh(b)) for name, b in temps]

    def match(part):
        v = weigh(bag(part))
        scores = [(round(min(1.0, sum(x * y.get(t, 0) for t, x in v.items()) / norm(v) / norm(y)), 9), -i) for i, (_, y) in enumerate(sides)] if v else []
        return (sides[-max(scores)[1]][0], max(scores)[0]) if scores and max(scores)[0] >= licences.THRESHOLD else None

    comment = re.compile(licences.COMMENT.replace("^", "", 1))
    own, whole = {}, {}
    for i, (text, _) in docs.items():
        plain = re.sub("\r\n?", "\n", text or "")
        lines = plain.split("\n")
        code = next((k for k, x in enumerate(lines) if not comment.match(x.lower())), len(lines))
        parts = [("line", x) for x in dict.fromkeys(lines)] + [("p", x) for x in dict.fromkeys(re.split("\n[^A-Za-z0-9]*\n", plain))] + [("h", "\n".join(lines[:code])), ("whole", plain)]
        hits = [(kind, x, m) for kind, x in parts if (m := match(x))]
        if hits:
            own[i] = min((-m[1], m[0]) for _, _, m in hits)
            stated = sum(sum(bag(x).values()) for kind, x, _ in hits if kind == "line")
            whole[i] = any(kind == "whole" for kind, _, _ in hits) or stated >= licences.FILE_SHARE * sum(bag(plain).values())
    given = {}
    for i in whole:
        if whole[i]:
            at = f"{docs[i][1] or ''}/{i // 1000}/{i // 100}"
            given[at] = min(given.get(at, own[i]), own[i])
    got = queries.op3_licences(spark, sf).collect()
    assert len(got) == len(docs) and len(own) > 3
    for r in got:
        up = [at for at in (f"{docs[r.doc_id][1] or ''}/{r.doc_id // 1000}/{r.doc_id // 100}", f"{docs[r.doc_id][1] or ''}/{r.doc_id // 1000}", docs[r.doc_id][1] or "") if at in given]
        want = (own[r.doc_id][1], "own", -own[r.doc_id][0]) if r.doc_id in own else (given[up[0]][1], "inherited", -given[up[0]][0]) if up else (None, "none", None)
        assert (r.licence, r.origin, r.score) == want


# --- all queries, and the pipeline


def test_queries_are_registered():
    import __spark_entry__

    names = [n for n in __spark_entry__.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 11)) and "pipeline" in __spark_entry__.queries()


def test_pipeline_stages(spark, sf):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{sf}/documents.parquet").cache()
    spoken = p.language(spark, docs, sf)
    assert spoken.columns == docs.columns and spoken.count() >= 0.98 * docs.count()
    labels = spark.read.parquet(f"{sf}/labels.parquet").where("toxic = 1")
    clean = p.clean(spark, spoken, sf)
    gone = spoken.join(clean, "doc_id", "left_anti")
    assert clean.columns == docs.columns and gone.count() == gone.join(labels, "doc_id", "left_semi").count() or gone.count() <= labels.count() * 2
    one = p.distinct(spark, docs, sf)
    parts = simhash.simhash_components(docs)
    assert {r.doc_id for r in one.collect()} == {r.component_id for r in parts.collect()} and one.count() == parts.select("component_id").distinct().count()
    mixed = p.mixed(spark, one, sf)
    copies = {r.doc_id: r.copies for r in mixing.mix(one).collect()}
    assert Counter(r.doc_id for r in mixed.collect()) == Counter({k: v for k, v in copies.items() if v}) and mixed.columns == docs.columns
    tokens = p.tokens(spark, mixed, sf)
    text = {r.doc_id: r.text for r in docs.collect()}
    for r in tokens.collect():
        assert r.n_tokens == len(r.ids) and r.decoded_sha256 == hashlib.sha256(text[r.doc_id].encode()).hexdigest()


def test_stages_keep_columns_of_any_name(spark, tmp_path):
    import corpus_pipeline as p

    more = "score double, row string, id long, fp long, size long, copies int, lang_pred string, t string, order long, component_id long, n long"
    rows = [(i, t, "en", s, 0, *[None] * 11) for i, t, s in ODD] + [(i, f"text number {i} of the many words here", "en", "s", 0, *[None] * 11) for i in range(10, 60)]
    docs = spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, {more}")
    spark.createDataFrame([(10, 1, 0), (None, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for _, stage in p.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns and out.count() > 40
    assert p.STAGES[-1][1](spark, docs, str(tmp_path)).count() == len(rows)


def test_pipeline_odd_documents(spark, tmp_path):
    import corpus_pipeline as p

    rows = [(i, t, "en", s, 0) for i, t, s in ODD] + [(i, f"text number {i} of the many words here", "en", "s", 0) for i in range(10, 60)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(10, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = p.run(spark, str(tmp_path)).collect()
    assert 5 in {r.doc_id for r in got} and not {1, 2, 3} & {r.doc_id for r in got}
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/e/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/e/labels.parquet")
    assert p.run(spark, f"{tmp_path}/e").count() == 0
