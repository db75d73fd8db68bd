"""Language identification of whole texts, with spans of mixed-language text.

A word, a run of letters (Unicode's categories L), can only be in the languages
seen with its script, or in any where none was. Naive Bayes over the character n-grams of a word gives its score in
each of them. Viterbi over the words, with a penalty for every change of
language, then labels spans; a text's language is the one that covers most of
its letters.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import extended, forgotten, small_batches, trim, written

TRAIN_ROWS = 4000
ORDERS = (1, 2, 3)
PENALTY = 12.0
FLOOR = -8.0
BARRED = -1e4  # for a language that a word's script rules out
UNKNOWN = "und"
_MEMO = 150_000
_CHUNK = 1 << 20  # characters whose words are learned at once
_RUNS = re.compile(r"[^\W\d_]+")  # letters, and the few numerals that are no digits


def letters(text: str) -> list[tuple[int, int]]:
    """[start, end) of the runs of letters in a text."""
    out = []
    for found in _RUNS.finditer(text):
        a, b = found.span()
        if text[a:b].isalpha():
            out.append((a, b))
            continue
        for i in range(a, b):
            if text[i].isalpha():
                if out and out[-1][1] == i and i > a:
                    out[-1] = (out[-1][0], i + 1)
                else:
                    out.append((i, i + 1))
    return out


def words_of(text: str) -> list[str]:
    """The runs of letters in a text."""
    found = _RUNS.findall(text)
    if all(map(str.isalpha, found)):
        return found
    return [text[a:b] for a, b in letters(text)]

# Script blocks of Unicode, (first code point, last code point, script).
SCRIPTS = (
    (0x0041, 0x024F, "Latin"), (0x0250, 0x02AF, "Latin"), (0x0370, 0x03FF, "Greek"), (0x0400, 0x052F, "Cyrillic"),
    (0x0530, 0x058F, "Armenian"), (0x0590, 0x05FF, "Hebrew"), (0x0600, 0x077F, "Arabic"), (0x0900, 0x097F, "Devanagari"),
    (0x0980, 0x09FF, "Bengali"), (0x0A00, 0x0A7F, "Gurmukhi"), (0x0A80, 0x0AFF, "Gujarati"), (0x0B80, 0x0BFF, "Tamil"),
    (0x0C00, 0x0C7F, "Telugu"), (0x0C80, 0x0CFF, "Kannada"), (0x0D00, 0x0D7F, "Malayalam"), (0x0E00, 0x0E7F, "Thai"),
    (0x0E80, 0x0EFF, "Lao"), (0x1000, 0x109F, "Myanmar"), (0x10A0, 0x10FF, "Georgian"), (0x1100, 0x11FF, "Hangul"),
    (0x1200, 0x137F, "Ethiopic"), (0x1780, 0x17FF, "Khmer"), (0x1E00, 0x1EFF, "Latin"), (0x1F00, 0x1FFF, "Greek"),
    (0x3040, 0x309F, "Hiragana"), (0x30A0, 0x30FF, "Katakana"), (0x3400, 0x4DBF, "Han"), (0x4E00, 0x9FFF, "Han"),
    (0xAC00, 0xD7AF, "Hangul"), (0xF900, 0xFAFF, "Han"), (0x20000, 0x2FA1F, "Han"),
)
_STARTS = [a for a, _, _ in SCRIPTS]


def script(char: str) -> str:
    """The script of a letter; ``Other`` outside the table."""
    at = bisect_right(_STARTS, ord(char)) - 1
    return SCRIPTS[at][2] if at >= 0 and ord(char) <= SCRIPTS[at][1] else "Other"


def scripts(word: str) -> set[str]:
    return {"Latin"} if word.isascii() else {script(c) for c in word}


def grams(edged: str) -> list[str]:
    """The n-grams of a lower-case word whose edges are marked."""
    return [edged[i:i + n] for n in ORDERS for i in range(len(edged) - n + 1)]


@dataclass
class Model:
    """Languages in order, the languages of each script, and log-probabilities of n-grams (rows) by language."""

    langs: list[str]
    by_script: dict[str, list[int]]
    rows: dict[str, int]
    logs: np.ndarray
    memo: dict[str, int] = field(default_factory=dict, repr=False)
    scores: np.ndarray | None = field(default=None, repr=False)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"memo": {}, "scores": None}

    def forget(self) -> None:
        """Drop what was looked up."""
        self.memo, self.scores = {}, None

    def allowed(self, word: str) -> np.ndarray:
        """True for the languages seen with a script of the word; all where none was."""
        seen = {i for s in scripts(word) for i in self.by_script.get(s, ())}
        mask = np.zeros(len(self.langs), bool)
        mask[list(seen) or slice(None)] = True
        return mask

    def learn(self, words: set[str]) -> None:
        """Put the log-posteriors of new words into the memo, which holds what ``words`` need and a bounded rest."""
        new = list(words.difference(self.memo))
        if len(self.memo) + len(new) > _MEMO:
            self.memo.clear()
            self.scores = None
            new = list(words)
        if not new:
            return
        get, flat, cuts = self.rows.get, [], []
        rest = len(self.logs) - 1  # the empty row: of unknown n-grams
        for w in new:
            cuts.append(len(flat))
            edged = f"^{w}$"
            flat += [get(g, rest) for g in grams(edged)]
        sums = np.add.reduceat(self.logs[flat], cuts, axis=0) / len(ORDERS)
        out = {i: ~mask for i, w in enumerate(new) if not (mask := self.allowed(w)).all()} if len(self.by_script) > 1 else {}
        for i, mask in out.items():
            sums[i, mask] = -np.inf
        sums -= sums.max(axis=1, keepdims=True)
        post = sums - np.log(np.exp(sums).sum(axis=1, keepdims=True))
        post = np.maximum(post, FLOOR).astype(np.float32)
        for i, mask in out.items():
            post[i, mask] = BARRED
        start = len(self.memo)
        if self.scores is None or start + len(new) > len(self.scores):
            grown = np.zeros((max(2 * (start + len(new)), 1024), len(self.langs)), np.float32)
            grown[:start] = self.scores[:start] if start else 0
            self.scores = grown
        self.scores[start:start + len(new)] = post
        self.memo.update(zip(new, range(start, start + len(new))))


def viterbi(scores: np.ndarray, penalty: float = PENALTY) -> np.ndarray:
    """The best language of every word: highest sum of scores less ``penalty`` for each change; ties to the lower index."""
    n, k = scores.shape
    if k == 1:
        return np.zeros(n, np.int64)
    best = int(scores.sum(axis=0, dtype=np.float64).argmax())
    gains = scores.astype(np.float64) - scores[:, best:best + 1]
    total = np.concatenate((np.zeros((1, k)), np.cumsum(gains, axis=0)))
    outside = np.delete(gains, best, axis=1).max(axis=1).sum()
    if outside <= 0 and (total - np.minimum.accumulate(total, axis=0)).max() < penalty:
        # A way without `best` loses, and a stretch in another language beside it gains less than a change costs.
        return np.full(n, best)
    at = scores[0].astype(np.float64).tolist()
    back = []
    for row in scores[1:].tolist():
        top = max(at)
        jump, stay = at.index(top), top - penalty
        back.append([i if v >= stay else jump for i, v in enumerate(at)])
        at = [(v if v >= stay else stay) + s for v, s in zip(at, row)]
    path = [at.index(max(at))]
    for step in reversed(back):
        path.append(step[path[-1]])
    return np.array(path[::-1])


def identify(model: Model, words: list[str]) -> tuple[str, float, np.ndarray]:
    """(language, score, label of every word) of a text's words, which the model has learned."""
    rows = model.scores[np.fromiter(map(model.memo.__getitem__, words), np.int64, len(words))]
    path = viterbi(rows)
    lengths = np.fromiter(map(len, words), np.float64, len(words))
    lang = int(np.bincount(path, weights=lengths, minlength=len(model.langs)).argmax())
    own = path == lang
    score = float((np.exp(rows[own, lang]) * lengths[own]).sum() / lengths.sum())
    return model.langs[lang], min(1.0, max(0.0, score)), path


def spans(text: str, path: np.ndarray, langs: list[str]) -> list[dict]:
    """Stretches of one language in a text, as [start, end) code points; ``path`` labels its words."""
    out: list[dict] = []
    for (start, end), label in zip(letters(text), path.tolist()):
        if out and out[-1]["lang"] == langs[label]:
            out[-1]["end"] = end
        else:
            out.append({"start": start, "end": end, "lang": langs[label]})
    return out


def _tallied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The weights of n-grams, and the letters of scripts, by language, from a partition's words (l, w, x, n)."""
    tally: Counter = Counter()
    for batch in batches:
        for l, w, x, n in zip(*(c.to_pylist() for c in batch.columns)):
            for s in scripts(w):
                tally[l, True, s] += n * len(w)
            for g in grams(f"^{w}$"):
                tally[l, False, g] += x
    if tally:
        columns = list(zip(*tally))
        kinds = (pa.string(), pa.bool_(), pa.string())
        yield pa.RecordBatch.from_arrays(
            [*map(pa.array, columns, kinds), pa.array(list(tally.values()), pa.int64())], names=["l", "script", "key", "x"]
        )


def train(df: DataFrame, text_col: str = "text", lang_col: str = "lang", usable: Column | None = None, max_rows: int = TRAIN_ROWS) -> Model:
    """A model from the rows of ``df`` with a language, or those of them where ``usable`` holds.

    The languages share ``max_rows`` rows at most, on average, chosen by a hash
    of the text; only the weights of their words' n-grams by language reach the
    driver. Without any such row the model knows no language, and it knows none of which no chosen row has a letter.
    """
    rows = df.select(F.col(text_col).alias("t"), F.col(lang_col).cast("string").alias("l"), (F.lit(True) if usable is None else usable).alias("ok"))
    rows = rows.where(F.col("l").isNotNull() & F.col("ok") & F.col("t").isNotNull())
    counts = written(rows.groupBy("l").agg(F.count(F.lit(1)).alias("n")), "languages")
    known = counts.count()
    if not known:
        return Model([], {}, {}, np.zeros((1, 0), np.float32))
    shares = counts.select("l", F.least(F.lit(1.0), F.lit(max_rows / known) / F.col("n")).alias("share"))
    chosen = rows.join(F.broadcast(shares) if known <= max_rows else shares, "l")
    chosen = chosen.where(F.pmod(F.xxhash64("t", F.lit(10)), F.lit(1 << 20)) < F.col("share") * (1 << 20))
    words = chosen.select("l", F.explode(F.regexp_extract_all(F.lower("t"), F.lit(r"\p{L}+"), F.lit(0))).alias("w"))
    # A word weighs 1 and the logarithm of its number, in whole 2^20ths, so that sums are the same in any order.
    weights = words.groupBy("l", "w").agg(F.round((1 + F.log(F.count(F.lit(1)))) * (1 << 20)).cast("long").alias("x"), F.count(F.lit(1)).alias("n"))
    table = weights.mapInArrow(_tallied, "l string, script boolean, key string, x long").groupBy("l", "script", "key").agg(F.sum("x").alias("x")).toPandas()
    langs = sorted(set(table["l"]))
    if not langs:
        return Model([], {}, {}, np.zeros((1, 0), np.float32))
    index = {l: i for i, l in enumerate(langs)}
    found: dict[str, list[float]] = {}
    used: dict[str, Counter] = {}
    for l, is_script, key, x in zip(table["l"].map(index), table["script"], table["key"], table["x"].tolist()):
        if is_script:
            used.setdefault(key, Counter())[l] += x
        else:
            found.setdefault(key, [0.0] * len(langs))[l] = x / (1 << 20)
    kept = sorted(g for g, row in found.items() if sum(row) > 2)
    logs = np.zeros((len(kept) + 1, len(langs)))
    if kept:
        sizes = np.array(list(map(len, kept)))
        hits = np.array([found[g] for g in kept])
        for n in ORDERS:
            own = sizes == n
            smooth = hits[own] + 0.5
            logs[:-1][own] = np.log(smooth) - np.log(smooth.sum(axis=0)) if own.any() else 0
    by_script = {s: sorted(l for l, n in c.items() if n >= 0.001 * sum(c.values())) for s, c in used.items()}
    del table, found
    trim()
    return Model(langs, by_script, {g: i for i, g in enumerate(kept)}, logs.astype(np.float32))


def detect(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", with_spans: bool = False) -> DataFrame:
    """(id_col, lang_pred, score, n_spans[, spans]) for every row of ``df``.

    A null text or one without letters is ``und`` with score 0 and no span, and
    so is every text under a model that knows no language. The score is the
    mean over the text's letters of the posterior of ``lang_pred``, nothing
    where another language is the label. Ties go to the language first in
    order. Other columns are ignored; repeated rows each get a row; an empty
    table gives an empty one. ``spans`` has start, end (code points) and lang.
    """
    spark = df.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            out: list[tuple] = []
            held: list[tuple[str, list[str]]] = []
            size = 0

            def label() -> None:
                model.learn(set().union(*[words for _, words in held]))
                for text, words in held:
                    if not words:
                        out.append((UNKNOWN, 0.0, 0, []))
                        continue
                    lang, score, path = identify(model, words)
                    n = 1 + int(np.count_nonzero(path[1:] != path[:-1]))
                    out.append((lang, score, n, spans(text, path, model.langs) if with_spans else []))
                held.clear()

            for text in batch.column(1):
                text = text.as_py() or ""
                low = text.lower()
                if not model.langs:
                    words = []
                elif len(low) == len(text):
                    words = words_of(low)
                else:  # a letter whose lower case is several characters must not split its word
                    words = [w.lower() for w in words_of(text)]
                held.append((text if with_spans else "", words))
                size += len(text)
                if size >= _CHUNK:
                    label()
                    size = 0
            label()
            langs, scores, counts, stretches = zip(*out) if out else ((), (), (), ())
            columns = [batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(counts, pa.int64())]
            names = [id_col, "lang_pred", "score", "n_spans"]
            if with_spans:
                columns.append(pa.array(stretches, span))
                names.append("spans")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    more = ", spans array<struct<start: long, end: long, lang: string>>" if with_spans else ""
    def forgetting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return forgotten(of(batches), lambda: shared.value.forget())

    return df.select(id_col, text_col).mapInArrow(forgetting, extended(df, id_col, f"lang_pred string, score double, n_spans long{more}"))
