"""Toxicity by a factorization machine over hashed terms.

A text's terms are its distinct words and the beginnings of its words, hashed
into a fixed space. A term's own weight adds to the score, and every pair of
terms adds the product of their factors, so an insult beside the mention of a
group can weigh more than the two alone. Training keeps the terms that by
themselves, or together with another term, tell more about the label than
chance explains: a mention as common in clean texts as in toxic ones stays if
its pairs do not. That leaves so few that a text is scored by looking up its
distinct words.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from hashlib import sha1

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import extended, forgotten, small_batches, trim

TRAIN_ROWS = 16_000
SPACE = 1 << 20
PREFIXES = (3, 4, 5)
MIN_DOCS = 3
FACTORS = 4
PAIR_ROWS = 1000
STEPS = 400
RATE = 0.1
DECAY = 3e-6
_MEMO = 200_000
_SLICE = 1 << 20
_WORDS = re.compile(r"\w+")
_NO_WORD = re.compile(r"\W")


def words_of(text: str | None) -> set[str]:
    """The distinct lower-case words of a text, which is gone through in slices that cut no word."""
    text, found, at = text or "", set(), 0
    while at < len(text):
        gap = _NO_WORD.search(text, at + _SLICE)
        end = gap.start() if gap else len(text)
        found.update(_WORDS.findall(text[at:end].lower()))
        at = end
    return found


def terms(word: str) -> list[int]:
    """Hashed terms of a lower-case word: itself, and its beginnings if it is longer."""
    raw = word.encode("utf-8", "surrogatepass")
    found = [zlib.crc32(raw) % SPACE]
    found += [zlib.crc32(f"{word[:n]}*".encode("utf-8", "surrogatepass")) % SPACE for n in PREFIXES if len(word) > n]
    return found


@dataclass
class Model:
    """bias + sum of weights of a text's terms + sum over pairs of terms of the products of their factors."""

    bias: float
    rows: dict[int, int]
    weights: np.ndarray
    factors: np.ndarray
    memo: dict[str, tuple[int, ...]] = field(default_factory=dict, repr=False)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"memo": {}}

    def forget(self) -> None:
        """Drop what was looked up."""
        self.memo = {}

    def of(self, text: str | None) -> list[int]:
        """The model's distinct terms in a text, in order."""
        words = words_of(text)
        memo = self.memo
        new = words.difference(memo)
        if len(memo) + len(new) > _MEMO:
            memo.clear()
            new = words
        get = self.rows.get
        for w in new:
            memo[w] = tuple(r for r in map(get, terms(w)) if r is not None)
        return sorted({r for found in map(memo.__getitem__, words) if found for r in found})

    def score(self, text: str | None) -> float:
        """Probability of the label, 0 to 1; an empty or null text has that of the bias alone."""
        on = self.of(text)
        z = self.bias
        if on:
            v = self.factors[on]
            z += float(self.weights[on].sum() + 0.5 * (np.square(v.sum(axis=0)) - np.square(v).sum(axis=0)).sum())
        return 1 / (1 + float(np.exp(-min(max(z, -30.0), 30.0))))


def fit(rows: list[np.ndarray], labels: np.ndarray, seed: int = 1) -> Model:
    """A model from the hashed terms of texts (sorted, distinct) and their 0/1 labels.

    A term that occurs in ``MIN_DOCS`` texts stays if its own association with
    the label is beyond what the best of as many unrelated terms would show (z
    above the square root of twice the logarithm of their number), or if it is
    in a pair that is beyond that of all pairs with what the first terms leave
    unexplained. Weights and factors are fitted on the logistic loss.
    """
    n, ones = len(rows), float(labels.sum())
    if not n or not 0 < ones < n:
        rate = (ones + 0.5) / (n + 1)
        return Model(float(np.log(rate / (1 - rate))), {}, np.zeros(0), np.zeros((0, FACTORS)))
    docs, hits = np.zeros(SPACE, np.int64), np.zeros(SPACE, np.int64)
    for row, y in zip(rows, labels):
        docs[row] += 1
        if y:
            hits[row] += 1
    base = ones / n
    usual = docs >= min(MIN_DOCS, n)
    spread = np.sqrt(np.maximum(docs * base * (1 - base) * (1 - docs / n), 1e-9))
    z = np.where(usual, np.abs(hits - docs * base) / spread, 0)
    kept = np.nonzero(z > np.sqrt(2 * np.log(max(2, usual.sum()))))[0]
    model, chance = _descend(rows, labels, kept, seed)
    more = np.union1d(kept, paired(rows, labels, chance))
    return model if len(more) == len(kept) else _descend(rows, labels, more, seed)[0]


def paired(rows: list[np.ndarray], labels: np.ndarray, chance: np.ndarray, max_rows: int = PAIR_ROWS) -> np.ndarray:
    """Terms of which a pair's labels differ from a model's probabilities (``chance``) more than those of the best of all unrelated pairs would.

    At most ``max_rows`` texts with different terms are looked at, evenly taken.
    The variance of a label is taken as no less than that of all labels, as
    wrong labels go beyond the model's. A pair must be in as many texts as the
    square of the bound.
    """
    different = {row.tobytes(): i for i, row in enumerate(rows)}
    chosen = sorted(different.values())
    chosen = [chosen[len(chosen) * i // max_rows] for i in range(max_rows)] if len(chosen) > max_rows else chosen
    docs = np.zeros(SPACE, np.int64)
    for i in chosen:
        docs[rows[i]] += 1
    often, bound = np.nonzero(docs >= MIN_DOCS)[0], 0.0
    for _ in range(2):
        bound = np.sqrt(2 * np.log(max(2, len(often) * (len(often) - 1) / 2)))
        often = often[docs[often] >= bound**2]
    if len(often) < 2:
        return often[:0]
    place = np.full(SPACE, -1, np.int64)
    place[often] = np.arange(len(often))
    x = np.zeros((len(chosen), len(often)), np.float32)
    for r, i in enumerate(chosen):
        on = place[rows[i]]
        x[r, on[on >= 0]] = 1
    p = chance[chosen].astype(np.float32)[:, None]
    miss, variance = p - labels[chosen].astype(np.float32)[:, None], np.maximum(p * (1 - p), np.float32(labels.mean() * (1 - labels.mean())))
    found = np.zeros(len(often), bool)
    for a in range(0, len(often), 256):
        own = x[:, a:a + 256]
        sums, squares = (own * miss).T @ x[:, a:], (own * variance).T @ x[:, a:]
        clear = np.square(sums) > bound**2 * np.maximum(squares, 1e-9)
        clear &= np.arange(clear.shape[1])[None, :] > np.arange(len(clear))[:, None]
        found[a:a + 256] |= clear.any(axis=1)
        found[a:] |= clear.any(axis=0)
    return often[found]


def _descend(rows: list[np.ndarray], labels: np.ndarray, kept: np.ndarray, seed: int) -> tuple[Model, np.ndarray]:
    """A model over the terms ``kept``, by Adam on the logistic loss, and its probabilities."""
    n, k = len(rows), len(kept)
    base = float(labels.sum()) / n
    place = np.full(SPACE, -1, np.int64)
    place[kept] = np.arange(k)
    flat, owner = [], []
    for i, row in enumerate(rows):
        on = place[row]
        on = on[on >= 0]
        flat.append(on)
        owner.append(np.full(len(on), i))
    flat, owner = np.concatenate(flat), np.concatenate(owner)
    order = np.argsort(flat, kind="stable")
    by_term, its_doc = flat[order], owner[order]
    rng = np.random.default_rng(seed)
    bias, w, v = np.array([np.log(base / (1 - base))]), np.zeros(k), rng.normal(0, 0.01, (k, FACTORS))
    params = [bias, w, v]
    m1, m2 = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    y = labels.astype(float)

    def by_doc(x: np.ndarray) -> np.ndarray:
        return np.bincount(owner, weights=x, minlength=n)

    def to_term(x: np.ndarray) -> np.ndarray:
        return np.bincount(by_term, weights=x[its_doc], minlength=k)

    chance = np.full(n, base)
    for step in range(1, STEPS + 1 if k else 1):
        sums = np.stack([by_doc(v[flat, f]) for f in range(FACTORS)], axis=1)
        squares = by_doc(np.square(v[flat]).sum(axis=1))
        logit = bias[0] + by_doc(w[flat]) + 0.5 * (np.square(sums).sum(axis=1) - squares)
        chance = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        miss = (chance - y) / n
        total = to_term(miss)
        slope_v = np.stack([to_term(miss * sums[:, f]) for f in range(FACTORS)], axis=1) - v * total[:, None]
        slopes = [np.array([miss.sum()]), total + DECAY * w, slope_v + DECAY * v]
        for p, g, a, b in zip(params, slopes, m1, m2):
            a += 0.1 * (g - a)
            b += 0.001 * (g * g - b)
            p -= RATE * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)
    return Model(float(bias[0]), {int(t): i for i, t in enumerate(kept)}, w, v), chance


def train(
    df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    usable: Column | None = None, max_rows: int = TRAIN_ROWS,
) -> Model:
    """A model from the texts of ``df`` that ``labels`` (id_col, label_col) marks 0 or 1.

    ``usable``, over ``id_col``, restricts the labels to learn from. Of these a
    hash of the id chooses about ``max_rows`` at most; their hashed terms, not
    their texts, reach the driver. Null ids and labels are left out, and an id
    that labels repeat has its largest label.
    """
    small_batches(df.sparkSession)
    marked = labels.where((F.lit(True) if usable is None else usable) & F.col(id_col).isNotNull())
    marked = marked.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).where(F.col("y").isNotNull())
    count = marked.count()
    chosen = marked.where(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1 << 20)) < min(1.0, max_rows / max(1, count)) * (1 << 20))
    chosen = chosen.groupBy("id").agg(F.max("y").alias("y"))
    texts = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).join(F.broadcast(chosen), "id")

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text in batch.column(1):
                row = np.unique(np.array([t for w in words_of(text.as_py()) for t in terms(w)], np.int32))
                found.append(row.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], names=["y", "terms"])

    table = texts.select("y", "t").mapInArrow(of, "y int, terms binary").toArrow().combine_chunks()
    labels = table["y"].to_numpy()
    rows = [np.frombuffer(b.as_buffer(), np.int32) for b in table["terms"]]
    order = sorted(range(len(rows)), key=lambda i: (sha1(rows[i]).digest(), labels[i]))
    model = fit([rows[i] for i in order], (labels[order] > 0).astype(np.int8))
    del table, rows
    trim()
    return model


def scores(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, score) for every row: the probability of the label from the whole text.

    Null and empty texts score as the bias alone. Rows that repeat an id each
    get a row; other columns are ignored; an empty table gives an empty one.
    """
    spark = df.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            found = [model.score(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64())], names=[id_col, "score"])

    def forgetting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return forgotten(of(batches), lambda: shared.value.forget())

    return df.select(id_col, text_col).mapInArrow(forgetting, extended(df, id_col, "score double"))
