"""Similarities that no native expression gives: sequence ratio, weighted edit distance, alignment of entities."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

# Letters that old hands write alike, (how alike, 1 most, and the letters), for small letters, capitals and marks of abbreviation.
SMALL = (
    (1, "ijınuūīń"), (1, "fſ"), (1, "ct"), (1, "rꝛ"), (1, "uvꝟ"), (1, "ij"),
    (2, "mw"), (2, "aoeöëä"), (2, "au"), (2, "blh"), (2, "dđꝺ"), (2, "gqy"), (2, "yȝʒz"), (2, "eo"), (2, "wƿp"),
    (3, "khb"), (3, "sſʃ"), (3, "xy"), (3, "þðyp"), (3, "ðdo"),
)
CAPITAL = (
    (1, "BGW"), (1, "IJ"), (1, "UVꝞ"), (2, "CEGOT"), (2, "BDPRS"), (2, "LSJI"), (2, "ÞPY"), (2, "ÐDO"), (2, "ȜZYG"), (2, "ǷPW"),
    (3, "AHKMN"), (3, "OQG"), (3, "FIJLT"), (3, "XYZ"),
)
MARKS = (
    (1, "pꝑꝓꝕ"), (1, "PꝐꝒꝔ"), (1, "qꝗꝙ"), (1, "QꝖꝘ"), (1, "rꝛ"), (1, "RꝚ"), (2, "ꝝrꝛ"), (2, "ꝜRꝚ"), (1, "ꝫꝰꝯ⁊"), (1, "ꝪꝮ"), (1, "vꝟu"), (1, "VꝞU"),
)
# Costs of replacing one letter of a pair by the other.
PAIRS = (
    (0.1, "IJ UV VꝞ uv ij vꝟ ꝫꝪ ꝯꝮ"),
    (0.15, "UꝞ PꝐ QꝖ RꝚ fſ uꝟ nu pꝑ qꝗ rꝛ cC oO xX zZ"),
    (0.2, "BG BW GW ÞY ȜZ PꝒ PꝔ QꝘ ct nv þy pꝓ pꝕ qꝙ ꝫꝰ sS wW"),
    (0.25, "EC TC ÐD ǷP ꝐꝒ ꝖꝘ RꝜ ȝz ƿp ꝑꝓ ꝗꝙ rꝝ"),
    (0.3, "BR GC MN ÞP ȜY ǷW ꝚꝜ ꝪꝮ bl gq ao ec ðd ȝy ƿw ſs ꝛꝝ ꝛ2 ꝫꝯ ꝰꝯ"),
    (0.35, "GS DO DB TI PR FT HK NU ȜG bh hk gy au eo þp ȝg ꝫ⁊ ꝯ⁊"),
    (0.4, "SL ÐO li pq de da ðo ſl ꝫ3"),
    (0.5, "ꝫz ꝪZ"),
)
IN_SET = {1: 0.2, 2: 0.35, 3: 0.5}
SAME_TIER = 0.7
EDIT = 0.8
PREFIX_BONUS = {2: 0.3, 3: 0.8, 4: 1.5, 5: 2.0}
SUFFIX_BONUS = 0.5


def letter_sets() -> dict[str, tuple[int, str]]:
    """The set that each letter belongs to, with its tier.

    Of small letters' sets the last of the best tier has a letter, of capitals'
    the first, and marks of abbreviation only add letters that have none.
    """
    out: dict[str, tuple[int, str]] = {}
    for groups, takes in ((SMALL, lambda old, new: old >= new), (CAPITAL, lambda old, new: old > new), (MARKS, lambda old, new: False)):
        for tier, letters in groups:
            out |= {c: (tier, letters) for c in letters if c not in out or takes(out[c][0], tier)}
    return out


def pair_costs() -> dict[frozenset[str], float]:
    return {frozenset(pair): cost for cost, pairs in PAIRS for pair in pairs.split()}


_SETS, _PAIRS = letter_sets(), pair_costs()


def substitution_cost(a: str, b: str) -> float:
    """0 for the same letter, 0.1 for another case, a pair's cost (0.05 more across cases), a set's, 0.7 for sets of one tier, else 1."""
    if a == b:
        return 0.0
    small = a.lower(), b.lower()
    if small[0] == small[1]:
        return 0.1
    pair, low = frozenset((a, b)), frozenset(small)
    if pair in _PAIRS:
        return _PAIRS[pair]
    if low in _PAIRS:
        return _PAIRS[low] + 0.05
    (tier, letters), (other_tier, others) = _SETS.get(a, (0, a)), _SETS.get(b, (-1, b))
    if tier > 0 and sorted(letters) == sorted(others):
        return IN_SET[tier]
    return SAME_TIER if tier == other_tier else 1.0


def weighted_distance(a: str, b: str) -> float:
    """Edit distance with lookalike costs, less a bonus for a common beginning or end, in the same case; at least 0."""
    if not a or not b:
        return EDIT * (len(a) + len(b))
    row = [EDIT * j for j in range(len(b) + 1)]
    for i, x in enumerate(a, 1):
        above, row[0] = row[0], EDIT * i
        for j, y in enumerate(b, 1):
            above, row[j] = row[j], min(row[j] + EDIT, row[j - 1] + EDIT, above + substitution_cost(x, y))
    same = next((n for n in sorted(PREFIX_BONUS, reverse=True) if min(len(a), len(b)) >= n and a[:n] == b[:n]), 0)
    bonus = PREFIX_BONUS.get(same, 0.0) + (SUFFIX_BONUS if min(len(a), len(b)) >= 3 and a[-3:] == b[-3:] else 0.0)
    return max(0.0, row[-1] - bonus)


def ratio(a: str | None, b: str | None) -> float:
    """Share of matching stretches of two texts without white space and case; asymmetric, so the truth goes first."""
    a, b = "".join((a or "").split()).lower(), "".join((b or "").split()).lower()
    if not a and not b:
        return 1.0
    return SequenceMatcher(None, a, b).ratio() if a and b else 0.0


@F.pandas_udf(DoubleType())
def _ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([ratio(x, y) for x, y in zip(a, b)], dtype=float)


@F.pandas_udf(DoubleType())
def _weighted(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([weighted_distance(x or "", y or "") for x, y in zip(a, b)], dtype=float)


def sequence_ratio(truth: Column, other: Column) -> Column:
    return _ratio(truth, other)


def palaeographic_distance(a: Column, b: Column) -> Column:
    return _weighted(a, b)


def palaeographic_similarity(a: Column, b: Column) -> Column:
    """1 less the distance by the longer length, at least 0; two empty texts are equal, and one is like no other."""
    a, b = F.coalesce(a, F.lit("")), F.coalesce(b, F.lit(""))
    share = 1 - _weighted(a, b) / F.greatest(F.length(a), F.length(b), F.lit(1))
    return F.when((a == "") & (b == ""), 1.0).when((a == "") | (b == ""), 0.0).otherwise(F.greatest(F.lit(0.0), share))


def lookalikes(queries: DataFrame, query: str, candidates: DataFrame, candidate: str, by: list[str], threshold: float = 0.5) -> DataFrame:
    """Queries with the candidates of equal ``by`` that look at least so alike, with ``similarity``: an equi-join, then the similarity."""
    pairs = queries.join(candidates, by).withColumn("similarity", palaeographic_similarity(F.col(query), F.col(candidate)))
    return pairs.where(F.col("similarity") >= threshold)


def locate(entity: str, text: str, threshold: int = 80) -> tuple[int, int] | None:
    """[start, end) of an entity in a text: exactly, case aside, the most similar window, then the most similar word; None below the threshold."""
    if not entity or not text:
        return None
    for hay, needle in ((text, entity), (text.lower(), entity.lower())):
        at = hay.find(needle)
        if at >= 0:
            return at, at + len(entity)
    low, n = entity.lower(), len(entity)
    score = lambda s: 100 * SequenceMatcher(None, low, s.lower(), autojunk=False).ratio()
    windows = [(score(text[i:i + n]), -i, i + n) for i in range(max(1, len(text) - n + 1))]
    best = max(windows)
    if best[0] >= threshold:
        return -best[1], min(best[2], len(text))
    at, words = 0, []
    for w in text.split(" "):
        if w:
            words.append((score(w), -at, at + len(w)))
        at += len(w) + 1
    best = max(words, default=(0, 0, 0))
    return (-best[1], best[2]) if best[0] >= threshold else None


@F.pandas_udf(StructType([StructField("start", IntegerType()), StructField("end", IntegerType())]))
def _locate(entity: pd.Series, text: pd.Series) -> pd.DataFrame:
    found = [locate(e or "", t or "") for e, t in zip(entity, text)]
    return pd.DataFrame({"start": [f[0] if f else None for f in found], "end": [f[1] if f else None for f in found]}, dtype="Int32")


def entity_position(entity: Column, text: Column) -> Column:
    """struct(start, end) of an entity in a text, nulls if it is not there."""
    return _locate(entity, text)


def dot(a: Column, b: Column) -> Column:
    """Inner product in double precision."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two vectors; null if one is zero."""
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))
