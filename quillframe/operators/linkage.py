"""Record linkage: best matches, one-to-one assignments, and rules by which fields compare."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.similarity import sequence_ratio
from ..functions.text import dates, filled, last_word, money, phonetic_code, squeezed, without_parentheses, without_particle
from . import nearest

PARTY_WHOLE = 0.3  # of a party's score, what the whole names weigh


def best_in_block(left: DataFrame, right: DataFrame, block: str, left_id: str, right_id: str, score: Column, least: float, bound: Column | None = None) -> DataFrame:
    """Of each left row the right row of its block with the best score, at least ``least``; ties to the smaller right id.

    ``bound``, a native expression never below ``score``, saves scoring every
    pair: the pair of the highest bound is scored first, then only those whose
    bound reaches that score, so the result stays that of all pairs.
    """
    left = left.repartition(int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")), left_id)
    order = Window.partitionBy(left_id).orderBy(F.desc("score"), right_id)
    if bound is None:
        pairs = left.join(right, block).withColumn("score", score)
    else:
        columns = [c for c in right.columns if c != block]
        first = left.join(right, block).groupBy(*left.columns).agg(F.max_by(F.struct(*columns), bound).alias("__r"))
        reached = first.select(*left.columns, "__r.*").withColumn("__least", score - 1e-9).select(*left.columns, "__least")
        pairs = reached.join(right, block).where(bound >= F.greatest("__least", F.lit(least - 1e-9))).withColumn("score", score).drop("__least")
    return pairs.where(F.col("score") >= least).withColumn("__n", F.row_number().over(order)).where("__n = 1").drop("__n")


def best_by_text(left: DataFrame, right: DataFrame, block: str, left_id: str, right_id: str, left_text: str, right_text: str, score: Column, least: float, weight: float) -> DataFrame:
    """``best_in_block`` for a score of which the likeness of two texts (1 - edits / longer length) weighs ``weight`` and all else the rest, at most 1.

    The likest text's score is one that the best reaches, so only texts alike
    enough to reach it with all else at its most are scored. Ids name rows.
    """
    key, other = [block, left_id], [block, right_id]
    scored = lambda pairs: pairs.join(left, key).join(right, other).withColumn("score", score)
    reached = scored(nearest.alike_in_block(left, right, block, left_id, right_id, left_text, right_text))
    need = (F.greatest(F.col("score"), F.lit(least)) - 1e-9 - (1 - weight)) / weight
    asked = reached.select(block, left_id, left_text, need.alias("__need"))
    pairs = scored(nearest.alike_in_block(asked, right, block, left_id, right_id, left_text, right_text, "__need"))
    order = Window.partitionBy(left_id).orderBy(F.desc("score"), right_id)
    return pairs.where(F.col("score") >= least).withColumn("__n", F.row_number().over(order)).where("__n = 1").drop("__n")


def hungarian(scores: np.ndarray) -> list[tuple[int, int]]:
    """(row, column) pairs of the assignment with the largest sum, shortest augmenting paths; lower numbers on ties."""
    turned = scores.shape[0] > scores.shape[1]
    cost = -(scores.T if turned else scores)
    n, m = cost.shape
    u, v, match = np.zeros(n + 1), np.zeros(m + 1), np.zeros(m + 1, int)
    for i in range(1, n + 1):
        match[0], j0 = i, 0
        least, way, used = np.full(m + 1, np.inf), np.zeros(m + 1, int), np.zeros(m + 1, bool)
        while True:
            used[j0] = True
            i0 = match[j0]
            slack = cost[i0 - 1] - u[i0] - v[1:]
            better = ~used[1:] & (slack < least[1:])
            least[1:][better] = slack[better]
            way[1:][better] = j0
            j1 = int(np.where(used[1:], np.inf, least[1:]).argmin()) + 1
            delta = least[j1]
            u[match[used]] += delta
            v[used] -= delta
            least[~used] -= delta
            j0 = j1
            if not match[j0]:
                break
        while j0:
            match[j0], j0 = match[way[j0]], way[j0]
    pairs = [(match[j] - 1, j - 1) for j in range(1, m + 1) if match[j]]
    return sorted((j, i) if turned else (i, j) for i, j in pairs)


def greedy(scores: np.ndarray) -> list[tuple[int, int]]:
    """(row, column) pairs: rows in order take the best column left, the lower one on a tie."""
    left, out = set(range(scores.shape[1])), []
    for i in range(scores.shape[0]):
        if left:
            j = max(sorted(left), key=lambda c: scores[i, c])
            left.discard(j)
            out.append((i, j))
    return out


def assign(pairs: DataFrame, block: str, left: str, right: str, score: str, least: float, method: Callable = hungarian, strict: bool = False) -> DataFrame:
    """(block, left, right, score): one-to-one matches in every block that reach ``least`` (``strict``: exceed it).

    ``pairs`` has the scores of a block's pairs; a missing one counts as 0.
    Blocks are cases with a few dozen members each, so one fits a task.
    """
    kinds = {c: pairs.schema[c].dataType.simpleString() for c in (block, left, right)}

    def of(frame: pd.DataFrame) -> pd.DataFrame:
        table = frame.pivot_table(index=left, columns=right, values=score, aggfunc="max", fill_value=0.0)
        s = table.to_numpy(float)
        rows = [(frame[block].iat[0], table.index[i], table.columns[j], s[i, j]) for i, j in method(s) if (s[i, j] > least if strict else s[i, j] >= least)]
        return pd.DataFrame(rows, columns=[block, left, right, score])

    schema = f"`{block}` {kinds[block]}, `{left}` {kinds[left]}, `{right}` {kinds[right]}, `{score}` double"
    return pairs.select(block, left, right, score).groupBy(block).applyInPandas(of, schema)


def name_similarity(a: Column, b: Column) -> Column:
    """1 if the surnames sound alike or are nearly equal, else the ratio of the whole names."""
    sa, sb = last_word(a), last_word(b)
    code = phonetic_code(sa)
    alike = (code != "") & (code == phonetic_code(sb))
    unless = lambda done, x: F.when(~F.coalesce(done, F.lit(False)), x)  # noqa: E731  a UDF runs over all rows, so those it has no part in are null
    near = sequence_ratio(unless(alike, sa), unless(alike, sb)) >= 0.85
    done = alike | near
    return F.when(done, 1.0).otherwise(sequence_ratio(unless(done, a), unless(done, b)))


def ratio_bound(a: Column, b: Column) -> Column:
    """Never below ``sequence_ratio`` of squeezed texts: its matching stretches are a common subsequence, so edits bound them."""
    return 1 - F.levenshtein(a, b) / F.greatest(F.length(a) + F.length(b), F.lit(1))


def name_bound(code: Column, other_code: Column, surname: Column, other_surname: Column, whole: Column, other_whole: Column) -> Column:
    """Never below ``name_similarity``, from phonetic codes and squeezed surnames and names."""
    alike = ((code != "") & (code == other_code)) | (ratio_bound(surname, other_surname) >= 0.85 - 1e-9)
    return F.when(alike, 1.0).otherwise(ratio_bound(whole, other_whole))


def case_score(county: Column, damages: Column, writ: Column, names: Column) -> Column:
    """0.30 county, 0.25 damages, 0.15 writ type and 0.30 party names, each 0 to 1."""
    return 0.30 * county + 0.25 * damages + 0.15 * writ + 0.30 * names


def presence_score(a: Column, b: Column, similarity: Column) -> Column:
    """A field's part in a score: 0.5 where both sides lack it, 0 where one does."""
    a, b = filled(a), filled(b)
    return F.when((a == "") & (b == ""), 0.5).when((a == "") | (b == ""), 0.0).otherwise(similarity)


def party_score(name: Column, whole: Column) -> Column:
    return (1 - PARTY_WHOLE) * name + PARTY_WHOLE * whole


def _words(x: Column, least: int, besides: tuple[str, ...] = ()) -> Column:
    found = F.regexp_extract_all(F.lower(filled(x)), F.lit(r"(\w+)"), F.lit(1))
    return F.filter(found, lambda w: (F.length(w) >= least) & ~w.isin(*besides) if besides else F.length(w) >= least)


def compare_fields(df: DataFrame, truth: str, other: str, field: str) -> DataFrame:
    """``df`` with is_match, similarity and basis of each pair of field values, by rules in order of which the first that fits decides.

    Names match by sound or a near-equal surname; dates, places, case types,
    occupations, roles and event types by their own rules; then what one side
    lacks; then equality, or a ratio that reaches the field's threshold.
    """
    f, a, b = F.col(field), F.trim(filled(F.col(truth))), F.trim(filled(F.col(other)))
    is_ = lambda *names: f.isin(*names)
    x = F.when(is_("Event Date"), dates(a)).when(is_("Damages Claimed"), money(a)).when(is_("Writ Type"), without_parentheses(a)).otherwise(a)
    y = F.when(is_("Event Date"), dates(b)).when(is_("Damages Claimed"), money(b)).when(is_("Writ Type"), without_parentheses(b)).otherwise(b)
    full = (a != "") & (b != "")
    na, nb = last_word(without_particle(a)), last_word(without_particle(b))
    sound = is_("Agent Name") & full & (phonetic_code(na) != "") & (phonetic_code(na) == phonetic_code(nb))
    asked = is_("Agent Name") & full & ~sound
    near = asked & (sequence_ratio(F.when(asked, na), F.when(asked, nb)) >= 0.85)
    first = lambda s: F.regexp_extract(F.lower(s), r"(\w+)", 1)
    shared = lambda n, besides=(): F.arrays_overlap(_words(a, n, besides), _words(b, n, besides))
    special = (
        (is_("Event Place", "Agent Location") & full & ((first(a) == first(b)) | shared(4)))
        | (is_("Case Type") & full & ((first(a) == first(b)) | (F.lower(a).contains("detention") & (F.lower(b) == "detinue"))))
        | (is_("Agent Occupation") & full & shared(1, ("and",)))
        | (is_("Agent Role") & full & shared(4))
        | (is_("Event Type") & full & shared(5))
        | (is_("Agent Status", "Agent Occupation") & (a == "") & (b != ""))
        | (is_("Agent Location") & (F.lower(a) == "london") & (b == ""))
    )
    threshold = F.when(is_("Agent Name", "Event Place", "Agent Location"), 0.95).when(f.contains("Block"), 0.75).when(is_("Case Type"), 0.85).otherwise(0.90)
    basis = (
        F.when(sound, "soundex").when(near, "levenshtein")
        .when(is_("Event Date") & (x != "") & (x == y), "date_normalization")
        .when(special, "special_rule")
        .when((x == "") & (y == ""), "both_empty").when((x == "") | (y == ""), "one_empty")
        .when(squeezed(x) == squeezed(y), "exact_match").otherwise("ratio")
    )
    out = df.withColumn("basis", basis)
    left = F.col("basis") == "ratio"
    out = out.withColumn("__ratio", F.when(left, sequence_ratio(F.when(left, x), F.when(left, y))))
    sim = F.when(F.col("basis") == "one_empty", 0.0).when(F.col("basis") == "ratio", F.col("__ratio")).otherwise(1.0)
    return out.withColumn("similarity", sim).withColumn("is_match", F.col("similarity") >= threshold).drop("__ratio")
