"""Entity resolution: candidates by edit distance, Bayesian scores, and the choice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.similarity import entity_position
from ..functions.text import edit_limit, filled, length_ratio_fits, stems


def deletions(term: Column, edits: int = 2) -> Column:
    """The term and what is left of it after up to two deletions, distinct."""
    one = lambda t: F.transform(
        F.when(F.length(t) > 0, F.sequence(F.lit(1), F.greatest(F.length(t), F.lit(1)))).otherwise(F.array().cast("array<int>")),
        lambda i: F.concat(F.substring(t, F.lit(1), i - 1), F.substring(t, i + 1, F.length(t))),
    )
    keys = F.array(term)
    if edits > 0:
        keys = F.array_union(keys, one(term))
    if edits > 1:
        keys = F.array_union(keys, F.flatten(F.transform(one(term), one)))
    return F.array_distinct(keys)


def delete_keys(vocabulary: DataFrame, term: str, edits: int = 2) -> DataFrame:
    """The dictionary of a vocabulary: a row for each key of each term, to be kept as a table and reused.

    A term has as many letters left out as the longest word it can be found by allows.
    """
    return vocabulary.withColumn("key", F.explode(_keys(F.lower(term), edit_limit(F.concat(F.col(term), F.lit("  "))), edits)))


def _keys(term: Column, limit: Column, edits: int) -> Column:
    """Deletion keys of a term with at most ``limit`` letters left out, and at most ``edits``."""
    keys = F.when(limit <= 0, deletions(term, 0))
    for n in range(1, edits):
        keys = keys.when(limit <= n, deletions(term, n))
    return keys.otherwise(deletions(term, edits))


def edit_candidates(queries: DataFrame, query: str, dictionary: DataFrame, term: str, edits: int = 2, ratio: bool = False) -> DataFrame:
    """Queries with the terms within the edits allowed for their length: an equi-join on deletion keys, then the true distance.

    ``dictionary`` comes from ``delete_keys`` with as many edits. Distance is
    Levenshtein on lower case; ``ratio`` asks for similar lengths too.
    """
    q = queries.withColumn("__key", F.explode(_keys(F.lower(query), edit_limit(F.col(query)), edits)))
    pairs = q.join(dictionary, q["__key"] == dictionary["key"]).drop("__key", "key")
    distance = F.levenshtein(F.lower(query), F.lower(term))
    pairs = pairs.withColumn("distance", distance).where(F.col("distance") <= F.least(edit_limit(F.col(query)), F.lit(edits)))
    pairs = pairs.dropDuplicates([*queries.columns, term])
    return pairs.where(length_ratio_fits(F.col(term), F.col(query))) if ratio else pairs


def i_j_distance(a: Column, b: Column) -> Column:
    """Edit distance on lower case, also with j written i, whichever is less."""
    low = lambda x: F.lower(filled(x))
    return F.least(F.levenshtein(low(a), low(b)), F.levenshtein(F.replace(low(a), F.lit("j"), F.lit("i")), F.replace(low(b), F.lit("j"), F.lit("i"))))


def nearest_terms(candidates: DataFrame, entity: str, term: str, frequency: str, keep: int = 50) -> DataFrame:
    """Of each entity the ``keep`` candidates nearest, then most frequent, ties by term."""
    order = Window.partitionBy(entity).orderBy("distance", F.desc(frequency), term)
    return candidates.withColumn("place", F.row_number().over(order)).where(F.col("place") <= keep)


def log_prior(frequency: Column, total: Column, kinds: Column, alpha: float = 1.0) -> Column:
    """Laplace-smoothed log-probability; an empty dictionary counts as one."""
    total = F.when(F.coalesce(total, F.lit(0)) == 0, F.lit(1)).otherwise(total)
    return F.log((F.coalesce(frequency, F.lit(0)) + alpha) / (total + alpha * kinds))


def select_best(
    candidates: DataFrame, entity: str, term: str, frequency: str, likelihood: Column | None = None, original: Column | None = None,
    declension_fits: Column | None = None, total: int = 0, kinds: int = 0, weight_likelihood: float = 1.0, weight_prior: float = 1.0,
) -> DataFrame:
    """``candidates`` with log_prior, score, probability (softmax within an entity) and rank, the best first.

    Score: weighted likelihood and prior, 0.5 more for the original reading,
    1.5 less for each edit, 0.5 less for a forename in the wrong case. Without
    likelihoods only frequencies and distances count. Ties go to the term first
    by name.
    """
    score = weight_prior * F.col("log_prior") - 1.5 * F.col("distance")
    if likelihood is not None:
        score = score + weight_likelihood * F.coalesce(likelihood, F.lit(0.0))
    if original is not None:
        score = score + F.when(original, 0.5).otherwise(0.0)
    if declension_fits is not None:
        score = score - F.when(declension_fits, 0.0).otherwise(0.5)
    w = Window.partitionBy(entity)
    out = candidates.withColumn("log_prior", log_prior(F.col(frequency), F.lit(total), F.lit(kinds))).withColumn("score", score)
    out = out.withColumn("__e", F.exp(F.col("score") - F.max("score").over(w)))
    return out.withColumn("probability", F.col("__e") / F.sum("__e").over(w)).drop("__e").withColumn(
        "rank", F.row_number().over(w.orderBy(F.desc("score"), term))
    )


def low_confidence(scored: DataFrame, entity: str, term: str, below: float = 0.9, alternatives: int = 3) -> DataFrame:
    """(entity, best, probability, others): entities whose best candidate is less than sure, with the next ones in order."""
    near = scored.where(F.col("rank") <= alternatives + 1)
    others = F.transform(F.array_sort(F.collect_list(F.when(F.col("rank") > 1, F.struct("rank", term)))), lambda s: s[term])
    out = near.groupBy(entity).agg(
        F.max(F.when(F.col("rank") == 1, F.col(term))).alias("best"), F.max(F.when(F.col("rank") == 1, F.col("probability"))).alias("probability"),
        others.alias("others"),
    )
    return out.where(F.col("probability") < below)


def substituted(text: Column, pairs: Column) -> Column:
    """A text with every original of an array of structs (original, corrected) replaced by its correction, one after the other."""
    return F.aggregate(pairs, text, lambda t, p: F.when(F.length(p["original"]) > 0, F.replace(t, p["original"], p["corrected"])).otherwise(t))


def typed_dictionary(forms: DataFrame, edits: int = 2) -> DataFrame:
    """Deletion keys of forms (kind, form, english, declension, n), one row for each form, English name and declension with its largest n; to be kept as a table."""
    best = forms.groupBy("kind", "form", "english", "declension").agg(F.max("n").alias("n"))
    return delete_keys(best, "form", edits)


def typed_candidates(
    entities: DataFrame, dictionary: DataFrame, endings: tuple[str, ...] = (), edits: int = 2, keep: int = 50,
) -> DataFrame:
    """(entity, kind, text, term, english, distance, n, origin, place): candidates of entities (entity, kind, text, declension) of their own kind.

    ``origin`` says how a form was first found: ``exact`` (in the entity's
    declension, where it has one), ``english`` (by the English name), ``edit``
    (within the edits allowed for the text's length, j also written i), or
    ``stem`` (beginning with what is left of the text without an ending, within
    two edits). Of each form the nearest finding stays; nearest, then most
    frequent first. All joins are by kind and an equal key.
    """
    forms = dictionary.drop("key").distinct().withColumnsRenamed({"kind": "__kind", "declension": "__declension"})
    low = lambda c: F.lower(filled(F.col(c)))
    of_kind = F.col("kind") == F.col("__kind")
    fits = F.col("declension").isNull() | F.col("__declension").isNull() | (F.col("declension") == F.col("__declension"))
    columns = ["entity", "kind", "text", "form", "english", "n", "distance", "origin", "__rank"]

    def found(pairs: DataFrame, origin: str, rank: int) -> DataFrame:
        pairs = pairs.withColumn("distance", i_j_distance(F.col("text"), F.col("form")))
        return pairs.withColumn("origin", F.lit(origin)).withColumn("__rank", F.lit(rank)).select(*columns)

    exact = found(entities.join(forms, of_kind & (low("text") == low("form"))).where(fits), "exact", 0)
    english = found(entities.join(forms, of_kind & (low("text") == low("english"))), "english", 1)
    swapped = F.array_distinct(F.array(low("text"), F.replace(low("text"), F.lit("j"), F.lit("i"))))
    q = entities.withColumn("__t", F.explode(swapped)).withColumn("__key", F.explode(_keys(F.col("__t"), edit_limit(F.col("text")), edits)))
    keyed = dictionary.withColumnsRenamed({"kind": "__kind", "declension": "__declension"})
    edit = found(q.join(keyed, of_kind & (F.col("__key") == F.col("key"))), "edit", 2)
    edit = edit.where(F.col("distance") <= F.least(edit_limit(F.col("text")), F.lit(edits)))
    out = exact.unionByName(english).unionByName(edit)
    if endings:
        cut = entities.withColumn("__stem", F.explode(stems(F.col("text"), endings)))
        beginnings = F.transform(F.sequence(F.lit(1), F.greatest(F.length("form"), F.lit(1))), lambda n: F.substring(F.lower("form"), F.lit(1), n))
        begun = forms.withColumn("__begin", F.explode(beginnings))
        out = out.unionByName(found(cut.join(begun, of_kind & (F.col("__stem") == F.col("__begin"))), "stem", 3).where(F.col("distance") <= 2))
    order = F.struct("distance", "__rank", (-F.col("n")).alias("m"), "english")
    best = out.groupBy("entity", "kind", "text", F.col("form").alias("term")).agg(F.min_by(F.struct("english", "distance", "n", "origin"), order).alias("x"))
    best = best.select("entity", "kind", "text", "term", "x.*")
    return nearest_terms(best, "entity", "term", "n", keep)


def applied(entities: DataFrame, best: DataFrame, line: str, as_written: tuple[str, ...] = ("forename",)) -> DataFrame:
    """Entities (entity, kind, text, and the ``line`` they stand in) with ``start``, ``end``, ``original`` as the line has it, ``corrected`` and ``status``.

    ``best`` has (entity, term). ``status`` is ``bayesian_corrected`` where the
    term differs from what the line has, in case too for kinds ``as_written``,
    else ``original``; an entity without a candidate or a place keeps its text.
    """
    found = entities.join(best.select("entity", "term"), "entity", "left").withColumn("__at", entity_position(F.col("text"), F.col(line)))
    found = found.withColumn("start", F.col("__at.start")).withColumn("end", F.col("__at.end"))
    found = found.withColumn("original", F.coalesce(F.substring(F.col(line), F.col("start") + 1, F.col("end") - F.col("start")), F.col("text")))
    found = found.withColumn("corrected", F.coalesce("term", "original"))
    same = F.when(F.col("kind").isin(*as_written), F.col("corrected") == F.col("original")).otherwise(F.lower("corrected") == F.lower("original"))
    return found.withColumn("status", F.when(same, "original").otherwise("bayesian_corrected")).drop("__at", "term")


def rescored(stored: DataFrame, fresh: DataFrame, key: list[str], value: str) -> DataFrame:
    """Stored results whose ``value`` is null get it from ``fresh``, all others stay; ``rescored`` says which."""
    new = fresh.select(*key, F.col(value).alias("__new"))
    out = stored.join(new, key, "left").withColumn("rescored", F.col(value).isNull() & F.col("__new").isNotNull())
    return out.withColumn(value, F.coalesce(value, "__new")).select(*stored.columns, "rescored")
