"""Text normalisers as native column expressions.

All of them treat null as the empty text unless they say otherwise, so that a
missing value compares like an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_DIGITS_OF = ("AEIOUHWYBFPVCGJKQSXZDTLMNR", "00000000111122222222334556")


def filled(x: Column) -> Column:
    return F.coalesce(x, F.lit(""))


def squeezed(x: Column) -> Column:
    """Lower case without any white space."""
    return F.lower(F.regexp_replace(filled(x), r"(?U)\s+", ""))


def collapsed(x: Column) -> Column:
    """Runs of white space as one space, trimmed."""
    return F.trim(F.regexp_replace(filled(x), r"(?U)\s+", " "))


def without_particle(x: Column, particle: str = "de") -> Column:
    """A name without the particle between words, where a word ends it, and where a word begins with it."""
    x = F.regexp_replace(filled(x), rf"(?iU)\s+{particle}\s+", " ")
    x = F.regexp_replace(x, rf"(?iU)\s+{particle}\b", " ")
    return collapsed(F.regexp_replace(x, rf"(?iU)\b{particle}\s+", " "))


def last_word(x: Column) -> Column:
    """The last word; empty for none."""
    return F.coalesce(F.try_element_at(F.split(collapsed(x), " "), F.lit(-1)), F.lit(""))


def first_word(x: Column) -> Column:
    return F.substring_index(collapsed(x), " ", 1)


def joined(*parts: Column, by: str = ", ") -> Column:
    """The parts that are neither null nor blank, trimmed and joined."""
    return F.concat_ws(by, *[F.nullif(F.trim(p), F.lit("")) for p in parts])


def phonetic_code(x: Column) -> Column:
    """Initial and three digits; vowels and H, W, Y all separate equal digits. Empty for no letters."""
    letters = F.regexp_replace(F.upper(filled(x)), "[^A-Z]", "")
    digits = F.regexp_replace(F.translate(letters, *_DIGITS_OF), r"(.)\1+", "$1")
    tail = F.regexp_replace(F.substring(digits, F.lit(2), F.length(digits)), "0", "")
    return F.when(letters == "", F.lit("")).otherwise(F.rpad(F.concat(F.substring(letters, 1, 1), F.substring(tail, 1, 3)), 4, "0"))


def money(x: Column) -> Column:
    """The first number of a sum with its unit: a sign before l/s/d after it, before a word, else pounds. Empty if there is no number."""
    x = F.lower(F.regexp_replace(F.trim(filled(x)), ",", ""))
    number = F.regexp_extract(x, r"(\d+(?:\.\d+)?)", 1)
    suffix = F.regexp_extract(x, r"\d\s*(l|s|d)\b", 1)
    unit = (
        F.when(x.contains("£"), "pounds")
        .when(suffix == "l", "pounds").when(suffix == "s", "shillings").when(suffix == "d", "pence")
        .when(x.contains("pound"), "pounds").when(x.contains("shilling"), "shillings")
        .when(x.rlike("pence|penny"), "pence").when(x.contains("mark"), "marks")
        .otherwise("pounds")
    )
    return F.when(number == "", F.lit("")).otherwise(F.concat_ws(" ", number, unit))


def without_parentheses(x: Column) -> Column:
    """``Debt (account)`` as ``Debt``."""
    return F.trim(F.regexp_replace(filled(x), r"\s*\([^)]*\)", ""))


def dates(x: Column) -> Column:
    """The dates of a list cut by semicolons, without remarks in parentheses and times of day, joined by ``; ``."""
    one = lambda p: F.trim(F.regexp_replace(F.regexp_replace(p, r"\s*\([^)]*\)", ""), r"\s+\d{1,2}:\d{2}(:\d{2})?.*$", ""))
    return F.array_join(F.filter(F.transform(F.split(filled(x), ";"), one), lambda p: p != ""), "; ")


def sentences(x: Column) -> Column:
    """Sentences: cut at white space after . ! or ?, but not after an initial or a two-letter title like ``St.``."""
    cut = F.split(F.trim(filled(x)), r"(?<!\b[A-Z][a-z]\.)(?<!\b[A-Z]\.)(?<=[.!?])\s+")
    return F.filter(cut, lambda s: s != "")


def from_symbols(x: Column) -> Column:
    """Recogniser output, characters apart and ``<space>`` for a space, as text."""
    return collapsed(F.replace(F.regexp_replace(F.replace(filled(x), F.lit("<space>"), F.lit("\u0001")), " ", ""), F.lit("\u0001"), F.lit(" ")))


def to_symbols(x: Column) -> Column:
    """The characters of a text as symbols, ``<space>`` for a space; none for an empty text."""
    chars = F.filter(F.split(filled(x), ""), lambda c: c != "")
    return F.transform(chars, lambda c: F.when(c == " ", F.lit("<space>")).otherwise(c))


def symbol_ngrams(x: Column, n: int) -> Column:
    """Runs of n symbols of a symbol text, ``<...>`` counting as one and spaces as none."""
    symbols = F.regexp_extract_all(filled(x), F.lit(r"(<[^>]*>|[^ ])"), F.lit(1))
    starts = F.when(F.size(symbols) >= n, F.sequence(F.lit(1), F.greatest(F.size(symbols) - n + 1, F.lit(1)))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.array_join(F.slice(symbols, i, n), ""))


def latin_form(x: Column) -> Column:
    """A Latin form for comparison: lower case, j as i, v as u, without marks of abbreviation."""
    return F.translate(F.lower(filled(x)), "jvãẽĩõũñ'`’", "iuaeioun")


def letter_variants(x: Column) -> Column:
    """All spellings by i/j and u/v, sorted, the given one included."""
    swap = {"i": "j", "j": "i", "u": "v", "v": "u", "I": "J", "J": "I", "U": "V", "V": "U"}
    table = F.create_map(*[F.lit(s) for pair in swap.items() for s in pair])
    grown = F.aggregate(
        F.filter(F.split(filled(x), ""), lambda c: c != ""), F.array(F.lit("")),
        lambda acc, c: F.flatten(F.transform(
            F.when(F.element_at(table, c).isNull(), F.array(c)).otherwise(F.array(c, F.element_at(table, c))),
            lambda s: F.transform(acc, lambda a: F.concat(a, s)),
        )),
    )
    return F.array_sort(F.array_distinct(grown))


def stems(x: Column, endings: tuple[str, ...]) -> Column:
    """What stays of a word of at least three letters more than an ending, for each ending it has."""
    x = F.lower(filled(x))
    each = [F.when(x.endswith(e) & (F.length(x) >= len(e) + 3), F.substring(x, F.lit(1), F.length(x) - len(e))) for e in endings]
    return F.array_distinct(F.filter(F.array(*each), lambda s: s.isNotNull()))


def capitalised(x: Column) -> Column:
    """Every run of letters with a capital first, also after an apostrophe or hyphen."""
    runs = F.regexp_extract_all(filled(x), F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(1))
    return F.array_join(F.transform(runs, F.initcap), "")


def forename(x: Column, titles: tuple[str, ...] = ("sir", "dame", "master", "lady", "lord")) -> Column:
    """The forename of a full name: no title, remark or punctuation, capitalised; null if under two letters."""
    x = F.regexp_replace(F.regexp_replace(filled(x), r"\([^)]*\)", " "), rf"(?i)^\s*(?:{'|'.join(titles)})\s+", "")
    name = F.regexp_replace(first_word(x), r"[.,;:]+", "")
    return F.when((F.length(name) >= 2) & name.rlike(r"^\p{L}"), capitalised(name))


def base_image(x: Column) -> Column:
    """An image's name without the number of its augmentation."""
    return F.regexp_replace(x, r"_aug_\d+$", "")


def safe_key(x: Column) -> Column:
    return F.regexp_replace(filled(x), r"[^A-Za-z0-9_-]", "_")


def shortened(x: Column, n: int) -> Column:
    return F.when(F.length(x) > n, F.concat(F.substring(x, 1, n), F.lit("..."))).otherwise(x)


def unfenced(x: Column) -> Column:
    """A JSON text without the code fence around it."""
    return F.trim(F.regexp_replace(F.regexp_replace(filled(x), r"^\s*```[a-zA-Z]*\s*", ""), r"\s*```\s*$", ""))


def roll_number(x: Column) -> Column:
    """struct(roll, rotulus) of a file name such as ``CP 40-559 055-a.jpg`` or ``CP40_559_055``; nulls where it has neither."""
    named = r"(?i)CP\s*40[-_ /](\d+)[-_ ]+(\d+)"
    plain = r"^(\d{3})[-_ ](\d+)"
    take = lambda g: F.coalesce(F.nullif(F.regexp_extract(x, named, g), F.lit("")), F.nullif(F.regexp_extract(x, plain, g), F.lit("")))
    return F.struct(take(1).alias("roll"), take(2).alias("rotulus"))


def levenshtein_similarity(a: Column, b: Column) -> Column:
    """1 - distance / longer length; two empty texts are equal."""
    longest = F.greatest(F.length(filled(a)), F.length(filled(b)))
    return F.when(longest == 0, F.lit(1.0)).otherwise(1 - F.levenshtein(filled(a), filled(b)) / longest)


def edit_limit(x: Column) -> Column:
    """Edits allowed in a word: none up to 3 letters, one up to 5, else two."""
    return F.when(F.length(x) <= 3, 0).when(F.length(x) <= 5, 1).otherwise(2)


def length_ratio_fits(candidate: Column, original: Column, low: float = 0.7, high: float = 1.4) -> Column:
    ratio = F.try_divide(F.length(candidate), F.length(original))
    return F.coalesce(ratio.between(low, high), F.lit(False))


def generic_place(x: Column, name: str = "england") -> Column:
    return F.lower(F.regexp_replace(filled(x), "[, ]", "")) == name


def plain_token(x: Column) -> Column:
    """Whether a text can be one token of a language model: not empty, no white space."""
    return F.coalesce(x.rlike(r"^\S+$"), F.lit(False))
