"""Golden values of the scalar functions."""

import pytest
from pyspark.sql import functions as F

from quillframe.functions import calendar, similarity, text


def values(spark, f, inputs):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], "i int, x string")
    return [r[0] for r in df.orderBy("i").select(f(F.col("x"))).collect()]


@pytest.mark.parametrize("f,cases", [
    (text.phonetic_code, {"Ashcraft": "A226", "Tymczak": "T522", "Pfister": "P236", "Sawhill": "S400", "Schmidt": "S530", "": "", None: ""}),
    (text.without_particle, {"William de Warrene": "William Warrene", "de Lacy": "Lacy", "John De": "John", None: ""}),
    (text.money, {"£100": "100 pounds", "100l": "100 pounds", "10s 5d": "10 shillings", "40": "40 pounds", "1,000 pounds": "1000 pounds", "": "", None: ""}),
    (text.without_parentheses, {"Debt (account)": "Debt", "Debt": "Debt"}),
    (text.dates, {"1400-03-10 00:00:00 (initial)": "1400-03-10", "a; ;b": "a; b", None: ""}),
    (text.base_image, {"image_001_aug_2": "image_001", "x_aug_ab12cd34": "x_aug_ab12cd34"}),
    (text.last_word, {"John  Smith ": "Smith", "": "", None: ""}),
    (text.from_symbols, {"a b <space> c": "ab c", "": ""}),
    (text.forename, {"Sir JOHN Smith": "John", "mary (the elder)": "Mary", "o'brien-smith": "O'Brien-Smith", "x": None}),
    (text.unfenced, {"```json\n{}\n```": "{}", "{}": "{}"}),
    (text.latin_form, {"Johannes'": "iohannes", "Ujv": "uiu"}),
])
def test_text(spark, f, cases):
    assert values(spark, f, list(cases)) == list(cases.values())


def test_arrays(spark):
    assert values(spark, lambda x: text.symbol_ngrams(x, 2), ["a b<space>c", "a", "", None]) == [["ab", "b<space>", "<space>c"], [], [], []]
    assert values(spark, text.sentences, ["A b. C d! E?", "St. Paul came. J. Smith left.", ""]) == [["A b.", "C d!", "E?"], ["St. Paul came.", "J. Smith left."], []]
    assert values(spark, text.letter_variants, ["ui", ""]) == [["ui", "uj", "vi", "vj"], [""]]
    assert values(spark, lambda x: text.stems(x, ("us", "is")), ["Johannus", "is", "abcis"]) == [["johann"], [], ["abc"]]
    assert values(spark, text.edit_limit, ["abc", "abcde", "abcdef"]) == [0, 1, 2]
    part = lambda x: F.concat_ws("/", text.roll_number(x)["roll"], text.roll_number(x)["rotulus"])
    assert values(spark, part, ["CP 40-559 055-a.jpg", "none"]) == ["559/055", ""]


def test_calendar(spark):
    df = spark.createDataFrame([(n,) for n in (555, 556, 559, 609, 554)], "r int")
    year, term = calendar.roll_year(F.col("r")), calendar.roll_term(F.col("r"))
    got = [tuple(r) for r in df.select(year, term, calendar.regnal_year(year, term)).collect()]
    assert got == [
        (1399, "Michaelmas", "1 Henry IV"), (1400, "Hilary", "1 Henry IV"), (1400, "Michaelmas", "2 Henry IV"), (1413, "Easter", "1 Henry V"), (None, None, None),
    ]


def test_similarity(spark):
    assert similarity.ratio("tide", "diet") == 0.25 and similarity.ratio("diet", "tide") == 0.5
    assert similarity.ratio("", None) == 1.0 and similarity.ratio("a", "") == 0.0
    assert similarity.weighted_distance("", "abc") == pytest.approx(2.4)
    assert similarity.weighted_distance("Johannes", "Johannes") == 0.0
    assert similarity.locate("Smith", "John smith, clerk") == (5, 10)
    assert similarity.locate("Smyth", "John Smith") == (5, 10)
    assert similarity.locate("zzzz", "John Smith") is None
    df = spark.createDataFrame([([1.0, 0.0], [1.0, 0.0]), ([1.0, 0.0], [0.0, 0.0])], "a array<float>, b array<float>")
    assert [r[0] for r in df.select(similarity.cosine(F.col("a"), F.col("b"))).collect()] == [1.0, None]


@pytest.mark.parametrize("a,b,cost", [
    ("i", "j", 0.1), ("u", "v", 0.1), ("n", "u", 0.15), ("c", "t", 0.2), ("a", "o", 0.3), ("b", "l", 0.3), ("g", "q", 0.3), ("e", "o", 0.35), ("f", "t", 0.7),
    ("f", "ſ", 0.15), ("C", "T", 0.25), ("E", "t", 1.0), ("N", "v", 0.25), ("n", "ı", 0.2), ("i", "n", 0.7), ("B", "G", 0.2), ("A", "K", 0.5), ("x", "q", 1.0),
    ("q", "y", 0.7), ("m", "w", 0.7), ("a", "e", 0.7), ("s", "ʃ", 0.5), ("d", "đ", 0.35), ("y", "z", 0.35), ("g", "y", 0.35), ("B", "W", 0.2), ("D", "P", 0.35),
    ("k", "x", 0.7), ("ꝑ", "ꝕ", 0.2), ("2", "ꝛ", 0.3), ("c", "C", 0.1), ("1", "7", 1.0), ("þ", "ð", 0.7),
])
def test_letters_cost_what_hands_confuse(a, b, cost):
    assert similarity.substitution_cost(a, b) == similarity.substitution_cost(b, a) == pytest.approx(cost)


@pytest.mark.parametrize("a,b,distance", [("Ricardus", "ricardus", 0.0), ("cat", "cot", 0.3), ("Johannes", "Johames", 0.3), ("ab", "", 1.6), ("Wille", "Walle", 0.5), ("terra", "torra", 0.0), ("terra", "tirra", 0.5)])
def test_weighted_distances(a, b, distance):
    # prefixes and endings count in the same case: "Ricardus" and "ricardus" share their ending only
    assert similarity.weighted_distance(a, b) == pytest.approx(distance)
