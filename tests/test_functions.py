"""Column functions: the traps of null, case, order and whitespace."""

import pytest
from pyspark.sql import functions as F

from speechframe.functions import scalars, tags
from speechframe.operators.annotate import fill_metadata, parse_response


def column(spark, rows, kind="string"):
    return spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, c {kind}")


def apply(spark, function, rows, kind="string"):
    return [r[0] for r in column(spark, rows, kind).select("i", function("c").alias("v")).orderBy("i").select("v").collect()]


@pytest.mark.parametrize(
    "accent, region",
    [
        ("General American", "North American"),
        ("Australian English", "North American"),  # contains 'us'
        ("Russian", "North American"),
        ("British RP", "British Isles"),
        ("New Zealand English", "British Isles"),
        ("New Zealand", "Oceanic"),
        ("Indian", "South Asian"),
        ("South African", "African"),
        ("Japanese", "East Asian"),
        ("Caucasian", "East Asian"),
        ("German", "European"),
        ("Brazilian", "Other"),
        ("unknown", "Other"),
        (None, None),
    ],
)
def test_accent_region(spark, accent, region):
    assert apply(spark, scalars.accent_region, [accent]) == [region]


def test_accent_region_takes_another_rule_table(spark):
    rules = [("Southern", ["australian", "zealand"])]
    assert apply(spark, lambda c: scalars.accent_region(c, rules, "Rest"), ["Australian", "Irish"]) == ["Southern", "Rest"]


def test_character_type(spark):
    texts = ["A Youthful, warm tone", "mature and deep", "Gentle but strong", "Powerful", "plain", "", None]
    got = apply(spark, scalars.character_type, texts)
    assert got == ["young_character", "adult_character", "friendly_character", "authoritative_character", "neutral_character", "neutral_character", None]


def test_word_count_and_words(spark):
    rows = ["", " a b ", "one\u00a0two\u3000three", "tab\there\x1fnow", None, "été über"]
    assert apply(spark, scalars.word_count, rows) == [0, 2, 3, 3, None, 2]
    assert [None if r is None else len(r.split()) for r in rows] == [0, 2, 3, 3, None, 2]
    assert apply(spark, scalars.words, ["  Warm, clear.\n"]) == [["Warm,", "clear."]]


def test_strip_equals_python(spark):
    rows = ["  a ", "\u2003b\u00a0", "\x1c\x85c d\u2028", "", " \t\n", "d\u200b", "\ufeffe"]
    assert apply(spark, scalars.strip, rows) == [r.strip() for r in rows]


def test_whitespace_constants_agree():
    every = {chr(i) for i in range(0x110000) if chr(i).isspace()}
    assert set(scalars.WHITESPACE_CHARS) == every


def test_rate_finite_hours(spark):
    df = spark.createDataFrame([(10, 5.0), (10, 0.0), (0, 0.0), (None, 1.0)], "w int, d double")
    got = [r[0] for r in df.select(scalars.speaking_rate("w", "d")).collect()]
    assert got == [120.0, None, None, None]
    assert apply(spark, scalars.finite, [1.0, float("inf"), float("-inf"), float("nan"), None], "double") == [1.0, None, None, None, None]


def test_number_formats(spark):
    numbers = [0.05, 0.15, 0.25, 0.35, 0.45, 0.95, 2.5, 7.96, 20238.65, 142.5, 1.25, 99.95, 1e6 + 0.25]
    assert apply(spark, lambda c: scalars.fmt_decimals(c, 1), numbers, "double") == [f"{n:.1f}" for n in numbers]
    assert apply(spark, lambda c: scalars.fmt_decimals(c, 0), [142.5, 143.5, 0.4], "double") == ["142", "144", "0"]
    assert apply(spark, scalars.fmt_thousands, [1234567], "long") == ["1,234,567"]
    assert apply(spark, lambda c: scalars.fmt_padded(c, 6), [42], "long") == ["000042"]
    with pytest.raises(ValueError):
        scalars.fmt_decimals(F.col("c"), 2)


def test_title_and_timestamps(spark):
    assert apply(spark, scalars.title, ["voice_analysis"]) == ["Voice Analysis"]
    stamps = apply(spark, scalars.parse_ts, ["2025-06-01T10:20:30.123456", "yesterday", None])
    assert stamps[0].isoformat() == "2025-06-01T10:20:30.123456" and stamps[1:] == [None, None]


def test_basename(spark):
    rows = ["E:\\out\\a\\x_1.wav", "/data/b/y.wav", "z.wav", "dir/", None]
    assert apply(spark, scalars.basename, rows) == ["x_1.wav", "y.wav", "z.wav", "", None]


def test_known_counts_null(spark):
    assert apply(spark, scalars.known, ["unknown", None, "male", "Unknown"]) == [False, True, True, True]


def test_hash_choices_do_not_depend_on_partitions(spark):
    df = spark.range(1000)
    draw = lambda d: {r.id: r.u for r in d.select("id", scalars.uniform(3, F.col("id")).alias("u")).collect()}
    one = draw(df.repartition(1))
    assert one == draw(df.repartition(17))
    assert all(0 <= u < 1 for u in one.values()) and 0.45 < sum(one.values()) / 1000 < 0.55


# --- tags ----------------------------------------------------------------------------------------


@pytest.mark.parametrize(
    "text, gender",
    [
        ("GENDER: Female", "female"),
        ("gender: a man", "male"),
        ("GENDER: Woman", "female"),
        ("GENDER: German", "male"),
        ("GENDER: non-binary ", "non-binary"),
        ("GENDER: \nAGE: 1950s", "age: 1950s"),  # the blank swallows the line end
        ("GENDER:  \n", ""),
        ("no tag", "unknown"),
        (None, "unknown"),
    ],
)
def test_parse_gender(spark, text, gender):
    assert apply(spark, tags.parse_gender, [text]) == [gender]


@pytest.mark.parametrize(
    "text, age",
    [
        ("AGE: early twenties", "twenties"),
        ("AGE: 35", "35"),
        ("AGE: 1950s", "teens"),  # contains 19
        ("LANGUAGE: 20 ", "twenties"),  # contains AGE:
        ("AGE: fourties", "fourties"),
        ("AGE: forties", "forties"),
        ("AGE: elderly", "fifties+"),
        ("AGE: sixteen to 19", "teens"),
        ("", "unknown"),
    ],
)
def test_parse_age(spark, text, age):
    assert apply(spark, tags.parse_age, [text]) == [age]


def test_parse_accent(spark):
    rows = ["ACCENT: Neutral", "accent:  British RP ", "ACCENT: none given", "ACCENT: \n\nVOICE_PROFILE:  ", "x", "ACCENT: Unknown"]
    assert apply(spark, tags.parse_accent, rows) == ["General American", "British RP", "General American", "VOICE_PROFILE:", "unknown", "General American"]


def test_parse_profile(spark):
    rows = [
        "GENDER: x\nVOICE_PROFILE: warm\nand deep \n",
        "voice_profile:\n clear",
        "AGE: 20\nrest\n",
        "ACCENT: a\nVOICE_PROFILE:",
        "VOICE_PROFILE:  ",
        "  plain  ",
    ]
    assert apply(spark, tags.parse_profile, rows) == ["warm\nand deep", "clear", "rest", "VOICE_PROFILE:", "", "plain"]


def test_parse_response_leaves_globe_alone(spark):
    df = spark.createDataFrame([("globe_v2", " GENDER: male "), ("laions", "GENDER: male"), ("laions", None)], "dataset string, response string")
    got = [tuple(r) for r in parse_response(df).select("parsed_gender", "parsed_age", "parsed_profile").collect()]
    assert got == [("unknown", "unknown", "GENDER: male"), ("male", "unknown", ""), ("unknown", "unknown", None)]


def test_fill_metadata_keeps_nulls_and_known_values(spark):
    rows = [("laions", "unknown"), ("laions", None), ("laions", "male"), ("globe_v2", "unknown")]
    df = spark.createDataFrame([(d, g, "GENDER: female\nAGE: 30s\nVOICE_PROFILE: soft") for d, g in rows], "dataset string, gender string, voice_description string")
    got = [tuple(r) for r in fill_metadata(df).select("gender", "age", "voice_description").collect()]
    plain = "GENDER: female\nAGE: 30s\nVOICE_PROFILE: soft"
    assert got == [("female", "thirties", "soft"), (None, "thirties", "soft"), ("male", "thirties", "soft"), ("unknown", None, plain)]
