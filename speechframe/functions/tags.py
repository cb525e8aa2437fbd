"""Parsing of tagged annotator output: GENDER / AGE / ACCENT / VOICE_PROFILE."""

from pyspark.sql import Column, functions as F

from speechframe.functions.scalars import WHITESPACE, _col, contains_any, first_rule, strip
from speechframe.schemas import UNKNOWN

# Age bands in the order in which they are tried.
AGE_BANDS = [
    ("teens", ["teen", "10", "15", "16", "17", "18", "19"]),
    ("twenties", ["twenties", "20"]),
    ("thirties", ["thirties", "30"]),
    ("forties", ["forties", "40"]),
    ("fifties+", ["fifties", "50", "older", "elder"]),
]
# Fixed values: 'female' contains 'male' and 'woman' contains 'man', so the order matters.
GENDERS = [("female", ["female", "woman"]), ("male", ["male", "man"])]
NO_ACCENT = ["neutral", "unknown", "none"]
DEFAULT_ACCENT = "General American"


def tag_value(c, name: str) -> Column:
    """Stripped value of a tag line, null without the tag. The blank after the colon may swallow newlines."""
    pattern = rf"(?i){name}:[{WHITESPACE}]*([^\n]+)"
    # The whole text is searched once; the value is then cut out of the short hit, which is never empty.
    hit = F.nullif(F.regexp_extract(_col(c), pattern, 0), F.lit(""))
    return strip(F.regexp_extract(hit, pattern, 1))


def gender_of(value) -> Column:
    """Gender from the value of a GENDER tag; 'unknown' where the tag was absent."""
    value = F.lower(_col(value))
    return F.when(value.isNotNull(), first_rule(value, GENDERS, value)).otherwise(UNKNOWN)


def age_of(value) -> Column:
    value = F.lower(_col(value))
    return F.when(value.isNotNull(), first_rule(value, AGE_BANDS, value)).otherwise(UNKNOWN)


def accent_of(value) -> Column:
    value = _col(value)
    kept = F.when(contains_any(F.lower(value), NO_ACCENT), F.lit(DEFAULT_ACCENT)).otherwise(value)
    return F.when(value.isNotNull(), kept).otherwise(UNKNOWN)


def parse_gender(c) -> Column:
    return gender_of(tag_value(c, "GENDER"))


def parse_age(c) -> Column:
    return age_of(tag_value(c, "AGE"))


def parse_accent(c) -> Column:
    return accent_of(tag_value(c, "ACCENT"))


def parse_profile(c) -> Column:
    """The text behind VOICE_PROFILE:, or without that tag the text minus its tag lines."""
    text = _col(c)
    pattern = rf"(?ius)VOICE_PROFILE:[{WHITESPACE}]*(.+)"
    hit = F.nullif(F.regexp_extract(text, pattern, 0), F.lit(""))
    cleaned = F.regexp_replace(text, rf"(?i)(GENDER|AGE|ACCENT):[{WHITESPACE}]*[^\n]*\n?", "")
    return F.coalesce(strip(F.regexp_extract(hit, pattern, 1)), strip(cleaned))
