"""Scalar columns used across the corpus tables."""

from functools import reduce

from pyspark.sql import Column, functions as F

# The characters that count as whitespace for strip() and split(), as the inside
# of a regular-expression class. Java's own \s is ASCII only.
WHITESPACE = r"\s\x0b\x1c-\x1f\x85\p{Z}"
# The same characters one by one.
WHITESPACE_CHARS = (
    "\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# A word, for counting: printable ASCII is tested first because most characters are, and what was
# matched is never given back.
_WORD = f"[!-~[^{WHITESPACE}]]++"

# Accent regions in the order in which they are tried, with the lower-case pieces
# that select them. 'us' also hits Australian and Russian, 'english' also New Zealand English.
ACCENT_REGIONS = [
    ("North American", ["american", "us", "california", "texas", "new york"]),
    ("British Isles", ["british", "english", "scottish", "welsh", "irish"]),
    ("Oceanic", ["australian", "new zealand"]),
    ("South Asian", ["indian", "south asian"]),
    ("African", ["african", "south african"]),
    ("East Asian", ["japanese", "chinese", "korean", "asian"]),
    ("European", ["european", "german", "french", "spanish", "italian"]),
]
OTHER_REGION = "Other"

# Character types in the order in which they are tried.
CHARACTER_TYPES = [
    ("young_character", ["young", "youthful", "teen", "child"]),
    ("adult_character", ["mature", "adult", "professional"]),
    ("friendly_character", ["warm", "friendly", "gentle"]),
    ("authoritative_character", ["deep", "powerful", "strong"]),
]
NEUTRAL_CHARACTER = "neutral_character"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def contains_any(text: Column, pieces: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [text.contains(p) for p in pieces])


def first_rule(text: Column, rules: list[tuple[str, list[str]]], default) -> Column:
    """The name of the first rule one of whose pieces occurs in ``text``."""
    names = iter(rules)
    name, pieces = next(names)
    chain = F.when(contains_any(text, pieces), F.lit(name))
    for name, pieces in names:
        chain = chain.when(contains_any(text, pieces), F.lit(name))
    return chain.otherwise(default if isinstance(default, Column) else F.lit(default))


def accent_region(c, rules=ACCENT_REGIONS, default=OTHER_REGION) -> Column:
    """Region of an accent; null stays null."""
    text = F.lower(_col(c))
    return F.when(text.isNotNull(), first_rule(text, rules, default))


def character_type(c, rules=CHARACTER_TYPES, default=NEUTRAL_CHARACTER) -> Column:
    """Character label of a description; null stays null."""
    text = F.lower(_col(c))
    return F.when(text.isNotNull(), first_rule(text, rules, default))


def char_length(c) -> Column:
    return F.length(_col(c))


def word_count(c) -> Column:
    """Number of whitespace-separated words: '' has none, null stays null."""
    return F.regexp_count(_col(c), F.lit(_WORD))


def words(c) -> Column:
    """The whitespace-separated words themselves, punctuation kept."""
    return F.regexp_extract_all(_col(c), F.lit(_WORD), F.lit(0))


def speaking_rate(word_col, duration_col) -> Column:
    """Words per minute; null where the duration is 0."""
    return F.try_divide(_col(word_col), _col(duration_col)) * F.lit(60.0)


def finite(c) -> Column:
    """Null out infinities and NaN."""
    c = _col(c)
    return F.when(F.abs(c) < F.lit(float("inf")), c)


def strip(c) -> Column:
    """Trim every kind of whitespace, not only U+0020."""
    return F.btrim(_col(c), F.lit(WHITESPACE_CHARS))


def title(c) -> Column:
    """'voice_analysis' -> 'Voice Analysis'."""
    return F.initcap(F.translate(_col(c), "_", " "))


def fmt_thousands(c) -> Column:
    return F.format_number(_col(c), 0)


def fmt_decimals(c, digits: int) -> Column:
    """Fixed decimals of the exact value with ties to even, for 0 or 1 digits.

    format_string rounds the shortest decimal that prints as the value, and half up: 142.5 would give
    143 and 0.35, which lies below its name, 0.4.
    """
    x = _col(c).cast("double")
    if digits == 0:
        return F.format_string("%.0f", F.bround(x, 0))
    if digits != 1:
        raise ValueError(f"digits must be 0 or 1: {digits}")
    whole = F.floor(x).cast("double")
    part = x - whole
    # ten times the fraction as a sum of two exact products, with what the sum lost
    tenths = part * 8.0 + part * 2.0
    lost = (part * 8.0 - (tenths - (tenths - part * 8.0))) + (part * 2.0 - (tenths - part * 8.0))
    low = F.floor(tenths).cast("double")
    above = tenths - low
    up = (above > 0.5) | ((above == 0.5) & ((lost > 0) | ((lost == 0) & (low % 2 == 1))))
    return F.format_string("%.1f", whole + (low + F.when(up, 1.0).otherwise(0.0)) / 10.0)


def fmt_padded(c, width: int) -> Column:
    return F.format_string(f"%0{width}d", _col(c))


def parse_ts(c) -> Column:
    """ISO-8601 text to timestamp; unreadable text gives null."""
    return F.try_to_timestamp(_col(c))


def hours(c) -> Column:
    return _col(c) / F.lit(3600.0)


def known(c, sentinel="unknown") -> Column:
    """``value != 'unknown'`` the way a null-tolerant comparison sees it: null counts as known."""
    return ~_col(c).eqNullSafe(F.lit(sentinel))


def basename(c) -> Column:
    """File name of a path with either kind of separator."""
    return F.regexp_extract(_col(c), r"([^/\\]+)$", 1)


def uniform(seed: int, key: Column) -> Column:
    """A uniform number in [0, 1) that depends only on the seed and the row's key."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def shuffle_key(seed: int, key: Column) -> Column:
    """Sort key of a random order that depends only on the seed and the row's key."""
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))
