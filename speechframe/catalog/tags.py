"""Tag parsing."""

from pyspark.sql import functions as F

from speechframe.catalog.base import SQL_WS, Catalog, responses, sql_strip, with_views
from speechframe.functions.tags import parse_accent, parse_age, parse_gender, parse_profile
from speechframe.operators.annotate import fill_metadata, parse_response

CATALOG = Catalog()
add = CATALOG.add


def tag(name):
    pattern = rf"(?i){name}:{SQL_WS}*([^\n]+)"
    value = sql_strip(f"regexp_extract(response, '{pattern}', 1)")
    return f"regexp_matches(response, '{pattern}')", value


def has(value, *pieces):
    return "(" + " OR ".join(f"contains({value}, '{p}')" for p in pieces) + ")"


def gender_sql():
    found, value = tag("GENDER")
    v = f"lower({value})"
    return f"CASE WHEN NOT coalesce({found}, false) THEN 'unknown' WHEN {has(v, 'female', 'woman')} THEN 'female' WHEN {has(v, 'male', 'man')} THEN 'male' ELSE {v} END"


def age_sql():
    found, value = tag("AGE")
    v = f"lower({value})"
    return f"""CASE WHEN NOT coalesce({found}, false) THEN 'unknown' WHEN {has(v, 'teen', '10', '15', '16', '17', '18', '19')} THEN 'teens'
      WHEN {has(v, 'twenties', '20')} THEN 'twenties' WHEN {has(v, 'thirties', '30')} THEN 'thirties' WHEN {has(v, 'forties', '40')} THEN 'forties'
      WHEN {has(v, 'fifties', '50', 'older', 'elder')} THEN 'fifties+' ELSE {v} END"""


def accent_sql():
    found, value = tag("ACCENT")
    return f"CASE WHEN NOT coalesce({found}, false) THEN 'unknown' WHEN {has(f'lower({value})', 'neutral', 'unknown', 'none')} THEN 'General American' ELSE {value} END"


def profile_sql():
    pattern = rf"(?is)VOICE_PROFILE:{SQL_WS}*(.+)"
    cleaned = rf"regexp_replace(response, '(?i)(GENDER|AGE|ACCENT):{SQL_WS}*[^\n]*\n?', '', 'g')"
    return f"CASE WHEN regexp_matches(response, '{pattern}') THEN {sql_strip(f'''regexp_extract(response, '{pattern}', 1)''')} ELSE {sql_strip(cleaned)} END"


SQL = {"gender": gender_sql(), "age": age_sql(), "accent": accent_sql(), "profile": profile_sql()}
for name, parse in {"gender": parse_gender, "age": parse_age, "accent": parse_accent, "profile": parse_profile}.items():
    add(
        f"parse_{name}",
        lambda s, d, p=parse: responses(s, d).select("idx", p("response").alias("value")),
        with_views(f"SELECT idx, {SQL[name]} AS value FROM responses", "responses"),
    )

PARSED = "CASE WHEN dataset = 'globe_v2' THEN {plain} ELSE {sql} END"
parsed_sql = {k: PARSED.format(plain=sql_strip("response") if k == "profile" else "'unknown'", sql=v) for k, v in SQL.items()}
add(
    "parse_response",
    lambda s, d: parse_response(responses(s, d)).select("idx", "parsed_gender", "parsed_age", "parsed_accent", "parsed_profile"),
    with_views("SELECT idx, " + ", ".join(f"{v} AS parsed_{k}" for k, v in parsed_sql.items()) + " FROM responses", "responses"),
)


def filled(s, d):
    """Gender is known for some rows, 'unknown' or null for others; age and accent columns are missing."""
    known = F.when(F.col("idx") % 3 == 0, "unknown").when(F.col("idx") % 3 == 1, "other")
    rows = responses(s, d).withColumn("gender", known).withColumnRenamed("response", "voice_description")
    return fill_metadata(rows).select("idx", "gender", "age", "accent", "voice_description")


add(
    "fill_metadata",
    filled,
    with_views(
        f"""SELECT idx, CASE WHEN idx % 3 = 1 THEN 'other' WHEN idx % 3 = 0 AND dataset <> 'globe_v2' THEN {SQL['gender']} WHEN idx % 3 = 0 THEN 'unknown' END AS gender,
        CASE WHEN dataset <> 'globe_v2' THEN {SQL['age']} END AS age, CASE WHEN dataset <> 'globe_v2' THEN {SQL['accent']} END AS accent,
        CASE WHEN dataset = 'globe_v2' THEN response ELSE {SQL['profile']} END AS voice_description FROM responses""",
        "responses",
    ),
)
