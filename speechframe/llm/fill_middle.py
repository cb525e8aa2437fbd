"""Fill-in-the-middle training text by one counted-quantifier match for each row.

A text is ``n`` units: a word with the white space before it, or white space that no word follows. ``regexp_count`` gives ``n``;
two draws from the row's hash give the units ``a <= b`` after which prefix and middle end. Each row then has a pattern of its own,

    \\A((?:unit){a}+)((?:unit){b-a}+)(.*)\\z

whose three groups are prefix, middle and suffix. The counted groups are possessive: Java runs such a group as a loop and
keeps no way back into it, so the depth of its stack does not grow with the text. The replacement that writes the groups in
the order of the form is the one match of the row. ``restore`` rebuilds the text from output and form alone.

A null text is an empty one. An empty text, a text that holds one of the marks, and the rows that the draw leaves out are
plain: the output is the text. A null doc_id draws as an empty one (the hash of ``42:``); rows that share a doc_id and a text
get the same output, each its own row. All work is column expressions; no row depends on another, so an empty table gives an
empty one. Columns other than the id and the text are not read.
"""

from pyspark.sql import Column, DataFrame, functions as F

SPACE = r"\x20\x09-\x0D"
#: The two branches exclude each other, so that none of the three runs ever needs a way back.
UNIT = rf"[{SPACE}]*+[^{SPACE}]++|[{SPACE}]++"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"


def draws(doc_id: Column, seed: int) -> list[Column]:
    """The first four 8-digit groups of the hexadecimal SHA-256 of ``seed:doc_id``, as numbers."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def restore(output: Column, form: Column) -> Column:
    """The text that ``output`` was made of. A transformed text holds each mark once, as texts with marks stay plain."""
    psm = F.regexp_replace(output, rf"(?s)\A{PREFIX}(.*){SUFFIX}(.*){MIDDLE}(.*)\z", "$1$3$2")
    spm = F.regexp_replace(output, rf"(?s)\A{SUFFIX}(.*){PREFIX}(.*){MIDDLE}(.*)\z", "$2$3$1")
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def fill_in_middle(docs: DataFrame, seed: int = 42, transformed: int = 50, suffix_first: int = 80) -> DataFrame:
    """(doc_id, text, n, form, prefix_chars, middle_chars, output) of every row.

    Of the rows that may be transformed, ``transformed`` percent are, and of these ``suffix_first`` percent put the suffix first.
    """
    h1, h2, h3, h4 = draws(F.col("doc_id"), seed)
    marked = F.col("text").contains(PREFIX) | F.col("text").contains(SUFFIX) | F.col("text").contains(MIDDLE)
    counted = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("n", F.regexp_count("text", F.lit(UNIT)).cast("long"))
    cut = counted.withColumns({"c1": h1 % (F.col("n") + 1), "c2": h2 % (F.col("n") + 1)})
    formed = cut.withColumn(
        "form",
        F.when((F.col("text") == "") | marked | (h3 % 100 >= transformed), "plain").when(h4 % 100 < suffix_first, "spm").otherwise("psm"),
    )
    pattern = F.concat(
        F.lit(rf"(?s)\A((?:{UNIT}){{"), F.least("c1", "c2").cast("string"), F.lit(rf"}}+)((?:{UNIT}){{"), F.abs(F.col("c1") - F.col("c2")).cast("string"), F.lit(r"}+)(.*)\z")
    )
    order = F.when(F.col("form") == "spm", f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2").otherwise(f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2")
    written = formed.withColumn("output", F.when(F.col("form") == "plain", F.col("text")).otherwise(F.regexp_replace("text", pattern, order)))
    # the marks' places in the output, counted in code points from 1, give the lengths of the pieces between them
    p, s, m = (F.instr("output", mark) for mark in (PREFIX, SUFFIX, MIDDLE))
    head = F.when(F.col("form") == "spm", m - p - len(PREFIX)).when(F.col("form") == "psm", s - p - len(PREFIX))
    middle = F.when(F.col("form") != "plain", F.char_length("output") - m - len(MIDDLE) + 1)
    return written.select("doc_id", "text", "n", "form", head.cast("long").alias("prefix_chars"), middle.cast("long").alias("middle_chars"), "output")


#: The query's rows in DuckDB's SQL, for the seed and shares that it is registered with.
SQL = rf"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
u AS (SELECT doc_id, text, regexp_extract_all(text, '[{SPACE}]*[^{SPACE}]+|[{SPACE}]+') AS units,
  CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
  CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM t),
c AS (SELECT *, CAST(len(units) AS BIGINT) AS n, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS a,
  greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS b,
  CASE WHEN text = '' OR contains(text, '{PREFIX}') OR contains(text, '{SUFFIX}') OR contains(text, '{MIDDLE}') OR h3 % 100 >= 50 THEN 'plain'
       WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT *, array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle, array_to_string(units[b + 1:], '') AS suffix FROM c)
SELECT doc_id, n, form,
  CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '{PREFIX}' || prefix || '{SUFFIX}' || suffix || '{MIDDLE}' || middle
    ELSE '{SUFFIX}' || suffix || '{PREFIX}' || prefix || '{MIDDLE}' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM p"""
