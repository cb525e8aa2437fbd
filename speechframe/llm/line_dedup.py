"""Removal of boilerplate lines by their frequency within a site.

For each host the number of its rows that contain a line is divided by the host's rows; lines above the boilerplate ratio
are dropped from the host's rows. A host that holds a third of all rows is no hot key: lines are counted per task first and
dealt out by host and line. At most (mean lines of a row / ratio) lines of a host can be above the ratio, so the lists that
are joined back to the rows are short whatever the host's size.

A line is what stands between line feeds; blank lines are never dropped. A line that occurs twice in a row counts once. A
null host is a host of its own, a null text stays null and has no lines, a text whose lines all go becomes empty. Repeated
rows count each, unless rows of the same lines are to count once: a page that a site holds many times is then one page, and
its copies do not make its lines boilerplate. Other columns are kept as they are; columns named n_lines and n_dropped are replaced.
"""

from pyspark.sql import Column, DataFrame, functions as F

from speechframe.llm.common import small
from speechframe.session import materialize

#: Working columns, named apart from what tables hold.
HOST, LISTED, KEPT, PAGE = "_line_dedup_host", "_line_dedup_listed", "_line_dedup_kept", "_line_dedup_page"


def _key(line: Column) -> Column:
    return F.unhex(F.md5(line.cast("binary")))


def _page(text: Column) -> Column:
    """Digest of the set of lines of a text, blank ones aside; nulls share one."""
    lines = F.filter(F.array_distinct(F.split(text, "\n", -1)), lambda x: F.trim(x) != "")
    return _key(F.coalesce(F.array_join(F.array_sort(lines), "\n"), F.lit("")))


def boilerplate_lines(docs: DataFrame, host: Column, ratio: float, least: int, copies: bool = True) -> DataFrame:
    """(HOST, LISTED): the digests of each host's boilerplate lines. Without ``copies``, rows of a host with the same lines count once."""
    page = [] if copies else [_page(F.col("text")).alias(PAGE)]
    number = F.count("*") if copies else F.count_distinct(PAGE)
    # Spark evaluates what stands beside an explode once for each line, so the digest of a page comes before it
    paged = docs.select(host.alias(HOST), *page, "text")
    lines = paged.select(HOST, *([] if copies else [PAGE]), F.explode(F.array_distinct(F.split("text", "\n", -1))).alias("line")).filter(F.trim("line") != "")
    keyed = lines.select(HOST, *([] if copies else [PAGE]), _key(F.col("line")).alias("line"))
    counted = keyed.groupBy(HOST, "line").agg(number.alias("n")).filter(F.col("n") >= least)
    totals = materialize(docs.select(host.alias(HOST), *page).groupBy(HOST).agg(number.alias("total")), "hosts")
    above = counted.join(small(totals), HOST).filter(F.col("n") > ratio * F.col("total"))
    return above.groupBy(HOST).agg(F.collect_set("line").alias(LISTED))


def line_dedup(docs: DataFrame, host_col: str = "source", ratio: float = 0.1, least: int = 5, copies: bool = True) -> DataFrame:
    """``docs`` with cleaned texts, and ``n_lines`` and ``n_dropped``.

    A line goes when more than ``ratio`` of its host's rows, and at least ``least`` of them, contain it; without ``copies``,
    rows of a host with the same lines are one row in both counts.
    """
    host = F.coalesce(F.concat(F.lit("="), F.col(host_col).cast("string")), F.lit(""))
    listed = materialize(boilerplate_lines(docs, host, ratio, least, copies), "boilerplate")
    joined = docs.withColumn(HOST, host).join(small(listed), HOST, "left")
    lines = F.split("text", "\n", -1)
    kept = F.when(F.col(LISTED).isNull(), lines).otherwise(F.filter(lines, lambda x: ~F.array_contains(LISTED, _key(x))))
    own = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    marked = joined.withColumns({"n_lines": F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)).cast("long"), KEPT: kept})
    return marked.withColumns(
        {"n_dropped": F.when(F.col("text").isNull(), 0).otherwise(F.col("n_lines") - F.size(KEPT)).cast("long"), "text": F.array_join(KEPT, "\n")}
    ).select(*own, "n_lines", "n_dropped")


SQL = r"""
WITH lines AS (SELECT DISTINCT source, doc_id, unnest(string_split(text, chr(10))) AS line FROM documents),
totals AS (SELECT source, count(*) AS total FROM documents GROUP BY 1),
counted AS (SELECT source, line, count(*) AS n FROM lines WHERE trim(line, ' ') <> '' GROUP BY 1, 2),
bad AS (SELECT source, list(line) AS bad FROM counted JOIN totals USING (source) WHERE n > {ratio} * total AND n >= {least} GROUP BY 1)
SELECT doc_id, coalesce(len(string_split(text, chr(10))), 0)::BIGINT AS n_lines,
  coalesce(len(list_filter(string_split(text, chr(10)), lambda x: list_contains(coalesce(bad, []), x))), 0)::BIGINT AS n_dropped,
  CASE WHEN text IS NOT NULL THEN coalesce(array_to_string(list_filter(string_split(text, chr(10)), lambda x: NOT list_contains(coalesce(bad, []), x)), chr(10)), '') END AS text
FROM documents LEFT JOIN bad USING (source)
"""
