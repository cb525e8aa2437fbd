"""Benchmark decontamination over a distributed positional inverted index, in DataFrame operations only.

``build_index`` cuts texts into words once and stores the postings (term, document, position) of the terms that the
benchmark uses; other terms can take part in no match. Every document also has one posting of term 0, whose position is its
number of words. A window of benchmark words is looked for from its two rarest terms: their postings, shifted by the
terms' offsets in the item, must meet in one alignment of item and document. Only for alignments that survive are the other
words looked up. Runs of matched words that are a window long are the exact matches. ``proximity_matches`` finds the
places where all terms of a query stand near each other, from the rarest term's postings on.

Words are cut as the contract says: A-Z become lower case, every other ASCII character but a digit or a letter separates.
A null text has no words; an item of no words matches nothing. Rows that share a doc_id are told apart by their text, and
identical rows give identical results, one for each; a row without a doc_id is judged like any other, its doc_id is null. A null item_id counts as the empty string; an id that occurs in several
rows of the benchmark counts once. Other columns are not read.
"""

from functools import reduce
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, Window, functions as F

from speechframe.llm.common import small, with_ids, without_number
from speechframe.session import materialize

SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WINDOW = 13
DOC = ["doc_id", "tag"]
ALIGNMENT = [*DOC, "item", "delta"]


def _lower(word: Column) -> Column:
    """A-Z only; words of ASCII alone take the fast way."""
    return F.when(F.octet_length(word) == F.char_length(word), F.lower(word)).otherwise(F.translate(word, ascii_uppercase, ascii_lowercase))


def words_of(df: DataFrame, *keys) -> DataFrame:
    """(keys, pos, term) of every word of ``text``, and one row with the empty term at the position after the last word.

    The keys are worked out before the words become rows: beside the generator they would be once for each word, from the whole text.
    """
    ended = F.concat(F.coalesce("text", F.lit("")), F.lit(" "))
    words = F.split(F.regexp_replace(ended, f"^{SEPARATORS}", ""), SEPARATORS, -1)
    cut = df.select(*keys, words.alias("words"))
    return cut.select(*cut.columns[:-1], F.posexplode("words").alias("pos", "word")).withColumn("term", _lower(F.col("word"))).drop("word")


def build_index(docs: DataFrame, terms: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Postings (term_id, doc_id, tag, pos) of the listed terms (term, term_id), written as a table."""
    tokens = words_of(docs, F.col(doc_id).alias("doc_id"), F.hash("text").alias("tag"))
    postings = tokens.join(small(terms), "term").select("term_id", *DOC, "pos")
    return materialize(postings, "postings")


def _items(benchmark: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(item, item_id, pos, term, n) of the benchmark's words, and its terms with their numbers (0 is the end of a text)."""
    numbered = materialize(benchmark.select(F.monotonically_increasing_id().alias("item"), F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), "text"), "items")
    tokens = words_of(numbered, "item", "item_id")
    lengths = tokens.filter("term = ''").select("item", F.col("pos").alias("n"))
    words = materialize(tokens.filter("term <> ''").join(lengths, "item"), "item_words")
    terms = words.select("term").distinct().select("term", (F.monotonically_increasing_id() + 1).alias("term_id"))
    terms = materialize(terms.unionByName(words.sparkSession.sql("SELECT '' AS term, 0L AS term_id")), "terms")
    return words, terms


def _seeds(words: DataFrame, counts: DataFrame, window: int) -> DataFrame:
    """(item, first, first_term, second, second_term, lo, hi): the two rarest words of the windows that start from lo to hi.

    Windows with a word that no document has are left out; ``second`` is null for windows of one word.
    """
    span = F.least(F.lit(window), "n")
    starts = F.explode(F.sequence(F.greatest(F.lit(0), F.col("pos") - span + 1), F.least(F.col("pos"), F.col("n") - span)))
    rows = words.join(small(counts), "term_id").select("item", "term_id", "pos", "count", span.alias("span"), starts.alias("start"))
    ordered = F.array_sort(F.collect_list(F.struct("count", "pos", "term_id")))
    windows = rows.groupBy("item", "start").agg(ordered.alias("w"), F.first("span").alias("span")).filter(F.size("w") == F.col("span"))
    second = F.try_element_at("w", F.lit(2))
    return windows.groupBy("item", F.col("w")[0]["pos"].alias("first"), F.col("w")[0]["term_id"].alias("first_term"), second["pos"].alias("second"), second["term_id"].alias("second_term")).agg(
        F.min("start").alias("lo"), (F.max("start") + F.max("span") - 1).alias("hi")
    )


def phrase_matches(index: DataFrame, words: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, tag, item, delta, j): words j of an item that stand at delta + j in a document, inside an occurrence of a window."""
    counts = materialize(index.filter("term_id > 0").groupBy("term_id").count(), "term_counts")
    seeds = materialize(_seeds(words, counts, window), "seeds")
    shown = seeds.select("item", "first", "second", "lo", "hi")

    def aligned(which: str) -> DataFrame:
        at = small(seeds.filter(F.col(which).isNotNull()).select(F.col(f"{which}_term").alias("term_id"), "item", "first", "second"))
        return index.join(at, "term_id").select(*DOC, "item", "first", "second", (F.col("pos") - F.col(which)).alias("delta")).distinct()

    firsts, key = aligned("first"), [*ALIGNMENT, "first", "second"]
    both = firsts.filter("second IS NOT NULL").join(aligned("second"), key).unionByName(firsts.filter("second IS NULL"))
    pairs = both.join(small(shown.withColumnRenamed("second", "s")), ["item", "first"]).filter(F.col("second").eqNullSafe(F.col("s")))
    asked = pairs.select(*ALIGNMENT, F.explode(F.sequence("lo", "hi")).alias("j")).distinct()
    numbered = words.select("item", F.col("pos").alias("j"), "term_id", F.least(F.lit(window), "n").alias("span"))
    asked = materialize(asked.join(small(numbered), ["item", "j"]).withColumn("pos", F.col("delta") + F.col("j")), "asked")
    met = index.join(small(asked), [*DOC, "term_id", "pos"]).select(*ALIGNMENT, "j", "span").distinct()
    order = Window.partitionBy(*ALIGNMENT).orderBy("j")  # at most an item's words
    run = met.withColumn("run", F.col("j") - F.row_number().over(order))
    long = run.withColumn("length", F.count("*").over(Window.partitionBy(*ALIGNMENT, "run"))).filter("length >= span")
    return long.select(*ALIGNMENT, "j")


def proximity_matches(index: DataFrame, queries: DataFrame, within: int) -> DataFrame:
    """(query, doc_id, tag, at): places of a query's rarest term that have all its terms (query, term_id) at most ``within`` words away."""
    counts = index.filter("term_id > 0").groupBy("term_id").count()
    asked = queries.select("query", "term_id").distinct().join(counts, "term_id", "left").na.fill(0, ["count"])
    asked = asked.withColumns({"terms": F.count("*").over(Window.partitionBy("query")), "rank": F.row_number().over(Window.partitionBy("query").orderBy("count", "term_id"))})
    asked = materialize(asked, "proximity")
    rarest = index.join(small(asked.filter("rank = 1")), "term_id").select("query", "terms", *DOC, F.col("pos").alias("at"))
    # positions meet in blocks of the distance, their own and the two beside it
    blocks = rarest.withColumn("block", F.explode(F.array(*(F.floor(F.col("at") / (within + 1)) + d for d in (-1, 0, 1)))))
    others = index.join(small(asked.select("query", "term_id")), "term_id").withColumn("block", F.floor(F.col("pos") / (within + 1)))
    near = blocks.join(others, ["query", *DOC, "block"]).filter(F.abs(F.col("pos") - F.col("at")) <= within)
    return near.groupBy("query", *DOC, "at", "terms").agg(F.count_distinct("term_id").alias("met")).filter("met = terms").select("query", *DOC, "at")


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: int = 20) -> DataFrame:
    """(doc_id, tag, n_words, n_hit, n_items, items_sha256, contaminated) of every row.

    A document is contaminated when at least one word in ``share`` stands inside an occurrence of a window.
    """
    return contamination(with_ids(docs), benchmark, window, share).withColumn("doc_id", without_number("doc_id"))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: int = 20) -> DataFrame:
    """The rows of ``decontaminate`` for documents that all have an id."""
    words, terms = _items(benchmark)
    words = materialize(words.join(small(terms), "term").drop("term"), "item_terms")
    index = build_index(docs, terms)
    hits = materialize(phrase_matches(index, words, window), "hits")
    names = words.select("item", "item_id").distinct()
    n_hit = hits.select(*DOC, (F.col("delta") + F.col("j")).alias("pos")).distinct().groupBy(*DOC).agg(F.count("*").alias("n_hit"))
    items = hits.select(*DOC, "item").distinct().join(small(names), "item").groupBy(*DOC).agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    lengths = index.filter("term_id = 0").select(*DOC, F.col("pos").cast("long").alias("n_words"))
    joined = reduce(lambda a, b: a.join(b, DOC, "left"), (n_hit, items), lengths)
    n = F.coalesce("n_hit", F.lit(0)).cast("long")
    return joined.select(
        *DOC,
        "n_words",
        n.alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"),
        ((n > 0) & (share * n >= F.col("n_words"))).alias("contaminated"),
    )


SQL = r"""
WITH doc AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
spans AS (SELECT DISTINCT least(13, len(w)) AS span FROM item WHERE len(w) > 0),
item_windows AS (SELECT item_id, span, array_to_string(w[s : s + span - 1], ' ') AS win
  FROM (SELECT item_id, w, least(13, len(w)) AS span, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS s FROM item WHERE len(w) > 0)),
doc_windows AS (SELECT doc_id, span, s, array_to_string(w[s : s + span - 1], ' ') AS win
  FROM (SELECT doc_id, w, span, unnest(range(1, len(w) - span + 2)) AS s FROM doc, spans WHERE len(w) >= span)),
met AS (SELECT DISTINCT doc_id, item_id, s, d.span FROM doc_windows d JOIN item_windows i ON d.win = i.win AND d.span = i.span),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + span)) AS p FROM met) GROUP BY 1),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM met) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""
