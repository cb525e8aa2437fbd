"""Traits, words, TF-IDF, similarity search and classification."""

from pyspark.sql import functions as F

from speechframe.catalog.base import SQL_WORD, Catalog, on_samples, rounded, samples, table
from speechframe.catalog.scalars import TYPE
from speechframe.operators import classify, text_search
from speechframe.operators.text_search import ENGLISH_STOP_WORDS
from speechframe.session import materialize, workspace

CATALOG = Catalog()
add = CATALOG.add

TOKENS = r"[\p{L}\p{M}\p{N}\p{Pc}]"


def quoted(words):
    return ", ".join(f"'{w}'" for w in words)


HITS = ", w AS (SELECT unnest(regexp_extract_all(lower(voice_description), '{t}+')) AS w FROM samples)".format(t=TOKENS)
CATEGORY = "CASE " + " ".join(f"WHEN w IN ({quoted(v)}) THEN '{c}'" for c, v in text_search.TRAITS.items()) + " END"
add(
    "trait_counts",
    lambda s, d: text_search.trait_counts(samples(s, d)).drop("rank"),
    on_samples("").rstrip()
    + HITS
    + f""" SELECT category, trait, count FROM (SELECT {CATEGORY} AS category, w AS trait, count(*) AS count,
      row_number() OVER (PARTITION BY {CATEGORY} ORDER BY count(*) DESC, w) AS rn FROM w WHERE {CATEGORY} IS NOT NULL GROUP BY 1, 2) WHERE rn <= 5""",
)
add(
    "trait_counts_flat",
    lambda s, d: text_search.trait_counts_flat(samples(s, d)),
    on_samples("").rstrip()
    + HITS
    + f" SELECT w AS value, count(*) AS count FROM w WHERE w IN ({quoted(text_search.FLAT_TRAITS)}) GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10",
)
add(
    "word_frequency",
    lambda s, d: text_search.word_frequency(samples(s, d), 20),
    on_samples("").rstrip()
    + f", w AS (SELECT unnest(regexp_extract_all(lower(voice_description), '{SQL_WORD}')) AS word FROM samples)"
    + " SELECT word, count(*) AS count FROM w GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20",
)


def weights_sql(source, key, text, features, bigrams, extra=""):
    """CTEs ``n``, ``vocab``, ``idf`` and ``weights`` over the token lists of a corpus."""
    grams = "toks" if not bigrams else "list_concat(toks, list_transform(range(1, greatest(len(toks), 1)), lambda i: toks[i] || ' ' || toks[i + 1]))"
    return f""" corpus AS (SELECT {key} AS key, {text} AS text FROM {source} {extra}),
 toks AS (SELECT key, list_filter(regexp_extract_all(lower(text), '{TOKENS}{{2,}}'), lambda t: t NOT IN ({quoted(ENGLISH_STOP_WORDS)})) AS toks FROM corpus),
 terms AS (SELECT key, unnest({grams}) AS term FROM toks),
 vocab AS (SELECT term FROM terms GROUP BY 1 ORDER BY count(*) DESC, term LIMIT {features}),
 tf AS (SELECT key, term, count(*) AS tf FROM terms JOIN vocab USING (term) GROUP BY 1, 2),
 idf AS (SELECT term, ln((1 + (SELECT count(*) FROM corpus)) / (1 + count(*))) + 1 AS idf FROM tf GROUP BY 1),
 weights AS (SELECT key, term, tf * idf AS weight FROM tf JOIN idf USING (term))"""


NORMED = " SELECT key, term, round(weight / sqrt(sum(weight * weight) OVER (PARTITION BY key)), 6) AS weight FROM weights"
add(
    "tfidf_documents",
    lambda s, d: rounded(text_search.tfidf(table(s, d, "documents"), "text", "doc_id", 1000, (1, 1))),
    "WITH " + weights_sql("documents", "doc_id", "text", 1000, False) + NORMED,
)
add(
    "tfidf_bigrams",
    lambda s, d: rounded(text_search.tfidf(samples(s, d), **text_search.BIGRAM_1000)),
    on_samples("").rstrip() + "," + weights_sql("samples", "idx", "voice_description", 1000, True) + NORMED,
)

TARGET = "warm female voice with clear articulation and medium pitch"
SHOWN = "coalesce(gender, 'None') || ', ' || coalesce(age, 'None') || ', ' || coalesce(accent, 'None') AS demographics"
RANKED = f""", q AS (SELECT term, weight AS q FROM {{query}}),
 dots AS (SELECT key, round(sum(weight * coalesce(q, 0)) / (sqrt(sum(weight * weight)) * (SELECT sqrt(sum(q * q)) FROM q)), 12) AS similarity
   FROM weights LEFT JOIN q USING (term) WHERE key IS NOT NULL GROUP BY 1)
SELECT idx, round(coalesce(similarity, 0), 6) AS similarity, speaker_id, voice_description AS description, {SHOWN}
FROM samples LEFT JOIN dots ON key = idx ORDER BY coalesce(dots.similarity, 0) DESC, idx LIMIT {{k}}"""

for name, config, bigrams in [("unigrams", text_search.UNIGRAM_1000, False), ("bigrams", text_search.BIGRAM_1000, True)]:
    add(
        f"find_similar_{name}",
        lambda s, d, c=config: rounded(text_search.find_similar(samples(s, d), TARGET, 5, **c)),
        on_samples("").rstrip()
        + ","
        + weights_sql("samples", "idx", "voice_description", 1000, bigrams, f"UNION ALL SELECT NULL, '{TARGET}'")
        + RANKED.format(query="weights WHERE key IS NULL", k=5),
    )

ASKED = "deep authoritative male voice zzunseen"


def searched(s, d):
    df = samples(s, d)
    path = text_search.search_index(df, workspace(s, "index"))
    return rounded(text_search.search(df, path, ASKED, 3))


add(
    "search_index",
    searched,
    on_samples("").rstrip()
    + ","
    + weights_sql("samples", "idx", "voice_description", 200, False)
    + RANKED.format(query=f"(SELECT term, idf AS weight FROM idf WHERE term IN ({quoted(ASKED.split())}))", k=3),
)
add(
    "label_characters",
    lambda s, d: classify.label_characters(samples(s, d)),
    on_samples(f"SELECT idx, voice_description, {TYPE.format(c='voice_description')} AS label FROM samples"),
)
add(
    "classifier_report",
    lambda s, d: rounded(classify.evaluate_classifier(samples(s, d))),
)
def classified(s, d):
    """The forest with its production parameters on the test rows: what it says is a label of the training rows, and it is
    right more often than the most frequent label of the training rows would be."""
    predicted, trained = classify.predict_test_rows(samples(s, d))
    known = trained.groupBy("label").agg(F.count("*").alias("n"))
    usual = known.orderBy(F.desc("n"), "label").limit(1).select("label").scalar()
    rows = materialize(predicted.select("idx", "label", "prediction_label", (F.col("label") == usual).alias("usual")), "predicted")
    right = rows.agg((F.avg((F.col("label") == F.col("prediction_label")).cast("int")) >= F.avg(F.col("usual").cast("int"))).alias("b")).scalar()
    marked = rows.join(F.broadcast(known.select(F.col("label").alias("prediction_label"), F.lit(True).alias("known"))), "prediction_label", "left")
    return marked.select("idx", "label", F.coalesce("known", F.lit(False)).alias("known"), right.alias("beats_the_usual"))


add(
    "classifier_test_rows",
    classified,
    on_samples(
        f"""SELECT idx, label, true AS known, true AS beats_the_usual FROM (SELECT idx, {TYPE.format(c='voice_description')} AS label FROM samples)
        WHERE label IS NOT NULL AND CAST('0x' || substr(md5(concat('42:', idx)), 1, 8) AS BIGINT) / 4294967296.0 < 0.2"""
    ),
)
add(
    "classification_report",
    lambda s, d: rounded(classify.classification_report(table(s, d, "labels"), "quality", "toxic")),
    """WITH c AS (SELECT CAST(quality AS VARCHAR) AS l, CAST(toxic AS VARCHAR) AS p FROM labels),
     n AS (SELECT DISTINCT l AS label FROM c UNION SELECT DISTINCT p FROM c),
     m AS (SELECT label, (SELECT count(*) FROM c WHERE l = label AND p = label) AS hit, (SELECT count(*) FROM c WHERE l = label) AS support,
       (SELECT count(*) FROM c WHERE p = label) AS predicted FROM n),
     pr AS (SELECT label, hit, support, coalesce(hit / nullif(predicted, 0), 0) AS p, coalesce(hit / nullif(support, 0), 0) AS r FROM m),
     f AS (SELECT *, coalesce(2 * p * r / nullif(p + r, 0), 0) AS f1 FROM pr)
    SELECT label, round(p, 6) AS precision, round(r, 6) AS recall, round(f1, 6) AS f1, support FROM f
    UNION ALL SELECT 'accuracy', round(sum(hit) / sum(support), 6), round(sum(hit) / sum(support), 6), round(sum(hit) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM f
    UNION ALL SELECT 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f1), 6), CAST(sum(support) AS BIGINT) FROM f
    UNION ALL SELECT 'weighted avg', round(sum(p * support) / sum(support), 6), round(sum(r * support) / sum(support), 6),
      round(sum(f1 * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM f""",
)
