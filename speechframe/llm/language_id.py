"""Language identification by words, backing off to character n-grams.

A known word scores by its log frequency in each language. An unseen word backs off to the longest of its character n-grams
that are known, from five characters down to one. The sums over a text's words are compared between the languages.

The model is fitted on labelled rows that are not held out: of these, the ``FIT_ROWS`` rows with the smallest hash of their
id, which is a bounded sample at any size. So the model is bounded too and travels with the scoring tasks; every row is scored.

A text that is null or has no letter is ``und`` with score 0; other signs that can stand in words, like ½ or ², are no letters. A text of letters that the model has never seen gets the most
frequent language. With no labelled rows at all every text is ``und``. Repeated rows are scored each on their own; only the
text is read in scoring.
"""

import math
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from speechframe.llm.common import map_batches, per_text
from speechframe.session import materialize

FIT_ROWS = 8_000
#: Words and n-grams that occur less often in the sample are left to the back-off.
LEAST_COUNT = 2
LONGEST_GRAM = 5
#: Words scored with their own vector are remembered by a task up to this many.
KEPT_WORDS = 200_000

#: A letter and what follows of letters and the marks on them.
WORDS = regex.compile(r"\p{L}[\p{L}\p{M}]*+")
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
COUNTS = "lang string, word string, n long"


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def grams(word: str, n: int) -> list[str]:
    padded = f"^{word}$"
    return [padded[i : i + n] for i in range(len(padded) - n + 1)] if n > 1 else list(word)


def _count_words(batches):
    for batch in batches:
        counts: Counter = Counter()
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            counts.update((lang, w) for w in WORDS.findall(text.lower()))
        yield pa.RecordBatch.from_pydict({"lang": [k[0] for k in counts], "word": [k[1] for k in counts], "n": pa.array(list(counts.values()), pa.int64())})


def fit(docs: DataFrame, rows: int = FIT_ROWS) -> dict:
    """Log frequencies of words and n-grams by language, from at most ``rows`` labelled rows that are not held out."""
    labelled = docs.filter(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    order = F.xxhash64("doc_id")
    chosen = labelled.select(order.alias("h")).orderBy("h").limit(rows).agg(F.max("h")).first()[0]
    if chosen is None:
        return {"langs": [], "first": None, "words": ([], None), "grams": ([], None)}
    sample = labelled.filter(order <= chosen).select("lang", "text")
    counts = map_batches(sample, _count_words, COUNTS).groupBy("lang", "word").agg(F.sum("n").alias("n"))
    by_lang: dict[str, Counter] = defaultdict(Counter)
    for lang, word, n in materialize(counts, "words").toLocalIterator():
        by_lang[lang][word] = n
    langs = sorted(by_lang)
    totals = {lang: sum(c.values()) for lang, c in by_lang.items()}
    pieces: dict[str, Counter] = defaultdict(Counter)
    for lang, words in by_lang.items():
        own = pieces[lang]
        for word, n in words.items():
            for size in range(1, LONGEST_GRAM + 1):
                for g in grams(word, size):
                    own[g] += n

    def logs(tables, sizes):
        kept = sorted({k for c in tables.values() for k, n in c.items() if n >= LEAST_COUNT})
        return kept, np.array([[math.log((tables[lang][k] + 0.1) / (sizes(lang, k) + 1)) for lang in langs] for k in kept], dtype=np.float32)

    by_size = {lang: Counter() for lang in langs}
    for lang, c in pieces.items():
        for g, n in c.items():
            by_size[lang][len(g)] += n
    first = max(langs, key=lambda lang: (totals[lang], lang))
    return {"langs": langs, "first": first, "words": logs(by_lang, lambda lang, _: totals[lang]), "grams": logs(pieces, lambda lang, g: by_size[lang][len(g)])}


class Scorer:
    """Scores texts in one task. ``words`` and ``grams`` of the model are a list and the log frequencies of each by language."""

    def __init__(self, model):
        self.langs = model["langs"]
        self.first = self.langs.index(model["first"]) if self.langs else 0
        names, rows = model["words"]
        self.fixed = {w: i for i, w in enumerate(names)}
        self.known = dict(self.fixed)
        self.table = np.zeros((len(names) + KEPT_WORDS + 50_000, max(1, len(self.langs))), dtype=np.float32)
        if len(names):
            self.table[: len(names)] = rows
        names, self.gram_rows = model["grams"]
        self.grams = {g: i for i, g in enumerate(names)}

    def _back_off(self, word: str):
        for size in range(LONGEST_GRAM, 0, -1):
            found = [self.grams[g] for g in grams(word, size) if g in self.grams]
            if found:
                return self.gram_rows[found].mean(axis=0)
        return np.zeros(len(self.langs))

    def score(self, text: str) -> tuple[str, float]:
        words = WORDS.findall(text.lower())
        if not words or not self.langs:
            return "und", 0.0
        known = self.known
        for w in set(words).difference(known):
            if len(known) >= len(self.table):  # one very long text can bring more words than are kept
                self.table = np.concatenate([self.table, np.zeros_like(self.table)])
            self.table[len(known)] = self._back_off(w)
            known[w] = len(known)
        sums = self.table[list(map(known.__getitem__, words))].sum(axis=0, dtype=np.float64)
        if len(known) > len(self.fixed) + KEPT_WORDS:
            self.known = dict(self.fixed)
        best = int(sums.argmax()) if sums.any() else self.first
        # an average over words keeps long texts from all scoring 1
        share = np.exp((sums - sums[best]) / math.sqrt(len(words)))
        return self.langs[best], float(share[best] / share.sum())


def identify(docs: DataFrame, model: dict, extra=()) -> DataFrame:
    """(doc_id, lang_pred, score) of every text, and the columns named in ``extra``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(ids, texts, scorer):
        found = list(map(scorer.score, texts))
        return {"doc_id": ids, "lang_pred": [f[0] for f in found], "score": [f[1] for f in found]}

    schema = T.StructType([*SCHEMA, *(docs.schema[c] for c in extra)])
    return map_batches(docs.select("doc_id", "text", *(c for c in extra if c != "text")), per_text(run, schema, lambda: Scorer(shared.value)), schema)


def language_id(docs: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row, with a model fitted on the rows of ``docs`` that are not held out."""
    return identify(docs, fit(docs, rows)).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
