"""A quality classifier of texts learned from preference pairs (Bradley-Terry).

A text is described by ``FEATURES``, numbers that do not depend on its language. In a preference pair a text of label 1 beats
one of label 0 with the probability ``sigmoid(w . (f1 - f0))``; the weights ``w`` minimise the logistic loss on the
differences of features. A text's margin is then ``w . f``. The threshold is the quantile of the margins of all labelled
training documents that leaves the share of label 0 below it, in the middle of the gap there, and the score is the sigmoid of the
margin's distance from it.

Bounds: pairs are drawn from at most ``FIT_ROWS`` training documents of each label, those with the smallest hash of their id, each
in about ``PARTNERS`` pairs. This bounded sample is read by Spark's logistic regression; the driver sees the weights. The threshold is taken over
all labelled training documents, counted in at most ``2 * EDGE * STEPS`` bins. Every row is scored.

Results for awkward input: an empty or null text has all features 0 and is scored like any other. Rows that share a doc_id are
scored each on their own; in the fit they count as one document, with the greatest of their texts and margins. Labels other than 0 and 1,
null ids, and documents labelled both 0 and 1 teach nothing. A null doc_id is scored, and held_out is that of an empty id
(false). Without training rows of both labels the score is the label that there is, 0.5 without any. Other columns are not read.
"""

import math
import zlib
from itertools import islice
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, functions as F

from speechframe.llm.common import map_batches
from speechframe.session import materialize

FIT_ROWS = 10_000
PARTNERS = 4
#: Margins are counted in bins of 1 / STEPS up to EDGE to either side; those beyond fall into the last bins.
STEPS, EDGE = 256, 64
FEATURES = (
    "log_chars", "letters", "upper", "digits", "blanks", "stops", "symbols", "beyond_ascii", "entropy",
    "log_words", "word_length", "distinct_words", "repeated_words", "most_frequent_word", "repeated_lines", "compressed",
    "root_upper", "root_digits", "root_symbols", "root_repeated_words", "root_repeated_lines",
)


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def _class(characters: str) -> np.ndarray:
    mask = np.zeros(256)
    mask[list(characters.encode())] = 1
    return mask


_UPPER = _class("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_LOWER = _class("abcdefghijklmnopqrstuvwxyz")
_BEYOND = np.r_[np.zeros(128), np.ones(128)]
_CLASSES = np.stack([_UPPER + _LOWER + _BEYOND, _class("0123456789"), _class(" \t\n\r\x0b\x0c"), _class(".,;:!?'\"()-"), _class("#$%&*+/<=>@[\\]^_`{|}~"), _BEYOND], axis=1)


def features(text: str) -> list[float]:
    """The numbers named in ``FEATURES`` of one whole text."""
    data = text.encode("utf-8", "surrogatepass")
    if not data:
        return [0.0] * len(FEATURES)
    counts = np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256).astype(np.float64)
    n = len(data)
    letters, digits, blanks, stops, symbols, beyond = (counts @ _CLASSES / n).tolist()
    shares = counts[counts > 0] / n
    entropy = float(-(shares * np.log2(shares)).sum()) / 8
    upper = float(counts @ _UPPER) / max(1.0, float(counts @ (_UPPER + _LOWER)))
    words = text.split()
    m = max(1, len(words))
    times: dict[str, int] = {}
    for w in words:
        times[w] = times.get(w, 0) + 1
    again = sum(map(eq, words, islice(words, 1, None))) / m
    lines = [line for line in text.split("\n") if line]
    lines_again = 1 - len(set(lines)) / max(1, len(lines)) if lines else 0.0
    packer = zlib.compressobj(1)
    packed = len(packer.compress(data)) + len(packer.flush())
    most = max(times.values(), default=0) / m if m > 1 else 0.0
    distinct = math.log1p(len(times)) / math.log1p(m)
    root = math.sqrt
    return [
        math.log1p(n) / 10, letters, upper, digits, blanks, stops, symbols, beyond, entropy,
        math.log1p(m) / 10, min(1.0, n / m / 20), distinct, again, most, lines_again, min(1.0, packed / n),
        root(upper), root(digits), root(symbols), root(again), root(lines_again),
    ]


def preferences(labels: DataFrame) -> DataFrame:
    """(doc_id, quality) of the documents that may teach: one label, not held out."""
    usable = labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    agreed = usable.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("most")).filter("quality = most")
    return agreed.select("doc_id", F.col("quality").cast("int").alias("quality"))


def pairs(docs: DataFrame, taught: DataFrame, rows: int = FIT_ROWS, partners: int = PARTNERS) -> DataFrame:
    """Feature differences of the bounded sample's preference pairs; ``won`` is 1 where the first of the two has label 1.

    Half of the pairs are turned round, so that both outcomes occur.
    """
    present = taught.join(docs.select("doc_id").distinct(), "doc_id", "left_semi").withColumn("h", F.xxhash64("doc_id"))
    chosen = [present.filter(F.col("quality") == q).orderBy("h", "doc_id").limit(rows) for q in (0, 1)]
    ids = materialize(chosen[0].unionByName(chosen[1]), "sample")  # at most 2 * rows
    texts = docs.select("doc_id", "text").join(F.broadcast(ids.select("doc_id")), "doc_id", "left_semi")
    one_each = texts.groupBy("doc_id").agg(F.max("text").alias("text"))

    def run(batches):
        for batch in batches:
            found = [features(t or "") for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.list_(pa.float64()))], ["doc_id", "f"])

    described = map_batches(one_each, run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, f array<double>")
    sample = materialize(described.join(F.broadcast(ids), "doc_id"), "described")
    sizes = {r["quality"]: r["n"] for r in sample.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return None
    # texts meet in buckets by the hash of their id, in each of which there are about ``partners`` of the rarer label
    bucketed = sample.withColumn("bucket", F.pmod("h", F.lit(max(1, min(sizes.values()) // partners))))
    high, low = (bucketed.filter(F.col("quality") == q).select("bucket", F.col("f").alias(f"f{q}"), F.col("h").alias(f"h{q}")) for q in (1, 0))
    met = high.join(low, "bucket").withColumn("won", F.pmod(F.xxhash64("h1", "h0"), F.lit(2)).cast("double"))
    return met.select(F.zip_with("f1", "f0", lambda x, y: F.when(F.col("won") == 1, x - y).otherwise(y - x)).alias("difference"), "won")


def fit(docs: DataFrame, taught: DataFrame, rows: int = FIT_ROWS, partners: int = PARTNERS) -> np.ndarray | None:
    """Weights of the features by logistic loss on the differences of preference pairs; None without pairs."""
    met = pairs(docs, taught, rows, partners)
    if met is None:
        return None
    train = materialize(met, "pairs").select(array_to_vector("difference").alias("features"), F.col("won").alias("label"))
    model = LogisticRegression(fitIntercept=False, regParam=1e-4, maxIter=60, tol=1e-7).fit(train)
    return model.coefficients.toArray()


def margins(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """(doc_id, margin) of every row."""
    weights = np.asarray(weights)

    def run(batches):
        for batch in batches:
            found = np.array([features(t or "") for t in batch.column("text").to_pylist()]).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found @ weights, pa.float64())], ["doc_id", "margin"])

    return map_batches(docs.select("doc_id", "text"), run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, margin double")


def threshold(scored: DataFrame, taught: DataFrame) -> float:
    """The quantile of the training documents' margins below which their share of label 0 lies, in the middle of the gap there."""
    at = F.greatest(F.lit(-EDGE * STEPS), F.least(F.lit(EDGE * STEPS), F.floor(F.col("margin") * STEPS)))
    known = scored.groupBy("doc_id").agg(F.max("margin").alias("margin")).join(taught, "doc_id")
    bins = known.groupBy(at.alias("at")).agg(F.count("*").alias("n"), F.sum(1 - F.col("quality")).alias("low"), F.min("margin").alias("least"), F.max("margin").alias("most"))
    found = sorted(bins.collect())  # one row for each bin
    below, goal = 0, sum(r["low"] for r in found)
    for this, after in zip(found, found[1:]):
        below += this["n"]
        if below >= goal:
            return (this["most"] + after["least"]) / 2
    return found[-1]["least"] if found else 0.0


def classify(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS, partners: int = PARTNERS) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``."""
    taught = materialize(preferences(labels), "taught")
    weights = fit(docs, taught, rows, partners)
    if weights is None:
        only = taught.join(docs.select("doc_id"), "doc_id", "left_semi").agg(F.avg("quality")).first()[0]
        scored = docs.select("doc_id", F.lit(0.5 if only is None else float(only)).alias("score"))
    else:
        found = materialize(margins(docs, weights), "margins")
        apart = F.col("margin") - F.lit(float(threshold(found, taught)))
        scored = found.select("doc_id", (1 / (1 + F.exp(-apart))).alias("score"))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
