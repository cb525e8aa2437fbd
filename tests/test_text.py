"""Statistics, text search against brute force, waveforms against numpy, the classifier."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from speechframe.functions import waveform
from speechframe.operators import classify, quality, stats, text_search
from speechframe.session import workspace

DESCRIPTIONS = [
    "Warm and clear voice, warm tone.",
    "Deep raspy voice with dark tone",
    "A high clear bright voice; voice of youth",
    None,
    "",
    "warm deep voice, warm deep tone, Über-clear",
    "Warm and clear voice, warm tone.",
]


@pytest.fixture(scope="module")
def described(spark):
    rows = [(i, f"s{i}", d, "male", "teens", None) for i, d in enumerate(DESCRIPTIONS)]
    return spark.createDataFrame(rows, "idx long, speaker_id string, voice_description string, gender string, age string, accent string")


def brute(corpus, max_features, ngrams, stop):
    """(vectors, idf) the way a vectorizer defines them."""
    lists = []
    for text in corpus:
        words = [w for w in re.findall(r"\b\w\w+\b", (text or "").lower()) if w not in stop]
        lists.append([" ".join(words[i : i + n]) for n in range(ngrams[0], ngrams[1] + 1) for i in range(len(words) - n + 1)])
    totals = Counter(t for ts in lists for t in ts)
    kept = [t for t, _ in sorted(totals.items(), key=lambda x: (-x[1], x[0]))[:max_features]]
    idf = {t: math.log((1 + len(corpus)) / (1 + sum(t in ts for ts in lists))) + 1 for t in kept}
    vectors = []
    for ts in lists:
        v = {t: c * idf[t] for t, c in Counter(ts).items() if t in idf}
        norm = math.sqrt(sum(x * x for x in v.values()))
        vectors.append({t: x / norm for t, x in v.items()} if norm else {})
    return vectors, idf


@pytest.mark.parametrize("max_features, ngrams", [(1000, (1, 1)), (6, (1, 1)), (1000, (1, 2)), (5, (1, 2)), (8, (1, 3)), (4, (2, 2))])
def test_tfidf_equals_brute_force(described, max_features, ngrams):
    stop = ["and", "with", "of"]
    got = text_search.tfidf(described, max_features=max_features, ngrams=ngrams, stop=stop).collect()
    vectors, _ = brute(DESCRIPTIONS, max_features, ngrams, stop)
    want = {(i, t): w for i, v in enumerate(vectors) for t, w in v.items()}
    assert {(r.key, r.term) for r in got} == set(want)
    assert all(math.isclose(r.weight, want[r.key, r.term], rel_tol=1e-9) for r in got)


def test_find_similar_equals_brute_force(described):
    query = "warm voice with clear tone"
    got = text_search.find_similar(described, query, k=7, ngrams=(1, 2), stop=["with"]).collect()
    vectors, _ = brute([query, *DESCRIPTIONS], 1000, (1, 2), ["with"])
    sims = [sum(vectors[0].get(t, 0) * w for t, w in v.items()) for v in vectors[1:]]
    order = sorted(range(len(sims)), key=lambda i: (-round(sims[i], 12), i))
    assert [r.idx for r in got] == order
    assert np.allclose([r.similarity for r in got], [sims[i] for i in order])
    assert got[0].demographics == "male, teens, None"


def test_weights_are_worked_out_where_a_texts_terms_are(described, monkeypatch):
    plan = text_search.tfidf(described, ngrams=(1, 2))._jdf.queryExecution().toString()
    assert "Exchange" not in plan and "Window" not in plan and "Sort" not in plan
    chosen = []
    monkeypatch.setattr(text_search, "_ranked", lambda df, dots, key, k: chosen.append(dots))
    text_search.find_similar(described, "warm voice", ngrams=(1, 2))
    plan = chosen[0]._jdf.queryExecution().toString()
    assert "Exchange" not in plan and "Join" not in plan


@pytest.mark.parametrize("listed, piece", [(0, 1_000_000), (100_000, 1), (100_000, 5)])
def test_terms_do_not_depend_on_pieces_or_lists(described, monkeypatch, listed, piece):
    ask = lambda n: {(r.key, r.term, round(r.weight, 9)) for r in text_search.tfidf(described, max_features=9, ngrams=n, stop=["and"]).collect()}
    want = [ask(n) for n in ((1, 1), (1, 2), (1, 3), (2, 3))]
    monkeypatch.setattr(text_search, "LISTED_WORDS", listed)
    monkeypatch.setattr(text_search, "PIECE_WORDS", piece)
    assert [ask(n) for n in ((1, 1), (1, 2), (1, 3), (2, 3))] == want


def test_rows_of_one_key_are_one_text(spark):
    rows = [(1, "warm voice"), (1, "warm tone"), (2, "deep voice"), (None, "deep tone"), (None, "deep"), (3, None), (4, "a")]
    got = text_search.tfidf(spark.createDataFrame(rows, "idx long, voice_description string"), ngrams=(1, 2), stop=[]).collect()
    keys = {k: Counter(t for i, x in rows if i == k and x for w in [[w for w in x.split() if len(w) > 1]] for t in w + [" ".join(p) for p in zip(w, w[1:])]) for k, _ in rows}
    weight = {(k, t): n * (math.log((1 + len(rows)) / (1 + sum(t in c for c in keys.values()))) + 1) for k, c in keys.items() for t, n in c.items()}
    norm = {k: math.sqrt(sum(w * w for (i, _), w in weight.items() if i == k)) for k in keys}
    assert len(got) == len(weight) and all(math.isclose(r.weight, weight[r.key, r.term] / norm[r.key], rel_tol=1e-9) for r in got)
    assert text_search.tfidf(spark.createDataFrame([(1, "a"), (2, None)], "idx long, voice_description string"), ngrams=(1, 2)).count() == 0


def test_search_ignores_terms_the_corpus_lacks(described, spark):
    path = text_search.search_index(described, workspace(spark, "index"))
    got = text_search.search(described, path, "zebra deep zebra", 2).collect()
    assert [r.idx for r in got][0] in (1, 5) and got[0].similarity > 0
    none = text_search.search(described, path, "zebra", 2).collect()
    assert [(r.idx, r.similarity) for r in none] == [(0, 0.0), (1, 0.0)]


def test_traits_are_whole_words(spark):
    df = spark.createDataFrame([("Highly high, HIGH; low-pitched thin",), ("überhigh warm",), (None,)], "voice_description string")
    got = {(r.category, r.trait): r["count"] for r in text_search.trait_counts(df).collect()}
    assert got == {("pitch", "high"): 2, ("pitch", "low"): 1, ("tone", "thin"): 1, ("tone", "warm"): 1}


# --- statistics ----------------------------------------------------------------------------------


@pytest.mark.parametrize("data", [[1.0, 2.0, 2.5, 10.0], [3.0, 3.0], [0.0, 1.0, float("inf"), float("nan"), None]])
def test_histogram_equals_numpy(spark, data):
    df = spark.createDataFrame([(x,) for x in data], "x double")
    got = stats.histogram(df, "x", 7).orderBy("bin").collect()
    counts, edges = np.histogram([x for x in data if x is not None and math.isfinite(x)], 7)
    assert [r["count"] for r in got] == list(counts)
    assert np.allclose([r.lo for r in got] + [got[-1].hi], edges)


def test_correlation_equals_pandas(spark):
    data = [(1.0, 2.0, 5.0), (2.0, None, 5.0), (3.0, 1.0, 5.0), (4.0, 8.0, 5.0), (None, 4.0, 5.0)]
    df = spark.createDataFrame(data, "a double, b double, c double")
    got = {(r.a, r.b): r.r for r in stats.correlation(df, ["a", "b", "c"]).collect()}
    want = df.toPandas()[["a", "b"]].corr()
    assert len(got) == 9 and math.isclose(got["a", "b"], want.loc["a", "b"]) and got["a", "b"] == got["b", "a"]
    assert math.isclose(got["a", "a"], 1.0) and got["c", "c"] is None and got["a", "c"] is None


def test_null_and_unknown_are_different(spark):
    df = spark.createDataFrame([("unknown", None, "x"), (None, "unknown", None), ("male", "teens", "")], "gender string, age string, accent string")
    df = df.withColumns({"transcript": F.col("accent"), "voice_description": F.lit("v")})
    got = {r["column"]: round(r.pct, 3) for r in quality.completeness(df).collect()}
    assert got == {"gender": 66.667, "age": 66.667, "accent": 100.0, "transcript": 33.333, "voice_description": 100.0}
    assert quality.unknown_counts(df).collect()[0].asDict() == {"unknown_gender": 1, "unknown_age": 1, "unknown_accent": 0}


def test_quality_score_of_nothing_is_null(spark):
    df = spark.createDataFrame([], "speaker_id string, gender string, age string, accent string, transcript string, duration double")
    assert quality.quality_score(df).collect()[0].overall_quality_score is None


def test_eta_without_progress(spark):
    empty = spark.createDataFrame([], "idx long, seconds double")
    state = stats.progress(empty)
    assert state.collect()[0].asDict() == {"processed_count": 0, "last_index": -1, "has_data": False, "total_time": 0.0}
    assert stats.eta(state, 10).collect()[0].asDict() == {"remaining_samples": 10, "estimated_hours": None, "avg_seconds_per_sample": None}


def test_processing_dates_are_listed(spark):
    df = spark.createDataFrame([("v", "2025-01-01T00:00:00"), (None, "2025-01-01T00:00:00"), ("vvv", None)], "voice_description string, processing_timestamp string")
    got = {(r.section, r.key): r.value for r in stats.description_stats(df).collect()}
    assert got["processing_dates", "2025-01-01T00:00:00"] == 2
    assert math.isclose(got["lengths", "std_voice_description_length"], np.std([1, 0, 3]))


def test_classification_report_zero_division(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("c", "a")], "label string, prediction string")
    got = {r.label: (round(r.precision, 4), round(r.recall, 4), round(r.f1, 4), r.support) for r in classify.classification_report(df).collect()}
    assert got["a"] == (0.5, 0.5, 0.5, 2) and got["c"] == (0.0, 0.0, 0.0, 1)
    assert got["accuracy"][0] == 0.5 and got["macro avg"][3] == 4 and got["weighted avg"][1] == 0.5


def test_classifier_learns_separable_labels(spark):
    df = spark.range(200).select(F.col("id").alias("idx"), F.when(F.col("id") % 2 == 0, "a warm friendly sound").otherwise("a powerful deep sound").alias("voice_description"))
    report = {r.label: r for r in classify.evaluate_classifier(df, trees=5, max_depth=4).collect()}
    assert report["accuracy"].f1 == 1.0 and set(report) >= {"friendly_character", "authoritative_character"}


# --- waveforms -----------------------------------------------------------------------------------


def numpy_rms(x, frame, hop):
    padded = np.pad(np.asarray(x, float), frame // 2)
    return np.array([np.sqrt(np.mean(padded[i * hop : i * hop + frame] ** 2)) for i in range(1 + len(x) // hop)])


@pytest.fixture(scope="module")
def clip(spark):
    rng = np.random.default_rng(1)
    x = np.concatenate([np.zeros(300), rng.normal(0, 0.3, 700), np.zeros(211)]).astype(np.float32)
    return x, spark.createDataFrame([([float(v) for v in x],)], "s array<float>")


def test_frame_rms(clip):
    x, df = clip
    got = df.select(waveform.frame_rms("s", 64, 16).alias("r"), waveform.rms_energy("s", 64, 16).alias("e")).collect()[0]
    want = numpy_rms(x, 64, 16)
    assert np.allclose(got.r, want) and math.isclose(got.e, want.mean())


def test_trim_silence(clip):
    x, df = clip
    got = df.select(waveform.trim_silence("s", 60.0, 64, 16).alias("t")).collect()[0].t
    db = 10 * np.log10(np.maximum(numpy_rms(x, 64, 16) ** 2, 1e-10))
    loud = np.flatnonzero(db - db.max() > -60.0)
    assert np.allclose(got, x[loud[0] * 16 : min(len(x), (loud[-1] + 1) * 16)])


def test_preprocess_and_silence(clip, spark):
    x, df = clip
    got = df.select(waveform.preprocess("s", F.lit(100), 2.0, 60.0, 64, 16).alias("p")).collect()[0].p
    assert len(got) == 200 and math.isclose(max(map(abs, got)), 1.0)
    silent = spark.createDataFrame([([0.0, 0.0],)], "s array<float>")
    assert silent.select(waveform.peak_normalize("s").alias("n")).collect()[0].n == [None, None]
    stereo = spark.createDataFrame([([[1.0, 0.0], [0.5, 0.5]],)], "s array<array<float>>")
    assert stereo.select(waveform.preprocess("s", F.lit(1), trim=False, channels=True).alias("p")).collect()[0].p == [1.0, 1.0]


def test_classifier_cuts_texts_once_and_keeps_each_rows_place_in_the_trees(spark, monkeypatch):
    texts = ["warm friendly voice", "old wise calm voice", "young bright voice"]
    df = spark.createDataFrame([(i, texts[i % 3], "abc"[i % 3]) for i in range(60)], "idx long, voice_description string, label string")
    written = []
    whole = classify.materialize
    monkeypatch.setattr(classify, "materialize", lambda d, name: written.append((name, d.columns)) or whole(d, name))
    model = classify.train_classifier(df, trees=3, max_depth=4)
    assert written[0] == ("words", ["label", "kept"])  # all that is fitted reads these words, not the texts
    assert model.stages[-2].getCacheNodeIds()
    got = model.transform(df).select("label", "prediction_label").collect()
    assert all(r.label == r.prediction_label for r in got)
