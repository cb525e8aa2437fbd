"""The quality classifier, embedding whitening and fill-in-the-middle against brute force, accuracy and round trips."""

import hashlib
import math
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from speechframe.llm import fill_middle, quality, whitening
from tests.llm.test_operators import ROWS, SCHEMA, TEXTS, docs, nothing  # noqa: F401


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# fill in the middle


def plain_fill(doc_id, text, seed=42, transformed=50, suffix_first=80):
    """(n, form, prefix_chars, middle_chars, output) by slicing a list of units."""
    text = text or ""
    units = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    digest = sha(f"{seed}:{'' if doc_id is None else doc_id}")
    h1, h2, h3, h4 = (int(digest[8 * k : 8 * k + 8], 16) for k in range(4))
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= transformed:
        return n, "plain", None, None, text
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < suffix_first:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def filled(df, **options):
    made = fill_middle.fill_in_middle(df, **options).withColumn("back", fill_middle.restore(F.col("output"), F.col("form")))
    return [tuple(r) for r in made.select("doc_id", "text", "n", "form", "prefix_chars", "middle_chars", "output", "back").collect()]


def key(row):
    return tuple((x is not None, x) for x in row)


@pytest.mark.parametrize("options", [{}, {"transformed": 100}, {"transformed": 100, "suffix_first": 0}, {"seed": 7, "transformed": 0}])
def test_fill_matches_slicing(docs, options):  # noqa: F811
    want = sorted(((i, t or "", *plain_fill(i, t, **options), t or "") for i, t, *_ in ROWS), key=key)
    assert sorted(filled(docs, **options), key=key) == want


def test_fill_awkward_texts(spark):
    rng = random.Random(3)
    pieces = [*" \t\n\x0b\x0c\r", "a", "é", "🙂", "日本", "<", "P>", "<P", "S>", "$1", "\\", "{2}", "\x1c", "\x85", "\xa0"]
    texts = ["".join(rng.choices(pieces, k=rng.randint(0, 25))) for _ in range(300)] + ["<M> x", "a<S>", None, "", " ", "w " * 200_000, " " * 300_000, "z" * 300_000]
    rows = [(None if i % 50 == 3 else i, t, "x") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows + rows[:3], "doc_id long, text string, n string")
    for options in ({"transformed": 100}, {"transformed": 100, "suffix_first": 0}):
        want = sorted(((i, t or "", *plain_fill(i, t, **options), t or "") for i, t, _ in rows + rows[:3]), key=key)
        assert sorted(filled(df, **options), key=key) == want


def test_fill_of_nothing(nothing):  # noqa: F811
    assert filled(nothing) == []


# whitening


def plain_whitening(rows, most=16):
    """{vec_id: (deviation, whitened)}, n, explained; exact sums, eigenvectors of the covariance as a matrix."""
    usable = {}
    for i, v in rows:
        if v and all(c is not None and math.isfinite(c) and abs(64 * c) < 2**52 for c in v):
            usable.setdefault(len(v), []).append((i, [math.floor(64 * c) + 1_000_000 for c in v]))
    width = max(usable, key=lambda w: (len(usable[w]), w))
    kept = usable[width]
    fit = sorted(set(map(tuple, (x for _, x in kept))))
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array([[float(Fraction(n * a - s, n)) for a, s in zip(x, sums)] for x in fit])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    trace = values.sum()
    m = min(most, int((values > 1e-13 * values[0]).sum()))
    out = [(i, sum((n * a - s) ** 2 for a, s in zip(x, sums)), np.array([float(Fraction(n * a - s, n)) for a, s in zip(x, sums)]) @ vectors[:, :m] / np.sqrt(values[:m])) for i, x in kept]
    return out, n, values[:m] / trace


def assert_whitened(df, rows, tolerance=1e-9, **options):
    want, n, explained = plain_whitening(rows)
    got = whitening.whiten(df, **options).collect()
    by = lambda r: (r[0] is not None, r[0], r[1])
    got, want = sorted(((r.vec_id, r.deviation, np.array(r.whitened)) for r in got), key=by), sorted(want, key=by)
    assert [r[:2] for r in got] == [r[:2] for r in want]
    a, b = np.array([r[2] for r in got]), np.array([r[2] for r in want])
    signs = np.sign((a * b).sum(axis=0))
    assert np.abs(a * signs - b).max() < tolerance
    first = whitening.whiten(df, **options).first()
    assert first.n == n and np.allclose(first.explained, explained, rtol=1e-9) and first.identity_error < 1e-9


AWKWARD = [None, [], [0.1], [None, 1.0, 2.0], [float("nan"), 0.0, 0.0], [float("inf"), 0.0, 0.0], [1e300, 0.0, 0.0], [0.5, 0.25, 0.125, 1.0]]


def vectors_of(rng, n, width):
    return (rng.normal(size=(n, width)) * np.linspace(3, 0.2, width) + rng.normal(size=width) * 50).tolist()


@pytest.mark.parametrize("block", [1, 7, 4096])
def test_whitening_matches_eigenvectors(spark, block):
    rng = np.random.default_rng(block)
    rows = list(enumerate(vectors_of(rng, 240, 3))) + list(enumerate(AWKWARD, 500))
    rows += [(900 + k, rows[5][1]) for k in range(200)] + [rows[7], rows[7], (None, rows[9][1]), (None, [4.0, 4.0, 4.0])]
    df = spark.createDataFrame([(i, v, "x", "y", 1) for i, v in rows], "vec_id long, embedding array<double>, n string, x string, width int").repartition(11)
    assert_whitened(df, rows, block=block)


def test_whitening_of_the_given_table(spark, sf):
    given = spark.read.parquet(f"{sf}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in given.collect()]
    assert_whitened(given.repartition(9), rows, tolerance=1e-8)
    each = whitening.by_component(whitening.whiten(given))
    assert each.count() == 16 * len(rows) and [r.component for r in each.select("component").distinct().orderBy("component").collect()] == list(range(1, 17))


def test_whitening_without_variance(spark):
    schema = "vec_id long, embedding array<float>"
    one = [(i, [0.5, 0.25]) for i in range(5)]
    assert whitening.whiten(spark.createDataFrame(one, schema)).collect() == []
    assert whitening.whiten(spark.createDataFrame([], schema)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, None), (2, [])], schema)).collect() == []
    flat = [(i, [float(i), 0.25, -float(i)]) for i in range(9)]  # one direction of three
    found = whitening.whiten(spark.createDataFrame(flat, schema)).collect()
    assert len(found) == 9 and all(len(r.whitened) == 1 and r.explained == [pytest.approx(1.0)] for r in found)


def test_large_entries_stay_exact(spark):
    big = 2.0**40
    rows = [(i, [big * i, -big + i, float(i % 3)]) for i in range(20)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = {i: d for i, d, _ in plain_whitening(rows)[0]}
    got = {r.vec_id: r.deviation for r in whitening.whiten(df).collect()}
    assert got == {i: d if d < 2**63 else None for i, d in want.items()} and None in got.values()


def test_rank_one_updates():
    rng = np.random.default_rng(1)
    for trial in range(60):
        d = int(rng.integers(1, 20))
        vectors = np.linalg.qr(rng.normal(size=(d, d)))[0]
        values = np.sort(rng.integers(0, 4, d).astype(float) if trial % 2 else rng.exponential(size=d) * 10.0 ** rng.integers(-8, 4, d))
        v = rng.normal(size=d) * (rng.random(d) < 0.6) * 10.0 ** rng.integers(-3, 3)
        new, turned = whitening.rank_one(values, vectors, v)
        want = vectors @ np.diag(values) @ vectors.T + np.outer(v, v)
        scale = max(np.abs(want).max(), 1e-300)
        assert np.abs(turned @ np.diag(new) @ turned.T - want).max() < 1e-12 * scale
        assert np.abs(turned.T @ turned - np.eye(d)).max() < 1e-12 and np.all(np.diff(new) >= 0)


def test_merged_spectra_equal_one(spark):
    x = np.random.default_rng(4).integers(-30, 30, (500, 12)) + 10**6
    whole, parts = whitening.Spectrum.empty(12), [whitening.Spectrum.empty(12) for _ in range(5)]
    whole.add(x)
    for k, p in enumerate(parts):
        p.add(x[k * 100 : k * 100 + 60])
        p.add(x[k * 100 + 60 : k * 100 + 100])
    for p in parts[1:]:
        parts[0].merge(p)
    assert parts[0].n == 500 and parts[0].sums == whole.sums
    assert np.allclose(parts[0].values, whole.values, rtol=1e-10)
    assert np.allclose(np.abs((parts[0].vectors * whole.vectors).sum(axis=0)), 1, atol=1e-8)


# quality


def test_quality_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    given = spark.read.parquet(f"{sf}/documents.parquet")
    found = quality.classify(given, spark.read.parquet(f"{sf}/labels.parquet")).toPandas()
    assert sorted(found.doc_id) == sorted(r.doc_id for r in given.select("doc_id").collect())
    assert found.score.between(0, 1).all() and (found.predicted == (found.score >= 0.5)).all()
    assert (found.held_out == [zlib.crc32(str(i).encode()) % 3 == 1 for i in found.doc_id]).all()
    known = found.merge(pd.read_parquet(f"{sf}/labels.parquet"), on="doc_id")
    held = known[known.held_out]
    assert (held.quality == held.predicted).mean() >= 0.97 and (held[held.quality == 0].predicted == 0).mean() >= 0.9


def test_quality_learns_nothing_from_held_out_labels(spark):
    sf = "/root/testdata/sf0.001"
    given, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    turned = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    rows = lambda y: sorted(map(tuple, quality.classify(given, y).collect()))
    a, b = rows(labels), rows(turned.withColumn("doc_id", F.col("doc_id")))
    assert [r[0] for r in a] == [r[0] for r in b] and np.allclose([r[2] for r in a], [r[2] for r in b], atol=1e-6)


def test_quality_of_awkward_rows(spark, docs, nothing):  # noqa: F811
    taught = [(i, i % 2, "x", 0.5) for i in range(36)] + [(4, 1, "x", 0.5), (10, None, "x", 0.5), (None, 1, "x", 0.5), (6, 7, "x", 0.5), (4_000, 1, "x", 0.5)]
    labels = spark.createDataFrame(taught, "doc_id long, quality int, text string, margin double")
    rows = docs.unionByName(spark.createDataFrame([(None, t, *[None] * 13) for t in ("some text", None)], SCHEMA))
    found = quality.classify(rows, labels).collect()
    assert sorted((r.doc_id for r in found), key=lambda i: (i is not None, i)) == sorted([None, None, *(r[0] for r in ROWS)], key=lambda i: (i is not None, i))
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) and r.held_out is not None for r in found)
    ids = {r.doc_id for r in quality.preferences(labels).collect()}
    assert 4 not in ids and 10 in ids and None not in ids and all(zlib.crc32(str(i).encode()) % 3 != 1 for i in ids)
    assert quality.classify(nothing, labels).collect() == []


@pytest.mark.parametrize("known, score", [([], 0.5), ([(0, 1), (2, 1)], 1.0), ([(0, 0)], 0.0)])
def test_quality_without_two_labels(spark, docs, known, score):  # noqa: F811
    labels = spark.createDataFrame([r for r in known if zlib.crc32(str(r[0]).encode()) % 3 != 1], "doc_id long, quality int")
    want = score if labels.count() else 0.5
    assert {(r.score, r.predicted) for r in quality.classify(docs, labels).collect()} == {(want, int(want >= 0.5))}


def test_features_are_finite():
    for t in [*(t or "" for t in TEXTS), "\n" * 5, "A", "é" * 9, "a " * 50_000]:
        f = quality.features(t)
        assert len(f) == len(quality.FEATURES) and all(map(math.isfinite, f))


def test_threshold_leaves_the_share_below(spark):
    rows = [(i, float(i) / 10, 0 if i < 30 else 1) for i in range(100)]
    scored = spark.createDataFrame([(i, m) for i, m, _ in rows] + [(500, 3.3)], "doc_id long, margin double")
    taught = spark.createDataFrame([(i, q) for i, _, q in rows], "doc_id long, quality int")
    assert 2.9 < quality.threshold(scored, taught) < 3.0
