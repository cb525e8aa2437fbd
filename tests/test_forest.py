"""The forest against brute force, wherever its subtrees begin, and what of it the driver holds."""

import numpy as np
import pytest
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import functions as F

from speechframe.operators import classify, forest
from speechframe.session import discard, materialize, shared_dir


@pytest.fixture(scope="module")
def noisy(spark):
    """Words and labels that have little to do with each other, so that trees grow down to single rows; some rows come twice."""
    rng = np.random.default_rng(7)
    words = np.array([f"word{i}" for i in range(40)])
    rows = [(i, " ".join(rng.choice(words, rng.integers(1, 60)) if i % 50 else ["word0"]), "abc"[rng.integers(3)]) for i in range(600)]
    return materialize(spark.createDataFrame(rows + rows[:30], "idx long, voice_description string, label string"), "noisy")


def test_trees_are_the_same_wherever_their_subtrees_begin(noisy, monkeypatch):
    words = noisy.select(F.split("voice_description", " ").alias("w"), (F.ascii("label") - F.ascii(F.lit("a"))).cast("double").alias("label_index"))
    vectors = materialize(CountVectorizer(inputCol="w", outputCol="features").fit(words).transform(words).select("label_index", "features"), "vectors")
    rows = materialize(vectors.withColumn("_row", F.monotonically_increasing_id()), "rows")
    told = lambda model: np.array([r.votes for r in model.votes(rows).orderBy("_row").collect()])
    whole = forest.fit(vectors, 40, trees=6, seed=3)
    want = told(whole)
    assert want.shape == (630, 3) and np.allclose(want.sum(axis=1), 6)  # one vote of each tree
    for name, value in (("SUBTREE_BYTES", 100 * 40), ("COUNT_BYTES", 50000), ("BUNDLE_BYTES", 3000), ("LEAST_TREES", 2), ("ROUND_BYTES", 1), ("PLACED_LEVELS", 2), ("PIECE_BYTES", 8000)):
        monkeypatch.setattr(forest, name, value)
    parts = forest.fit(vectors, 40, trees=6, seed=3)
    assert len(parts.subtrees) == 3 and len(list(parts._bundles())) > 3 and max(len(u.feature) for u in parts.uppers) > 9
    assert np.allclose(told(parts), want)


def test_the_driver_does_not_hold_the_trees(noisy):
    model = classify.train_classifier(noisy, trees=6).stages[-2]
    assert sum(len(u.feature) for u in model.uppers) == 6  # the place of the subtree, for each tree
    nodes = sum(len(r.feature) // 4 for table, _ in model.subtrees for r in table.collect())
    assert nodes > 6 * 100


def test_all_of_a_small_tree_is_learned(spark):
    texts = ["red red", "red blue", "blue", "green", ""]
    df = spark.createDataFrame([(i, texts[i % 5], "vwxyz"[i % 5]) for i in range(400)], "idx long, voice_description string, label string")
    got = classify.train_classifier(df, trees=20).transform(df)
    assert got.where("label = prediction_label").count() == 400
    assert got.columns == ["idx", "voice_description", "label", "tokens", "kept", "counts", "features", "label_index", "rawPrediction", "probability", "prediction", "prediction_label"]


def brute(x, label, weight, classes, depth):
    """Nested (feature, cut, left, right) or a leaf's counts, by all splits of all features; joined upwards where leaves say the same."""
    totals = np.bincount(label, weight, classes)
    best = (0.0, None)
    gini = lambda c: c.sum() - (c**2).sum() / c.sum()
    if depth and (totals > 0).sum() > 1:
        for f in range(x.shape[1]):
            for cut in range(x[:, f].max()):
                low = x[:, f] <= cut
                a = np.bincount(label[low], weight[low], classes)
                if a.sum() and (totals - a).sum() and gini(totals) - gini(a) - gini(totals - a) > best[0] + 1e-9:
                    best = (gini(totals) - gini(a) - gini(totals - a), (f, cut))
    if best[1] is None:
        return totals
    f, cut = best[1]
    low = x[:, f] <= cut
    sides = [brute(x[s], label[s], weight[s], classes, depth - 1) for s in (low, ~low)]
    if all(isinstance(s, np.ndarray) for s in sides) and sides[0].argmax() == sides[1].argmax():
        return totals
    return (f, cut, *sides)


def nested(tree, node=0):
    if tree.feature[node] < 0:
        return tree.counts[node]
    return (int(tree.feature[node]), int(tree.cut[node]), nested(tree, tree.left[node]), nested(tree, tree.left[node] + 1))


def same(a, b):
    if isinstance(a, tuple) != isinstance(b, tuple):
        return False
    return a[:2] == b[:2] and same(a[2], b[2]) and same(a[3], b[3]) if isinstance(a, tuple) else bool((a == b).all())


@pytest.mark.parametrize("seed", range(4))
def test_a_tree_against_brute_force(seed, monkeypatch):
    rng = np.random.default_rng(seed)
    x = (rng.integers(0, 4, (150, 6)) * rng.integers(0, 2, (150, 6))).astype(np.uint8)
    label, weight = rng.integers(0, 3, 150), rng.integers(1, 4, 150).astype(np.uint8)
    spec = forest.Spec(1, 1, 6, 6, 3, 7)
    tree = forest.grow(x, label, weight, spec, 0, 1, 0)
    assert same(nested(tree), brute(x, label, weight.astype(float), 3, 7))
    monkeypatch.setattr(forest, "PIECE_BYTES", 2000)
    assert same(nested(forest.grow(x, label, weight, spec, 0, 1, 0)), nested(tree))


def test_draws():
    ids = np.arange(20000) + (3 << 33)
    weight = forest.bag_weights(42, 5, ids)
    assert abs(weight.mean() - 1) < 0.03 and abs((weight == 0).mean() - np.exp(-1)) < 0.02
    assert abs(np.corrcoef(weight, forest.bag_weights(42, 6, ids))[0, 1]) < 0.03
    tried = forest.tried_features(forest.Spec(42, 10, 50, 8, 2, 30), 3, np.arange(1, 20001))
    assert all(len(set(r)) == 8 for r in tried[:500]) and tried.min() == 0 and tried.max() == 49
    assert np.allclose(np.bincount(tried.ravel(), minlength=50) / 20000, 8 / 50, atol=0.015)


def test_cut_points_and_bins(spark):
    assert forest.cut_points(np.array([0.0, 1, 3]), np.array([5, 1, 1])).tolist() == [0.5, 2.0]
    many = forest.cut_points(np.arange(100.0), np.ones(100, int))
    assert len(many) == 31 and (np.diff(many) > 2).all() and (np.diff(many) < 5).all()
    df = spark.createDataFrame([(1, ["a", "a", "a", "b"]), (2, []), (3, ["b"]), (4, ["b", "a"])], "k long, w array<string>")
    vectors = CountVectorizer(inputCol="w", outputCol="v").fit(df).transform(df).drop("w")
    cuts = forest.find_cuts(vectors.select("v"), 2, 4)
    assert [c[np.isfinite(c)].tolist() for c in cuts] == [[0.5, 2.0], [0.5]]
    got = {r.k: np.frombuffer(r.codes, np.uint16).tolist() for r in forest.binned(vectors, "v", cuts).collect()}
    assert got == {1: [2, 32 + 1], 2: [], 3: [32 + 1], 4: [1, 32 + 1]}


def test_discard_deletes_one_table(spark):
    kept, gone = materialize(spark.range(3), "kept"), materialize(spark.range(3), "gone")
    discard(gone)
    assert kept.count() == 3 and shared_dir(spark) in gone._written
    with pytest.raises(Exception):
        spark.read.parquet(gone._written)
    with pytest.raises(AttributeError):
        discard(kept.select("id"))


def test_depth_is_bounded(noisy):
    with pytest.raises(ValueError):
        forest.fit(noisy.select(F.lit(0.0).alias("label_index")), 1, max_depth=31)
    shallow = classify.train_classifier(noisy, trees=2, max_depth=0).transform(noisy)
    assert shallow.select("prediction").distinct().count() == 1


def test_test_rows_come_whole_from_a_model_that_the_driver_does_not_hold(spark, monkeypatch):
    """Rows are told apart by themselves, not by their key, which may repeat or be null."""
    texts = ["a warm sound", "a deep sound", "a young sound", "a sound", None]
    df = spark.createDataFrame([(None if i % 9 == 0 else i // 2, texts[i % 5]) for i in range(300)], "idx long, voice_description string")
    models, train = [], classify.train_classifier
    monkeypatch.setattr(classify, "train_classifier", lambda *a, **k: models.append(train(*a, **k)) or models[-1])
    predicted, trained = classify.predict_test_rows(df, trees=8)
    labelled = classify.train_test(classify.label_characters(df).where("label IS NOT NULL"))
    rows = lambda d: sorted(map(str, d.select("idx", "voice_description", "label").collect()))
    assert rows(predicted) == rows(labelled.where("is_test")) and rows(trained) == rows(labelled.where("NOT is_test"))
    assert predicted.where("label = prediction_label").count() == predicted.count()
    assert sum(len(u.feature) for u in models[0].stages[-2].uppers) == 8
