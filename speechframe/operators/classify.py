"""Character labels, the character classifier and its report."""

from pyspark.ml import PipelineModel
from pyspark.ml.feature import IDF, CountVectorizer, IndexToString, RegexTokenizer, StopWordsRemover, StringIndexer
from pyspark.sql import DataFrame, functions as F

from speechframe.functions.scalars import character_type
from speechframe.operators import forest
from speechframe.operators.sampling import train_test
from speechframe.operators.text_search import ENGLISH_STOP_WORDS, TOKEN
from speechframe.session import materialize


def label_characters(df: DataFrame, key: str = "idx") -> DataFrame:
    return df.select(key, "voice_description", character_type("voice_description").alias("label"))


class CharacterModel(PipelineModel):
    """Text stages, forest and names; the rows are numbered before they are cut into words, so that only their own columns are written."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        *text, trees, names = self.stages
        rows = materialize(dataset.withColumn("_row", F.monotonically_increasing_id()), "rows")
        return names.transform(trees.predict(PipelineModel(text).transform(rows)))


def train_classifier(df: DataFrame, max_features: int = 500, trees: int = 100, seed: int = 42, max_depth: int = 30, stop=ENGLISH_STOP_WORDS):
    """Fit TF-IDF and a random forest on ``(voice_description, label)``; the model adds ``prediction_label``.

    The texts are cut into words once. The forest is grown by the tasks and left in the shared folder (``forest``): fully grown
    trees have about as many nodes as there are rows, which the driver cannot hold.
    """
    cut = PipelineModel(
        [
            RegexTokenizer(inputCol="voice_description", outputCol="tokens", pattern=TOKEN, gaps=False),
            StopWordsRemover(inputCol="tokens", outputCol="kept", stopWords=list(stop)),
        ]
    )
    words = materialize(cut.transform(df).select("label", "kept"), "words")
    counts = CountVectorizer(inputCol="kept", outputCol="counts", vocabSize=max_features).fit(words)
    counted = materialize(counts.transform(words).select("label", "counts"), "counts")
    weights = IDF(inputCol="counts", outputCol="features").fit(counted)
    labels = StringIndexer(inputCol="label", outputCol="label_index", handleInvalid="keep").fit(counted)
    features = labels.transform(weights.transform(counted)).select("label_index", "features")
    trees = forest.fit(features, len(counts.vocabulary), trees, seed, max_depth)
    names = IndexToString(inputCol="prediction", outputCol="prediction_label", labels=labels.labels)
    return CharacterModel([*cut.stages, counts, weights, labels, trees, names])


def predict_test_rows(df: DataFrame, test_share: float = 0.2, seed: int = 42, key: str = "idx", **options) -> tuple[DataFrame, DataFrame]:
    """(predicted, trained): the test rows with ``label`` and ``prediction_label`` of a model of the other rows, and those.

    Rows are labelled once, into a table.
    """
    labelled = label_characters(df, key).where(F.col("label").isNotNull())
    split = materialize(train_test(labelled, test_share, seed, key), "labelled")
    trained = split.where(~F.col("is_test"))
    return train_classifier(trained, seed=seed, **options).transform(split.where("is_test")), trained


def evaluate_classifier(df: DataFrame, test_share: float = 0.2, seed: int = 42, key: str = "idx", **options) -> DataFrame:
    """Train on 80 % of the labelled rows and report on the rest."""
    return classification_report(predict_test_rows(df, test_share, seed, key, **options)[0], "label", "prediction_label")


def classification_report(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Precision, recall, F1 and support per label, then accuracy, macro and weighted averages.

    Everything follows from the confusion counts, one row per (label, prediction).
    """
    confusion = df.groupBy(F.col(label).cast("string").alias("l"), F.col(prediction).cast("string").alias("p")).agg(
        F.count("*").alias("n")
    )
    hit = F.when(F.col("l") == F.col("p"), F.col("n")).otherwise(0)
    sides = confusion.select(
        F.inline(
            F.array(
                F.struct(F.col("l").alias("label"), hit.alias("hit"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("predicted")),
                F.struct(F.col("p").alias("label"), F.lit(0).cast("bigint").alias("hit"), F.lit(0).cast("bigint").alias("support"), F.col("n").alias("predicted")),
            )
        )
    )
    sums = sides.groupBy("label").agg(*[F.sum(c).alias(c) for c in ["hit", "support", "predicted"]])
    ratio = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    scored = sums.select(
        "label",
        "hit",
        "support",
        ratio(F.col("hit"), F.col("predicted")).alias("precision"),
        ratio(F.col("hit"), F.col("support")).alias("recall"),
    )
    p, r = F.col("precision"), F.col("recall")
    scored = scored.withColumn("f1", ratio(2.0 * p * r, p + r))
    measures = ["precision", "recall", "f1"]
    weighted = lambda c: ratio(F.sum(F.col(c) * F.col("support")), F.sum("support"))
    accuracy = ratio(F.sum("hit"), F.sum("support"))
    summary = scored.agg(
        F.sum("support").alias("support"),
        F.struct(*[accuracy.alias(c) for c in measures]).alias("accuracy"),
        F.struct(*[F.avg(c).alias(c) for c in measures]).alias("macro"),
        F.struct(*[weighted(c).alias(c) for c in measures]).alias("weighted"),
    )
    lines = [("accuracy", "accuracy"), ("macro avg", "macro"), ("weighted avg", "weighted")]
    averages = summary.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(name).alias("label"), *[F.col(s)[c].alias(c) for c in measures], F.col("support").alias("support"))
                    for name, s in lines
                ]
            )
        )
    )
    return scored.select("label", *measures, "support").unionByName(averages)
