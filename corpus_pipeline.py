"""The corpus pipeline: each stage reads what its predecessor kept and writes what it keeps.

    run(spark, sf_dir)

A stage takes (spark, docs, sf_dir) and returns the rows it keeps with the columns of ``documents``; the last returns the
encoded documents. Between stages the rows go through a table in the shared folder.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from speechframe.llm import bpe, decontaminate, language_id, line_dedup, near_dedup
from speechframe.llm.common import small, table, with_ids, without_number
from speechframe.llm.queries import DOCUMENTS, LINE_LEAST, LINE_RATIO, RANKS
from speechframe.session import materialize


#: Rows that Spark hands to a Python worker at a time. A batch of its usual 10,000 whole texts (34 MB of the check tool's) is held
#: several times over in the JVM and in the worker, beside what earlier stages have left in the executor.
BATCH_ROWS = 2_000
#: Bytes at which such a batch ends, however few its rows are. Spark's usual 64 MB leave 2,000 long texts whole, and both sides
#: keep buffers of the largest batch.
BATCH_BYTES = 1 << 20
#: Distinct parts of texts that a task of the encoder keeps here; it works beside what four stages have left in the executor.
KEPT_PARTS = 100_000


def in_small_batches(spark: SparkSession) -> None:
    """Texts go to Python in batches of ``BATCH_ROWS`` and ``BATCH_BYTES`` at most, from this session's next plan on; results do not depend on it."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a language can be told; a ``lang`` that is missing becomes the language found."""
    in_small_batches(spark)
    found = language_id.identify(docs, language_id.fit(docs), extra=["text", "lang", "source", "n_chars"])
    return found.filter(F.col("lang_pred") != "und").withColumn("lang", F.coalesce("lang", "lang_pred")).select(DOCUMENTS)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their site's boilerplate lines; a document of nothing else goes.

    Copies count once here, as one of them is to be left for the next stage to keep.
    """
    cleaned = line_dedup.line_dedup(docs, ratio=LINE_RATIO, least=LINE_LEAST, copies=False)
    return cleaned.filter((F.col("n_dropped") == 0) | (F.trim("text") != "")).withColumn("n_chars", F.char_length("text").cast("long")).select(DOCUMENTS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five words to a shingle, a similarity of 0.8 or more.

    Rows that share a doc_id are one document, of which the row with the greatest text stays; rows without an id are each their own.
    """
    in_small_batches(spark)
    docs = with_ids(docs)
    found = near_dedup.numbered_components(docs, words=5, share=80).groupBy("doc_id").agg(F.bool_or("kept").alias("kept"))
    # fewer go than stay: their ids are sent to the texts, which stay where they are
    dropped = materialize(found.filter("NOT kept").select("doc_id"), "dropped")
    rows = docs.join(small(dropped), "doc_id", "left_anti").select(DOCUMENTS)
    repeated = materialize(docs.groupBy("doc_id").count().filter("count > 1").select("doc_id"), "repeated")
    greatest = rows.join(small(repeated), "doc_id", "left_semi").groupBy("doc_id").agg(F.max(F.struct(*DOCUMENTS[1:])).alias("row"))
    once = rows.join(small(repeated), "doc_id", "left_anti").unionByName(greatest.select("doc_id", "row.*"))
    return once.withColumn("doc_id", without_number("doc_id"))


def drop_benchmark_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words stand inside windows of benchmark items."""
    docs = with_ids(docs)
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"))
    contaminated = materialize(found.filter("contaminated").select("doc_id", "tag").distinct(), "contaminated")
    # ids are sent to the texts, which stay where they are
    clean = docs.withColumn("tag", F.hash("text")).join(small(contaminated), ["doc_id", "tag"], "left_anti").select(DOCUMENTS)
    return clean.withColumn("doc_id", without_number("doc_id"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    in_small_batches(spark)
    return bpe.encode(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN, KEPT_PARTS)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_lines),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_benchmark_copies),
    ("byte_bpe", encode),
]

#: Language scores and signatures are not expressible in SQL; the pipeline is tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
