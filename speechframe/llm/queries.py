"""The registered queries of this folder, each over its whole table with production parameters, and their SQL where there is any."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from speechframe.llm import bpe, decontaminate, exact_dedup, fill_middle, html_text, language_id, line_dedup, near_dedup, quality, secret_scan, substring_dedup, tokens, whitening
from speechframe.llm.common import table

COUNTED = "byte_bpe_50k.json"
RANKS = "byte_bpe_multi_50k.tiktoken"
#: Share of a site's rows above which a line is boilerplate.
LINE_RATIO, LINE_LEAST = 0.1, 5

DOCUMENTS = ["doc_id", "text", "lang", "source", "n_chars"]


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_scan(table(spark, sf_dir, "documents"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(COUNTED), public_tokenizers.PATTERN)


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op4_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_dedup(table(spark, sf_dir, "documents"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("tag")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.language_id(table(spark, sf_dir, "documents"))


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_dedup(table(spark, sf_dir, "documents"), words=2, share=80)


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_dedup.line_dedup(table(spark, sf_dir, "documents"), ratio=LINE_RATIO, least=LINE_LEAST)
    return cleaned.select("doc_id", "n_lines", "n_dropped", "text")


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(table(spark, sf_dir, "documents"), public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


def op11_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.by_component(whitening.whiten(table(spark, sf_dir, "embeddings")))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_middle.fill_in_middle(table(spark, sf_dir, "documents"))
    digests = [F.sha2("output", 256).alias("output_sha256"), F.sha2(fill_middle.restore(F.col("output"), F.col("form")), 256).alias("restored_sha256")]
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


QUERIES = {
    f.__name__: f
    for f in (
        op1_secret_scan,
        op2_token_counts,
        op3_exact_dedup,
        op4_suffix_array_dedup,
        op5_decontamination,
        op6_language_id,
        op7_html_extraction,
        op8_minhash_near_dedup,
        op9_line_dedup,
        op10_byte_bpe,
        op11_quality_classifier,
        op12_embedding_whitening,
        op13_fill_in_middle,
    )
}

ORACLE = {
    "op3_exact_dedup": r"""
WITH t AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY 1)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM t JOIN g USING (text_sha256)""",
    "op5_decontamination": decontaminate.SQL,
    "op9_line_dedup": line_dedup.SQL.format(ratio=LINE_RATIO, least=LINE_LEAST),
    "op13_fill_in_middle": fill_middle.SQL,
}
