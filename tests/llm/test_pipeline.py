"""The corpus pipeline against what a plain reading of its stages gives on a small corpus."""

import random

import public_tokenizers
import pyarrow as pa

import corpus_pipeline
from speechframe.llm import bpe
from speechframe.llm.queries import DOCUMENTS

PASSAGE = "the quick brown fox jumps over the lazy dog while seven small birds watch from a tall old oak tree near the river"


def write(spark, folder, docs):
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, PASSAGE)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")


def test_each_stage_takes_what_it_should(spark, tmp_path):
    rng = random.Random(3)
    words = ["".join(rng.choices("etaoinshr", k=rng.randint(3, 8))) for _ in range(400)]
    prose = lambda n: " ".join(rng.choices(words, k=n))
    docs = {i: f"Boilerplate of the site\n{prose(60)}" for i in range(20)}
    docs |= {20: "123 ... 456", 21: None, 22: "", 23: "Boilerplate of the site"}
    docs |= {24: docs[3], 25: docs[4].replace(docs[4].split()[30], "changed", 1)}
    docs |= {26: PASSAGE, 27: prose(20) + " " + PASSAGE, 28: prose(900) + " " + PASSAGE}
    write(spark, tmp_path, [(i, t, "en", "s", len(t or "")) for i, t in docs.items()])
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    # no letters: 20-22; nothing left: 23; copies: 24, 25; contaminated: 26, 27 (28 holds too little of the passage)
    assert sorted(r.doc_id for r in rows) == [*range(20), 28]
    encoder = bpe.Encoder(bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), public_tokenizers.PATTERN)
    for r in rows:
        text = docs[r.doc_id].removeprefix("Boilerplate of the site\n")
        assert r.n_tokens == len(encoder.encode(text))


def test_one_of_a_large_group_of_copies_stays(spark, tmp_path):
    rng = random.Random(8)
    words = ["".join(rng.choices("etaoinshr", k=rng.randint(3, 8))) for _ in range(400)]
    prose = lambda n: " ".join(rng.choices(words, k=n))
    copied = f"{prose(40)}\n{prose(40)}"
    texts = [f"Boilerplate of the site\n{prose(60)}" for _ in range(20)] + [f"Boilerplate of the site\n{copied}"] * 8 + [f"{copied}\n"] * 4
    write(spark, tmp_path, [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)])
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    cleaned = {r.doc_id: r.text for r in corpus_pipeline.drop_lines(spark, docs, str(tmp_path)).collect()}
    assert cleaned == {i: t.removeprefix("Boilerplate of the site\n") for i, t in enumerate(texts)}
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert [r.doc_id for r in rows if r.doc_id >= 20] == [20] and len(rows) == 21


def test_stages_return_the_columns_of_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "near_dedup", "decontamination", "byte_bpe"]
    for _, stage in corpus_pipeline.STAGES[:2]:
        assert stage(spark, docs, sf).columns == DOCUMENTS


def test_texts_are_not_moved_to_leave_documents_out(spark, tmp_path):
    rng = random.Random(5)
    write(spark, tmp_path, [(i, " ".join(rng.choices("abcdefghij", k=60)), "en", "s", 119) for i in range(20)] + [(20, PASSAGE, "en", "s", len(PASSAGE))])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
        for stage in (corpus_pipeline.drop_near_copies, corpus_pipeline.drop_benchmark_copies):
            plan = stage(spark, docs, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
            assert "LeftAnti" in plan and not [x for x in plan.splitlines() if "SortMergeJoin" in x and "LeftAnti" in x and "doc_id" in x], plan
        assert 20 not in [r.doc_id for r in corpus_pipeline.drop_benchmark_copies(spark, docs, str(tmp_path)).collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_an_empty_corpus(spark, tmp_path):
    write(spark, tmp_path, [])
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_missing_and_repeated_ids(spark, tmp_path):
    rng = random.Random(9)
    words = ["".join(rng.choices("etaoinshr", k=rng.randint(3, 8))) for _ in range(400)]
    prose = lambda n: " ".join(rng.choices(words, k=n))
    alone, copied, twice = prose(60), prose(60), prose(60)
    docs = [(i, prose(60)) for i in range(10)] + [(None, alone), (None, copied), (3_000, copied), (None, PASSAGE), (40, twice), (40, twice), (41, twice)]
    write(spark, tmp_path, [(i, t, "en", "s", len(t)) for i, t in docs])
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    # the copy with an id stays, of the repeated row one; the text without an id that is like no other stays too
    assert sorted(r.doc_id for r in rows if r.doc_id is not None) == [*range(10), 40, 3_000]
    assert len([r for r in rows if r.doc_id is None]) == 1


def test_texts_go_to_python_in_small_batches(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    usual = spark.conf.get(key)
    try:
        docs = spark.range(5).selectExpr("id AS doc_id", "'some text' AS text")
        encoded = corpus_pipeline.encode(spark, docs, "")
        assert int(spark.conf.get(key)) <= corpus_pipeline.BATCH_ROWS < 10_000
        assert encoded.count() == 5
    finally:
        spark.conf.set(key, usual)


def test_long_texts_go_to_python_few_at_a_time(spark, tmp_path):
    keys = ["spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"]
    usual = [spark.conf.get(key) for key in keys]

    def held(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"rows": [b.num_rows], "bytes": [b.nbytes]})

    try:
        spark.range(0, 400, 1, 1).selectExpr("id AS doc_id", "repeat('long text ', 2000) AS text").write.parquet(f"{tmp_path}/long")
        corpus_pipeline.in_small_batches(spark)
        found = spark.read.parquet(f"{tmp_path}/long").mapInArrow(held, "rows long, bytes long").collect()
        assert sum(r.rows for r in found) == 400 and max(r.bytes for r in found) <= 2 * corpus_pipeline.BATCH_BYTES
    finally:
        for key, value in zip(keys, usual):
            spark.conf.set(key, value.removesuffix("b"))


def test_a_worker_keeps_no_parts_of_texts_after_a_task():
    content = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    first = bpe.encoder(content, public_tokenizers.PATTERN, 100)
    once = list(first.encoded([PASSAGE]))
    second = bpe.encoder(content, public_tokenizers.PATTERN, 100)
    assert first.known.now and not second.known.now and second.ranks is first.ranks
    assert list(second.encoded([PASSAGE])) == once
