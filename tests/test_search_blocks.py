"""Search by blocks of postings next to the cosine of every row."""

import math
import random
from collections import Counter

import pytest

from speechframe.operators import text_search
from speechframe.session import workspace

WORDS = [f"word{i}" for i in range(60)]


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(3)
    # a few words are in nearly every row, a third of the rows are the same, some have no word at all
    texts = [" ".join(rng.choices(WORDS, weights=[1 / (i + 1) for i in range(60)], k=rng.randint(1, 30))) for _ in range(2_000)]
    texts += ["word1 word1 word30"] * 1_000 + ["", None, "!"] * 5
    rows = [(i, f"S_{i}", t, None, None, None) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "idx long, speaker_id string, voice_description string, gender string, age string, accent string").repartition(5).cache()


@pytest.fixture(scope="module")
def index(spark, corpus):
    return text_search.search_index(corpus, workspace(spark, "blocks"), max_features=100, block_rows=16)


def plain(rows, query, k):
    """(key, similarity) of the best rows: cosine of TF-IDF vectors, rounded, ties by key."""
    counts = {i: Counter((t or "").split()) for i, t in rows}
    counts = {i: Counter({w: n for w, n in c.items() if len(w) > 1}) for i, c in counts.items()}
    seen = Counter(w for c in counts.values() for w in c)
    idf = {w: math.log((1 + len(rows)) / (1 + n)) + 1 for w, n in seen.items()}
    asked = {w: n * idf[w] for w, n in Counter(query.split()).items() if w in idf}
    length = lambda v: math.sqrt(sum(x * x for x in v.values())) or 1.0
    out = []
    for i, c in counts.items():
        own = {w: n * idf[w] for w, n in c.items()}
        out.append((i, round(sum(own.get(w, 0) * x for w, x in asked.items()) / length(own) / length(asked), 9)))
    return sorted(out, key=lambda r: (-r[1], r[0]))[:k]


@pytest.mark.parametrize("query", ["word1 word30", "word50", "word0 word1 word2 word40", "word59 word58 word57 word57", "unseen", "word0 unseen", ""])
@pytest.mark.parametrize("k", [1, 5, 60])
def test_same_rows_as_the_full_sum(corpus, index, query, k):
    want = plain([(r.idx, r.voice_description) for r in corpus.select("idx", "voice_description").collect()], query, k)
    got = [(r.idx, round(r.similarity, 9)) for r in text_search.search(corpus, index, query, k).collect()]
    assert got == want


def test_fewer_blocks_are_read(spark, corpus, index):
    asked = text_search._asked(spark, index, "word1 word30", (1, 1), text_search.ENGLISH_STOP_WORDS)
    listed = spark.read.parquet(f"{index}/blocks").where(text_search.F.col("term").isin(list(asked)))
    blocks, least = text_search.blocks_above(spark, index, asked, 5)
    assert 0 < least <= 1 and blocks.count() < listed.count() / 2
    everything, none = text_search.blocks_above(spark, index, asked, 100_000)
    assert none == 0 and everything.count() == listed.count()


def test_blocks_hold_falling_weights(spark, index):
    blocks = spark.read.parquet(f"{index}/blocks").collect()
    assert all(len(b.keys) == len(b.weights) <= 16 and b.top == b.weights[0] and b.weights == sorted(b.weights, reverse=True) for b in blocks)
    assert sum(len(b.keys) for b in blocks) == spark.read.parquet(f"{index}/vectors").selectExpr("sum(size(v)) AS n").first().n


def test_only_the_rows_folders_are_read(spark, corpus, index):
    plan = text_search.search(corpus, index, "word50", 1)._jdf.queryExecution().toString()
    assert any("PartitionFilters" in line and "folder" in line.split("PartitionFilters")[1].split("]")[0] for line in plan.split("\n"))
