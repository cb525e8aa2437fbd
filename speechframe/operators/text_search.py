"""Trait and word counts, TF-IDF weights and similarity search over descriptions."""

from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from speechframe.functions.scalars import words
from speechframe.functions.waveform import bind
from speechframe.operators.joins import bounded
from speechframe.operators.ordinal import top_k_per_group
from speechframe.operators.records import demographics
from speechframe.operators.stats import top_k
from speechframe.session import materialize, ship_package

# Trait words by category, and the flat list.
TRAITS = {
    "pitch": ["high", "low", "medium", "deep", "pitch"],
    "tone": ["warm", "cool", "bright", "dark", "rich", "thin"],
    "quality": ["smooth", "raspy", "clear", "breathy", "nasal", "gravelly"],
}
FLAT_TRAITS = ["warm", "cool", "bright", "dark", "deep", "high", "low", "smooth", "raspy", "clear", "breathy"]

# English function words, the default stop list. Pass another one as ``stop``.
ENGLISH_STOP_WORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers
herself it its itself they them their theirs themselves what which who whom this that these those am is are
was were be been being have has had having do does did doing would should could ought a an the and but if or
because as until while of at by for with about against between into through during before after above below
to from up down in out on off over under again further then once here there when where why how all any both
each few more most other some such no nor not only own same so than too very can will just now
""".split()

UNIGRAM_1000 = {"max_features": 1000, "ngrams": (1, 1)}
BIGRAM_1000 = {"max_features": 1000, "ngrams": (1, 2)}
UNIGRAM_500 = {"max_features": 500, "ngrams": (1, 1)}
UNIGRAM_200 = {"max_features": 200, "ngrams": (1, 1)}


def _hits(text: str, vocabulary) -> Column:
    pattern = r"(?U)\b(" + "|".join(vocabulary) + r")\b"
    return F.regexp_extract_all(F.lower(text), F.lit(pattern), F.lit(1))


def trait_counts(df: DataFrame, vocabulary=TRAITS, k: int = 5, column: str = "voice_description") -> DataFrame:
    """Whole-word hits per category, the ``k`` most common each.

    The text is searched once for all words; the categories are attached to the few counts.
    """
    every = list(dict.fromkeys(w for ws in vocabulary.values() for w in ws))
    counted = df.select(F.explode(_hits(column, every)).alias("trait")).groupBy("trait").agg(F.count("*").alias("count"))
    homes = [F.struct(F.lit(c).alias("category"), F.array(*map(F.lit, ws)).alias("words")) for c, ws in vocabulary.items()]
    listed = counted.select("trait", "count", F.inline(F.array(*homes))).where(F.array_contains("words", F.col("trait")))
    return top_k_per_group(listed.drop("words"), "category", [F.desc("count"), F.asc("trait")], k)


def trait_counts_flat(df: DataFrame, vocabulary=FLAT_TRAITS, k: int = 10, column: str = "voice_description") -> DataFrame:
    return top_k(df.select(F.explode(_hits(column, vocabulary)).alias("trait")), "trait", k)


def word_frequency(df: DataFrame, k: int = 20, column: str = "voice_description") -> DataFrame:
    """The ``k`` most frequent lower-cased words, punctuation kept."""
    return top_k(df.select(F.explode(words(F.lower(column))).alias("word")), "word", k).withColumnRenamed("value", "word")


# --- TF-IDF ------------------------------------------------------------------------------------


# A token of two or more word characters. Lower-case letters of common texts are tested before the
# Unicode class, and what was matched is never given back.
TOKEN = r"(?U)[a-z0-9_\x{df}-\x{f6}\x{f8}-\x{ff}\w]{2,}+"


def tokens_of(text: str, stop=ENGLISH_STOP_WORDS) -> Column:
    """Lower-cased tokens of two or more word characters without stop words."""
    tokens = F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))
    return F.filter(tokens, lambda t: ~t.isin(*stop)) if stop else tokens


def _neighbours(words: Column, n: int) -> Column:
    """Every run of ``n`` consecutive words, as arrays."""
    count = F.greatest(F.size(words) - (n - 1), F.lit(0))
    runs = F.transform(F.slice(words, F.lit(1), count), lambda w: F.array(w))
    for i in range(2, n + 1):
        runs = F.zip_with(runs, F.slice(words, F.lit(i), count), lambda run, w: F.array_append(run, w))
    return runs


def grams_of(words: Column, ngrams=(1, 1)) -> Column:
    """All n-grams of a list of words; bind the list when it is not a column."""
    low, high = ngrams
    kinds = [words] if low == 1 else []
    for n in range(max(low, 2), high + 1):
        kinds.append(F.transform(_neighbours(words, n), lambda run: F.array_join(run, " ")))
    return F.concat(*kinds)


def terms(text: str, ngrams=(1, 1), stop=ENGLISH_STOP_WORDS) -> Column:
    """All n-grams of the tokens, formed after the stop words are gone."""
    if ngrams == (1, 1):
        return tokens_of(text, stop)
    return bind(tokens_of(text, stop), lambda words: grams_of(words, ngrams))


def _counted(words: DataFrame, ngrams) -> DataFrame:
    return words.select(F.explode(grams_of(F.col("words"), ngrams)).alias("term")).groupBy("term").agg(F.count("*").alias("total"))


def _counted_among(words: DataFrame, n: int, frequent: DataFrame) -> DataFrame:
    """Counts of the n-grams all of whose words are listed. Spark broadcasts the list while it is small enough."""
    runs = words.select(F.explode(_neighbours(F.col("words"), n)).alias("run"))
    for i in range(n):
        runs = runs.withColumn("word", F.col("run")[i]).join(frequent.withColumnRenamed("term", "word"), "word", "left_semi")
    return runs.groupBy(F.array_join("run", " ").alias("term")).agg(F.count("*").alias("total"))


# Words that a task looks at in one piece, and listed words that tasks are given; more of these are joined by Spark.
PIECE_WORDS = 1_000_000
LISTED_WORDS = 100_000


def _pieces(batches):
    """The batches in pieces of at most ``PIECE_WORDS`` words, or one row."""
    for batch in batches:
        upto, at = np.cumsum(pc.fill_null(pc.list_value_length(batch.column("words")), 0).to_numpy(), dtype=np.int64), 0
        while at < len(upto):
            stop = max(at + 1, int(np.searchsorted(upto, PIECE_WORDS + (upto[at - 1] if at else 0), side="right")))
            yield batch.slice(at, stop - at)
            at = stop


def _rows_and_places(words: pa.Array, listed: pa.Array):
    """Of each word of a column of lists: the number of its row, and its place in ``listed`` or -1."""
    row = np.repeat(np.arange(len(words)), pc.fill_null(pc.list_value_length(words), 0).to_numpy())
    flat = words.flatten()
    return row, pc.fill_null(pc.index_in(flat, value_set=listed.cast(flat.type)), -1).to_numpy().astype(np.int64)


def _longer(runs, row, place, n: int, size: int):
    """Numbers of the runs of ``n`` words that begin at each word, from those of ``n`` - 1 words; -1 where a word is not listed or in another row."""
    out = np.full(len(runs), -1, np.int64)
    if len(runs) >= n:
        first, last = runs[: len(runs) - n + 1], place[n - 1 :]
        out[: len(first)] = np.where((first >= 0) & (last >= 0) & (row[: len(first)] == row[n - 1 :]), first * size + last, -1)
    return out


def _mapped(words: DataFrame, fn, schema) -> DataFrame:
    """``mapInArrow`` over pieces of the written lists; ``fn`` gives the record batch of one."""
    ship_package(words.sparkSession)
    return words.mapInArrow(lambda batches: map(fn, _pieces(batches)), schema)


def _run_counts(words: DataFrame, high: int, listed: list[str]) -> DataFrame:
    """As ``_counted_among`` for 2 to ``high`` words, with the words as numbers; ``listed`` words to the power of ``high`` are below 2^63."""

    def count(batch):
        names = pa.array(listed, pa.string())
        row, place = _rows_and_places(batch.column("words"), names)
        runs, terms, totals = place, [], []
        for n in range(2, high + 1):
            runs = _longer(runs, row, place, n, len(names))
            found, times = np.unique(runs[runs >= 0], return_counts=True)
            parts = [names.take(pa.array(found // len(names) ** i % len(names))) for i in range(n - 1, -1, -1)]
            terms.append(pc.binary_join_element_wise(*parts, " "))
            totals.append(times)
        return pa.RecordBatch.from_arrays([pa.concat_arrays(terms), pa.array(np.concatenate(totals), pa.int64())], ["term", "total"])

    return _mapped(words.select("words"), count, "term string, total long").groupBy("term").agg(F.sum("total").alias("total"))


def vocabulary(words: DataFrame, max_features: int, ngrams=(1, 1)) -> DataFrame:
    """``term`` and ``total`` of the ``max_features`` most frequent terms of the lists ``words``, ties by the term.

    An n-gram is at most as frequent as its rarest word. The words are counted first, and an n-gram can only
    reach the vocabulary when all its words are as frequent as the last word that would; the many rare n-grams
    are then neither made nor shuffled.
    """
    low, high = ngrams
    if high == 1 or low > 1:
        counted = _counted(words, ngrams)
    else:
        counted = single = materialize(_counted(words, (1, 1)), "words")
        last = single.orderBy(F.desc("total")).limit(max_features).agg(F.min("total")).scalar()
        frequent = materialize(single.where(F.col("total") >= last).select("term"), "frequent")
        listed = [r.term for r in frequent.limit(LISTED_WORDS + 1).collect()]
        if 0 < len(listed) <= LISTED_WORDS and len(listed) ** high < 2**63:
            counted = counted.unionByName(_run_counts(words, high, listed))
        else:
            for n in range(2, high + 1):
                counted = counted.unionByName(_counted_among(words, n, frequent))
    return counted.orderBy(F.desc("total"), "term").limit(max_features)


def _levels(names: list[str]):
    """(words, levels): the words of the terms, and for each length the sorted numbers of the terms' beginnings of that length.

    The number of a beginning is the place of the one a word shorter, times the number of words, plus the place of its last word.
    ``levels`` also holds the place in ``names`` of each beginning, -1 where it is no term.
    """
    split = [name.split(" ") for name in names]
    words = sorted({w for term in split for w in term})
    place = {w: i for i, w in enumerate(words)}
    levels, before = [], {(): 0}
    for n in range(1, max(map(len, split), default=0) + 1):
        codes = {tuple(t[:n]): before[tuple(t[: n - 1])] * len(words) + place[t[n - 1]] for t in split if len(t) >= n}
        order = sorted(codes, key=codes.get)
        before = {run: i for i, run in enumerate(order)}
        term = np.full(len(order), -1, np.int64)
        for i, t in enumerate(split):
            if len(t) == n:
                term[before[tuple(t)]] = i
        levels.append((np.array([codes[run] for run in order], np.int64), term))
    return words, levels


def _term_counts(words: DataFrame, names: list[str], also) -> DataFrame:
    """(key, terms, counts) of every row that has one of the terms: their places in ``names``, and how often they occur."""
    listed, levels = _levels(names)
    head = [*also, "key"]
    key_types = ", ".join(f"{c} {words.schema[c].dataType.simpleString()}" for c in head)

    def count(batch):
        row, place = _rows_and_places(batch.column("words"), pa.array(listed, pa.string()))
        runs, found = np.where(place >= 0, 0, -1), []
        for n, (codes, term) in enumerate(levels, 1):
            runs = place if n == 1 else _longer(runs, row, place, n, len(listed))
            at = np.searchsorted(codes, runs).clip(max=len(codes) - 1)
            runs = np.where(codes[at] == runs, at, -1)
            named = np.where(runs >= 0, term[runs], -1)
            found.append(row[named >= 0] * len(names) + named[named >= 0])
        each, times = np.unique(np.concatenate(found), return_counts=True)
        rows, sizes = np.unique(each // len(names), return_counts=True)
        offsets = pa.array(np.append(0, np.cumsum(sizes)), pa.int32())
        lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in ((each % len(names)).astype(np.int32), times.astype(np.int64))]
        return pa.RecordBatch.from_arrays([*(batch.column(c).take(pa.array(rows)) for c in head), *lists], [*head, "terms", "counts"])

    return _mapped(words.select(*head, "words"), count, f"{key_types}, terms array<int>, counts array<bigint>")


def term_vectors(df: DataFrame, text: str = "voice_description", key: str = "idx", max_features: int = 1000, ngrams=(1, 1), stop=ENGLISH_STOP_WORDS, also=()):
    """(vectors, names, idf): written ``(key, terms, counts)``, one row for each key with terms; and by their places the terms and their idf.

    The texts are cut into words once. ``also`` names columns that tell rows apart besides the key. A vector has at most
    ``max_features`` entries, which bounds what the driver holds.
    """
    words = materialize(df.select(*also, F.col(key).alias("key"), tokens_of(text, stop).alias("words")), "tokens")
    names = [r.term for r in vocabulary(words, max_features, ngrams).select("term").collect()]
    size = words.agg(F.count("*").alias("n")).scalar()
    head = [*also, "key"]
    if not names:
        return words.select(*head, F.array().cast("array<int>").alias("terms"), F.array().cast("array<bigint>").alias("counts")).limit(0), [], []
    vectors = materialize(_term_counts(words, names, also), "terms")
    if vectors.groupBy(*head).agg(F.count("*").alias("rows")).where("rows > 1").limit(1).count():
        # rows of the same key are one text
        each = vectors.select(*head, F.inline(F.arrays_zip("terms", "counts"))).groupBy(*head, "terms").agg(F.sum("counts").alias("counts"))
        vectors = each.groupBy(*head).agg(F.collect_list(F.struct("terms", "counts")).alias("v"))
        vectors = materialize(vectors.select(*head, F.col("v.terms").alias("terms"), F.col("v.counts").alias("counts")), "merged")
    seen = vectors.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    idf = {r.term: r.idf for r in seen.select("term", (F.log((F.lit(size) + 1) / (F.col("df") + 1)) + 1.0).alias("idf")).collect()}
    return vectors, names, [idf[i] for i in range(len(names))]


def _weighed(vectors: DataFrame, idf: list[float], make, schema: str) -> DataFrame:
    """``make(batch, sizes, starts, terms, weights)`` of the vectors in Arrow batches: of each vector its size and where it begins, and of all one after another the terms' places and weights."""
    values = np.array(idf)

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                sizes = batch.column("terms").value_lengths().to_numpy()
                terms = batch.column("terms").flatten().to_numpy()
                yield make(batch, sizes, np.cumsum(sizes) - sizes, terms, batch.column("counts").flatten().to_numpy() * values[terms])

    ship_package(vectors.sparkSession)
    return vectors.select("key", "terms", "counts").mapInArrow(run, f"key {vectors.schema['key'].dataType.simpleString()}, {schema}")


def _normed(vectors: DataFrame, names: list[str], idf: list[float]) -> DataFrame:
    """``(key, term, weight)`` with normalised weights."""

    def make(batch, sizes, starts, terms, weights):
        norm = np.repeat(np.sqrt(np.add.reduceat(weights * weights, starts)), sizes)
        rows = np.repeat(np.arange(len(sizes)), sizes)
        return pa.RecordBatch.from_arrays([batch.column("key").take(pa.array(rows)), pa.array(names, pa.string()).take(pa.array(terms)), pa.array(weights / norm)], ["key", "term", "weight"])

    return _weighed(vectors, idf, make, "term string, weight double")


def tfidf(df: DataFrame, text: str = "voice_description", key: str = "idx", max_features: int = 1000, ngrams=(1, 1), stop=ENGLISH_STOP_WORDS) -> DataFrame:
    """L2-normalised ``(key, term, weight)``; a row has at most ``max_features`` terms."""
    return _normed(*term_vectors(df, text, key, max_features, ngrams, stop))


def _ranked(df: DataFrame, dots: DataFrame, key: str, k: int) -> DataFrame:
    """The ``k`` best rows; rows without a common term score 0 and fill up by key.

    At most 2 ``k`` keys are chosen before a description is read.
    """
    best = dots.orderBy(F.desc("similarity"), "key").limit(k)
    first = df.select(F.col(key).alias("key"), F.lit(0.0).alias("similarity")).orderBy("key").limit(k)
    chosen = best.unionByName(first).groupBy("key").agg(F.max("similarity").alias("similarity"))
    return (
        df.join(F.broadcast(chosen), F.col(key) == F.col("key"))
        .orderBy(F.desc("similarity"), key)
        .limit(k)
        .select(key, "similarity", "speaker_id", F.col("voice_description").alias("description"), demographics().alias("demographics"))
    )


def _cosine(vectors: DataFrame, idf: list[float], asked: list[float]) -> DataFrame:
    """Cosine of every vector with the query, whose weights are ``asked`` by the places of the terms."""
    query = np.array(asked)
    length = float(np.sqrt(query @ query))

    def make(batch, sizes, starts, terms, weights):
        dot = np.add.reduceat(weights * query[terms], starts)
        return pa.RecordBatch.from_arrays([batch.column("key"), pa.array(dot), pa.array(np.sqrt(np.add.reduceat(weights * weights, starts)))], ["key", "dot", "norm"])

    sums = _weighed(vectors, idf, make, "dot double, norm double").where("dot > 0")
    # Sums run in any order: rounding keeps equal texts equal, so that ties fall to the key
    return sums.select("key", F.round(F.try_divide(F.col("dot"), F.col("norm") * length), 12).alias("similarity"))


def find_similar(df: DataFrame, query: str, k: int = 5, text: str = "voice_description", key: str = "idx", max_features: int = 1000, ngrams=(1, 2), stop=ENGLISH_STOP_WORDS) -> DataFrame:
    """The ``k`` rows closest to ``query``, with the query part of the fitted corpus."""
    asked = df.sparkSession.range(1).select(F.lit(True).alias("_asked"), F.lit(None).cast(df.schema[key].dataType).alias(key), F.lit(query).alias(text))
    corpus = df.select(F.lit(False).alias("_asked"), key, text).unionByName(asked)
    vectors, names, idf = term_vectors(corpus, text, key, max_features, ngrams, stop, also=["_asked"])
    weights = {t: c * idf[t] for r in vectors.where("_asked").collect() for t, c in zip(r.terms, r.counts)}  # of one text
    return _ranked(df, _cosine(vectors.where(~F.col("_asked")), idf, [weights.get(i, 0.0) for i in range(len(names))]), key, k)


# Postings in a block of the search index, and folders that its row vectors are dealt out to.
BLOCK_ROWS = 1_024
VECTOR_FOLDERS = 16
# Contributions are compared with this much room, so that rounding leaves no row out.
ROOM = 1e-9


def search_index(df: DataFrame, path: str, text: str = "voice_description", key: str = "idx", max_features: int = 200, ngrams=(1, 1), stop=ENGLISH_STOP_WORDS, block_rows: int = BLOCK_ROWS, folders: int = VECTOR_FOLDERS) -> str:
    """Fit on the corpus once and write an index below ``path``.

    ``blocks``: the postings of each term by falling weight, up to ``block_rows`` in one row with the largest weight, in the
    order of terms and weights. ``vectors``: the normalised weights of each row, in ``folders`` folders by the key's hash. ``vocabulary``: term and idf.
    """
    fitted, names, idf = term_vectors(df, text, key, max_features, ngrams, stop)
    folder = F.pmod(F.xxhash64("key"), F.lit(folders)).cast("int")
    vectors = _normed(fitted, names, idf).groupBy("key").agg(F.collect_list(F.struct("term", "weight")).alias("v"))  # at most max_features entries
    vectors.withColumn("folder", folder).repartition("folder").write.mode("overwrite").partitionBy("folder").parquet(f"{path}/vectors")
    postings = df.sparkSession.read.parquet(f"{path}/vectors").select("key", F.inline("v"))
    # a frequent term is spread over several ranges of its weights
    ordered = postings.select("term", "key", "weight").repartitionByRange("term", F.desc("weight"), "key").sortWithinPartitions("term", F.desc("weight"), "key")
    _in_blocks(ordered, block_rows).write.mode("overwrite").parquet(f"{path}/blocks")
    df.sparkSession.createDataFrame(list(zip(names, idf)), "term string, idf double").write.mode("overwrite").parquet(f"{path}/vocabulary")
    df.sparkSession.range(1).select(F.lit(folders).cast("long").alias("folders")).write.mode("overwrite").parquet(f"{path}/layout")
    return path


def _in_blocks(ordered: DataFrame, block_rows: int) -> DataFrame:
    """Rows (term, top, keys, weights) of up to ``block_rows`` postings, from partitions in the order of terms and falling weights."""
    key_type = ordered.schema["key"].dataType.simpleString()

    def cut(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            term, n = batch.column("term").dictionary_encode().indices.to_numpy(), batch.num_rows
            first = np.flatnonzero(np.append(True, term[1:] != term[:-1]))
            sizes = np.diff(np.append(first, n))
            starts = np.concatenate([np.arange(a, a + size, block_rows) for a, size in zip(first, sizes)])
            offsets = pa.array(np.append(starts, n), pa.int32())
            at = pa.array(starts)
            yield pa.RecordBatch.from_arrays(
                [batch.column("term").take(at), batch.column("weight").take(at), pa.ListArray.from_arrays(offsets, batch.column("key")), pa.ListArray.from_arrays(offsets, batch.column("weight"))],
                ["term", "top", "keys", "weights"],
            )

    ship_package(ordered.sparkSession)
    return ordered.mapInArrow(cut, f"term string, top double, keys array<{key_type}>, weights array<double>")


def _asked(spark, path: str, query: str, ngrams, stop) -> dict[str, float]:
    """The query's terms that the corpus has, with their normalised weights; at most the vocabulary."""
    idf = spark.read.parquet(f"{path}/vocabulary")
    asked = spark.range(1).select(F.lit(query).alias("query"))
    counted = _counted(asked.select(tokens_of("query", stop).alias("words")), ngrams).withColumnRenamed("total", "tf")
    own = idf.join(F.broadcast(counted), "term").select("term", (F.col("tf") * F.col("idf")).alias("weight")).collect()
    length = sum(r.weight * r.weight for r in own) ** 0.5 or 1.0
    return {r.term: r.weight / length for r in own}


def _postings(blocks: DataFrame) -> DataFrame:
    """(key, part) of every posting in ``blocks``: its share of the similarity."""
    each = blocks.select("q", F.inline(F.arrays_zip("keys", "weights")))
    return each.select(F.col("keys").alias("key"), (F.col("q") * F.col("weights")).alias("part"))


def blocks_above(spark, path: str, asked: dict[str, float], k: int) -> tuple[DataFrame, float]:
    """(blocks, least): the blocks that a row among the ``k`` best can be found in, and a bound that its similarity reaches.

    The blocks that promise most give ``k`` rows, the last of which sets the bound. A row that reaches it has a term that
    contributes the bound divided by the number of terms, or more; blocks whose largest weight is too small for that are skipped.
    """
    blocks = spark.read.parquet(f"{path}/blocks")
    weight = F.create_map(*(F.lit(x) for item in asked.items() for x in item))[F.col("term")]

    def promising(least: float) -> DataFrame:
        # a plain condition on both columns, which the scan can skip row groups by
        return blocks.where(reduce(or_, ((F.col("term") == t) & (F.col("top") >= least / q) for t, q in asked.items()))).withColumn("q", weight)

    tops = promising(0.0).select((F.col("q") * F.col("top")).alias("top")).orderBy(F.desc("top")).limit(len(asked) + k)
    edge = tops.agg(F.min("top")).first()[0]
    if edge is None:
        return promising(0.0), 0.0
    leading = _postings(promising(edge - ROOM)).groupBy("key").agg(F.sum("part").alias("part"))
    best = leading.select("part").orderBy(F.desc("part")).limit(k).agg(F.count("*").alias("n"), F.min("part").alias("least")).first()
    least = max(0.0, best["least"] - ROOM) if best["n"] == k else 0.0
    return promising(least / len(asked) - ROOM), least


def search(df: DataFrame, path: str, query: str, k: int = 3, key: str = "idx", ngrams=(1, 1), stop=ENGLISH_STOP_WORDS) -> DataFrame:
    """The ``k`` rows closest to ``query`` by a written index; terms the corpus does not have are ignored.

    Postings are read from the blocks that matter, and of the rows found so the vectors of those that can still be among the best.
    """
    spark = df.sparkSession
    asked = _asked(spark, path, query, ngrams, stop)
    none = df.select(F.col(key).alias("key"), F.lit(0.0).alias("similarity")).limit(0)
    if not asked:
        return _ranked(df, none, key, k)
    blocks, least = blocks_above(spark, path, asked, k)
    share = least / len(asked) - ROOM
    found = _postings(blocks).where(F.col("part") >= share).groupBy("key").agg(F.sum("part").alias("part"), F.count("*").alias("terms"))
    # a term that was not found contributes less than the share
    hopeful = found.where(F.col("part") + (len(asked) - F.col("terms")) * (share + ROOM) >= least - ROOM)
    folders = spark.read.parquet(f"{path}/layout").scalar()
    hopeful = materialize(hopeful.select("key", F.pmod(F.xxhash64("key"), folders).cast("int").alias("folder")), "hopeful")
    vectors = spark.read.parquet(f"{path}/vectors")
    listed = F.create_map(*(F.lit(x) for item in asked.items() for x in item))
    score = F.aggregate("v", F.lit(0.0), lambda a, x: a + F.coalesce(listed[x["term"]], F.lit(0.0)) * x["weight"])
    # Sums run in any order: rounding keeps equal texts equal, so that ties fall to the key
    read = [r.folder for r in hopeful.select("folder").distinct().collect()]  # of a fixed number
    kept = vectors.where(F.col("folder").isin(read)).join(bounded(hopeful), ["folder", "key"], "left_semi")
    dots = kept.select("key", F.round(score, 12).alias("similarity"))
    return _ranked(df, dots.where("similarity > 0"), key, k)
