"""The corpus jobs: process one source, combine the sources, filter and split the result."""

from pyspark.sql import DataFrame, functions as F

from speechframe.operators.annotate import annotate, fill_metadata
from speechframe.operators.filters import has_audio
from speechframe.operators.joins import attach_audio, bounded, coalesce_audio, lookup, matched_originals, original_columns, recover_audio, resume, usable_audio, with_file, without_file
from speechframe.operators.ordinal import with_ordinal
from speechframe.operators.prompts import build_prompt
from speechframe.operators.records import split_projection, to_combined, to_record
from speechframe.functions.scalars import basename
from speechframe.functions.waveform import unify_audio
from speechframe.operators.sampling import decaying_sample, split3
from speechframe.schemas import SOURCE_ORDER
from speechframe.session import materialize, workspace
from speechframe.sources.adapters import normalize_source
from speechframe.sources.key_tables import in_buckets

# Rows whose numbers come back together, as a power of two.
UNIT_BITS = 13
# Spark's own bound on the buckets of a table.
MAX_BUCKETS = 100_000


def process_source(raw: DataFrame, name: str, make_annotator, max_n=None, seed=0, processed=None, timestamp=None) -> DataFrame:
    """Normalise, sample, skip what is processed, annotate, parse the tags and emit canonical records.

    ``raw`` numbers its rows in ``idx`` from 1.
    """
    rows = normalize_source(raw, name)
    if max_n:
        already = processed.count() if processed is not None else 0
        rows = decaying_sample(rows, max_n, seed, already, processed=processed)
    elif processed is not None:
        rows = resume(rows, processed, ["idx"])
    described = annotate(build_prompt(rows), make_annotator)
    return to_record(fill_metadata(described), name, timestamp)


def recover_source(records: DataFrame, files: DataFrame, originals: DataFrame | None, source: str, key: str = "idx", **options) -> DataFrame:
    """Records of one source with ``audio`` and its ``status``.

    Rows that have a file and rows that lack one go separate ways, so the audio that is
    there passes through one join only, and so do the texts of either.
    """
    files = files.where(F.col("audio").isNotNull())
    present = attach_audio(with_file(records, files), files, key).where(F.col("file_audio").isNotNull())
    present = present.withColumnRenamed("file_audio", "audio").withColumn("status", F.lit("present"))
    missing = without_file(records, files).withColumn("file_audio", F.lit(None).cast(files.schema["audio"].dataType))
    if originals is None:
        found = missing.withColumn("recovered_audio", F.col("file_audio"))
    else:
        found = missing.join(recover_audio(missing, originals, source, key, **options), key, "left")
    return present.unionByName(coalesce_audio(found))


def source_status(records: DataFrame, files: DataFrame, originals: DataFrame | None, source: str, key: str = "idx", by: str = "dataset") -> DataFrame:
    """(key, dataset, status, usable) of the records of one source, as :func:`recover_source` would give them.

    What is joined is keys, names and whether a clip has samples; no waveform leaves the task that reads it.
    """
    there = files.where(F.col("audio").isNotNull()).select("file_name", usable_audio(F.col("audio")).alias("_filed"))
    named = records.select(key, by, "transcript", "speaker_id", basename("audio_path").alias("file_name"))
    filed = materialize(lookup(named, there, "file_name", key), "filed")
    present = filed.where(F.col("_filed").isNotNull()).select(key, by, F.lit("present").alias("status"), F.col("_filed").alias("usable"))
    missing = filed.where(F.col("_filed").isNull())
    if originals is None:
        return present.unionByName(missing.select(key, by, F.lit("missing").alias("status"), F.lit(False).alias("usable")))
    matched = matched_originals(missing, originals, source, key)
    _, audio = original_columns(originals, source)
    asked = materialize(matched.where(F.col("ordinal").isNotNull()).select("ordinal").distinct(), "asked")
    wanted = originals.join(bounded(asked), "ordinal", "left_semi")
    clip = unify_audio(wanted, audio)
    sound = wanted.select("ordinal", clip.isNotNull().alias("_there"), usable_audio(clip).alias("_usable"))
    outcome = lookup(matched, sound, "ordinal", key).select(key, "_there", "_usable")
    found = F.coalesce("_there", F.lit(False))
    rest = missing.select(key, by).join(outcome, key, "left").select(
        key, by, F.when(found, "recovered").otherwise("missing").alias("status"), (found & F.coalesce("_usable", F.lit(False))).alias("usable")
    )
    return present.unionByName(rest)


def combine_checked(sources: dict[str, DataFrame], key: str = "idx") -> tuple[DataFrame, DataFrame]:
    """(corpus, rejected): the usable rows of all sources under one 0-based ``index``, and those that do not fit its shape.

    Rows stand in the fixed order of the sources they come from, whatever their own ``dataset`` says, and by ``key`` within one;
    an absent source is skipped. Every row has a number of its own before it is placed, so null or repeated keys and labels
    neither lose nor multiply rows. The rows are written once, in units of at most 2 ** ``UNIT_BITS``, and read where they were
    written: what is ordered and joined are ranks, keys and numbers, and the numbers of a unit come back as one list.
    """
    parts = []
    for rank, name in enumerate(SOURCE_ORDER):
        if name in sources:
            parts.append(sources[name].withColumn("_rank", F.lit(rank)))
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part, allowMissingColumns=True)
    good, rejected = to_combined(has_audio(rows).withColumn("index", F.col(key)), extra=["_rank"])
    # the lower 33 bits of the generated id count the rows of one task, the others tell the task
    row = F.monotonically_increasing_id()
    placed = good.withColumn("_row", row).withColumn("_unit", F.shiftright("_row", UNIT_BITS))
    spark = good.sparkSession
    # no fewer tasks read the rows than wrote them
    buckets = min(MAX_BUCKETS, max(int(spark.conf.get("spark.sql.shuffle.partitions")), placed.rdd.getNumPartitions()))
    stored = in_buckets(placed, workspace(spark, "combined"), "_unit", buckets)
    numbered = with_ordinal(stored.select("_rank", "index", "_unit", "_row"), ["_rank", "index", "_row"], name="_index")
    entries = F.array_sort(F.collect_list(F.struct("_row", "_index")))  # of one unit
    lists = numbered.groupBy("_unit").agg(F.transform(entries, lambda e: e["_index"]).alias("_numbers"))
    place = F.col("_row").bitwiseAND(F.lit((1 << UNIT_BITS) - 1)).cast("int")
    # the lists are the built side of the join, so the rows are neither moved nor sorted
    joined = stored.join(lists.hint("shuffle_hash"), "_unit").withColumn("_index", F.col("_numbers")[place])
    return joined.select(F.col("_index").alias("index"), *[c for c in good.columns if c not in ("index", "_rank")]), rejected


def combine(sources: dict[str, DataFrame], key: str = "idx") -> DataFrame:
    """The corpus of :func:`combine_checked`."""
    return combine_checked(sources, key)[0]


def update(corpus: DataFrame, seed: int = 42, caps=None, key: str = "index") -> DataFrame:
    """Filter by description length, deal the rows into splits and shape them for training."""
    return split_projection(split3(corpus, seed, caps, key))
