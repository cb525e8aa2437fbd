"""Lookups between corpus tables: audio by file name, recovery by transcript, resume, speaker lists."""

from pyspark.sql import DataFrame, functions as F

from speechframe.functions.scalars import basename, strip
from speechframe.functions.waveform import unify_audio
from speechframe.session import materialize

# A key on at least this many rows is joined in pieces of about that many. At most rows / HOT_KEY_ROWS keys
# can be that frequent, which bounds the broadcast list of them.
HOT_KEY_ROWS = 1_000_000
# Rows with a null key match nothing and are dealt out over so many places.
NULL_PIECES = 4096
# A written side of at most this many narrow rows is broadcast.
BROADCAST_ROWS = 1_000_000


def bounded(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A written table with a broadcast hint when it is counted to have at most ``rows`` rows, else left to a shuffled join."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def lookup(left: DataFrame, right: DataFrame, key: str, spread: str, hot_rows: int = HOT_KEY_ROWS) -> DataFrame:
    """Left join onto ``right``, which holds each ``key`` once, when some keys of ``left`` may be very frequent.

    Rows with a frequent or null key are spread over the join tasks by ``spread``, a column of ``left``
    that tells its rows apart; ``right`` is repeated only for the frequent keys.
    """
    hot = left.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_rows")).where(F.col("_rows") >= hot_rows)
    pieces = F.ceil(F.col("_rows") / hot_rows).cast("int")
    hot = F.broadcast(hot.select(key, pieces.alias("_pieces")))
    # a null key matches nothing, so its rows may go anywhere
    parts = F.when(F.col(key).isNull(), NULL_PIECES).otherwise(F.coalesce("_pieces", F.lit(1)))
    salted = left.join(hot, key, "left").withColumn("_salt", F.pmod(F.xxhash64(spread), parts).cast("int"))
    every = F.sequence(F.lit(0), F.coalesce("_pieces", F.lit(1)) - 1)
    copies = right.join(hot, key, "left").withColumn("_salt", F.explode(every))
    return salted.drop("_pieces").join(copies.drop("_pieces"), [key, "_salt"], "left").drop("_salt")


def attach_audio(records: DataFrame, files: DataFrame, key: str = "idx") -> DataFrame:
    """``file_audio`` of every record by the base name of its ``audio_path``; absent gives null.

    ``files`` has ``file_name``, each once, and ``audio``.
    """
    named = records.withColumn("file_name", basename("audio_path"))
    audio = files.select("file_name", F.col("audio").alias("file_audio"))
    return lookup(named, audio, "file_name", key).drop("file_name")


def without_file(records: DataFrame, files: DataFrame) -> DataFrame:
    """Records that no file is named after; reads no audio. The names are sent to the records while they are few."""
    names = bounded(materialize(files.select("file_name"), "names"))
    named = records.withColumn("file_name", basename("audio_path"))
    # rows without a name have no file; they stay out of the join, where they would all meet in one task
    nameless = named.where(F.col("file_name").isNull()).drop("file_name")
    looked_up = named.where(F.col("file_name").isNotNull()).join(names, "file_name", "left_anti")
    return looked_up.drop("file_name").unionByName(nameless)


def with_file(records: DataFrame, files: DataFrame) -> DataFrame:
    """Records that may have a file: those that one is named after while the names are few enough to be sent to them, else all."""
    names = materialize(files.select("file_name"), "names")
    if names.limit(BROADCAST_ROWS + 1).count() > BROADCAST_ROWS:
        return records
    return records.join(F.broadcast(names), basename("audio_path") == names["file_name"], "left_semi")


# The text column that identifies a row in each original source.
RECOVERY_TEXT = {"globe_v2": "transcript", "laions": "text", "animevox": "transcription", "anispeech": "caption"}


def recovery_key(source: str, text, speaker: str = "speaker_id"):
    """Digest of what must agree: the stripped text, for globe_v2 the speaker too. Null never matches."""
    value = strip(text)
    if source == "globe_v2":
        value = F.concat(F.col(speaker), F.lit(chr(31)), value)
    return F.unhex(F.sha2(value, 256))


def original_columns(originals: DataFrame, source: str, audio: str = "audio"):
    """(text, audio column name) of an original source: a source may keep its text in ``json`` and its audio in ``wav``."""
    text = RECOVERY_TEXT[source]
    if text in originals.columns:
        found = F.col(text)
    else:
        # the metadata is a struct or its JSON text
        nested = originals.schema["json"].dataType.typeName() == "struct"
        found = F.col("json")[text] if nested else F.get_json_object("json", f"$.{text}")
    return found, audio if audio in originals.columns else "wav"


def _checked_source(source: str) -> str:
    if source not in RECOVERY_TEXT:
        raise ValueError(f"unknown source: {source}. Available: {sorted(RECOVERY_TEXT)}")
    return source


def original_keys(originals: DataFrame, source: str, ordinal: str = "ordinal") -> DataFrame:
    """(_key, ordinal): the digest of each original text, with the first original that has it."""
    text, _ = original_columns(originals, _checked_source(source))
    keyed = originals.select(F.col(ordinal).alias("ordinal"), recovery_key(source, text).alias("_key")).where(F.col("_key").isNotNull())
    return keyed.groupBy("_key").agg(F.min("ordinal").alias("ordinal"))


def matched_originals(missing: DataFrame, originals: DataFrame, source: str, key: str = "idx", ordinal: str = "ordinal", keys: DataFrame | None = None) -> DataFrame:
    """Written (key, ordinal): the first original that agrees with each missing record, null without one; reads no audio.

    Only digests and ordinals are shuffled, and both steps are written once because the search for frequent
    keys reads them too. ``keys`` are the :func:`original_keys` of an earlier run, written as a key table: they
    stay where they are, and no original text is read.
    """
    wanted = materialize(missing.select(key, recovery_key(_checked_source(source), "transcript").alias("_key")), "wanted")
    if keys is None:
        firsts = original_keys(originals, source, ordinal)
    else:
        # each wanted key once, so that a frequent one is not joined row by row here
        asked = wanted.select("_key").where(F.col("_key").isNotNull()).distinct()
        firsts = materialize(asked.hint("shuffle_merge").join(keys, "_key"), "found_keys")
    found = firsts.select("_key", F.col("ordinal").alias(ordinal))
    return materialize(lookup(wanted, found, "_key", key).drop("_key"), "matched")


def recover_audio(missing: DataFrame, originals: DataFrame, source: str, key: str = "idx", ordinal: str = "ordinal", audio: str = "audio", default_rate: int = 16000, keys: DataFrame | None = None):
    """``recovered_audio`` of every missing record from the first original that agrees with it.

    The audio is fetched last, by ordinal, and only that of originals which are wanted. ``keys`` as for :func:`matched_originals`.
    """
    matched = matched_originals(missing, originals, source, key, ordinal, keys)
    _, audio = original_columns(originals, source, audio)
    # only originals that are wanted go on with their audio
    asked = materialize(matched.where(F.col(ordinal).isNotNull()).select(ordinal).distinct(), "asked")
    needed = originals.join(bounded(asked), ordinal, "left_semi")
    payload = needed.select(ordinal, unify_audio(needed, audio, default_rate).alias("recovered_audio"))
    return lookup(matched, payload, ordinal, key).select(key, "recovered_audio")


def coalesce_audio(df: DataFrame) -> DataFrame:
    """The file's audio, else the recovered one, with the status present / recovered / missing."""
    status = F.when(F.col("file_audio").isNotNull(), "present").when(F.col("recovered_audio").isNotNull(), "recovered")
    return df.select(
        *[c for c in df.columns if c not in ("file_audio", "recovered_audio")],
        F.coalesce("file_audio", "recovered_audio").alias("audio"),
        status.otherwise("missing").alias("status"),
    )


def usable_audio(audio):
    """Whether a clip has samples."""
    return F.coalesce(F.size(audio["array"]) > 0, F.lit(False))


def resume(df: DataFrame, processed: DataFrame, keys=("dataset", "idx")) -> DataFrame:
    """Rows whose keys are not yet processed."""
    return df.join(processed.select(*keys), list(keys), "left_anti")


def only_speakers(df: DataFrame, speakers: DataFrame) -> DataFrame:
    """Rows of the listed speakers. Spark broadcasts the list while it is small enough."""
    return df.join(speakers.select("speaker_id"), "speaker_id", "left_semi")


def pipeline_counters(df: DataFrame, by: str = "dataset") -> DataFrame:
    """Counters per source, and for the whole corpus under 'total'.

    ``df`` is the outcome of :func:`coalesce_audio`, or has ``usable`` instead of ``audio``; without samples a row counts as an error.
    """
    usable = F.col("usable") if "usable" in df.columns else usable_audio(F.col("audio"))
    counted = df.groupBy(by).agg(
        F.count("*").alias("total_processed"),
        F.count_if(F.col("status") != "present").alias("missing_audio"),
        F.count_if(F.col("status") == "recovered").alias("recovered_audio"),
        F.count_if(~usable).alias("audio_errors"),
        F.count_if(usable).alias("successful"),
    )
    names = [c for c in counted.columns if c != by]
    total = counted.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in names])
    return counted.unionByName(total.select(F.lit("total").alias(by), *names))
