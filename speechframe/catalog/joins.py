"""Audio lookup and recovery, resume, speaker lists, combination of sources.

A record has a file where its document has a waveform. The documents with a waveform are also the
originals, so a record without a file is recovered where an exact copy of its text has one.
"""

from pyspark.sql import functions as F

from speechframe.catalog.base import Catalog, on_samples, samples, sql_strip, table, waves, with_views
from speechframe.operators import joins, sampling, stats
from speechframe.plans import corpus
from speechframe.session import materialize, workspace
from speechframe.functions.scalars import basename
from speechframe.sources.key_tables import read_key_table, write_key_table
from speechframe.sources.readers import scan_wav
from speechframe.sources.wav_sink import write_back

CATALOG = Catalog()
add = CATALOG.add


def records(s, d):
    path = F.concat(F.lit("E:\\out\\"), "dataset", F.lit("\\audio\\"), F.col("idx").cast("string"), F.lit(".wav"))
    return samples(s, d).withColumn("audio_path", path)


def files(s, d):
    return waves(s, d).select(F.concat(F.col("idx").cast("string"), F.lit(".wav")).alias("file_name"), "audio")


def originals(s, d):
    """Padded texts; the waveform sits in the column and form of the source."""
    docs = table(s, d, "documents").join(waves(s, d).select(F.col("idx").alias("doc_id"), "audio"), "doc_id")
    padded = F.concat(F.lit("  "), "text", F.lit("\n"))
    speaker = F.concat(F.lit("S_"), (F.col("doc_id") % 61).cast("string"))
    return docs.select(F.col("doc_id").alias("ordinal"), padded.alias("text"), padded.alias("transcript"), speaker.alias("speaker_id"), "audio")


SETUP = f""", files AS (SELECT idx AS file_idx, samples AS file_audio FROM wave),
 orig AS (SELECT idx AS ordinal, {sql_strip("concat('  ', text, chr(10))")} AS k, concat('S_', doc_id % 61) AS speaker, samples AS audio
   FROM documents JOIN wave ON idx = doc_id),
 firsts AS (SELECT k, min(ordinal) AS ordinal FROM orig GROUP BY 1),
 both_firsts AS (SELECT k, speaker, min(ordinal) AS ordinal FROM orig GROUP BY 1, 2),
 attached AS (SELECT samples.*, file_audio FROM samples LEFT JOIN files ON file_idx = idx),
 recovered AS (SELECT a.*, o.ordinal, o.audio AS recovered_audio FROM attached a LEFT JOIN firsts f ON file_audio IS NULL AND f.k = {sql_strip('a.transcript')}
   LEFT JOIN orig o ON o.ordinal = f.ordinal),
 status AS (SELECT *, CASE WHEN file_audio IS NOT NULL THEN 'present' WHEN recovered_audio IS NOT NULL THEN 'recovered' ELSE 'missing' END AS status FROM recovered)
"""


def on_recovery(sql):
    return with_views("", "samples", "wave").rstrip() + SETUP + sql


def statuses(s, d):
    return corpus.recover_source(records(s, d), files(s, d), originals(s, d), "laions")


def _first(column):
    """First sample of a clip, as an exact number."""
    return F.element_at(F.col(column)["array"], 1).cast("double")


add(
    "attach_audio",
    lambda s, d: joins.attach_audio(records(s, d), files(s, d)).select("idx", _first("file_audio").alias("first_sample")),
    on_recovery("SELECT idx, CAST(file_audio[1] AS DOUBLE) AS first_sample FROM attached"),
)
add(
    "recover_audio_by_text",
    lambda s, d: joins.recover_audio(joins.without_file(records(s, d), files(s, d)), originals(s, d), "laions").select(
        "idx", _first("recovered_audio").alias("first_sample")
    ),
    on_recovery("SELECT idx, CAST(recovered_audio[1] AS DOUBLE) AS first_sample FROM recovered WHERE file_audio IS NULL"),
)
def recovered_by_keys(s, d):
    """The originals' digests are written once; the run that recovers reads them from their buckets."""
    path = workspace(s, "keys")
    write_key_table(joins.original_keys(originals(s, d), "laions"), path, ["_key"])
    missing = joins.without_file(records(s, d), files(s, d))
    return joins.recover_audio(missing, originals(s, d), "laions", keys=read_key_table(s, path)).select("idx", _first("recovered_audio").alias("first_sample"))


add(
    "recover_audio_by_key_table",
    recovered_by_keys,
    on_recovery("SELECT idx, CAST(recovered_audio[1] AS DOUBLE) AS first_sample FROM recovered WHERE file_audio IS NULL"),
)
add(
    "recover_audio_by_speaker",
    lambda s, d: joins.recover_audio(joins.without_file(records(s, d), files(s, d)), originals(s, d), "globe_v2").select(
        "idx", _first("recovered_audio").alias("first_sample")
    ),
    on_recovery(
        f"""SELECT idx, CAST(o.audio[1] AS DOUBLE) AS first_sample FROM attached a LEFT JOIN both_firsts f
        ON f.k = {sql_strip('a.transcript')} AND f.speaker = a.speaker_id LEFT JOIN orig o ON o.ordinal = f.ordinal WHERE file_audio IS NULL"""
    ),
)
add(
    "audio_status",
    lambda s, d: statuses(s, d).select("idx", "dataset", "status", _first("audio").alias("first_sample")),
    on_recovery("SELECT idx, dataset, status, CAST(coalesce(file_audio, recovered_audio)[1] AS DOUBLE) AS first_sample FROM status"),
)
def written_back(s, d):
    """Recovered clips are written under the names that the records give them; the next run finds every one of them in place."""
    folder = workspace(s, "recovered")
    write_back(statuses(s, d), folder)
    added = scan_wav(s, folder, nested=True).select(basename("path").alias("file_name"), "audio")
    again = corpus.recover_source(records(s, d), files(s, d).unionByName(added), None, "laions")
    return again.select("idx", "dataset", "status", F.rint(_first("audio") * 32768).cast("long").alias("first_level"))


add(
    "recovered_audio_written_back",
    written_back,
    on_recovery(
        """SELECT idx, dataset, CASE WHEN status = 'missing' THEN 'missing' ELSE 'present' END AS status,
        CAST(round(round_even(CAST(coalesce(file_audio, recovered_audio)[1] AS DOUBLE) * 32768, 0)) AS BIGINT) AS first_level FROM status"""
    ),
)
add(
    "audio_counters",
    lambda s, d: joins.pipeline_counters(corpus.source_status(records(s, d), files(s, d), originals(s, d), "laions")),
    on_recovery(
        "".join(
            f"""{link} SELECT {key} AS dataset, count(*) AS total_processed, count(*) FILTER (WHERE status <> 'present') AS missing_audio,
            count(*) FILTER (WHERE status = 'recovered') AS recovered_audio, count(*) FILTER (WHERE status = 'missing') AS audio_errors,
            count(*) FILTER (WHERE status <> 'missing') AS successful FROM status {group}"""
            for link, key, group in [("", "dataset", "GROUP BY 1"), ("UNION ALL", "'total'", "")]
        )
    ),
)
add(
    "resume",
    lambda s, d: joins.resume(
        samples(s, d), table(s, d, "labels").join(table(s, d, "documents"), "doc_id").select(F.col("source").alias("dataset"), F.col("doc_id").alias("idx"))
    ).select("idx", "dataset"),
    on_samples("SELECT idx, dataset FROM samples WHERE idx NOT IN (SELECT doc_id FROM labels)"),
)
def resumed_by_keys(s, d):
    """The keys that are done stand in buckets."""
    path = workspace(s, "done")
    done = table(s, d, "labels").join(table(s, d, "documents"), "doc_id").select(F.col("source").alias("dataset"), F.col("doc_id").alias("idx"))
    write_key_table(done, path, ["dataset", "idx"])
    return joins.resume(samples(s, d), read_key_table(s, path)).select("idx", "dataset")


add("resume_by_key_table", resumed_by_keys, on_samples("SELECT idx, dataset FROM samples WHERE idx NOT IN (SELECT doc_id FROM labels)"))
add(
    "only_top_speakers",
    lambda s, d: joins.only_speakers(
        samples(s, d), stats.top_k(samples(s, d), "speaker_id", 10).withColumnRenamed("value", "speaker_id")
    ).select("idx", "speaker_id"),
    on_samples(
        "SELECT idx, speaker_id FROM samples WHERE speaker_id IN (SELECT speaker_id FROM samples GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 10)"
    ),
)
add(
    "lookup_frequent_keys",
    lambda s, d: joins.lookup(
        table(s, d, "events").select("event_id", "user_id"),
        table(s, d, "customer").select(F.col("c_custkey").alias("user_id"), "c_name"),
        "user_id",
        "event_id",
        hot_rows=60,
    ),
    "SELECT event_id, user_id, c_name FROM events LEFT JOIN customer ON c_custkey = user_id",
)


def raw_originals(s, d):
    """The originals in the source's own shape: the text inside ``json``, the waveform in ``wav``."""
    return originals(s, d).select("ordinal", F.to_json(F.struct("text")).alias("json"), F.col("audio.array").alias("wav"))


add(
    "recover_audio_from_source_shape",
    lambda s, d: joins.recover_audio(joins.without_file(records(s, d), files(s, d)), raw_originals(s, d), "laions", default_rate=24000).select(
        "idx", _first("recovered_audio").alias("first_sample")
    ),
    on_recovery("SELECT idx, CAST(recovered_audio[1] AS DOUBLE) AS first_sample FROM recovered WHERE file_audio IS NULL"),
)


def awkward_sources(s, d):
    """Two sources whose rows have repeated keys, and labels that are null or another source's."""
    # written once: each source reads it
    rows = materialize(statuses(s, d).where("status <> 'missing'"), "statuses")
    label = F.when(F.col("idx") % 3 == 0, F.lit(None)).when(F.col("idx") % 3 == 1, "laions").otherwise("animevox")
    rows = rows.withColumns({"idx": F.floor(F.col("idx") / 4), "dataset": label.cast("string")})
    return {"laions": rows.where("length(speaker_id) % 2 = 0"), "animevox": rows.where("length(speaker_id) % 2 = 1")}


add(
    "combine_awkward_keys",
    lambda s, d: corpus.combine(awkward_sources(s, d)).agg(
        F.count("*").alias("rows"), F.count_distinct("index").alias("numbers"), F.max("index").alias("last"), F.count("dataset").alias("labelled")
    ),
    on_recovery(
        """SELECT count(*) AS rows, count(*) AS numbers, count(*) - 1 AS last, count(*) FILTER (WHERE idx % 3 <> 0) AS labelled
        FROM status WHERE status <> 'missing'"""
    ),
)


def four_sources(s, d):
    """The corpus dealt to the four sources; each keeps its own row numbers."""
    # written once: each source reads it
    rows = materialize(statuses(s, d), "statuses")
    names = ["globe_v2", "animevox", "laions", "anispeech"]
    place = F.pmod(F.length("dataset") + F.col("idx"), F.lit(len(names)))
    return {n: rows.where(place == i).withColumn("dataset", F.lit(n)) for i, n in enumerate(names)}


COMBINED = """, c AS (SELECT *, (length(dataset) + idx) % 4 AS place, coalesce(file_audio, recovered_audio) AS audio FROM status WHERE status <> 'missing'),
 o AS (SELECT *, CASE place WHEN 0 THEN 'globe_v2' WHEN 1 THEN 'animevox' WHEN 2 THEN 'laions' ELSE 'anispeech' END AS name FROM c)
SELECT row_number() OVER (ORDER BY CASE name WHEN 'animevox' THEN 0 WHEN 'anispeech' THEN 1 WHEN 'globe_v2' THEN 2 ELSE 3 END, idx) - 1 AS "index",
  name AS dataset, speaker_id, transcript, gender, CAST(audio[1] AS DOUBLE) AS first_sample FROM o"""
add(
    "combine",
    lambda s, d: corpus.combine(four_sources(s, d)).select("index", "dataset", "speaker_id", "transcript", "gender", _first("audio").alias("first_sample")),
    on_recovery("").rstrip() + COMBINED,
)
add(
    "update_splits",
    lambda s, d: corpus.update(corpus.combine(four_sources(s, d)), caps=sampling.SPLIT_CAPS).groupBy("split").agg(
        F.count("*").alias("rows"), F.max("speaker_id").alias("last_position")
    ),
    on_recovery(
        f"""SELECT 'train' AS split, least(10000, count(*) * 2 // 3) AS rows, least(10000, count(*) * 2 // 3) - 1 AS last_position
        FROM status WHERE status <> 'missing' AND length({sql_strip('voice_description')}) >= 60
        UNION ALL SELECT 'validation', least(3000, count(*) // 6), least(3000, count(*) // 6) - 1
        FROM status WHERE status <> 'missing' AND length({sql_strip('voice_description')}) >= 60
        UNION ALL SELECT 'test', least(2000, count(*) - least(10000, count(*) * 2 // 3) - least(3000, count(*) // 6)),
        least(2000, count(*) - least(10000, count(*) * 2 // 3) - least(3000, count(*) // 6)) - 1
        FROM status WHERE status <> 'missing' AND length({sql_strip('voice_description')}) >= 60"""
    ),
)
