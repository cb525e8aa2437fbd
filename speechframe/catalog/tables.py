"""Sources and sinks. Written tables go below the shared folder and are read back."""

from pyspark.sql import functions as F

from speechframe.catalog.base import Catalog, on_samples, rounded, samples, sql_strip, table, waves, with_views
from speechframe.functions.scalars import known
from speechframe.operators.filters import first_n
from speechframe.operators.records import to_record
from speechframe.operators.sampling import SPLIT_CAPS, split3
from speechframe.operators.stats import basic_stats, unpivot
from speechframe.schemas import RECORD
from speechframe.session import workspace
from speechframe.sources import readers, sinks
from speechframe.sources.adapters import normalize_source

CATALOG = Catalog()
add = CATALOG.add

STAMP = "2025-01-01T00:00:00.000000"


def records(s, d):
    return to_record(samples(s, d), timestamp=STAMP)


RECORD_SQL = f"""SELECT idx AS "index", dataset, speaker_id, transcript, CAST(NULL AS VARCHAR) AS audio_path, round(duration, 6) AS duration,
  voice_description, '{STAMP}' AS processing_timestamp, gender, age, accent FROM samples"""


def records_round_trip(s, d):
    path = workspace(s, "records")
    sinks.write_records(records(s, d), path)
    return rounded(readers.read_records(s, path, RECORD, lines=True))


def record_arrays(s, d):
    """Two files of one array each, cut into ranges of 128 kB, most of which begin inside an object or a string."""
    path = workspace(s, "arrays")
    sinks.write_record_arrays(records(s, d), path, files=2)
    return rounded(readers.read_records(s, path, RECORD, range_bytes=128 << 10))


def corpus_round_trip(s, d):
    path = workspace(s, "corpus")
    sinks.write_corpus(records(s, d), path)
    return rounded(readers.read_corpus(s, path))


def validated_corpus(s, d):
    path = workspace(s, "corpus")
    sinks.write_corpus(records(s, d), path)
    return readers.validate_table(s, path, ["index", "transcript", "audio"])


def splits_round_trip(s, d):
    path = workspace(s, "splits")
    sinks.write_splits(split3(samples(s, d), caps=SPLIT_CAPS).select("idx", "split", "position"), path)
    return readers.read_corpus(s, path).groupBy("split").agg(
        F.count("*").alias("rows"), F.sum("idx").alias("idx_sum"), F.max("position").alias("last_position")
    )


def stats_round_trip(s, d):
    path = workspace(s, "stats")
    sinks.write_stats(unpivot(basic_stats(samples(s, d)), "basic"), path)
    return rounded(s.read.schema("section string, key string, value double").json(path))


def wav_round_trip(s, d):
    folder = workspace(s, "wav")
    named = waves(s, d).withColumn("dataset", F.lit("wave"))
    written = sinks.write_wav(named, folder)
    written.write.parquet(f"{folder}-manifest")
    sounds = readers.scan_wav(s, folder)
    steps = F.transform("audio.array", lambda x: F.round(x.cast("double") * 32768).cast("long"))
    return sounds.select(
        F.element_at(F.split(F.element_at(F.split("path", "/"), -1), "_"), 2).cast("long").alias("idx"),
        F.col("audio.sampling_rate").alias("sampling_rate"),
        F.size("audio.array").alias("length"),
        F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x).alias("level_sum"),
        F.array_max(steps).alias("level_max"),
    )


def append_batches(s, d):
    one = samples(s, d)
    older = one.drop("dataset").where(F.col("duration") < 5)
    return readers.concat_batches([one.where(F.col("duration") >= 5), older]).groupBy("dataset").agg(F.count("*").alias("rows"), F.sum("idx").alias("idx_sum"))


def exported_training(s, d):
    path = workspace(s, "training")
    rows = sinks.export_training(samples(s, d), path, "instruction")
    read = s.read.schema("instruction string, input string, output string").json(path)
    return read.agg(F.count("*").alias("rows"), F.sum(F.length("input")).alias("chars"), F.lit(rows).cast("bigint").alias("reported"))


def exported_conversations(s, d):
    """The conversation form, read back turn by turn."""
    path = workspace(s, "conversations")
    sinks.export_training(samples(s, d), path, "conversation")
    schema = "conversations array<struct<from: string, value: string>>, metadata struct<speaker_id: string, accent: string, age: string, gender: string>"
    return s.read.schema(schema).json(path).select(F.posexplode("conversations").alias("turn", "c"), "metadata").select("turn", "c.from", "c.value", "metadata.*")


def exported_subset(s, d):
    """Whole export: audio, metadata and manifest; the metadata is read back. Rows without a waveform are in it, without a file."""
    folder = workspace(s, "subset")
    corpus = samples(s, d).join(waves(s, d).select("idx", "audio"), "idx", "left")
    manifest = sinks.export_subset(corpus, (F.col("gender") == "female") & (F.col("duration") < 5.0), folder, "source")
    meta = s.read.schema("audio_file string, speaker_id string, duration double").json(f"{folder}/metadata")
    # the files are in place: every manifest line names one that can be read
    sounds = readers.scan_wav(s, f"{folder}/audio").select(F.element_at(F.split("path", "/"), -1).alias("audio_file"), F.size("audio.array").alias("length"))
    done = manifest.where("error IS NULL").select(F.element_at(F.split("path", "/"), -1).alias("audio_file"))
    return rounded(meta.join(done.join(sounds, "audio_file"), "audio_file", "left"))


add("records_round_trip", records_round_trip, on_samples(RECORD_SQL))
add("record_arrays_in_ranges", record_arrays, on_samples(RECORD_SQL))
add("corpus_round_trip", corpus_round_trip, on_samples(RECORD_SQL))
add(
    "validated_corpus",
    validated_corpus,
    """SELECT 'exists' AS "check", true AS ok UNION ALL SELECT 'finished', true UNION ALL SELECT 'column index', true
    UNION ALL SELECT 'column transcript', true UNION ALL SELECT 'column audio', false""",
)
add(
    "read_corpus_columns",
    lambda s, d: readers.read_corpus(s, f"{d}/documents.parquet", ["doc_id", "source", "n_chars"]),
    "SELECT doc_id, source, n_chars FROM documents",
)
add(
    "first_100_rows",
    lambda s, d: first_n(samples(s, d), 100).select("idx", "dataset", "speaker_id"),
    on_samples("SELECT idx, dataset, speaker_id FROM samples ORDER BY idx LIMIT 100"),
)
add(
    "concat_batches",
    append_batches,
    on_samples(
        """SELECT CASE WHEN duration >= 5 THEN dataset END AS dataset, count(*) AS rows, CAST(sum(idx) AS BIGINT) AS idx_sum FROM samples GROUP BY 1"""
    ),
)

SPLIT_SQL = """, k AS (SELECT idx, row_number() OVER (ORDER BY md5(concat('42:', idx)), idx) - 1 AS place FROM samples
   WHERE length({strip}) >= 60),
 n AS (SELECT count(*) AS n FROM k),
 z AS (SELECT least(10000, n * 2 // 3) AS tr, least(3000, n // 6) AS va, n FROM n),
 y AS (SELECT *, least(2000, n - tr - va) AS te FROM z),
 m AS (SELECT idx, CASE WHEN place < tr THEN 'train' WHEN place < tr + va THEN 'validation' ELSE 'test' END AS split,
   CAST(CASE WHEN place < tr THEN place WHEN place < tr + va THEN place - tr ELSE place - tr - va END AS BIGINT) AS position
   FROM k, y WHERE place < tr + va + te)
"""

SPLIT_SQL = SPLIT_SQL.format(strip=sql_strip("voice_description"))
add(
    "splits_round_trip",
    splits_round_trip,
    on_samples("").rstrip() + SPLIT_SQL + "SELECT split, count(*) AS rows, CAST(sum(idx) AS BIGINT) AS idx_sum, max(position) AS last_position FROM m GROUP BY 1",
)
add(
    "stats_round_trip",
    stats_round_trip,
    on_samples(
        """SELECT 'basic' AS section, 'total_samples' AS key, CAST(count(*) AS DOUBLE) AS value FROM samples
        UNION ALL SELECT 'basic', 'unique_speakers', CAST(count(DISTINCT speaker_id) AS DOUBLE) FROM samples
        UNION ALL SELECT 'basic', 'unique_accents', CAST(count(DISTINCT accent) AS DOUBLE) FROM samples
        UNION ALL SELECT 'basic', 'total_duration_hours', round(sum(duration) / 3600, 6) FROM samples
        UNION ALL SELECT 'basic', 'avg_duration_seconds', round(avg(duration), 6) FROM samples"""
    ),
)
add(
    "wav_round_trip",
    wav_round_trip,
    with_views(
        """, l AS (SELECT idx, sampling_rate, list_transform(samples, lambda x: CAST(round_even(CAST(x AS DOUBLE) * 32768, 0) AS BIGINT)) AS steps FROM wave)
    SELECT idx, sampling_rate, CAST(len(steps) AS INTEGER) AS length, CAST(list_sum(steps) AS BIGINT) AS level_sum, list_max(steps) AS level_max FROM l""",
        "wave",
    ).replace(")\n,", "),"),
)
add(
    "exported_training",
    exported_training,
    on_samples(
        """SELECT count(*) AS rows, CAST(sum(length(concat('Speaker transcript: ''', coalesce(transcript, 'None'), ''''))) AS BIGINT) AS chars,
        count(*) AS reported FROM samples"""
    ),
)

add(
    "exported_conversations",
    exported_conversations,
    on_samples(
        """SELECT 0 AS turn, 'human' AS "from", concat('Please analyze this voice recording. The speaker says: ''', coalesce(transcript, 'None'), '''') AS value,
        speaker_id, accent, age, gender FROM samples
        UNION ALL SELECT 1, 'assistant', voice_description, speaker_id, accent, age, gender FROM samples"""
    ),
)

MANIFEST = """, o AS (SELECT idx, row_number() OVER (ORDER BY idx) - 1 AS n FROM {base})
SELECT {columns} FROM samples JOIN o USING (idx) WHERE {predicate}"""
QUALITY = lambda: (F.col("duration") > 1.0) & (F.col("duration") < 10.0) & known("gender")
add(
    "subset_manifest_source",
    lambda s, d: rounded(sinks.subset_manifest(samples(s, d), (F.col("gender") == "female") & (F.col("duration") < 5.0), "source")),
    on_samples("").rstrip()
    + MANIFEST.format(
        base="samples",
        columns="idx, concat('voice_', lpad(CAST(n AS VARCHAR), 6, '0'), '.wav') AS audio_file, speaker_id, transcript, round(duration, 6) AS duration, gender, age, accent, voice_description",
        predicate="gender = 'female' AND duration < 5",
    ),
)
add(
    "subset_manifest_filtered",
    lambda s, d: rounded(sinks.subset_manifest(samples(s, d), QUALITY(), "filtered")),
    on_samples("").rstrip()
    + MANIFEST.format(
        base="samples WHERE duration > 1 AND duration < 10 AND gender IS DISTINCT FROM 'unknown'",
        columns="idx, concat('audio_', lpad(CAST(n AS VARCHAR), 6, '0'), '.wav') AS audio_path, transcript, speaker_id, voice_description",
        predicate="true",
    ),
)
add(
    "exported_subset",
    exported_subset,
    with_views(
        """, c AS (SELECT *, row_number() OVER (ORDER BY samples.idx) - 1 AS n FROM samples LEFT JOIN (SELECT idx, len(samples) AS length FROM wave) USING (idx))
    SELECT concat('voice_', lpad(CAST(n AS VARCHAR), 6, '0'), '.wav') AS audio_file, speaker_id, round(duration, 6) AS duration, CAST(length AS INTEGER) AS length
    FROM c WHERE gender = 'female' AND duration < 5""",
        "samples",
        "wave",
    ).replace(")\n,", "),"),
)


# --- the four source adapters over the documents, of which some have no waveform ------------------

RAW = "SELECT doc_id AS idx, text, lang, source, n_chars, embedding FROM documents LEFT JOIN embeddings ON vec_id = doc_id"


def raw(s, d):
    docs, vecs = table(s, d, "documents"), table(s, d, "embeddings")
    both = docs.join(vecs, docs.doc_id == vecs.vec_id, "left")
    return both.select(F.col("doc_id").alias("idx"), "text", "lang", "source", "n_chars", "embedding")


def _flat(df):
    lead = df.withColumn("sampling_rate", F.col("audio.sampling_rate")).withColumn("length", F.size("audio.array"))
    return rounded(lead.drop("audio"))


def globe(s, d):
    audio = F.struct(F.col("embedding").alias("array"), F.lit(48).alias("sampling_rate")).alias("audio")
    return _flat(normalize_source(raw(s, d).select("idx", audio, F.col("text").alias("transcript"), F.col("lang").alias("accent")), "globe_v2"))


def laions(s, d):
    meta = F.struct(
        F.when(F.col("lang") != "en", F.col("lang")).alias("emotion"),
        F.when(F.col("source") != "src1", F.concat(F.lit("smp_"), "idx")).alias("sample_id"),
        "text",
        F.when(F.col("n_chars") > 500, F.col("n_chars") / 100).alias("duration"),
    )
    return _flat(normalize_source(raw(s, d).select("idx", F.col("embedding").alias("wav"), F.to_json(meta).alias("json")), "laions"))


def animevox(s, d):
    cols = [F.col("embedding").alias("audio"), F.col("source").alias("character_name"), F.col("lang").alias("anime"), F.col("text").alias("transcription")]
    return _flat(normalize_source(raw(s, d).select("idx", *cols), "animevox"))


def anispeech(s, d):
    return _flat(normalize_source(raw(s, d).select("idx", F.col("embedding").alias("audio"), F.col("text").alias("caption"), F.col("source").alias("voice")), "anispeech"))


ON_RAW = f"WITH raw AS ({RAW}) "
add(
    "normalize_globe",
    globe,
    ON_RAW
    + """SELECT idx, 'globe_v2' AS dataset, concat('globe_speaker_', idx) AS speaker_id, text AS transcript, round(len(embedding) / 48, 6) AS duration,
    'unknown' AS gender, 'unknown' AS age, lang AS accent, 48 AS sampling_rate, CAST(len(embedding) AS INTEGER) AS length FROM raw""",
)
add(
    "normalize_laions",
    laions,
    ON_RAW
    + """SELECT idx, 'laions' AS dataset, CASE WHEN source <> 'src1' THEN concat('smp_', idx) ELSE concat('laions_', idx) END AS speaker_id,
    text AS transcript, round(CASE WHEN n_chars > 500 THEN n_chars / 100 ELSE len(embedding) / 24000 END, 6) AS duration,
    CASE WHEN lang <> 'en' THEN lang ELSE 'unknown' END AS emotion, CASE WHEN embedding IS NOT NULL THEN 24000 END AS sampling_rate, CAST(len(embedding) AS INTEGER) AS length FROM raw""",
)
add(
    "normalize_animevox",
    animevox,
    ON_RAW
    + """SELECT idx, 'animevox' AS dataset, concat(lang, '_', source) AS speaker_id, text AS transcript, round(len(embedding) / 16000, 6) AS duration,
    source AS character_name, lang AS anime, CASE WHEN embedding IS NOT NULL THEN 16000 END AS sampling_rate, CAST(len(embedding) AS INTEGER) AS length FROM raw""",
)
add(
    "normalize_anispeech",
    anispeech,
    ON_RAW
    + """SELECT idx, 'anispeech' AS dataset, concat('anispeech_', source, '_', idx) AS speaker_id, text AS transcript,
    round(len(embedding) / 16000, 6) AS duration, source AS voice_class, CASE WHEN embedding IS NOT NULL THEN 16000 END AS sampling_rate, CAST(len(embedding) AS INTEGER) AS length FROM raw""",
)


def event_records(s, d):
    """The JSON column of the events as source metadata: its only field is not one the source knows."""
    events = table(s, d, "events").select(F.col("event_id").alias("idx"), F.array(F.col("value").cast("float")).alias("wav"), F.col("props").alias("json"))
    return _flat(normalize_source(events, "laions"))


add(
    "normalize_event_json",
    event_records,
    """SELECT event_id AS idx, 'laions' AS dataset, concat('laions_', event_id) AS speaker_id, '' AS transcript, round(1 / 24000, 6) AS duration,
    'unknown' AS emotion, 24000 AS sampling_rate, 1 AS length FROM events""",
)


def event_metadata(s, d):
    """The number in the events' JSON, handed over as the duration that the source's metadata has."""
    meta = F.regexp_replace("props", '"k"', '"duration"')
    events = table(s, d, "events").select(F.col("event_id").alias("idx"), F.array(F.col("value").cast("float")).alias("wav"), meta.alias("json"))
    return _flat(normalize_source(events, "laions"))


add(
    "normalize_event_metadata",
    event_metadata,
    """SELECT event_id AS idx, 'laions' AS dataset, concat('laions_', event_id) AS speaker_id, '' AS transcript,
    round(CAST(json_extract(props, '$.k') AS DOUBLE), 6) AS duration, 'unknown' AS emotion, 24000 AS sampling_rate, 1 AS length FROM events""",
)
