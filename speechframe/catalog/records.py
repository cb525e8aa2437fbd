"""Record projections, prompts and annotation."""

from pyspark.sql import functions as F

from speechframe.catalog.base import Catalog, on_samples, rounded, samples, sql_words, table, waves, with_views
from speechframe.catalog.tables import raw
from speechframe.functions.scalars import basename
from speechframe.functions.waveform import rms_energy
from speechframe.operators import annotate, prompts, records

CATALOG = Catalog()
add = CATALOG.add


def combined_input(s, d):
    """Rows with a textual duration, which cannot be read for some languages, and a textual rate."""
    audio = F.struct(F.col("embedding").cast("array<double>").alias("array"), F.lit("16000").alias("sampling_rate"))
    duration = F.when(F.col("lang") == "fr", "unbekannt").otherwise(F.col("n_chars").cast("string"))
    return raw(s, d).select(
        "idx",
        F.col("source").alias("dataset"),
        F.concat(F.lit("sp_"), "lang").alias("speaker_id"),
        F.col("text").alias("transcript"),
        audio.alias("audio"),
        duration.alias("duration"),
        F.col("text").alias("voice_description"),
        F.when(F.col("lang") != "en", F.lit("female")).alias("gender"),
    )


def combined(s, d, which):
    good, rejected = records.to_combined(combined_input(s, d))
    if which == "rejected":
        return rejected.select("idx", "dataset", "duration")
    return good.select("index", "dataset", "speaker_id", "transcript", "duration", "gender", "age", "accent", F.col("audio.sampling_rate").alias("sampling_rate"), F.size("audio.array").alias("length"))


COMBINED_SQL = "SELECT doc_id AS idx, text, lang, source, n_chars, embedding FROM documents LEFT JOIN embeddings ON vec_id = doc_id"
add(
    "to_combined_good",
    lambda s, d: combined(s, d, "good"),
    f"""SELECT idx AS "index", source AS dataset, concat('sp_', lang) AS speaker_id, text AS transcript, CAST(n_chars AS DOUBLE) AS duration,
    CASE WHEN lang <> 'en' THEN 'female' END AS gender, 'unknown' AS age, 'unknown' AS accent, 16000 AS sampling_rate,
    CAST(len(embedding) AS INTEGER) AS length FROM ({COMBINED_SQL}) WHERE lang <> 'fr'""",
)
add(
    "to_combined_rejected",
    lambda s, d: combined(s, d, "rejected"),
    f"SELECT idx, source AS dataset, 'unbekannt' AS duration FROM ({COMBINED_SQL}) WHERE lang = 'fr'",
)
add(
    "unify_audio_struct",
    lambda s, d: _unified(waves(s, d).select("idx", "audio")),
    with_views("SELECT idx, sampling_rate, CAST(len(samples) AS INTEGER) AS length FROM wave", "wave"),
)
add(
    "unify_audio_bare",
    lambda s, d: _unified(waves(s, d).select("idx", F.col("samples").alias("audio"))),
    with_views("SELECT idx, 16000 AS sampling_rate, CAST(len(samples) AS INTEGER) AS length FROM wave", "wave"),
)


def _unified(df):
    from speechframe.functions.waveform import unify_audio

    one = df.withColumn("audio", unify_audio(df, "audio"))
    return one.select("idx", F.col("audio.sampling_rate").alias("sampling_rate"), F.size("audio.array").alias("length"))


add(
    "format_instruction",
    lambda s, d: rounded(records.format_instruction(samples(s, d)).select("instruction", "input", "output", "metadata.*")),
    on_samples(
        f"""SELECT '{records.INSTRUCTION}' AS instruction, concat('Speaker transcript: ''', coalesce(transcript, 'None'), '''') AS input,
        voice_description AS output, speaker_id, accent, age, gender, round(duration, 6) AS duration FROM samples"""
    ),
)
add(
    "format_conversation",
    lambda s, d: records.format_conversation(samples(s, d)).select(F.posexplode("conversations").alias("turn", "c"), "metadata").select("turn", "c.from", "c.value", "metadata.*"),
    on_samples(
        """SELECT 0 AS turn, 'human' AS "from", concat('Please analyze this voice recording. The speaker says: ''', coalesce(transcript, 'None'), '''') AS value,
        speaker_id, accent, age, gender FROM samples
        UNION ALL SELECT 1, 'assistant', voice_description, speaker_id, accent, age, gender FROM samples"""
    ),
)
for variant, nested in [("a", "speaker_embedding"), ("c", "voice_characteristics")]:
    add(
        f"training_rows_{variant}",
        lambda s, d, v=variant, n=nested: records.training_rows(samples(s, d), v).select("text", *(["speaker_id"] if v == "c" else []), f"{n}.*"),
        on_samples(
            f"""SELECT transcript AS text, {'speaker_id, ' if variant == 'c' else ''} gender, age, accent,
            voice_description AS {'description' if variant == 'c' else 'voice_profile'} FROM samples"""
        ),
    )
add(
    "training_rows_b",
    lambda s, d: rounded(records.training_rows(samples(s, d), "b")),
    on_samples(
        """SELECT transcript AS text, speaker_id, gender, age, accent, voice_description AS voice_profile,
        round(duration, 6) AS duration, dataset AS source_dataset FROM samples"""
    ),
)
add(
    "preview",
    lambda s, d: records.preview(samples(s, d)),
    on_samples(
        """SELECT speaker_id, CASE WHEN length(transcript) > 100 THEN concat(substr(transcript, 1, 100), '...') ELSE transcript END AS transcript,
        coalesce(gender, 'None') || ', ' || coalesce(age, 'None') || ', ' || coalesce(accent, 'None') AS metadata,
        substr(voice_description, 1, 200) || '...' AS voice_description_preview FROM samples"""
    ),
)
add(
    "basename_of_urls",
    lambda s, d: table(s, d, "pages").select("page_id", basename("url").alias("name"), basename(F.translate("url", "/", "\\")).alias("windows_name")),
    r"SELECT page_id, regexp_extract(url, '([^/\\]+)$', 1) AS name, regexp_extract(url, '([^/\\]+)$', 1) AS windows_name FROM pages",
)


# --- prompts -------------------------------------------------------------------------------------


def prompt_input(s, d):
    """Documents as rows of the four sources, by language."""
    docs = table(s, d, "documents")
    names = list(prompts.SOURCE_PROMPTS)
    known = F.array(*[F.lit(n) for n in names])
    place = F.length("lang") + F.length("source") + F.col("doc_id")
    return docs.select(
        F.col("doc_id").alias("idx"),
        F.element_at(known, (F.pmod(place, F.lit(4)) + 1).cast("int")).alias("dataset"),
        F.col("source").alias("gender"),
        F.when(F.col("n_chars") > 100, F.col("lang")).alias("age"),
        F.col("lang").alias("accent"),
        F.col("source").alias("emotion"),
        F.col("source").alias("character_name"),
        F.col("lang").alias("anime"),
    )


def _sql_text(text):
    return " || chr(10) || ".join("'" + line.replace("'", "''") + "'" for line in text.split("\n"))


def _sql_prompt(template):
    column = {"gender": "source", "age": "coalesce(CASE WHEN n_chars > 100 THEN lang END, 'None')", "accent": "lang", "emotion": "source", "character_name": "source", "anime": "lang", "voice_class": "'unknown'"}
    return " || ".join(column[t] if is_column else _sql_text(t) for t, is_column in prompts.template_parts(template))


add(
    "build_prompt",
    lambda s, d: prompts.build_prompt(prompt_input(s, d)).select("idx", "dataset", "prompt"),
    "WITH p AS (SELECT *, (length(lang) + length(source) + doc_id) % 4 AS place FROM documents) SELECT doc_id AS idx, CASE place "
    + " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(prompts.SOURCE_PROMPTS))
    + " END AS dataset, CASE place "
    + " ".join(f"WHEN {i} THEN {_sql_prompt(t)}" for i, t in enumerate(prompts.SOURCE_PROMPTS.values()))
    + " END AS prompt FROM p",
)
for kind, text in prompts.GENERIC_PROMPTS.items():
    add(
        f"prompt_{kind}",
        lambda s, d, k=kind: prompts.prompt_by_type(table(s, d, "documents").select("doc_id"), k),
        f"SELECT doc_id, {_sql_text(text)} AS prompt FROM documents",
    )


# --- annotation ----------------------------------------------------------------------------------


def loudness_annotator():
    """Names the loudest sample of a clip and refuses to describe a clip without a positive one."""

    def describe(samples, rate, prompt):
        first = float(samples[0])
        if first < 0:
            raise ValueError("starts below zero")
        return f"  {len(samples)} samples at {rate} Hz for {prompt}\n"

    return describe


def annotated(s, d):
    rows = waves(s, d).select("idx", "audio", F.col("speaker_id").alias("prompt"))
    return annotate.annotate(rows, loudness_annotator).select("idx", "voice_description")


add(
    "annotate",
    annotated,
    with_views(
        """SELECT idx, CASE WHEN samples[1] < 0 THEN 'Error: starts below zero'
        ELSE concat(len(samples), ' samples at 16 Hz for ', speaker_id) END AS voice_description FROM wave""",
        "wave",
    ),
)


def acoustic_input(s, d):
    both = samples(s, d).join(waves(s, d).select("idx", "samples"), "idx", "left")
    f0 = F.lit(100.0) + F.abs(F.element_at("samples", 1)).cast("double") * 600.0
    return both.select("idx", "transcript", "duration", f0.alias("f0"), rms_energy("samples", 16, 8).alias("energy"))


RMS = """list_transform(range(0, len({x}) // {hop} + 1), lambda i: sqrt(coalesce(list_sum(list_transform(
  {x}[greatest(i * {hop} - {half}, 0) + 1 : least(i * {hop} + {half}, len({x}))], lambda v: CAST(v AS DOUBLE) * CAST(v AS DOUBLE))), 0) / {frame}))"""


def sql_rms(column, frame, hop):
    return RMS.format(x=column, frame=frame, hop=hop, half=frame // 2)


ACOUSTIC = f""", a AS (SELECT idx, transcript, duration, 100 + abs(CAST(samples[1] AS DOUBLE)) * 600 AS f0,
   list_avg({sql_rms('samples', 16, 8)}) AS energy FROM samples LEFT JOIN (SELECT idx, samples FROM wave) USING (idx)),
 b AS (SELECT *, CASE WHEN duration > 0 THEN {sql_words('transcript')} / duration * 60 ELSE 0 END AS wpm FROM a),
 c AS (SELECT *, CASE WHEN f0 > 180 THEN 'high-pitched' WHEN f0 < 120 THEN 'low-pitched' ELSE 'medium-pitched' END AS pitch,
   CASE WHEN energy > 0.1 THEN 'energetic' WHEN energy < 0.05 THEN 'calm' ELSE 'moderate' END AS power,
   CASE WHEN wpm > 180 THEN 'fast' WHEN wpm < 120 THEN 'slow' ELSE 'moderate' END AS pace FROM b)
"""
add(
    "describe_acoustics",
    lambda s, d: annotate.describe_acoustics(acoustic_input(s, d)).select("idx", "voice_description"),
    with_views("", "samples", "wave").rstrip()
    + ACOUSTIC
    + """ SELECT idx, 'Voice Analysis:' || chr(10) || 'The speaker has a ' || pitch || ' voice with ' || power || ' delivery. ' || chr(10)
    || 'Speaking rate is ' || pace || ' at approximately ' || format('{:.0f}', wpm) || ' words per minute.' || chr(10)
    || 'Duration: ' || format('{:.1f}', duration) || ' seconds.' || chr(10) || chr(10) || 'Transcript: ' || transcript || chr(10) || chr(10)
    || 'Character/Persona:' || chr(10) || 'Based on the vocal characteristics, this voice would suit a '
    || CASE WHEN pitch = 'high-pitched' AND power = 'energetic' AND pace = 'fast' THEN 'young, enthusiastic character or excited narrator'
            WHEN pitch = 'low-pitched' AND power = 'calm' AND pace = 'slow' THEN 'wise elder, meditation guide, or authoritative figure'
            WHEN pitch = 'medium-pitched' AND power = 'moderate' AND pace = 'moderate' THEN 'professional presenter, teacher, or everyday character'
            ELSE 'versatile character suitable for various roles' END || '.' || chr(10) AS voice_description FROM c""",
)


def suggested(s, d):
    """Characters over the price, quantity and discount bands of the line items."""
    line = table(s, d, "lineitem")
    bands = line.select(
        F.element_at(F.array(F.lit("high-pitched"), F.lit("low-pitched"), F.lit("medium-pitched")), (F.col("l_linenumber") % 3 + 1)).alias("pitch"),
        F.when(F.col("l_discount") > 0.05, "energetic").when(F.col("l_discount") < 0.03, "calm").otherwise("moderate").alias("energy"),
        F.when(F.col("l_quantity") > 30, "fast").when(F.col("l_quantity") < 15, "slow").otherwise("moderate").alias("rate"),
    )
    named = bands.select(annotate.suggest_character(F.col("pitch"), F.col("energy"), F.col("rate")).alias("character"))
    return named.groupBy("character").agg(F.count("*").alias("rows"))


add(
    "suggest_character",
    suggested,
    """WITH b AS (SELECT l_linenumber % 3 AS p, CASE WHEN l_discount > 0.05 THEN 2 WHEN l_discount < 0.03 THEN 0 ELSE 1 END AS e,
      CASE WHEN l_quantity > 30 THEN 2 WHEN l_quantity < 15 THEN 0 ELSE 1 END AS r FROM lineitem)
    SELECT CASE WHEN p = 0 AND e = 2 AND r = 2 THEN 'young, enthusiastic character or excited narrator'
      WHEN p = 1 AND e = 0 AND r = 0 THEN 'wise elder, meditation guide, or authoritative figure'
      WHEN p = 2 AND e = 1 AND r = 1 THEN 'professional presenter, teacher, or everyday character'
      ELSE 'versatile character suitable for various roles' END AS character, count(*) AS rows FROM b GROUP BY 1""",
)
