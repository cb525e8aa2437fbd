"""Waveform operators over the embeddings read as clips of 16 Hz."""

from pyspark.sql import functions as F

from speechframe.catalog.base import Catalog, rounded, view, with_views
from speechframe.catalog.records import sql_rms
from speechframe.functions import waveform

CATALOG = Catalog()
add = CATALOG.add


def on_wave(sql):
    return with_views(sql, "wave")


def clips(s, d):
    return view(s, d, "wave")


def exploded(df, column):
    return rounded(df.select("idx", F.posexplode(column).alias("place", "x")).withColumn("x", F.col("x").cast("double")))


UNNESTED = """SELECT idx, CAST(unnest(range(0, len({x}))) AS INTEGER) AS place, round(CAST(unnest({x}) AS DOUBLE), 6) AS x FROM {source}"""


def stereo(df):
    """Neighbouring samples as the two channels of a frame."""
    starts = F.sequence(F.lit(1), F.size("samples") - 1, F.lit(2))
    frames = F.transform(starts, lambda i: F.array(F.element_at("samples", i), F.element_at("samples", i + 1)))
    return df.withColumn("frames", frames)


add(
    "to_mono",
    lambda s, d: exploded(stereo(clips(s, d)).withColumn("mono", waveform.to_mono("frames")), "mono"),
    on_wave(
        ", m AS (SELECT idx, list_transform(range(0, len(samples) // 2), lambda i: CAST((CAST(samples[2 * i + 1] AS DOUBLE) + CAST(samples[2 * i + 2] AS DOUBLE)) / 2 AS FLOAT)) AS mono FROM wave) "
        + UNNESTED.format(x="mono", source="m")
    ).replace(")\n,", "),"),
)
add(
    "clip",
    lambda s, d: exploded(clips(s, d).withColumn("kept", waveform.clip("samples", "sampling_rate", 2.0)), "kept"),
    on_wave(", c AS (SELECT idx, samples[1:32] AS kept FROM wave) " + UNNESTED.format(x="kept", source="c")).replace(")\n,", "),"),
)
add(
    "peak_normalize",
    lambda s, d: exploded(clips(s, d).withColumn("n", waveform.peak_normalize("samples")), "n"),
    on_wave(
        ", p AS (SELECT idx, samples, CAST(list_max(list_transform(samples, lambda x: abs(x))) AS DOUBLE) AS peak FROM wave), "
        + "n AS (SELECT idx, list_transform(samples, lambda x: CAST(x AS DOUBLE) / peak) AS n FROM p) "
        + UNNESTED.format(x="n", source="n")
    ).replace(")\n,", "),"),
)
add(
    "rms_energy",
    lambda s, d: rounded(clips(s, d).select("idx", waveform.rms_energy("samples", 16, 8).alias("energy"))),
    on_wave(f"SELECT idx, round(list_avg({sql_rms('samples', 16, 8)}), 6) AS energy FROM wave"),
)
add(
    "audio_duration",
    lambda s, d: clips(s, d).select("idx", waveform.duration_of("samples", "sampling_rate").alias("seconds")),
    on_wave("SELECT idx, len(samples) / 16 AS seconds FROM wave"),
)
add(
    "signal_stats",
    lambda s, d: rounded(clips(s, d).select("idx", waveform.signal_stats("samples").alias("t")).select("idx", "t.*")),
    on_wave(
        """SELECT idx, round(CAST(list_min(samples) AS DOUBLE), 6) AS min, round(CAST(list_max(samples) AS DOUBLE), 6) AS max,
        round(list_avg(list_transform(samples, lambda x: CAST(x AS DOUBLE))), 6) AS mean, CAST(len(samples) AS INTEGER) AS length FROM wave"""
    ),
)

# The first and last loud frame of every clip, a frame being loud within 3 dB of the loudest.
TRIM = f""", r AS (SELECT idx, samples, {sql_rms('samples', 16, 8)} AS levels FROM wave),
 l AS (SELECT idx, samples, list_transform(levels, lambda v: 10 * log10(greatest(v * v, 1e-10) / greatest(list_max(levels) ** 2, 1e-10)) > -3.0) AS loud FROM r),
 t AS (SELECT idx, samples, (list_position(loud, true) - 1) * 8 AS first,
   least((len(loud) - list_position(list_reverse(loud), true) + 1) * 8, len(samples)) AS last FROM l),
 k AS (SELECT idx, samples[first + 1 : last] AS kept FROM t) """
add(
    "trim_silence",
    lambda s, d: exploded(clips(s, d).withColumn("samples", waveform.trim_silence("samples", 3.0, 16, 8)), "samples"),
    on_wave(TRIM + UNNESTED.format(x="kept", source="k")).replace(")\n,", "),"),
)
add(
    "preprocess",
    lambda s, d: exploded(clips(s, d).withColumn("samples", waveform.preprocess("samples", "sampling_rate", 2.0, 3.0, 16, 8)), "samples"),
    on_wave(
        TRIM.rstrip()
        + ", c AS (SELECT idx, kept[1:32] AS kept FROM k), p AS (SELECT idx, kept, CAST(list_max(list_transform(kept, lambda x: abs(x))) AS DOUBLE) AS peak FROM c), "
        + "n AS (SELECT idx, list_transform(kept, lambda x: CAST(x AS DOUBLE) / peak) AS n FROM p) "
        + UNNESTED.format(x="n", source="n")
    ).replace(")\n,", "),"),
)
add(
    "preprocess_short_form",
    lambda s, d: exploded(stereo(clips(s, d)).withColumn("frames", waveform.preprocess("frames", "sampling_rate", trim=False, channels=True)), "frames"),
    on_wave(
        ", m AS (SELECT idx, list_transform(range(0, len(samples) // 2), lambda i: CAST((CAST(samples[2 * i + 1] AS DOUBLE) + CAST(samples[2 * i + 2] AS DOUBLE)) / 2 AS FLOAT)) AS mono FROM wave), "
        + "p AS (SELECT idx, mono, CAST(list_max(list_transform(mono, lambda x: abs(x))) AS DOUBLE) AS peak FROM m), "
        + "n AS (SELECT idx, list_transform(mono, lambda x: CAST(x AS DOUBLE) / peak) AS n FROM p) "
        + UNNESTED.format(x="n", source="n")
    ).replace(")\n,", "),"),
)
