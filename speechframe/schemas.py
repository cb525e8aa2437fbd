"""Fixed schemas of the corpus tables. Nothing is inferred at read time."""

from pyspark.sql import types as T

UNKNOWN = "unknown"

AUDIO = T.StructType(
    [
        T.StructField("array", T.ArrayType(T.FloatType())),
        T.StructField("sampling_rate", T.IntegerType()),
    ]
)

DEMOGRAPHICS = ["gender", "age", "accent"]

RECORD = T.StructType(
    [
        T.StructField("index", T.LongType()),
        T.StructField("dataset", T.StringType()),
        T.StructField("speaker_id", T.StringType()),
        T.StructField("transcript", T.StringType()),
        T.StructField("audio_path", T.StringType()),
        T.StructField("duration", T.DoubleType()),
        T.StructField("voice_description", T.StringType()),
        T.StructField("processing_timestamp", T.StringType()),
        T.StructField("gender", T.StringType()),
        T.StructField("age", T.StringType()),
        T.StructField("accent", T.StringType()),
    ]
)

COMBINED = T.StructType(
    [
        T.StructField("index", T.LongType()),
        T.StructField("dataset", T.StringType()),
        T.StructField("speaker_id", T.StringType()),
        T.StructField("transcript", T.StringType()),
        T.StructField("audio", AUDIO),
        T.StructField("duration", T.DoubleType()),
        T.StructField("voice_description", T.StringType()),
        T.StructField("gender", T.StringType()),
        T.StructField("age", T.StringType()),
        T.StructField("accent", T.StringType()),
    ]
)

SPLIT = T.StructType(
    [
        T.StructField("speaker_id", T.LongType()),
        T.StructField("transcript", T.StringType()),
        T.StructField("audio", AUDIO),
        T.StructField("voice_description", T.StringType()),
        T.StructField("gender", T.StringType()),
        T.StructField("age", T.StringType()),
        T.StructField("accent", T.StringType()),
        T.StructField("duration", T.DoubleType()),
        T.StructField("dataset", T.StringType()),
    ]
)

# The four sources in the fixed order in which they are combined.
SOURCE_ORDER = ["animevox", "anispeech", "globe_v2", "laions"]
