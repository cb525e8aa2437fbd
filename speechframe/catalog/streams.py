"""Streaming forms over the given tables read as growing folders."""

from pyspark.sql import functions as F

from speechframe.catalog.base import Catalog, rounded, table
from speechframe.session import workspace
from speechframe.sources.adapters import normalize_source
from speechframe.sources.readers import stream_records
from speechframe.operators.records import to_combined
from speechframe.streaming import ingest as streams
from speechframe.streaming import state

CATALOG = Catalog()
add = CATALOG.add


def stream(s, d, name, files_per_batch=None):
    # the last letter in brackets makes the path a pattern, which a stream needs to read a single file
    schema = table(s, d, name).schema
    return stream_records(s, f"{d}/{name}.parque[t]", schema, "parquet", files_per_batch)


def parts(s, d, name, key, n):
    """The table as a folder of ``n`` files, each holding one range of the key."""
    path = workspace(s, name)
    table(s, d, name).repartitionByRange(n, key).write.parquet(path)
    return path


def ingested(s, d):
    place = workspace(s, "ingest")

    def shape(df):
        audio = F.array(F.col("value").cast("float")).alias("wav")
        rows = normalize_source(df.select(F.col("event_id").alias("idx"), audio, F.col("props").alias("json")), "laions")
        return rows.select("idx", "dataset", "speaker_id", "transcript", "duration", "emotion")

    for _ in range(2):  # the second run finds nothing new
        streams.ingest(stream(s, d, "events"), f"{place}/sink", f"{place}/checkpoint", shape).awaitTermination()
    return rounded(s.read.parquet(f"{place}/sink"))


add(
    "stream_ingest",
    ingested,
    """SELECT event_id AS idx, 'laions' AS dataset, concat('laions_', event_id) AS speaker_id, '' AS transcript, round(1 / 24000, 6) AS duration,
    'unknown' AS emotion FROM events""",
)


def totals(s, d):
    place = workspace(s, "totals")
    source = stream_records(s, parts(s, d, "events", "event_id", 8), table(s, d, "events").schema, "parquet", 1)
    streams.batch_totals(source, f"{place}/sink", f"{place}/checkpoint", "value")
    done = streams.running_batch_totals(s, f"{place}/sink")
    return rounded(done.agg(F.count("*").alias("batches"), F.sum("rows").alias("rows"), F.max("running_total").alias("running_total")), 3)


add(
    "stream_batch_totals",
    totals,
    "SELECT 8 AS batches, count(*) AS rows, round(sum(value), 3) AS running_total FROM events",
)


def bounded(s, d):
    place = workspace(s, "bounded")
    source = stream_records(s, parts(s, d, "events", "event_id", 8), table(s, d, "events").schema, "parquet", 1)
    before = []
    for _ in range(2):  # the second run goes on where the first one stopped
        streams.max_batches(source, 3, f"{place}/sink", f"{place}/checkpoint", "value")
        before.append(streams.running_batch_totals(s, f"{place}/sink").count())
    streams.batch_totals(source, f"{place}/sink", f"{place}/checkpoint", "value")
    done = streams.running_batch_totals(s, f"{place}/sink")
    stops = [F.lit(n).cast("long").alias(f"after_run_{i}") for i, n in enumerate(before, 1)]
    return rounded(done.agg(F.count("*").alias("batches"), F.sum("rows").alias("rows"), F.max("running_total").alias("running_total")).select("*", *stops), 3)


add(
    "stream_max_batches",
    bounded,
    "SELECT 8 AS batches, count(*) AS rows, round(sum(value), 3) AS running_total, 3 AS after_run_1, 6 AS after_run_2 FROM events",
)


def deduplicated(s, d):
    place = workspace(s, "dedup")
    unique = streams.dedup(stream(s, d, "conversations").select("conv_id", "role"), ["conv_id", "role"])
    streams.ingest(unique, f"{place}/sink", f"{place}/checkpoint").awaitTermination()
    return s.read.parquet(f"{place}/sink")


add("stream_dedup", deduplicated, "SELECT DISTINCT conv_id, role FROM conversations")


def counted(s, d, name, column):
    place = workspace(s, "counts")
    streams.save_counts(streams.streaming_counts(stream(s, d, name), column), f"{place}/sink", f"{place}/checkpoint")
    return s.read.parquet(f"{place}/sink")


for name, column in [("events", "event_type"), ("conversations", "role"), ("documents", "source")]:
    add(
        f"stream_counts_{column}",
        lambda s, d, n=name, c=column: counted(s, d, n, c),
        f"SELECT {column} AS value, count(*) AS count FROM {name} GROUP BY 1",
    )


def state_totals(s, d):
    """Eight files, one to a batch; the query stops after five of them and is started again when the rest has come."""
    place, whole = workspace(s, "state"), parts(s, d, "events", "event_id", 8)
    schema = table(s, d, "events").schema
    half = workspace(s, "half")
    pieces = [r.path for r in s.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(whole).select("path").orderBy("path").collect()]
    for arrived in (pieces[:5], pieces[5:]):
        s.read.schema(schema).parquet(*arrived).write.mode("append").parquet(half)
        source = stream_records(s, half, schema, "parquet", 1)
        state.save_batches(state.running_totals(source, "event_type", "value", "event_id"), f"{place}/sink", f"{place}/checkpoint")
    return rounded(state.latest_totals(s.read.parquet(f"{place}/sink")), 3)


add("stream_state_totals", state_totals, "SELECT event_type AS key, count(*) AS rows, round(sum(value), 3) AS total FROM events GROUP BY 1")


def checked(s, d):
    """Event rows in the combined shape; purchases bring a duration that is no number and are rejected."""
    place = workspace(s, "checked")
    source = stream_records(s, parts(s, d, "events", "event_id", 4), table(s, d, "events").schema, "parquet", 1)

    def split(batch):
        duration = F.when(F.col("event_type") == "purchase", F.concat(F.col("value").cast("string"), F.lit(" s"))).otherwise(F.col("value").cast("string"))
        audio = F.struct(F.array(F.col("value").cast("float")).alias("array"), F.lit(16).alias("sampling_rate"))
        none = F.lit(None).cast("string")
        return to_combined(
            batch.select(
                F.col("event_id").alias("index"), F.lit("laions").alias("dataset"), F.col("user_id").cast("string").alias("speaker_id"), F.col("event_type").alias("transcript"),
                audio.alias("audio"), duration.alias("duration"), none.alias("voice_description"), none.alias("gender"), none.alias("age"), none.alias("accent"),
            )
        )

    state.ingest_checked(source, split, f"{place}/sink", f"{place}/checkpoint")
    outcome = lambda name: s.read.parquet(f"{place}/sink/{name}").select(F.lit(name).alias("outcome"), "index", "transcript")
    return outcome("good").unionByName(outcome("rejected"))


add(
    "stream_rejected_rows",
    checked,
    "SELECT CASE WHEN event_type = 'purchase' THEN 'rejected' ELSE 'good' END AS outcome, event_id AS \"index\", event_type AS transcript FROM events",
)
