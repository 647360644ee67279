"""Queries that run a stream over the events file to its end."""

from __future__ import annotations

from pyspark.sql import functions as F

from statlake.functions.text import iso_time
from statlake.operators.progress import as_text_times
from statlake.queries.progress import _TIMES, FOLD_SQL, log_rows
from statlake.queries.registry import query, table
from statlake.session import scratch_dir
from statlake.streaming import metrics, progress, upserts

EVENT_SCHEMA = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
)


def event_stream(spark, sf, in_order=False):
    """The events in five files, one micro-batch each; the files go by time or are of all times."""
    path = scratch_dir(spark, "events")
    events = table(spark, sf, "events")
    if in_order:
        first, last = events.agg(F.min("ts"), F.max("ts")).first()
        place = F.floor((F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(F.lit(first).cast("timestamp"))) * 5
                        / (int((last - first).total_seconds() * 1e6) + 1))
        for k in range(5):  # one after the other: a stream takes files by their age
            # Not coalesced, which would read the whole table in one task for each file.
            events.where(place == k).repartition(1).write.mode("append").parquet(path)
    else:
        events.repartition(5, F.col("event_id") % 997).write.parquet(path)
    return spark.readStream.schema(EVENT_SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)


@query(
    "stream_upsert",
    """
    WITH r AS (
        SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS up,
               row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS down FROM events)
    SELECT a.user_id, a.event_type, a.props AS first_props, b.event_id AS last_event,
           CASE WHEN b.event_id % 3 > 0 THEN b.value END AS last_value
    FROM r a JOIN r b USING (user_id, event_type) WHERE a.up = 1 AND b.down = 1
    """,
)
def stream_upsert(spark, sf):
    root = scratch_dir(spark, "upserts")
    keys = ["user_id", "event_type"]
    stream = event_stream(spark, sf).select(
        *keys,
        "ts",
        "event_id",
        F.col("props").alias("first_props"),
        F.col("event_id").alias("last_event"),
        F.when(F.col("event_id") % 3 > 0, F.col("value")).alias("last_value"),
    )
    upserts.start_upserts(
        stream, f"{root}/deltas", f"{root}/checkpoint", keys, ["ts", "event_id"],
        ["first_props"], ["last_event", "last_value"],
    ).awaitTermination()
    upserts.compact_upserts(spark, f"{root}/deltas", f"{root}/compacted", keys)
    return upserts.read_upserts(spark, f"{root}/compacted", keys)


@query(
    "stream_progress",
    f"""
    WITH {FOLD_SQL}
    SELECT player_id, season, player_slug, player_name, status, url, extraction_source, stat_count,
           error, attempts, {_TIMES} FROM folded
    """,
)
def stream_progress(spark, sf):
    root = scratch_dir(spark, "progress")
    # Each event acts on what the ones before it left, so a log is landed in its order.
    progress.start_progress(
        log_rows(event_stream(spark, sf, in_order=True)), f"{root}/deltas", f"{root}/checkpoint",
    ).awaitTermination()
    return as_text_times(progress.read_progress(spark, f"{root}/deltas"))


@query(
    "stream_metrics",
    """
    SELECT strftime(make_timestamp(epoch_us(ts) // 60000000 * 60000000), '%Y-%m-%dT%H:%M:%S.%f') AS window_start,
           event_type, count(*) AS n FROM events GROUP BY 1, 2
    """,
)
def stream_metrics(spark, sf):
    root = scratch_dir(spark, "metrics")
    stream = event_stream(spark, sf).withColumn("ts", F.col("ts").cast("timestamp"))
    metrics.start_window_counts(
        stream, f"{root}/deltas", f"{root}/checkpoint", kind="event_type"
    ).awaitTermination()
    out = metrics.read_window_counts(spark, f"{root}/deltas", kind="event_type")
    return out.withColumn("window_start", iso_time("window_start"))


@query(
    "stream_dedup",
    "SELECT user_id, event_type, min_by(event_id, (ts, event_id)) AS event_id FROM events GROUP BY 1, 2",
)
def stream_dedup(spark, sf):
    """The first event of each user and type; all later ones count as replays."""
    root = scratch_dir(spark, "dedup")
    stream = event_stream(spark, sf).select("user_id", "event_type", "ts", "event_id")
    keys, order = ["user_id", "event_type"], ["ts", "event_id"]
    metrics.start_without_replays(
        stream, f"{root}/deltas", f"{root}/checkpoint", keys, order
    ).awaitTermination()
    return metrics.read_without_replays(spark, f"{root}/deltas", keys, order).drop("ts")
