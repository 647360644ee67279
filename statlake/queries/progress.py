"""Queries over the progress table."""

from __future__ import annotations

from pyspark.sql import functions as F

from statlake.functions.text import iso_time
from statlake.operators import progress as ops
from statlake.queries.registry import query, table, text
from statlake.session import scratch_dir

EVENTS_SQL = """
    SELECT CAST(user_id AS VARCHAR) AS player_id, strftime(ts, '%Y-%m-%d') AS season, ts, event_id,
           CASE WHEN event_id % 9 = 0 THEN 'reset' WHEN event_type = 'click' THEN 'started'
                WHEN event_type = 'view' THEN 'completed' WHEN event_type = 'purchase' THEN 'success'
                WHEN event_type = 'signup' THEN 'skipped' WHEN event_id % 2 = 0 THEN 'failed'
                ELSE 'failure_upsert' END AS op,
           CASE WHEN event_id % 3 > 0 THEN concat('s', event_id) END AS slug,
           CASE WHEN event_id % 4 > 0 THEN concat('n', event_id) END AS name,
           CASE WHEN event_id % 10 > 0 THEN concat('u', event_id) END AS url,
           concat('src', event_id % 4) AS source, event_id % 10 AS n, concat('e', event_id) AS error
    FROM events
"""

# The state machine one event after the other, for every key.
FOLD_SQL = f"""
    RECURSIVE log AS (
        SELECT *, row_number() OVER (PARTITION BY player_id, season ORDER BY ts, event_id) AS rn,
               op IN ('started', 'success', 'failure_upsert', 'skipped') AS up
        FROM ({EVENTS_SQL})),
    st AS (
        SELECT DISTINCT player_id, season, CAST(0 AS BIGINT) AS rn, FALSE AS made,
               CAST(NULL AS VARCHAR) AS status, CAST(NULL AS VARCHAR) AS slug,
               CAST(NULL AS VARCHAR) AS name, CAST(NULL AS VARCHAR) AS url,
               CAST(NULL AS VARCHAR) AS source, CAST(0 AS BIGINT) AS n, CAST(NULL AS VARCHAR) AS error,
               CAST(0 AS BIGINT) AS attempts, CAST(NULL AS TIMESTAMP) AS last_attempt,
               CAST(NULL AS TIMESTAMP) AS completed_at, CAST(NULL AS TIMESTAMP) AS created_at FROM log
        UNION ALL
        SELECT e.player_id, e.season, e.rn, s.made OR e.up,
               CASE WHEN e.op = 'reset' THEN CASE WHEN s.status = 'failed' AND s.attempts < 3 THEN 'pending'
                         ELSE s.status END
                    WHEN NOT (s.made OR e.up) THEN NULL
                    WHEN e.op = 'started' THEN 'in_progress' WHEN e.op IN ('completed', 'success') THEN 'success'
                    WHEN e.op = 'skipped' THEN 'skipped' ELSE 'failed' END,
               CASE WHEN e.op = 'started' THEN coalesce(e.slug, s.slug)
                    WHEN e.op IN ('success', 'failure_upsert') AND NOT s.made THEN e.slug ELSE s.slug END,
               CASE WHEN e.op = 'started' THEN coalesce(e.name, s.name) ELSE s.name END,
               CASE WHEN e.op = 'started' OR (e.op IN ('success', 'failure_upsert') AND NOT s.made) THEN e.url
                    ELSE s.url END,
               CASE WHEN e.op = 'success' OR (e.op = 'completed' AND s.made) THEN e.source ELSE s.source END,
               CASE WHEN e.op = 'success' THEN s.n + e.n WHEN e.op = 'completed' AND s.made THEN e.n ELSE s.n END,
               CASE WHEN e.op = 'completed' AND s.made THEN NULL
                    WHEN e.op IN ('skipped', 'failure_upsert') OR (e.op = 'failed' AND s.made) THEN e.error
                    WHEN e.op = 'reset' AND s.status = 'failed' AND s.attempts < 3 THEN NULL ELSE s.error END,
               s.attempts + CASE WHEN e.op IN ('started', 'failure_upsert') THEN 1 ELSE 0 END,
               CASE WHEN e.op IN ('started', 'skipped', 'failure_upsert') OR (e.op = 'failed' AND s.made)
                    THEN e.ts ELSE s.last_attempt END,
               CASE WHEN e.op = 'success' OR (e.op = 'completed' AND s.made) THEN e.ts ELSE s.completed_at END,
               CASE WHEN e.up AND NOT s.made THEN e.ts ELSE s.created_at END
        FROM st s JOIN log e ON e.player_id = s.player_id AND e.season = s.season AND e.rn = s.rn + 1),
    folded AS (
        SELECT player_id, season, slug AS player_slug, name AS player_name, status, url,
               source AS extraction_source, n AS stat_count, error, attempts, last_attempt, completed_at, created_at
        FROM st JOIN (SELECT player_id, season, max(rn) AS rn FROM log GROUP BY ALL) USING (player_id, season, rn)
        WHERE made)
"""


def log_rows(events):
    """Events as a progress log."""
    key, kind = F.col("event_id"), F.col("event_type")
    op = (
        F.when(key % 9 == 0, "reset")
        .when(kind == "click", "started")
        .when(kind == "view", "completed")
        .when(kind == "purchase", "success")
        .when(kind == "signup", "skipped")
        .when(key % 2 == 0, "failed")
        .otherwise("failure_upsert")
    )

    def tagged(tag: str, every: int):
        return F.when(key % every > 0, F.concat(F.lit(tag), key))

    return events.select(
        text("user_id").alias("player_id"),
        F.date_format("ts", "yyyy-MM-dd").alias("season"),
        op.alias("op"),
        F.col("ts").cast("timestamp").alias("ts"),
        key.alias("seq"),
        tagged("s", 3).alias("player_slug"),
        tagged("n", 4).alias("player_name"),
        tagged("u", 10).alias("url"),
        F.concat(F.lit("src"), key % 4).alias("source"),
        (key % 10).alias("n"),
        F.concat(F.lit("e"), key).alias("error"),
    )


def folded(spark, sf):
    return ops.fold_progress(log_rows(table(spark, sf, "events")))


_TIMES = ", ".join(
    f"strftime({c}, '%Y-%m-%dT%H:%M:%S.%f') AS {c}"
    for c in ("last_attempt", "completed_at", "created_at")
)


@query(
    "progress_fold",
    f"""
    WITH {FOLD_SQL}
    SELECT player_id, season, player_slug, player_name, status, url, extraction_source, stat_count,
           error, attempts, {_TIMES} FROM folded
    """,
)
def progress_fold(spark, sf):
    return ops.as_text_times(folded(spark, sf))


@query(
    "progress_status_counts",
    f"""
    WITH {FOLD_SQL} SELECT status, count(*) AS n FROM folded GROUP BY status
    UNION ALL SELECT 'total', count(*) FROM folded
    """,
)
def progress_status_counts(spark, sf):
    return ops.status_counts(folded(spark, sf))


@query(
    "pending_queue",
    f"""
    WITH {FOLD_SQL} SELECT player_id, season, url FROM folded
    WHERE status IN ('pending', 'failed') AND attempts < 3 ORDER BY created_at, player_id, season LIMIT 50
    """,
)
def pending_queue(spark, sf):
    queue = ops.pending_queue(folded(spark, sf), limit=50)
    return queue.select("player_id", "season", "url")


@query(
    "reset_failed",
    f"""
    WITH {FOLD_SQL}
    SELECT player_id, season, CASE WHEN status = 'failed' AND attempts < 3 THEN 'pending' ELSE status END AS status,
           CASE WHEN NOT (status = 'failed' AND attempts < 3) THEN error END AS error,
           (SELECT count(*) FROM folded WHERE status = 'failed' AND attempts < 3) AS affected
    FROM folded
    """,
)
def reset_failed(spark, sf):
    after, seen = ops.reset_failed(folded(spark, sf))
    path = scratch_dir(spark, "reset")
    after.select("player_id", "season", "status", "error").write.parquet(path)
    return spark.read.parquet(path).withColumn("affected", F.lit(seen.get["affected"]))


@query(
    "progress_flags",
    f"""
    WITH {FOLD_SQL}
    SELECT c_custkey, coalesce(status = 'success', FALSE) AS completed,
           status IS NULL OR status <> 'success' AS pending,
           CASE WHEN status = 'success' THEN concat(player_id, '_', season) END AS completed_key
    FROM customer LEFT JOIN folded ON player_id = CAST(c_custkey AS VARCHAR)
    """,
)
def progress_flags(spark, sf):
    state = folded(spark, sf)
    done = ops.completed_keys(state).select(
        F.split("key", "_")[0].alias("player_id"),
        F.split("key", "_")[1].alias("season"),
        F.col("key").alias("completed_key"),
    )
    customers = table(spark, sf, "customer").select("c_custkey", text("c_custkey").alias("player_id"))
    return (
        customers.join(state.select(*ops.PROGRESS_KEY, "status", "attempts"), "player_id", "left")
        .join(done, ops.PROGRESS_KEY, "left")
        .select(
            "c_custkey",
            ops.is_completed().alias("completed"),
            ops.is_pending().alias("pending"),
            "completed_key",
        )
    )


@query(
    "progress_success",
    """
    WITH e AS (SELECT *, CAST(user_id AS VARCHAR) AS player_id, strftime(ts, '%Y-%m-%d') AS season FROM events
               WHERE event_type <> 'error'),
    r AS (SELECT *, row_number() OVER (PARTITION BY player_id, season ORDER BY ts, event_id) AS up,
                 row_number() OVER (PARTITION BY player_id, season ORDER BY ts DESC, event_id DESC) AS down,
                 sum(CASE WHEN event_id % 3 = 0 THEN event_id % 4 ELSE 1 END) OVER (PARTITION BY player_id, season) AS total
          FROM e)
    SELECT a.player_id, a.season, 'success' AS status, concat('s', a.event_id) AS player_slug,
           concat('u', a.event_id) AS url, b.event_type AS extraction_source,
           CAST(a.total AS BIGINT) AS stat_count, strftime(b.ts, '%Y-%m-%dT%H:%M:%S.%f') AS completed_at
    FROM r a JOIN r b USING (player_id, season) WHERE a.up = 1 AND b.down = 1
    """,
)
def progress_success(spark, sf):
    key = F.col("event_id")
    # Every third item is a profile whose nested list has 0 to 3 stats.
    nested = F.when(key % 3 == 0, F.array_repeat(key, (key % 4).cast("int")))
    rows = table(spark, sf, "events").where(F.col("event_type") != "error").select(
        text("user_id").alias("player_id"),
        F.date_format("ts", "yyyy-MM-dd").alias("season"),
        F.concat(F.lit("s"), key).alias("player_slug"),
        F.concat(F.lit("u"), key).alias("url"),
        F.col("event_type").alias("source"),
        "ts",
        "event_id",
        nested.alias("stats"),
    )
    out = ops.success_upserts(rows, ["ts", "event_id"], count=ops.item_count(F.col("stats")))
    return out.withColumn("completed_at", iso_time("completed_at"))


@query(
    "progress_failures",
    """
    WITH e AS (SELECT *, CAST(user_id AS VARCHAR) AS player_id, strftime(ts, '%Y-%m-%d') AS season FROM events
               WHERE event_type = 'error'),
    r AS (SELECT *, row_number() OVER (PARTITION BY player_id, season ORDER BY ts, event_id) AS up,
                 row_number() OVER (PARTITION BY player_id, season ORDER BY ts DESC, event_id DESC) AS down,
                 count(*) OVER (PARTITION BY player_id, season) AS total FROM e)
    SELECT a.player_id, a.season, 'failed' AS status, concat('s', a.event_id) AS player_slug,
           concat('u', a.event_id) AS url, CASE WHEN b.event_id % 5 > 0 THEN b.props END AS error,
           a.total AS attempts, strftime(b.ts, '%Y-%m-%dT%H:%M:%S.%f') AS last_attempt
    FROM r a JOIN r b USING (player_id, season) WHERE a.up = 1 AND b.down = 1
    """,
)
def progress_failures(spark, sf):
    key = F.col("event_id")
    rows = table(spark, sf, "events").where(F.col("event_type") == "error").select(
        text("user_id").alias("player_id"),
        F.date_format("ts", "yyyy-MM-dd").alias("season"),
        F.concat(F.lit("s"), key).alias("player_slug"),
        F.concat(F.lit("u"), key).alias("url"),
        F.when(key % 5 > 0, F.col("props")).alias("error"),
        "ts",
        "event_id",
    )
    out = ops.failure_upserts(rows, ["ts", "event_id"])
    return out.withColumn("last_attempt", iso_time("last_attempt"))
