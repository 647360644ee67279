"""Queries over fetch logs."""

from __future__ import annotations

from pyspark.sql import functions as F

from statlake.functions.text import iso_time
from statlake.operators import fetchlog
from statlake.queries.registry import pick, query, table

_KIND_SQL = """
    CASE event_type WHEN 'click' THEN 'item' WHEN 'view' THEN 'page'
        WHEN 'purchase' THEN CASE WHEN event_id % 7 = 0 THEN 'gave_up' ELSE 'retry' END
        WHEN 'signup' THEN CASE WHEN event_id % 3 = 0 THEN 'dequeued' ELSE 'enqueued' END
        ELSE CASE WHEN event_id % 4 = 0 THEN 'auth_expired' ELSE 'error' END END
"""


def fetch_log(spark, sf):
    """Events as a fetch log with one run per day."""
    key = F.col("event_id")
    kind = (
        F.when(F.col("event_type") == "click", "item")
        .when(F.col("event_type") == "view", "page")
        .when(F.col("event_type") == "purchase", F.when(key % 7 == 0, "gave_up").otherwise("retry"))
        .when(F.col("event_type") == "signup", F.when(key % 3 == 0, "dequeued").otherwise("enqueued"))
        .otherwise(F.when(key % 4 == 0, "auth_expired").otherwise("error"))
    )
    return table(spark, sf, "events").select(
        F.date_format("ts", "yyyy-MM-dd").alias("run_id"),
        "ts",
        kind.alias("kind"),
        pick(key % 3, ["timeout", "closed", None]).alias("reason"),
        key,
    )


_LOG = f"SELECT *, strftime(ts, '%Y-%m-%d') AS run_id, {_KIND_SQL} AS kind FROM events"


@query(
    "run_summary",
    f"""
    SELECT run_id, count(*) FILTER (WHERE kind = 'item') AS items, count(*) FILTER (WHERE kind = 'page') AS pages,
           count(*) FILTER (WHERE kind = 'retry') AS retries, count(*) FILTER (WHERE kind = 'error') AS errors,
           count(*) FILTER (WHERE kind = 'auth_expired') AS auth_expired,
           round((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6, 3) AS duration_seconds,
           round(count(*) FILTER (WHERE kind = 'item') / ((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6) * 60, 6)
               AS items_per_minute
    FROM ({_LOG}) GROUP BY run_id
    """,
)
def run_summary(spark, sf):
    return fetchlog.run_summary(fetch_log(spark, sf)).withColumns(
        {
            "duration_seconds": F.round("duration_seconds", 3),
            "items_per_minute": F.round("items_per_minute", 6),
        }
    )


@query(
    "progress_snapshots",
    f"""
    WITH s AS (SELECT run_id, epoch_us(ts) // 60000000 AS slot,
                      count(*) FILTER (WHERE kind = 'item') AS i, count(*) FILTER (WHERE kind = 'page') AS p,
                      count(*) FILTER (WHERE kind = 'retry') AS r, count(*) FILTER (WHERE kind = 'enqueued') AS e,
                      count(*) FILTER (WHERE kind = 'dequeued') AS d FROM ({_LOG}) GROUP BY 1, 2)
    SELECT run_id, strftime(make_timestamp(slot * 60000000), '%Y-%m-%dT%H:%M:%S.%f') AS slot_start,
           CAST(sum(i) OVER w AS BIGINT) AS items, CAST(sum(p) OVER w AS BIGINT) AS pages,
           CAST(greatest(0, sum(e) OVER w - sum(d) OVER w) AS BIGINT) AS pending,
           CAST(sum(r) OVER w AS BIGINT) AS retries, (slot - min(slot) OVER w + 1) * 60 AS elapsed_seconds
    FROM s WINDOW w AS (PARTITION BY run_id ORDER BY slot)
    """,
)
def progress_snapshots(spark, sf):
    return fetchlog.progress_snapshots(fetch_log(spark, sf)).withColumn(
        "slot_start", iso_time("slot_start")
    )


@query(
    "retry_reasons",
    f"""
    SELECT run_id, CASE WHEN kind = 'gave_up' THEN 'max_reached' WHEN event_id % 3 = 0 THEN 'timeout'
                        WHEN event_id % 3 = 1 THEN 'closed' ELSE 'other' END AS reason, count(*) AS n
    FROM ({_LOG}) WHERE kind IN ('retry', 'gave_up') GROUP BY 1, 2
    """,
)
def retry_reasons(spark, sf):
    return fetchlog.retry_reasons(fetch_log(spark, sf))


@query(
    "failure_classes",
    """
    SELECT CASE WHEN event_id % 11 = 0 THEN 'auth_expired' WHEN event_id % 13 = 0 THEN 'retryable_status'
                ELSE CASE event_id % 6 WHEN 0 THEN 'timeout' WHEN 1 THEN 'timeout' WHEN 2 THEN 'closed'
                          WHEN 3 THEN 'network' WHEN 4 THEN 'other' ELSE 'timeout' END END AS failure,
           event_type, count(*) AS n
    FROM events GROUP BY 1, 2
    """,
)
def failure_classes(spark, sf):
    key = F.col("event_id")
    name = pick(key % 6, ["TimeoutError", "Error", "Error", "Error", "KeyError", "Error"])
    message = pick(
        key % 6,
        ["x", "Navigation Timeout closed", "Target closed", "net::ERR_ABORTED", "net ERR",
         "timeout net::"],
    )
    status = F.when(key % 13 == 0, 503).otherwise(404)
    failure = fetchlog.failure_class(name, message, status, key % 11 == 0)
    return (
        table(spark, sf, "events")
        .groupBy(failure.alias("failure"), "event_type")
        .agg(F.count("*").alias("n"))
    )


@query(
    "auth_wall_pages",
    """
    SELECT page_id, page_id % 17 IN (1, 2, 3, 4, 5) OR contains(lower(html), 'please log in')
               OR contains(lower(html), 'sign in to continue') OR contains(lower(html), 'session expired')
               OR contains(url, '/login') OR contains(url, '/signin') AS is_wall
    FROM pages
    """,
)
def auth_wall_pages(spark, sf):
    key = F.col("page_id")
    body = F.concat(
        F.col("html"),
        F.coalesce(pick(key % 17, [None, "Please LOG in", "Sign in to continue", "SESSION EXPIRED"]), F.lit("")),
    )
    url = F.concat(F.col("url"), F.when(key % 17 == 4, "/signin?x").otherwise(""))
    asked = F.concat(F.col("url"), F.when(key % 17 == 5, "/login").otherwise(""))
    return table(spark, sf, "pages").select(
        "page_id", fetchlog.is_auth_wall(url, body, asked).alias("is_wall")
    )
