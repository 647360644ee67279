"""Fetch logs: login walls, failure classes, run summaries, snapshots, retry reasons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Signs of a login page, and status codes worth a retry.
LOGIN_URL_PARTS = ["/login", "/signin"]
REQUEST_LOGIN_PART = "/login"
LOGIN_PHRASES = ["please log in", "sign in to continue", "session expired"]
RETRY_CODES = [500, 502, 503, 504, 408, 429]

COUNTED_KINDS = {
    "items": "item",
    "pages": "page",
    "retries": "retry",
    "errors": "error",
    "auth_expired": "auth_expired",
}


def _has(c: Column, part: str) -> Column:
    return F.coalesce(F.contains(c, F.lit(part)), F.lit(False))


def is_auth_wall(url: Column, body: Column, request_url: Column | None = None) -> Column:
    """The page is a login page and not what was asked for."""
    found = F.lit(False)
    for part in LOGIN_URL_PARTS:
        found = found | _has(url, part)
    if request_url is not None:
        found = found | _has(request_url, REQUEST_LOGIN_PART)
    low = F.lower(body)
    for phrase in LOGIN_PHRASES:
        found = found | _has(low, phrase)
    return found


def failure_class(
    error_name: Column, error_text: Column, status: Column, auth_wall: Column | None = None
) -> Column:
    """Kind of a failed fetch. Error texts are tested in the order timeout, closed, network."""
    low = F.lower(error_text)
    wall = F.lit(False) if auth_wall is None else auth_wall
    return (
        F.when(wall, "auth_expired")
        .when(status.isin(RETRY_CODES), "retryable_status")
        .when(_has(error_name, "Timeout") | _has(low, "timeout"), "timeout")
        .when(_has(low, "closed"), "closed")
        .when(_has(low, "net::"), "network")
        .otherwise("other")
    )


def run_summary(log: DataFrame) -> DataFrame:
    """Counts, duration and items per minute of each run."""
    counts = log.groupBy("run_id").agg(
        *[F.count_if(F.col("kind") == kind).alias(n) for n, kind in COUNTED_KINDS.items()],
        F.min(F.unix_micros(F.col("ts").cast("timestamp"))).alias("_from"),
        F.max(F.unix_micros(F.col("ts").cast("timestamp"))).alias("_to"),
    )
    seconds = (F.col("_to") - F.col("_from")) / 1e6
    return counts.select(
        "run_id",
        *COUNTED_KINDS,
        seconds.alias("duration_seconds"),
        F.when((F.col("items") > 0) & (seconds > 0), F.col("items") / seconds * 60).alias(
            "items_per_minute"
        ),
    )


def progress_snapshots(log: DataFrame, seconds: int = 60) -> DataFrame:
    """Running totals of each run at the end of every interval that has entries.

    Entries are first counted per interval, so the window runs over intervals and not entries.
    """
    slot = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / (seconds * 1_000_000))
    kinds = {"items": "item", "pages": "page", "retries": "retry", "_in": "enqueued", "_out": "dequeued"}
    per_slot = log.groupBy("run_id", slot.alias("_slot")).agg(
        *[F.count_if(F.col("kind") == kind).alias(n) for n, kind in kinds.items()]
    )
    run = Window.partitionBy("run_id").orderBy("_slot")
    sofar = run.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first = F.min("_slot").over(sofar)
    totals = {n: F.sum(n).over(sofar) for n in kinds}
    return per_slot.select(
        "run_id",
        F.timestamp_seconds(F.col("_slot") * seconds).alias("slot_start"),
        totals["items"].alias("items"),
        totals["pages"].alias("pages"),
        F.greatest(F.lit(0), totals["_in"] - totals["_out"]).alias("pending"),
        totals["retries"].alias("retries"),
        ((F.col("_slot") - first + 1) * seconds).alias("elapsed_seconds"),
    )


def retry_reasons(log: DataFrame) -> DataFrame:
    """Retries by reason for each run; given-up fetches count under ``max_reached``."""
    reason = F.when(F.col("kind") == "retry", F.coalesce("reason", F.lit("other"))).when(
        F.col("kind") == "gave_up", "max_reached"
    )
    return (
        log.select("run_id", reason.alias("reason"))
        .where(F.col("reason").isNotNull())
        .groupBy("run_id", "reason")
        .agg(F.count("*").alias("n"))
    )
