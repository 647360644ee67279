"""The ledger of an ingest: what each window of each source came to, kept as it happens.

Every event is written at once as a small file of its own below the ledger, so that nothing is ever rewritten
and a driver that is lost forgets no window. ``started`` comes before the first row of a window is written
and names the part (run folder) that takes its rows; ``written`` comes after the last one. A part that was
started and not written is an orphan: the next run removes it, so its rows do not stay beside those of the
repeated window. The state document is a fold of the ledger.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from statlake.session import path_exists, write_text

STARTED, WRITTEN, FAILED = "started", "written", "failed"
EVENT_SCHEMA = (
    "source string, window_start date, window_end date, run_ts string, event string, part string, "
    "rows bigint, error string, error_class string"
)
EVENT_FIELDS = [field.split()[0] for field in EVENT_SCHEMA.split(", ")]


def path_key(text: str) -> str:
    """Any text as part of a path, different texts as different parts."""
    return "".join(c if c.isalnum() and c.isascii() else f"-{ord(c):x}-" for c in text)


def append_event(
    spark: SparkSession, path: str, source: str, window: tuple, run_ts: str, event: str, part: str,
    rows: int = 0, error: Exception | None = None,
) -> None:
    """Add one event. Adding it again replaces it, so a repeated call counts once."""
    said = None if error is None else (str(error).splitlines() or [""])[0]
    kind = None if error is None else type(error).__name__
    start, end = (str(day) for day in window)
    row = dict(zip(EVENT_FIELDS, (source, start, end, run_ts, event, part, rows, said, kind), strict=True))
    name = f"{start}_{path_key(run_ts)}_{event}.json"
    write_text(spark, f"{path}/{path_key(source)}", name, json.dumps(row))


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """All events; none where there is no ledger yet."""
    if not path_exists(spark, f"{path}/*/[0-9]*.json"):
        return spark.createDataFrame([], EVENT_SCHEMA)
    return spark.read.schema(EVENT_SCHEMA).json(f"{path}/*/[0-9]*.json")


def orphans(ledger: DataFrame) -> DataFrame:
    """(source, part) of windows that were started and not written."""
    parts = ledger.groupBy("source", "part").agg(F.bool_or(F.col("event") == WRITTEN).alias("whole"))
    return parts.where(~F.col("whole")).select("source", "part")


def written_through(ledger: DataFrame) -> DataFrame:
    """(source, written_to): the last day up to which the written windows of a source leave no gap."""
    done = ledger.where(F.col("event") == WRITTEN).select("source", "window_start", "window_end").distinct()
    order = Window.partitionBy("source").orderBy("window_start", "window_end")
    before = F.max("window_end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    gap = F.coalesce(F.col("window_start") > F.date_add(before, 1), F.lit(False))
    gaps = done.withColumn("gap", gap).withColumn("gaps", F.count_if("gap").over(order))
    return gaps.where("gaps = 0").groupBy("source").agg(F.max("window_end").alias("written_to"))


def fold_ledger(state: DataFrame, ledger: DataFrame) -> DataFrame:
    """State rows after what the ledger says. Folding the same events twice changes nothing.

    Written windows move the resume point. Failures count if their run is later than the last one the state
    knows, which the fold sets; the last event of that run says whether there is an error.
    """
    known = state.select("source", F.coalesce("last_run_ts", F.lit("")).alias("_known"))
    fresh = ledger.join(known, "source").where(F.col("run_ts") > F.col("_known"))
    order = F.struct("run_ts", "window_start", (F.col("event") != STARTED).cast("int"))
    runs = fresh.groupBy("source").agg(
        F.max("run_ts").alias("_run"),
        F.count_if(F.col("event") == FAILED).cast("int").alias("_failed"),
        F.max_by(F.when(F.col("event") == FAILED, F.col("error")), order).alias("_error"),
    )
    ran = F.col("_run").isNotNull()
    reached = F.greatest("last_processed_date", F.date_format("written_to", "yyyy-MM-dd"))
    return (
        state.join(runs, "source", "left")
        .join(written_through(ledger), "source", "left")
        .withColumns(
            {
                "last_processed_date": reached,
                "status": F.when(F.col("written_to").isNotNull() & (reached >= F.col("initial_end_date")), "complete")
                .when(ran, "in_progress")
                .otherwise(F.col("status")),
                "last_run_ts": F.coalesce("_run", "last_run_ts"),
                "error_count": F.col("error_count") + F.coalesce("_failed", F.lit(0)),
                "last_error": F.when(ran, F.col("_error")).otherwise(F.col("last_error")),
            }
        )
        .select(*state.columns)
    )
