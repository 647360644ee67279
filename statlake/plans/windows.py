"""Planning tables: date windows, seasons, resume points, retries."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statlake.functions.seasons import (
    FIRST_MONTH,
    FIRST_SEASON,
    LAST_SEASON,
    long_season,
    season_key,
    season_start_year,
    short_season,
)
from statlake.functions.text import as_column

# Days per window; seconds of the first wait, its growth, the longest wait, tries.
WINDOW_DAYS = 30
BACKOFF_BASE, BACKOFF_FACTOR, BACKOFF_CAP, MAX_RETRIES = 5, 4, 120, 3


def date_windows(
    start: Column | str, end: Column | str, days: int = WINDOW_DAYS, inclusive: bool = True
) -> Column:
    """ARRAY of STRUCT(start, end): windows of ``days`` days that cover start to end.

    Without ``inclusive`` a window that would begin on the last day is left out, and start = end
    gives none.
    """
    if days < 1:
        raise ValueError("days must be at least 1")
    first, last = as_column(start).cast("date"), as_column(end).cast("date")
    stop = last if inclusive else F.date_sub(last, 1)
    starts = F.when(
        first <= stop, F.sequence(first, stop, F.make_dt_interval(F.lit(days)))
    ).otherwise(F.array().cast("array<date>"))
    return F.transform(
        starts,
        lambda s: F.struct(
            s.alias("start"), F.least(F.date_add(s, days - 1), last).alias("end")
        ),
    )


def explode_windows(
    ranges: DataFrame, start: str, end: str, days: int = WINDOW_DAYS, inclusive: bool = True
) -> DataFrame:
    """One row per window of each range, as ``window_start`` and ``window_end``."""
    windows = date_windows(start, end, days, inclusive)
    kept = [c for c in ranges.columns]
    return ranges.select(*kept, F.explode(windows).alias("_w")).select(
        *kept, F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end")
    )


def seasons_between(start: Column | str, end: Column | str) -> Column:
    """ARRAY of the seasons (``2024-25``) that overlap a range of dates."""
    first = season_start_year(as_column(start).cast("date"))
    last = season_start_year(as_column(end).cast("date"))
    years = F.when(first <= last, F.sequence(first, last)).otherwise(
        F.array().cast("array<int>")
    )
    return F.transform(years, short_season)


def season_list(start: str, end: str) -> list[str]:
    """The same seasons for two given days, as literals for a filter."""
    first, last = (
        d.year - (d.month < FIRST_MONTH) for d in map(datetime.date.fromisoformat, (start, end))
    )
    return [f"{y}-{(y + 1) % 100:02d}" for y in range(first, last + 1)]


def all_seasons(
    spark: SparkSession, first: int = FIRST_SEASON, last: int = LAST_SEASON
) -> DataFrame:
    """(season_key, season) for every season, counted from the first."""
    years = spark.range(first, last + 1).withColumnRenamed("id", "year")
    return years.select(
        season_key("year", first).alias("season_key"), long_season("year").alias("season")
    )


def resume_windows(
    state: DataFrame, target: Column | None = None, days: int = WINDOW_DAYS,
    inclusive: bool = True, written: DataFrame | None = None,
) -> DataFrame:
    """Windows still to load for each source: from the last processed date, else the initial
    start, to the target, else the initial end. Complete sources need none.

    The last processed date itself is loaded again, as it may have been going on. ``written`` has
    ``source`` and ``written_to``, up to which windows are whole; those days are not loaded again.
    """
    last = F.col("initial_end_date") if target is None else target
    todo = state.where(F.col("status") != "complete")
    start = F.coalesce("last_processed_date", "initial_start_date").cast("date")
    if written is not None:
        todo = todo.join(written.select("source", "written_to"), "source", "left")
        start = F.greatest(start, F.date_add("written_to", 1))
    todo = todo.select("source", start.alias("from_date"), last.cast("date").alias("to_date"))
    return explode_windows(todo, "from_date", "to_date", days, inclusive)


def backoff_seconds(attempt: Column | str) -> Column:
    """Wait after the given failed attempt (1, 2, ...)."""
    grown = BACKOFF_BASE * F.pow(F.lit(BACKOFF_FACTOR), as_column(attempt) - 1)
    return F.least(F.lit(float(BACKOFF_CAP)), grown)


def retry_plan(
    failures: DataFrame, attempts: str = "attempts", last_attempt: str = "last_attempt",
    max_retries: int = MAX_RETRIES,
) -> DataFrame:
    """Add ``delay_seconds``, ``next_eligible_at`` and ``give_up`` to failed work."""
    give_up = F.col(attempts) > max_retries
    delay = F.when(~give_up, backoff_seconds(attempts))
    micros = F.unix_micros(F.col(last_attempt).cast("timestamp"))
    return failures.withColumns(
        {
            "delay_seconds": delay,
            "next_eligible_at": F.timestamp_micros((micros + delay * 1_000_000).cast("bigint")),
            "give_up": give_up,
        }
    )
