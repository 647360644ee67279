"""Progress of work per (player, season): event log to current rows, queues, counts."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from statlake.functions.text import iso_time
from statlake.functions.urls import url_key
from statlake.operators.ordered import BLOCK, order_struct, with_blocks, with_keys

PROGRESS_KEY = ["player_id", "season"]
BLOCK_EVENTS = 100_000  # of a key, put together in one task

# Statuses, the events that change them, and the number of tries.
PENDING, IN_PROGRESS, SUCCESS, FAILED, SKIPPED = (
    "pending",
    "in_progress",
    "success",
    "failed",
    "skipped",
)
MAX_ATTEMPTS = 3
STATUS_AFTER = {
    "started": IN_PROGRESS,
    "completed": SUCCESS,
    "success": SUCCESS,
    "failed": FAILED,
    "failure_upsert": FAILED,
    "skipped": SKIPPED,
}
# Events that make the row if the key has none; the others only change a row that is there.
CREATING = ["started", "success", "failure_upsert", "skipped", "state"]

EVENT_FIELDS = ["player_slug", "player_name", "url", "source", "n", "error"]
PROGRESS_COLUMNS = [
    "player_id",
    "season",
    "player_slug",
    "player_name",
    "status",
    "url",
    "extraction_source",
    "stat_count",
    "error",
    "attempts",
    "last_attempt",
    "completed_at",
    "created_at",
]
_STATE_ONLY = ["status", "attempts", "last_attempt", "completed_at", "created_at"]


def _as_events(current: DataFrame, order_by: Sequence[str], events: DataFrame) -> DataFrame:
    """Current rows as the events that come before all others."""
    nulls = {c: F.lit(None).cast(events.schema[c].dataType) for c in order_by}
    return current.select(
        *PROGRESS_KEY,
        F.lit("state").alias("op"),
        "player_slug",
        "player_name",
        "url",
        F.col("extraction_source").alias("source"),
        F.col("stat_count").alias("n"),
        "error",
        *_STATE_ONLY,
    ).withColumns({**nulls, "_age": F.lit(0)})


def _is(*ops: str) -> Column:
    return F.col("op").isin(list(ops))


# What a stretch of the log does, whatever came before it, as far as a reset and a count depend on
# order: its tries; the last event that sets the error (``errs``: whether there is one, whether it
# fails, its error, the tries up to it, whether a reset follows it before the next status, whether
# one still may); the last event that sets the status (``sets``: whether it fails, whether a reset
# follows); a reset before the first status; the last count that was set, and what was added since.
# A stretch has this twice: as ``whole`` for a key that has a row before it, and as ``made`` for one
# that has none, where only what comes from the first creating event on has an effect.
_ADDS = {"tries": "a.tries + b.tries", "errs": "a.errs or b.errs", "sets": "a.sets or b.sets", "counts": "a.counts or b.counts"}
# What two stretches a and b do one after the other, by field: b's where b has such an event, else this.
_ELSE = {
    "errs": {
        "err_fails": "a.err_fails", "error": "a.error", "err_reset": "a.err_reset or (a.err_open and b.reset_first)",
        "err_open": "a.err_open and not b.sets",
    },
    "sets": {"fails": "a.fails", "was_reset": "a.was_reset or b.reset_first"},
    "counts": {"count": "a.count", "added": "a.added + b.added"},
}
_AFTER = {
    **_ADDS,
    **{f: f"if(b.{has}, b.{f}, {other})" for has, fields in _ELSE.items() for f, other in fields.items()},
    "err_tries": "if(b.errs, a.tries + b.err_tries, a.err_tries)",
    "reset_first": "a.reset_first or (not a.sets and b.reset_first)",
}
# What one event x does by itself, and what none does.
_ONE = {
    "tries": "x.tries", "errs": "x.errs", "err_fails": "x.fails", "error": "x.error", "err_tries": "x.tries",
    "err_reset": "false", "err_open": "x.errs", "sets": "x.sets", "fails": "x.fails", "was_reset": "false",
    "reset_first": "x.reset", "counts": "x.counts", "count": "x.n", "added": "x.added",
}
_KINDS = {"tries": "0L", "err_tries": "0L", "added": "0L", "count": "cast(null as bigint)", "error": "cast(null as string)"}


def _struct(fields: dict[str, str]) -> str:
    return "named_struct(" + ", ".join(f"'{f}', {fields[f]}" for f in _ONE) + ")"


def _stretch(whole: str, made: str, creates: str) -> str:
    return f"named_struct('whole', {whole}, 'made', {made}, 'creates', {creates})"


def _put_together() -> str:
    """Two stretches p and q as one. It does not matter how a log is cut into stretches."""
    after = _struct(_AFTER)
    whole, made = (re.sub(r"\b([ab])\.", lambda m: {"a": f"p.{side}.", "b": "q.whole."}[m[1]], after) for side in ("whole", "made"))
    return _stretch(whole, f"if(p.creates, {made}, q.made)", "p.creates or q.creates")


_NONE = _struct({f: _KINDS.get(f, "false") for f in _ONE})
_STRETCH_OF = _stretch(_struct(_ONE), f"if(x.creates, {_struct(_ONE)}, {_NONE})", "x.creates")
_FOLD = f"aggregate({{0}}, {_stretch(_NONE, _NONE, 'false')}, (p, q) -> {_put_together()})"


def fold_progress(
    events: DataFrame, block: Column | int = BLOCK_EVENTS, order_by: Sequence[str] = ("ts", "seq"),
    current: DataFrame | None = None, max_attempts: int = MAX_ATTEMPTS,
) -> DataFrame:
    """Replay an event log into one current row per key.

    ``events`` has the key, ``op``, the order columns, ``ts`` and the event fields; ``current``
    holds the rows of an earlier fold, which come first. Rules by event:

    * started: makes or updates the row, counts a try, keeps slug and name where the new are NULL
    * completed, failed: update only; completed sets the count and clears the error
    * success: makes or updates the row and adds to the count
    * failure_upsert: makes or updates the row and counts a try
    * skipped: makes or updates the row
    * reset: a failed row with fewer than ``max_attempts`` tries becomes pending, error cleared

    Two groupings do all of it. The first, by key and block, makes one row of a block: for fields
    that only the last event of some kind sets, that event; for what depends on the order, the
    block's effect on whatever it meets. The second puts the blocks of a key together, in their
    order. ``block`` is the number of events a block is to hold, or a column that does not fall as
    ``order_by`` rises.
    """
    order_by = list(order_by)
    state_nulls = {
        c: F.lit(None).cast(t)
        for c, t in zip(
            _STATE_ONLY, ["string", "bigint", "timestamp", "timestamp", "timestamp"], strict=True
        )
    }
    log = (
        with_keys(events, PROGRESS_KEY)
        .select(*PROGRESS_KEY, "op", *order_by, *EVENT_FIELDS)
        .withColumns({**state_nulls, "_age": F.lit(1)})
    )
    log = with_blocks(log, PROGRESS_KEY, order_by, block)
    if current is not None:
        old = _as_events(current, order_by, events).withColumn(
            BLOCK, F.lit(None).cast(log.schema[BLOCK].dataType)
        )
        log = log.unionByName(old.select(*log.columns))

    # NULL sorts first, so the earlier rows take the first place.
    ord_ = order_struct(["_age", *order_by])
    status = F.col("status")
    for op, then in STATUS_AFTER.items():
        status = F.when(F.col("op") == op, then).otherwise(status)
    count = F.coalesce(F.col("n"), F.lit(0)).cast("bigint")
    creates, sets = _is(*CREATING), _is("state", *STATUS_AFTER)
    tries = F.when(_is("started", "failure_upsert"), 1).when(_is("state"), F.col("attempts")).otherwise(0)
    errs = _is("completed", "failed", "skipped", "failure_upsert", "state")
    step = F.struct(
        ord_.alias("place"),
        F.coalesce(tries, F.lit(0)).cast("bigint").alias("tries"),
        errs.alias("errs"),
        (sets & F.coalesce(status == FAILED, F.lit(False))).alias("fails"),
        F.when(errs & ~_is("completed"), F.col("error")).alias("error"),
        sets.alias("sets"),
        _is("reset").alias("reset"),
        creates.alias("creates"),
        _is("completed", "state").alias("counts"),
        count.alias("n"),
        F.when(_is("success"), count).otherwise(0).alias("added"),
    )
    ts, slug, url = F.col("ts").cast("timestamp"), F.col("player_slug"), F.col("url")

    # (field, its value, the events that set it): the last one counts, if it is not before the row is made.
    fields = [
        ("started_slug", slug, _is("started") & slug.isNotNull()),
        ("player_name", F.col("player_name"), _is("started", "state") & F.col("player_name").isNotNull()),
        ("started_url", url, _is("started")),
        ("status", status, sets),
        ("extraction_source", F.col("source"), _is("success", "completed", "state")),
        ("last_attempt", F.when(_is("state"), F.col("last_attempt")).otherwise(ts), _is("started", "failed", "skipped", "failure_upsert", "state")),
        ("completed_at", F.when(_is("state"), F.col("completed_at")).otherwise(ts), _is("success", "completed", "state")),
    ]
    first = F.struct(
        "op", slug.alias("slug"), url.alias("url"),
        F.when(_is("state"), F.col("created_at")).otherwise(ts).alias("created_at"),
    )

    def last(name: str, value: Column, place: Column) -> Column:
        """The later of some (place, value), which partial aggregates also make of their rows."""
        return F.max_by(value, place).alias(name)

    known = sets | _is("reset")  # other events do nothing
    blocks = log.where(known).withColumn("_step", step).groupBy(*PROGRESS_KEY, BLOCK).agg(
        F.expr(_FOLD.format(f"transform(sort_array(collect_list(_step)), x -> {_STRETCH_OF})")).alias("_stretch"),
        F.min(ord_).alias("_begin"),
        F.min_by(F.struct(ord_.alias("place"), first.alias("v")), F.when(creates, ord_)).alias("_first"),
        *[
            last(f"_{name}", F.struct(ord_.alias("place"), value.alias("v")), F.when(where, ord_))
            for name, value, where in fields
        ],
    )
    stretches = "sort_array(collect_list(struct(_begin, _stretch)))._stretch"
    rows = blocks.groupBy(*PROGRESS_KEY).agg(
        F.expr(_FOLD.format(stretches)).alias("_all"),
        F.min_by("_first", F.col("_first.place")).alias("_first"),
        *[last(f"_{name}", F.col(f"_{name}"), F.col(f"_{name}.place")) for name, _, _ in fields],
    )
    made, begin = F.col("_all.made"), F.col("_first.v")

    def value(name: str) -> Column:
        return F.when(F.col(f"_{name}.place") >= F.col("_first.place"), F.col(f"_{name}.v"))

    # The event that makes the row names it; a later start may name it anew.
    own = F.when(begin["op"].isin("success", "failure_upsert", "state"), begin["slug"])
    own_url = F.when(begin["op"].isin("success", "failure_upsert", "state"), begin["url"])
    tries_left = made["tries"] < max_attempts
    cleared = made["err_fails"] & made["err_reset"] & (made["err_tries"] < max_attempts)
    folded = rows.where("_all.creates").select(
        *PROGRESS_KEY,
        F.coalesce(value("started_slug"), own).alias("player_slug"),
        value("player_name").alias("player_name"),
        F.when(made["fails"] & made["was_reset"] & tries_left, PENDING).otherwise(value("status")).alias("status"),
        F.when(F.col("_started_url").isNull(), own_url).otherwise(value("started_url")).alias("url"),
        value("extraction_source").alias("extraction_source"),
        (F.when(made["counts"], made["count"]).otherwise(0) + made["added"]).alias("stat_count"),
        F.when(made["errs"] & ~cleared, made["error"]).alias("error"),
        made["tries"].alias("attempts"),
        value("last_attempt").alias("last_attempt"),
        value("completed_at").alias("completed_at"),
        begin["created_at"].alias("created_at"),
    )
    return folded.select(*PROGRESS_COLUMNS)


def fold_tries(
    tries: DataFrame, order_by: Sequence[str] = ("ts", "seq"), current: DataFrame | None = None
) -> DataFrame:
    """The fold of a log in which each try is started and at once completed or failed.

    ``tries`` has the key, the order columns, ``ts``, the event fields and ``done``; ``current`` is as in
    ``fold_progress``, which gives the same rows for the two events of each try. With nothing between
    the two and no reset, only the first and the last try, the last done one and their number count:
    one grouping with partials, in which a hot key costs no more than any other.
    """
    order_by, ts = list(order_by), F.col("ts").cast("timestamp")
    log = with_keys(tries, PROGRESS_KEY).select(
        *PROGRESS_KEY, F.lit(1).alias("_age"), *order_by, *EVENT_FIELDS,
        F.when(F.col("done"), SUCCESS).otherwise(FAILED).alias("status"),
        F.lit(1).cast("bigint").alias("attempts"),
        ts.alias("last_attempt"), ts.alias("completed_at"), ts.alias("created_at"),
        F.coalesce("done", F.lit(False)).alias("_sets"),
    )
    if current is not None:
        old = _as_events(current, order_by, tries)
        log = log.unionByName(old.withColumn("_sets", F.lit(True)).select(*log.columns))
    ord_ = order_struct(["_age", *order_by])
    error = F.when((F.col("_age") == 0) | ~F.col("_sets"), F.col("error"))
    rows = log.groupBy(*PROGRESS_KEY).agg(
        F.max_by(F.struct("status", "url", error.alias("error"), "last_attempt"), ord_).alias("_last"),
        F.max_by(F.struct("source", "n", "completed_at"), F.when(F.col("_sets"), ord_)).alias("_done"),
        F.max_by("player_slug", F.when(F.col("player_slug").isNotNull(), ord_)).alias("player_slug"),
        F.max_by("player_name", F.when(F.col("player_name").isNotNull(), ord_)).alias("player_name"),
        F.min_by("created_at", ord_).alias("created_at"),
        F.coalesce(F.sum("attempts"), F.lit(0)).alias("attempts"),
    )
    return rows.select(
        *PROGRESS_KEY, "player_slug", "player_name", "_last.status", "_last.url",
        F.col("_done.source").alias("extraction_source"),
        F.coalesce(F.col("_done.n"), F.lit(0)).cast("bigint").alias("stat_count"),
        "_last.error", "attempts", "_last.last_attempt", "_done.completed_at", "created_at",
    ).select(*PROGRESS_COLUMNS)


def success_upserts(
    rows: DataFrame, order_by: Sequence[str], keys: Sequence[str] = PROGRESS_KEY,
    count: Column | None = None,
) -> DataFrame:
    """Success accounting of item rows: counts are summed, source and time are the last ones,
    slug and URL the first ones."""
    ord_ = order_struct(order_by)
    n = F.lit(1) if count is None else count
    return rows.groupBy(*keys).agg(
        F.min_by(F.struct("player_slug", "url"), ord_).alias("_first"),
        F.max_by(F.struct("source", "ts"), ord_).alias("_last"),
        F.sum(n).cast("bigint").alias("stat_count"),
    ).select(
        *keys,
        F.lit(SUCCESS).alias("status"),
        F.col("_first.player_slug"),
        F.col("_first.url"),
        F.col("_last.source").alias("extraction_source"),
        "stat_count",
        F.col("_last.ts").alias("completed_at"),
    )


def failure_upserts(
    rows: DataFrame, order_by: Sequence[str], keys: Sequence[str] = PROGRESS_KEY
) -> DataFrame:
    """Failure accounting: tries are counted, error and time are the last ones."""
    ord_ = order_struct(order_by)
    return rows.groupBy(*keys).agg(
        F.min_by(F.struct("player_slug", "url"), ord_).alias("_first"),
        F.max_by(F.struct("error", "ts"), ord_).alias("_last"),
        F.count("*").alias("attempts"),
    ).select(
        *keys,
        F.lit(FAILED).alias("status"),
        F.col("_first.player_slug"),
        F.col("_first.url"),
        F.col("_last.error"),
        "attempts",
        F.col("_last.ts").alias("last_attempt"),
    )


def item_count(stats: Column | None = None) -> Column:
    """Stats an item stands for: the length of its nested list, or one."""
    return F.lit(1) if stats is None else F.coalesce(F.array_size(stats), F.lit(1))


def is_completed(status: Column | str = "status") -> Column:
    c = F.col(status) if isinstance(status, str) else status
    return c.eqNullSafe(F.lit(SUCCESS))


def is_pending(status: Column | str = "status", attempts: Column | str = "attempts") -> Column:
    """To be done: no row, failed with tries left, or any status but success.

    So a failed row without tries left still counts; ``pending_queue`` has the capped rule.
    """
    s = F.col(status) if isinstance(status, str) else status
    a = F.col(attempts) if isinstance(attempts, str) else attempts
    retry = (s == FAILED) & (a < MAX_ATTEMPTS)
    return s.isNull() | F.coalesce(retry, F.lit(False)) | (s != SUCCESS)


def completed_keys(progress: DataFrame) -> DataFrame:
    """Distinct ``<id>_<season>`` of completed work."""
    return (
        progress.where(is_completed())
        .select(url_key("player_id", "season").alias("key"))
        .distinct()
    )


def pending_queue(
    progress: DataFrame, limit: int | None = None, max_attempts: int = MAX_ATTEMPTS
) -> DataFrame:
    """Pending and failed work with tries left, oldest first; no or zero limit means all."""
    queue = progress.where(
        F.col("status").isin(PENDING, FAILED) & (F.col("attempts") < max_attempts)
    ).orderBy("created_at", "player_id", "season")
    return queue.limit(limit) if limit else queue


def reset_failed(
    progress: DataFrame, max_attempts: int = MAX_ATTEMPTS
) -> tuple[DataFrame, Observation]:
    """Failed rows with tries left back to pending, and how many they are (``affected``).

    They are counted by the pass that writes the rows; the count is there when it is done.
    """
    hit = F.coalesce(
        (F.col("status") == FAILED) & (F.col("attempts") < max_attempts), F.lit(False)
    )
    seen = Observation("reset_failed")
    counted = progress.observe(seen, F.count_if(hit).alias("affected"))
    after = counted.withColumns(
        {
            "error": F.when(~hit, F.col("error")),
            "status": F.when(hit, F.lit(PENDING)).otherwise(F.col("status")),
        }
    )
    return after, seen


def status_counts(progress: DataFrame) -> DataFrame:
    """Rows by status, and their total."""
    by_status = progress.groupBy("status").agg(F.count("*").alias("n"))
    return (
        by_status.rollup("status")
        .agg(F.sum("n").alias("n"), F.grouping_id().alias("_all"))
        .select(
            F.when(F.col("_all") == 1, F.lit("total")).otherwise(F.col("status")).alias("status"),
            "n",
        )
    )


def as_text_times(progress: DataFrame) -> DataFrame:
    """Progress rows with ISO text times."""
    times = ["last_attempt", "completed_at", "created_at"]
    return progress.withColumns({c: iso_time(c) for c in times if c in progress.columns})
