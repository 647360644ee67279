"""Keyed and ordered operators: golden cases, brute force on small logs, properties."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from statlake.functions.urls import url_key
from statlake.operators import progress, upsert
from statlake.operators.breaker import rows_before_stop
from statlake.operators.fetchlog import failure_class, is_auth_wall
from statlake.operators.joins import skip_completed
from statlake.operators.normalize import is_valid_stat, normalize_stats
from statlake.operators.ordered import (
    carry_forward,
    first_rows_per_key,
    number_block,
    row_blocks,
    running,
    with_previous,
)
from statlake.plans import windows
from statlake.plans.windows import date_windows, season_list, seasons_between

FEW = settings(
    max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
EVENT_SCHEMA = (
    "player_id string, season string, op string, ts timestamp, seq long, player_slug string, "
    "player_name string, url string, source string, n long, error string"
)


def windows_of(spark, start, end, days=30, inclusive=True):
    df = spark.range(1).select(
        F.inline(date_windows(F.lit(start), F.lit(end), days, inclusive))
    )
    return [(str(r[0]), str(r[1])) for r in df.collect()]


def test_date_windows(spark):
    assert windows_of(spark, "2024-01-01", "2024-03-15") == [
        ("2024-01-01", "2024-01-30"), ("2024-01-31", "2024-02-29"), ("2024-03-01", "2024-03-15"),
    ]
    long = ("2024-01-01", "2024-01-30")
    assert windows_of(spark, "2024-01-01", "2024-01-31", inclusive=False) == [long]
    assert windows_of(spark, "2024-01-01", "2024-01-31") == [long, ("2024-01-31", "2024-01-31")]
    assert windows_of(spark, "2024-01-01", "2024-01-01", inclusive=False) == []
    assert windows_of(spark, "2024-01-01", "2024-01-01") == [("2024-01-01", "2024-01-01")]
    assert windows_of(spark, "2024-01-02", "2024-01-01") == []
    with pytest.raises(ValueError):
        date_windows(F.lit("2024-01-01"), F.lit("2024-01-02"), 0)


@FEW
@given(start=st.dates(), length=st.integers(0, 400), days=st.integers(1, 60))
def test_date_windows_cover(spark, start, length, days):
    import datetime

    start = max(min(start, datetime.date(2100, 1, 1)), datetime.date(1900, 1, 1))
    end = start + datetime.timedelta(days=length)
    got = windows_of(spark, str(start), str(end), days)
    covered = []
    for a, b in got:
        a, b = datetime.date.fromisoformat(a), datetime.date.fromisoformat(b)
        assert a <= b < a + datetime.timedelta(days=days)
        covered += [a + datetime.timedelta(days=i) for i in range((b - a).days + 1)]
    assert covered == [start + datetime.timedelta(days=i) for i in range(length + 1)]


def test_seasons(spark):
    got = spark.range(1).select(seasons_between(F.lit("2023-09-30"), F.lit("2024-10-01"))).first()[0]
    assert got == ["2022-23", "2023-24", "2024-25"] == season_list("2023-09-30", "2024-10-01")
    rows = windows.all_seasons(spark).collect()
    assert (len(rows), tuple(rows[0]), tuple(rows[-1])) == (
        14, ("0", "2013-2014"), ("13", "2026-2027"),
    )


def test_retry_plan(spark):
    df = spark.createDataFrame([(a, "2024-01-01 00:00:00") for a in (1, 2, 3, 4)], "attempts int, last_attempt string")
    rows = windows.retry_plan(df).orderBy("attempts").collect()
    assert [r["delay_seconds"] for r in rows] == [5.0, 20.0, 80.0, None]
    assert [r["give_up"] for r in rows] == [False, False, False, True]
    assert str(rows[1]["next_eligible_at"]).endswith("00:20")
    assert spark.range(1).select(windows.backoff_seconds(F.lit(4))).first()[0] == 120.0


def test_resume_windows(spark):
    state = spark.createDataFrame(
        [("a", "2024-01-01", "2024-01-10", None, "pending"), ("b", "2024-01-01", "2024-01-10", "2024-01-08", "in_progress"),
         ("c", "2024-01-01", "2024-01-10", "2024-01-10", "complete")],
        "source string, initial_start_date string, initial_end_date string, last_processed_date string, status string",
    )
    rows = windows.resume_windows(state, days=7).orderBy("source", "window_start").collect()
    assert [(r["source"], str(r["window_start"]), str(r["window_end"])) for r in rows] == [
        ("a", "2024-01-01", "2024-01-07"), ("a", "2024-01-08", "2024-01-10"), ("b", "2024-01-08", "2024-01-10"),
    ]


STAT_SCHEMA = (
    "player_id string, season string, statistic_name string, player_name string, player_slug string, "
    "statistic_category string, page_url string, is_complete boolean, value string, value_numeric double, "
    "percentile string, percentile_numeric double, grade string, extraction_source string, extracted_at string, n int"
)


def stat(n, name, category, value, grade, key="1"):
    return (key, "s", "FT", name, "slug", category, "u", True, value, 1.0, None, None, grade, "x", str(n), n)


def test_partial_upsert_keeps_nulls_of_last(spark):
    rows = [stat(1, "A", "X", "1", "B"), stat(2, "Z", "Y", "2", None), stat(3, "q", "q", "q", "q", None)]
    out = upsert.upsert_stats(spark.createDataFrame(rows, STAT_SCHEMA), ["extracted_at", "n"]).collect()
    assert [(r["player_name"], r["statistic_category"], r["value"], r["grade"]) for r in out] == [
        ("A", "X", "2", None)
    ]
    with pytest.raises(ValueError):
        upsert.upsert_stats(spark.createDataFrame(rows, STAT_SCHEMA), [])


def test_upsert_does_not_depend_on_input_order(spark):
    rows = [stat(i, f"n{i}", f"c{i}", str(i), None if i % 3 else "A", key=str(i % 4)) for i in range(40)]
    results = []
    for seed, parts in ((1, 1), (2, 7)):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, STAT_SCHEMA).repartition(parts)
        results.append(sorted(map(tuple, upsert.upsert_stats(df, ["n"]).collect()), key=str))
    assert results[0] == results[1]
    # In two steps, the second onto the table of the first, it is the same table.
    rows.sort(key=lambda r: r[-1])
    first = upsert.upsert_stats(spark.createDataFrame(rows[:15], STAT_SCHEMA), ["n"])
    both = upsert.upsert_into(
        first, spark.createDataFrame(rows[15:], STAT_SCHEMA), upsert.STAT_KEY, ["n"],
        upsert.STAT_IDENTITY, upsert.STAT_MEASURES,
    )
    assert sorted(map(tuple, both.select(*first.columns).collect()), key=str) == results[0]


def test_clean_ids_and_column_names(spark):
    df = spark.createDataFrame(
        list(enumerate([" 1", None, "2", "", "1 ", "2"])), "pos int, id string"
    )
    assert [r["id"] for r in upsert.clean_ids(df, "id", "pos").collect()] == ["1", "2"]
    with pytest.raises(ValueError):
        upsert.lower_columns(spark.range(1).select(F.lit(1).alias("GAME_ID"), F.lit(2).alias("game_id")))
    with pytest.raises(ValueError):
        upsert.union_all([])


def test_skip_completed(spark):
    seeds = spark.createDataFrame(
        [("a", "1", "s"), ("b", "2", "s"), ("c", None, "s"), ("d", "1", None), ("e", "", "s")],
        "url string, player_id string, season string",
    )
    done = spark.createDataFrame(
        [("1", "s", "success"), ("2", "s", "failed"), ("", "s", "success"), (None, "s", "success")],
        "player_id string, season string, status string",
    )
    left = {r["url"] for r in skip_completed(seeds, done).collect()}
    assert left == {"b", "c", "d", "e"}
    finished = {r["url"] for r in seeds.join(done.where("status = 'success' and player_id <> ''"), ["player_id", "season"]).collect()}
    assert left | finished == {"a", "b", "c", "d", "e"}


def status_rows(spark, statuses, key="k"):
    return spark.createDataFrame(
        [(key, i, s) for i, s in enumerate(statuses)], "k string, i int, status string"
    )


def brute_breaker(statuses, n):
    kept, run = [], 0
    for i, s in enumerate(statuses):
        if s == "ok":
            run = 0
            kept.append(i)
        elif s == "fail":
            run += 1
            if run >= n:
                break
    return kept


@pytest.mark.parametrize("width", [1, 3, 1000])
def test_breaker(spark, width):
    rng = random.Random(width)
    logs = {
        "a": ["ok", "fail", "empty", "fail", "ok"], "b": ["fail", "ok", "fail", "ok"],
        "c": ["fail"] * 4, "d": ["ok"] * 9, "e": ["empty", "fail", "empty", "empty", "fail", "ok"],
        **{f"r{j}": rng.choices(["ok", "fail", "empty"], [5, 3, 2], k=40) for j in range(6)},
    }
    df = None
    for k, statuses in logs.items():
        one = status_rows(spark, statuses, k)
        df = one if df is None else df.unionByName(one)
    for n in (2, 3):
        got = rows_before_stop(df, ["k"], ["i"], number_block("i", width), max_failures=n).collect()
        want = sorted((k, i) for k, statuses in logs.items() for i in brute_breaker(statuses, n))
        assert sorted((r["k"], r["i"]) for r in got) == want


def test_running_over_blocks(spark):
    rng = random.Random(5)
    rows = [(k, i, rng.choice([None, 1, 2]), rng.choice([None, "x", "y"])) for k in "ab" for i in range(30)]
    df = spark.createDataFrame(rows, "k string, i int, v int, c string")
    for block in (number_block("i", 4), 5, 1, 1000, F.lit(0)):
        out = running(df, ["k"], ["i"], block, {"total": F.col("v")}, {"carried": F.col("c")}).collect()
        assert len(out) == len(rows)
        for r in out:
            before = [x for x in rows if x[0] == r["k"] and x[1] <= r["i"]]
            assert r["total"] == sum(x[2] or 0 for x in before)
            assert r["carried"] == next((x[3] for x in reversed(before) if x[3]), None)
    filled = carry_forward(df, ["k"], ["i"], number_block("i", 4), "c", "General").collect()
    assert all(r["c"] is not None for r in filled)
    previous = {(r["k"], r["i"]): r["p"] for r in with_previous(df, ["k"], ["i"], number_block("i", 4), {"p": "c"}).collect()}
    values = {(x[0], x[1]): x[3] for x in rows}
    assert previous == {(k, i): values.get((k, i - 1)) for k, i in values}


def test_first_rows_with_a_hot_key(spark):
    df = spark.range(5000).select(
        F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise((F.col("id") % 7).cast("string")).alias("k"), "id"
    )
    got = first_rows_per_key(df, ["k"], ["id"], 5, descending=True).collect()
    rows = {}
    for r in df.collect():
        rows.setdefault(r["k"], []).append(r["id"])
    assert sorted((r["k"], r["id"]) for r in got) == sorted(
        (k, i) for k, ids in rows.items() for i in sorted(ids)[-5:]
    )


def brute_fold(log, max_attempts=3):
    """One event after the other, as one would write it for a single key."""
    rows = {}
    for e in sorted(log, key=lambda e: (e["ts"], e["seq"])):
        key, op = (e["player_id"], e["season"]), e["op"]
        row = rows.get(key)
        if row is None:
            if op not in ("started", "success", "failure_upsert", "skipped"):
                continue
            row = rows[key] = dict(
                slug=None, name=None, status=None, url=None, source=None, n=0, error=None, attempts=0,
                last=None, done=None, made=e["ts"],
            )
            if op in ("success", "failure_upsert"):
                row.update(slug=e["player_slug"], url=e["url"])
        if op == "reset":
            if row["status"] == "failed" and row["attempts"] < max_attempts:
                row.update(status="pending", error=None)
            continue
        row["status"] = progress.STATUS_AFTER[op]
        if op == "started":
            row.update(slug=e["player_slug"] or row["slug"], name=e["player_name"] or row["name"], url=e["url"])
        if op in ("started", "failure_upsert"):
            row["attempts"] += 1
        if op in ("started", "failed", "skipped", "failure_upsert"):
            row["last"] = e["ts"]
        if op in ("failed", "skipped", "failure_upsert"):
            row["error"] = e["error"]
        if op in ("completed", "success"):
            row.update(source=e["source"], done=e["ts"])
            row["n"] = e["n"] + (row["n"] if op == "success" else 0)
        if op == "completed":
            row["error"] = None
    return {k: tuple(v.values()) for k, v in rows.items()}


def random_log(seed, keys=6, size=150):
    import datetime

    rng = random.Random(seed)
    ops = ["started", "completed", "failed", "skipped", "success", "failure_upsert", "reset", "reset"]
    start = datetime.datetime(2024, 1, 1)
    return [
        dict(
            player_id="hot" if rng.random() < 0.4 else f"p{rng.randrange(keys)}", season="s", op=rng.choice(ops),
            ts=start + datetime.timedelta(seconds=rng.randrange(60)), seq=i,
            player_slug=rng.choice([None, f"s{i}"]), player_name=rng.choice([None, f"n{i}"]),
            url=rng.choice([None, f"u{i}"]), source=f"x{i}", n=rng.randrange(5), error=f"e{i}",
        )
        for i in range(size)
    ]


def fold_rows(df):
    return {
        (r["player_id"], r["season"]): (
            r["player_slug"], r["player_name"], r["status"], r["url"], r["extraction_source"], r["stat_count"],
            r["error"], r["attempts"], r["last_attempt"], r["completed_at"], r["created_at"],
        )
        for r in df.collect()
    }


@pytest.mark.parametrize("seed", [1, 2])
def test_progress_fold_equals_brute_force(spark, seed):
    from statlake.operators.ordered import time_block

    log = random_log(seed)
    df = spark.createDataFrame([tuple(e.values()) for e in log], EVENT_SCHEMA)
    want = brute_fold(log)
    assert fold_rows(progress.fold_progress(df, time_block("ts", 7))) == want
    # Half the log, then the other half onto the rows of the first.
    log.sort(key=lambda e: (e["ts"], e["seq"]))
    halves = [spark.createDataFrame([tuple(e.values()) for e in h], EVENT_SCHEMA) for h in (log[:70], log[70:])]
    first = progress.fold_progress(halves[0], time_block("ts", 7))
    second = progress.fold_progress(halves[1], time_block("ts", 7), current=first)
    untouched = {k: v for k, v in fold_rows(first).items() if k not in fold_rows(second)}
    assert {**untouched, **fold_rows(second)} == want


@pytest.mark.parametrize("block", [1, 3, 40, 10_000])
def test_progress_fold_does_not_depend_on_its_blocks(spark, block):
    log = random_log(7, keys=3, size=400)
    df = spark.createDataFrame([tuple(e.values()) for e in log], EVENT_SCHEMA)
    assert fold_rows(progress.fold_progress(df, block)) == brute_fold(log)
    none = spark.createDataFrame([], EVENT_SCHEMA)
    assert fold_rows(progress.fold_progress(none, block)) == {}


def test_progress_fold_groups_twice(spark):
    df = spark.createDataFrame([tuple(e.values()) for e in random_log(3)], EVENT_SCHEMA)
    plan = progress.fold_progress(df, F.lit(0))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and "Window" not in plan and "Join" not in plan


def test_row_blocks_of_a_hot_key(spark):
    """One key has most rows, many of them at one place of the first order column."""
    spread = F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id") % 1000)
    df = spark.range(60_000).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise((F.col("id") % 900).cast("string")).alias("k"), spread.alias("a"), "id"
    )
    blocks = row_blocks(df, ["k"], ["a", "id"], 2000)
    sizes = blocks.groupBy("k", "_block").agg(F.count("*").alias("n"), F.min(F.struct("a", "id")).alias("lo"), F.max(F.struct("a", "id")).alias("hi"))
    rows = sizes.orderBy("k", "_block").collect()
    assert sum(r["n"] for r in rows) == 60_000 and max(r["n"] for r in rows) <= 2000
    hot = [r for r in rows if r["k"] == "hot"]
    assert 20 <= len(hot) <= 80 and all(x["hi"] < y["lo"] for x, y in zip(hot, hot[1:], strict=False))
    assert all(r["_block"] == 0 for r in rows if r["k"] != "hot")


def test_status_queue_and_flags(spark):
    df = spark.createDataFrame(
        [("1", "s", "success", 1, "2024-01-03"), ("2", "s", "failed", 3, "2024-01-01"), ("3", "s", "failed", 1, "2024-01-04"),
         ("4", "s", "pending", 0, "2024-01-02"), ("5", "s", "in_progress", 1, "2024-01-01"), ("6", "s", "success", 2, "2024-01-01")],
        "player_id string, season string, status string, attempts int, created_at string",
    ).withColumn("error", F.lit("e"))
    counts = {r["status"]: r["n"] for r in progress.status_counts(df).collect()}
    assert counts == {"success": 2, "failed": 2, "pending": 1, "in_progress": 1, "total": 6}
    assert [r["player_id"] for r in progress.pending_queue(df).collect()] == ["4", "3"]
    assert [r["player_id"] for r in progress.pending_queue(df, 1).collect()] == ["4"]
    flags = {r["player_id"]: r["p"] for r in df.select("player_id", progress.is_pending().alias("p")).collect()}
    assert flags == {"1": False, "2": True, "3": True, "4": True, "5": True, "6": False}
    after, affected = progress.reset_failed(df)
    assert {(r["player_id"], r["error"]) for r in after.where("status = 'pending'").collect()} == {("3", None), ("4", "e")}
    assert affected.get["affected"] == 1
    assert {r["key"] for r in progress.completed_keys(df).collect()} == {"1_s", "6_s"}
    assert df.select(url_key("player_id", "season").alias("k")).first()["k"] == "1_s"


def test_success_and_failure_accounting(spark):
    rows = [("1", "s", f"slug{i}", f"u{i}", "src", f"e{i}", i, n) for i, n in enumerate([3, 4])]
    df = spark.createDataFrame(
        rows, "player_id string, season string, player_slug string, url string, source string, error string, ts int, n int"
    )
    ok = progress.success_upserts(df, ["ts"], count=F.col("n")).first()
    assert (ok["status"], ok["stat_count"], ok["player_slug"], ok["url"], ok["completed_at"]) == ("success", 7, "slug0", "u0", 1)
    bad = progress.failure_upserts(df, ["ts"]).first()
    assert (bad["status"], bad["attempts"], bad["error"], bad["last_attempt"]) == ("failed", 2, "e1", 1)


def test_predicates(spark):
    rows = [("Value", "1", False), (" grade ", "1", False), ("FT", "-", False), ("FT", " ", False), ("FT", "0", True), (None, "1", False), ("FT", None, False)]
    df = spark.createDataFrame(rows, "n string, v string, want boolean")
    assert all(r["got"] == r["want"] for r in df.select(is_valid_stat(F.col("n"), F.col("v")).alias("got"), "want").collect())
    cases = [("TimeoutError", "x", None, "timeout"), ("E", "Target closed", None, "closed"), ("E", "net::ERR_X", None, "network"),
             ("E", "x", 503, "retryable_status"), ("E", "x", 404, "other"), (None, None, None, "other")]
    df = spark.createDataFrame(cases, "e string, m string, s int, want string")
    assert all(r[0] == r[1] for r in df.select(failure_class(F.col("e"), F.col("m"), F.col("s")), "want").collect())
    walls = spark.createDataFrame([("h/login?x", "", True), ("h", "Session Expired now", True), ("h", "fine", False), (None, None, False)], "u string, b string, want boolean")
    assert all(r[0] == r[1] for r in walls.select(is_auth_wall(F.col("u"), F.col("b")), "want").collect())


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.createDataFrame([stat(1, "A", "X", "1", "B")], STAT_SCHEMA).write.parquet(path)
    rows = spark.read.parquet(path)
    cleaned = plan(normalize_stats(rows))
    assert "EvalPython" not in cleaned and "Exchange" not in cleaned
    assert plan(upsert.upsert_stats(rows, ["n"])).count("Exchange hashpartitioning") == 1
    assert "PushedFilters: [IsNotNull(player_id)" in plan(upsert.upsert_stats(rows, ["n"]))
    done = spark.createDataFrame([("1", "s", "success")], "player_id string, season string, status string")
    skipped = plan(skip_completed(rows.select("player_id", "season"), done))
    assert "LeftAnti" in skipped and "CartesianProduct" not in skipped
