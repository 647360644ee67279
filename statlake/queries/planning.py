"""Queries over load planning."""

from __future__ import annotations

from pyspark.sql import functions as F

from statlake.functions import seasons
from statlake.plans import windows
from statlake.queries.registry import query, season_sql, table, text
from statlake.sources.landed import box_scores_for, games_between


def _day(c: str):
    return F.date_format(c, "yyyy-MM-dd")


_RANGES = """
    SELECT o_orderpriority, o_orderstatus, CAST(min(o_orderdate) AS DATE) AS mn,
           CAST(max(o_orderdate) AS DATE) AS mx FROM orders GROUP BY 1, 2
"""


@query(
    "date_windows",
    f"""
    WITH r AS ({_RANGES}),
    w AS (SELECT *, CAST(unnest(generate_series(mn, mx, INTERVAL 30 DAY)) AS DATE) AS s FROM r)
    SELECT o_orderpriority, o_orderstatus, mode, strftime(s, '%Y-%m-%d') AS window_start,
           strftime(least(CAST(s + INTERVAL 29 DAY AS DATE), mx), '%Y-%m-%d') AS window_end
    FROM w, (VALUES ('inclusive'), ('open')) m(mode) WHERE mode = 'inclusive' OR s < mx
    """,
)
def date_windows(spark, sf):
    ranges = (
        table(spark, sf, "orders")
        .groupBy("o_orderpriority", "o_orderstatus")
        .agg(F.min("o_orderdate").alias("mn"), F.max("o_orderdate").alias("mx"))
    )
    both = [
        windows.explode_windows(ranges, "mn", "mx", 30, inclusive).withColumn("mode", F.lit(mode))
        for inclusive, mode in ((True, "inclusive"), (False, "open"))
    ]
    return both[0].unionByName(both[1]).select(
        "o_orderpriority", "o_orderstatus", "mode",
        _day("window_start").alias("window_start"), _day("window_end").alias("window_end"),
    )


@query(
    "seasons_in_range",
    """
    WITH r AS (SELECT o_custkey, min(year(o_orderdate) - CASE WHEN month(o_orderdate) < 10 THEN 1 ELSE 0 END) AS a,
                      max(year(o_orderdate) - CASE WHEN month(o_orderdate) < 10 THEN 1 ELSE 0 END) AS b
               FROM orders GROUP BY 1),
    y AS (SELECT o_custkey, unnest(generate_series(a, b)) AS y FROM r)
    SELECT o_custkey, printf('%d-%02d', y, (y + 1) % 100) AS season FROM y
    """,
)
def seasons_in_range(spark, sf):
    ranges = (
        table(spark, sf, "orders")
        .groupBy("o_custkey")
        .agg(F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("b"))
    )
    return ranges.select("o_custkey", F.explode(windows.seasons_between("a", "b")).alias("season"))


@query(
    "season_table",
    """
    WITH y AS (SELECT unnest(generate_series((SELECT min(year(o_orderdate)) FROM orders),
                                             (SELECT max(year(o_orderdate)) FROM orders))) AS y)
    SELECT CAST(y - (SELECT min(y) FROM y) AS VARCHAR) AS season_key, concat(y, '-', y + 1) AS season,
           (SELECT count(*) FROM orders WHERE year(o_orderdate) = y) AS n_orders FROM y
    """,
)
def season_table(spark, sf):
    orders = table(spark, sf, "orders")
    span = orders.agg(F.min(F.year("o_orderdate")), F.max(F.year("o_orderdate"))).first()
    counts = orders.groupBy(seasons.long_season(F.year("o_orderdate")).alias("season")).agg(
        F.count("*").alias("n_orders")
    )
    return (
        windows.all_seasons(spark, span[0], span[1])
        .join(counts, "season", "left")
        .na.fill(0, ["n_orders"])
        .select("season_key", "season", "n_orders")
    )


@query(
    "resume_windows",
    """
    WITH s AS (
        SELECT concat(o_orderpriority, '/', o_orderstatus) AS source, CAST(min(o_orderdate) AS DATE) AS a,
               CAST(max(o_orderdate) AS DATE) AS b,
               CASE o_orderstatus WHEN 'P' THEN CAST(max(o_orderdate) AS DATE) - 100 END AS done, o_orderstatus
        FROM orders GROUP BY o_orderpriority, o_orderstatus),
    w AS (SELECT *, CAST(unnest(generate_series(coalesce(done, a), b, INTERVAL 30 DAY)) AS DATE) AS s
          FROM s WHERE o_orderstatus <> 'F')
    SELECT source, strftime(s, '%Y-%m-%d') AS window_start,
           strftime(least(CAST(s + INTERVAL 29 DAY AS DATE), b), '%Y-%m-%d') AS window_end FROM w
    """,
)
def resume_windows(spark, sf):
    status = F.col("o_orderstatus")
    state = (
        table(spark, sf, "orders")
        .groupBy("o_orderpriority", status)
        .agg(F.min("o_orderdate").cast("date").alias("a"), F.max("o_orderdate").cast("date").alias("b"))
        .select(
            F.concat_ws("/", "o_orderpriority", status).alias("source"),
            text("a").alias("initial_start_date"),
            text("b").alias("initial_end_date"),
            F.when(status == "P", text(F.date_sub("b", 100))).alias("last_processed_date"),
            F.when(status == "F", "complete").otherwise("in_progress").alias("status"),
        )
    )
    return windows.resume_windows(state).select(
        "source", _day("window_start").alias("window_start"), _day("window_end").alias("window_end")
    )


@query(
    "retry_plan",
    """
    WITH f AS (SELECT user_id, count(*) AS attempts, max(ts) AS last_attempt FROM events
               WHERE event_type = 'error' GROUP BY user_id, CAST(ts AS DATE))
    SELECT user_id, attempts, strftime(last_attempt, '%Y-%m-%dT%H:%M:%S.%f') AS last_attempt,
           attempts > 3 AS give_up,
           CASE attempts WHEN 1 THEN 5.0e0 WHEN 2 THEN 20.0e0 WHEN 3 THEN 80.0e0 END AS delay_seconds,
           CASE WHEN attempts <= 3 THEN strftime(last_attempt + to_seconds(
               CASE attempts WHEN 1 THEN 5 WHEN 2 THEN 20 WHEN 3 THEN 80 END), '%Y-%m-%dT%H:%M:%S.%f')
           END AS next_eligible_at
    FROM f
    """,
)
def retry_plan(spark, sf):
    from statlake.functions.text import iso_time

    failures = (
        table(spark, sf, "events")
        .where(F.col("event_type") == "error")
        .groupBy("user_id", F.to_date("ts").alias("_day"))
        .agg(F.count("*").alias("attempts"), F.max("ts").alias("last_attempt"))
        .drop("_day")
    )
    return windows.retry_plan(failures).withColumns(
        {c: iso_time(c) for c in ("last_attempt", "next_eligible_at")}
    )


@query(
    "games_in_range",
    f"""
    SELECT game_id, strftime(o_orderdate, '%Y-%m-%d') AS game_date, {season_sql("o_orderdate")} AS season
    FROM (SELECT *, CAST(o_custkey AS VARCHAR) AS game_id,
                 row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn
          FROM orders WHERE o_orderdate BETWEEN '1996-09-15' AND '1998-10-20') WHERE rn = 1
    """,
)
def games_in_range(spark, sf):
    games = table(spark, sf, "orders").select(
        text("o_custkey").alias("game_id"),
        F.col("o_orderdate").alias("game_date"),
        "o_orderkey",
        seasons.season_of("o_orderdate").alias("season"),
    )
    found = games_between(games, "1996-09-15", "1998-10-20", order_by=("game_date", "o_orderkey"))
    return found.select("game_id", _day("game_date").alias("game_date"), "season")


@query(
    "box_scores_of_games",
    """
    SELECT CAST(l_orderkey AS VARCHAR) AS game_id, count(*) AS n, CAST(sum(l_quantity) AS BIGINT) AS points
    FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT')
    GROUP BY 1
    """,
)
def box_scores_of_games(spark, sf):
    scores = table(spark, sf, "lineitem").select(
        text("l_orderkey").alias("GAME_ID"), F.col("l_quantity").alias("Points")
    )
    ids = table(spark, sf, "orders").where(F.col("o_orderpriority") == "1-URGENT")
    return (
        box_scores_for(scores, ids.select(text("o_orderkey").alias("game_id")))
        .groupBy("game_id")
        .agg(F.count("*").alias("n"), F.sum("points").cast("bigint").alias("points"))
    )


