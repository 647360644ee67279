"""Queries that run the whole jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from statlake.functions.seasons import season_of
from statlake.functions.text import iso_time
from statlake.plans.crawl import run_crawl
from statlake.plans.ingest import run_ingest, run_resumed
from statlake.plans.ledger import FAILED, read_ledger
from statlake.queries.extraction import order_pages, order_responses
from statlake.queries.possessions import games as nested_games
from statlake.queries.registry import query, table, text
from statlake.session import scratch_dir
from statlake.sinks.tables import write_state
from statlake.sources.landed import read_games
from statlake.sources.state import read_state, state_document, state_rows


@query(
    "ingest_job",
    """
    WITH g AS (SELECT * FROM orders WHERE o_orderstatus = 'F')
    SELECT 'games' AS dataset, 'written' AS status, count(*) AS n, count(*) AS n_stored,
           CAST(NULL AS VARCHAR) AS error FROM g
    UNION ALL SELECT 'possessions', 'written', CAST(sum(o_orderkey % 4) AS BIGINT),
           CAST(sum(o_orderkey % 4) AS BIGINT), NULL FROM g
    UNION ALL SELECT 'profiles', 'failed', 0, 0, 'no profiles today'
    """,
)
def ingest_job(spark, sf):
    """Games, the possessions of those games, and profiles that fail."""
    root = scratch_dir(spark, "bronze")
    landed = scratch_dir(spark, "landed")
    table(spark, sf, "orders").where(F.col("o_orderstatus") == "F").select(
        F.concat(F.lit(" "), text("o_orderkey")).alias("GAME_ID"), F.col("o_orderdate").alias("GAME_DATE")
    ).write.parquet(landed)

    def no_profiles():
        raise ValueError("no profiles today")

    log = run_ingest(
        spark, lambda: read_games(spark, landed), lambda: nested_games(spark, sf), root,
        "20240101_070000", no_profiles,
    )
    stored = None
    for dataset in ("games", "possessions"):
        n = spark.read.parquet(f"{root}/{dataset}").agg(F.count("*").alias("n_stored"))
        n = n.withColumn("dataset", F.lit(dataset))
        stored = n if stored is None else stored.unionByName(n)
    return (
        log.join(stored, "dataset", "left")
        .select("dataset", "status", F.col("rows").alias("n"), "n_stored", "error")
        .na.fill(0, ["n_stored"])
    )


_PAGES_SQL = """
    SELECT o_orderkey AS k, CAST(o_custkey AS VARCHAR) AS player_id, concat(year(o_orderdate), '-', year(o_orderdate) + 1) AS season,
           o_orderkey % 5 AS v, CAST(round(o_totalprice * 100) AS BIGINT) AS price, day(o_orderdate) AS day, o_orderstatus AS status
    FROM orders
"""


def _crawl(spark, sf):
    """A run in which pages with odd keys come without their content, then one over all pages that
    skips what is done."""
    pages, responses = order_pages(spark, sf), order_responses(spark, sf)
    partly = F.when(F.col("page_id") % 2 == 0, F.col("html")).otherwise("<p>loading</p>")
    first = run_crawl(
        spark, pages.withColumn("html", partly), scratch_dir(spark, "crawl1"),
        "2024-01-01 07:00:00", responses,
    )
    progress = spark.read.parquet(first.progress)
    seeds = pages.select(
        "url",
        F.lit(None).cast("string").alias("player_slug"),
        F.regexp_extract("url", "/([0-9]+)$", 1).alias("player_id"),
        F.regexp_extract("url", "/([0-9]{4}-[0-9]{4})/", 1).alias("season"),
    ).distinct()
    # A second seed for each URL, which does not know the player; and pages of no seed.
    seeds = seeds.withColumn("player_id", F.explode(F.array("player_id", F.lit(None).cast("string"))))
    strange = pages.where("page_id % 7 = 0").withColumns(
        {"page_id": -F.col("page_id"), "url": F.concat("url", F.lit("/extra"))}
    )
    return run_crawl(
        spark, pages.unionByName(strange), scratch_dir(spark, "crawl2"), "2024-01-02 07:00:00",
        responses, seeds, progress, first.stats,
    )


# The events of both runs, as plain SQL. A page gives a completed event if it has stats; in run one
# the odd keys have none unless they were captured; run two takes the pages of player seasons that
# run one did not leave as success.
_EVENTS_SQL = f"""
    p AS ({_PAGES_SQL}),
    e1 AS (SELECT * REPLACE (CASE WHEN k % 2 = 0 OR v = 2 THEN v ELSE 4 END AS v), 1 AS run FROM p),
    s1 AS (SELECT player_id, season, max_by(v, k) < 4 AS ok FROM e1 GROUP BY 1, 2),
    e2 AS (SELECT p.*, 2 AS run FROM p WHERE NOT EXISTS (
           SELECT 1 FROM s1 WHERE ok AND s1.player_id = p.player_id AND s1.season = p.season)),
    e AS (SELECT * FROM e1 UNION ALL SELECT * FROM e2)
"""


@query(
    "crawl_job_progress",
    f"""
    WITH {_EVENTS_SQL},
    r AS (SELECT *, row_number() OVER (PARTITION BY player_id, season ORDER BY run DESC, k DESC) AS down,
                 count(*) OVER (PARTITION BY player_id, season) AS tries FROM e),
    done AS (SELECT player_id, season, max_by(v, run * 1000000000000 + k) AS v FROM e WHERE v < 4 GROUP BY 1, 2)
    SELECT r.player_id, r.season, CASE WHEN r.v < 4 THEN 'success' ELSE 'failed' END AS status,
           CASE WHEN r.v = 4 THEN 'No stats found' END AS error, r.tries AS attempts,
           CASE done.v WHEN 0 THEN 'next_data' WHEN 1 THEN 'apollo_state' WHEN 2 THEN 'xhr_json' WHEN 3 THEN 'dom_tables' END AS extraction_source,
           CAST(CASE WHEN done.v IS NULL THEN 0 WHEN done.v = 0 THEN 3 ELSE 2 END AS BIGINT) AS stat_count,
           concat('2024-01-0', r.run, 'T07:00:00.000000') AS last_attempt
    FROM r LEFT JOIN done ON done.player_id = r.player_id AND done.season = r.season WHERE r.down = 1
    """,
)
def crawl_job_progress(spark, sf):
    out = spark.read.parquet(_crawl(spark, sf).progress)
    return out.select(
        "player_id", "season", "status", "error", "attempts", "extraction_source", "stat_count",
        iso_time("last_attempt").alias("last_attempt"),
    )


@query(
    "crawl_job_stats",
    f"""
    WITH {_EVENTS_SQL},
    rows AS (
        SELECT *, 'Price' AS statistic_name, CASE WHEN v < 2 THEN 'Shooting' WHEN v = 2 THEN 'General' ELSE 'Totals' END AS category,
               CAST(price AS VARCHAR) AS value FROM e WHERE v < 4
        UNION ALL SELECT *, 'Day', CASE WHEN v = 0 THEN 'Shooting' WHEN v < 3 THEN 'General' ELSE 'Totals' END, CAST(day AS VARCHAR) FROM e WHERE v < 4
        UNION ALL SELECT *, 'Status', 'Defense', status FROM e WHERE v = 0),
    r AS (SELECT *, row_number() OVER (PARTITION BY player_id, season, statistic_name ORDER BY run, k) AS up,
                 row_number() OVER (PARTITION BY player_id, season, statistic_name ORDER BY run DESC, k DESC) AS down FROM rows)
    SELECT a.player_id, a.season, a.statistic_name, a.category AS statistic_category, b.value,
           TRY_CAST(b.value AS DOUBLE) AS value_numeric,
           CASE b.v WHEN 0 THEN 'next_data' WHEN 1 THEN 'apollo_state' WHEN 2 THEN 'xhr_json' ELSE 'dom_tables' END AS extraction_source,
           concat('2024-01-0', b.run, 'T07:00:00.000000') AS extracted_at
    FROM r a JOIN r b USING (player_id, season, statistic_name) WHERE a.up = 1 AND b.down = 1
    """,
)
def crawl_job_stats(spark, sf):
    stats = spark.read.parquet(_crawl(spark, sf).stats)
    return stats.select(
        "player_id", "season", "statistic_name", "statistic_category", "value", "value_numeric",
        "extraction_source", iso_time("extracted_at").alias("extracted_at"),
    )


@query(
    "crawl_job_export",
    f"""
    WITH {_EVENTS_SQL}
    SELECT CASE v WHEN 0 THEN 'next_data' WHEN 1 THEN 'apollo_state' WHEN 2 THEN 'xhr_json' ELSE 'dom_tables' END AS extraction_source,
           CAST(sum(CASE WHEN v = 0 THEN 3 ELSE 2 END) AS BIGINT) AS n,
           CAST(sum(day) AS BIGINT) AS day_sum
    FROM e WHERE run = 2 AND v < 4 GROUP BY 1
    """,
)
def crawl_job_export(spark, sf):
    path = _crawl(spark, sf).export
    rows = spark.read.schema(
        "extraction_source string, statistic_name string, value_numeric double"
    ).json(path)
    days = F.when(F.col("statistic_name") == "Day", F.col("value_numeric"))
    return rows.groupBy("extraction_source").agg(
        F.count("*").alias("n"), F.sum(days).cast("bigint").alias("day_sum")
    )


@query(
    "crawl_job_rejected",
    """
    SELECT 'No seed names this page' AS reason, count(*) AS n, CAST(sum(-o_orderkey) AS BIGINT) AS id_sum
    FROM orders WHERE o_orderkey % 7 = 0
    """,
)
def crawl_job_rejected(spark, sf):
    path = _crawl(spark, sf).rejected
    rows = spark.read.schema("page_id bigint, url string, reason string").json(path)
    return rows.groupBy("reason").agg(F.count("*").alias("n"), F.sum("page_id").alias("id_sum"))


_DAY = "yyyy-MM-dd"


@query(
    "ingest_resume",
    """
    WITH s AS (
        SELECT o_orderpriority AS source, substr(o_orderpriority, 1, 1) AS d,
               min(CAST(o_orderdate AS DATE)) AS a, max(CAST(o_orderdate AS DATE)) AS b FROM orders GROUP BY 1),
    f AS (SELECT *, CASE d WHEN '2' THEN DATE '1997-01-01' WHEN '3' THEN b ELSE a END AS from_date FROM s),
    g AS (SELECT f.source, count(*) AS games, CAST(sum(o_orderkey % 4) AS BIGINT) AS possessions
          FROM orders JOIN f ON f.source = o_orderpriority
          WHERE CAST(o_orderdate AS DATE) >= from_date AND d IN ('1', '2', '4') GROUP BY 1)
    SELECT f.source, strftime(CASE d WHEN '5' THEN NULL ELSE b END, '%Y-%m-%d') AS last_processed_date,
           CASE d WHEN '5' THEN 'pending' ELSE 'complete' END AS status,
           CAST(CASE d WHEN '4' THEN 1 ELSE 0 END AS BIGINT) AS error_count, CAST(NULL AS VARCHAR) AS last_error,
           CAST(CASE d WHEN '4' THEN 1 ELSE 0 END AS BIGINT) AS windows_failed,
           coalesce(g.games, 0) AS games, coalesce(g.possessions, 0) AS possessions
    FROM f LEFT JOIN g ON g.source = f.source
    """,
)
def ingest_resume(spark, sf):
    """Of five sources one is fresh, one goes on, one is complete, one fails in its second window and goes on in
    a second run, and one is not there. No row is written twice."""
    root, state = scratch_dir(spark, "bronze"), f"{scratch_dir(spark, 'state')}/run"
    orders = table(spark, sf, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("date"))
    rows = (
        orders.groupBy(F.col("o_orderpriority").alias("source"))
        .agg(
            F.date_format(F.min("o_orderdate"), _DAY).alias("initial_start_date"),
            F.date_format(F.max("o_orderdate"), _DAY).alias("initial_end_date"),
        )
        .withColumn("_d", F.substring("source", 1, 1))
    )
    last = F.when(F.col("_d") == "2", "1997-01-01").when(F.col("_d") == "3", F.col("initial_end_date"))
    rows = rows.withColumns(
        {
            "last_processed_date": last,
            "status": F.when(F.col("_d") == "2", "in_progress").when(F.col("_d") == "3", "complete").otherwise("pending"),
            "last_run_ts": F.lit(None).cast("string"),
            "error_count": F.lit(0),
            "last_error": F.lit(None).cast("string"),
            "initial_ingestion_complete": F.lit(False),
            "last_successful_run": F.lit(None).cast("string"),
        }
    ).drop("_d")
    write_state(state_document(rows), state)
    games = orders.select(
        text("o_orderkey").alias("game_id"), F.col("o_orderdate").alias("game_date"), "o_orderpriority",
        season_of("o_orderdate").alias("season"),
    )

    def games_of(source, fails):
        def load():
            own = games.where(F.col("o_orderpriority") == source).drop("o_orderpriority")
            first = F.lit(start[source]).cast("date")
            broken = F.when(F.col("game_date") >= F.date_add(first, 400), F.raise_error(F.lit("no games today")))
            return own.withColumn("note", broken.cast("string")) if fails else own

        return load

    start = {r["source"]: r["initial_start_date"] for r in rows.collect() if not r["source"].startswith("5")}
    for run_ts in ("20240101_070000", "20240102_070000"):
        fails = run_ts < "20240102"
        run_resumed(
            spark, state, {s: games_of(s, fails and s.startswith("4")) for s in start},
            lambda: nested_games(spark, sf), root, run_ts, days=400,
        )
    after = state_rows(read_state(spark, state))

    events = read_ledger(spark, f"{state}.ledger").where(F.col("event") == FAILED)
    failed = events.groupBy("source").agg(F.count("*").alias("windows_failed"))

    def counted(dataset):
        n = spark.read.schema("game_id string, source string").parquet(f"{root}/{dataset}")
        return n.groupBy("source").agg(F.count("*").alias(dataset))

    return (
        after.join(counted("games"), "source", "left")
        .join(failed, "source", "left")
        .join(counted("possessions"), "source", "left")
        .select(
            "source", "last_processed_date", "status", F.col("error_count").cast("bigint").alias("error_count"),
            "last_error", F.coalesce("windows_failed", F.lit(0)).alias("windows_failed"),
            F.coalesce("games", F.lit(0)).alias("games"),
            F.coalesce("possessions", F.lit(0)).alias("possessions"),
        )
    )
