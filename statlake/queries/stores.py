"""Queries that write somewhere below the shared folder and read it back."""

from __future__ import annotations

from pyspark.sql import functions as F

from statlake.functions import seasons
from statlake.plans.windows import seasons_between
from statlake.queries.extraction import order_pages, order_responses
from statlake.queries.registry import cents, pick, query, season_sql, table, text
from statlake.session import scratch_dir
from statlake.sinks import tables as sinks
from statlake.sources import landed
from statlake.sources import state as states
from statlake.sources.seeds import read_seeds


@query(
    "bronze_roundtrip",
    """
    SELECT o_orderkey, o_orderstatus, 'new' AS run, CAST(round(o_totalprice * 100) AS BIGINT) AS cents,
           (SELECT count(*) FROM orders) AS rows_written FROM orders
    """,
)
def bronze_roundtrip(spark, sf):
    """A run, its repetition, a dry run and an empty run: the rows are there once."""
    root = scratch_dir(spark, "bronze")
    rows = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("O_ORDERKEY"), "o_orderstatus", cents("o_totalprice").alias("cents")
    )
    sinks.write_bronze(rows, root, "games", "20240101_070000")
    again = sinks.write_bronze(rows, root, "games", "20240101_070000")
    sinks.write_bronze(rows, root, "games", "20240102_070000", dry_run=True)
    sinks.write_bronze(rows.where("FALSE"), root, "games", "20240103_070000")
    back = landed.read(spark, "games", f"{root}/games")
    return back.select(
        "o_orderkey", "o_orderstatus", "cents",
        F.when(F.col("run_ts") == "20240101_070000", "new").otherwise("other").alias("run"),
        F.lit(again.rows).cast("bigint").alias("rows_written"),
    )


@query(
    "jsonl_roundtrip",
    "SELECT doc_id, lang, CASE WHEN doc_id % 3 > 0 THEN source END AS source, length(text) AS n_text, md5(text) AS hash FROM documents",
)
def jsonl_roundtrip(spark, sf):
    path = scratch_dir(spark, "jsonl")
    docs = table(spark, sf, "documents").select(
        "doc_id", "lang", F.when(F.col("doc_id") % 3 > 0, F.col("source")).alias("source"), "text"
    )
    sinks.write(docs, "feed", path)
    back = spark.read.schema("doc_id bigint, lang string, source string, text string").json(path)
    return back.select(
        "doc_id", "lang", "source", F.length("text").cast("bigint").alias("n_text"),
        F.md5("text").alias("hash"),
    )


@query(
    "silver_partitioned",
    f"""
    SELECT season, count(*) AS n, CAST(sum(points) AS BIGINT) AS points FROM (
        SELECT {season_sql("l_shipdate")} AS season,
               CASE WHEN year(l_shipdate) = 1998 THEN 1 ELSE CAST(l_quantity AS BIGINT) END AS points FROM lineitem)
    GROUP BY 1
    """,
)
def silver_partitioned(spark, sf):
    """A first load, then a rewrite of the seasons with rows of 1998 alone."""
    path = scratch_dir(spark, "silver")
    base = table(spark, sf, "lineitem").select(
        text("l_orderkey").alias("game_id"),
        text("l_partkey").alias("player_id"),
        F.col("l_quantity").cast("int").alias("points"),
        "l_shipdate",
        seasons.season_of("l_shipdate").alias("season"),
    )
    columns = ["game_id", "player_id", "points", "season"]
    sinks.write_silver(base.select(*columns), path)
    touched = F.array_contains(
        seasons_between(F.lit("1998-01-01"), F.lit("1998-12-31")), F.col("season")
    )
    ones = F.when(F.year("l_shipdate") == 1998, 1).otherwise(F.col("points"))
    sinks.write_silver(
        base.where(touched).withColumn("points", ones).select(*columns), path, only_touched=True
    )
    stored = spark.read.schema("game_id string, player_id string, points int, season string").parquet(path)
    return stored.groupBy("season").agg(
        F.count("*").alias("n"), F.sum("points").cast("bigint").alias("points")
    )


@query(
    "state_roundtrip",
    """
    WITH s AS (SELECT o_orderpriority AS source, strftime(min(o_orderdate), '%Y-%m-%d') AS a,
                      strftime(max(o_orderdate), '%Y-%m-%d') AS b,
                      strftime(max(o_orderdate) FILTER (WHERE o_orderstatus = 'F'), '%Y-%m-%d') AS f,
                      substr(o_orderpriority, 1, 1) AS d FROM orders GROUP BY o_orderpriority)
    SELECT source, a AS initial_start_date, b AS initial_end_date,
           CASE WHEN d IN ('1', '2') THEN b ELSE f END AS last_processed_date,
           CASE WHEN d IN ('1', '2') THEN 'complete' ELSE 'in_progress' END AS status,
           CASE WHEN d = '5' THEN NULL ELSE '2024-01-02' END AS last_run_ts,
           CAST(CASE WHEN d IN ('3', '4') THEN 1 ELSE 0 END AS BIGINT) AS error_count,
           CASE WHEN d IN ('3', '4') THEN 'limit' END AS last_error, FALSE AS initial_ingestion_complete
    FROM s
    """,
)
def state_roundtrip(spark, sf):
    """No state, then a saved one, then the one after a run in which two sources fail."""
    path = scratch_dir(spark, "state")
    day = "yyyy-MM-dd"
    done = F.max(F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate")))
    rows = (
        table(spark, sf, "orders")
        .groupBy("o_orderpriority")
        .agg(
            F.date_format(F.min("o_orderdate"), day).alias("initial_start_date"),
            F.date_format(F.max("o_orderdate"), day).alias("initial_end_date"),
            F.date_format(done, day).alias("last_processed_date"),
        )
        .withColumnRenamed("o_orderpriority", "source")
        .withColumns(
            {
                "status": F.lit("in_progress"),
                "last_run_ts": F.lit(None).cast("string"),
                "error_count": F.lit(0),
                "last_error": F.lit(None).cast("string"),
                "initial_ingestion_complete": F.lit(False),
                "last_successful_run": F.lit(None).cast("string"),
            }
        )
    )
    none = states.state_rows(states.read_state(spark, path))
    sinks.write_state(states.state_document(rows.unionByName(none.select(*rows.columns))), path)
    loaded = states.state_rows(states.read_state(spark, path))
    digit = F.substring("source", 1, 1)
    results = loaded.where(digit != "5").select(
        "source",
        F.when(digit.isin("1", "2"), F.col("initial_end_date")).alias("processed_to"),
        F.lit("2024-01-02").alias("run_ts"),
        F.when(~digit.isin("1", "2"), "limit").alias("error"),
    )
    after = f"{path}-after"
    sinks.write_state(states.state_document(states.source_progress(loaded, results)), after)
    out = states.state_rows(states.read_state(spark, after))
    return out.select(
        "source", "initial_start_date", "initial_end_date", "last_processed_date", "status",
        "last_run_ts", F.col("error_count").cast("bigint").alias("error_count"), "last_error",
        "initial_ingestion_complete",
    )


@query(
    "payload_roundtrip",
    """
    SELECT 'html' AS source, count(*) AS n FROM orders
    UNION ALL SELECT 'next_data', count(*) FROM orders WHERE o_orderkey % 5 = 0
    UNION ALL SELECT 'apollo_state', count(*) FROM orders WHERE o_orderkey % 5 < 2
    UNION ALL SELECT 'xhr_json', 3 * count(*) FROM orders
    """,
)
def payload_roundtrip(spark, sf):
    from statlake.operators.extract.choose import raw_payloads

    path = scratch_dir(spark, "payloads")
    sinks.write(raw_payloads(order_pages(spark, sf), order_responses(spark, sf)), "payloads", path)
    return spark.read.parquet(path).groupBy("source").agg(F.count("payload").alias("n"))


@query(
    "pages_and_responses",
    """
    SELECT page_id, length(html) AS n_html, CAST(CASE WHEN page_id % 2 = 0 THEN 1 ELSE 0 END AS BIGINT) AS n_kept
    FROM pages
    """,
)
def pages_and_responses(spark, sf):
    """Landed pages, and landed responses of which those with JSON are kept."""
    path = scratch_dir(spark, "responses")
    source = landed.read(spark, "pages", f"{sf}/pages.parquet")
    source.select(
        "page_id",
        F.lit(1).alias("seq"),
        F.concat(F.lit("https://h/api/"), "page_id").alias("url"),
        F.lit(200).alias("status"),
        F.lit("application/json").alias("content_type"),
        F.when(F.col("page_id") % 2 == 0, F.to_json(F.struct("html"))).otherwise(F.col("html")).alias("body"),
    ).write.json(path)
    kept = landed.read(spark, "responses", path).groupBy("page_id").agg(F.count("*").alias("n_kept"))
    return (
        source.select("page_id", F.length("html").cast("bigint").alias("n_html"))
        .join(kept, "page_id", "left")
        .na.fill(0, ["n_kept"])
    )


@query(
    "seed_scan",
    """
    SELECT CASE WHEN s_suppkey % 4 < 2 THEN concat('https://stats.example.org/player-profiles/2024-2025/', s_name, '/', s_suppkey)
                ELSE concat('https://h/x/', s_suppkey) END AS url,
           CASE s_suppkey % 4 WHEN 3 THEN NULL ELSE CAST(s_suppkey AS VARCHAR) END AS player_id,
           CASE s_suppkey % 4 WHEN 3 THEN NULL ELSE s_name END AS player_slug,
           CASE WHEN s_suppkey % 4 < 2 THEN '2024-2025' END AS season
    FROM supplier
    """,
)
def seed_scan(spark, sf):
    """Seeds as URL lines, quoted and JSON lines, comments, blanks, and an array; and a place without."""
    path = scratch_dir(spark, "seeds")
    key = F.col("s_suppkey")
    profile = F.concat(
        F.lit("https://stats.example.org/player-profiles/2024-2025/"), "s_name", F.lit("/"), key
    )
    other = F.concat(F.lit("https://h/x/"), key)
    as_json = F.to_json(
        F.struct(other.alias("url"), text(key).alias("player_id"), F.col("s_name").alias("player_slug"))
    )
    quoted = F.concat(F.lit(' "'), profile, F.lit('" '))
    line = pick(key % 4, [profile, quoted, as_json, other])
    suppliers = table(spark, sf, "supplier")
    lines = suppliers.where(key % 3 > 0).select(
        F.explode(F.array(line, F.lit(""), F.concat(F.lit("# "), "s_name"))).alias("value")
    )
    lines.write.text(path)
    # One file more, a JSON array of URLs and objects.
    entry = F.when(as_json == line, as_json).otherwise(F.concat(F.lit('"'), F.trim(F.replace(line, F.lit('"'))), F.lit('"')))
    entries = suppliers.where(key % 3 == 0).agg(F.array_join(F.collect_list(entry), ",\n").alias("value"))
    entries.select(F.concat(F.lit("[\n"), "value", F.lit("]"))).write.mode("append").text(path)
    missing = read_seeds(spark, f"{path}-missing")
    return read_seeds(spark, path).unionByName(missing)


@query(
    "dimension_scan",
    "SELECT n_nationkey, n_name, CAST(count(c_custkey) AS BIGINT) AS n FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY 1, 2",
)
def dimension_scan(spark, sf):
    path = scratch_dir(spark, "teams")
    table(spark, sf, "nation").select(
        F.col("n_nationkey").cast("int").alias("N_NationKey"), F.col("n_name").alias("N_NAME")
    ).write.json(path)
    teams = landed.read(spark, "dimension", path)
    customers = table(spark, sf, "customer").groupBy("c_nationkey").agg(F.count("*").alias("n"))
    return (
        teams.join(customers, F.col("n_nationkey") == F.col("c_nationkey"), "left")
        .select(F.col("n_nationkey").cast("int").alias("n_nationkey"), "n_name", "n")
        .na.fill(0, ["n"])
    )
