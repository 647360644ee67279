"""Queries over keyed operators: upserts, dedup, joins, ordered work."""

from __future__ import annotations

from pyspark.sql import functions as F

from statlake.functions import seasons, urls
from statlake.operators import joins, upsert
from statlake.operators.breaker import rows_before_stop
from statlake.operators.ordered import (
    carry_forward,
    first_rows_per_key,
    with_previous,
)
from statlake.queries.registry import cents, pick, query, season_sql, table, text

BLOCK_ROWS = 25  # so that the users of a test table have several blocks


@query(
    "stats_partial_upsert",
    f"""
    WITH e AS (
        SELECT *, CASE WHEN event_id % 11 > 0 THEN CAST(user_id AS VARCHAR) END AS player_id,
               {season_sql("ts")} AS season FROM events),
    r AS (
        SELECT *, row_number() OVER (PARTITION BY player_id, season, event_type ORDER BY ts, event_id) AS up,
               row_number() OVER (PARTITION BY player_id, season, event_type ORDER BY ts DESC, event_id DESC) AS down
        FROM e WHERE player_id IS NOT NULL)
    SELECT a.player_id, a.season, a.event_type AS statistic_name, a.props AS statistic_category,
           concat('slug-', a.event_id) AS player_slug,
           CASE WHEN b.event_id % 7 > 0 THEN concat(b.event_id, '%') END AS value,
           CASE WHEN b.event_id % 7 > 0 THEN CAST(b.event_id AS DOUBLE) END AS value_numeric,
           concat('src', b.event_id % 3) AS extraction_source
    FROM r a JOIN r b USING (player_id, season, event_type) WHERE a.up = 1 AND b.down = 1
    """,
)
def stats_partial_upsert(spark, sf):
    key = F.col("event_id")
    value = F.when(key % 7 > 0, key)
    nothing = F.lit(None).cast("string")
    rows = table(spark, sf, "events").select(
        F.when(key % 11 > 0, text("user_id")).alias("player_id"),
        seasons.season_of("ts").alias("season"),
        F.col("event_type").alias("statistic_name"),
        F.concat(F.lit("name-"), "event_type").alias("player_name"),
        F.concat(F.lit("slug-"), key).alias("player_slug"),
        F.col("props").alias("statistic_category"),
        nothing.alias("page_url"),
        F.lit(True).alias("is_complete"),
        F.concat(value, F.lit("%")).alias("value"),
        value.cast("double").alias("value_numeric"),
        nothing.alias("percentile"),
        F.lit(None).cast("double").alias("percentile_numeric"),
        nothing.alias("grade"),
        F.concat(F.lit("src"), key % 3).alias("extraction_source"),
        F.col("ts").alias("extracted_at"),
        "event_id",
    )
    return upsert.upsert_stats(rows, ["extracted_at", "event_id"]).select(
        "player_id", "season", "statistic_name", "statistic_category", "player_slug", "value",
        "value_numeric", "extraction_source",
    )


@query(
    "upsert_into_table",
    """
    WITH old AS (SELECT l_partkey, max(l_suppkey) AS first_supp, min(l_quantity) AS qty
                 FROM lineitem WHERE l_linestatus = 'F' GROUP BY l_partkey),
    r AS (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_suppkey, l_quantity) AS up,
                 row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_suppkey DESC, l_quantity DESC) AS down
          FROM lineitem WHERE l_linestatus = 'O')
    SELECT coalesce(old.l_partkey, a.l_partkey) AS l_partkey,
           coalesce(old.first_supp, a.l_suppkey) AS first_supp,
           CASE WHEN b.l_partkey IS NULL THEN old.qty ELSE b.l_quantity END AS qty
    FROM old FULL JOIN (SELECT * FROM r WHERE up = 1) a ON old.l_partkey = a.l_partkey
    LEFT JOIN (SELECT * FROM r WHERE down = 1) b ON a.l_partkey = b.l_partkey
    """,
)
def upsert_into_table(spark, sf):
    items = table(spark, sf, "lineitem")
    current = (
        items.where(F.col("l_linestatus") == "F")
        .groupBy("l_partkey")
        .agg(F.max("l_suppkey").alias("first_supp"), F.min("l_quantity").alias("qty"))
    )
    updates = items.where(F.col("l_linestatus") == "O").select(
        "l_partkey", F.col("l_suppkey").alias("first_supp"), F.col("l_quantity").alias("qty"),
        "l_shipdate", "l_orderkey", "l_linenumber",
    )
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "first_supp", "qty"]
    return upsert.upsert_into(current, updates, ["l_partkey"], order, ["first_supp"], ["qty"])


@query(
    "key_validity",
    """
    SELECT CASE WHEN o_orderkey % 5 IN (0, 1) THEN 'rejected' ELSE 'kept' END AS part,
           count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS key_sum
    FROM orders GROUP BY 1
    """,
)
def key_validity(spark, sf):
    ident = pick(F.col("o_orderkey") % 5, [None, ""] + [text("o_custkey")] * 3)
    rows = table(spark, sf, "orders").select(
        "o_orderkey", ident.alias("player_id"), seasons.season_of("o_orderdate").alias("season")
    )
    kept, rejected = upsert.split_by_key(rows, ["player_id", "season"])
    both = kept.withColumn("part", F.lit("kept")).unionByName(
        rejected.withColumn("part", F.lit("rejected"))
    )
    return both.groupBy("part").agg(
        F.count("*").alias("n"), F.sum("o_orderkey").alias("key_sum")
    )


@query(
    "dedup_keep_first",
    """
    SELECT l_orderkey, l_partkey, l_suppkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
           strftime(l_shipdate, '%Y-%m-%d') AS shipped
    FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey
          ORDER BY l_shipdate, l_partkey, l_suppkey, l_linenumber) AS rn FROM lineitem) WHERE rn = 1
    """,
)
def dedup_keep_first(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", F.col("l_linenumber").cast("bigint"), "l_shipdate"
    )
    first = upsert.keep_first(
        rows, ["l_orderkey"], ["l_shipdate", "l_partkey", "l_suppkey", "l_linenumber"]
    )
    return first.withColumn("shipped", F.date_format("l_shipdate", "yyyy-MM-dd")).drop("l_shipdate")


@query(
    "dedup_source_priority",
    """
    SELECT doc_id, lang, n_chars, source FROM (
        SELECT *, row_number() OVER (PARTITION BY lang, n_chars ORDER BY
               CASE source WHEN 'src2' THEN 0 WHEN 'src0' THEN 1 WHEN 'src1' THEN 2 ELSE 3 END, doc_id) AS rn
        FROM documents) WHERE rn = 1
    """,
)
def dedup_source_priority(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang", "n_chars", "source")
    return upsert.keep_best_source(
        docs, ["lang", "n_chars"], "source", ["src2", "src0", "src1"], ["doc_id"]
    )


@query(
    "id_list_clean",
    """
    SELECT CAST(c_custkey // 3 AS VARCHAR) AS id, min(c_custkey) AS pos FROM customer
    WHERE c_custkey % 9 NOT IN (3, 7) GROUP BY 1
    """,
)
def id_list_clean(spark, sf):
    key = F.col("c_custkey")
    ident = text(F.floor(key / 3))
    raw = pick(
        key % 9,
        [ident, F.concat(F.lit(" "), ident), F.concat(ident, F.lit("\t")), "  "]
        + [ident] * 3
        + [None, ident],
    )
    ids = table(spark, sf, "customer").select(raw.alias("id"), key.alias("pos"))
    return upsert.clean_ids(ids, "id", "pos")


@query(
    "union_and_cast",
    """
    SELECT 'c' AS kind, c_custkey AS id, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_acctbal END AS balance,
           c_mktsegment AS segment FROM customer
    UNION ALL SELECT 's', s_suppkey, s_acctbal, NULL FROM supplier
    """,
)
def union_and_cast(spark, sf):
    customers = table(spark, sf, "customer").select(
        F.lit("c").alias("KIND"),
        F.col("c_custkey").alias("ID"),
        F.when(F.col("c_custkey") % 3 == 0, "bad").otherwise(text("c_acctbal")).alias("Balance"),
        F.col("c_mktsegment").alias("Segment"),
    )
    suppliers = table(spark, sf, "supplier").select(
        F.lit("s").alias("kind"), F.col("s_suppkey").alias("id"), text("s_acctbal").alias("balance")
    )
    both = upsert.union_all([upsert.lower_columns(customers), suppliers])
    return upsert.cast_numbers(both, ["balance", "absent"])


@query(
    "skip_completed",
    f"""
    WITH s AS (SELECT *, CASE WHEN o_orderkey % 13 > 1 THEN CAST(o_custkey AS VARCHAR)
                              WHEN o_orderkey % 13 = 1 THEN '' END AS player_id,
                      {season_sql("o_orderdate")} AS season FROM orders)
    SELECT o_orderkey, player_id, season FROM s
    WHERE NOT EXISTS (SELECT 1 FROM s d WHERE d.o_orderstatus = 'F' AND d.player_id <> ''
                      AND d.player_id = s.player_id AND d.season = s.season)
    """,
)
def skip_completed(spark, sf):
    ident = (
        F.when(F.col("o_orderkey") % 13 > 1, text("o_custkey"))
        .when(F.col("o_orderkey") % 13 == 1, F.lit(""))
    )
    orders = table(spark, sf, "orders").select(
        "o_orderkey",
        ident.alias("player_id"),
        seasons.season_of("o_orderdate").alias("season"),
        F.when(F.col("o_orderstatus") == "F", "success").otherwise("failed").alias("status"),
    )
    return joins.skip_completed(orders.drop("status"), orders.where(F.col("player_id") != ""))


@query(
    "entity_season_grid",
    """
    SELECT s_suppkey AS player_id, CAST(y - 2013 AS VARCHAR) AS season_key,
           concat(y, '-', y + 1) AS season,
           concat('https://stats.example.org/player-profiles/', y, '-', y + 1, '/', s_name, '/', s_suppkey) AS url,
           concat(s_suppkey, '_', y, '-', y + 1) AS url_key
    FROM supplier, (SELECT unnest(generate_series(2013, 2026)) AS y)
    """,
)
def entity_season_grid(spark, sf):
    players = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("player_id"), F.col("s_name").alias("player_slug")
    )
    return joins.entity_seasons(players).select(
        "player_id", "season_key", "season", "url",
        urls.url_key("player_id", "season").alias("url_key"),
    )


@query(
    "semi_load",
    f"""
    SELECT l_returnflag, count(*) AS n_rows,
           CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS cents
    FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE {season_sql("o_orderdate")} = '1997-98')
    GROUP BY 1
    """,
)
def semi_load(spark, sf):
    games = table(spark, sf, "orders").where(seasons.season_of("o_orderdate") == "1997-98")
    rows = joins.only_listed(table(spark, sf, "lineitem"), games.withColumnRenamed("o_orderkey", "l_orderkey"), "l_orderkey")
    return rows.groupBy("l_returnflag").agg(
        F.count("*").alias("n_rows"), F.sum(cents("l_extendedprice")).alias("cents")
    )


@query(
    "failure_breaker",
    """
    WITH e AS (
        SELECT user_id, event_id, ts, event_type = 'error' AS bad, event_type = 'signup' AS skip,
               sum(CASE WHEN event_type NOT IN ('error', 'signup') THEN 1 ELSE 0 END)
                   OVER (PARTITION BY user_id ORDER BY ts, event_id) AS island FROM events),
    f AS (SELECT *, sum(CASE WHEN bad THEN 1 ELSE 0 END)
                    OVER (PARTITION BY user_id, island ORDER BY ts, event_id) AS run FROM e),
    s AS (SELECT *, coalesce(max(CASE WHEN bad AND run >= 3 THEN 1 ELSE 0 END)
                    OVER (PARTITION BY user_id ORDER BY ts, event_id), 0) AS stopped FROM f)
    SELECT user_id, event_id FROM s WHERE NOT bad AND NOT skip AND stopped = 0
    """,
)
def failure_breaker(spark, sf):
    status = (
        F.when(F.col("event_type") == "error", "fail")
        .when(F.col("event_type") == "signup", "empty")
        .otherwise("ok")
    )
    rows = table(spark, sf, "events").select("user_id", "event_id", "ts", status.alias("status"))
    kept = rows_before_stop(
        rows, ["user_id"], ["ts", "event_id"], BLOCK_ROWS, max_failures=3
    )
    return kept.select("user_id", "event_id")


@query(
    "keep_last_n",
    """
    SELECT user_id, event_id FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
        FROM events) WHERE rn <= 10
    """,
)
def keep_last_n(spark, sf):
    rows = table(spark, sf, "events").select("user_id", "event_id", "ts")
    last = first_rows_per_key(rows, ["user_id"], ["ts", "event_id"], 10, descending=True)
    return last.select("user_id", "event_id")


@query(
    "category_carry_forward",
    """
    SELECT event_id, coalesce(last_value(CASE WHEN event_type = 'signup' THEN props END IGNORE NULLS)
               OVER (PARTITION BY user_id ORDER BY ts, event_id), 'General') AS category
    FROM events
    """,
)
def category_carry_forward(spark, sf):
    rows = table(spark, sf, "events").select(
        "user_id", "event_id", "ts",
        F.when(F.col("event_type") == "signup", F.col("props")).alias("category"),
    )
    filled = carry_forward(
        rows, ["user_id"], ["ts", "event_id"], BLOCK_ROWS, "category", "General"
    )
    return filled.select("event_id", "category")


@query(
    "previous_row",
    """
    SELECT event_id, lag(CASE WHEN event_type <> 'view' THEN event_type END)
               OVER (PARTITION BY user_id ORDER BY event_id) AS previous_type,
           lag(value) OVER (PARTITION BY user_id ORDER BY event_id) AS previous_value
    FROM events
    """,
)
def previous_row(spark, sf):
    rows = table(spark, sf, "events").select(
        "user_id", "event_id", "value",
        F.when(F.col("event_type") != "view", F.col("event_type")).alias("kind"),
    )
    out = with_previous(
        rows, ["user_id"], ["event_id"], BLOCK_ROWS,
        {"previous_type": "kind", "previous_value": "value"},
    )
    return out.select("event_id", "previous_type", "previous_value")
