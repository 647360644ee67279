"""Queries over the column functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from statlake.functions import jsontext, numbers, seasons, urls
from statlake.functions import text as texts
from statlake.operators.extract.entries import HEADER_CELLS
from statlake.operators.normalize import is_valid_stat, normalize_stats
from statlake.queries.registry import cents, pick, query, season_sql, table, text


@query(
    "season_counts",
    f"""
    SELECT {season_sql("o_orderdate")} AS season, count(*) AS n_orders,
           CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS total_cents
    FROM orders GROUP BY 1
    """,
)
def season_counts(spark, sf):
    return (
        table(spark, sf, "orders")
        .groupBy(seasons.season_of("o_orderdate").alias("season"))
        .agg(F.count("*").alias("n_orders"), F.sum(cents("o_totalprice")).alias("total_cents"))
    )


@query(
    "season_normalize",
    """
    SELECT o_orderkey,
           CASE WHEN o_orderkey % 6 < 4
                THEN concat(year(o_orderdate), '-', year(o_orderdate) + 1) END AS season,
           CASE WHEN o_orderkey % 6 = 2 AND year(o_orderdate) % 100 = 99 THEN '1999-1900'
                WHEN o_orderkey % 6 < 4 THEN concat(year(o_orderdate), '-', year(o_orderdate) + 1)
                WHEN o_orderkey % 6 = 4 THEN concat(year(o_orderdate), '-202') END AS strict_season,
           concat(year(o_orderdate), '-', year(o_orderdate) + 1) AS long_season,
           CAST(year(o_orderdate) - 1990 AS VARCHAR) AS season_key,
           strftime(o_orderdate, '%m/%d/%Y') AS provider_date
    FROM orders
    """,
)
def season_normalize(spark, sf):
    year = F.year("o_orderdate")
    short, next_short = (F.lpad(text(y % 100), 2, "0") for y in (year, year + 1))
    spelled = pick(
        F.col("o_orderkey") % 6,
        [
            F.concat_ws("-", text(year), next_short),
            F.concat_ws("-", text(year), text(year + 1)),
            F.concat_ws("-", short, next_short),
            F.concat(F.lit("  "), text(year), F.lit("-"), next_short, F.lit("\t")),
            F.concat(text(year), F.lit("-202")),
            F.concat(F.lit("in "), text(year)),
        ],
    )
    return table(spark, sf, "orders").select(
        "o_orderkey",
        seasons.normalize_season(spelled).alias("season"),
        seasons.normalize_season(spelled, strict=True).alias("strict_season"),
        seasons.long_season(year).alias("long_season"),
        seasons.season_key(year, 1990).alias("season_key"),
        seasons.provider_date(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("provider_date"),
    )


@query(
    "stat_value_normalize",
    """
    SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
           CASE WHEN v IN (3, 6, 7) THEN '00000' WHEN v = 1 THEN q WHEN v = 2 THEN concat(q, '%')
                WHEN v = 4 THEN 'N/A' WHEN v = 5 THEN concat('$', q, ' each') END AS value,
           CASE WHEN v IN (1, 2, 5) THEN CAST(q AS DOUBLE) END AS value_numeric,
           v NOT IN (3, 6, 7) AS is_complete,
           CASE WHEN v IN (1) THEN q WHEN v = 2 THEN concat(q, '%') WHEN v = 3 THEN '-'
                WHEN v = 4 THEN 'N/A' WHEN v = 5 THEN concat('$', q, ' each')
                WHEN v = 6 THEN '' END AS raw_value
    FROM (SELECT *, l_linenumber AS v, CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS q
          FROM lineitem)
    """,
)
def stat_value_normalize(spark, sf):
    q = text(F.col("l_quantity").cast("bigint"))
    raw = pick(
        F.col("l_linenumber") - 1,
        [
            q,
            F.concat(q, F.lit("%")),
            "-",
            "N/A",
            F.concat(F.lit("$"), q, F.lit(" each")),
            "",
            None,
        ],
    )
    rows = table(spark, sf, "lineitem").select(
        "l_orderkey",
        F.col("l_linenumber").cast("bigint").alias("l_linenumber"),
        F.col("l_returnflag").alias("statistic_name"),
        raw.alias("value"),
        F.lit(None).cast("string").alias("percentile"),
        F.lit(None).cast("string").alias("grade"),
    )
    return normalize_stats(rows).select(
        "l_orderkey",
        "l_linenumber",
        "value",
        "value_numeric",
        "is_complete",
        F.col("raw_data.value").alias("raw_value"),
    )


# Grade texts and what they are read as.
GRADE_TEXTS = [
    ("a+", "A+"), (" b- ", "B-"), ("D+ (good)", "D+"), ("A +", "A"), ("AVERAGE", "A"),
    ("BAD", "B"), ("F-", "F"), ("FAIL", "F"), ("E", None), ("—", None), ("N/A", None),
    ("none", None), ("neutral", None), ("", None), (None, None), ("c", "C"),
]
_GRADE_SQL = " ".join(
    f"WHEN {i} THEN '{out}'" for i, (_, out) in enumerate(GRADE_TEXTS) if out is not None
)


@query(
    "grade_normalize",
    f"SELECT p_partkey, CASE p_size % 16 {_GRADE_SQL} END AS grade FROM part",
)
def grade_normalize(spark, sf):
    raw = pick(F.col("p_size") % 16, [g for g, _ in GRADE_TEXTS])
    return table(spark, sf, "part").select("p_partkey", numbers.grade(raw).alias("grade"))


@query(
    "percentile_normalize",
    """
    SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
           CASE v WHEN 2 THEN d / 100.0e0 WHEN 4 THEN 1.0e0 WHEN 5 THEN 0.0e0
                  WHEN 6 THEN NULL WHEN 7 THEN NULL
                  ELSE CASE WHEN d > 1 THEN d / 100.0e0 ELSE CAST(d AS DOUBLE) END END AS percentile,
           CASE v WHEN 1 THEN d / 100.0e0 WHEN 2 THEN d / 100.0e0 / 100.0e0 WHEN 3 THEN d / 100.0e0
                  WHEN 4 THEN 1.5e0 WHEN 5 THEN -0.05e0 END AS over_100
    FROM (SELECT *, l_linenumber AS v, CAST(round(l_discount * 100) AS BIGINT) AS d FROM lineitem)
    """,
)
def percentile_normalize(spark, sf):
    d = F.round(F.col("l_discount") * 100).cast("bigint")
    raw = pick(
        F.col("l_linenumber") - 1,
        [
            F.concat(text(d), F.lit("%")),
            F.concat(F.lit("0."), F.lpad(text(d), 2, "0")),
            text(d),
            "150%",
            "-5",
            "abc",
            None,
        ],
    )
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        F.col("l_linenumber").cast("bigint").alias("l_linenumber"),
        numbers.percentile(raw).alias("percentile"),
        numbers.percentile_over_100(raw).alias("over_100"),
    )


_TITLE = (
    "array_to_string(list_transform(string_split({0}, ' '), "
    "lambda w: concat(upper(w[1]), lower(w[2:]))), ' ')"
)


@query(
    "category_normalize",
    f"""
    SELECT p_partkey,
           CASE p_partkey % 8 WHEN 0 THEN concat('Post Play ', {_TITLE.format("p_type")})
                WHEN 1 THEN 'Post Play' WHEN 2 THEN concat('Three Point ', {_TITLE.format("p_name")})
                WHEN 3 THEN concat('Three Point ', {_TITLE.format("p_name")}) WHEN 4 THEN 'General'
                WHEN 5 THEN 'General' WHEN 6 THEN {_TITLE.format("p_name")}
                ELSE 'Post Play Skills' END AS category
    FROM part
    """,
)
def category_normalize(spark, sf):
    name = F.col("p_name")
    raw = pick(
        F.col("p_partkey") % 8,
        [
            F.concat(F.lit(" post-play  "), F.col("p_type")),
            "POSTPLAY",
            F.concat(F.lit("3pt "), name),
            F.concat(F.lit("3-point   "), F.upper(name)),
            None,
            "  ",
            name,
            "post up skills",
        ],
    )
    return table(spark, sf, "part").select(
        "p_partkey", texts.stat_category(raw).alias("category")
    )


@query(
    "player_name_normalize",
    """
    SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN concat('O''', c_name, ' Jr')
               WHEN 1 THEN NULL WHEN 2 THEN NULL
               WHEN 3 THEN concat('Karl-', c_name, ' 3Rd') ELSE c_name END AS player_name
    FROM customer
    """,
)
def player_name_normalize(spark, sf):
    name = F.col("c_name")
    raw = pick(
        F.col("c_custkey") % 5,
        [
            F.concat(F.lit("  o'"), F.lower(name), F.lit("\t  JR ")),
            " Unknown ",
            "n/a",
            F.concat(F.lit("karl-"), name, F.lit(" 3rd")),
            F.upper(name),
        ],
    )
    return table(spark, sf, "customer").select(
        "c_custkey", texts.player_name(raw).alias("player_name")
    )


@query(
    "valid_stat_filter",
    """
    SELECT p_brand, count(*) AS n_valid,
           CAST(sum(p_partkey) AS BIGINT) AS key_sum,
           count(*) FILTER (WHERE p_partkey % 12 = 5) AS n_category_cells
    FROM part
    WHERE p_partkey % 12 NOT IN (0, 1, 2, 3) AND p_partkey % 7 NOT IN (0, 1, 2)
    GROUP BY p_brand
    """,
)
def valid_stat_filter(spark, sf):
    key = F.col("p_partkey")
    name = pick(
        key % 12,
        ["Statistic", " grade ", "TYPE", None, "Name2", F.lit("Shooting")]
        + [F.col("p_name")] * 6,
    )
    value = pick(key % 7, [None, "-", "  "] + [text("p_size")] * 4)
    rows = table(spark, sf, "part").select("p_brand", "p_partkey", name.alias("n"), value.alias("v"))
    header = F.upper("n").isin(HEADER_CELLS)
    return (
        rows.where(is_valid_stat(F.col("n"), F.col("v")) & ~header)
        .groupBy("p_brand")
        .agg(
            F.count("*").alias("n_valid"),
            F.sum("p_partkey").alias("key_sum"),
            F.count_if(F.col("n") == "Shooting").alias("n_category_cells"),
        )
    )


@query(
    "url_normalize",
    r"""
    SELECT page_id,
           rtrim(regexp_extract(url, '^(https?://[^?#]*)', 1), '/') AS url,
           rtrim(regexp_extract(url, '^(https?://[^?#]*)', 1), '/') AS padded_url,
           regexp_extract(url, '^https?://([^/?#]*)', 1) AS domain,
           concat('https://', rtrim(regexp_extract(url, '^https?://([^?#]*)', 1), '/')) AS bare_url
    FROM pages
    """,
)
def url_normalize(spark, sf):
    url = F.col("url")
    padded = F.concat(F.regexp_extract(url, r"^([^?#]*)", 1), F.lit("//?x=/#/"))
    bare = F.regexp_replace(url, "^https?://", "")
    return table(spark, sf, "pages").select(
        "page_id",
        urls.normalize_url(url).alias("url"),
        urls.normalize_url(padded).alias("padded_url"),
        urls.domain(url).alias("domain"),
        urls.normalize_url(bare).alias("bare_url"),
    )


@query(
    "url_parse",
    r"""
    SELECT page_id, CAST(NULL AS VARCHAR) AS profile_season, FALSE AS is_profile,
           nullif(regexp_extract(url, '/([a-z]{2})/([0-9]+)', 1), '') AS lang,
           nullif(regexp_extract(url, '/([a-z]{2})/([0-9]+)', 2), '') AS number
    FROM pages
    """,
)
def url_parse(spark, sf):
    pattern = r"/(([a-z]{2}))/([0-9]+)"
    return table(spark, sf, "pages").select(
        "page_id",
        urls.parse_profile_url("url")["season"].alias("profile_season"),
        urls.is_profile_url("url").alias("is_profile"),
        urls.url_season("url", pattern).alias("lang"),
        urls.url_player_id("url", pattern).alias("number"),
    )


@query(
    "profile_url_parts",
    """
    SELECT s_suppkey, CASE WHEN s_suppkey % 4 < 3 THEN concat(1990 + s_nationkey, '-', 1991 + s_nationkey) END AS season,
           CASE WHEN s_suppkey % 4 < 3 THEN lower(s_name) END AS slug,
           CASE WHEN s_suppkey % 4 < 3 THEN CAST(s_suppkey AS VARCHAR) END AS player_id,
           s_suppkey % 4 < 3 AS is_profile,
           concat(s_suppkey, '_', 1990 + s_nationkey, '-', 1991 + s_nationkey) AS url_key,
           CASE WHEN s_suppkey % 2 = 0 THEN 'https://stats.example.org/players?season=x&page=3'
                ELSE 'https://stats.example.org/players?page=3' END AS list_url
    FROM supplier
    """,
)
def profile_url_parts(spark, sf):
    key, year = F.col("s_suppkey"), F.lit(1990) + F.col("s_nationkey")
    season = seasons.long_season(year)
    full = urls.build_profile_url(season, F.lower("s_name"), key)
    url = pick(
        key % 4,
        [full, F.concat(full, F.lit("?tab=1#top")), F.concat(full, F.lit("/stats")),
         F.concat(F.lit("https://stats.example.org/player-profiles/1990-91/a/"), text(key))],
    )
    return table(spark, sf, "supplier").select(
        "s_suppkey",
        urls.url_season(url).alias("season"),
        urls.url_slug(url).alias("slug"),
        urls.url_player_id(url).alias("player_id"),
        urls.is_profile_url(url).alias("is_profile"),
        urls.url_key(key, season).alias("url_key"),
        urls.build_list_url(F.when(key % 2 == 0, F.lit("x")), 3).alias("list_url"),
    )


@query(
    "settings_and_times",
    """
    SELECT event_id,
           CAST(CASE WHEN event_id % 3 = 0 THEN event_id % 1000 WHEN event_id % 3 = 1 THEN 7 ELSE 7 END
                AS BIGINT) AS int_setting,
           CASE WHEN event_id % 3 = 2 THEN 0.5e0 ELSE CAST(event_id % 1000 AS DOUBLE) END AS float_setting,
           strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS iso_time,
           CASE WHEN event_id % 2 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')
                ELSE '2024-02-03T04:05:06.000000' END AS stamped,
           CASE WHEN event_id % 4 < 2 THEN NULL ELSE event_type END AS cell
    FROM events
    """,
)
def settings_and_times(spark, sf):
    key = F.col("event_id")
    whole = text(key % 1000)
    raw = pick(
        key % 3, [F.concat(F.lit(" "), whole, F.lit(" ")), F.concat(whole, F.lit(".0")), "x"]
    )
    stamp = F.lit("2024-02-03 04:05:06").cast("timestamp")
    seen = F.when(key % 2 == 0, F.col("ts").cast("timestamp"))
    cell = pick(key % 4, [" ", "N/A", F.concat(F.lit(" "), "event_type"), F.col("event_type")])
    return table(spark, sf, "events").select(
        "event_id",
        texts.setting_int(raw, 7).cast("bigint").alias("int_setting"),
        texts.setting_float(raw, 0.5).alias("float_setting"),
        texts.iso_time("ts").alias("iso_time"),
        texts.iso_time(F.coalesce(seen, stamp)).alias("stamped"),
        texts.cell_text(cell).alias("cell"),
    )


@query(
    "json_bodies",
    """
    SELECT event_type, count(*) AS n,
           count(*) FILTER (WHERE event_id % 6 <> 5) AS n_json,
           count(*) FILTER (WHERE event_id % 6 IN (0, 4)) AS n_filled
    FROM events GROUP BY event_type
    """,
)
def json_bodies(spark, sf):
    props = F.col("props")
    body = pick(
        F.col("event_id") % 6,
        [props, "{}", " [ ] ", "0", F.concat(F.lit("["), props, F.lit("]")),
         F.concat(props, F.lit("}"))],
    )
    rows = table(spark, sf, "events").select("event_type", body.alias("body"))
    return rows.groupBy("event_type").agg(
        F.count("*").alias("n"),
        F.count_if(jsontext.is_json("body")).alias("n_json"),
        F.count(jsontext.json_document("body")).alias("n_filled"),
    )
