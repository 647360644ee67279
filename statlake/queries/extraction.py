"""Queries over page and response extraction.

The pages are made row by row from ``orders`` and ``part``: each row becomes the HTML or JSON text
that a site would show for it, so the SQL side is the plain relational answer.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from statlake.functions.seasons import long_season
from statlake.functions.text import iso_time
from statlake.functions.urls import build_profile_url
from statlake.functions.jsontext import json_document
from statlake.operators.extract import captured, choose
from statlake.operators.extract.entries import explode_stats
from statlake.operators.extract.scripts import (
    cache_state_text,
    extract_cache_state,
    extract_page_data,
    page_data_text,
)
from statlake.operators.extract.tables import extract_tables, page_tables
from statlake.operators.normalize import explode_profiles, normalize_profiles, normalize_stats
from statlake.queries.registry import PARTS, cents, pick, query, table, text


def _orders(spark, sf):
    return table(spark, sf, "orders").repartition(PARTS, "o_orderkey")


def _join(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _price() -> Column:
    return cents("o_totalprice")


def _share() -> Column:
    return F.col("o_orderkey") % 101


def _page_data() -> Column:
    return _join(
        '<script>var x="</p>";</script><script id="__NEXT_DATA__" type="application/json">',
        '{"props":{"pageProps":{"player":{"id":', F.col("o_custkey"), ',"name":"Cust ', F.col("o_custkey"),
        '"},"season":"', long_season(F.year("o_orderdate")), '","stats":{"Shooting":[{"name":"Price","value":"',
        _price(), '","percentile":"', _share(), '%","grade":"', F.substring("o_orderstatus", 1, 1),
        '"},{"label":"Day","score":', F.dayofmonth("o_orderdate"), '},{"value":1}],"Defense":[{"stat_name":"Status",'
        '"value":"', F.col("o_orderstatus"), '"}],"note":"none"}}}}</script>',
    )


def _cache_state() -> Column:
    return _join(
        '<script>go();</script><script>window.__APOLLO_STATE__ = {"Player:', F.col("o_custkey"),
        '":{"name":"Cust ', F.col("o_custkey"), '"},"ROOT":[1],"Stat:1":{"label":"Price","value":', _price(),
        ',"type":"Shooting"},"q":{"__typename":"PlayerStat","metric":"Day","stat_value":"',
        F.dayofmonth("o_orderdate"), '"}};</script>',
    )


def _table() -> Column:
    return _join(
        '<h1 class="player-name">Cust ', F.col("o_custkey"), '</h1><h2>Totals</h2><div class="stat-table-wrapper">'
        "<table><thead><tr><th>Statistic</th><th>Value</th></tr></thead><tbody><tr><td>Price</td><td> ", _price(),
        " </td><td>", _share(), "%</td><td>—</td></tr><tr><td>Statistic</td><td>Value</td></tr><tr><td>Day</td><td>",
        F.dayofmonth("o_orderdate"), "</td></tr></tbody></table></div>",
    )


def _url() -> Column:
    slug = _join("cust-", F.col("o_custkey"))
    return build_profile_url(long_season(F.year("o_orderdate")), slug, "o_custkey")


def order_pages(spark, sf):
    """Pages with the sources that ``o_orderkey % 5`` gives them: all, cache state and table,
    captured and table, table, none."""
    which = F.col("o_orderkey") % 5
    body = pick(
        which,
        [_join(_page_data(), _cache_state(), _table()), _join(_cache_state(), _table()), _table(),
         _table(), F.lit("<p>nothing here</p>")],
    )
    return _orders(spark, sf).select(
        F.col("o_orderkey").alias("page_id"),
        _url().alias("url"),
        _join("<html><body>", body, "</body></html>").alias("html"),
    )


def order_responses(spark, sf, everywhere: bool = False):
    """Three captured responses for each page: no stats, two, and two again. Unless
    ``everywhere``, only the pages with ``o_orderkey % 5 = 2`` have stats in theirs."""
    here = F.lit(everywhere) | (F.col("o_orderkey") % 5 == 2)
    empty = F.lit('{"stats":[]}')

    def body(name: str) -> Column:
        return _join(
            '{"playerId":', F.col("o_custkey"), ',"data":{"player":{"name":"Cust ', F.col("o_custkey"),
            '","stats":[{"name":"', name, '","value":', _price(), ',"rating":"b"},{"statName":"Day","score":',
            F.dayofmonth("o_orderdate"), "},{}]}}}",
        )

    responses = F.array(
        *[
            F.struct(F.lit(i + 1).alias("seq"), F.when(here, b).otherwise(empty).alias("body"))
            for i, b in enumerate([empty, body("Price"), body("Late")])
        ]
    )
    return _orders(spark, sf).select(
        F.col("o_orderkey").alias("page_id"), F.explode(responses).alias("_r")
    ).select("page_id", "_r.seq", _join("https://h/api/", F.col("page_id")).alias("url"), "_r.body")


def _flat(df):
    return (
        explode_stats(df, ["page_id", "x.player_id", "x.player_name", "x.season"], "x.stats")
        .select("page_id", "player_id", "player_name", "season", "_stat.*")
    )


_PRICE = "CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS VARCHAR)"
_DAY = "CAST(day(o_orderdate) AS VARCHAR)"
_SEASON = "concat(year(o_orderdate), '-', year(o_orderdate) + 1)"
_CUST = "CAST(o_custkey AS VARCHAR)"
_NAME = "concat('Cust ', o_custkey)"
_SHARE = "concat(o_orderkey % 101, '%')"


def _stats_sql(where, rows, columns="player_id, player_name, season"):
    head = {
        "player_id": f"{_CUST} AS player_id",
        "player_name": f"{_NAME} AS player_name",
        "season": f"{_SEASON} AS season",
    }
    return " UNION ALL ".join(
        f"SELECT o_orderkey AS page_id, {', '.join(head.get(c, c) for c in columns.split(', '))}, "
        f"'{name}' AS statistic_name, {value} AS value, {pct} AS percentile, {grade} AS grade, "
        f"'{category}' AS statistic_category FROM orders WHERE {where}"
        for name, value, pct, grade, category in rows
    )


_PAGE_ROWS = [
    ("Price", _PRICE, _SHARE, "substr(o_orderstatus, 1, 1)", "Shooting"),
    ("Day", _DAY, "CAST(NULL AS VARCHAR)", "CAST(NULL AS VARCHAR)", "Shooting"),
    ("Status", "o_orderstatus", "CAST(NULL AS VARCHAR)", "CAST(NULL AS VARCHAR)", "Defense"),
]
_CACHE_ROWS = [
    ("Price", _PRICE, "CAST(NULL AS VARCHAR)", "CAST(NULL AS VARCHAR)", "Shooting"),
    ("Day", _DAY, "CAST(NULL AS VARCHAR)", "CAST(NULL AS VARCHAR)", "General"),
]
_CAPTURED_ROWS = [
    ("Price", _PRICE, "CAST(NULL AS VARCHAR)", "'b'", "General"),
    ("Day", _DAY, "CAST(NULL AS VARCHAR)", "CAST(NULL AS VARCHAR)", "General"),
]
_TABLE_ROWS = [
    ("Price", _PRICE, _SHARE, "CAST(NULL AS VARCHAR)", "Totals"),
    ("Day", _DAY, "CAST(NULL AS VARCHAR)", "CAST(NULL AS VARCHAR)", "Totals"),
]


@query("extract_page_data", _stats_sql("TRUE", _PAGE_ROWS))
def extract_page_data_query(spark, sf):
    pages = _orders(spark, sf).select(
        F.col("o_orderkey").alias("page_id"), _page_data().alias("html")
    )
    docs = pages.select("page_id", page_data_text("html").alias("doc"))
    return _flat(docs.select("page_id", extract_page_data("doc").alias("x")))


@query(
    "extract_cache_state",
    _stats_sql("TRUE", _CACHE_ROWS, "player_id, player_name, CAST(NULL AS VARCHAR) AS season"),
)
def extract_cache_state_query(spark, sf):
    pages = _orders(spark, sf).select(
        F.col("o_orderkey").alias("page_id"), _cache_state().alias("html")
    )
    docs = pages.select("page_id", cache_state_text("html").alias("doc"))
    return _flat(docs.select("page_id", extract_cache_state("doc").alias("x")))


@query(
    "extract_captured",
    _stats_sql("TRUE", _CAPTURED_ROWS, "player_id, player_name, CAST(NULL AS VARCHAR) AS season"),
)
def extract_captured_query(spark, sf):
    best = captured.best_captured(order_responses(spark, sf, everywhere=True))
    return _flat(best.withColumnRenamed("captured", "x"))


@query(
    "extract_tables",
    """
    WITH p AS (SELECT *, CAST(p_partkey AS VARCHAR) AS k, p_partkey % 4 AS v FROM part)
    SELECT p_partkey AS page_id, concat('Part ', k) AS player_name, 'Size' AS statistic_name,
           CAST(p_size AS VARCHAR) AS value, concat(p_size, '%') AS percentile, 'A' AS grade,
           CASE WHEN v = 3 THEN 'General' ELSE p_type END AS statistic_category FROM p
    UNION ALL SELECT p_partkey, concat('Part ', k), 'Brand', p_brand, NULL, NULL,
           CASE v WHEN 0 THEN 'Inner & more' WHEN 1 THEN p_type WHEN 2 THEN p_name ELSE 'General' END FROM p
    """,
)
def extract_tables_query(spark, sf):
    """One row table and one column-label table per part, under headings of four kinds."""
    size = _join(
        "<table><tbody><tr><td>Name</td><td>Value</td></tr><tr><td> Size </td><td>", F.col("p_size"),
        "</td><td>", F.col("p_size"), "%</td><td><b>A</b></td><td>more</td></tr><tr><td>one</td></tr></tbody></table>",
    )
    brand = _join(
        "<table><tr><td>Head</td><td>Head</td></tr><tr><td>Brand</td><td>", F.col("p_brand"), "</td><td>-</td>"
        "<td>N/A</td></tr></table>",
    )
    heading = _join("<h3>", F.col("p_type"), "</h3>")
    body = pick(
        F.col("p_partkey") % 4,
        [
            _join(heading, size, "<div class='x-category'><h4>Inner &amp; more</h4>", brand, "</div>"),
            _join(heading, "<section class='player-stats'>", size, "</section><h2>Grade</h2>", brand),
            _join(heading, size, "<h2>", F.col("p_name"), "</h2><p>text<br></p>", brand, "</i>"),
            _join("<h1>none</h1>", size, brand),
        ],
    )
    pages = table(spark, sf, "part").repartition(PARTS, "p_partkey").select(
        F.col("p_partkey").alias("page_id"),
        _join("<div class='player-header'><h1>Part ", F.col("p_partkey"), "</h1></div>", body).alias("html"),
    )
    parsed = pages.select("page_id", page_tables("html").alias("p"))
    return _flat(parsed.select("page_id", extract_tables(F.col("p")).alias("x"))).drop(
        "player_id", "season"
    )


@query(
    "extract_tables_web",
    """
    SELECT page_id, 'Length' AS statistic_name, CAST(page_id % 1000 AS VARCHAR) AS value,
           'Web stats' AS statistic_category FROM pages
    """,
)
def extract_tables_web(spark, sf):
    """Whole real pages, each with one stat table put before its end."""
    added = _join(
        "<section><h2>Web stats</h2><table><tbody><tr><td>Length</td><td>", F.col("page_id") % 1000,
        "</td></tr></tbody></table></section>",
    )
    pages = table(spark, sf, "pages").repartition(PARTS, "page_id").select("page_id", F.concat("html", added).alias("html"))
    parsed = pages.select("page_id", page_tables("html").alias("p"))
    return _flat(parsed.select("page_id", extract_tables(F.col("p")).alias("x"))).drop(
        "player_id", "player_name", "season", "percentile", "grade"
    )


_CHOSEN = [
    ("o_orderkey % 5 = 0", "next_data", _PAGE_ROWS),
    ("o_orderkey % 5 = 1", "apollo_state", _CACHE_ROWS),
    ("o_orderkey % 5 = 2", "xhr_json", _CAPTURED_ROWS),
    ("o_orderkey % 5 = 3", "dom_tables", _TABLE_ROWS),
]


@query(
    "extract_priority",
    """
    SELECT o_orderkey AS page_id,
           CASE o_orderkey % 5 WHEN 0 THEN 'next_data' WHEN 1 THEN 'apollo_state' WHEN 2 THEN 'xhr_json'
                WHEN 3 THEN 'dom_tables' ELSE 'unknown' END AS source,
           CAST(CASE o_orderkey % 5 WHEN 0 THEN 3 WHEN 4 THEN 0 ELSE 2 END AS BIGINT) AS n_stats,
           CASE WHEN o_orderkey % 5 = 4 THEN 'All extraction sources failed' END AS error
    FROM orders
    """,
)
def extract_priority(spark, sf):
    out = choose.extract_pages(order_pages(spark, sf), order_responses(spark, sf))
    return out.select(
        "page_id", "source", F.size("extracted.stats").cast("bigint").alias("n_stats"), "error"
    )


def _read_attribute(df, column, needed, falsy):
    """The stats that a page has as JSON in an attribute."""
    found = F.when(needed, F.nullif(F.regexp_extract("html", "data-stats='([^']*)'", 1), F.lit("")))
    return df.withColumn(column, captured.extract_captured(found, falsy))


@query(
    "extract_own_source",
    """
    SELECT o_orderkey AS page_id,
           CASE WHEN o_orderkey % 3 = 0 THEN 'attribute' WHEN o_orderkey % 3 = 1 THEN 'next_data' ELSE 'unknown' END AS source,
           CAST(CASE o_orderkey % 3 WHEN 0 THEN 1 WHEN 1 THEN 3 ELSE 0 END AS BIGINT) AS n_stats,
           CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_custkey AS VARCHAR) END AS first_value
    FROM orders
    """,
)
def extract_own_source(spark, sf):
    """A source that a user registers and names before a built-in one."""
    choose.register_source(choose.PageSource("attribute", _read_attribute))
    own = _join("<div data-stats='", '{"stats":[{"name":"Customer","value":"', F.col("o_custkey"), '"}]}', "'></div>")
    html = F.when(F.col("o_orderkey") % 3 == 0, F.concat(own, _page_data())).when(
        F.col("o_orderkey") % 3 == 1, _page_data()
    )
    pages = _orders(spark, sf).select(
        F.col("o_orderkey").alias("page_id"), F.lit("https://h/x").alias("url"),
        F.coalesce(html, F.lit("<div data-stats=''></div>")).alias("html"),
    )
    out = choose.extract_pages(pages, priority=["attribute", choose.PAGE_DATA])
    first = F.get("extracted.stats", F.lit(0))["value"]
    return out.select(
        "page_id", "source", F.coalesce(F.size("extracted.stats"), F.lit(0)).cast("bigint").alias("n_stats"),
        F.when(F.col("source") == "attribute", first).alias("first_value"),
    )


@query(
    "crawl_rows",
    " UNION ALL ".join(
        f"""SELECT page_id, player_id, player_name, concat('cust-', player_id) AS player_slug, season,
                   '{source}' AS extraction_source, statistic_name, statistic_category, value,
                   TRY_CAST(value AS DOUBLE) AS value_numeric,
                   CAST(rtrim(percentile, '%') AS DOUBLE) / 100.0e0 AS percentile_numeric,
                   CASE WHEN upper(grade) IN ('F', 'B') THEN upper(grade) END AS grade, TRUE AS is_complete,
                   '2024-01-02T03:04:05.000000' AS extracted_at
            FROM ({_stats_sql(where, rows)})"""
        for where, source, rows in _CHOSEN
    ),
)
def crawl_rows(spark, sf):
    """Pages to cleaned stat rows: extraction by priority, identity, cleaning."""
    stamp = F.lit("2024-01-02 03:04:05").cast("timestamp")
    chosen = choose.extract_pages(order_pages(spark, sf), order_responses(spark, sf))
    rows = normalize_stats(choose.stat_rows(chosen, stamp))
    return rows.select(
        "page_id", "player_id", "player_name", "player_slug", "season", "extraction_source",
        "statistic_name", "statistic_category", "value", "value_numeric", "percentile_numeric",
        "grade", "is_complete", iso_time("extracted_at").alias("extracted_at"),
    )


@query(
    "best_source",
    """
    SELECT o_orderkey AS page_id,
           CASE WHEN v = 0 THEN 'next_data' WHEN v = 2 THEN 'dom_tables' WHEN v = 4 THEN 'unknown'
                ELSE 'dom_tables' END AS best_source,
           CAST(CASE v WHEN 0 THEN 4 WHEN 4 THEN 0 ELSE 3 END AS BIGINT) AS n_stats,
           CASE v WHEN 0 THEN 'Found page data with 4 stats' WHEN 4 THEN 'No suitable extraction source found'
                ELSE 'Found 1 tables with 3 rows' END AS reason
    FROM (SELECT *, o_orderkey % 5 AS v FROM orders)
    """,
)
def best_source(spark, sf):
    pages = order_pages(spark, sf).drop("url")
    return choose.best_source(pages, order_responses(spark, sf))


@query(
    "inspect_report",
    """
    WITH o AS (SELECT o_orderkey AS page_id, o_custkey, o_orderkey % 5 AS v FROM orders),
    r AS (SELECT *, 'next_data' AS source, CASE WHEN v = 0 THEN 3 ELSE 0 END AS n, 'Defense,Shooting' AS c FROM o
          UNION ALL SELECT *, 'apollo_state', CASE WHEN v < 2 THEN 2 ELSE 0 END, 'General,Shooting' FROM o
          UNION ALL SELECT *, 'dom_tables', CASE WHEN v < 4 THEN 2 ELSE 0 END, 'Totals' FROM o)
    SELECT page_id, source, n > 0 AS success, CAST(n AS BIGINT) AS n_stats,
           CASE WHEN n > 0 THEN concat('Cust ', o_custkey) END AS player_name,
           CASE WHEN n > 0 THEN 'Price' END AS sample, CASE WHEN n > 0 THEN c END AS categories,
           CASE WHEN v = 0 THEN 'next_data' WHEN v = 1 THEN 'apollo_state' WHEN v < 4 THEN 'dom_tables' END AS best_source
    FROM r
    """,
)
def inspect_report(spark, sf):
    report = choose.inspect_pages(order_pages(spark, sf).drop("url"))
    return report.withColumns(
        {
            "n_stats": F.col("n_stats").cast("bigint"),
            "categories": F.when(F.col("success"), F.array_join("categories", ",")),
        }
    )


@query(
    "raw_payloads",
    """
    SELECT o_orderkey AS page_id, 'html' AS source FROM orders
    UNION ALL SELECT o_orderkey, 'next_data' FROM orders WHERE o_orderkey % 5 = 0
    UNION ALL SELECT o_orderkey, 'apollo_state' FROM orders WHERE o_orderkey % 5 < 2
    UNION ALL SELECT o_orderkey, 'xhr_json' FROM orders, range(3)
    """,
)
def raw_payloads(spark, sf):
    pages = order_pages(spark, sf).drop("url")
    return choose.raw_payloads(pages, order_responses(spark, sf)).select("page_id", "source")


def event_responses(spark, sf):
    """Events as captured responses of a page per user."""
    key, props = F.col("event_id"), F.col("props")
    url = pick(
        key % 6,
        ["https://h/api/v1", "https://h/graphql?q=1", "https://h/_next/data/x", "https://h/img.png",
         "https://h/stats", "https://h/player/1"],
    )
    content_type = pick(key % 4, ["application/JSON", "text/html", "application/javascript", "json; x"])
    body = pick(
        key % 5,
        [props, _join('{"data":{"stats":', props, "}}"), _join('[{"rank":1,"value":', key, "}]"), "{}", "<p>"],
    )
    return table(spark, sf, "events").repartition(PARTS, "event_id").select(
        F.col("user_id").alias("page_id"),
        key.alias("seq"),
        url.alias("url"),
        F.lit(200).alias("status"),
        content_type.alias("content_type"),
        body.alias("body"),
    )


_CAPTURED_SQL = """
    SELECT user_id AS page_id, event_id AS seq, event_id % 6 AS u, event_id % 5 AS b FROM events
    WHERE event_id % 6 <> 3 AND event_id % 4 <> 1 AND event_id % 5 <> 4
"""


@query(
    "capture_filter",
    f"""
    SELECT page_id, seq, b <> 3 AS has_json, u = 1 AS is_graphql, b IN (1, 2) AS has_stats
    FROM ({_CAPTURED_SQL})
    """,
)
def capture_filter(spark, sf):
    kept = captured.capture_json(event_responses(spark, sf))
    document = json_document("body")
    return kept.select(
        "page_id",
        "seq",
        document.isNotNull().alias("has_json"),
        captured.is_graphql("url").alias("is_graphql"),
        captured.has_stats(document).alias("has_stats"),
    )


@query(
    "capture_summary",
    f"""
    WITH k AS (SELECT page_id % 7 AS page_id, seq, u, b FROM ({_CAPTURED_SQL})),
    l AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY seq DESC) AS rn FROM k)
    SELECT page_id, count(*) AS total_responses, count(*) AS json_responses,
           count(*) FILTER (WHERE b IN (1, 2)) AS stats_responses, count(*) FILTER (WHERE u = 1) AS graphql_responses,
           string_agg(CASE u WHEN 0 THEN 'https://h/api/v1' WHEN 1 THEN 'https://h/graphql?q=1' WHEN 2 THEN
                      'https://h/_next/data/x' WHEN 4 THEN 'https://h/stats' ELSE 'https://h/player/1' END, ' ' ORDER BY seq)
               FILTER (WHERE rn <= 100) AS urls
    FROM l GROUP BY page_id
    """,
)
def capture_summary(spark, sf):
    """Seven pages with hundreds of responses each; the last hundred URLs are listed."""
    kept = captured.capture_json(event_responses(spark, sf)).withColumn("page_id", F.col("page_id") % 7)
    return captured.capture_summary(kept).withColumn("urls", F.array_join("urls", " "))


@query(
    "count_stat_entries",
    """
    SELECT event_id, CAST(CASE event_id % 5 WHEN 0 THEN event_id % 401 WHEN 1 THEN event_id % 13 WHEN 2 THEN 1
                          ELSE 0 END AS BIGINT) AS n_entries,
           (event_id % 5 = 1 AND event_id % 13 > 0) OR event_id % 5 = 2 AS has_stats FROM events
    """,
)
def count_stat_entries(spark, sf):
    """Lists of up to 400 stats, and stats up to 12 levels down."""
    key = F.col("event_id")
    listed = F.concat(F.lit("["), F.array_join(F.array_repeat(F.lit('{"score":1}'), (key % 401).cast("int")), ","), F.lit("]"))
    depth = (key % 13).cast("int")
    nested = F.concat(F.repeat(F.lit('{"rank":1,"grade":'), depth), F.lit("0"), F.repeat(F.lit("}"), depth))
    rows = event_responses(spark, sf).withColumnRenamed("seq", "event_id")
    body = pick(key % 5, [listed, nested, F.col("body"), F.col("body"), F.col("body")])
    return rows.withColumn("body", body).select(
        "event_id",
        captured.count_stats("body").alias("n_entries"),
        captured.has_stats("body").alias("has_stats"),
    )


@query(
    "profile_explode",
    """
    SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 1 AND i = 2 THEN 'own' ELSE concat('c', o_custkey) END AS player_id,
           concat('stat', i) AS statistic_name, CASE i WHEN 3 THEN '00000' ELSE concat(o_custkey, '%') END AS value,
           CASE WHEN i < 3 THEN CAST(o_custkey AS DOUBLE) END AS value_numeric,
           CASE i WHEN 1 THEN 'A+' WHEN 2 THEN 'F' END AS grade, i < 3 AS is_complete
    FROM orders, (SELECT unnest([1, 2, 3]) AS i) WHERE o_orderkey % 4 > 0
    """,
)
def profile_explode(spark, sf):
    """Profiles with three nested stats, cleaned in place and exploded; some have none."""
    share = _join(F.col("o_custkey"), "%")

    def stat(i: int, value: Column, grade: str | None) -> Column:
        own = F.when(F.col("o_orderkey") % 4 == 1, "own") if i == 2 else F.lit(None)
        return F.struct(
            F.lit(f"stat{i}").alias("statistic_name"),
            F.lit("General").alias("statistic_category"),
            value.alias("value"),
            F.lit(None).cast("string").alias("percentile"),
            F.lit(grade).cast("string").alias("grade"),
            own.cast("string").alias("player_id"),
        )

    stats = F.array(stat(1, share, "a+"), stat(2, share, "fail"), stat(3, F.lit("-"), None))
    profiles = _orders(spark, sf).select(
        "o_orderkey",
        _join("c", F.col("o_custkey")).alias("player_id"),
        F.when(F.col("o_orderkey") % 4 > 0, stats).alias("stats"),
    )
    rows = normalize_stats(explode_profiles(profiles))
    return rows.select(
        "o_orderkey", "player_id", "statistic_name", "value", "value_numeric", "grade", "is_complete"
    )


@query(
    "profile_normalize",
    """
    SELECT o_orderkey, concat(o_custkey, '|00000') AS stored, CAST(o_custkey AS DOUBLE) AS first_number,
           CAST(1 AS BIGINT) AS n_complete
    FROM orders
    """,
)
def profile_normalize(spark, sf):
    def stat(value: Column) -> Column:
        return F.struct(
            F.lit("s").alias("statistic_name"),
            F.lit("General").alias("statistic_category"),
            value.alias("value"),
            F.lit("5%").alias("percentile"),
            F.lit("b").alias("grade"),
        )

    profiles = _orders(spark, sf).select(
        "o_orderkey", F.array(stat(text("o_custkey")), stat(F.lit(""))).alias("stats")
    )
    out = normalize_profiles(profiles)
    return out.select(
        "o_orderkey",
        F.array_join(F.transform("stats", lambda s: s["value"]), "|").alias("stored"),
        F.get("stats", F.lit(0))["value_numeric"].alias("first_number"),
        F.size(F.filter("stats", lambda s: s["is_complete"])).cast("bigint").alias("n_complete"),
    )


@query(
    "run_stamp",
    """
    SELECT o_orderkey, CAST(o_custkey AS DOUBLE) AS value_numeric,
           strftime(CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_orderdate AS TIMESTAMP) ELSE TIMESTAMP '2024-01-02 03:04:05' END,
                    '%Y-%m-%dT%H:%M:%S.%f') AS row_stamp,
           '2024-01-02T03:04:05.000000' AS profile_stamp
    FROM orders
    """,
)
def run_stamp(spark, sf):
    """Rows and profiles get the time of the run where they have none."""
    run_ts = F.lit("2024-01-02 03:04:05")
    known = F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderdate").cast("timestamp"))
    rows = _orders(spark, sf).select(
        "o_orderkey", F.lit("s").alias("statistic_name"), text("o_custkey").alias("value"),
        F.lit("5%").alias("percentile"), F.lit("b").alias("grade"), known.alias("extracted_at"),
    )
    stamped = normalize_stats(rows, run_ts).withColumnRenamed("extracted_at", "row_stamp")
    stat = F.struct("statistic_name", "value", "percentile", "grade")
    profiles = normalize_profiles(stamped.select("o_orderkey", "row_stamp", "value_numeric", F.array(stat).alias("stats")), run_ts)
    return profiles.select(
        "o_orderkey", "value_numeric", iso_time("row_stamp").alias("row_stamp"),
        iso_time("extracted_at").alias("profile_stamp"),
    )
