"""Extraction against hand-derived pages."""

import json
import random
import time

from pyspark.sql import functions as F

from statlake.operators.extract import captured, choose, tables
from statlake.operators.extract.entries import stats_from_list
from statlake.operators.extract.scripts import (
    cache_state_text,
    extract_cache_state,
    extract_page_data,
    extraction,
    page_data_text,
)
from statlake.operators.extract.tables import extract_tables, page_tables, read_page

PAGE = (
    '<html><script>var x="</p>";</script><script id="__NEXT_DATA__" type="application/json">%s'
    "</script></html>"
)
CACHE = "<script>a()</script><script>window.__APOLLO_STATE__ = %s;</script>"


def stats_of(row):
    return [tuple(s) for s in row["x"]["stats"]]


def tables_of(spark, html, repeats=False):
    df = spark.createDataFrame([(html,)], "html string").select(page_tables("html").alias("p"))
    return df.select(extract_tables(F.col("p"), repeats).alias("x")).first()


def one(spark, html, column):
    return spark.createDataFrame([(html,)], "html string").select(column.alias("x")).first()


def page_data(spark, doc, falsy=False):
    html = PAGE % (doc if isinstance(doc, str) else json.dumps(doc))
    return one(spark, html, extract_page_data(page_data_text("html"), falsy))


def test_page_data_groups(spark):
    props = {
        "player": {"id": 7, "name": "A B"},
        "season": "2024-25",
        "stats": {
            "Shooting": [
                {"name": "3P%", "value": "41.2%", "percentile": "88%", "grade": "a"},
                {"label": "FT", "score": 0},
                {"value": 1},
            ]
        },
    }
    row = page_data(spark, {"props": {"pageProps": props}})
    assert (row["x"]["player_id"], row["x"]["player_name"], row["x"]["season"]) == (
        "7", "A B", "2024-25",
    )
    assert stats_of(row) == [
        ("3P%", "41.2%", "88%", "a", "Shooting"),
        ("FT", "0", None, None, "Shooting"),
    ]


def test_page_data_alternatives(spark):
    props = {
        "stats": [],
        "data": {"player": {"playerId": "9", "playerName": "C", "statistics": [
            {"statName": "A", "stat_value": 0, "value": "", "rank": 3, "rating": "B", "type": "T"},
            5, None, {"metric": "M", "value": 2},
        ]}},
    }
    doc = {"props": {"pageProps": props}, "query": {"season": "2023-24"}}
    row = page_data(spark, doc)
    assert (row["x"]["player_id"], row["x"]["player_name"], row["x"]["season"]) == (
        "9", "C", "2023-24",
    )
    assert stats_of(row) == [("A", "0", "3", "B", "T"), ("M", "2", None, None, "General")]


def test_page_data_falsy_chain(spark):
    entry = {"name": "A", "value": 0, "stat_value": 5, "pct": 0, "rank": 0}
    doc = {"props": {"pageProps": {"playerStats": [entry]}}}
    assert stats_of(page_data(spark, doc)) == [("A", "0", "0", None, "General")]
    assert stats_of(page_data(spark, doc, falsy=True)) == [("A", "5", "0", None, "General")]


def test_page_data_missing_or_broken(spark):
    assert one(spark, "<p>none</p>", page_data_text("html"))["x"] is None
    row = page_data(spark, "{broken")
    assert row["x"]["stats"] == []


def test_cache_state(spark):
    doc = {
        "Player:7": {"id": "7", "name": "A"},
        "Stat:1": {"label": "FT", "value": 3, "type": "Shooting"},
        "x": {"__typename": "PlayerStatistic", "name": "AST", "score": "4"},
        "y": [1],
        "Player:8:9": {"name": "B"},
    }
    html = CACHE % "{broken}" + CACHE % json.dumps(doc)
    row = one(spark, html, extract_cache_state(cache_state_text("html")))
    assert (row["x"]["player_id"], row["x"]["player_name"]) == ("9", "B")
    assert stats_of(row) == [
        ("FT", "3", None, None, "Shooting"), ("AST", "4", None, None, "General"),
    ]
    assert one(spark, "<script>1</script>", cache_state_text("html"))["x"] is None


def table(rows, head="<tr><th>Statistic</th></tr>"):
    body = "".join("<tr>" + "".join(f"<td>{c}</td>" for c in r) + "</tr>" for r in rows)
    return f"<table><thead>{head}</thead><tbody>{body}</tbody></table>"


def test_tables(spark):
    html = (
        "<h1 class='big player-name'> A <b>B</b></h1>"
        "<h2>Shooting</h2><div class='stat-table-wrapper'>"
        + table([["FT", "—", "88%"], ["Statistic", "Value"], ["x"], ["3P &amp; up", "1", "2", "A"]])
        + "</div><div>" + table([["AST", "5"]]) + "</div>"
        "<section><h3>Grade</h3>" + table([["REB", "6"]]) + "</section>"
        "<div class='my-category-box'><p class='category-title'>Defense</p>"
        "<table><tr><td>h</td><td>h</td></tr><tr><td>STL</td><td>N/A</td></tr></table></div>"
    )
    row = tables_of(spark, html)
    assert row["x"]["player_name"] == "AB"
    expected = [
        ("FT", None, "88%", None, "Shooting"),
        ("3P & up", "1", "2", "A", "Shooting"),
        ("AST", "5", None, None, "Shooting"),
        ("REB", "6", None, None, "Shooting"),
        ("STL", None, None, None, "Defense"),
    ]
    assert stats_of(row) == expected
    twice = tables_of(spark, html, repeats=True)
    assert sorted(stats_of(twice)) == sorted(expected[:2] * 2 + expected[2:4] + expected[4:] * 2)


def test_pages_of_one_layout_are_parsed_once(monkeypatch):
    def page(a, b):
        return f"<!-- c --><h2>{a}</h2><p><table class='x'>" + table([[a, b], [b, "&lt;x> "]]) + "<br/></table>end"

    odd = ["<title>a<b></title>", "<a href='x>y'>", "<script>if (a<b && c>d) f('</p>')</script>", "</scr\u0131pt>", "<a b=c/>"]
    expected = [read_page(page(a, "1") + o) for a in ("one", "two &amp; three", "") for o in odd]
    parsed = []
    monkeypatch.setattr(tables._Tolerant, "feed", lambda self, html: parsed.append(html))
    pages = [read_page(page(str(i), "")) for i in range(1_000)]
    assert parsed == []
    monkeypatch.undo()
    assert [read_page(page(a, "1") + o) for a in ("one", "two &amp; three", "") for o in odd] == expected
    for html in [page("&amp;x", "y"), page("", " "), page("a", "b") + "<title>&amp;</title><h2>&amp;</h2>", *odd]:
        plain = tables._Page(html)
        slow = tables._Page.__new__(tables._Page)
        slow._start()
        parser = tables._Tolerant(slow)
        parser.feed(html)
        parser.close()
        slow.finish()
        assert read_page(html) == read_page(html) == tables._Layout(plain).read(plain.texts) == tables._Layout(slow).read(slow.texts)
    assert pages[7]["sections"][0]["rows"] != pages[8]["sections"][0]["rows"]


def test_read_page_counts():
    page = read_page(table([["a", "b"]]) + "<table><tr><td>x</td></tr></table></p><br><p>open")
    assert (page["tables"], page["body_rows"]) == (2, 1)


def test_reading_is_linear_in_the_tags():
    started = time.perf_counter()
    page = read_page("<table>" * 20_000 + "x" + "</table>" * 20_000)
    assert page["tables"] == 20_000
    read_page("<p>" * 20_000 + "</i>" * 20_000 + "<table></table>")
    assert time.perf_counter() - started < 10


def test_many_sections(spark):
    """Wrappers around one table, and many tables: linear, and the category is carried."""
    deep = "<div class='stat-section'>" * 5_000 + "<h3>Deep</h3><table><tr><th>a<tr><td>s</td><td>1</td></table>"
    flat = "<h2>Flat</h2>" + "<table><tr><th>a<tr><td>s</td><td>1</td></tr></table>" * 20_000
    started = time.perf_counter()
    page = read_page(deep)
    assert [bool(s["rows"]) for s in page["sections"][:3]] == [True, False, False]
    assert {(s["first"], s["category"]) for s in page["sections"]} == {(0, "Deep")}
    df = spark.createDataFrame([(flat,)], "html string").select(page_tables("html").alias("p"))
    got = df.select(extract_tables(F.col("p")).alias("x")).selectExpr(
        "size(x.stats) AS n", "array_distinct(transform(x.stats, s -> s.statistic_category)) AS c"
    )
    assert tuple(got.first()) == (20_000, ["Flat"])
    assert time.perf_counter() - started < 20


def test_best_captured(spark):
    def body(n):
        return json.dumps({"stats": [{"name": f"s{i}", "value": i} for i in range(n)], "playerId": n})

    rows = [
        (1, 1, body(2)), (1, 2, body(5)), (1, 3, body(5)), (2, 1, "{}"), (2, 2, "x"),
        (3, 1, json.dumps({"data": {"player": {"id": 4, "name": "N", "stats": [{"name": "q"}]}}})),
    ]
    df = spark.createDataFrame(rows, "page_id long, seq int, body string")
    got = {r["page_id"]: r["captured"] for r in captured.best_captured(df).collect()}
    assert set(got) == {1, 3}
    assert (got[1]["player_id"], len(got[1]["stats"])) == ("5", 5)
    assert (got[3]["player_id"], got[3]["player_name"]) == ("4", "N")


def test_count_and_has_stats(spark):
    deep = "1"
    for _ in range(12):
        deep = '{"value": %s}' % deep
    texts = [
        ('{"a":{"Value":1},"b":[{"grade":"A"},{"x":1}]}', 2, False),
        ('{"a":[{"rank":1,"grade":2}]}', 1, True),
        ('{"a":{"metrics":1}}', 0, True),
        (deep, 12, False),
        *((json.dumps([{"score": 1}] * n), n, False) for n in (11, 150, 400)),
        (json.dumps([1] * 30 + [[[[[[{"stats": []}]]]]]]), 0, True),
        ('{"value":' * 100_000 + "1" + "}" * 100_000, 100_000, False),
        ('{"rank":{"x":' * 30_000 + "1" + "}" * 30_000 + ',"grade":1}' * 30_000, 30_000, True),
        ('{"value":' * 2_000 + "1" + "}" * 1_999, 0, False),
        ('{"value":{"x":{"grade":1},"rank":{}},"y":"{\\"rank\\":1}"}', 2, False),
        ('{"rank":{"x":{"y":[1,{}]}},"grade":{}}', 1, True),
        (r'{"\u0067rade":1,"r\u0061nk":"grade\":{"}', 1, True),
        ("{", 0, False),
        ("", 0, False),
        (None, 0, False),
    ]
    df = spark.createDataFrame([(i, t[0]) for i, t in enumerate(texts)], "i int, t string")
    rows = df.select(
        "i", captured.count_stats("t").alias("c"), captured.has_stats("t").alias("h")
    ).orderBy("i").collect()
    assert [(r["c"], r["h"]) for r in rows] == [(t[1], t[2]) for t in texts]
    cut = df.where("i = 5").select(captured.count_stats("t", max_items=100).alias("c"))
    assert cut.first()["c"] == 100


def test_objects_against_a_walk(spark):
    """Generated nestings, against the walk of the parsed text that limits use."""
    rng = random.Random(5)
    names = ["value", "Grade", "grade", "rank", "percentile", "stats", "x", "y", "score"]

    def value(depth):
        kind = rng.random()
        if depth > 30 or kind < 0.15:
            return rng.choice([1, None, "{", '"}', "rank", "a\\", "'"])
        if kind < 0.3:
            return [value(depth + 1) for _ in range(rng.randrange(3))]
        return {k: value(depth + 1) for k in rng.sample(names, rng.randrange(3))}

    texts = [json.dumps(value(0), indent=rng.choice([None, 1])) for _ in range(500)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    wide = 10**6
    rows = df.select(
        captured.count_stats("t"), captured.count_stats("t", wide, wide),
        captured.has_stats("t"), captured.has_stats("t", wide, wide),
    ).collect()
    assert all(r[0] == r[1] and r[2] == r[3] for r in rows)
    assert len({r[0] for r in rows}) > 4 and len({r[2] for r in rows}) == 2


def test_capture_filter_and_summary(spark):
    rows = [
        (1, i, u, "Application/JSON; x", b)
        for i, (u, b) in enumerate(
            [("h/api/x", '{"stats":1}'), ("h/graphql", "[]"), ("h/other", "{}"), ("h/stats", "bad")]
        )
    ] + [(1, 9, "h/api/y", "text/html", "{}")]
    df = spark.createDataFrame(
        rows, "page_id long, seq int, url string, content_type string, body string"
    )
    kept = captured.capture_json(df)
    assert sorted(r["seq"] for r in kept.collect()) == [0, 1]
    summary = captured.capture_summary(kept).first()
    assert tuple(summary) == (1, 2, 2, 1, 1, ["h/api/x", "h/graphql"])
    many = kept.withColumn("seq", F.explode(F.sequence(F.lit(0), F.lit(149))))
    full = captured.capture_summary(many, listed=3).first()
    assert tuple(full)[:5] == (1, 300, 300, 150, 150) and len(full["urls"]) == 3
    assert captured.json_responses(df).count() == 1
    assert captured.graphql_responses(df).count() == 1
    assert captured.stats_responses(df).count() == 1
    last = captured.keep_last_responses(df, keep=2)
    assert sorted(r["seq"] for r in last.collect()) == [3, 9]


def stats_from_list_struct(text):
    nothing = F.lit(None).cast("string")
    return extraction(nothing, nothing, nothing, stats_from_list(F.lit(text)))


def pages(spark):
    nd = PAGE % json.dumps({"props": {"pageProps": {"stats": [{"name": "n", "value": 1}]}}})
    cs = CACHE % json.dumps({"Stat:1": {"name": "c", "value": 2}, "Stat:2": {"name": "d"}})
    tb = table([["t", "3"], ["u", "4"]])
    base = "https://h/player-profiles/2024-2025/slug/"
    rows = [(1, base + "1", nd + cs + tb), (2, base + "2", cs + tb), (3, base + "3", tb),
            (4, base + "4", "<p>nothing</p>"), (5, "https://h/x", tb)]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_extract_pages_by_priority(spark):
    body = json.dumps({"stats": [{"name": "x", "value": 1}]})
    responses = spark.createDataFrame([(5, 1, body)], "page_id long, seq int, body string")
    out = choose.extract_pages(pages(spark), responses).orderBy("page_id").collect()
    assert [r["source"] for r in out] == [
        "next_data", "apollo_state", "dom_tables", "unknown", "xhr_json",
    ]
    assert [r["error"] is None for r in out] == [True, True, True, False, True]
    rows = choose.stat_rows(
        choose.extract_pages(pages(spark), responses), F.lit("2024-01-02 03:04:05")
    ).orderBy("page_id", "stat_pos").collect()
    assert [(r["player_id"], r["season"], r["statistic_name"]) for r in rows] == [
        ("1", "2024-2025", "n"), ("2", "2024-2025", "c"), ("2", "2024-2025", "d"),
        ("3", "2024-2025", "t"), ("3", "2024-2025", "u"), (None, None, "x"),
    ]


def test_custom_source_and_priority(spark):
    def always(df, column, needed, falsy):
        return df.withColumn(column, stats_from_list_struct('[{"name":"s","value":1}]'))

    choose.register_source(choose.PageSource("always", always))
    out = choose.extract_pages(pages(spark), priority=["dom_tables", "always"]).orderBy("page_id")
    assert [r["source"] for r in out.collect()] == [
        "dom_tables", "dom_tables", "dom_tables", "always", "dom_tables",
    ]
    del choose.SOURCES["always"]


def test_best_source_and_inspection(spark):
    best = choose.best_source(pages(spark)).orderBy("page_id").collect()
    assert [(r["best_source"], r["n_stats"]) for r in best] == [
        ("dom_tables", 2), ("dom_tables", 2), ("dom_tables", 2), ("unknown", 0), ("dom_tables", 2),
    ]
    report = choose.inspect_pages(pages(spark)).where("page_id = 2").orderBy("source").collect()
    assert [(r["source"], r["n_stats"], r["sample"], r["best_source"]) for r in report] == [
        ("apollo_state", 2, "c", "apollo_state"), ("dom_tables", 2, "t", "apollo_state"),
        ("next_data", 0, None, "apollo_state"),
    ]
    assert choose.raw_payloads(pages(spark)).where("page_id = 1").count() == 3
