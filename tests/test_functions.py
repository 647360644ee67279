"""Golden vectors of the column functions."""

import time
import pytest
from pyspark.sql import functions as F

from statlake.functions import jsontext, numbers, seasons, text, urls


def run(spark, column, values, schema="x string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, " + schema)
    return [r["y"] for r in df.select("i", column.alias("y")).orderBy("i").collect()]


def check(spark, column, pairs):
    assert run(spark, column, [p[0] for p in pairs]) == [p[1] for p in pairs]


VALUES = [
    ("12.5", 12.5), (" 7 ", 7.0), ("45%", 45.0), ("+3", 3.0), (".5", 0.5), ("5.", 5.0),
    ("1e3", 1000.0), ("1,234", 1.0), ("$7 each", 7.0), ("-3.2 (est)", -3.2), ("12-5", 12.0),
    ("1e3f", 1.0), ("0x1p3", 0.0), ("1_000", 1000.0), ("1d", 1.0), ("88 %", 88.0),
    ("abc", None), ("%", None), ("", None), ("-", None), ("—", None), ("N/A", None),
    ("n/a", None), ("null", None), ("None", None), (None, None), (" 9 ", 9.0),
]
GRADES = [
    ("a+", "A+"), (" b- ", "B-"), ("D+ (good)", "D+"), ("A +", "A"), ("AVERAGE", "A"),
    ("BAD", "B"), ("F-", "F"), ("FAIL", "F"), ("E", None), ("—", None), ("N/A", None),
    ("none", None), ("neutral", None), ("", None), (None, None),
]
PERCENTILES = [
    ("88%", 0.88), ("88", 0.88), ("0.88", 0.88), ("88 %", 0.88), ("1", 1.0), ("1%", 1.0),
    ("1.5", 0.015), ("150", 1.0), ("-5", 0.0), ("abc", None), ("N/A", None), (None, None),
    ("nan", None), ("1d", None),
]
OVER_100 = [
    ("88%", 0.88), ("88%%", 0.88), ("0.88", 0.0088), ("150%", 1.5), ("-", None),
    ("N/A", None), ("88 % x", None), (None, None),
]
NAMES = [
    ("  lebron   JAMES ", "Lebron James"), ("shaquille o'neal", "Shaquille O'Neal"),
    ("karl-anthony towns", "Karl-Anthony Towns"), ("jj 3rd", "Jj 3Rd"), ("Unknown", None),
    ("N/A", None), ("", None), (None, None), ("éric DUPONT", "Éric Dupont"),
]
SEASONS = [
    ("2024-25", "2024-2025"), ("2024-2025", "2024-2025"), ("24-25", "2024-2025"),
    ("2024-30", "2024-2025"), ("2024-20256", "2024-2025"), ("1999-00", "1999-2000"),
    ("50-51", "1950-1951"), ("49-50", "2049-2050"), ("99-00", "1999-2000"), ("2024-202", None),
    ("2024", None), ("x2024-25", None), (None, None), (" 2013-14 ", "2013-2014"),
]
CATEGORIES = [
    (None, "General"), ("", "General"), ("post-play", "Post Play"), ("postplay", "Post Play"),
    ("post up", "Post Play"), ("3-point shooting", "Three Point Shooting"),
    ("3 point", "Three Point"), ("  ball   handling", "Ball Handling"), ("3pt", "Three Point"),
]
NORMAL_URLS = [
    ("example.com/a/", "https://example.com/a"), ("http://h/a//", "http://h/a"),
    ("https://h/?q=1#f", "https://h"), ("HTTPS://H/x", "https://HTTPS://H/x"),
]


def test_stat_value(spark):
    check(spark, numbers.stat_value("x"), VALUES)


def test_long_texts(spark):
    check(spark, numbers.stat_value("x"), [("1" + "_1" * 50_000 + "x", 1.0), ("9" * 1_000 + "z", float("inf"))])
    started = time.perf_counter()
    for long in ("9" * 100_000 + "z", "1." + "9" * 100_000 + "z", "1e" + "9" * 100_000 + "z", "9_" * 50_000):
        for read in (numbers.parse_number, numbers.percentile, numbers.percentile_over_100):
            check(spark, read("x"), [(long, None)])
    assert time.perf_counter() - started < 30  # twelve jobs; quadratic reading takes minutes for one row
    check(spark, text.strip("x"), [(" " * 50_000 + "a" + " " * 50_000 + "b ", "a" + " " * 50_000 + "b")])
    check(spark, text.player_name("x"), [("a-" * 20_000, "A-" * 20_000)])


def test_grade(spark):
    check(spark, numbers.grade("x"), GRADES)
    known = [g for g in numbers.GRADES]
    assert run(spark, numbers.grade("x"), known) == known


def test_percentile(spark):
    got = run(spark, numbers.percentile("x"), [p[0] for p in PERCENTILES])
    assert got == [pytest.approx(p[1]) if p[1] is not None else None for p in PERCENTILES]


def test_percentile_over_100(spark):
    got = run(spark, numbers.percentile_over_100("x"), [p[0] for p in OVER_100])
    assert got == [pytest.approx(p[1]) if p[1] is not None else None for p in OVER_100]


def test_player_name(spark):
    check(spark, text.player_name("x"), NAMES)


def test_season(spark):
    check(spark, seasons.normalize_season("x"), SEASONS)
    check(
        spark,
        seasons.normalize_season("x", strict=True),
        [("99-00", "1999-1900"), ("2024-202", "2024-202"), ("2024-25", "2024-2025")],
    )


def test_category(spark):
    check(spark, text.stat_category("x"), CATEGORIES)
    check(spark, text.stat_category("x", strict=True), [("3pt", "3Pt"), ("post up", "Post Play")])


def test_value_sentinel_and_completeness(spark):
    df = spark.createDataFrame([("-",), ("abc",), ("00000",), ("N/A",), (None,), ("",)], "x string")
    stored = numbers.value_or_sentinel("x")
    rows = df.select(
        stored.alias("v"),
        numbers.item_value_numeric("x").alias("n"),
        numbers.is_complete(F.lit("name"), stored).alias("c"),
    ).collect()
    assert [tuple(r) for r in rows] == [
        ("00000", None, False), ("abc", None, True), ("00000", 0.0, False), ("N/A", None, True),
        ("00000", None, False), ("00000", None, False),
    ]


def test_season_of_date(spark):
    check(
        spark,
        seasons.season_of(F.col("x").cast("date")),
        [("2024-10-01", "2024-25"), ("2024-09-30", "2023-24"), ("1999-12-31", "1999-00")],
    )


def test_urls(spark):
    check(spark, urls.normalize_url("x"), NORMAL_URLS)
    parsed = run(
        spark,
        urls.parse_profile_url("x"),
        ["https://h/player-profiles/2024-2025/aaron-gordon/203932?x=1",
         "https://h/player-profiles/2024-25/a/1", "https://h/player-profiles/2024-2025/a/b", None],
    )
    assert parsed[0][:3] == ("2024-2025", "aaron-gordon", "203932")
    assert parsed[1:] == [None, None, None]
    check(spark, urls.domain("x"), [("https://u@h:80/p?q", "u@h:80"), ("h/p", "")])
    check(
        spark,
        urls.build_list_url(F.col("x"), 2, base="b"),
        [("2024-2025", "b/players?season=2024-2025&page=2"), (None, "b/players?page=2")],
    )
    check(spark, urls.build_list_url(base="b"), [("any", "b/players")])


def test_settings_and_dates(spark):
    check(spark, text.setting_int("x", 7), [(" 12 ", 12), ("a", 7), (None, 7), ("1.5", 7)])
    check(spark, text.setting_float("x", 0.5), [("2", 2.0), ("x", 0.5)])
    check(spark, seasons.provider_date("x"), [("2024-01-31", "01/31/2024"), ("nope", None)])


def test_json(spark):
    check(
        spark,
        jsontext.json_document("x").isNotNull(),
        [("{}", False), (" [ ] ", False), ("[1]", True), ("0", False), (None, False), ('{"a":0}', True)],
    )
    check(spark, jsontext.is_json("x"), [
        ("{}", True), ("{", False), ("1", True), (None, False), ('{"a":1}}', False), ("", False),
        ("1] [2", False), ("1,2", False), ('{"a":1,"a":2}', True), (' "x" ', True), ("1,2] x", False),
    ])


@pytest.mark.parametrize(
    "function, pairs",
    [
        (numbers.grade, GRADES),
        (text.player_name, NAMES),
        (seasons.normalize_season, SEASONS),
        (text.stat_category, CATEGORIES),
        (urls.normalize_url, NORMAL_URLS),
    ],
)
def test_idempotent(spark, function, pairs):
    outs = [p[1] for p in pairs if p[1] is not None]
    assert run(spark, function("x"), outs) == outs
