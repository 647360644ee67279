"""The crawl job: which pages are read, what moves, what is rejected and replaced."""

import contextlib
import gzip
import io
import json
import pathlib
import re
import time

from pyspark.sql import functions as F

from statlake.operators.extract.captured import best_captured
from statlake.operators.extract.choose import extract_pages, with_identity
from statlake.operators.extract.tables import read_page, read_pages
from statlake.operators.progress import fold_progress, fold_tries
from statlake.plans import crawl
from statlake.plans.crawl import (
    clean_rows,
    likely_pages,
    progress_events,
    progress_tries,
    run_crawl,
    seeds_to_do,
    write_stats,
)
from statlake.session import RELEASED_SHUFFLES, settings

URL = "https://h/player-profiles/2024-2025/a-b/"
SEEDS = "url string, player_id string, player_slug string, season string"


def page(n, stats=1):
    body = {"props": {"pageProps": {"stats": [{"name": f"s{i}", "value": f"{n}"} for i in range(stats)]}}}
    return f'<script id="__NEXT_DATA__" type="application/json">{json.dumps(body)}</script>'


def pages_of(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_html_is_in_no_exchange(spark):
    pages = pages_of(spark, [(i, f"{URL}{i}", page(i)) for i in range(20)])
    seeds = spark.createDataFrame([(f"{URL}{i}", None, None, None) for i in range(5)], SEEDS)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        todo = seeds_to_do(seeds)
        found = extract_pages(likely_pages(pages, todo)).join(todo, "url")
        text = io.StringIO()
        with contextlib.redirect_stdout(text):
            found.explain("formatted")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    inputs = re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[(.*)\]", text.getvalue())
    assert inputs and not any("html" in columns for columns in inputs)
    assert sorted(r["page_id"] for r in found.collect()) == list(range(5))


def test_filter_passes_all_that_are_asked_for(spark):
    pages = pages_of(spark, [(i, f"{URL}{i}", "x") for i in range(3000)])
    seeds = pages.where("page_id % 10 = 0").select("url")
    for bits in (1 << 23, 1 << 15, 1 << 9):
        got = {r["page_id"] for r in likely_pages(pages, seeds, bits).collect()}
        assert got >= set(range(0, 3000, 10)) and len(got) < {1 << 23: 310, 1 << 15: 400}.get(bits, 3001)


def test_filled_identity_wins_and_completed_pages_go(spark):
    rows = [("u", None, None, "s"), ("u", "p", None, "s"), ("v", "q", None, "s"), ("v", None, None, "s")]
    done = spark.createDataFrame([("q", "s", "success")], "player_id string, season string, status string")
    got = seeds_to_do(spark.createDataFrame(rows, SEEDS), done).collect()
    assert [(r["url"], r["player_id"]) for r in got] == [("u", "p")]


def test_rejects_and_touched_seasons(spark, tmp_path):
    def url(season, i):
        return f"https://h/player-profiles/{season}/a-b/{i}"

    first = pages_of(spark, [(1, url("2023-2024", 1), page(1)), (2, url("2024-2025", 2), page(2))])
    out = run_crawl(spark, first, str(tmp_path / "one"), "2024-01-01 07:00:00")
    untouched = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "one/stats/season=2023-2024").iterdir()}
    second = pages_of(spark, [(3, url("2024-2025", 3), page(3)), (4, "https://h/none", page(4)), (5, "https://h/x", page(5))])
    seeds = spark.createDataFrame([(url("2024-2025", 3), None, None, None), ("https://h/none", "", None, "")], SEEDS)
    again = run_crawl(spark, second, str(tmp_path / "two"), "2024-01-02 07:00:00", seeds=seeds, stats=out.stats)
    assert again.stats == out.stats
    rows = spark.read.parquet(out.stats).select("player_id", F.col("season").cast("string"), "value").collect()
    assert sorted(map(tuple, rows)) == [("1", "2023-2024", "1"), ("2", "2024-2025", "2"), ("3", "2024-2025", "3")]
    assert untouched == {p.name: p.stat().st_mtime_ns for p in (tmp_path / "one/stats/season=2023-2024").iterdir()}
    rejected = spark.read.schema("page_id long, url string, reason string").json(again.rejected).collect()
    assert sorted((r["page_id"], r["reason"]) for r in rejected) == [
        (4, "No player, season or statistic"), (5, "No seed names this page"),
    ]
    progress = spark.read.parquet(again.progress).collect()
    assert [(r["player_id"], r["status"]) for r in progress] == [("3", "success")]


def test_json_lines_of_a_run_are_compressed(spark, tmp_path):
    rows = [(i, f"{URL}{i}", page("é", 40)) for i in range(50)]
    out = run_crawl(spark, pages_of(spark, [*rows, (50, "https://h/none", page(1))]), str(tmp_path / "one"), "2024-01-01 07:00:00")
    stored, lines = 0, {}
    for name in ("export", "rejected"):
        files = [f for f in (tmp_path / "one" / name).glob("part*") if f.stat().st_size]
        assert files and all(f.name.endswith(".json.gz") for f in files)
        stored += sum(f.stat().st_size for f in files)
        lines[name] = [line for f in files for line in gzip.open(f, "rt", encoding="utf-8").read().splitlines()]
    assert len(lines["export"]) == 2001 and stored < sum(map(len, lines["export"])) / 10
    assert sum('"value":"é"' in line and '"player_name":null' in line for line in lines["export"]) == 2000
    assert [json.loads(line)["page_id"] for line in lines["rejected"]] == [50]
    assert spark.read.json(out.export).count() == 2001


def shuffle_files(spark):
    disks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {f for top in disks.localDirsString() for f in pathlib.Path(top).rglob("shuffle_*")}


def test_shuffle_files_go_with_their_output(spark, tmp_path):
    key = next(iter(RELEASED_SHUFFLES))
    before, was = shuffle_files(spark), spark.conf.get(key)
    pages = pages_of(spark, [(i, f"{URL}{i}", page(i)) for i in range(20)])
    out = run_crawl(spark, pages, str(tmp_path / "one"), "2024-01-01 07:00:00")
    seeds = spark.createDataFrame([(f"{URL}{i}", None, None, None) for i in range(5)], SEEDS)
    progress = spark.read.parquet(out.progress).where("player_id > 2")
    run_crawl(spark, pages, str(tmp_path / "two"), "2024-01-02 07:00:00", None, seeds, progress, out.stats)
    until = time.time() + 20
    while shuffle_files(spark) - before and time.time() < until:  # they are removed in the background
        time.sleep(0.2)
    assert not shuffle_files(spark) - before and spark.conf.get(key) == was
    assert spark.read.parquet(out.stats).count() == 20


def test_stat_rows_are_merged_before_the_silver_write(spark, tmp_path, monkeypatch):
    plans, write = [], crawl.write_silver

    def written(df, *args, **kept):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        write(df, *args, **kept)

    def rows(day, ids):
        return clean_rows(pages_of(spark, [(day * 10 + i, f"{URL}{i}", page(day)) for i in ids]), F.lit(f"2024-01-0{day}"))

    monkeypatch.setattr(crawl, "write_silver", written)
    place, other = str(tmp_path / "stats"), str(tmp_path / "other")
    write_stats(rows(1, [1, 2]), None, place)
    write_stats(rows(2, [2, 3]), place, place)
    write_stats(rows(3, [3, 4]), spark.read.parquet(place), other)
    got = {path: {(r["player_id"], r["value"]) for r in spark.read.parquet(path).collect()} for path in (place, other)}
    assert got == {place: {("1", "1"), ("2", "2"), ("3", "2")}, other: {("1", "1"), ("2", "2"), ("3", "3"), ("4", "3")}}
    assert len(plans) == 3 and not any("Aggregate" in plan for plan in plans)


def test_settings_are_put_back(spark):
    key, new = "spark.sql.shuffle.partitions", "spark.statlake.test"
    was = spark.conf.get(key)
    with contextlib.suppress(ValueError), settings(spark, {key: "3", new: "x"}):
        assert (spark.conf.get(key), spark.conf.get(new)) == ("3", "x")
        raise ValueError
    assert spark.conf.get(key) == was and spark.conf.get(new, None) is None


def test_tries_fold_as_their_events(spark):
    rows = [(i, f"{URL}{i % 7}", page(i, i % 3) if i % 5 else "<p>loading</p>") for i in range(60)]
    rows += [(i, f"{URL}{i}x?a", page(i)) for i in range(90, 93)]
    read = extract_pages(pages_of(spark, rows)).localCheckpoint()
    tries = with_identity(read).withColumn("n_stats", F.size("stats"))
    current = slow = None
    for day, part in (("2024-01-01", "page_id % 2 = 0"), ("2024-01-02", "page_id % 2 = 1 and page_id % 7 < 4")):
        stamp = F.lit(day).cast("timestamp")
        current = fold_tries(progress_tries(tries.where(part), stamp), current=current).localCheckpoint()
        slow = fold_progress(progress_events(read.where(part), stamp), current=slow).localCheckpoint()
        assert current.schema.names == slow.schema.names and current.count() > 3
        assert sorted(map(str, current.collect())) == sorted(map(str, slow.collect()))


def test_fold_of_tries_keeps_rows_without_a_new_try(spark):
    first = spark.createDataFrame([("p", "s", 1, "a")], "player_id string, season string, seq long, player_slug string")
    nothing = {c: F.lit(None).cast("string") for c in ("player_name", "url", "source", "error")}
    done = {"ts": F.lit("2024-01-01").cast("timestamp"), "n": F.lit(2).cast("long"), "done": F.lit(True)}
    row = fold_tries(first.withColumns({**nothing, **done}))
    again = fold_tries(first.withColumns({**nothing, **done}).where("seq > 1"), current=row)
    assert again.collect() == row.collect() and row.first()["attempts"] == 1 and row.first()["stat_count"] == 2


def test_extraction_is_kept_with_identity(spark, tmp_path, monkeypatch):
    kept = []
    monkeypatch.setattr(crawl, "remove_path", lambda _, path: kept.append(path))
    run_crawl(spark, pages_of(spark, [(1, f"{URL}1", page(1, 2))]), str(tmp_path / "one"), "2024-01-01 07:00:00")
    row = spark.read.parquet(kept[0]).first()
    assert (row["player_id"], row["season"], row["player_slug"], row["n_stats"]) == ("1", "2024-2025", "a-b", 2)


def test_responses_without_names_are_not_parsed(spark):
    named = '{"stats":[{"n\\u0061me":"a","value":1}]}'
    bodies = ['{"stats":[]}', named, named + "x", '{"stats":[{"value":1}]}', '{"stats":[{"label":"b"},{"metric":"c"}]}', None, "name"]
    rows = [(i % 2, i, b) for i, b in enumerate(bodies)]
    best = best_captured(spark.createDataFrame(rows, "page_id long, seq long, body string"))
    got = {r["page_id"]: [s["statistic_name"] for s in r["captured"]["stats"]] for r in best.collect()}
    assert got == {0: ["b", "c"], 1: ["a"]}
    plan = best._jdf.queryExecution().optimizedPlan().toString()
    below = plan.split("Generate ")[-1].split("\n", 1)[1]
    assert "Contains" in below or "contains" in below
    assert "json" not in below


def test_pages_are_read_into_flat_columns():
    table = '<h1 class="player-name">A</h1><h2>B &amp; C</h2><table><tr><td>x</td></tr><tr><td> 1 <b>2</b></td><td></td></tr></table>'
    pages = [table, None, "<p>a > b", table.replace("x", "y"), "<table>", table, ""]
    got = read_pages(pages)
    got.validate(full=True)
    assert got.to_pylist() == [None if p is None else read_page(p) for p in pages]
    assert got[5].as_py() == {
        "player_name": "A", "tables": 1, "body_rows": 0,
        "sections": [{"node": 2, "first": 0, "category": "B & C", "rows": [["12", ""]]}],
    }
