"""Sources, sinks, state, streams and jobs on small files."""

import datetime
import json

import pytest
from pyspark.sql import functions as F
from test_operators import EVENT_SCHEMA, brute_fold, fold_rows, random_log

from statlake.operators.normalize import explode_profiles, normalize_profiles
from statlake.operators.ordered import time_block
from statlake.operators.possessions import flatten_possessions, seconds_per_possession
from statlake.plans import ingest, ledger
from statlake.sinks import tables as sinks
from statlake.sources import landed
from statlake.sources import state as states
from statlake.sources.seeds import read_seeds
from statlake.streaming import deltas, metrics, progress, upserts


def test_bronze(spark, tmp_path):
    df = spark.range(3)
    root = str(tmp_path)
    done = sinks.write_bronze(df, root, "games", "20240101_070000")
    assert (done.rows, done.written) == (3, True)
    assert not sinks.write_bronze(df, root, "games", "20240102_070000", dry_run=True).written
    assert not sinks.write_bronze(df.where("id < 0"), root, "games", "20240103_070000").written
    assert sorted(p.name for p in (tmp_path / "games").iterdir()) == ["run_ts=20240101_070000"]
    sinks.write_bronze(df, root, "games", "20240101_070000")
    assert spark.read.parquet(f"{root}/games").count() == 3


def test_jsonl_keeps_nulls_and_text(spark, tmp_path):
    path = str(tmp_path / "out")
    sinks.write_feed(spark.createDataFrame([("é", None)], "a string, b string"), path)
    lines = [line for f in (tmp_path / "out").glob("part*") for line in f.read_text("utf-8").splitlines()]
    assert lines == ['{"a":"é","b":null}']
    with pytest.raises(Exception, match="already exists"):
        sinks.write_feed(spark.createDataFrame([("é", None)], "a string, b string"), path)


def test_silver_writes_seasons_side_by_side(spark, tmp_path):
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before, path = spark.conf.get(key), str(tmp_path / "silver")
    rows = spark.range(0, 4_000, numPartitions=4).selectExpr(
        "id", f"if(id % 50 = 0, null, cast(id % {2 * sinks.SILVER_WRITERS + 9} as string)) AS season"
    )
    written = []
    real = type(rows).hint

    def hinted(df, *args):
        out = real(df, *args)
        written.append(spark.conf.get(key))
        return out

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(type(rows), "hint", hinted)
        sinks.write_silver(rows, path)
    assert written == [str(sinks.SILVER_WRITERS)] and spark.conf.get(key) == before
    stored = spark.read.schema("id bigint, season string").parquet(path)
    assert sorted(map(str, stored.collect())) == sorted(map(str, rows.collect()))


def test_silver_rewrites_only_touched_seasons(spark, tmp_path):
    path = str(tmp_path / "silver")
    rows = spark.createDataFrame([("1", "a"), ("2", "b")], "id string, season string")
    sinks.write_silver(rows, path)
    sinks.write_silver(spark.createDataFrame([("3", "b")], "id string, season string"), path, only_touched=True)
    got = {(r["id"], r["season"]) for r in spark.read.parquet(path).collect()}
    assert got == {("1", "a"), ("3", "b")}


def test_state(spark, tmp_path):
    path = str(tmp_path / "state.json")
    empty = states.read_state(spark, path)
    assert tuple(empty.first()) == (False, None, {})
    doc = {
        "initial_ingestion_complete": True, "last_successful_run": "2024-01-01",
        "sources": {"a": {"initial_start_date": "2015-10-01", "initial_end_date": "2024-01-01"},
                    "b": {"initial_start_date": "x", "initial_end_date": "y", "status": "complete", "error_count": 2}},
    }
    (tmp_path / "state.json").write_text(json.dumps(doc, indent=2))
    rows = states.state_rows(states.read_state(spark, path)).orderBy("source").collect()
    assert [(r["source"], r["status"], r["error_count"]) for r in rows] == [("a", "pending", 0), ("b", "complete", 2)]
    out = str(tmp_path / "out")
    sinks.write_state(states.state_document(states.state_rows(states.read_state(spark, path))), out)
    again = states.read_state(spark, out).first()
    assert again["initial_ingestion_complete"] and set(again["sources"]) == {"a", "b"}


def test_seeds(spark, tmp_path):
    assert read_seeds(spark, str(tmp_path / "none")).count() == 0
    url = "https://h/player-profiles/2024-2025/a-b/7"
    (tmp_path / "lines.txt").write_text(f'# c\n\n  {url}\n{{"url":"u","player_id":"1"}}\nplain\n{{broken\n')
    rows = {tuple(r) for r in read_seeds(spark, str(tmp_path / "lines.txt")).collect()}
    assert rows == {(url, "7", "a-b", "2024-2025"), ("u", "1", None, None), ("plain", None, None, None), ("{broken", None, None, None)}
    mixed = tmp_path / "mixed"
    mixed.mkdir()
    (mixed / "a.json").write_text(f'# c\n["{url}", {{"url": "x", "player_id": "3"}}, "p", ""]')
    (mixed / "b.txt").write_text('"q"\nr\n')
    rows = {tuple(r) for r in read_seeds(spark, str(mixed)).collect()}
    none = (None, None, None)
    assert rows == {(url, "7", "a-b", "2024-2025"), ("x", "3", None, None), ("p", *none), ("q", *none), ("r", *none)}
    (tmp_path / "list.json").write_text(json.dumps([{"url": "x", "season": "s"}, {"url": "y"}], indent=1))
    assert {tuple(r) for r in read_seeds(spark, str(tmp_path / "list.json")).collect()} == {("x", None, None, "s"), ("y", None, None, None)}


def test_possessions(spark, tmp_path):
    games = [
        {"game_id": "1", "possessions": [
            {"start_time": "12:00", "end_time": "11:40", "offense_team_id": 5, "team_ids": [5, 6],
             "events": [{"period": 1, "score": "0-0"}, {"period": 1, "score": "2-0"}]},
            {"number": 9, "start_time": "bad", "team_ids": [], "previous_possession_ending_event": {"type": "Rebound"}}]},
        {"game_id": "2", "possessions": []},
    ]
    (tmp_path / "g.json").write_text("\n".join(map(json.dumps, games)))
    flat = flatten_possessions(landed.read(spark, "possessions", str(tmp_path / "g.json")))
    rows = flat.orderBy("possession_number").collect()
    assert len(flat.columns) == 19
    first, second = (r.asDict() for r in rows)
    assert (first["possession_number"], first["period"], first["team_ids"], first["event_count"]) == (1.0, 1.0, "5,6", 2.0)
    assert (first["start_score"], first["end_score"]) == ("0-0", "2-0")
    assert (second["possession_number"], second["team_ids"], second["event_count"], second["period"]) == (9.0, None, 0.0, None)
    assert second["previous_possession_ending_event_type"] == "Rebound"
    mean = seconds_per_possession(flat).where("offense_team_id = 5").first()
    assert (mean["possessions"], mean["seconds_per_possession"]) == (1, 20.0)
    bare = spark.createDataFrame([("1", [(3,)])], "game_id string, possessions array<struct<number int>>")
    row = flatten_possessions(bare).first()
    assert (row["possession_number"], row["event_count"], row["start_score"]) == (3.0, 0.0, None)


def test_ingest_goes_on_after_a_failure(spark, tmp_path):
    games = spark.createDataFrame([("1",), (" 1 ",), ("2",)], "game_id string")
    possessions = spark.createDataFrame(
        [("1", [(3,)]), ("9", [(4,)])], "game_id string, possessions array<struct<number int>>"
    )

    def broken():
        raise RuntimeError("down")

    log = ingest.run_ingest(spark, lambda: games, lambda: possessions, str(tmp_path), "r", broken)
    assert [(r["dataset"], r["status"], r["rows"], r["error"]) for r in log.collect()] == [
        ("games", "written", 3, None), ("possessions", "written", 1, None), ("profiles", "failed", 0, "down"),
    ]
    log = ingest.run_ingest(spark, broken, lambda: possessions, str(tmp_path), "r2")
    assert [r["status"] for r in log.collect()] == ["failed", "failed"]


def test_registries(spark, tmp_path):
    landed.register_reader("range", lambda session, path: session.range(2))
    assert landed.read(spark, "range", "").count() == 2
    seen = []
    sinks.register_writer("list", lambda df, path: seen.extend(df.collect()))
    sinks.write(spark.range(2), "list", "")
    assert len(seen) == 2
    del landed.READERS["range"], sinks.WRITERS["list"]


def write_files(spark, rows, schema, path, parts):
    """One file per part, so that a stream sees several batches."""
    for part in parts:
        spark.createDataFrame(rows[part], schema).coalesce(1).write.mode("append").parquet(path)


def test_stream_upsert_equals_batch_after_restart(spark, tmp_path):
    schema = "k string, ord int, a string, b string"
    rows = [(f"k{i % 3}", (i * 7) % 20, f"a{i}", None if i % 4 == 0 else f"b{i}") for i in range(20)]
    path, out = str(tmp_path / "in"), str(tmp_path / "out")

    def run():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
        upserts.start_upserts(stream, out, str(tmp_path / "cp"), ["k"], ["ord"], ["a"], ["b"]).awaitTermination()

    write_files(spark, rows, schema, path, [slice(0, 5), slice(5, 9)])
    run()
    write_files(spark, rows, schema, path, [slice(9, 20)])
    run()
    want = {}
    for k in ("k0", "k1", "k2"):
        own = sorted((r for r in rows if r[0] == k), key=lambda r: r[1])
        want[k] = (own[0][2], own[-1][3])
    assert {r["k"]: (r["a"], r["b"]) for r in upserts.read_upserts(spark, out, ["k"]).collect()} == want
    upserts.compact_upserts(spark, out, str(tmp_path / "compact"), ["k"])
    assert {r["k"]: (r["a"], r["b"]) for r in upserts.read_upserts(spark, str(tmp_path / "compact"), ["k"]).collect()} == want


def test_stream_progress_equals_brute_force_after_restart(spark, tmp_path):
    log = sorted(random_log(3, size=90), key=lambda e: (e["ts"], e["seq"]))
    rows = [tuple(e.values()) for e in log]
    path, out = str(tmp_path / "in"), str(tmp_path / "out")

    def run():  # reads the current ``out``
        stream = spark.readStream.schema(EVENT_SCHEMA).option("maxFilesPerTrigger", 1).option("latestFirst", False).parquet(path)
        progress.start_progress(stream, out, str(tmp_path / "cp"), lambda: time_block("ts", 7)).awaitTermination()

    for part in (slice(0, 30), slice(30, 60), slice(60, 90)):
        write_files(spark, rows, EVENT_SCHEMA, path, [part])
        run()
        compacted = f"{out}-{part.start}"
        progress.compact_progress(spark, out, compacted)
        out = compacted
    assert fold_rows(progress.read_progress(spark, out)) == brute_fold(log)


def test_stream_counts_and_replays(spark, tmp_path):
    schema = "id int, ts timestamp, kind string"
    path = str(tmp_path / "in")
    df = spark.range(100).select(
        (F.col("id") % 40).cast("int").alias("id"),
        F.timestamp_seconds(F.col("id") * 7).alias("ts"),
        F.when(F.col("id") % 2 == 0, "item").otherwise("page").alias("kind"),
    )
    # The oldest rows last, and some once more.
    write_files(spark, df.collect(), schema, path, [slice(60, 100), slice(30, 60), slice(0, 30)])
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    metrics.start_window_counts(stream, str(tmp_path / "c"), str(tmp_path / "cp")).awaitTermination()
    got = {(r["window_start"], r["kind"]): r["n"] for r in metrics.read_window_counts(spark, str(tmp_path / "c")).collect()}
    want = {(r[0], r[1]): r[2] for r in df.groupBy(F.window("ts", "60 seconds")["start"], "kind").count().collect()}
    assert got == want
    out = str(tmp_path / "o")
    metrics.start_without_replays(stream, out, str(tmp_path / "cp2"), ["id"], ["ts"]).awaitTermination()
    once = {r["id"]: r["ts"] for r in metrics.read_without_replays(spark, out, ["id"], ["ts"]).collect()}
    assert once == {r["id"]: r["ts"] for r in df.groupBy("id").agg(F.min("ts").alias("ts")).collect()}
    metrics.start_append(stream, str(tmp_path / "p"), str(tmp_path / "cp3")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "p")).count() == 100


def test_shared_root_follows_the_session(spark):
    from statlake.session import scratch_dir, shared_root

    assert scratch_dir(spark, "x").startswith(shared_root(spark))
    assert spark.conf.get("spark.checkpoint.dir") == shared_root(spark)


def test_no_local_folder_on_a_cluster():
    from types import SimpleNamespace

    from statlake.session import shared_root

    unset = SimpleNamespace(get=lambda *_: None)
    for master in ("spark://h:7077", "yarn", "local-cluster[2,1,512]"):
        context = SimpleNamespace(master=master, getConf=lambda: unset)
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_root(SimpleNamespace(conf=unset, sparkContext=context))


def test_missing_and_broken_are_kept_apart(spark, tmp_path):
    assert deltas.read_deltas(spark, str(tmp_path / "none"), 0) is None
    with pytest.raises(FileNotFoundError):
        deltas.read_deltas(spark, str(tmp_path / "none"), 3)
    with pytest.raises(FileNotFoundError):
        deltas.read_deltas(spark, str(tmp_path / "none"))
    (tmp_path / "state").write_text("x")
    assert states.read_state(spark, str(tmp_path / "none")).first()["sources"] == {}
    table = str(tmp_path / "table")
    deltas.write_delta(spark.range(3), table, 0, ["id"], lambda df: df)
    with pytest.raises(FileNotFoundError, match="batch 1"):
        deltas.read_deltas(spark, table, 3)
    broken = tmp_path / f"table/{deltas.LEVEL}=0/{deltas.BATCH}=1/{deltas.BUCKET}=0"
    broken.mkdir(parents=True)
    (broken / "part.parquet").write_text("no parquet")
    assert deltas.read_deltas(spark, table).count() == 3  # a folder that is not whole does not count
    (broken.parent / "_SUCCESS").write_text("")
    with pytest.raises(Exception, match="(?i)parquet"):
        deltas.read_deltas(spark, table).count()


def test_folders_cover_each_batch_once():
    for before in range(1, 300):
        have = {(level, n) for level in range(5) for n in range(before) if (n + 1) % deltas.FAN**level == 0}
        cover = deltas.covering(have, before)
        held = [b for f in cover for b in range(deltas.first_batch(f), f[1] + 1)]
        assert held == list(range(before))
        assert len(cover) <= (deltas.FAN - 1) * 5
        base = before // 3
        cover = deltas.covering({f for f in have if f[1] > base} | {(deltas.BASE, base)}, before)
        assert cover[0] == (deltas.BASE, base) and [f[1] for f in cover] == sorted(f[1] for f in cover)
        held = [b for f in cover[1:] for b in range(max(base + 1, deltas.first_batch(f)), f[1] + 1)]
        assert held == list(range(base + 1, before))


def test_deltas_fold_and_forget_what_is_folded(spark, tmp_path):
    table, most = str(tmp_path / "t"), 0

    def merge(df):
        return df.groupBy("k").agg(F.sum("n").alias("n"))

    def batch(i):
        return spark.createDataFrame([(i % 3, 1), (7, 1)], "k long, n long")

    for i in range(21):
        for _ in range(1 + (i in (3, 7, 15, 16))):  # some are replayed, also those that end a fold
            deltas.write_delta(batch(i), table, i, ["k"], merge)
        have = deltas.whole_folders(spark, table)
        most = max(most, len(have))
        if i in (2, 3, 4, 15, 16, 20):
            got = {r["k"]: r["n"] for r in merge(deltas.read_deltas(spark, table)).collect()}
            assert got == {**{k: sum(b % 3 == k for b in range(i + 1)) for k in range(min(3, i + 1))}, 7: i + 1}
            before = {r["k"]: r["n"] for r in merge(deltas.read_deltas(spark, table, i)).collect()}
            assert before[7] == i
    assert deltas.covering(have, 21) == [(2, 15), (1, 19), (0, 20)]
    assert most <= 12
    bucket = spark.createDataFrame([(7,)], "k long").select(deltas.bucket_of(["k"])).first()[0]
    only = deltas.read_deltas(spark, table, None, [bucket])
    assert 7 in {r["k"] for r in only.collect()} and "PartitionFilters: [isnotnull(bucket" in only._jdf.queryExecution().toString()


def test_twenty_files_out_of_order(spark, tmp_path):
    schema = "k string, ord int, a string, b string"
    rows = [(f"k{i % 5}", (i * 37) % 101, f"a{i}", None if i % 4 == 0 else f"b{i}") for i in range(100)]
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    write_files(spark, rows, schema, path, [slice(i, i + 5) for i in range(0, 100, 5)])
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    upserts.start_upserts(stream, out, str(tmp_path / "cp"), ["k"], ["ord"], ["a"], ["b"]).awaitTermination()
    want = {}
    for k in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == k), key=lambda r: r[1])
        want[k] = (own[0][2], own[-1][3])
    assert {r["k"]: (r["a"], r["b"]) for r in upserts.read_upserts(spark, out, ["k"]).collect()} == want
    assert len(deltas.covering(deltas.whole_folders(spark, out), 20)) == 2


def test_profiles_keep_all_their_fields(spark):
    rows = [("p", [("s", "c", "5", None, "B", "old", "more")])]
    kind = "array<struct<statistic_name:string,statistic_category:string,value:string,percentile:string,grade:string,raw_data:string,note:string>>"
    df = spark.createDataFrame(rows, f"player_id string, stats {kind}").withColumn(
        "stats", F.transform("stats", lambda s: s.withField("raw_data", F.struct(s["raw_data"].alias("value"), F.lit("x").alias("percentile"), F.lit("y").alias("grade"))))
    )
    out = explode_profiles(normalize_profiles(df, F.lit("2024-01-02 07:00:00"))).first()
    assert (out["note"], tuple(out["raw_data"]), out["value_numeric"]) == ("more", ("old", "x", "y"), 5.0)
    assert str(out["extracted_at"]) == "2024-01-02 07:00:00"


def test_games_between(spark):
    for kind in ("date", "timestamp", "string"):
        df = spark.createDataFrame(
            [("1", "2024-01-31", "2023-24"), ("1", "2024-01-30", "2023-24"), ("2", "2024-02-01", "2023-24")],
            "game_id string, game_date string, season string",
        ).withColumn("game_date", F.col("game_date").cast(kind))
        rows = landed.games_between(df, "2024-01-30", "2024-01-31").collect()
        assert [(r["game_id"], str(r["game_date"])[:10]) for r in rows] == [("1", "2024-01-30")]


GAME = "game_id string, game_date date, season string"


def _resume(spark, root, state, games, run_ts, **options):
    nested = spark.createDataFrame([], "game_id string, possessions array<string>")
    return ingest.run_resumed(spark, state, games, lambda: nested, root, run_ts, days=10, **options)


def _games(spark, n=30):
    days = [datetime.date(2024, 1, 1) + datetime.timedelta(i) for i in range(n)]
    return spark.createDataFrame([(str(i), d, "2023-24") for i, d in enumerate(days)], GAME)


def _new_state(spark, path, sources, end="2024-01-30"):
    doc = {"sources": {s: {"initial_start_date": "2024-01-01", "initial_end_date": end} for s in sources}}
    spark.createDataFrame([(json.dumps(doc),)], "value string").write.text(path)


@pytest.fixture
def no_possessions(monkeypatch):
    monkeypatch.setattr(ingest, "listed_possessions", lambda nested, ids: ids.select("game_id").limit(0))


def _ids(spark, root):
    return sorted(r["game_id"] for r in spark.read.parquet(f"{root}/games").collect())


def test_no_window_is_written_twice_after_a_failure(spark, tmp_path, no_possessions):
    root, state = str(tmp_path / "lake"), str(tmp_path / "state")
    _new_state(spark, state, ["a", "b c"])
    late = F.when(F.col("game_date") >= "2024-01-11", F.raise_error(F.lit("not yet"))).cast("string")
    bad = lambda: _games(spark).withColumn("note", late)
    results = _resume(spark, root, state, {"a": bad, "b c": lambda: _games(spark)}, "r1").orderBy("source").collect()
    assert [(r["source"], r["processed_to"], bool(r["error"])) for r in results] == [("a", "2024-01-10", True), ("b c", "2024-01-30", False)]
    kept = {r["source"]: r for r in states.state_rows(states.read_state(spark, state)).collect()}
    assert (kept["a"]["status"], kept["a"]["last_processed_date"], kept["a"]["error_count"]) == ("in_progress", "2024-01-10", 1)
    assert "not yet" in kept["a"]["last_error"] and kept["b c"]["status"] == "complete"
    good = {s: lambda: _games(spark) for s in ("a", "b c")}
    _resume(spark, root, state, good, "r2")
    _resume(spark, root, state, good, "r3")
    assert _ids(spark, root) == sorted(2 * [str(i) for i in range(30)])
    kept = {r["source"]: r for r in states.state_rows(states.read_state(spark, state)).collect()}
    assert [(r["status"], r["error_count"], r["last_error"]) for r in kept.values()] == [("complete", 1, None), ("complete", 0, None)]


@pytest.mark.parametrize("event", ["written", "started"])
def test_a_lost_driver_forgets_no_window(spark, tmp_path, monkeypatch, no_possessions, event):
    """The driver is lost in the second window: after its rows are there, or before."""
    root, state = str(tmp_path / "lake"), str(tmp_path / "state")
    _new_state(spark, state, ["a"])
    real, seen = ingest.append_event, []

    class Lost(BaseException):
        pass

    def append(*args, **options):
        seen.append(args[5])
        if args[5] == event and seen.count(event) == 2:
            raise Lost
        real(*args, **options)

    monkeypatch.setattr(ingest, "append_event", append)
    with pytest.raises(Lost):
        _resume(spark, root, state, {"a": lambda: _games(spark)}, "r1")
    monkeypatch.setattr(ingest, "append_event", real)
    assert states.state_rows(states.read_state(spark, state)).first()["last_processed_date"] is None
    # The same run started again, then another: the first window is kept, the second is loaded once.
    folder = tmp_path / "lake" / "games" / "run_ts=r1_a_2024-01-01"
    before = sorted(p.name for p in folder.iterdir())
    _resume(spark, root, state, {"a": lambda: _games(spark)}, "r2", target="2024-01-25")
    assert sorted(p.name for p in folder.iterdir()) == before
    assert _ids(spark, root) == sorted(str(i) for i in range(25))
    _resume(spark, root, state, {"a": lambda: _games(spark)}, "r3")
    assert _ids(spark, root) == sorted(str(i) for i in range(30))
    assert states.state_rows(states.read_state(spark, state)).first()["status"] == "complete"


def test_state_is_found_when_its_writer_was_lost(spark, tmp_path):
    path = str(tmp_path / "state")
    _new_state(spark, path, ["a"])
    rows = states.state_rows(states.read_state(spark, path))
    sinks.write_state(states.state_document(rows), str(tmp_path / "other"))
    (tmp_path / "other").rename(tmp_path / "state.next")
    assert states.read_state(spark, path).first()["last_successful_run"] is None
    for f in sorted((tmp_path / "state").iterdir()):
        f.rename(tmp_path / f"gone-{f.name}")
    (tmp_path / "state").rmdir()
    assert states.state_rows(states.read_state(spark, path)).first()["source"] == "a"


def test_written_windows_count_up_to_the_first_gap(spark):
    d = lambda n: datetime.date(2024, 1, n)
    events = [("a", d(1), d(5)), ("a", d(6), d(9)), ("a", d(12), d(20)), ("b", d(3), d(4)), ("b", d(3), d(4)), ("b", d(2), d(8))]
    rows = [(s, x, y, "r", ledger.WRITTEN, "p", 1, None, None) for s, x, y in events]
    rows += [("c", d(1), d(2), "r", ledger.FAILED, "p", 0, "no", "E")]
    got = ledger.written_through(spark.createDataFrame(rows, ledger.EVENT_SCHEMA)).collect()
    assert {r["source"]: r["written_to"].day for r in got} == {"a": 9, "b": 8}


def _nested(spark, n):
    rows = [(f" {i}", [(i, f"0{k}:00") for k in range(i % 3)]) for i in range(n)]
    return spark.createDataFrame(rows, "game_id string, possessions array<struct<number: int, start_time: string>>")


def test_possessions_are_read_once_for_all_windows(spark, tmp_path):
    root, state = str(tmp_path / "lake"), str(tmp_path / "state")
    _new_state(spark, state, ["a", "b c"])
    asked = []

    def possessions():
        asked.append(1)
        return _nested(spark, 30)

    games = {s: lambda: _games(spark) for s in ("a", "b c")}
    results = ingest.run_resumed(spark, state, games, possessions, root, "r1", days=10).collect()
    assert [r["error"] for r in results] == [None, None] and len(asked) == 1
    rows = spark.read.parquet(f"{root}/possessions").collect()
    want = sorted((s, str(i)) for s in games for i in range(30) for _ in range(i % 3))
    assert sorted((r["source"], r["game_id"]) for r in rows) == want
    parts = {(r["run_ts"], r["game_id"]) for r in rows}
    assert parts == {(r["run_ts"], r["game_id"]) for r in spark.read.parquet(f"{root}/games").collect() if int(r["game_id"]) % 3}


def test_possessions_of_games_that_were_not_listed(spark, tmp_path):
    """One source gives more games when it is read again, one cannot be listed, one fails in a window."""
    root, state = str(tmp_path / "lake"), str(tmp_path / "state")
    _new_state(spark, state, ["a", "b", "c"])
    read, first = [], []

    def grows():
        read.append(1)
        return _games(spark, 30 if len(read) > 1 else 5)

    def late():
        first.append(1)
        if len(first) == 1:
            raise ValueError("not yet")
        return _games(spark)

    bad = F.when(F.col("game_date") >= "2024-01-11", F.raise_error(F.lit("broken"))).otherwise(F.col("game_id"))
    games = {"a": grows, "b": late, "c": lambda: _games(spark).withColumn("game_id", bad)}
    results = ingest.run_resumed(spark, state, games, lambda: _nested(spark, 30), root, "r1", days=10)
    assert {r["source"]: (r["processed_to"], bool(r["error"])) for r in results.collect()} == {
        "a": ("2024-01-30", False), "b": ("2024-01-30", False), "c": ("2024-01-10", True),
    }
    rows = spark.read.parquet(f"{root}/possessions").where("source <> 'c' OR game_id < 10").collect()
    want = [(s, str(i)) for s, n in (("a", 30), ("b", 30), ("c", 10)) for i in range(n) for _ in range(i % 3)]
    assert sorted((r["source"], r["game_id"]) for r in rows) == sorted(want)


def test_a_batch_of_one_file_is_folded_by_several_tasks(spark, tmp_path, monkeypatch):
    from statlake.streaming import progress as stream_progress

    schema = ("player_id string, season string, op string, ts timestamp, seq bigint, player_slug string, "
              "player_name string, url string, source string, n bigint, error string")  # fmt: skip
    rows = [("hot", "2023-24", "success", datetime.datetime(2024, 1, 1), i, "s", "n", "u", "x", 1, None) for i in range(200)]
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "log"))
    real, seen = stream_progress.fold_progress, []

    def fold(batch, *rest):
        seen.append([n for n in batch.groupBy(F.spark_partition_id()).count().collect()])
        return real(batch, *rest)

    monkeypatch.setattr(stream_progress, "fold_progress", fold)
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "log"))
    stream_progress.start_progress(stream, str(tmp_path / "out"), str(tmp_path / "checkpoint")).awaitTermination()
    assert len(seen) == 1 and len(seen[0]) > 1
    assert stream_progress.read_progress(spark, str(tmp_path / "out")).first()["stat_count"] == 200
