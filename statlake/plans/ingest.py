"""The ingest job: datasets in order, each on its own feet, with a run log."""

from __future__ import annotations

import datetime
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statlake.functions.text import strip
from statlake.operators.joins import only_listed
from statlake.operators.possessions import flatten_possessions
from statlake.operators.upsert import clean_ids
from statlake.plans.ledger import (
    FAILED,
    STARTED,
    WRITTEN,
    append_event,
    fold_ledger,
    orphans,
    path_key,
    read_ledger,
    written_through,
)
from statlake.plans.windows import WINDOW_DAYS, resume_windows
from statlake.session import remove_path, scratch_dir
from statlake.sinks.tables import write_bronze, write_state
from statlake.sources.landed import games_between, in_range
from statlake.sources.state import read_state, state_document, state_rows

RUN_LOG_SCHEMA = (
    "dataset string, status string, rows bigint, path string, error string, error_class string"
)

# Names of the datasets.
GAMES, POSSESSIONS, PROFILES = "games", "possessions", "profiles"


@dataclass(frozen=True)
class Stage:
    """A dataset and how to get its frame. Building and writing may both fail."""

    dataset: str
    build: Callable[[], DataFrame]


def run_stages(
    spark: SparkSession, stages: Sequence[Stage], root: str, run_ts: str, dry_run: bool = False
) -> DataFrame:
    """Write each dataset in turn; one that fails does not stop the others. Gives the run log."""
    log = []
    for stage in stages:
        try:
            done = write_bronze(stage.build(), root, stage.dataset, run_ts, dry_run)
            status = "written" if done.written else ("dry_run" if done.rows else "empty")
            log.append((stage.dataset, status, done.rows, done.path, None, None))
        except Exception as exc:
            said = (str(exc).splitlines() or [""])[0]
            log.append((stage.dataset, "failed", 0, None, said, type(exc).__name__))
    return spark.createDataFrame(log, RUN_LOG_SCHEMA)


def game_ids(games: DataFrame) -> DataFrame:
    """Cleaned distinct ids of the games."""
    ids = games.select(F.col("game_id").cast("string"), F.lit(0).alias("pos"))
    return clean_ids(ids, "game_id", "pos").select("game_id")


def listed_possessions(nested: DataFrame, games: DataFrame) -> DataFrame:
    """Flat possessions of the games loaded in this run."""
    keyed = nested.withColumn("game_id", F.trim(F.col("game_id").cast("string")))
    return flatten_possessions(only_listed(keyed, game_ids(games), "game_id"))


def run_ingest(
    spark: SparkSession, games: Callable[[], DataFrame], possessions: Callable[[], DataFrame],
    root: str, run_ts: str, profiles: Callable[[], DataFrame] | None = None,
    dry_run: bool = False,
) -> DataFrame:
    """Games, the possessions of the games this run has written, and profiles if given."""

    def written_games() -> DataFrame:
        # A source read once more might give other games; a dry run has written none.
        path = f"{root}/{GAMES}/run_ts={run_ts}"
        return games() if dry_run else spark.read.parquet(path)

    stages = [
        Stage(GAMES, games),
        Stage(POSSESSIONS, lambda: listed_possessions(possessions(), written_games())),
    ]
    if profiles is not None:
        stages.append(Stage(PROFILES, profiles))
    return run_stages(spark, stages, root, run_ts, dry_run)


RESULT_SCHEMA = "source string, processed_to string, run_ts string, error string, error_class string"
SOURCES_AT_ONCE = 8


STAGED_FROM = 3  # windows; with fewer the possessions are read as they are
Day = datetime.date


class StagedPossessions:
    """Possessions dealt to the windows of a run, so that a window does not read those of all others.

    The games of all windows are listed and joined to the possessions once; what a window's games may have is a
    folder of its own below the shared folder. A window whose games are not all on its list (a source may give
    other games when it is read again), or could not be listed or dealt, reads all possessions.
    """

    def __init__(self, spark: SparkSession, possessions: Callable[[], DataFrame]):
        self.spark, self.possessions = spark, possessions
        self.path = scratch_dir(spark, "staged-possessions")
        self.listed: DataFrame | None = None
        self.dealt: DataFrame | None = None

    def deal(self, games: dict[str, Callable[[], DataFrame]], parts: dict[str, dict[str, tuple[Day, Day]]]) -> None:
        """``parts``: the part of each window of each source."""
        paths = []
        for n, (source, windows) in enumerate(parts.items()):
            try:
                self.list_games(games[source](), windows).write.parquet(f"{self.path}/ids/{n}")
                paths.append(f"{self.path}/ids/{n}")
            except Exception:  # the source's own windows will say what is wrong
                continue
        if not paths:
            return
        try:
            listed = self.spark.read.schema("game_id string, part string").parquet(*paths)
            nested = self.possessions()
            rows = nested.select(F.trim(F.col("game_id").cast("string")).alias("game_id"), F.struct("*").alias("nested"))
            dealt = rows.join(listed, "game_id").select("part", "nested").hint("rebalance", "part")
            dealt.write.partitionBy("part").parquet(f"{self.path}/rows")
            schema = dealt.select("nested", "part").schema
            self.dealt = self.spark.read.schema(schema).parquet(f"{self.path}/rows")
            self.listed = listed
        except Exception:
            self.dealt = self.listed = None

    @staticmethod
    def list_games(games: DataFrame, windows: dict[str, tuple[Day, Day]]) -> DataFrame:
        """(game_id, part) of the games of the windows, each once."""
        own = [F.when(in_range(games, "game_date", str(a), str(b)), F.lit(part)) for part, (a, b) in windows.items()]
        listed = games.select(strip("game_id").alias("game_id"), F.explode(F.array_compact(F.array(*own))).alias("part"))
        return listed.where("game_id <> ''").distinct()

    def of(self, part: str, games: DataFrame) -> DataFrame:
        """All that the games of a part may have."""
        if self.dealt is None:
            return self.possessions()
        known = self.listed.where(F.col("part") == part)
        if not game_ids(games).join(known, "game_id", "left_anti").isEmpty():
            return self.possessions()
        return self.dealt.where(F.col("part") == part).select("nested.*")


def load_window(
    spark: SparkSession, frame: DataFrame, possessions: Callable[[str, DataFrame], DataFrame], root: str,
    source: str, window: tuple[Day, Day], part: str,
) -> int:
    """Games and possessions of one window of one source into its part; how many games.

    ``possessions`` gives those of a part and its games.
    """
    own = games_between(frame, str(window[0]), str(window[1])).withColumn("source", F.lit(source))
    games = write_bronze(own, root, GAMES, part)
    if games.written:
        ids = spark.read.parquet(games.path)
        flat = listed_possessions(possessions(part, ids), ids).withColumn("source", F.lit(source))
        write_bronze(flat, root, POSSESSIONS, part)
    return games.rows


def remove_orphans(spark: SparkSession, ledger: DataFrame, root: str) -> None:
    """Remove the rows of windows that a lost or failed run has left unfinished: a few parts."""
    for row in orphans(ledger).collect():
        for dataset in (GAMES, POSSESSIONS):
            remove_path(spark, f"{root}/{dataset}/run_ts={row['part']}")


def save_state(spark: SparkSession, state_path: str, ledger_path: str) -> DataFrame:
    """Fold the ledger into the state document; gives the state rows."""
    rows = fold_ledger(state_rows(read_state(spark, state_path)), read_ledger(spark, ledger_path))
    # A document of a few rows, which must be read to its end before it is replaced.
    kept = spark.createDataFrame(rows.collect(), rows.schema)
    write_state(state_document(kept), state_path)
    return kept


def run_resumed(
    spark: SparkSession, state_path: str, games: dict[str, Callable[[], DataFrame]],
    possessions: Callable[[], DataFrame], root: str, run_ts: str, target: str | None = None,
    days: int = WINDOW_DAYS, ledger_path: str | None = None,
) -> DataFrame:
    """Load what state and ledger leave, window by window, and save the state.

    ``games`` gives the frame of each source. A window that is written is entered in the ledger at
    once and never written again, whatever becomes of the windows behind it, of other sources or of
    the driver; what a window left unfinished is removed before it is repeated. A source whose
    window fails goes no further in this run and counts an error. Sources are independent of each
    other and their jobs run side by side. The windows are a short list on the driver. The possessions
    are dealt to the windows once, so they are not read by each of them. Gives the results by source.
    """
    ledger_path = ledger_path or f"{state_path}.ledger"
    ledger = read_ledger(spark, ledger_path)
    remove_orphans(spark, ledger, root)
    rows = save_state(spark, state_path, ledger_path)
    end = None if target is None else F.lit(target)
    planned = resume_windows(rows, end, days, written=written_through(ledger))
    windows: dict[str, list[tuple[datetime.date, datetime.date]]] = {}
    for w in planned.where(F.col("source").isin(list(games))).orderBy("source", "window_start").collect():
        windows.setdefault(w["source"], []).append((w["window_start"], w["window_end"]))
    part_of = lambda source, window: f"{run_ts}_{path_key(source)}_{window[0]}"
    staged = StagedPossessions(spark, possessions)
    if sum(map(len, windows.values())) >= STAGED_FROM:
        staged.deal(games, {s: {part_of(s, w): w for w in own} for s, own in windows.items()})

    def load(source: str) -> tuple:
        frame, done = None, None
        for window in windows[source]:
            part = part_of(source, window)
            note = partial(append_event, spark, ledger_path, source, window, run_ts)
            try:
                note(STARTED, part)
                frame = games[source]() if frame is None else frame
                n = load_window(spark, frame, staged.of, root, source, window, part)
            except Exception as exc:
                note(FAILED, part, error=exc)
                return source, done, run_ts, (str(exc).splitlines() or [""])[0], type(exc).__name__
            note(WRITTEN, part, n)
            done = str(window[1])
        return source, done, run_ts, None, None

    with ThreadPoolExecutor(SOURCES_AT_ONCE) as pool:
        jobs = [pool.submit(inheritable_thread_target(spark)(partial(load, s))) for s in windows]
        results = [job.result() for job in jobs]
    remove_path(spark, staged.path)
    save_state(spark, state_path, ledger_path)
    return spark.createDataFrame(results, RESULT_SCHEMA)
