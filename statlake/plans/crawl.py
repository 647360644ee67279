"""The crawl job: landed pages to stat rows, the stat table and progress."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statlake.functions.text import text_or_null
from statlake.functions.urls import PROFILE_PATH
from statlake.operators.extract.choose import (
    PRIORITY,
    extract_pages,
    identified_rows,
    stat_rows,
    with_identity,
)
from statlake.operators.joins import skip_completed
from statlake.operators.normalize import normalize_stats
from statlake.operators.progress import fold_tries
from statlake.operators.upsert import (
    STAT_IDENTITY,
    STAT_KEY,
    STAT_MEASURES,
    keep_first,
    split_by_key,
    upsert_into,
    upsert_stats,
)
from statlake.session import (
    RELEASED_SHUFFLES,
    remove_path,
    scratch_dir,
    settings,
    staged_rows,
)
from statlake.sinks.tables import write_jsonl, write_silver

NO_STATS = "No stats found"
NO_KEY, NO_SEED = "No player, season or statistic", "No seed names this page"
MANY_SEASONS = 1_000  # beyond so many the seasons are joined instead of named in the plan
# Shuffled bytes a task of the merge is given; its sort holds some ten times as much in memory.
SORTED_BYTES = 16 * 1024 * 1024
ARRIVAL = ["extracted_at", "page_id", "stat_pos"]
EXPORT_COLUMNS = [
    "player_id",
    "player_name",
    "player_slug",
    "player_url",
    "season",
    "statistic_name",
    "statistic_category",
    "value",
    "value_numeric",
    "percentile",
    "percentile_numeric",
    "grade",
    "extraction_source",
    "extracted_at",
    "page_url",
    "is_complete",
    "raw_data",
]


@dataclass(frozen=True)
class CrawlOutput:
    """Where the job has written: JSON lines, the stat table, progress, and what was rejected."""

    export: str
    stats: str
    progress: str
    rejected: str


IDENTITY = ["player_id", "player_slug", "season"]
# Bits of the filter that keeps pages nobody asks for from being read; 1 MB for any number of URLs.
FILTER_BITS = 1 << 23


def seeds_to_do(seeds: DataFrame, progress: DataFrame | None = None) -> DataFrame:
    """One row per URL, of several the one with most of its identity filled, if it is not completed."""
    missing = sum((text_or_null(F.col(c)).isNull().cast("int") for c in IDENTITY), F.lit(0))
    ranked = seeds.select("url", *IDENTITY).withColumn("_missing", missing)
    known = keep_first(ranked, ["url"], ["_missing", *IDENTITY]).drop("_missing")
    return known if progress is None else skip_completed(known, progress)


def likely_pages(pages: DataFrame, seeds: DataFrame, bits: int = FILTER_BITS) -> DataFrame:
    """The pages whose URL may be among the seeds', without moving a page.

    The URLs' hashes are put into bitmaps of a size that is fixed whatever the number of seeds, and
    these are sent to the pages. Few pages pass without being asked for; more do so when the bitmaps
    are full, which costs time and changes nothing.
    """
    place = lambda url: F.pmod(F.xxhash64(url), F.lit(bits))
    maps = seeds.groupBy(F.bitmap_bucket_number(place(F.col("url"))).alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place(F.col("url")))).alias("_bits")
    )
    asked = pages.withColumn("_place", place(F.col("url")))
    asked = asked.withColumn("_bucket", F.bitmap_bucket_number("_place"))
    asked = asked.join(F.broadcast(maps), "_bucket").withColumn("_bit", F.bitmap_bit_position("_place"))
    byte = F.expr("conv(hex(substring(_bits, cast(_bit div 8 as int) + 1, 1)), 16, 10)").cast("int")
    hit = asked.withColumn("_byte", byte).where("shiftright(_byte, cast(_bit % 8 as int)) & 1 = 1")
    return hit.select(*pages.columns)


def progress_events(
    extracted: DataFrame, run_ts: Column, pattern: str = PROFILE_PATH
) -> DataFrame:
    """Two events per page: started, then completed with its count, or failed."""
    page = with_identity(extracted, pattern)
    n = F.size("stats")
    nothing = F.lit(None).cast("string")

    def event(op: Column, place: int, source: Column, count: Column, error: Column) -> Column:
        return F.struct(
            op.alias("op"),
            F.lit(place).alias("place"),
            source.alias("source"),
            count.cast("bigint").alias("n"),
            error.alias("error"),
        )

    start = event(F.lit("started"), 0, nothing, F.lit(None), nothing)
    end = event(
        F.when(n > 0, "completed").otherwise("failed"),
        1,
        F.when(n > 0, F.col("source")),
        F.when(n > 0, n),
        F.when(n == 0, F.lit(NO_STATS)),
    )
    return (
        page.select("*", F.explode(F.array(start, end)).alias("_e"))
        .select(
            "player_id",
            "season",
            "_e.op",
            run_ts.cast("timestamp").alias("ts"),
            (F.col("page_id") * 2 + F.col("_e.place")).alias("seq"),
            "player_slug",
            F.lit(None).cast("string").alias("player_name"),
            "url",
            F.col("_e.source").alias("source"),
            F.col("_e.n").alias("n"),
            F.col("_e.error").alias("error"),
        )
        .where(text_or_null(F.col("player_id")).isNotNull() & text_or_null(F.col("season")).isNotNull())
    )


def progress_tries(identified: DataFrame, run_ts: Column) -> DataFrame:
    """One row per page ``with_identity``, ``n_stats`` and a key: both ``progress_events`` of it as one try."""
    n = F.col("n_stats")
    return identified.select(
        "player_id",
        "season",
        run_ts.cast("timestamp").alias("ts"),
        F.col("page_id").alias("seq"),
        "player_slug",
        F.lit(None).cast("string").alias("player_name"),
        "url",
        F.when(n > 0, F.col("source")).alias("source"),
        F.when(n > 0, n).cast("bigint").alias("n"),
        F.when(n == 0, F.lit(NO_STATS)).alias("error"),
        (n > 0).alias("done"),
    ).where((F.col("player_id") != "") & (F.col("season") != ""))


def clean_rows(
    pages: DataFrame, run_ts: Column, responses: DataFrame | None = None,
    pattern: str = PROFILE_PATH, priority: list[str] | None = None,
) -> DataFrame:
    """Pages to cleaned stat rows."""
    extracted = extract_pages(pages, responses, priority or PRIORITY)
    return normalize_stats(stat_rows(extracted, run_ts, pattern))


def run_crawl(
    spark: SparkSession, pages: DataFrame, out: str, run_ts: str,
    responses: DataFrame | None = None, seeds: DataFrame | None = None,
    progress: DataFrame | None = None, stats: DataFrame | str | None = None,
    pattern: str = PROFILE_PATH, priority: list[str] | None = None,
) -> CrawlOutput:
    """Extract, clean and store landed pages.

    ``progress`` and ``stats`` are the tables of the run before; the new ones go to ``out``,
    which must be a new place. With ``stats`` as a path that table is brought up to date where it is,
    season by season. What was extracted, and who it is about, is written once to the shared folder, and
    the outputs are made from that table: a lost executor costs a stage and not the extraction. Each output's
    shuffle files go when it is written.
    """
    with settings(spark, RELEASED_SHUFFLES):
        stamp = F.lit(run_ts).cast("timestamp")
        todo = None
        if seeds is not None:
            # Used by the filter of pages and by the join behind it.
            asked = scratch_dir(spark, "seeds")
            seeds_to_do(seeds, progress).write.parquet(asked)
            todo = spark.read.parquet(asked)
        read = pages if todo is None else likely_pages(pages, todo)
        found = extract_pages(read, responses, priority or PRIORITY)
        if todo is not None:
            # Joined after the HTML has been read where it lies, so that no page moves.
            found = found.join(todo, "url")
        staged = scratch_dir(spark, "extracted")
        with_identity(found, pattern).withColumn("n_stats", F.size("stats")).write.parquet(staged)
        if todo is not None:
            remove_path(spark, asked)
        identified = spark.read.parquet(staged)

        rows = normalize_stats(identified_rows(identified, stamp))
        place = stats if isinstance(stats, str) else f"{out}/stats"
        result = CrawlOutput(f"{out}/export", place, f"{out}/progress", f"{out}/rejected")
        write_jsonl(rows.select(*EXPORT_COLUMNS), result.export, compression="gzip")

        valid, invalid = split_by_key(rows, STAT_KEY)
        rejected = invalid.select(
            "page_id", F.col("page_url").alias("url"), F.lit(NO_KEY).alias("reason")
        )
        if seeds is not None:
            unnamed = pages.select("page_id", "url").join(seeds.select("url"), "url", "left_anti")
            rejected = rejected.unionByName(unnamed.withColumn("reason", F.lit(NO_SEED)))
        write_jsonl(rejected, result.rejected, compression="gzip")

        write_stats(valid, stats, place)

        folded = fold_tries(progress_tries(identified, stamp), order_by=["ts", "seq"], current=progress)
        folded.write.parquet(result.progress)
        remove_path(spark, staged)
        return result


def write_stats(valid: DataFrame, stats: DataFrame | str | None, place: str) -> None:
    """Merge rows into the stat table at ``place``.

    With the path of a table only the seasons that ``valid`` has rows for are read and replaced.
    The merged rows are written to the shared folder first: a table cannot be read while it is replaced,
    tasks of the silver write's size would sort far more rows than memory holds, and the shuffle files of the
    merge go before those of the silver write come. A run that breaks in between can be repeated.
    """
    if stats is None:
        merged = upsert_stats(valid, ARRIVAL)
    else:
        old = stats if isinstance(stats, DataFrame) else touched_seasons(valid, stats)
        merged = upsert_into(old, valid, STAT_KEY, ARRIVAL, STAT_IDENTITY, STAT_MEASURES)
    sized = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": str(SORTED_BYTES)}
    with settings(valid.sparkSession, sized), staged_rows(merged, "stats") as rows:
        write_silver(rows, place, only_touched=isinstance(stats, str))


def touched_seasons(valid: DataFrame, stats: str) -> DataFrame:
    """The rows of the stat table whose seasons ``valid`` has rows for."""
    touched = valid.select("season").distinct()
    few = [r["season"] for r in touched.limit(MANY_SEASONS + 1).collect()]
    old = valid.sparkSession.read.parquet(stats).withColumn("season", F.col("season").cast("string"))
    if len(few) <= MANY_SEASONS:
        return old.where(F.col("season").isin(few))
    return old.join(touched, "season", "left_semi")
