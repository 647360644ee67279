"""Writers over any path Spark can reach. A path that is read is never overwritten."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from statlake.session import move_path, next_state, remove_path, settings

# Target size of silver files, and their partition column.
SILVER_FILE_BYTES = 512 * 1024 * 1024
SILVER_PARTITION = "season"
# Files a task of a silver write keeps open at once; rows of more partitions are sorted by Spark.
SILVER_WRITERS = 16


@dataclass(frozen=True)
class WriteResult:
    dataset: str
    path: str
    rows: int
    written: bool


def write_bronze(
    df: DataFrame, root: str, dataset: str, run_ts: str, dry_run: bool = False
) -> WriteResult:
    """Write a run's rows to ``<root>/<dataset>/run_ts=<run_ts>``; nothing for an empty frame.

    A run owns its folder, so a repeated run replaces its own rows and adds none twice.
    """
    path = f"{root}/{dataset}/run_ts={run_ts}"
    if dry_run:
        return WriteResult(dataset, path, df.count(), False)
    # Counted while it is written: a test for emptiness first would run most of the plan twice.
    seen = Observation(f"bronze_{dataset}")
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(path)
    rows = seen.get["n"]
    if rows == 0:
        remove_path(df.sparkSession, path)
    return WriteResult(dataset, path, rows, rows > 0)


def write_jsonl(
    df: DataFrame, path: str, mode: str = "overwrite", compression: str = "none"
) -> None:
    """One JSON object per row; NULL fields are kept, text is written as it is.

    With a ``compression`` (``gzip``) the lines are the same, and readers know the codec by the files'
    names. It is done at the fastest level: field names and URLs repeat, so that is most of the gain.
    """
    writer = df.write.mode(mode).option("ignoreNullFields", "false")
    writer.option("zlib.compress.level", "BEST_SPEED").option("compression", compression).json(path)


def write_feed(df: DataFrame, path: str) -> None:
    """JSON lines to a place that must be new."""
    write_jsonl(df, path, mode="errorifexists")


def write_silver(
    df: DataFrame, path: str, partition: str = SILVER_PARTITION,
    file_bytes: int = SILVER_FILE_BYTES, only_touched: bool = False,
) -> None:
    """Partitioned Parquet with files near the target size.

    The rebalance lets AQE join small and split large partitions, so a season with a large share
    of the rows becomes many files written by many tasks. ``only_touched`` replaces just the
    partitions that ``df`` has rows for. A task has few seasons and writes them side by side: to write
    them in turn Spark would sort all its rows, which are several times the target size in memory.
    """
    wanted = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(file_bytes),
        "spark.sql.maxConcurrentOutputFileWriters": str(SILVER_WRITERS),
    }
    with settings(df.sparkSession, wanted):
        writer = df.hint("rebalance", partition).write.mode("overwrite").partitionBy(partition)
        writer.option(
            "partitionOverwriteMode", "dynamic" if only_touched else "static"
        ).parquet(path)


def write_state(document: DataFrame, path: str) -> None:
    """The one-row state document as JSON.

    It is written whole beside the old one and then takes its place, so a driver that is lost on the
    way leaves one of them, which ``read_state`` finds.
    """
    spark, new = document.sparkSession, next_state(path)
    document.coalesce(1).write.mode("overwrite").option("ignoreNullFields", "false").json(new)
    move_path(spark, new, path)


def write_payloads(payloads: DataFrame, path: str) -> None:
    """Raw payloads beside the parsed rows, by source."""
    payloads.write.mode("overwrite").partitionBy("source").parquet(path)


WRITERS: dict[str, Callable[..., object]] = {
    "jsonl": write_jsonl,
    "feed": write_feed,
    "silver": write_silver,
    "payloads": write_payloads,
}


def register_writer(name: str, writer: Callable[..., object]) -> None:
    """Make a further output known under a name."""
    WRITERS[name] = writer


def write(df: DataFrame, name: str, path: str, **options) -> None:
    WRITERS[name](df, path, **options)
