"""Event-time counts and replay-safe ingestion."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from statlake.operators.upsert import keep_first
from statlake.streaming.deltas import BATCH, read_deltas, write_delta


def window_counts(
    entries: DataFrame, ts: str = "ts", kind: str = "kind", interval: str = "60 seconds"
) -> DataFrame:
    """Entries by tumbling window and kind. ``ts`` must be a TIMESTAMP."""
    return (
        entries.groupBy(F.window(ts, interval), kind)
        .agg(F.count("*").alias("n"))
        .select(F.col("window.start").alias("window_start"), kind, "n")
    )


def start_window_counts(
    stream: DataFrame, path: str, checkpoint: str, ts: str = "ts", kind: str = "kind",
    interval: str = "60 seconds",
) -> StreamingQuery:
    """Write the counts of each micro-batch. They add up on reading, so rows may be as late as they
    like, and nothing is kept between batches."""

    def each(batch: DataFrame, batch_id: int) -> None:
        counts = window_counts(batch, ts, kind, interval)
        write_delta(counts, path, batch_id, ["window_start", kind], lambda df: _summed(df, kind))

    return _run(stream, each, checkpoint)


def read_window_counts(spark: SparkSession, path: str, kind: str = "kind") -> DataFrame:
    """The count of each window over all micro-batches."""
    return _summed(read_deltas(spark, path), kind)


def _summed(counts: DataFrame, kind: str) -> DataFrame:
    return counts.groupBy("window_start", kind).agg(F.sum("n").alias("n"))


def start_without_replays(
    stream: DataFrame, path: str, checkpoint: str, keys: Sequence[str], order_by: Sequence[str]
) -> StreamingQuery:
    """Write each micro-batch with the first row of each key in the order.

    A replay of a key is dropped on reading, however late it comes; no state grows with the keys.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        first = lambda df: keep_first(df.drop(BATCH), keys, order_by)
        write_delta(first(batch), path, batch_id, keys, first)

    return _run(stream, each, checkpoint)


def read_without_replays(
    spark: SparkSession, path: str, keys: Sequence[str], order_by: Sequence[str]
) -> DataFrame:
    """Each key once: its first row in the order over all micro-batches."""
    return keep_first(read_deltas(spark, path).drop(BATCH), keys, order_by)


def _run(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def start_append(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append everything available as Parquet, exactly once."""
    return (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
