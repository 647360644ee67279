"""Incremental bronze to silver: the partial-merge upsert over a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from statlake.operators.ordered import order_struct, with_keys
from statlake.streaming.deltas import last_batch, read_deltas, write_base, write_delta


def _merge(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.min_by("_first", "_first_at").alias("_first"),
        F.min("_first_at").alias("_first_at"),
        F.max_by("_last", "_last_at").alias("_last"),
        F.max("_last_at").alias("_last_at"),
    )


def _summarize(
    rows: DataFrame, keys: Sequence[str], order_by: Sequence[str],
    first_wins: Sequence[str], last_wins: Sequence[str],
) -> DataFrame:
    """One row per key that still knows when its values were set, so that summaries merge."""
    at = order_struct(order_by)
    return _merge(
        rows.select(
            *keys,
            F.struct(*first_wins).alias("_first"),
            at.alias("_first_at"),
            F.struct(*last_wins).alias("_last"),
            at.alias("_last_at"),
        ),
        keys,
    )


def start_upserts(
    stream: DataFrame, path: str, checkpoint: str, keys: Sequence[str],
    order_by: Sequence[str], first_wins: Sequence[str], last_wins: Sequence[str],
) -> StreamingQuery:
    """Upsert everything available. The order columns decide, not the order of arrival, so late
    files and any split into batches give the same table."""

    def each(batch: DataFrame, batch_id: int) -> None:
        rows = _summarize(with_keys(batch, keys), keys, order_by, first_wins, last_wins)
        write_delta(rows, path, batch_id, keys, lambda df: _merge(df, keys))

    return (
        stream.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_upserts(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The table as of the last micro-batch."""
    merged = _merge(read_deltas(spark, path), keys)
    return merged.select(*keys, "_first.*", "_last.*")


def compact_upserts(spark: SparkSession, path: str, into: str, keys: Sequence[str]) -> None:
    """Fold all folders into one at a new path, under the last batch number.

    The stream goes on from its checkpoint with the new path.
    """
    write_base(_merge(read_deltas(spark, path), keys), into, last_batch(spark, path), keys)
