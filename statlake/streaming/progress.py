"""The progress fold over a stream of events."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from statlake.operators.progress import (
    BLOCK_EVENTS,
    PROGRESS_COLUMNS,
    PROGRESS_KEY,
    fold_progress,
)
from statlake.streaming.deltas import (
    BATCH,
    BUCKET,
    bucket_of,
    last_batch,
    read_deltas,
    write_base,
    write_delta,
)

def _latest(deltas: DataFrame) -> DataFrame:
    rest = [c for c in PROGRESS_COLUMNS if c not in PROGRESS_KEY]
    newest = deltas.groupBy(*PROGRESS_KEY).agg(F.max_by(F.struct(*rest), BATCH).alias("_r"))
    return newest.select(*PROGRESS_KEY, "_r.*")


def start_progress(
    stream: DataFrame, path: str, checkpoint: str, block: Callable[[], Column] | int = BLOCK_EVENTS,
    order_by: tuple[str, ...] = ("ts", "seq"),
) -> StreamingQuery:
    """Fold each micro-batch onto the rows of earlier ones, and write the keys it touched.

    A state store per key would see all events of a key in one task; the batch fold splits them.
    Only folders before this batch are read, of the buckets it has keys in, so a replay gives the same
    rows.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        spark, current = batch.sparkSession, None
        # A batch may be one file, which one task reads; what is to be folded is spread by all of its order, since
        # a key may be hot.
        batch = batch.repartition(spark.sparkContext.defaultParallelism, *PROGRESS_KEY, *order_by)
        batch = batch.persist()  # its keys, their blocks and the fold read it
        if batch_id > 0:
            touched = batch.select(*PROGRESS_KEY).distinct()
            own = touched.select(bucket_of(PROGRESS_KEY).alias(BUCKET)).distinct().collect()
            earlier = read_deltas(spark, path, batch_id, [r[BUCKET] for r in own])
            current = _latest(earlier.join(touched, PROGRESS_KEY, "left_semi"))
        blocks = block if isinstance(block, int) else block()
        folded = fold_progress(batch, blocks, order_by, current)
        write_delta(folded, path, batch_id, PROGRESS_KEY, _latest)
        batch.unpersist()

    return (
        stream.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """One current row per key."""
    return _latest(read_deltas(spark, path))


def compact_progress(spark: SparkSession, path: str, into: str) -> None:
    """Fold all folders into one at a new path, under the last batch number.

    The stream goes on from its checkpoint with the new path.
    """
    write_base(_latest(read_deltas(spark, path)), into, last_batch(spark, path), PROGRESS_KEY)
