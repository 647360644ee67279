"""Consecutive-failure breaker: what a batch yields before it is stopped."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statlake.operators.ordered import (
    BLOCK,
    block_window,
    blocks_window,
    order_struct,
    with_blocks,
)


def rows_before_stop(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str], block: Column | int,
    status: str = "status", max_failures: int = 5,
    ok: str = "ok", fail: str = "fail",
) -> DataFrame:
    """The ``ok`` rows of each batch that come before its ``max_failures``-th failure in a row.

    An ``ok`` row ends a run of failures; rows of any other status neither end nor lengthen it.
    A run may cross blocks: each block reports the failures at its head and tail, and the run
    that enters a block is worked out from those reports.
    """
    if max_failures < 1:
        raise ValueError("max_failures must be at least 1")
    is_ok = F.coalesce((F.col(status) == ok).cast("int"), F.lit(0))
    is_fail = F.coalesce((F.col(status) == fail).cast("int"), F.lit(0))
    inside = block_window(keys, order_by).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    d = (
        with_blocks(df, keys, order_by, block)
        .withColumns({"_ok": is_ok, "_fail": is_fail})
        .withColumns({"_oks": F.sum("_ok").over(inside), "_fails": F.sum("_fail").over(inside)})
        .withColumn(
            "_run",
            F.col("_fails")
            - F.coalesce(
                F.last(F.when(F.col("_ok") == 1, F.col("_fails")), ignorenulls=True).over(inside),
                F.lit(0),
            ),
        )
    )
    summary = d.groupBy(*keys, BLOCK).agg(
        F.sum("_ok").alias("_n_ok"),
        F.sum("_fail").alias("_n_fail"),
        F.max_by("_run", order_struct(order_by)).alias("_tail"),
        F.max(F.when(F.col("_oks") == 0, F.col("_fails")).otherwise(0)).alias("_head"),
        F.max("_run").alias("_longest"),
    )
    along = blocks_window(keys)
    upto = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        summary.withColumn("_total", F.sum("_n_fail").over(upto))
        .withColumn("_base", F.when(F.col("_n_ok") > 0, F.col("_total") - F.col("_tail")))
        .withColumn(
            "_enter",
            F.col("_total")
            - F.col("_n_fail")
            - F.coalesce(F.last("_base", ignorenulls=True).over(earlier), F.lit(0)),
        )
        .withColumn(
            "_hit",
            (F.col("_longest") >= max_failures)
            | ((F.col("_head") > 0) & (F.col("_head") + F.col("_enter") >= max_failures)),
        )
        .withColumn("_stopped", F.coalesce(F.max("_hit").over(earlier), F.lit(False)))
        .select(*keys, BLOCK, "_enter", "_stopped")
    )
    run = F.col("_run") + F.when(F.col("_oks") == 0, F.col("_enter")).otherwise(0)
    return (
        d.join(carried, [*keys, BLOCK])
        .withColumn("_hit", (F.col("_fail") == 1) & (run >= max_failures))
        .withColumn("_hits", F.max("_hit").over(inside))
        .where((F.col("_ok") == 1) & ~F.col("_stopped") & ~F.col("_hits"))
        .select(*df.columns)
    )
