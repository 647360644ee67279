"""Ordered work per key that holds up when one key has a large share of all rows.

A plain window over a key puts every row of that key in one task. Here the rows of a key are
split into *blocks*, stretches of the order that follow one another: windows run inside a block,
one summary row per block carries what earlier blocks leave behind, and the summary is joined
back. A block is given as a number of rows it is to hold (``row_blocks``), or as a column that
never falls as the order rises, so each retry of a task computes the same ones.

``order_by`` is always a total order within a key, all ascending. Keys must not be NULL.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statlake.functions.text import as_column
from statlake.session import scratch_dir

BLOCK = "_block"
DRAWN = 64  # rows drawn for each half block, from which bounds are taken


def check_order(order_by: Sequence[str]) -> None:
    if not order_by:
        raise ValueError("order_by must name at least one column")


def with_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with all key columns. (``dropna`` means the same but is not pushed to the scan.)"""
    for key in keys:
        df = df.where(F.col(key).isNotNull())
    return df


def order_struct(order_by: Sequence[str]) -> Column:
    """The order as one comparable value."""
    check_order(order_by)
    return F.struct(*[F.col(c) for c in order_by])


def time_block(ts: Column | str, seconds: int) -> Column:
    """Blocks of fixed length in time."""
    return F.floor(F.unix_micros(as_column(ts).cast("timestamp")) / (seconds * 1_000_000))


def number_block(n: Column | str, width: int) -> Column:
    """Blocks of fixed width of a number, such as a position."""
    return F.floor(as_column(n) / F.lit(width))


def row_blocks(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], rows: int) -> DataFrame:
    """Add ``_block``: stretches of a key's order, none with more than about ``rows`` rows.

    Only keys with more rows than that are split. Of these a share of the rows, drawn by a hash, is
    sorted, and every so many drawn rows begin a block; they are as far apart as half of ``rows``, so
    the chance of a block beyond it is negligible however the order is spread. The bounds are written
    below the shared folder, a row for each split key, so that every use and retry sees the same;
    Spark broadcasts them if they are small.
    """
    if rows < 1:
        raise ValueError("a block must hold at least one row")
    large = df.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > rows).select(*keys)
    if large.isEmpty():
        return df.withColumn(BLOCK, F.lit(0).cast("long"))
    every = max(1, rows // (2 * DRAWN))
    drawn = df.where(F.pmod(F.xxhash64(*keys, *order_by), F.lit(every)) == 0)
    step = max(1, rows // (2 * every))
    places = F.sequence(F.lit(step), F.size("_drawn"), F.lit(step))
    begin = F.when(F.size("_drawn") >= step, F.transform(places, lambda i: F.element_at("_drawn", i)))
    bounds = drawn.join(large, list(keys), "left_semi").groupBy(*keys).agg(
        F.sort_array(F.collect_list(order_struct(order_by))).alias("_drawn")
    )
    path = scratch_dir(df.sparkSession, "block-bounds")
    bounds.select(*keys, begin.alias("_begin")).write.parquet(path)
    known = df.sparkSession.read.parquet(path)
    place = F.size(F.filter("_begin", lambda b: b <= order_struct(order_by))).cast("long")
    return df.join(known, list(keys), "left").select(
        *df.columns, F.when(F.col("_begin").isNull(), 0).otherwise(place).alias(BLOCK)
    )


def with_blocks(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str], block: Column | int
) -> DataFrame:
    """Add ``_block``, from a column or as stretches of so many rows."""
    if isinstance(block, int):
        return row_blocks(df, keys, order_by, block)
    return df.withColumn(BLOCK, block)


def block_window(keys: Sequence[str], order_by: Sequence[str]):
    """Window inside one block of one key."""
    check_order(order_by)
    return Window.partitionBy(*keys, BLOCK).orderBy(*order_by)


def blocks_window(keys: Sequence[str]):
    """Window over the block summaries of one key."""
    return Window.partitionBy(*keys).orderBy(BLOCK)


def running(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    block: Column | int,
    sums: Mapping[str, Column] | None = None,
    lasts: Mapping[str, Column] | None = None,
    before: bool = False,
) -> DataFrame:
    """Add running sums and carried last non-NULL values per key.

    With ``before`` the current row itself is left out.
    """
    sums, lasts = dict(sums or {}), dict(lasts or {})
    d = with_blocks(df, keys, order_by, block)
    start = Window.unboundedPreceding
    inside = block_window(keys, order_by).rowsBetween(start, -1 if before else Window.currentRow)
    earlier = blocks_window(keys).rowsBetween(start, -1)
    ord_ = order_struct(order_by)

    summary = d.groupBy(*keys, BLOCK).agg(
        *[F.sum(x).alias(f"_s_{n}") for n, x in sums.items()],
        *[F.max_by(x, F.when(x.isNotNull(), ord_)).alias(f"_l_{n}") for n, x in lasts.items()],
    )
    carried = summary.select(
        *keys,
        BLOCK,
        *[F.sum(f"_s_{n}").over(earlier).alias(f"_cs_{n}") for n in sums],
        *[F.last(f"_l_{n}", ignorenulls=True).over(earlier).alias(f"_cl_{n}") for n in lasts],
    )
    inner = d.withColumns(
        {
            **{f"_is_{n}": F.sum(x).over(inside) for n, x in sums.items()},
            **{f"_il_{n}": F.last(x, ignorenulls=True).over(inside) for n, x in lasts.items()},
        }
    )
    joined = inner.join(carried, [*keys, BLOCK], "left")
    return joined.select(
        *df.columns,
        *[
            (F.coalesce(f"_is_{n}", F.lit(0)) + F.coalesce(f"_cs_{n}", F.lit(0))).alias(n)
            for n in sums
        ],
        *[F.coalesce(f"_il_{n}", f"_cl_{n}").alias(n) for n in lasts],
    )


def carry_forward(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str], block: Column | int, column: str,
    default: str | None = None,
) -> DataFrame:
    """Fill NULLs of ``column`` with the last earlier value of the key, else the default."""
    filled = running(df, keys, order_by, block, lasts={"_carried": F.col(column)})
    return filled.withColumn(column, F.coalesce("_carried", F.lit(default))).drop("_carried")


def with_previous(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str], block: Column | int,
    columns: Mapping[str, str],
) -> DataFrame:
    """Add, under new names, column values of the row before (NULL values included)."""
    boxed = {new: F.struct(F.col(old).alias("v")) for new, old in columns.items()}
    out = running(df, keys, order_by, block, lasts=boxed, before=True)
    return out.withColumns({new: F.col(new)["v"] for new in columns})


def first_rows_per_key(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str], n: int,
    descending: bool = False, salts: int = 64,
) -> DataFrame:
    """The first ``n`` rows of each key in the order, or the last ones with ``descending``.

    Two steps: the first ``n`` of each of ``salts`` parts of a key, then of the key. So at most
    ``n * salts`` rows of a key meet in a task, however many it has.
    """
    check_order(order_by)
    if n < 1:
        raise ValueError("n must be at least 1")
    order = [F.desc(c) if descending else F.asc(c) for c in order_by]
    parts = df.withColumn("_salt", F.pmod(F.xxhash64(*order_by), F.lit(salts)))
    within_part = Window.partitionBy(*keys, "_salt").orderBy(*order)
    within_key = Window.partitionBy(*keys).orderBy(*order)
    few = parts.withColumn("_rn", F.row_number().over(within_part)).where(F.col("_rn") <= n)
    return (
        few.withColumn("_rn", F.row_number().over(within_key))
        .where(F.col("_rn") <= n)
        .select(*df.columns)
    )
