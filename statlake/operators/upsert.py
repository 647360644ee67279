"""Keyed upserts, deduplication and key checks.

All of them are aggregates with ``min_by`` / ``max_by``: every map task sends one row per key, so
a key with a large share of all rows costs no more in the reduce step than any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statlake.functions.text import strip
from statlake.operators.ordered import check_order, order_struct, with_keys

# Key and column groups of the stat table. Identity columns keep the first value
# seen for a key, measure columns take the last one, NULL included.
STAT_KEY = ["player_id", "season", "statistic_name"]
STAT_IDENTITY = ["player_name", "player_slug", "statistic_category", "page_url", "is_complete"]
STAT_MEASURES = [
    "value",
    "value_numeric",
    "percentile",
    "percentile_numeric",
    "grade",
    "extraction_source",
    "extracted_at",
]


def keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One row per key: the first in the order."""
    check_order(order_by)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).distinct()
    picked = df.groupBy(*keys).agg(
        F.min_by(F.struct(*rest), order_struct(order_by)).alias("_row")
    )
    return picked.select(*keys, "_row.*").select(*df.columns)


def keep_best_source(
    df: DataFrame, keys: Sequence[str], source: str, ranking: Sequence[str],
    order_by: Sequence[str],
) -> DataFrame:
    """One row per key: from the source that ranks first, then the first in the order.

    Sources not in the ranking come after all others.
    """
    rank = F.lit(len(ranking))
    for i, name in reversed(list(enumerate(ranking))):
        rank = F.when(F.col(source) == name, i).otherwise(rank)
    ranked = df.withColumn("_rank", rank)
    return keep_first(ranked, keys, ["_rank", *order_by]).drop("_rank")


def partial_upsert(
    rows: DataFrame, keys: Sequence[str], order_by: Sequence[str],
    first_wins: Sequence[str], last_wins: Sequence[str],
) -> DataFrame:
    """One row per key: ``first_wins`` columns from the first row, ``last_wins`` from the last.

    The structs around the columns keep NULLs, so that a later NULL does overwrite.
    """
    ord_ = order_struct(order_by)
    picked = []
    if first_wins:
        picked.append(F.min_by(F.struct(*first_wins), ord_).alias("_first"))
    if last_wins:
        picked.append(F.max_by(F.struct(*last_wins), ord_).alias("_last"))
    out = rows.groupBy(*keys).agg(*picked)
    return out.select(
        *keys,
        *[F.col(f"_first.{c}") for c in first_wins],
        *[F.col(f"_last.{c}") for c in last_wins],
    )


def upsert_into(
    current: DataFrame, updates: DataFrame, keys: Sequence[str], order_by: Sequence[str],
    first_wins: Sequence[str], last_wins: Sequence[str],
) -> DataFrame:
    """Upsert ``updates`` into ``current``, which has one row per key and comes first."""
    columns = [*keys, *first_wins, *last_wins]
    nulls = {c: F.lit(None).cast(updates.schema[c].dataType) for c in order_by if c not in columns}
    old = current.select(*columns).withColumns({**nulls, "_age": F.lit(0)})
    new = updates.withColumn("_age", F.lit(1))
    both = old.unionByName(new.select(*old.columns))
    return partial_upsert(both, keys, ["_age", *order_by], first_wins, last_wins)


def upsert_stats(rows: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """The stat table: one row per player, season and statistic."""
    valid = with_keys(rows, STAT_KEY)
    return partial_upsert(valid, STAT_KEY, order_by, STAT_IDENTITY, STAT_MEASURES)


def split_by_key(
    df: DataFrame, keys: Sequence[str], blank_is_missing: bool = True
) -> tuple[DataFrame, DataFrame]:
    """Rows with a full key, and the rejected rest."""
    full = F.lit(True)
    for k in keys:
        present = F.col(k).isNotNull()
        if blank_is_missing:
            present = present & (F.col(k).cast("string") != "")
        full = full & present
    return df.where(full), df.where(~full)


def clean_ids(df: DataFrame, column: str, position: str) -> DataFrame:
    """Trimmed ids without blanks, each once, in order of first appearance."""
    clean = strip(column)
    ids = df.select(clean.alias(column), position).where(F.col(column) != "")
    return ids.groupBy(column).agg(F.min(position).alias(position)).orderBy(position)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of frames whose columns may differ; what a frame lacks is NULL."""
    if not frames:
        raise ValueError("no frames")
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def lower_columns(df: DataFrame) -> DataFrame:
    """Column names in lower case; two names that become one are an error."""
    names = [c.lower() for c in df.columns]
    double = {n for n in names if names.count(n) > 1}
    if double:
        raise ValueError(f"columns differ only in case: {sorted(double)}")
    return df.toDF(*names)


def cast_numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns to double, bad values to NULL; columns that are not there are passed over."""
    wanted = [c for c in columns if c in df.columns]
    return df.withColumns({c: F.col(c).try_cast("double") for c in wanted}) if wanted else df
