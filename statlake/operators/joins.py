"""The joins that loading needs: skip what is done, keep what is listed, pair with seasons."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statlake.functions.seasons import FIRST_SEASON, LAST_SEASON, long_season, season_key
from statlake.functions.urls import DEFAULT_BASE, build_profile_url
from statlake.operators.ordered import with_keys
from statlake.operators.progress import PROGRESS_KEY, is_completed


def skip_completed(
    seeds: DataFrame, progress: DataFrame, keys: Sequence[str] = PROGRESS_KEY, salts: int = 256
) -> DataFrame:
    """Seeds that are not completed. Seeds without a full key always pass.

    Those match nothing, but would all be hashed to one place; a salt that only they have spreads
    them. Spark broadcasts the completed keys if it finds them small, else it joins by shuffle
    and splits hot keys (AQE).
    """
    done = with_keys(progress.where(is_completed()), keys).select(*keys).distinct()
    no_key = F.lit(False)
    for k in keys:
        no_key = no_key | F.col(k).isNull() | (F.col(k).cast("string") == "")
    spread = F.pmod(F.xxhash64(*seeds.columns), F.lit(salts)) + 1
    salted = seeds.withColumn("_salt", F.when(no_key, spread).otherwise(0))
    return salted.join(
        done.withColumn("_salt", F.lit(0).cast("bigint")), [*keys, "_salt"], "left_anti"
    ).drop("_salt")


def only_listed(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in the id list; ids are made distinct before the shuffle."""
    return df.join(ids.select(key).where(F.col(key).isNotNull()).distinct(), key, "left_semi")


def entity_seasons(
    players: DataFrame, first: int = FIRST_SEASON, last: int = LAST_SEASON,
    base: str = DEFAULT_BASE, id_col: str = "player_id", slug_col: str = "player_slug",
) -> DataFrame:
    """Every player with every season and the page URL.

    The seasons are a few literals, so each row is exploded in place; nothing is joined.
    """
    years = F.sequence(F.lit(first), F.lit(last))
    rows = players.select("*", F.explode(years).alias("_year"))
    return rows.select(
        *players.columns,
        season_key("_year", first).alias("season_key"),
        long_season("_year").alias("season"),
        build_profile_url(long_season("_year"), slug_col, id_col, base).alias("url"),
    )
