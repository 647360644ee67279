"""Games, box scores, dimensions, possessions, pages and captured responses as landed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statlake.operators.extract.captured import capture_json
from statlake.operators.joins import only_listed
from statlake.operators.possessions import POSSESSION_SCHEMA
from statlake.operators.upsert import keep_first, lower_columns
from statlake.plans.windows import season_list

PAGE_SCHEMA = "page_id bigint, url string, html string"
RESPONSE_SCHEMA = (
    "page_id bigint, seq int, url string, status int, content_type string, body string"
)


def read_games(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Landed game frames with lower-case column names."""
    return lower_columns(spark.read.format(fmt).load(path))


def in_range(df: DataFrame, column: str, start: str, end: str) -> Column:
    """The column between two days, said in its own type so that the scan can use it."""
    kind = dict(df.dtypes)[column]
    c, first, last = F.col(column), F.lit(start).cast("date"), F.lit(end).cast("date")
    if kind.startswith("timestamp"):
        return (c >= first.cast(kind)) & (c < F.date_add(last, 1).cast(kind))
    if kind == "string":
        return c.substr(1, 10).between(start, end)
    return c.between(first, last)


def games_between(
    games: DataFrame, start: str, end: str, seasons: list[str] | None = None,
    date_col: str = "game_date", season_col: str = "season",
    order_by: tuple[str, ...] | None = None,
) -> DataFrame:
    """Games in a range of dates, the first row of each ``game_id``.

    Without ``order_by`` that is the first by date and then by all other columns in turn.

    The season filter follows from the dates but Catalyst cannot know that; said here, it prunes
    the season partitions.
    """
    wanted = F.col(season_col).isin(season_list(start, end) if seasons is None else seasons)
    rows = games.where(wanted & in_range(games, date_col, start, end))
    if "game_id" not in games.columns:
        return rows
    order = order_by or (date_col, *(c for c in games.columns if c not in ("game_id", date_col)))
    return keep_first(rows, ["game_id"], list(order))


def box_scores_for(scores: DataFrame, game_ids: DataFrame) -> DataFrame:
    """Box scores of the listed games, one ``game_id`` column; games without scores give none."""
    return only_listed(lower_columns(scores), game_ids, "game_id")


def read_dimension(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Teams or players; Spark broadcasts them in joins if they are small."""
    return lower_columns(spark.read.format(fmt).load(path))


def read_possessions(spark: SparkSession, path: str) -> DataFrame:
    """Nested possessions, one row per game, as JSON lines."""
    return spark.read.schema(POSSESSION_SCHEMA).json(path)


def read_pages(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.schema(PAGE_SCHEMA).format(fmt).load(path)


def read_responses(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Captured responses with a fitting URL and content type whose body is JSON."""
    return capture_json(spark.read.schema(RESPONSE_SCHEMA).format(fmt).load(path))


READERS: dict[str, Callable[..., DataFrame]] = {
    "games": read_games,
    "dimension": read_dimension,
    "possessions": read_possessions,
    "pages": read_pages,
    "responses": read_responses,
}


def register_reader(name: str, reader: Callable[..., DataFrame]) -> None:
    """Make a further data source known under a name."""
    READERS[name] = reader


def read(spark: SparkSession, name: str, path: str, **options) -> DataFrame:
    return READERS[name](spark, path, **options)

