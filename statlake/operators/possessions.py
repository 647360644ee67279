"""Possessions: nested games to flat rows, and what is measured on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statlake.operators.upsert import cast_numbers

# Columns of a flat possession row in order, and those read as numbers.
FLAT_COLUMNS = [
    "game_id",
    "possession_number",
    "period",
    "start_time",
    "end_time",
    "offense_team_id",
    "team_ids",
    "start_score_margin",
    "possession_start_type",
    "possession_has_timeout",
    "previous_possession_has_timeout",
    "previous_possession_ending_event_type",
    "previous_possession_end_shooter_player_id",
    "previous_possession_end_rebound_player_id",
    "previous_possession_end_steal_player_id",
    "previous_possession_end_turnover_player_id",
    "event_count",
    "start_score",
    "end_score",
]
NUMBER_COLUMNS = [
    "possession_number",
    "period",
    "offense_team_id",
    "start_score_margin",
    "previous_possession_end_shooter_player_id",
    "previous_possession_end_rebound_player_id",
    "previous_possession_end_steal_player_id",
    "previous_possession_end_turnover_player_id",
    "event_count",
]

POSSESSION_SCHEMA = """
    game_id string,
    possessions array<struct<
        number int, start_time string, end_time string, offense_team_id bigint,
        team_ids array<bigint>, start_score_margin int, possession_start_type string,
        possession_has_timeout boolean, previous_possession_has_timeout boolean,
        previous_possession_ending_event struct<type string>,
        previous_possession_end_shooter_player_id bigint,
        previous_possession_end_rebound_player_id bigint,
        previous_possession_end_steal_player_id bigint,
        previous_possession_end_turnover_player_id bigint,
        events array<struct<period int, score string>>>>
"""


def _names(dtype: T.DataType) -> set[str]:
    while isinstance(dtype, T.ArrayType):
        dtype = dtype.elementType
    return set(dtype.fieldNames()) if isinstance(dtype, T.StructType) else set()


def flatten_possessions(games: DataFrame) -> DataFrame:
    """One flat row per possession. Games without possessions give no row; what a possession
    lacks is NULL; a possession without a number takes its place in the game."""
    element = games.schema["possessions"].dataType.elementType
    known = _names(element)
    inner = {f.name: _names(f.dataType) for f in element.fields}
    p = F.col("_p")

    def field(name: str) -> Column:
        return p[name] if name in known else F.lit(None)

    def event(index: int, name: str) -> Column:
        if name not in inner.get("events", ()):
            return F.lit(None).cast("string")
        return F.try_element_at(p["events"], F.lit(index))[name]

    teams = field("team_ids").cast("array<string>")
    ending = inner.get("previous_possession_ending_event", set())
    special = {
        "game_id": F.col("game_id").cast("string"),
        "possession_number": F.coalesce(field("number"), F.col("_pos") + 1),
        "period": event(1, "period"),
        "team_ids": F.when(F.size(teams) > 0, F.array_join(teams, ",")),
        "previous_possession_ending_event_type": (
            p["previous_possession_ending_event"]["type"]
            if "type" in ending
            else F.lit(None).cast("string")
        ),
        "event_count": (
            F.coalesce(F.array_size(p["events"]), F.lit(0)) if "events" in known else F.lit(0)
        ),
        "start_score": event(1, "score"),
        "end_score": event(-1, "score"),
    }
    # Outer, with a filter behind it: see explode_profiles.
    rows = games.select("game_id", F.posexplode_outer("possessions").alias("_pos", "_p"))
    rows = rows.where(F.col("_p").isNotNull())
    flat = rows.select(*[special.get(c, field(c)).alias(c) for c in FLAT_COLUMNS])
    return cast_numbers(flat, NUMBER_COLUMNS)


def with_previous_timeouts(games: DataFrame) -> DataFrame:
    """Fill ``previous_possession_has_timeout`` from the possession before, where it is missing.

    A game is one row, so the possession before is the one before in its array: no shuffle.
    """

    def fill(possession: Column, i: Column) -> Column:
        before = F.when(i > 0, F.get(F.col("possessions"), i - 1)["possession_has_timeout"])
        known = possession["previous_possession_has_timeout"]
        return possession.withField(
            "previous_possession_has_timeout", F.coalesce(known, before)
        )

    return games.withColumn("possessions", F.transform("possessions", fill))


def clock_seconds(clock: Column) -> Column:
    """``MM:SS`` to seconds, NULL for other text."""
    minutes = F.regexp_extract(clock, r"^\s*([0-9]+):([0-9]+(?:\.[0-9]+)?)\s*$", 1)
    seconds = F.regexp_extract(clock, r"^\s*([0-9]+):([0-9]+(?:\.[0-9]+)?)\s*$", 2)
    return minutes.try_cast("double") * 60 + seconds.try_cast("double")


def seconds_per_possession(possessions: DataFrame) -> DataFrame:
    """Mean length of a possession by game and offense team; the clock counts down."""
    length = clock_seconds(F.col("start_time")) - clock_seconds(F.col("end_time"))
    return possessions.groupBy("game_id", "offense_team_id").agg(
        F.count(length).alias("possessions"), F.avg(length).alias("seconds_per_possession")
    )
