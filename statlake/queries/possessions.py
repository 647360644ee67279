"""Queries over possessions. Each order is a game with 0 to 3 possessions of 0 to 2 events."""

from __future__ import annotations

from pyspark.sql import functions as F

from statlake.operators.possessions import (
    flatten_possessions,
    seconds_per_possession,
    with_previous_timeouts,
)
from statlake.queries.registry import PARTS, query, table, text


def games(spark, sf):
    key = F.col("o_orderkey")

    def clock(seconds):
        return F.format_string("%02d:%02d", F.floor(seconds / 60), seconds % 60)

    def event(i, j):
        return F.struct(
            (j + 1).cast("int").alias("period"),
            F.concat_ws("-", text(i), text(j), text("o_custkey")).alias("score"),
        )

    def upto(n):
        return F.slice(F.array(*[F.lit(i) for i in range(3)]), 1, n.cast("int"))

    def possession(i):
        start = (key * 7 + i * 31) % 600 + 60
        return F.struct(
            F.when((key + i) % 3 > 0, (i + 10).cast("int")).alias("number"),
            clock(start).alias("start_time"),
            clock(start - (key + i) % 24).alias("end_time"),
            (F.col("o_custkey") % 30).alias("offense_team_id"),
            F.when(key % 2 == 0, F.array(F.col("o_custkey") % 30, key % 30)).alias("team_ids"),
            (i - 1).cast("int").alias("start_score_margin"),
            ((key + i) % 5 == 0).alias("possession_has_timeout"),
            F.lit(None).cast("boolean").alias("previous_possession_has_timeout"),
            F.when(i > 0, F.struct(F.lit("Rebound").alias("type"))).alias(
                "previous_possession_ending_event"
            ),
            F.when(i > 0, F.col("o_custkey")).alias("previous_possession_end_rebound_player_id"),
            F.transform(upto((key + i) % 3), lambda j: event(i, j)).alias("events"),
        )

    return table(spark, sf, "orders").repartition(PARTS, "o_orderkey").select(
        key.alias("game_id"), F.transform(upto(key % 4), possession).alias("possessions")
    )


_SQL = """
    SELECT CAST(o_orderkey AS VARCHAR) AS game_id, o_custkey AS c, o_orderkey AS k, i,
           (o_orderkey * 7 + i * 31) % 600 + 60 AS st, (o_orderkey + i) % 24 AS len, (o_orderkey + i) % 3 AS ne
    FROM orders, (SELECT unnest([0, 1, 2]) AS i) WHERE i < o_orderkey % 4
"""


@query(
    "possession_flatten",
    f"""
    SELECT game_id, CASE WHEN (k + i) % 3 > 0 THEN i + 10.0e0 ELSE i + 1.0e0 END AS possession_number,
           CASE WHEN ne > 0 THEN 1.0e0 END AS period,
           printf('%02d:%02d', st // 60, st % 60) AS start_time, printf('%02d:%02d', (st - len) // 60, (st - len) % 60) AS end_time,
           CAST(c % 30 AS DOUBLE) AS offense_team_id, CASE WHEN k % 2 = 0 THEN concat(c % 30, ',', k % 30) END AS team_ids,
           i - 1.0e0 AS start_score_margin, CAST(NULL AS VARCHAR) AS possession_start_type,
           (k + i) % 5 = 0 AS possession_has_timeout, CASE WHEN i > 0 THEN (k + i - 1) % 5 = 0 END AS previous_possession_has_timeout,
           CASE WHEN i > 0 THEN 'Rebound' END AS previous_possession_ending_event_type,
           CAST(NULL AS DOUBLE) AS previous_possession_end_shooter_player_id,
           CASE WHEN i > 0 THEN CAST(c AS DOUBLE) END AS previous_possession_end_rebound_player_id,
           CAST(NULL AS DOUBLE) AS previous_possession_end_steal_player_id,
           CAST(NULL AS DOUBLE) AS previous_possession_end_turnover_player_id,
           CAST(ne AS DOUBLE) AS event_count, CASE WHEN ne > 0 THEN concat(i, '-0-', c) END AS start_score,
           CASE WHEN ne > 0 THEN concat(i, '-', ne - 1, '-', c) END AS end_score
    FROM ({_SQL})
    """,
)
def possession_flatten(spark, sf):
    flat = flatten_possessions(with_previous_timeouts(games(spark, sf)))
    return flat.withColumn("possession_start_type", text("possession_start_type"))


@query(
    "seconds_per_unit",
    f"""
    SELECT game_id, CAST(c % 30 AS DOUBLE) AS offense_team_id, count(*) AS possessions,
           round(avg(len), 6) AS seconds_per_possession
    FROM ({_SQL}) GROUP BY 1, 2
    """,
)
def seconds_per_unit(spark, sf):
    out = seconds_per_possession(flatten_possessions(games(spark, sf)))
    return out.withColumn("seconds_per_possession", F.round("seconds_per_possession", 6))
