"""Seed lists: which pages to load."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statlake.functions.jsontext import bind, is_json, is_object
from statlake.functions.text import strip
from statlake.functions.urls import PROFILE_PATH, parse_profile_url
from statlake.session import path_exists

SEED_SCHEMA = "url string, player_id string, player_slug string, season string"


def _seeds(line: Column, pattern: str) -> Column:
    """A seed from a JSON object, a JSON string or a plain URL.

    A URL of a profile page also gives the id, slug and season.
    """

    def seed(text: Column) -> Column:
        as_object = F.from_json(F.when(is_object(text) & is_json(text), text), SEED_SCHEMA)
        quoted = F.get(F.from_json(F.concat(F.lit("["), text, F.lit("]")), "array<string>"), F.lit(0))
        url = F.when(text.startswith('"'), strip(F.coalesce(quoted, text))).otherwise(text)

        def from_url(u: Column) -> Column:
            info = parse_profile_url(u, pattern)
            return bind(
                info,
                lambda i: F.struct(
                    u.alias("url"), *[i[c].alias(c) for c in ("player_id", "player_slug", "season")]
                ),
            )

        return bind(as_object, lambda o: F.when(o.isNotNull(), o).otherwise(bind(url, from_url)))

    return bind(line, seed)


def parse_seed_lines(lines: DataFrame, column: str = "value", pattern: str = PROFILE_PATH) -> DataFrame:
    """JSON objects, quoted or plain URLs, one per line; blank lines and ``#`` comments are passed over."""
    text = lines.select(strip(column).alias("_line")).where(~F.col("_line").rlike(r"^(#.*)?$"))
    return text.select(_seeds(F.col("_line"), pattern).alias("_s")).select("_s.*")


def read_seeds(spark: SparkSession, path: str, pattern: str = PROFILE_PATH) -> DataFrame:
    """Seed lists: each file is one JSON array of objects or URLs, or JSON and URL lines.

    No file gives no seeds. Lines are read in parallel. A JSON array is read whole, file by file, so
    long lists should be landed as lines.
    """
    if not path_exists(spark, path):
        return spark.createDataFrame([], SEED_SCHEMA)
    lines = spark.read.text(path).withColumn("_file", F.input_file_name())
    told = lines.where(~F.col("value").rlike(r"^\s*(#.*)?$"))
    # The first line with content says what a file holds; a line's place is its task and order.
    first = told.withColumn("_at", F.monotonically_increasing_id()).groupBy("_file").agg(
        F.min_by("value", "_at").alias("_head")
    )
    arrays = [r["_file"] for r in first.where(F.ltrim("_head").startswith("[")).collect()]
    if not arrays:
        return parse_seed_lines(lines, "value", pattern)
    plain = parse_seed_lines(lines.where(~F.col("_file").isin(arrays)), "value", pattern)
    whole = spark.read.text(arrays, wholetext=True)
    array = F.regexp_replace("value", r"\A(?:\s*#[^\n]*+\n)++", "")
    entries = whole.select(F.explode(F.from_json(array, "array<string>")).alias("value"))
    listed = entries.where(strip("value") != "")
    return plain.unionByName(
        listed.select(_seeds(strip("value"), pattern).alias("_s")).select("_s.*")
    )
