"""Ingestion state: one row per source, kept as one small JSON document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statlake.session import next_state, path_exists

SOURCE_STRUCT = (
    "struct<initial_start_date string, initial_end_date string, last_processed_date string, "
    "status string, last_run_ts string, error_count int, last_error string>"
)
STATE_SCHEMA = (
    "initial_ingestion_complete boolean, last_successful_run string, "
    f"sources map<string, {SOURCE_STRUCT}>"
)
SOURCE_FIELDS = [
    "initial_start_date",
    "initial_end_date",
    "last_processed_date",
    "status",
    "last_run_ts",
    "error_count",
    "last_error",
]


def empty_state(spark: SparkSession) -> DataFrame:
    """The state before the first run: not complete, no sources."""
    return spark.range(1).select(
        F.lit(False).alias("initial_ingestion_complete"),
        F.lit(None).cast("string").alias("last_successful_run"),
        F.create_map().cast(f"map<string, {SOURCE_STRUCT}>").alias("sources"),
    )


def read_state(spark: SparkSession, path: str) -> DataFrame:
    """The state document; the empty state where there is none.

    A writer that was lost just before the new document took the old one's place has left it beside.
    """
    if not path_exists(spark, path):
        path = next_state(path)
        if not path_exists(spark, f"{path}/_SUCCESS"):
            return empty_state(spark)
    return spark.read.schema(STATE_SCHEMA).option("multiLine", True).json(path)


def state_rows(document: DataFrame) -> DataFrame:
    """One row per source."""
    return document.select(
        F.coalesce("initial_ingestion_complete", F.lit(False)).alias("initial_ingestion_complete"),
        "last_successful_run",
        F.explode("sources").alias("source", "_s"),
    ).select(
        "source",
        *[F.col(f"_s.{c}").alias(c) for c in SOURCE_FIELDS if c not in ("status", "error_count")],
        F.coalesce("_s.status", F.lit("pending")).alias("status"),
        F.coalesce("_s.error_count", F.lit(0)).alias("error_count"),
        "initial_ingestion_complete",
        "last_successful_run",
    )


def state_document(rows: DataFrame) -> DataFrame:
    """Rows back to one document. There are as many rows as configured sources: a handful."""
    source = F.struct(*[F.col(c) for c in SOURCE_FIELDS]).cast(SOURCE_STRUCT)
    return rows.agg(
        F.coalesce(F.bool_and("initial_ingestion_complete"), F.lit(False)).alias(
            "initial_ingestion_complete"
        ),
        F.max("last_successful_run").alias("last_successful_run"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("source", source)))).alias("sources"),
    )


def source_progress(rows: DataFrame, results: DataFrame) -> DataFrame:
    """State rows after a run. ``results`` has ``source``, ``processed_to``, ``run_ts`` and
    ``error`` (NULL for success): success moves the resume point, failure counts an error."""
    r = results.select("source", "processed_to", "run_ts", F.col("error").alias("_error"))
    ran, failed = F.col("run_ts").isNotNull(), F.col("_error").isNotNull()
    ok = ran & ~failed
    processed = F.when(ok, F.coalesce("processed_to", "last_processed_date")).otherwise(
        F.col("last_processed_date")
    )
    return (
        rows.join(r, "source", "left")
        .withColumns(
            {
                "last_processed_date": processed,
                "status": F.when(ok & (processed >= F.col("initial_end_date")), "complete")
                .when(ran, "in_progress")
                .otherwise(F.col("status")),
                "last_run_ts": F.coalesce("run_ts", "last_run_ts"),
                "error_count": F.col("error_count") + (ran & failed).cast("int"),
                "last_error": F.when(ran, F.col("_error")).otherwise(F.col("last_error")),
            }
        )
        .select(*rows.columns)
    )
