"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame

from statlake.session import scratch_dir


def scratch_table(df: DataFrame, label: str) -> DataFrame:
    """``df`` written below spark.checkpoint.dir and read again: cut lineage that survives lost executors."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
