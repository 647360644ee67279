"""Cleaning of stat rows and of profiles that hold their stats in an array."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statlake.functions.numbers import (
    grade,
    is_complete,
    item_value_numeric,
    percentile_over_100,
    value_or_sentinel,
)
from statlake.functions.text import ITEM_MISSING, strip

# First cells that are column labels and no statistic.
LABEL_NAMES = [
    "STATISTIC",
    "STAT",
    "NAME",
    "METRIC",
    "VALUE",
    "PERCENTILE",
    "GRADE",
    "CATEGORY",
    "TYPE",
]


def is_valid_stat(name: Column, value: Column) -> Column:
    """Named, not a label row, and with some value."""
    label = F.upper(strip(name)).isin(LABEL_NAMES)
    return F.coalesce(~label & ~strip(value).isin(ITEM_MISSING), F.lit(False))


def _clean(name: Column, value: Column, percentile: Column, raw_grade: Column) -> dict[str, Column]:
    stored = value_or_sentinel(value)
    kept_percentile = F.when(~percentile.isin(ITEM_MISSING), percentile)
    return {
        "value": stored,
        "value_numeric": item_value_numeric(value),
        "percentile": kept_percentile,
        "percentile_numeric": percentile_over_100(percentile),
        "grade": grade(raw_grade),
        "is_complete": is_complete(name, stored),
    }


def _raw(value: Column, percentile: Column, raw_grade: Column) -> Column:
    return F.struct(
        value.alias("value"), percentile.alias("percentile"), raw_grade.alias("grade")
    )


def normalize_stats(rows: DataFrame, run_ts: Column | None = None) -> DataFrame:
    """Clean stat rows in one projection; the raw texts stay in ``raw_data``.

    ``extracted_at`` is filled from ``run_ts`` where it is missing.
    """
    value, percentile, raw_grade = (
        F.col(c).cast("string") for c in ("value", "percentile", "grade")
    )
    raw = _raw(value, percentile, raw_grade)
    if "raw_data" in rows.columns:
        raw = F.coalesce(F.col("raw_data"), raw)
    columns = {"raw_data": raw, **_clean(F.col("statistic_name"), value, percentile, raw_grade)}
    if run_ts is not None:
        stamp = run_ts.cast("timestamp")
        known = "extracted_at" in rows.columns
        columns["extracted_at"] = F.coalesce(F.col("extracted_at"), stamp) if known else stamp
    return rows.withColumns(columns)


def normalize_profiles(profiles: DataFrame, run_ts: Column | None = None) -> DataFrame:
    """The same cleaning inside the ``stats`` array of profile rows; all other fields stay.

    ``raw_data`` that is set stays. ``extracted_at`` of the profile is filled from ``run_ts``.
    """
    given = profiles.schema["stats"].dataType.elementType.fieldNames()

    def clean(s: Column) -> Column:
        value, percentile, raw_grade = (s[c].cast("string") for c in ("value", "percentile", "grade"))
        fields = _clean(s["statistic_name"], value, percentile, raw_grade)
        raw = _raw(value, percentile, raw_grade)
        fields["raw_data"] = F.coalesce(s["raw_data"], raw) if "raw_data" in given else raw
        return F.struct(
            *[(fields[n] if n in fields else s[n]).alias(n) for n in given],
            *[c.alias(n) for n, c in fields.items() if n not in given],
        )

    out = profiles.withColumn("stats", F.transform("stats", clean))
    if run_ts is not None:
        stamp = run_ts.cast("timestamp")
        known = "extracted_at" in profiles.columns
        out = out.withColumn("extracted_at", F.coalesce("extracted_at", stamp) if known else stamp)
    return out


def explode_profiles(profiles: DataFrame) -> DataFrame:
    """One row per nested stat; the stat's own fields come before those of the profile.

    An absent and a NULL field look alike in a struct, so a NULL falls back to the profile.
    """
    stat_fields = profiles.schema["stats"].dataType.elementType.fieldNames()
    parents = [c for c in profiles.columns if c != "stats"]
    # The outer form with a filter behind it: a plain explode has Spark test the array's size at
    # the scan, and with it work out the whole array once more.
    rows = profiles.select(*parents, F.explode_outer("stats").alias("_stat"))
    rows = rows.where(F.col("_stat").isNotNull())
    own = {f: F.col("_stat")[f] for f in stat_fields}
    return rows.select(
        *[F.coalesce(own[c], F.col(c)).alias(c) if c in own else F.col(c) for c in parents],
        *[own[f].alias(f) for f in stat_fields if f not in parents],
    )
