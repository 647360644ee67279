"""Stat entries: from one JSON object, or one table row, to the common stat struct."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statlake.functions.jsontext import first_filled, is_list, is_object, list_items, text_map
from statlake.functions.text import CELL_MISSING, DEFAULT_CATEGORY, text_or_null

# The field names under which a stat entry may hold each part, in order.
NAME_FIELDS = ["name", "statName", "stat_name", "label", "metric"]
VALUE_FIELDS = ["value", "stat_value", "score"]
PERCENTILE_FIELDS = ["percentile", "pct", "rank"]
GRADE_FIELDS = ["grade", "rating"]
CATEGORY_FIELDS = ["category", "statCategory", "type"]

# First cells that mark a heading row of a table.
HEADER_CELLS = ["STATISTIC", "STAT", "NAME", "METRIC"]

STAT_STRUCT = (
    "struct<statistic_name string, value string, percentile string, grade string, "
    "statistic_category string>"
)
STAT_ARRAY = f"array<{STAT_STRUCT}>"


# All fields an entry is read for; others are skipped by the JSON parser.
ENTRY_STRUCT = "struct<{}>".format(
    ", ".join(
        f"{f} string"
        for f in NAME_FIELDS + VALUE_FIELDS + PERCENTILE_FIELDS + GRADE_FIELDS + CATEGORY_FIELDS
    )
)


def no_stats() -> Column:
    return F.array().cast(STAT_ARRAY)


def _field(entry: Column, name: str) -> Column:
    """A field that is not empty; named twice, since to read a field costs less than ``text_or_null``."""
    return F.when(entry[name] != "", entry[name])


def _choose(entry: Column, fields: Sequence[str], falsy_chain: bool) -> Column:
    """First field with a value. ``falsy_chain`` also passes over 0 and false, and then takes
    the last field as it is, which is how old rows were read."""
    if falsy_chain:
        values = [entry[f] for f in fields]
        return F.coalesce(first_filled(values[:-1]), values[-1])
    return F.coalesce(*[_field(entry, f) for f in fields])


def stat_from_entry(
    entry: Column, category: Column | None = None, falsy_chain: bool = False
) -> Column:
    """Stat struct from an entry struct; NULL for an entry without a name."""
    name = F.coalesce(*[_field(entry, f) for f in NAME_FIELDS])
    labels = [_field(entry, f) for f in CATEGORY_FIELDS]
    if category is not None:
        labels.insert(0, text_or_null(category))
    return F.when(
        name.isNotNull(),
        F.struct(
            name.alias("statistic_name"),
            _choose(entry, VALUE_FIELDS, falsy_chain).alias("value"),
            _choose(entry, PERCENTILE_FIELDS, falsy_chain).alias("percentile"),
            _choose(entry, GRADE_FIELDS, falsy_chain).alias("grade"),
            F.coalesce(*labels, F.lit(DEFAULT_CATEGORY)).alias("statistic_category"),
        ),
    )


def entry_structs(stats_json: Column) -> Column:
    """JSON list to an array of entry structs; items that are no objects become NULL."""
    return F.coalesce(
        F.from_json(stats_json, f"array<{ENTRY_STRUCT}>"),
        F.transform(
            list_items(stats_json),
            lambda item: F.when(is_object(item), F.from_json(item, ENTRY_STRUCT)),
        ),
    )


def stats_from_list(
    stats_json: Column, category: Column | None = None, falsy_chain: bool = False
) -> Column:
    """JSON list of entries to the stat array; entries without a name are left out."""
    stats = F.transform(
        F.when(is_list(stats_json), entry_structs(stats_json)),
        lambda e: stat_from_entry(e, category, falsy_chain),
    )
    return F.coalesce(F.filter(stats, lambda s: s.isNotNull()), no_stats())


def stats_from_groups(stats_json: Column, falsy_chain: bool = False) -> Column:
    """JSON object of category -> list of entries to the stat array, in document order."""
    groups = F.map_entries(text_map(stats_json))
    nested = F.transform(groups, lambda g: stats_from_list(g["value"], g["key"], falsy_chain))
    return F.coalesce(F.flatten(nested), no_stats())


def stats_from_json(stats_json: Column, falsy_chain: bool = False) -> Column:
    """Either form: a list of entries, or an object of such lists by category."""
    return F.when(is_list(stats_json), stats_from_list(stats_json, None, falsy_chain)).otherwise(
        stats_from_groups(stats_json, falsy_chain)
    )


def stat_from_cells(cells: Column, category: Column) -> Column:
    """Stat struct from the cell texts of one table row, which have no white space at their ends.

    NULL for fewer than two cells, for an empty first cell and for a heading row.
    """

    def cell(i: int) -> Column:
        text = F.get(cells, F.lit(i))
        return F.when(~text.isin(CELL_MISSING), text)

    name = cell(0)
    usable = (F.size(cells) >= 2) & name.isNotNull() & ~F.upper(name).isin(HEADER_CELLS)
    return F.when(
        usable,
        F.struct(
            name.alias("statistic_name"),
            cell(1).alias("value"),
            cell(2).alias("percentile"),
            cell(3).alias("grade"),
            category.alias("statistic_category"),
        ),
    )


def explode_stats(df: DataFrame, kept: Sequence[str | Column], stats: str) -> DataFrame:
    """One row per stat of the array, as ``_stat``, with its place as ``stat_pos``.

    The outer form with a filter after it: for the inner form Spark infers a filter on the array
    and pushes it down to the scan, where it would extract every page a second time.
    """
    rows = df.select(*kept, F.posexplode_outer(stats).alias("stat_pos", "_stat"))
    return rows.where(F.col("_stat").isNotNull())
