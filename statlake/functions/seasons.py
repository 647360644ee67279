"""Season text and keys. A season starts in October."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from statlake.functions.text import SPACE, as_column

# First month of a season, first and last start year of the profile seasons.
FIRST_MONTH = 10
FIRST_SEASON = 2013
LAST_SEASON = 2026


def _years(start: Column, end: Column) -> Column:
    return F.concat_ws("-", start.cast("string"), end.cast("string"))


def season_start_year(date: Column | str) -> Column:
    """Start year of the season that holds the date."""
    d = as_column(date)
    return F.year(d) - (F.month(d) < FIRST_MONTH).cast("int")


def short_season(start_year: Column | str) -> Column:
    """``2024`` to ``2024-25``."""
    y = as_column(start_year).cast("int")
    return F.when(
        y.isNotNull(),
        F.concat_ws("-", y.cast("string"), F.lpad(((y + 1) % 100).cast("string"), 2, "0")),
    )


def season_of(date: Column | str) -> Column:
    """Date to ``2024-25``."""
    return short_season(season_start_year(date))


def long_season(start_year: Column | str) -> Column:
    """``2024`` to ``2024-2025``."""
    y = as_column(start_year).cast("int")
    return F.when(y.isNotNull(), _years(y, y + 1))


def season_key(start_year: Column | str, base_year: int = FIRST_SEASON) -> Column:
    """Season number counted from the base year, as text."""
    return (as_column(start_year).cast("int") - F.lit(base_year)).cast("string")


def normalize_season(c: Column | str, strict: bool = False) -> Column:
    """Season text in any spelling to ``YYYY-YYYY``, else NULL.

    ``strict`` keeps two odd readings of old data: ``99-00`` gives ``1999-1900``, and an end
    of three digits is kept as it is. The default gives ``1999-2000`` and NULL.
    """
    text = as_column(c).cast("string")

    def part(pattern: str) -> Column:
        return F.regexp_extract(text, rf"(?U)\A{SPACE}*{pattern}", 1)

    start4 = part("([0-9]{4})-[0-9]{2}").try_cast("int")
    end4 = part("[0-9]{4}-([0-9]{3,4})")
    start2 = part("([0-9]{2})-[0-9]{2}").try_cast("int")
    end2 = part("[0-9]{2}-([0-9]{2})").try_cast("int")
    century = F.when(start2 < 50, 2000).otherwise(1900)
    end_short = century + end2
    if not strict:
        end_short = F.when(end2 < start2, century + start2 + 1).otherwise(end_short)
    long_end = F.when(end4 == "", start4 + 1)
    if not strict:
        long_end = long_end.when(F.length(end4) == 3, F.lit(None))
    long_end = long_end.otherwise(end4.try_cast("int"))
    return F.coalesce(
        F.concat(start4.cast("string"), F.lit("-"), long_end.cast("string")),
        F.when(
            start4.isNull() & start2.isNotNull(),
            F.concat(
                (century + start2).cast("string"), F.lit("-"), end_short.cast("string")
            ),
        ),
    )


def provider_date(c: Column | str) -> Column:
    """``YYYY-MM-DD`` to ``MM/DD/YYYY``."""
    return F.date_format(as_column(c).try_cast("date"), "MM/dd/yyyy")
