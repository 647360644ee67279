"""Numeric readings of stat text: values, percentiles, grades, completeness."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from statlake.functions.text import ITEM_MISSING, SPACE, as_column

# Fixed value: text that stands in for a missing number in the ``value`` column.
MISSING_NUMBER = "00000"

# The known grades.
GRADES = ["A+", "A", "A-", "B+", "B", "B-", "C+", "C", "C-", "D+", "D", "D-", "F"]

# Possessive throughout: no backtracking over long runs of digits, and the engine loops over the
# group instead of recursing, so that no text can make it slow or exhaust the stack.
_DIGITS = r"[0-9]++(?:_[0-9]++)*+"
_NUMBER = rf"([+-]?(?:{_DIGITS}\.?+(?:{_DIGITS})?+|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?+)"

# The functions below name their argument as few times as they can: an argument is often itself
# a long expression, and each mention may evaluate it once more. None of the missing markers
# holds a digit or begins with a grade, so a pattern that fails on them needs no test for them.


def _number_in(c: Column | str, tail: str) -> Column:
    """The decimal number that, with white space and ``tail`` after it, is all of the text.

    The pattern keeps out what a plain cast would take (``1d``, ``0x1p3``) and lets ``1_000`` in.
    ``nan`` and ``inf`` are NULL here.
    """
    found = F.regexp_extract(
        as_column(c).cast("string"), rf"(?U)\A{SPACE}*{_NUMBER}{SPACE}*{tail}\z", 1
    )
    return F.replace(found, F.lit("_"), F.lit("")).try_cast("double")


_ONE_PERCENT_SIGN = rf"%?{SPACE}*"
_PERCENT_SIGNS = "%*"


def parse_number(c: Column | str) -> Column:
    """Decimal text to double, else NULL."""
    return _number_in(c, "")


def stat_value(c: Column | str) -> Column:
    """Stat text to double: a plain number, else the first number inside the text."""
    text = as_column(c).cast("string")
    first = F.regexp_extract(text, r"(-?[0-9]++\.?+[0-9]*+)", 1)
    return F.coalesce(_number_in(text, _ONE_PERCENT_SIGN), first.try_cast("double"))


def percentile(c: Column | str) -> Column:
    """Percentile text to 0..1: values above 1 are per cent, then clamped."""
    number = _number_in(c, _ONE_PERCENT_SIGN)
    return (
        F.when(number > 1, F.least(F.lit(1.0), number / 100.0))
        .when(number < 0, 0.0)
        .otherwise(number)
    )


def percentile_over_100(c: Column | str) -> Column:
    """Percentile text always divided by 100, not clamped (the reading used for stored rows)."""
    return _number_in(c, _PERCENT_SIGNS) / 100.0


def grade(c: Column | str) -> Column:
    """Grade text to one of the known grades by its beginning, else NULL."""
    known = "|".join(g.replace("+", r"\+") for g in sorted(GRADES, key=len, reverse=True))
    found = F.regexp_extract(
        F.upper(as_column(c).cast("string")), rf"(?U)\A{SPACE}*({known})", 1
    )
    return F.nullif(found, F.lit(""))


def value_or_sentinel(c: Column | str) -> Column:
    """Missing value text becomes the sentinel; other text is kept."""
    text = as_column(c).cast("string")
    return F.when(~text.isin(ITEM_MISSING), text).otherwise(F.lit(MISSING_NUMBER))


def item_value_numeric(c: Column | str) -> Column:
    """Numeric reading of a raw item value; NULL where the sentinel stands in."""
    return stat_value(c)


def is_complete(name: Column | str, stored_value: Column | str) -> Column:
    """Named and not the sentinel; unparsable text still counts as complete."""
    return as_column(name).isNotNull() & ~as_column(stored_value).eqNullSafe(F.lit(MISSING_NUMBER))
