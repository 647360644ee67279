"""Text columns: stripping, title case, names, categories, cell text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text that stands for "no value", per operator.
CELL_MISSING = ["", "-", "—", "N/A"]
ITEM_MISSING = ["", "-"]
NAME_MISSING = ["", "unknown", "n/a"]

# Category spellings and what they become, applied in this order.
CATEGORY_SPELLINGS = [
    ("Post-Play", "Post Play"),
    ("Postplay", "Post Play"),
    ("Post Up", "Post Play"),
    ("3-Point", "Three Point"),
    ("3 Point", "Three Point"),
    ("3pt", "Three Point"),
]
DEFAULT_CATEGORY = "General"

# White space as in Unicode, with the four separators that (?U)\s leaves out.
SPACE = r"[\s\x1c-\x1f]"
_CASED = r"\p{Lu}\p{Ll}\p{Lt}"


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Strip all Unicode white space at both ends (``trim`` knows the blank only)."""
    # The look-behind lets a run of white space be tried from its start only.
    return F.regexp_replace(
        as_column(c).cast("string"), rf"(?U)\A{SPACE}++|(?<!{SPACE}){SPACE}++\z", ""
    )


def squeeze(c: Column | str) -> Column:
    """Strip, and turn every run of white space into one blank."""
    return F.regexp_replace(strip(c), rf"(?U){SPACE}+", " ")


def title_case(c: Column | str) -> Column:
    """Upper-case the first letter of every run of letters, lower-case the others.

    ``initcap`` restarts at blanks only, so ``o'neal`` or ``post-play`` need the runs split first.
    """
    runs = F.regexp_extract_all(as_column(c), F.lit(rf"([{_CASED}]+|[^{_CASED}]+)"), F.lit(1))
    return F.array_join(F.transform(runs, lambda run: F.initcap(run)), "")


def player_name(c: Column | str) -> Column:
    """Title-cased name with single blanks; NULL for blank, ``unknown`` and ``n/a``."""
    plain = squeeze(c)
    return F.when(~F.lower(plain).isin(NAME_MISSING), title_case(plain))


def stat_category(c: Column | str, strict: bool = False) -> Column:
    """Category label in one spelling; blank becomes ``General``.

    ``strict`` replaces only the exact case left by title-casing, so that ``3pt`` stays ``3Pt``.
    """
    out = title_case(squeeze(c))
    flag = "" if strict else "(?i)"
    for new in dict.fromkeys(new for _, new in CATEGORY_SPELLINGS):
        olds = "|".join(rf"\Q{old}\E" for old, to in CATEGORY_SPELLINGS if to == new)
        out = F.regexp_replace(out, f"{flag}(?:{olds})", new)
    filled = as_column(c).cast("string").rlike(rf"(?U)[^\s\x1c-\x1f]")
    return F.when(filled, out).otherwise(F.lit(DEFAULT_CATEGORY))


def cell_text(c: Column | str) -> Column:
    """Text of a table cell: stripped, missing markers to NULL."""
    plain = strip(c)
    return F.when(~plain.isin(CELL_MISSING), plain)


def text_or_null(c: Column | str) -> Column:
    """Empty text to NULL."""
    # The array holds the value, which may be a long expression, once; nullif would name it twice.
    return F.get(F.filter(F.array(as_column(c)), lambda x: x != ""), F.lit(0))


def setting_int(c: Column | str, default: int) -> Column:
    """Whole-number setting from text, the default where it does not parse."""
    return F.coalesce(strip(c).try_cast("int"), F.lit(default))


def setting_float(c: Column | str, default: float) -> Column:
    """Number setting from text, the default where it does not parse."""
    return F.coalesce(strip(c).try_cast("double"), F.lit(default))


def iso_time(c: Column | str) -> Column:
    """ISO-8601 text with microseconds, no zone."""
    return F.date_format(as_column(c), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
