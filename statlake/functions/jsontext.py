"""JSON held as text: validity, emptiness, object entries, first non-empty choice."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from statlake.functions.text import as_column

TEXT_MAP = "map<string,string>"

# JSON text that counts as empty.
EMPTY_JSON = ["", "null", "false", "0", "0.0", "-0.0", "[]", "{}", '""']


def is_json(c: Column | str) -> Column:
    """Parses as one JSON value of any type, with nothing after it.

    The parsers stop at the end of the first value. Inside ``[...]`` and ``[...,0]`` the text is
    a whole value exactly if the lists have one and two items.
    """
    text = as_column(c)
    alone = F.json_array_length(F.concat(F.lit("["), text, F.lit("]")))
    followed = F.json_array_length(F.concat(F.lit("["), text, F.lit(",0]")))
    return F.coalesce((alone == 1) & (followed == 2), F.lit(False))


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, with the value worked out once however often the body names it.

    A column expression is copied into every place that names it; the argument of a lambda is not.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def is_filled(c: Column | str) -> Column:
    """Compact JSON text, as Spark's JSON functions give it, that is not NULL or an empty value."""
    return F.coalesce(~as_column(c).isin(EMPTY_JSON), F.lit(False))


def json_document(c: Column | str) -> Column:
    """Body text where it is JSON and not an empty value, else NULL."""
    text = as_column(c)
    bare = F.regexp_replace(F.trim(text), r"\A([\[{])\s+([\]}])\z", "$1$2")
    return F.when(is_json(text) & is_filled(bare), text)


def first_filled(choices: Sequence[Column]) -> Column:
    """First choice that is not empty."""
    return F.coalesce(*[F.when(is_filled(c), c) for c in choices])


def is_object(c: Column) -> Column:
    return c.rlike(r"\A\s*\{")


def is_list(c: Column) -> Column:
    return c.rlike(r"\A\s*\[")


def text_map(c: Column) -> Column:
    """JSON object to MAP<STRING, STRING> in document order; nested values stay JSON text."""
    return F.when(is_object(c), F.from_json(c, TEXT_MAP))


def list_items(c: Column) -> Column:
    """JSON list to ARRAY<STRING>; each item stays JSON text."""
    return F.when(is_list(c), F.from_json(c, "array<string>"))
