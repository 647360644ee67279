"""Captured responses: filters, stats from their JSON bodies, the best response per page."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statlake.functions.jsontext import bind, first_filled, is_json, json_document
from statlake.functions.text import as_column, text_or_null
from statlake.operators.extract.entries import NAME_FIELDS, stats_from_list
from statlake.operators.extract.objects import count_named, has_named
from statlake.operators.extract.scripts import extraction
from statlake.operators.ordered import first_rows_per_key

# URL parts and content types of responses worth keeping.
CAPTURE_URL_PARTS = ["/api/", "/graphql", "/_next/data/", "/player", "/stats"]
CAPTURE_CONTENT_TYPES = ["json", "application/javascript"]
GRAPHQL_PART = "/graphql"
KEEP_RESPONSES = 100  # of a page, where only the last are to be kept or listed


def _contains_any(c: Column, parts: Sequence[str]) -> Column:
    found = F.lit(False)
    for part in parts:
        found = found | F.contains(c, F.lit(part))
    return F.coalesce(found, F.lit(False))


def is_capturable(
    url: Column | str, content_type: Column | str, parts: Sequence[str] = CAPTURE_URL_PARTS
) -> Column:
    """URL and content type of a response worth keeping."""
    return _contains_any(as_column(url), parts) & _contains_any(
        F.lower(as_column(content_type)), CAPTURE_CONTENT_TYPES
    )


def capture_json(responses: DataFrame, parts: Sequence[str] = CAPTURE_URL_PARTS) -> DataFrame:
    """Responses with a fitting URL and content type whose body is JSON."""
    return responses.where(is_capturable("url", "content_type", parts) & is_json("body"))


def json_responses(responses: DataFrame) -> DataFrame:
    """Responses whose JSON body is not an empty value."""
    return responses.where(json_document("body").isNotNull())


def is_graphql(url: Column | str) -> Column:
    return F.contains(as_column(url), F.lit(GRAPHQL_PART))


def graphql_responses(responses: DataFrame) -> DataFrame:
    return responses.where(is_graphql("url") & is_json("body"))


def stats_responses(responses: DataFrame) -> DataFrame:
    """Responses whose body looks like stats somewhere inside."""
    return json_responses(responses).where(has_stats(F.col("body")))


def keep_last_responses(
    responses: DataFrame, keys: Sequence[str] = ("page_id",), order: str = "seq",
    keep: int = KEEP_RESPONSES,
) -> DataFrame:
    """The last ``keep`` responses of each page."""
    return first_rows_per_key(responses, keys, [order], keep, descending=True)


# Keys that mark a stats-like object.
LIKELY_KEYS = ["stats", "statistics", "playerStats", "metrics", "grades"]
VALUE_KEYS = ["value", "percentile", "grade", "rank"]
COUNTED_KEYS = ["value", "percentile", "grade", "stat", "score"]


def _objects(text, max_depth, max_items):
    """JSON objects of a text, down to a depth and among the first items of lists.

    Text that is not JSON, or nested deeper than the parser goes, holds none.
    """
    import json

    try:
        todo = [(json.loads(text), 0)]
    except (TypeError, ValueError, RecursionError):
        return
    while todo:
        node, depth = todo.pop()
        if isinstance(node, dict):
            yield node
            below = node.values()
        elif isinstance(node, list):
            below = node if max_items is None else node[:max_items]
        else:
            continue
        if max_depth is None or depth < max_depth:
            todo.extend((x, depth + 1) for x in below if isinstance(x, (dict, list)))


def has_stats(
    text: Column | str, max_depth: int | None = None, max_items: int | None = None
) -> Column:
    """JSON text holds a stats-like object; Python is used only where limits are given."""
    if max_depth is None and max_items is None:
        return has_named(as_column(text), LIKELY_KEYS, VALUE_KEYS)

    @F.pandas_udf(T.BooleanType())
    def found(texts: pd.Series) -> pd.Series:
        likely, values = frozenset(LIKELY_KEYS), frozenset(VALUE_KEYS)

        def marked(keys):
            return not likely.isdisjoint(keys) or len(values.intersection(keys)) > 1

        return texts.map(lambda t: any(marked(n.keys()) for n in _objects(t, max_depth, max_items)))

    return found(as_column(text))


def count_stats(
    text: Column | str, max_depth: int | None = None, max_items: int | None = None
) -> Column:
    """Number of stat-like objects in JSON text; Python is used only where limits are given."""
    if max_depth is None and max_items is None:
        return count_named(as_column(text), COUNTED_KEYS)

    @F.pandas_udf(T.LongType())
    def counted(texts: pd.Series) -> pd.Series:
        wanted = frozenset(COUNTED_KEYS)

        def count(t):
            nodes = _objects(t, max_depth, max_items)
            return sum(1 for n in nodes if any(k.lower() in wanted for k in n))

        return texts.map(count)

    return counted(as_column(text))


_BODY = """
    struct<stats string, playerStats string, playerId string, playerName string,
        data struct<stats string, player struct<stats string, id string, name string>>>
"""


def extract_captured(body: Column | str, falsy_chain: bool = False) -> Column:
    """Extraction struct from one JSON body."""

    def from_body(b: Column) -> Column:
        player = b["data"]["player"]
        stats = first_filled(
            [b["stats"], b["playerStats"], b["data"]["stats"], player["stats"]]
        )
        return extraction(
            F.coalesce(text_or_null(b["playerId"]), text_or_null(player["id"])),
            F.coalesce(text_or_null(b["playerName"]), text_or_null(player["name"])),
            F.lit(None),
            bind(stats, lambda found: stats_from_list(found, None, falsy_chain)),
        )

    return bind(F.from_json(as_column(body), _BODY), from_body)


def best_captured(
    responses: DataFrame, keys: Sequence[str] = ("page_id",), order: str = "seq",
    falsy_chain: bool = False,
) -> DataFrame:
    """Per page the extraction of the response with most stats; ties go to the earliest.

    An aggregate, so that each task sends one candidate per page and a page with very many
    responses never meets in one task as a whole. Responses without stats, often nearly all, are gone
    before it: a body that names no field of a stat's name is not parsed (a backslash may hide one), and
    only of bodies with stats is it asked whether all of the text is JSON.
    """
    named = responses.where(_contains_any(F.col("body"), [*NAME_FIELDS, "\\"]))
    found = F.filter(
        F.array(extract_captured("body", falsy_chain)),
        lambda x: (F.size(x["stats"]) > 0) & is_json("body"),
    )
    # The outer form, as in explode_stats: no filter that names the extraction reaches the scan.
    parsed = named.select(*keys, order, F.explode_outer(found).alias("captured"))
    rank = F.struct(F.size("captured.stats"), -F.col(order))
    return parsed.where(F.col("captured").isNotNull()).groupBy(*keys).agg(
        F.max_by("captured", rank).alias("captured")
    )


def capture_summary(
    responses: DataFrame, keys: Sequence[str] = ("page_id",), order: str = "seq",
    listed: int = KEEP_RESPONSES,
) -> DataFrame:
    """Counts of all responses by kind, and the last ``listed`` URLs in order."""
    counts = (
        responses.withColumns({"_json": is_json("body"), "_stats": has_stats(json_document("body"))})
        .groupBy(*keys)
        .agg(
            F.count("*").alias("total_responses"),
            F.count_if("_json").alias("json_responses"),
            F.count_if("_stats").alias("stats_responses"),
            F.count_if(is_graphql("url") & F.col("_json")).alias("graphql_responses"),
        )
    )
    last = keep_last_responses(responses.select(*keys, order, "url"), keys, order, listed)
    urls = F.transform(
        F.array_sort(F.collect_list(F.struct(F.col(order).alias("seq"), "url"))),
        lambda u: u["url"],
    )
    return counts.join(last.groupBy(*keys).agg(urls.alias("urls")), list(keys))
