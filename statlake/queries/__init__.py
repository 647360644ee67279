"""Queries over the test tables, one or more per operator."""

from statlake.queries import (  # noqa: F401
    columns,
    extraction,
    jobs,
    keyed,
    metrics,
    planning,
    possessions,
    progress,
    stores,
    streams,
)
from statlake.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
