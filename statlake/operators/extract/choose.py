"""Which source a page is read from: by priority, or by the richest data."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statlake.functions.text import DEFAULT_CATEGORY, text_or_null
from statlake.functions.urls import PROFILE_PATH, parse_profile_url
from statlake.operators.extract.captured import best_captured, count_stats
from statlake.operators.extract.entries import explode_stats, no_stats
from statlake.operators.extract.scripts import (
    cache_state_text,
    extract_cache_state,
    extract_page_data,
    extraction,
    page_data_text,
)
from statlake.operators.extract.tables import extract_tables, page_tables

# Names of the sources as stored with each row, in order of priority.
PAGE_DATA, CACHE_STATE, CAPTURED, TABLES, UNKNOWN = (
    "next_data",
    "apollo_state",
    "xhr_json",
    "dom_tables",
    "unknown",
)
PRIORITY = [PAGE_DATA, CACHE_STATE, CAPTURED, TABLES]
NO_SOURCE = "All extraction sources failed"


@dataclass(frozen=True)
class PageSource:
    """A source of stats: ``read(pages, column, needed, falsy_chain)`` adds the extraction struct
    as ``column``.

    ``needed`` is false for pages an earlier source has already answered; a costly source skips
    them. Captured responses are no such source: they are joined once the HTML is gone.
    """

    name: str
    read: Callable[[DataFrame, str, Column, bool], DataFrame]


def empty_extraction() -> Column:
    nothing = F.lit(None).cast("string")
    return extraction(nothing, nothing, nothing, no_stats())


def _read_page_data(df: DataFrame, column: str, needed: Column, falsy: bool) -> DataFrame:
    text = F.when(needed, page_data_text("html"))
    return df.withColumn("_text", text).withColumn(column, extract_page_data("_text", falsy))


def _read_cache_state(df: DataFrame, column: str, needed: Column, falsy: bool) -> DataFrame:
    text = F.when(needed, cache_state_text("html"))
    return df.withColumn("_text", text).withColumn(column, extract_cache_state("_text", falsy))


def _read_tables(df: DataFrame, column: str, needed: Column, falsy: bool) -> DataFrame:
    parsed = df.withColumn("_parsed", page_tables("html", needed))
    return parsed.withColumn(column, extract_tables(F.col("_parsed"))).drop("_parsed")


SOURCES = {
    PAGE_DATA: PageSource(PAGE_DATA, _read_page_data),
    CACHE_STATE: PageSource(CACHE_STATE, _read_cache_state),
    TABLES: PageSource(TABLES, _read_tables),
}


def register_source(source: PageSource) -> None:
    """Make a further source known; name it in a priority list to use it."""
    SOURCES[source.name] = source


def with_captured(
    pages: DataFrame, responses: DataFrame | None, falsy_chain: bool = False
) -> DataFrame:
    """Add each page's best captured response."""
    if responses is None:
        return pages.withColumn("captured", F.when(F.lit(False), empty_extraction()))
    return pages.join(best_captured(responses, falsy_chain=falsy_chain), "page_id", "left")


def extract_pages(
    pages: DataFrame, responses: DataFrame | None = None,
    priority: Sequence[str] = tuple(PRIORITY), falsy_chain: bool = False,
) -> DataFrame:
    """Extract every page from its first source with stats; one row per page.

    Adds ``source``, ``extracted`` and ``error``; a page no source can read has the source
    ``unknown`` and an error. The HTML is read where it lies: what is joined with the captured
    responses is only what was extracted. So a page they answer may have its tables read in vain,
    which costs less than to shuffle all pages.
    """
    df = pages
    answered = F.lit(False)
    found = []
    for i, name in enumerate(priority):
        column = "captured" if name == CAPTURED else f"_x{i}"
        hit = F.coalesce(F.size(F.col(column)["stats"]), F.lit(0)) > 0
        found.append((name, hit, F.col(column)))
        if name != CAPTURED:
            df = SOURCES[name].read(df, column, ~answered, falsy_chain)
            answered = answered | hit
    df = with_captured(df.drop("html"), responses, falsy_chain)
    source, extracted = F.lit(UNKNOWN), empty_extraction()
    for name, hit, column in reversed(found):
        source = F.when(hit, name).otherwise(source)
        extracted = F.when(hit, column).otherwise(extracted)
    return df.select(
        *[c for c in pages.columns if c != "html"],
        source.alias("source"),
        extracted.alias("extracted"),
        F.when(source == UNKNOWN, NO_SOURCE).alias("error"),
    )


def with_identity(extracted: DataFrame, pattern: str = PROFILE_PATH) -> DataFrame:
    """One row per page with who it is about: as the seed says, else the URL, else the payload."""
    # A column of its own, so that a URL is parsed once and not for each part.
    named = extracted.withColumn("_named", parse_profile_url("url", pattern))

    def given(name: str) -> Column:
        if name in extracted.columns:
            return F.coalesce(text_or_null(F.col(name).cast("string")), F.col("_named")[name])
        return F.col("_named")[name]

    return named.select(
        "page_id",
        "url",
        F.coalesce(given("player_id"), text_or_null(F.col("extracted.player_id"))).alias(
            "player_id"
        ),
        F.col("extracted.player_name").alias("player_name"),
        given("player_slug").alias("player_slug"),
        F.coalesce(given("season"), F.col("extracted.season")).alias("season"),
        "source",
        F.col("extracted.stats").alias("stats"),
        "error",
    )


def stat_rows(extracted: DataFrame, run_ts: Column, pattern: str = PROFILE_PATH) -> DataFrame:
    """One row per stat."""
    return identified_rows(with_identity(extracted, pattern), run_ts)


def identified_rows(identified: DataFrame, run_ts: Column) -> DataFrame:
    """One row per stat, of pages ``with_identity``."""
    rows = explode_stats(
        identified,
        [
            "page_id",
            "player_id",
            "player_name",
            "player_slug",
            F.col("url").alias("player_url"),
            "season",
            F.col("source").alias("extraction_source"),
            F.col("url").alias("page_url"),
            run_ts.cast("timestamp").alias("extracted_at"),
        ],
        "stats",
    )
    return rows.select(
        "*",
        "_stat.statistic_name",
        "_stat.value",
        "_stat.percentile",
        "_stat.grade",
        F.coalesce("_stat.statistic_category", F.lit(DEFAULT_CATEGORY)).alias(
            "statistic_category"
        ),
    ).drop("_stat")


def best_source(pages: DataFrame, responses: DataFrame | None = None) -> DataFrame:
    """Per page the source with most stat-like entries, ties to the earlier one.

    The first captured response with any entries speaks for all of them, and tables count their
    body rows.
    """
    df = pages.withColumns(
        {
            "_page": count_stats(page_data_text("html")),
            "_cache": count_stats(cache_state_text("html")),
            "_tables": page_tables("html"),
        }
    )
    if responses is None:
        df = df.withColumn("_captured", F.lit(None).cast("bigint"))
    else:
        counted = responses.select("page_id", "seq", count_stats("body").alias("_n")).where(
            F.col("_n") > 0
        )
        first = counted.groupBy("page_id").agg(F.min_by("_n", "seq").alias("_captured"))
        df = df.join(first, "page_id", "left")
    counts = [
        (PAGE_DATA, F.col("_page")),
        (CACHE_STATE, F.col("_cache")),
        (CAPTURED, F.col("_captured")),
        (TABLES, F.col("_tables.body_rows")),
    ]
    ranked = F.array(
        *[
            F.struct(
                F.coalesce(n, F.lit(0)).alias("n"), F.lit(-i).alias("rank"), F.lit(name).alias("name")
            )
            for i, (name, n) in enumerate(counts)
        ]
    )
    kept = [c for c in pages.columns if c != "html"]
    best = F.array_max(ranked)
    df = df.select(*kept, best.alias("_best"), F.col("_tables.tables").alias("_n_tables"))
    n = F.col("_best.n")
    source = F.when(n > 0, F.col("_best.name")).otherwise(UNKNOWN)
    reason = (
        F.when(source == UNKNOWN, F.lit("No suitable extraction source found"))
        .when(source == PAGE_DATA, F.format_string("Found page data with %d stats", n))
        .when(source == CACHE_STATE, F.format_string("Found cache state with %d stats", n))
        .when(source == CAPTURED, F.format_string("Found captured JSON with %d stats", n))
        .otherwise(F.format_string("Found %d tables with %d rows", F.col("_n_tables"), n))
    )
    return df.select(*kept, source.alias("best_source"), n.alias("n_stats"), reason.alias("reason"))


def inspect_pages(pages: DataFrame) -> DataFrame:
    """Per page and page source: stats found, a sample, the categories, and the page's best source.

    Most stats wins, ties to the earlier source.
    """
    names = [PAGE_DATA, CACHE_STATE, TABLES]
    df = pages
    for name in names:
        df = SOURCES[name].read(df, name, F.lit(True), False)
    reports = [
        F.struct(
            F.coalesce(F.size(F.col(name)["stats"]), F.lit(0)).alias("n_stats"),
            F.lit(-i).alias("rank"),
            F.lit(name).alias("source"),
            F.col(name)["player_name"].alias("player_name"),
            F.get(F.col(name)["stats"], F.lit(0))["statistic_name"].alias("sample"),
            F.array_sort(
                F.array_distinct(
                    F.transform(F.col(name)["stats"], lambda s: s["statistic_category"])
                )
            ).alias("categories"),
        )
        for i, name in enumerate(names)
    ]
    kept = [c for c in pages.columns if c != "html"]
    top = F.array_max(
        F.transform(F.col("_reports"), lambda r: F.struct(r["n_stats"], r["rank"], r["source"]))
    )
    return (
        df.select(*kept, F.array(*reports).alias("_reports"))
        .withColumn("best_source", F.when(top["n_stats"] > 0, top["source"]))
        .select(*kept, "best_source", F.explode_outer("_reports").alias("_r"))
        .select(
            *kept,
            "_r.source",
            (F.col("_r.n_stats") > 0).alias("success"),
            "_r.n_stats",
            "_r.player_name",
            "_r.sample",
            "_r.categories",
            "best_source",
        )
    )


def raw_payloads(pages: DataFrame, responses: DataFrame | None = None) -> DataFrame:
    """Raw payloads beside the parsed rows: (page_id, source, payload)."""
    parts = F.array(
        F.struct(F.lit("html").alias("source"), F.col("html").alias("payload")),
        F.struct(F.lit(PAGE_DATA).alias("source"), page_data_text("html").alias("payload")),
        F.struct(F.lit(CACHE_STATE).alias("source"), cache_state_text("html").alias("payload")),
    )
    out = pages.select("page_id", F.explode_outer(parts).alias("_p")).select("page_id", "_p.*")
    if responses is not None:
        out = out.unionByName(
            responses.select("page_id", F.lit(CAPTURED).alias("source"), F.col("body").alias("payload"))
        )
    return out.where(F.col("payload").isNotNull())
