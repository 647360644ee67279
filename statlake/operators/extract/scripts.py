"""Stats from JSON inside script tags: the page-data script and the cache-state script."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from statlake.functions.jsontext import bind, first_filled, is_object, text_map
from statlake.functions.text import as_column, text_or_null
from statlake.operators.extract.entries import (
    ENTRY_STRUCT,
    no_stats,
    stat_from_entry,
    stats_from_json,
)

# The id of the page-data script and the name the cache state is assigned to.
PAGE_DATA_ID = "__NEXT_DATA__"
CACHE_NAME = "__APOLLO_STATE__"

_PAGE_DATA = (
    rf"(?is)<script\b[^>]*\bid\s*=\s*[\"']?(?-i:{PAGE_DATA_ID})(?=[\"'\s>/])[^>]*>(.*?)</script"
)
_SCRIPT = r"(?is)<script\b[^>]*>(.*?)</script"
_CACHE = rf"(?s){CACHE_NAME}\s*=\s*(\{{.+?\}});"


def extraction(
    player_id: Column, player_name: Column, season: Column, stats: Column
) -> Column:
    """The common extraction struct of one source."""
    return F.struct(
        player_id.cast("string").alias("player_id"),
        player_name.cast("string").alias("player_name"),
        season.cast("string").alias("season"),
        stats.alias("stats"),
    )


def page_data_text(html: Column | str) -> Column:
    """Body of the page-data script, NULL where the page has none."""
    page = as_column(html)
    return F.when(
        F.contains(page, F.lit(PAGE_DATA_ID)),
        text_or_null(F.regexp_extract(page, _PAGE_DATA, 1)),
    )


_PAGE_DOC = """
    struct<props struct<pageProps struct<
        player string, playerData string, data struct<player string>,
        stats string, playerStats string, season string>>,
    query struct<season string>>
"""
_PLAYER = """
    struct<id string, playerId string, name string, playerName string, season string,
        stats string, statistics string>
"""


def extract_page_data(doc: Column | str, falsy_chain: bool = False) -> Column:
    """Extraction struct from the text of the page-data script."""
    text = as_column(doc)

    def from_player(page: Column, player: Column) -> Column:
        props = page["props"]["pageProps"]
        stats = first_filled(
            [props["stats"], props["playerStats"], player["stats"], player["statistics"]]
        )
        known = player.isNotNull()
        return extraction(
            F.when(known, F.coalesce(player["id"], player["playerId"], F.lit(""))),
            F.when(known, F.coalesce(player["name"], player["playerName"], F.lit(""))),
            F.coalesce(
                text_or_null(props["season"]),
                text_or_null(player["season"]),
                page["query"]["season"],
            ),
            bind(stats, lambda found: stats_from_json(found, falsy_chain)),
        )

    def from_page(page: Column) -> Column:
        props = page["props"]["pageProps"]
        player = first_filled([props["player"], props["playerData"], props["data"]["player"]])
        return bind(F.from_json(player, _PLAYER), lambda p: from_player(page, p))

    return F.when(text.isNotNull(), bind(F.from_json(text, _PAGE_DOC), from_page))


def cache_state_text(html: Column | str) -> Column:
    """First cache-state object of the page's scripts that parses, NULL where there is none."""
    page = as_column(html)
    bodies = F.filter(
        F.regexp_extract_all(page, F.lit(_SCRIPT), F.lit(1)),
        lambda body: F.contains(body, F.lit(CACHE_NAME)),
    )
    objects = F.filter(
        F.transform(bodies, lambda body: F.regexp_extract(body, _CACHE, 1)),
        lambda text: text_map(text).isNotNull(),
    )
    return F.when(F.contains(page, F.lit(CACHE_NAME)), F.get(objects, F.lit(0)))


_CACHE_ENTRY = ENTRY_STRUCT.replace("struct<", "struct<__typename string, id string, ", 1)


def _is_player(entry: Column) -> Column:
    return F.contains(entry["key"], F.lit("Player:")) | (
        entry["fields"]["__typename"].eqNullSafe(F.lit("Player"))
    )


def _is_stat(entry: Column) -> Column:
    kind = F.lower(F.coalesce(entry["fields"]["__typename"], F.lit("")))
    return F.contains(entry["key"], F.lit("Stat:")) | F.contains(kind, F.lit("stat"))


def extract_cache_state(doc: Column | str, falsy_chain: bool = False) -> Column:
    """Extraction struct from the cache-state object; the last player entry wins."""
    text = as_column(doc)
    entries = F.transform(
        F.filter(F.map_entries(text_map(text)), lambda e: is_object(e["value"])),
        lambda e: F.struct(
            e["key"].alias("key"), F.from_json(e["value"], _CACHE_ENTRY).alias("fields")
        ),
    )

    def from_entries(items: Column) -> Column:
        stats = F.transform(
            F.filter(items, _is_stat), lambda e: stat_from_entry(e["fields"], None, falsy_chain)
        )
        return bind(
            F.try_element_at(F.filter(items, _is_player), F.lit(-1)),
            lambda player: extraction(
                F.coalesce(
                    text_or_null(player["fields"]["id"]),
                    F.substring_index(player["key"], ":", -1),
                ),
                player["fields"]["name"],
                F.lit(None),
                F.coalesce(F.filter(stats, lambda s: s.isNotNull()), no_stats()),
            ),
        )

    return F.when(text.isNotNull(), bind(entries, from_entries))
