"""Profile URLs: parsing, canonical form, building, keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from statlake.functions.text import as_column, text_or_null

# Fixed value: path shape of a profile page, /player-profiles/<season>/<slug>/<id>.
PROFILE_PATH = r"/player-profiles/([0-9]{4}-[0-9]{4})/([^/]+)/([0-9]+)"

DEFAULT_BASE = "https://stats.example.org"


def _part(url: Column | str, group: int, pattern: str) -> Column:
    return text_or_null(F.regexp_extract(as_column(url), pattern, group))


def url_season(url: Column | str, pattern: str = PROFILE_PATH) -> Column:
    return _part(url, 1, pattern)


def url_slug(url: Column | str, pattern: str = PROFILE_PATH) -> Column:
    return _part(url, 2, pattern)


def url_player_id(url: Column | str, pattern: str = PROFILE_PATH) -> Column:
    return _part(url, 3, pattern)


def parse_profile_url(url: Column | str, pattern: str = PROFILE_PATH) -> Column:
    """STRUCT(season, player_slug, player_id, full_url), or NULL for other URLs.

    The pattern's three groups are season, slug and id.
    """
    u = as_column(url)
    return F.when(
        u.rlike(pattern),
        F.struct(
            url_season(u, pattern).alias("season"),
            url_slug(u, pattern).alias("player_slug"),
            url_player_id(u, pattern).alias("player_id"),
            u.alias("full_url"),
        ),
    )


def is_profile_url(url: Column | str, pattern: str = PROFILE_PATH) -> Column:
    return F.coalesce(as_column(url).rlike(pattern), F.lit(False))


_SPLIT = r"^([^:/?#]*)://([^/?#]*)([^?#]*)"


def with_scheme(url: Column | str) -> Column:
    """Put ``https://`` before a URL that does not begin with ``http``."""
    u = as_column(url)
    return F.when(u.startswith("http"), u).otherwise(F.concat(F.lit("https://"), u))


def normalize_url(url: Column | str) -> Column:
    """Scheme, host and path only; trailing slashes dropped, scheme in lower case."""
    full = with_scheme(url)
    return F.concat(
        F.lower(F.regexp_extract(full, _SPLIT, 1)),
        F.lit("://"),
        F.regexp_extract(full, _SPLIT, 2),
        F.regexp_replace(F.regexp_extract(full, _SPLIT, 3), r"/+\z", ""),
    )


def domain(url: Column | str) -> Column:
    """Host with its port; empty text where the URL has no ``//`` part."""
    return F.regexp_extract(as_column(url), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1)


def build_profile_url(
    season: Column | str, slug: Column | str, player_id: Column | str, base: str = DEFAULT_BASE
) -> Column:
    """``<base>/player-profiles/<season>/<slug>/<id>``; NULL if a part is NULL."""
    return F.concat(
        F.lit(f"{base}/player-profiles/"),
        as_column(season).cast("string"),
        F.lit("/"),
        as_column(slug).cast("string"),
        F.lit("/"),
        as_column(player_id).cast("string"),
    )


def build_list_url(
    season: Column | str | None = None, page: Column | int = 1, base: str = DEFAULT_BASE
) -> Column:
    """``<base>/players`` with the season, and the page number from 2 on, as parameters."""
    season_col = F.lit(None).cast("string") if season is None else as_column(season)
    page_col = F.lit(page) if isinstance(page, int) else page
    query = F.concat_ws(
        "&",
        F.when(season_col != "", F.concat(F.lit("season="), season_col)),
        F.when(page_col > 1, F.concat(F.lit("page="), page_col.cast("string"))),
    )
    return F.concat(
        F.lit(f"{base}/players"),
        F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit("")),
    )


def url_key(player_id: Column | str, season: Column | str) -> Column:
    """``<id>_<season>``; NULL if a part is NULL."""
    return F.concat(
        as_column(player_id).cast("string"), F.lit("_"), as_column(season).cast("string")
    )
