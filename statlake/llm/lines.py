"""Line dedup by site: lines that too large a part of a host's pages has are boilerplate and go.

A page's lines are its text between block tags; they are made once and kept below spark.checkpoint.dir with
the other columns, without the HTML. For each host and line the pages that have the line are
counted, with map-side partials, and divided by the host's pages. A host's boilerplate is a short list
(of lines beyond ``ratio`` there are at most 1 / ratio times as many as a page of the host has on
average) and is joined to the pages by host as one value. All lists together are measured: up to
``SENT_BYTES`` they go to every task and the lines stay where they are; beyond that both sides meet by
host and one of ``SALTS`` parts, so that a hot host is spread.

Cases: a NULL URL or one without a host has the host ''; a NULL or empty page has no lines. A line that
a page repeats counts once for it and is dropped at all its places. Pages of hosts with fewer than
``min_pages`` pages with a line keep it. Rows are pages, so repeated rows count as pages. An empty table
gives an empty result. Other columns are kept; columns named host, lines, n_lines or n_dropped are
replaced, and one named common goes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statlake.functions.jsontext import bind
from statlake.llm.scratch import scratch_table

RATIO, MIN_PAGES = 0.1, 3
SENT_BYTES, SALTS = 8 << 20, 64

# Patterns that Java and RE2 read alike. Java needs time with the square of openings that nothing closes,
# so these are kept from it (``without_unshown``, ``blocks_split``).
HOST = "^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"
UNSHOWN = "(?is)<script[ \t\r\n>].*?</script[^>]*>|<style[ \t\r\n>].*?</style[^>]*>|<!--.*?-->"
UNSHOWN_ENDS = (("script[ \t\r\n>]", "</script"), ("style[ \t\r\n>]", "</style"), ("!--", "-->"))
# The same matches by patterns that only Java reads, which take a text in long steps and keep no way back.
_TO_END = {name: f"[^<]*+(?:<(?!/{name})[^<]*+)*+</{name}" for name in ("script", "style")}
_SHUT = (
    f"s(?:cript[ \t\r\n>]{_TO_END['script']}|tyle[ \t\r\n>]{_TO_END['style']})[^>]*+>|!--[^-]*+(?:-(?!->)[^-]*+)*+-->"
)
UNSHOWN_JAVA = f"(?i)<(?:{_SHUT})"
# A page in which all that opens is closed, read once from left to right.
ALL_SHUT = f"(?i)\\A[^<]*+(?:<(?:{_SHUT}|(?!s(?:cript|tyle)[ \t\r\n>]|!--))[^<]*+)*+\\z"
MARK = "\ufdd0\u0001\ufdd1"  # noncharacters
BLOCK_TAGS = (
    "p|div|li|ul|ol|dl|dt|dd|h[1-6]|table|tr|td|th|br|hr|article|section|aside|nav|header|footer|main|"
    "title|head|body|html|form|blockquote|pre|address|figure|figcaption|option|select|button"
)
BLOCK = f"(?i)</?(?:{BLOCK_TAGS})(?:[ \t\r\n/][^>]*)?>"
# The same tags by their first letters.
BLOCK_JAVA = (
    "(?i)</?+(?:p(?:re)?|d(?:iv|[ldt])|li|ul|h(?:[1-6r]|ead(?:er)?|tml)|t(?:able|[rdh]|itle)|b(?:r|ody|lockquote|utton)|"
    "o(?:l|ption)|a(?:rticle|side|ddress)|se(?:ction|lect)|f(?:ooter|orm|ig(?:ure|caption))|nav|main)"
    "(?:[ \t\r\n/][^>]*+)?>"
)
TAG = "<[^>]*>"
OPEN_TAG = "<[^>]*+\\z"  # stays; taken as one so that nothing within it is tried
SPACES = "[ \t\r\f ]+"
SPACES_JAVA = "[ \t\r\f ]{2,}+|[\t\r\f ]"  # all but a single space
ENTITIES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"))


def host_of(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, HOST, 1), F.lit("")))


def split_at(text: Column, last: str, body: Callable[[Column, Column], Column]) -> Column:
    """``body`` of a text up to its last match of a pattern, and of the rest."""
    return bind(
        F.regexp_extract(text, f"(?is)\\A.*{last}", 0),
        lambda front: body(front, F.substr(text, F.length(front) + 1)),
    )


def behind(text: Column, last: str) -> Column:
    """A text behind the last place of a word, or the whole one without it."""
    return F.substring_index(text, last, -1)


def unclosed_marked(text: Column, opening: str, closing: str) -> Column:
    """Openings that nothing behind them closes get ``MARK`` after their ``<``."""

    def marked(front: Column, rest: Column) -> Column:
        return F.concat(front, F.regexp_replace(rest, f"(?i)<({opening})", f"<{MARK}$1"))

    return bind(text, lambda t: split_at(t, closing, marked))


def without_unshown(text: Column) -> Column:
    """A text without scripts, styles and comments.

    Where something may be open to the end, the patterns see what lies before the last ``>``, with open
    ones marked; both ways give the same. A text that holds ``MARK`` itself is not marked.
    """
    plain = F.regexp_replace(text, UNSHOWN_JAVA, " ")

    def marked_front(front: Column, rest: Column) -> Column:
        marked = front
        for opening, closing in UNSHOWN_ENDS:
            marked = unclosed_marked(marked, opening, closing)
        shown = F.replace(F.regexp_replace(marked, UNSHOWN_JAVA, " "), F.lit(f"<{MARK}"), F.lit("<"))
        return F.concat(shown, rest)

    marked = bind(text, lambda t: split_at(t, ">", marked_front))
    return F.when(~text.rlike(ALL_SHUT) & ~F.contains(text, F.lit(MARK)), marked).otherwise(plain)


def blocks_split(text: Column) -> Column:
    """Line ends for block tags. All end with ``>``: behind the last one there is nothing to try."""

    def split(t: Column) -> Column:
        plain = F.regexp_replace(t, BLOCK_JAVA, "\n")
        front_only = split_at(t, ">", lambda front, rest: F.concat(F.regexp_replace(front, BLOCK_JAVA, "\n"), rest))
        return F.when(F.contains(behind(t, ">"), F.lit("<")), front_only).otherwise(plain)

    return bind(text, split)


def lines_of(html: Column) -> Column:
    """The lines of a page that are not blank, spaces collapsed."""
    text = blocks_split(without_unshown(F.coalesce(html, F.lit(""))))
    text = F.regexp_replace(text, f"{TAG}|({OPEN_TAG})", "$1")
    for entity, letter in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(letter))
    text = F.trim(F.regexp_replace(text, SPACES_JAVA, " "), F.lit(" \n"))
    return F.filter(F.split(text, " ?+\n[ \n]*+"), lambda line: line != "")


def boilerplate(pages: DataFrame, ratio: float, min_pages: int) -> DataFrame:
    """(host, common): for each host that has any, the lines that go. ``pages`` has host and lines."""
    totals = pages.groupBy("host").agg(F.count("*").alias("pages"))
    # Outer, with a filter behind it: of lines that are not stored, a plain explode has Spark test the array's
    # size at the scan, and with it parse every page once more.
    own = pages.select("host", F.explode_outer(F.array_distinct("lines")).alias("line"))
    own = own.where(F.col("line").isNotNull())
    counts = own.groupBy("host", "line").agg(F.count("*").alias("n")).where(F.col("n") >= min_pages)
    many = counts.join(totals, "host").where(F.col("n") > ratio * F.col("pages"))
    return many.groupBy("host").agg(F.collect_list("line").alias("common"))


def with_common(pages: DataFrame, common: DataFrame, sent_bytes: int) -> DataFrame:
    """``pages`` with the list of their host, NULL where it has none."""
    size = common.agg(F.sum(F.octet_length("host") + F.octet_length(F.array_join("common", "\n")))).first()[0]
    if (size or 0) <= sent_bytes:
        return pages.join(F.broadcast(common), "host", "left")
    salts = F.array(*map(F.lit, range(SALTS)))
    salted = pages.withColumn("_salt", F.pmod(F.xxhash64("lines"), F.lit(SALTS)).cast("int"))
    return salted.join(common.withColumn("_salt", F.explode(salts)), ["host", "_salt"], "left").drop("_salt")


def drop_boilerplate(
    pages: DataFrame,
    url: str = "url",
    html: str = "html",
    ratio: float = RATIO,
    min_pages: int = MIN_PAGES,
    sent_bytes: int = SENT_BYTES,
) -> DataFrame:
    """``pages`` without the HTML, with host, n_lines, lines (those kept) and n_dropped."""
    parsed = pages.withColumn("host", host_of(F.col(url))).withColumn("lines", lines_of(F.col(html)))
    # The lines are read twice, and to make them costs far more than to keep them.
    parsed = scratch_table(parsed.drop(html, "common", "n_lines", "n_dropped"), "lines")
    common = scratch_table(boilerplate(parsed.select("host", "lines"), ratio, min_pages), "boilerplate")
    kept = F.filter("lines", lambda line: ~F.array_contains(F.col("common"), line))
    joined = with_common(parsed, common, sent_bytes).select(*parsed.columns, "common")
    return (
        joined.withColumn("n_lines", F.size("lines").cast("long"))
        .withColumn("lines", F.when(F.col("common").isNull(), F.col("lines")).otherwise(kept))
        .withColumn("n_dropped", F.col("n_lines") - F.size("lines"))
        .drop("common")
    )


def oracle_sql(ratio: float = RATIO, min_pages: int = MIN_PAGES) -> str:
    """The query op4 in SQL."""
    text = f"regexp_replace(coalesce(html, ''), '{UNSHOWN}', ' ', 'g')"
    text = f"regexp_replace(regexp_replace({text}, '{BLOCK}', chr(10), 'g'), '{TAG}', '', 'g')"
    for entity, letter in ENTITIES:
        text = f"replace({text}, '{entity}', '{letter.replace(chr(39), chr(39) * 2)}')"
    return f"""
    WITH parsed AS (
        SELECT page_id, lower(coalesce(regexp_extract(url, '{HOST}', 1), '')) AS host,
               list_filter(list_transform(
                   string_split(regexp_replace({text}, '{SPACES}', ' ', 'g'), chr(10)),
                   lambda x: trim(x)), lambda x: x <> '') AS lines
        FROM pages
    ),
    counts AS (
        SELECT host, line, count(*) AS n
        FROM (SELECT host, unnest(list_distinct(lines)) AS line FROM parsed) GROUP BY host, line
    ),
    common AS (
        SELECT c.host, list(c.line) AS common
        FROM counts c JOIN (SELECT host, count(*) AS pages FROM parsed GROUP BY host) t ON c.host = t.host
        WHERE n >= {min_pages} AND n > {ratio} * pages GROUP BY c.host
    ),
    kept AS (
        SELECT page_id, p.host, len(lines) AS n_lines,
               CASE WHEN common IS NULL THEN lines
                    ELSE list_filter(lines, lambda x: NOT list_contains(common, x)) END AS own
        FROM parsed p LEFT JOIN common c ON p.host = c.host
    )
    SELECT page_id, host, n_lines, n_lines - len(own) AS n_dropped,
           sha256(array_to_string(own, chr(10))) AS kept_sha256
    FROM kept
    """
