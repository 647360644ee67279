"""Stats from HTML tables.

HTML nesting needs a real parser, so a small helper runs in Arrow batches and reports, per page, the
matched sections with their category and cell texts. Plainly written pages are read by one pattern, and
their layout is kept for pages with the same tags; all others are read by the standard library's
``html.parser``, with equal results. One sweep over the sections carries the category on, and the rows of a table stand at its first
section only, so what a page gives grows with its length. What cells mean is decided in Spark expressions.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import defaultdict
from functools import lru_cache
from html import unescape
from html.parser import HTMLParser
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from statlake.functions.text import DEFAULT_CATEGORY, as_column
from statlake.operators.extract.entries import no_stats, stat_from_cells
from statlake.operators.extract.scripts import extraction

# Class names that mark a stat section or the player's name, heading tags, and
# headings that are column labels and no category.
SECTION_CLASSES = {"stat-section", "stats-container", "stat-table-wrapper"}
SECTION_TAG_CLASS = ("section", "player-stats")
SECTION_CLASS_PART = "category"
ROW_CLASS = "stat-row"
HEADINGS = {"h2", "h3", "h4"}
INNER_HEADING_CLASS = "category-title"
NAME_CLASSES = {"player-name", "entry-title"}
NAME_BOX_CLASS = "player-header"
LABEL_HEADINGS = ["STATISTIC", "VALUE", "PERCENTILE", "GRADE"]

VOID_TAGS = set(
    "area base br col embed hr img input link meta param source track wbr".split()
)
SILENT_TAGS = {"script", "style", "template"}

# Plainly written markup, on which any HTML parser agrees: a text, then a tag whose attribute values are quoted
# or have none, a comment without inner "--", or a doctype. Class as the only attribute is the usual case.
_SPACE = r"[ \t\r\n\f]"
_NAME = r"[A-Za-z][A-Za-z0-9_:.-]*+"
_QUOTED = "\"[^\"]*+\"|'[^']*+'"
_PIECE = re.compile(
    rf"([^<]*+)<(?:(/?)([A-Za-z][A-Za-z0-9-]*+)(?:{_SPACE}++class=\"([^\"&]*+)\"(?={_SPACE}*+/?>))?"
    rf"((?:{_SPACE}++{_NAME}(?:=(?:{_QUOTED}))?+(?=[ \t\r\n\f/>]))*+){_SPACE}*+(/?)>"
    r"|(!--)(?!-?>)(?:[^-]|-(?!-))*+-->|![Dd][Oo][Cc][Tt][Yy][Pp][Ee]\s[^<>\[\"']*+>)"
)
# Pages of a site repeat their markup: so many layouts are kept by their tags, of pages with fewer tags than this.
FRAMES, FRAME_TAGS, SEEN = 256, 2_000, 10_000
_ATTR = re.compile(rf"({_NAME})(?:=({_QUOTED}))?+")
# Tags whose inside some parsers take for plain text. That of script and style ends at their first closing tag,
# with nothing in it that could be taken for another; of the others it is read here if it is no more than text.
RAW_TAGS = {
    "script", "style", "textarea", "title", "iframe", "noembed", "noframes", "noscript", "xmp", "plaintext",
}
_RAW_END = {
    tag: re.compile(
        rf"((?:[^<]++|<(?!/\s*+{tag}|!--))*+)(</{tag}>)" if tag in SILENT_TAGS else rf"([^<&]*+)(</{tag}>)", re.I
    )
    for tag in RAW_TAGS
}

_SECTION = T.StructType(
    [
        T.StructField("node", T.IntegerType()),
        T.StructField("first", T.IntegerType()),
        T.StructField("category", T.StringType()),
        T.StructField("rows", T.ArrayType(T.ArrayType(T.StringType()))),
    ]
)
PAGE_TYPE = T.StructType(
    [
        T.StructField("player_name", T.StringType()),
        T.StructField("tables", T.LongType()),
        T.StructField("body_rows", T.LongType()),
        T.StructField("sections", T.ArrayType(_SECTION)),
    ]
)


class _Node:
    """A tag with the stretch of later tags and of texts that lie inside it."""

    __slots__ = (
        "tag", "classes", "class_text", "at", "end", "text_at", "text_end", "sibling",
        "last_heading", "in_body", "in_name_box", "silent",
    )

    def __init__(self, tag, class_text, parent, at, text_at):
        self.tag, self.class_text, self.at, self.text_at = tag, class_text, at, text_at
        self.classes = class_text.split() if class_text else ()
        self.last_heading = None
        if parent is None:
            self.sibling, self.in_body, self.in_name_box, self.silent = None, False, False, False
            return
        self.sibling = parent.last_heading
        self.in_body = parent.in_body or parent.tag == "tbody"
        self.in_name_box = parent.in_name_box or NAME_BOX_CLASS in parent.classes
        self.silent = parent.silent or tag in SILENT_TAGS
        if tag in HEADINGS:
            parent.last_heading = self


def _value(attr):
    return unescape(attr[2][1:-1]) if attr[2] else ""


class _Page:
    """Tags and texts of a page in document order.

    Open tags nest until closed; a closing tag without an open partner is passed over.
    """

    def __init__(self, html):
        if not self.read_plain(html):
            self._start()
            parser = _Tolerant(self)
            parser.feed(html)
            parser.close()
        self.finish()

    def finish(self):
        self.flush()
        self._shut(0)

    def _start(self):
        self.nodes, self.texts, self.pieces = [], [], []
        self.by_tag = defaultdict(list)
        self.open = [_Node("", "", None, -1, 0)]
        self.depths = defaultdict(list)  # of each tag, where it is open

    def read_plain(self, html):
        """Read a page of plainly written markup, as the parser of the standard library would in several
        times the time; False where anything else turns up, which is left to that parser."""
        self._start()
        at, piece = 0, _PIECE.match
        while found := piece(html, at):
            text, close, tag, class_text, attrs, alone, comment = found.groups()
            at = found.end()
            if text:
                self.pieces.append(_plain_text(text))
            if tag is None:
                if comment:
                    self.flush()
                continue
            tag = tag.lower()
            if close:
                if class_text or attrs or alone:
                    return False
                self.end_tag(tag)
                continue
            if attrs:
                class_text = next((_value(a) for a in _ATTR.finditer(attrs) if a[1].lower() == "class"), "")
            self.start_tag(tag, class_text or "", bool(alone))
            if tag in RAW_TAGS:
                raw = _RAW_END[tag].match(html, at)
                if alone or raw is None or not raw[2].isascii():
                    return False
                if raw[1]:
                    self.pieces.append(raw[1])
                at = raw.end()
                self.end_tag(tag)
        rest = html[at:]
        if "<" in rest:
            return False
        if rest:
            self.pieces.append(unescape(rest))
        return True

    def flush(self):
        if self.pieces:
            if not self.open[-1].silent:
                self.texts.append("".join(self.pieces).strip())
            self.pieces = []

    def _shut(self, depth):
        """Close all tags from this depth on."""
        for node in self.open[depth:]:
            node.end, node.text_end = len(self.nodes), len(self.texts)
            if node.at >= 0:
                self.depths[node.tag].pop()
        del self.open[depth:]

    def start_tag(self, tag, class_text, alone=False):
        if self.pieces:
            self.flush()
        node = _Node(tag, class_text, self.open[-1], len(self.nodes), len(self.texts))
        self.nodes.append(node)
        self.by_tag[tag].append(node)
        if alone or tag in VOID_TAGS:
            node.end, node.text_end = len(self.nodes), len(self.texts)
            return
        self.depths[tag].append(len(self.open))
        self.open.append(node)

    def end_tag(self, tag):
        if self.pieces:
            self.flush()
        node = self.open[-1]
        if node.tag == tag and node.at >= 0:  # nearly always
            node.end, node.text_end = len(self.nodes), len(self.texts)
            self.open.pop()
            self.depths[tag].pop()
        elif self.depths.get(tag):
            self._shut(self.depths[tag][-1])

    def text(self, node):
        return "".join(self.texts[node.text_at : node.text_end])


class _Tolerant(HTMLParser):
    """Any markup, told to a page tag by tag."""

    def __init__(self, page):
        super().__init__(convert_charrefs=True)
        self.page = page

    def updatepos(self, i, j):
        return j  # line numbers are not needed

    def handle_data(self, data):
        self.page.pieces.append(data)

    def handle_comment(self, data):
        self.page.flush()

    def handle_starttag(self, tag, attrs, alone=False):
        class_text = next((v for k, v in attrs if k == "class"), None) or ""
        self.page.start_tag(tag, class_text, alone)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs, True)

    def handle_endtag(self, tag):
        self.page.end_tag(tag)


class _Kind:
    """Some nodes of a page in document order, to be found by the node they are in."""

    def __init__(self, nodes):
        self.nodes = nodes
        self.places = [n.at for n in nodes]

    def span(self, node):
        return bisect_right(self.places, node.at), bisect_left(self.places, node.end)

    def inside(self, node):
        start, end = self.span(node)
        return self.nodes[start:end]

    def first(self, node):
        start, end = self.span(node)
        return self.nodes[start] if start < end else None


def _is_section(node):
    return (
        node.tag == "table"
        or not SECTION_CLASSES.isdisjoint(node.classes)
        or (node.tag == SECTION_TAG_CLASS[0] and SECTION_TAG_CLASS[1] in node.classes)
        or SECTION_CLASS_PART in node.class_text
    )


def _is_name(node):
    return node.in_name_box or not NAME_CLASSES.isdisjoint(node.classes)


class _Layout:
    """Where a page's sections, headings and cells have their texts; places of texts, and no text itself."""

    def __init__(self, page):
        row_nodes = page.by_tag.get("tr", [])
        tables = _Kind(page.by_tag.get("table", []))
        rows = _Kind(row_nodes)
        body_rows = _Kind([n for n in row_nodes if n.in_body])
        cells = _Kind(page.by_tag.get("td", []))
        headings = _Kind([n for n in page.nodes if n.tag in HEADINGS or INNER_HEADING_CLASS in n.classes])

        def place(node):
            return (node.text_at, node.text_end) if node else None

        def cell_rows(table):
            inside = rows.inside(table)
            marked = [r for r in inside if r.in_body or ROW_CLASS in r.classes]
            return [[place(c) for c in cells.inside(r)] for r in marked or inside[1:]]

        self.sections, first = [], {}
        for node in filter(_is_section, page.nodes):
            table = node if node.tag == "table" else tables.first(node)
            at = table.at if table else None
            read = table is None or at in first
            self.sections.append(
                (
                    at,
                    first.setdefault(at, len(self.sections)),
                    (place(headings.first(node)), place(node.sibling)),
                    [] if read else cell_rows(table),
                )
            )
        self.name = place(next((n for n in page.by_tag.get("h1", []) if _is_name(n)), None))
        self.tables = len(tables.nodes)
        self.body_rows = sum(end - start for start, end in map(body_rows.span, tables.nodes))
        # The same for all pages of this layout, as columns.
        self.nodes = [node for node, _, _, _ in self.sections]
        self.firsts = [first for _, first, _, _ in self.sections]
        self.headings = [found for _, _, found, _ in self.sections]
        self.n_rows = [len(rows) for _, _, _, rows in self.sections]
        self.n_cells = [len(row) for _, _, _, rows in self.sections for row in rows]
        self.cells = [cell for _, _, _, rows in self.sections for row in rows for cell in row]

    def categories(self, text):
        """The category of each section, in which ``text`` gives what stands at a place."""

        def heading(place):
            """A heading's text, unless it is empty or the label of a column."""
            found = text(place) if place else ""
            return None if found.upper() in LABEL_HEADINGS else found

        categories, category = [], None
        for inner, sibling in self.headings:
            category = heading(inner) or heading(sibling) or category
            categories.append(category)
        return categories

    def read(self, texts):
        """Sections, name and table counts of a page with these texts, as plain values."""
        out = _Columns()
        out.add(self, lambda place: "".join(texts[place[0] : place[1]]))
        return out.array()[0].as_py()


class _Columns:
    """What pages give, as flat columns: Arrow takes these in a fraction of the time nested values need."""

    def __init__(self):
        self.known, self.names, self.tables, self.body_rows = [], [], [], []
        self.n_sections, self.nodes, self.firsts, self.categories = [], [], [], []
        self.n_rows, self.n_cells, self.cells = [], [], []

    def add(self, layout, text):
        self.known.append(True)
        self.names.append(text(layout.name) if layout.name else None)
        self.tables.append(layout.tables)
        self.body_rows.append(layout.body_rows)
        self.n_sections.append(len(layout.nodes))
        self.nodes += layout.nodes
        self.firsts += layout.firsts
        self.categories += layout.categories(text)
        self.n_rows += layout.n_rows
        self.n_cells += layout.n_cells
        self.cells += map(text, layout.cells)

    def add_nothing(self):
        self.known.append(False)
        for column in (self.names, self.tables, self.body_rows):
            column.append(None)
        self.n_sections.append(0)

    def array(self):
        texts = pa.string()
        rows = _lists(self.n_cells, pa.array(self.cells, texts))
        sections = [
            pa.array(self.nodes, pa.int32()), pa.array(self.firsts, pa.int32()),
            pa.array(self.categories, texts), _lists(self.n_rows, rows),
        ]
        wanted = to_arrow_type(PAGE_TYPE)
        inner = wanted.field("sections").type.value_type
        columns = [
            pa.array(self.names, texts), pa.array(self.tables, pa.int64()), pa.array(self.body_rows, pa.int64()),
            _lists(self.n_sections, pa.StructArray.from_arrays(sections, fields=list(inner))),
        ]
        missing = pa.array([not k for k in self.known], pa.bool_())
        return pa.StructArray.from_arrays(columns, fields=list(wanted), mask=missing)


def _lists(lengths, values):
    """Lists of these lengths, of values that stand one after another."""
    return pa.ListArray.from_arrays(pa.array([0, *accumulate(lengths)], pa.int32()), values)


@lru_cache(maxsize=FRAMES)
def _frame(tags):
    """The layout that all plainly written pages with just these tags have, and which texts between the
    tags make up each of its texts; None where the tags alone do not tell. Tags come without their brackets."""
    tags = [f"<{t}>" for t in tags]
    if not all(_PIECE.fullmatch(t) for t in tags):
        return None
    page = _Page.__new__(_Page)
    numbered = "".join(f"{i};{t}" for i, t in enumerate(tags)) + f"{len(tags)};"
    if not page.read_plain(numbered):
        return None
    page.finish()
    slots = [[int(i) for i in t.split(";")[:-1]] for t in page.texts]
    alone = {(at, at + 1): slot[0] for at, slot in enumerate(slots) if len(slot) == 1}
    return _Layout(page), slots, alone, any(t in page.by_tag for t in RAW_TAGS - SILENT_TAGS)


def _plain_text(text):
    return unescape(text) if "&" in text else text


_seen = set()


def _seen_before(key):
    """Whether a page with these tags came lately; a layout is worth keeping from the second on."""
    if key in _seen:
        return True
    if len(_seen) >= SEEN:
        _seen.clear()
    _seen.add(key)
    return False


def _read_page(html):
    """A page's layout, and the function that gives the text at a place of it."""
    first, *rest = html.split("<")
    tags, ends, after = zip(*[p.partition(">") for p in rest]) if rest else ((), (), ())
    if len(tags) < FRAME_TAGS and "" not in ends:
        frame = _frame(tags) if _seen_before(hash(tags)) else None
        if frame is not None:
            layout, slots, alone, raw_text = frame
            if not (raw_text and "&" in html):
                parts = (first, *after)

                def between(place):
                    i = alone.get(place)
                    if i is not None:  # nearly always: one text between two tags
                        return _plain_text(parts[i]).strip()
                    return "".join(
                        ["".join([_plain_text(parts[i]) for i in slot]).strip() for slot in slots[place[0] : place[1]]]
                    )

                return layout, between
    page = _Page(html)
    texts = page.texts
    return _Layout(page), lambda place: "".join(texts[place[0] : place[1]])


def read_pages(pages):
    """Sections, name and table counts of HTML pages, an Arrow struct for each; NULL for none."""
    out = _Columns()
    for html in pages:
        if html is None:
            out.add_nothing()
        else:
            out.add(*_read_page(html))
    return out.array()


def read_page(html):
    """The same of one page, as plain values."""
    return read_pages([html])[0].as_py()


@F.arrow_udf(PAGE_TYPE)
def parse_tables(pages: pa.Array) -> pa.Array:
    """Table sections of HTML pages; NULL pages cost nothing."""
    return read_pages(pages.to_pylist())


def page_tables(html: Column | str, needed: Column | None = None) -> Column:
    """Parsed table sections; only pages that hold a table, and are needed, reach Python."""
    page = as_column(html)
    # Most tables are written in lower case; only pages without such a tag are turned to it.
    wanted = F.contains(page, F.lit("<table")) | F.contains(F.lower(page), F.lit("<table"))
    if needed is not None:
        wanted = needed & wanted
    return parse_tables(F.when(wanted, page))


def extract_tables(parsed: Column, repeats: bool = False) -> Column:
    """Extraction struct from parsed table sections.

    A section takes its category from its own headings, else from the section before it. A
    wrapper and its table both match; the table is read once, at its first match, unless
    ``repeats`` asks for every match.
    """
    sections = parsed["sections"]
    read = F.filter(sections, lambda s, i: s["node"].isNotNull() & (F.lit(repeats) | (s["first"] == i)))

    def stats_of(section: Column) -> Column:
        rows = F.get(sections, section["first"])["rows"] if repeats else section["rows"]
        category = F.coalesce(section["category"], F.lit(DEFAULT_CATEGORY))
        stats = F.transform(rows, lambda cells: stat_from_cells(cells, category))
        return F.filter(stats, lambda s: s.isNotNull())

    stats = F.flatten(F.transform(read, stats_of))
    return F.when(
        parsed.isNotNull(),
        extraction(F.lit(None), parsed["player_name"], F.lit(None), F.coalesce(stats, no_stats())),
    )
