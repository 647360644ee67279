import random
import re
import time
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from statlake.llm.lines import ALL_SHUT, BLOCK, BLOCK_JAVA, BLOCK_TAGS, TAG, UNSHOWN, UNSHOWN_JAVA, drop_boilerplate, lines_of


def page(*lines):
    body = "".join(f"<p>{line}</p>" for line in lines)
    return f"<html><script>var x='<p>no</p>'</script><!-- <p>no --><body>{body}</body></html>"


def brute(rows, ratio, least):
    hosts, have = Counter(), defaultdict(Counter)
    for _, url, lines in rows:
        host = (re.match(r"\w+://([^/?#:]*)", url or "") or [0, ""])[1].lower()
        hosts[host] += 1
        have[host].update(set(lines))
    out = []
    for i, url, lines in rows:
        host = (re.match(r"\w+://([^/?#:]*)", url or "") or [0, ""])[1].lower()
        gone = {x for x, n in have[host].items() if n >= least and n > ratio * hosts[host]}
        kept = [x for x in lines if x not in gone]
        out.append((i, host, len(lines), kept))
    return out


def test_against_brute_force(spark):
    rows = []
    for i in range(400):
        host = "hot.example" if i % 3 == 0 else f"h{i % 7}.example"
        lines = ["Menu", f"own {i}", "Menu"] + (["Half"] if i % 2 else []) + [f"few {i % 40}"]
        rows.append((i, f"https://{host.upper()}:80/{i}?q", lines))
    rows += [(900, None, ["Menu"]), (901, "no url", []), (902, "http://one.example/", ["Menu", "a"])]
    frame = spark.createDataFrame(
        [(i, u, page(*x), "x") for i, u, x in rows] + [(903, "http://one.example/", None, "x")],
        "page_id long, url string, html string, common string",
    )
    rows.append((903, "http://one.example/", []))
    want = {i: (host, n, kept) for i, host, n, kept in brute(rows, 0.2, 3)}
    for size in (1 << 20, 0):
        got = drop_boilerplate(frame, ratio=0.2, sent_bytes=size)
        assert got.columns == ["page_id", "url", "host", "lines", "n_lines", "n_dropped"]
        assert {r.page_id: (r.host, r.n_lines, r.lines) for r in got.collect()} == want
    assert drop_boilerplate(frame.limit(0)).count() == 0


def test_entities_spaces_long_and_repeated_pages(spark):
    rows = [(1, "http://a.b/", "<div>a &amp;lt; b &nbsp; c<br/>\n  d <b>e</b></div>" + "<p>x</p>" * 100_000)]
    frame = spark.createDataFrame(rows * 4, "page_id long, url string, html string")
    got = drop_boilerplate(frame, min_pages=5).first()
    assert got.lines[:3] == ["a &lt; b c", "d e", "x"] and got.n_lines == 100_002
    assert drop_boilerplate(frame).agg(F.sum("n_dropped")).first()[0] == 4 * 100_002


def test_openings_that_nothing_closes(spark):
    """The patterns as they stand, on pages put together from their parts; and 1 MB of each opening."""
    rng = random.Random(3)
    parts = ["<", ">", "<!--", "-->", "<!-->", "<script>", "<SCRIPT ", "</script", "</Script >", "<style\n", "</style>",
             "<p", "<p ", "</div>", "a", " b ", "\n", "\U0001f600", "\ufdd0\u0001\ufdd1"]
    pages = ["".join(rng.choices(parts, k=rng.randrange(40))) for _ in range(3000)]

    def brute_lines(html):
        text = re.sub(TAG, "", re.sub(BLOCK, "\n", re.sub(UNSHOWN, " ", html)))
        lines = (re.sub("[ \t\r\f ]+", " ", line).strip(" ") for line in text.split("\n"))
        return [line for line in lines if line]

    frame = spark.createDataFrame([(i, p) for i, p in enumerate(pages)], "i int, html string")
    got = frame.select("i", lines_of(F.col("html")).alias("lines")).collect()
    assert all(r.lines == brute_lines(pages[r.i]) for r in got)
    openings = ["<", "<!--", "<script>", "<style >", "<p ", "</div ", "<!-->", "</script", "<script>" * 9 + "</script"]
    many = [x * ((1 << 20) // len(x)) for x in openings]
    long = spark.createDataFrame([(x + end,) for x in many for end in ("", "-->", "</script", ">")], "html string")
    started = time.perf_counter()
    assert long.repartition(8).select(F.sum(F.size(lines_of(F.col("html"))))).first()[0] > 0
    assert time.perf_counter() - started < 2 * long.count()


def test_patterns_of_java_match_what_those_of_sql_match(spark):
    """Every block tag, and names that only begin like one; spaces of all kinds at line ends."""
    names = [*BLOCK_TAGS.replace("h[1-6]", "h1|h3|h6").split("|"), "h7", "h", "pr", "prex", "heade", "se", "figur", "b", "o", "x"]
    pages = [f"a<{shut}{name.upper() if i % 2 else name}{tail}>b" for i, name in enumerate(names) for shut in ("", "/", "//")
             for tail in ("", " x='1'", "/", "\n", "-x", "x")]
    pages += [f"<{name} a>x < y </{name}y <!-- - -- - -->z" * 2 for name in ("script", "STYLE", "scripts", "style\t")]
    pages += ["a \t\r\n \u00a0 b\u00a0\n\n \n c\fd  e ", " \n ", "", "\u00a0", "\t\n\t"]
    frame = spark.createDataFrame([(i, p) for i, p in enumerate(pages)], "i int, html string")
    html = F.col("html")
    pairs = [(BLOCK, BLOCK_JAVA), (UNSHOWN, UNSHOWN_JAVA)]
    same = [F.regexp_replace(html, sql, "|") == F.regexp_replace(html, java, "|") for sql, java in pairs]
    assert frame.where(~(same[0] & same[1])).count() == 0
    for row in frame.select("i", lines_of(html).alias("lines")).collect():
        text = re.sub(TAG, "", re.sub(BLOCK, "\n", re.sub(UNSHOWN, " ", pages[row.i])))
        lines = (re.sub("[ \t\r\f\u00a0]+", " ", line).strip(" ") for line in text.split("\n"))
        assert row.lines == [line for line in lines if line]


def test_pages_with_all_closed_are_known_in_one_reading(spark):
    """A page of long scripts and comments, all closed, goes by the plain patterns."""
    closed = "<script >" + "<" * 300_000 + "</script><!-- " + "- " * 100_000 + "--><p>x < y</p>"
    frame = spark.createDataFrame([(closed, True), (closed + "<!-- ", False), (closed + "</script", True)], "html string, shut boolean")
    assert frame.where(F.col("html").rlike(ALL_SHUT) != F.col("shut")).count() == 0


def test_pages_are_read_into_lines_once(spark):
    rows = [(i, "http://a.b/", f"<p>Menu</p><p>own {i}</p>") for i in range(9)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(html):
        read.add(1)
        return html

    got = drop_boilerplate(frame.withColumn("html", counted("html"))).collect()
    assert sorted(r.lines for r in got) == [[f"own {i}"] for i in range(9)]
    assert read.value == len(rows)
