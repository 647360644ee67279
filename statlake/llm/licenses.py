"""Licence scan: passages compared to licence templates by the Dice coefficient of their word bigrams.

The passages of a text are its lines, its paragraphs (between blank lines) and itself as a whole. A
passage is normalised (lower case, words of letters and digits, one spelling of "license"), and its set
of word bigrams is compared to those of the templates. A coefficient of ``threshold`` needs the smaller
set to be threshold / (2 - threshold) of the larger at least, so a passage is compared only to templates
within these bounds of its size. It also needs that part of the template's bigrams, so each template has
a few long words, covering more than the rest of its bigrams, of which one must be in the passage; texts
and passages with none of these words are not cut into bigrams at all. Both prune exactly. SQL functions
only; nothing moves.

Notices of several paragraphs lie inside longer texts, so runs of consecutive lines (blank ones left out;
paragraphs are such runs) are compared as well, if their words are within the size bounds of a template of
which the whole text has enough bigrams. A run begins and ends at lines that share bigrams with such a
template. Of runs that overlap, the best counts, and only where no passage that it overlaps scores as high.

Cases: a NULL or empty text has no passages and no licence. Passages of fewer than two words have no
bigrams. Equal passages of a text count once. Between equal scores the first template decides. Repeated
rows give repeated rows; an empty table gives an empty result. ``find_licenses`` keeps the other columns
and replaces a column of the name of its own.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statlake.functions.jsontext import bind
from statlake.llm.license_templates import TEMPLATES

THRESHOLD = 0.8
NOT_WORDS = "[^a-z0-9\n]+"


def bigrams_of(text: str) -> list[str]:
    """The bigrams of a template; ``bigrams`` says the same of a column."""
    lower = "".join(c if c.isascii() and c.isalnum() else " " for c in text.lower())
    words = lower.replace("licence", "license").split()
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:], strict=False)))


def needed_words(templates: list[tuple[str, str]], threshold: float) -> list[str]:
    """Words of which every passage that reaches the threshold with some template has at least one.

    Such a passage has threshold / (2 - threshold) of the template's bigrams, so words that are in
    more bigrams than may be missing cannot all be absent. The longest words are taken, and of equally
    long ones those of the fewest templates.
    """
    found: dict[str, None] = {}
    spread = Counter(w for _, text in templates for w in {w for b in bigrams_of(text) for w in b.split()})
    for _, text in templates:
        left = bigrams_of(text)
        missing = len(left) * (1 - threshold / (2 - threshold)) + 1e-9
        size = len(left)
        for word in sorted({w for b in left for w in b.split()}, key=lambda w: (-len(w), spread[w], w)):
            if size - len(left) > missing:
                break
            left = [b for b in left if word not in b.split()]
            found[word] = None
    return list(found)


def plain_text(text: Column) -> Column:
    """A text in lower case, with one space or more for what is neither letter, digit nor line end."""
    lower = F.replace(F.lower(F.coalesce(text, F.lit(""))), F.lit("licence"), F.lit("license"))
    return F.regexp_replace(lower, NOT_WORDS, " ")


def passages(plain: Column) -> Column:
    """The distinct passages of a plain text, words one space apart."""
    lines = F.split(plain, "\n")
    paragraphs = F.transform(F.split(plain, "\n[ \n]*\n"), lambda p: F.replace(p, F.lit("\n"), F.lit(" ")))
    whole = F.array(F.replace(plain, F.lit("\n"), F.lit(" ")))
    found = F.concat(lines, paragraphs, whole)
    return F.array_distinct(F.transform(found, lambda p: F.trim(F.regexp_replace(p, " +", " "))))


def word_count(passage: Column) -> Column:
    spaces = F.length(passage) - F.length(F.replace(passage, F.lit(" "), F.lit("")))
    return F.when(F.length(passage) == 0, 0).otherwise(spaces + 1)


def bigrams(passage: Column) -> Column:
    """The distinct bigrams of a passage of two words or more."""
    return bind(
        F.split(passage, " "),
        lambda words: F.array_distinct(
            F.transform(
                F.sequence(F.lit(0), F.size(words) - 2),
                lambda i: F.concat(F.get(words, i), F.lit(" "), F.get(words, i + 1)),
            )
        ),
    )


def template_column(templates: list[tuple[str, str]]) -> Column:
    rows = [
        F.struct(
            F.lit(place).alias("place"),
            F.lit(name).alias("name"),
            F.array(*map(F.lit, found)).alias("bigrams"),
            F.lit(len(found)).alias("size"),
        )
        for place, (name, found) in enumerate((n, bigrams_of(t)) for n, t in templates)
    ]
    return F.array(*rows)


def best_matches(found: Column, templates: list[tuple[str, str]], threshold: float) -> Column:
    """Of passages the (score, place, name) of the best template, for those that reach the threshold."""
    sizes = [len(bigrams_of(t)) for _, t in templates]
    least = threshold / (2 - threshold)
    smallest, largest = min(sizes) * least, max(sizes) / least
    known = template_column(templates)
    needed = F.array(*map(F.lit, needed_words(templates, threshold)))

    def scores(own: Column) -> Column:
        size = F.size(own)
        near = F.filter(
            known, lambda t: (t["size"] >= size * least - 1e-9) & (size >= t["size"] * least - 1e-9)
        )
        rated = F.transform(
            near,
            lambda t: F.struct(
                (F.size(F.array_intersect(own, t["bigrams"])) * 2 / (size + t["size"])).alias("score"),
                (-t["place"]).alias("place"),
                t["name"].alias("name"),
            ),
        )
        return F.array_max(F.filter(rated, lambda r: r["score"] >= threshold))

    # A passage may repeat its bigrams, so its words only bound their number from above.
    long = F.filter(found, lambda p: (word_count(p) >= 2) & (word_count(p) - 1 >= smallest))
    long = F.filter(long, lambda p: F.arrays_overlap(F.split(p, " "), needed))
    sets = F.filter(F.transform(long, bigrams), lambda own: F.size(own) <= largest)
    return F.filter(F.transform(sets, scores), lambda r: r.isNotNull())


def held_templates(plain: Column, templates: list[tuple[str, str]], threshold: float) -> Column:
    """The templates of which a plain text has so many bigrams that a run of its lines can reach the threshold."""
    least = threshold / (2 - threshold)
    whole = F.trim(F.regexp_replace(plain, "[ \n]+", " "))
    held = bind(
        bigrams(whole),
        lambda own: F.filter(
            template_column(templates),
            lambda t: F.size(F.array_intersect(own, t["bigrams"])) >= t["size"] * least - 1e-9,
        ),
    )
    return F.when(word_count(whole) >= 2, held)


def run_matches(plain: Column, found: Column, held: Column, threshold: float) -> Column:
    """(score, place, name) of runs of lines by the templates ``held``, besides the passages ``found``."""
    least = threshold / (2 - threshold)

    def rated(text: Column, start: Column, end: Column) -> Column:
        best = bind(
            bigrams(text),
            lambda own: F.array_max(
                F.transform(
                    held,
                    lambda t: F.struct(
                        (F.size(F.array_intersect(own, t["bigrams"])) * 2 / (F.size(own) + t["size"])).alias("score"),
                        (-t["place"]).alias("place"),
                        t["name"].alias("name"),
                    ),
                )
            ),
        )
        base = F.array_contains(found, text)
        # In this order the best comes first: passages before runs, then shorter and earlier ones.
        return bind(
            best,
            lambda m: F.struct(
                m["score"].alias("score"),
                base.alias("base"),
                (start - end).alias("length"),
                (-start).alias("at"),
                m["place"].alias("place"),
                m["name"].alias("name"),
                end.alias("end"),
                text.alias("text"),
            ),
        )

    lines = F.filter(
        F.transform(F.split(plain, "\n"), lambda p: F.trim(F.regexp_replace(p, " +", " "))), lambda p: F.length(p) > 0
    )
    some = F.array_distinct(F.flatten(F.transform(held, lambda t: t["bigrams"])))
    fewest, most = F.array_min(F.transform(held, lambda t: t["size"])), F.array_max(F.transform(held, lambda t: t["size"]))

    def hits(all_lines: Column, i: Column, known: Column) -> Column:
        """Bigrams of templates that begin in line i."""
        text = F.concat_ws(" ", F.get(all_lines, i), F.get(F.split(F.get(all_lines, i + 1), " "), F.lit(0)))
        own = bind(
            F.split(text, " "),
            lambda w: F.transform(
                F.sequence(F.lit(0), F.size(w) - 2), lambda k: F.concat(F.get(w, k), F.lit(" "), F.get(w, k + 1))
            ),
        )
        return F.when(word_count(text) < 2, 0).otherwise(F.size(F.filter(own, lambda g: F.array_contains(known, g))))

    def runs(all_lines: Column, hit: Column) -> Column:
        low, high = F.ceil(fewest * least - 1e-9), F.floor(most / least + 1e-9) + 1
        last = F.size(all_lines) - 1

        def of(i: Column) -> Column:
            ends = F.aggregate(
                F.sequence(i, F.least(last, (i + high).cast("int"))),
                F.struct(F.lit(0).alias("words"), F.lit(0).alias("hits"), F.array().cast("array<int>").alias("ends")),
                lambda held_so_far, j: bind(
                    F.struct(
                        (held_so_far["words"] + word_count(F.get(all_lines, j))).alias("words"),
                        (held_so_far["hits"] + F.get(hit, j)).alias("hits"),
                    ),
                    lambda sums: F.struct(
                        sums["words"].alias("words"),
                        sums["hits"].alias("hits"),
                        F.when(
                            (sums["words"] <= high)
                            & (sums["hits"] >= low)
                            & ((F.get(hit, j) > 0) | (F.coalesce(F.get(hit, F.greatest(j - 1, F.lit(0))), F.lit(0)) > 0)),
                            F.concat(held_so_far["ends"], F.array(j)),
                        )
                        .otherwise(held_so_far["ends"])
                        .alias("ends"),
                    ),
                ),
            )["ends"]
            return F.transform(
                F.filter(ends, lambda j: (j > i) | (word_count(F.get(all_lines, i)) >= 2)),
                lambda j: bind(F.array_join(F.slice(all_lines, i + 1, j - i + 1), " "), lambda t: rated(t, i, j)),
            )

        starts = F.filter(F.sequence(F.lit(0), last), lambda i: F.get(hit, i) > 0)
        return F.filter(F.flatten(F.transform(starts, of)), lambda r: r["score"] >= threshold)

    numbered = bind(
        lines,
        lambda ls: bind(
            some,
            lambda known: bind(
                F.transform(F.sequence(F.lit(0), F.size(ls) - 1), lambda i: hits(ls, i, known)), lambda hit: runs(ls, hit)
            ),
        ),
    )
    # Passages may have more words than runs, so those are also held against the text of runs.
    wide = F.filter(
        F.transform(F.filter(found, lambda p: word_count(p) >= 2), lambda p: rated(p, F.lit(0), F.lit(0))),
        lambda r: r["score"] >= threshold,
    )

    def chosen(rated_runs: Column, passages_matched: Column) -> Column:
        kept = F.aggregate(
            F.reverse(F.array_sort(rated_runs)),
            F.slice(rated_runs, 1, 0),
            lambda taken, r: F.when(
                F.exists(taken, lambda t: (-t["at"] <= r["end"]) & (-r["at"] <= t["end"])) & ~r["base"], taken
            ).otherwise(F.concat(taken, F.array(r))),
        )
        free = lambda r: ~F.exists(
            passages_matched, lambda p: (p["score"] >= r["score"]) & F.contains(p["text"], r["text"])
        )
        kept = F.filter(kept, lambda r: ~r["base"] & free(r))
        by_text = F.filter(
            kept, lambda r: ~F.exists(kept, lambda q: (q["text"] == r["text"]) & (q["at"] > r["at"]))
        )
        return F.transform(by_text, lambda r: F.struct(r["score"], r["place"], r["name"]))

    return bind(numbered, lambda r: bind(wide, lambda w: chosen(r, w)))


def find_licenses(
    docs: DataFrame,
    text: str = "text",
    templates: list[tuple[str, str]] = TEMPLATES,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """``docs`` with ``matches``: array of (score, place, name), place as minus the template's number."""
    plain = docs.withColumn("_plain", plain_text(F.col(text)))
    words = F.split(F.replace("_plain", F.lit("\n"), F.lit(" ")), " ")
    some = F.arrays_overlap(words, F.array(*map(F.lit, needed_words(templates, threshold))))
    found = plain.withColumn("_passages", F.when(some, passages(F.col("_plain"))).otherwise(F.array()))
    several = F.col("_plain").rlike("[^ \n][ ]*\n[ \n]*[^ \n]")
    held = held_templates(F.col("_plain"), templates, threshold)
    found = found.withColumn("_held", F.when((F.size("_passages") > 0) & several, held))
    made = found.withColumn("matches", best_matches(F.col("_passages"), templates, threshold))
    more = run_matches(F.col("_plain"), F.col("_passages"), F.col("_held"), threshold)
    more = F.when(F.size("_held") > 0, more)
    made = made.withColumn(
        "matches", F.when(F.size("_held") > 0, F.concat("matches", more)).otherwise(F.col("matches"))
    )
    return made.drop("_plain", "_passages", "_held")


def oracle_sql(templates: list[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> str:
    """The query op10 in SQL: every passage against every template, without bounds."""
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    rows = ", ".join(
        f"({i}, {quoted(name)}, [{', '.join(map(quoted, bigrams_of(t)))}])"
        for i, (name, t) in enumerate(templates)
    )
    return f"""
    WITH templates(place, name, grams) AS (VALUES {rows}),
    plain AS (
        SELECT doc_id, regexp_replace(replace(lower(coalesce(text, '')), 'licence', 'license'),
                                      '[^a-z0-9\n]+', ' ', 'g') AS t
        FROM documents
    ),
    passages AS (
        SELECT doc_id, unnest(list_distinct(list_transform(
            string_split(t, chr(10)) || string_split_regex(t, '\\n[ \\n]*\\n') || [t],
            lambda p: trim(regexp_replace(replace(p, chr(10), ' '), ' +', ' ', 'g'))))) AS p
        FROM plain
    ),
    sets AS (
        SELECT doc_id, p, list_distinct(list_transform(range(1, len(words)),
                                                       lambda i: words[i] || ' ' || words[i + 1])) AS grams
        FROM (SELECT doc_id, p, string_split(p, ' ') AS words FROM passages) WHERE len(words) >= 2
    ),
    best AS (
        SELECT doc_id, p, max(score) AS score, arg_max(name, (score, -place)) AS name
        FROM (
            SELECT doc_id, p, place, name,
                   len(list_intersect(s.grams, templates.grams)) * 2.0::DOUBLE
                   / (len(s.grams) + len(templates.grams)) AS score
            FROM sets s, templates
        ) WHERE score >= {threshold} GROUP BY doc_id, p
    )
    SELECT d.doc_id, count(b.p) AS n_matches, coalesce(round(max(b.score), 6), 0.0) AS best_score,
           coalesce(array_to_string(list_sort(list_distinct(list(b.name) FILTER (b.name IS NOT NULL))), ','), '')
               AS licenses
    FROM documents d LEFT JOIN best b ON b.doc_id = d.doc_id GROUP BY d.doc_id
    """
