"""Objects of a JSON text at any depth, judged by their names, without a parse tree.

A text is first reduced to its braces and the names asked for, each name a letter: ``{v{g}}``. Objects
without inner ones are judged and taken out by patterns, which leaves nothing of most texts; what is
left is walked with the open objects on a stack. The stack is a number with three bits for each open
object; full numbers go to an array, of which a step carries the last few.

Both quotes are read, as Spark's JSON functions do. Escaped letters in names count as the letters.
Objects under a repeated name all count. A text that is no JSON has no objects; one that nests deeper
than Spark's parser goes is taken as JSON if its brackets close.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from statlake.functions.jsontext import bind, is_json

PARSER_DEPTH = 1000  # levels that Spark's JSON parser reads
LEAF_ROUNDS = 3
LEVELS, LEVEL_BITS = 20, 3  # open objects in one number
CHUNK = 500  # letters, which close no more objects than NEAR numbers hold
NEAR = CHUNK // LEVELS + 1

_STRING = r""""[^"\\]*+(?:\\.[^"\\]*+)*+"|'[^'\\]*+(?:\\.[^'\\]*+)*+'"""


def _letter(letter: str, any_case: bool) -> str:
    forms = {letter.lower(), letter.upper()} if any_case else {letter}
    return "(?:" + "|".join([*sorted(forms), *(f"\\\\u00(?i:{ord(x):02x})" for x in sorted(forms))]) + ")"


def _names(names: Sequence[str], any_case: bool, escaped: bool) -> str:
    """A pattern of quoted names, whose letters may be escaped."""
    if not escaped:
        return f"[\"'](?{'i' if any_case else ''}:{'|'.join(names)})[\"']"
    words = "|".join("".join(_letter(x, any_case) for x in name) for name in names)
    return f"[\"'](?:{words})[\"']"


def coded_objects(text: Column, codes: Mapping[str, Sequence[str]], any_case: bool) -> Column:
    """Braces and the letters of the names that ``codes`` lists, of text that is JSON."""

    def coded(escaped: bool) -> Column:
        wanted = "|".join(_names(names, any_case, escaped) for names in codes.values())
        kept = F.regexp_replace(
            text, f"(?s)[^\"'{{}}]*+(?:([{{}}]++)|({wanted})\\s*+:|{_STRING}|\\z)", "$1$2"
        )
        for code, names in codes.items():
            kept = F.regexp_replace(kept, _names(names, any_case, escaped), code)
        return kept

    return F.when(F.contains(text, F.lit("\\u00")), coded(True)).otherwise(coded(False))


def is_deep_json(text: Column) -> Column:
    """Brackets all close and nest as deep as Spark's parser cannot read."""
    brackets = F.regexp_replace(text, f"(?s)[^\"'\\[\\]{{}}]*+(?:([\\[\\]{{}}]++)|{_STRING}|\\z)", "$1")

    def step(acc: Column, bracket: Column) -> Column:
        depth = acc["depth"] + F.when(bracket.isin("{", "["), 1).otherwise(-1)
        return bind(
            depth,
            lambda d: F.struct(
                d.alias("depth"), F.least(acc["low"], d).alias("low"), F.greatest(acc["high"], d).alias("high")
            ),
        )

    start = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("low"), F.lit(0).alias("high"))
    closed = F.aggregate(
        F.split(brackets, "(?!$)"), start, step,
        lambda acc: (acc["depth"] == 0) & (acc["low"] == 0) & (acc["high"] >= PARSER_DEPTH),
    )
    return (F.length(text) > 2 * PARSER_DEPTH) & text.rlike(r"\A\s*[\[{]") & closed


def _walk(coded: Column, letters: str, two: bool) -> Column:
    """Objects with any letter of their own, or with two different ones."""
    no_numbers = F.array().cast("array<bigint>")
    start = F.struct(
        F.lit(0).cast("bigint").alias("hits"), F.lit(0).cast("bigint").alias("own"),
        F.lit(0).cast("bigint").alias("open"), F.lit(0).alias("n"), no_numbers.alias("full"),
    )

    def state(hits: Column, own: Column, held: Column, n: Column, full: Column) -> Column:
        return F.struct(
            hits.alias("hits"), own.alias("own"), held.alias("open"), n.alias("n"), full.alias("full")
        )

    def opened(acc: Column) -> Column:
        more = F.shiftleft(acc["open"], LEVEL_BITS).bitwiseOR(acc["own"])
        zero = F.lit(0).cast("bigint")
        return F.when(
            acc["n"] == LEVELS,
            state(acc["hits"], zero, acc["own"], F.lit(1), F.concat(acc["full"], F.array(acc["open"]))),
        ).otherwise(state(acc["hits"], zero, more, acc["n"] + 1, acc["full"]))

    def closed(acc: Column) -> Column:
        own = acc["open"].bitwiseAND(F.lit(2**LEVEL_BITS - 1).cast("bigint"))
        left = F.size(acc["full"])
        return F.when(
            (acc["n"] == 1) & (left > 0),
            state(acc["hits"], own, F.get(acc["full"], left - 1), F.lit(LEVELS), F.slice(acc["full"], 1, left - 1)),
        ).otherwise(state(acc["hits"], own, F.shiftright(acc["open"], LEVEL_BITS), acc["n"] - 1, acc["full"]))

    def named(acc: Column, letter: Column) -> Column:
        code = F.instr(F.lit(letters), letter).cast("bigint")
        hit = (acc["own"] != 0) & (acc["own"] != code) if two else acc["own"] == 0
        return state(
            acc["hits"] + hit.cast("bigint"), F.when(acc["own"] == 0, code).otherwise(acc["own"]),
            acc["open"], acc["n"], acc["full"],
        )

    def step(acc: Column, letter: Column) -> Column:
        return F.when(letter == "{", opened(acc)).when(letter == "}", closed(acc)).otherwise(named(acc, letter))

    def chunk(acc: Column, part: Column) -> Column:
        # Spark copies what a fold carries at each step, so a step carries what a chunk can close.
        far = F.greatest(F.size(acc["full"]) - NEAR, F.lit(0))
        near = state(acc["hits"], acc["own"], acc["open"], acc["n"], F.slice(acc["full"], far + 1, F.lit(NEAR)))
        whole = F.aggregate(F.split(part, "(?!$)"), near, step)
        return bind(
            whole,
            lambda w: state(w["hits"], w["own"], w["open"], w["n"], F.concat(F.slice(acc["full"], F.lit(1), far), w["full"])),
        )

    chunks = F.regexp_extract_all(coded, F.lit(f".{{1,{CHUNK}}}"), F.lit(0))
    return F.aggregate(chunks, start, chunk, lambda acc: acc["hits"])


def _of_json(text: Column, codes: Mapping[str, Sequence[str]], any_case: bool, judge: Callable[[Column], Column]) -> Column:
    """What ``judge`` says of the letters of a text that is JSON, else NULL."""

    def judged(t: Column) -> Column:
        return bind(
            F.when(is_json(t), t).when(is_deep_json(t), t),
            lambda whole: bind(coded_objects(whole, codes, any_case), judge),
        )

    return bind(text, judged)


def count_named(text: Column, names: Sequence[str]) -> Column:
    """Objects that have any of the names, in any case; 0 if there are none."""

    def counted(coded: Column, rounds: int) -> Column:
        if rounds == 0:
            return F.when(coded == "", F.lit(0).cast("bigint")).otherwise(_walk(coded, "k", False))

        def without_leaves(c: Column) -> Column:
            outer = F.replace(c, F.lit("{k}"), F.lit(""))
            hits = (F.length(c) - F.length(outer)) / 3
            rest = F.replace(outer, F.lit("{}"), F.lit(""))
            return hits.cast("bigint") + bind(rest, lambda r: counted(r, rounds - 1))

        return bind(F.regexp_replace(coded, "kk++", "k"), without_leaves)

    found = _of_json(text, {"k": names}, True, lambda c: counted(c, LEAF_ROUNDS))
    return F.coalesce(found, F.lit(0).cast("bigint"))


def has_named(text: Column, any_of: Sequence[str], two_of: Sequence[str]) -> Column:
    """An object has a name of ``any_of``, or two names of ``two_of`` (seven at most)."""
    letters = "abcdefg"[: len(two_of)]
    pair = f"([{letters}])\\1*+[{letters}]"

    def found(coded: Column, rounds: int) -> Column:
        rest = F.regexp_replace(coded, f"\\{{[{letters}]*+\\}}", "")
        below = coded.rlike(pair)
        if rounds == 0:
            return (coded != "") & (_walk(coded, letters, True) > 0)
        return below | bind(rest, lambda r: found(r, rounds - 1))

    codes = {"z": any_of, **{letter: [name] for letter, name in zip(letters, two_of, strict=True)}}
    marked = _of_json(text, codes, False, lambda c: F.contains(c, F.lit("z")) | found(c, LEAF_ROUNDS))
    return F.coalesce(marked, F.lit(False))
