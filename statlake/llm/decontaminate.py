"""Benchmark decontamination with a generalised suffix automaton of the items' words.

The automaton holds every run of words of every item. A text's words are fed to it, and at each word it
tells the longest run of item words that ends there. Where that is ``window`` words or more, or a whole
item of fewer, the words of the match are hit. Runs of words that no item has side by side cannot match,
so only stretches of neighbours known from the items are fed; all others are passed over in bulk.

The items are a query set and are held by each worker as blocks of at most ``BLOCK_WORDS`` words, one
automaton each; all blocks are run over every text. Texts do not move.

Cases: NULL and empty texts or items have no words; an item without words never occurs. Items with the
same id count as one. Repeated rows give repeated rows; an empty table of texts or items gives an empty
result, or one without hits. ``find_contamination`` puts its columns behind those given and replaces a
column of their names.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statlake.llm.blocks import Cache

WINDOW = 13
BLOCK_WORDS = 500_000

# Words after A-Z are lower-cased: runs of digits, letters and all bytes beyond ASCII.
_WORD_BYTES = frozenset([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)])
LOWER = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b in _WORD_BYTES else 0x20 for b in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(LOWER).split()


class ItemAutomaton:
    """A suffix automaton over the word lists of items."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.ids: dict[bytes, int] = {}
        self.names = [name for name, _ in items]
        lists = [[self.ids.setdefault(w, len(self.ids)) for w in words] for _, words in items]
        self.pairs = {a << 32 | b for words in lists for a, b in zip(words, words[1:])}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        for words in lists:
            last = 0
            for word in words:
                last = self.extended(last, word)
        # The shortest run that counts, in each state the items that have it as a window.
        self.found: dict[int, set[int]] = {}
        self.whole: dict[int, list[tuple[int, int]]] = {}
        self.shortest = window
        for i, words in enumerate(lists):
            if len(words) >= window:
                state, size = 0, 0
                for word in words:
                    state, size = self.next[state][word], size + 1
                    state, size = self.cut(state, size, window)
                    if size == window:
                        self.found.setdefault(state, set()).add(i)
            elif words:
                state = 0
                for word in words:
                    state = self.next[state][word]
                self.whole.setdefault(state, []).append((len(words), i))
                self.shortest = min(self.shortest, len(words))
        # For each state, the short items that are a suffix of what it stands for.
        self.ends: list[tuple[tuple[int, int], ...]] = [()] * len(self.next)
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            own = tuple(self.whole.get(state, ()))
            self.ends[state] = own + self.ends[self.link[state]]

    def extended(self, last: int, word: int) -> int:
        """The state of the run that ``last`` stands for with one word more."""
        moves, link, length = self.next, self.link, self.length
        if word in moves[last]:
            known = moves[last][word]
            return known if length[known] == length[last] + 1 else self.split(last, word, known)
        moves.append({})
        link.append(0)
        length.append(length[last] + 1)
        made, at = len(moves) - 1, last
        while at >= 0 and word not in moves[at]:
            moves[at][word] = made
            at = link[at]
        if at >= 0:
            known = moves[at][word]
            link[made] = known if length[known] == length[at] + 1 else self.split(at, word, known)
        return made

    def split(self, at: int, word: int, known: int) -> int:
        """A state for the shorter runs of ``known``, reached from ``at`` and its suffixes."""
        moves, link, length = self.next, self.link, self.length
        moves.append(dict(moves[known]))
        link.append(link[known])
        length.append(length[at] + 1)
        copy = link[known] = len(moves) - 1
        while at >= 0 and moves[at].get(word) == known:
            moves[at][word] = copy
            at = link[at]
        return copy

    def cut(self, state: int, size: int, most: int) -> tuple[int, int]:
        """The state of the last ``most`` words of a match of ``size`` words."""
        if size > most:
            size = most
            while self.length[self.link[state]] >= size:
                state = self.link[state]
        return state, size

    def matches(self, words: list[int], offset: int, spans: list, items: set[int]) -> None:
        """Add what occurs in a stretch of known words: spans of hit words, and the items."""
        moves, link, length, window = self.next, self.link, self.length, self.window
        state = size = 0
        for at, word in enumerate(words, offset + 1):
            while state and word not in moves[state]:
                state = link[state]
                size = length[state]
            state = moves[state].get(word, 0)
            size = size + 1 if state else 0
            state, size = self.cut(state, size, window)
            if size == window:
                spans.append((at - window, at))
                items |= self.found[state]
            for least, item in self.ends[state]:
                if least <= size:
                    spans.append((at - least, at))
                    items.add(item)

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """The spans of hit words of a text, and the items that occur in it."""
        spans: list[tuple[int, int]] = []
        items: set[int] = set()
        known = np.fromiter(map(self.ids.get, words, repeat(-1)), np.int64, len(words))
        inside = known >= 0
        if not inside.any():
            return spans, items
        # Word i goes with word i + 1 if some item has them side by side.
        both = np.flatnonzero(inside[:-1] & inside[1:])
        joined = np.zeros(len(words), dtype=bool)
        keys = (known[both] << 32 | known[both + 1]).tolist()
        joined[both] = np.fromiter(map(self.pairs.__contains__, keys), bool, len(keys))
        starts = np.flatnonzero(inside & ~np.r_[False, joined[:-1]])
        ends = np.flatnonzero(inside & ~joined) + 1
        long = ends - starts >= self.shortest
        for a, b in zip(starts[long].tolist(), ends[long].tolist(), strict=True):
            self.matches(known[a:b].tolist(), a, spans, items)
        return spans, items


def item_blocks(items: DataFrame, item_id: str, text: str, size: int) -> list[list[tuple[str, list[bytes]]]]:
    """The items' ids and words, in blocks of about ``size`` words, read one partition at a time."""
    words: dict[str, list[list[bytes]]] = {}
    blocks, held = [], 0
    rows = items.select(F.col(item_id).cast("string").alias("id"), F.col(text).alias("text"))
    for row in rows.where("id IS NOT NULL").toLocalIterator():
        found = words_of((row.text or "").encode())
        if not found:
            continue
        words.setdefault(row.id, []).append(found)
        held += len(found)
        if held >= size:
            blocks.append([(i, w) for i, lists in words.items() for w in lists])
            words, held = {}, 0
    if words or not blocks:
        blocks.append([(i, w) for i, lists in words.items() for w in lists])
    return blocks


AUTOMATA = Cache(8)  # of this worker, by the name of the block


def find_contamination(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``docs`` with n_words, n_hit, items (ids that occur, sorted) and hits (spans of words)."""
    context = docs.sparkSession.sparkContext
    blocks = [
        context.broadcast((uuid.uuid4().hex, block))
        for block in item_blocks(items, item_id, item_text, block_words)
    ]
    names = ("n_words", "n_hit", "items", "hits")
    kind = "struct<n_words:long,n_hit:long,items:array<string>,hits:array<struct<start:int,end:int>>>"

    @F.pandas_udf(kind)
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        automata = []
        for block in blocks:
            name, rows = block.value
            if name not in AUTOMATA:
                AUTOMATA.room(1)
                AUTOMATA[name] = ItemAutomaton(rows, window)
            automata.append(AUTOMATA[name])
        for batch in batches:
            rows = []
            for value in batch.tolist():
                words = words_of((value or "").encode())
                spans, occurring = [], set()
                for automaton in automata:
                    own, found_items = automaton.scan(words)
                    spans += own
                    occurring |= {automaton.names[i] for i in found_items}
                merged = []
                for start, end in sorted(spans):
                    if merged and start <= merged[-1]["end"]:
                        merged[-1]["end"] = max(end, merged[-1]["end"])
                    else:
                        merged.append({"start": start, "end": end})
                hit = sum(s["end"] - s["start"] for s in merged)
                rows.append((len(words), hit, sorted(occurring), merged))
            yield pd.DataFrame(rows, columns=list(names))

    made = docs.drop(*names).withColumn("_found", found(F.col(text)))
    return made.select(*(c for c in made.columns if c != "_found"), "_found.*")


def is_contaminated(n_hit: Column, n_words: Column, share: int = 20) -> Column:
    """Whether at least one word is hit, and one of each ``share`` words."""
    return (n_hit > 0) & (n_hit * share >= n_words)


def without_spans(text: Column, hits: Column) -> Column:
    """A text without its hit words, what stands between them included."""

    @F.pandas_udf("string")
    def cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
        out = []
        for value, own in zip(texts, spans, strict=True):
            if not value or own is None or not len(own):
                out.append(value)
                continue
            raw = value.encode()
            marked = np.frombuffer(raw.translate(LOWER), np.uint8) != 0x20
            edges = np.flatnonzero(np.diff(np.r_[False, marked, False])).reshape(-1, 2)
            kept, at = [], 0
            for span in own:
                kept.append(raw[at : edges[span["start"], 0]])
                at = edges[span["end"] - 1, 1]
            out.append(b"".join([*kept, raw[at:]]).decode())
        return pd.Series(out, dtype=object)

    return cut(text, hits)
