"""Token counts of a word-level BPE vocabulary by rank-synchronous merging of ragged arrays.

The distinct words of a block of texts are held as one flat array of symbol ids with their starts.
Each round finds, for every word, its pair of lowest rank, and merges that pair wherever it stands in
the word, in all words at once; a word without a pair to merge is done, and its count is the number
of symbols left. Counts of words are kept in a bounded cache per worker, so a frequent word is merged
once and not once per text. Nothing is shuffled.

Cases: a NULL or empty text has 0 bytes and 0 tokens. A special string inside a text (``<|endoftext|>``)
is one token, as the library has it by default. Repeated rows give repeated rows. An empty table gives
an empty result. Other columns are not read; ``count_tokens`` puts its columns behind those given, and
replaces a column that has the name of one of them.
"""

from __future__ import annotations

import functools
import json
import re
import unicodedata
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from statlake.llm.blocks import Cache, text_blocks

NO_RANK = np.int32(2**31 - 1)
CACHED_WORDS = 400_000
# Up to U+024F all Unicode versions agree on letters, cases and compositions.
NOT_LATIN = re.compile("[^\0-\u024f]")


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary (the usual rule)."""
    plain = {*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class WordBpe:
    """A word BPE with word ends, read from the text of a ``tokenizers`` JSON file."""

    def __init__(self, text: str):
        spec = json.loads(text)
        model = spec["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        letters = byte_letters()
        self.inner = np.array([vocab[c] for c in letters], dtype=np.int64)
        self.last = np.array([vocab[c + end] for c in letters], dtype=np.int64)
        ranks = {}
        for rank, (left, right) in enumerate(
            m.split(" ") if isinstance(m, str) else m for m in model["merges"]
        ):
            key = (vocab[left] << 32) | vocab[right]
            ranks.setdefault(key, (rank, vocab[left + right]))
        keys = sorted(ranks)
        self.keys = np.array(keys, dtype=np.int64)
        self.ranks = np.array([ranks[k][0] for k in keys], dtype=np.int32)
        self.merged = np.array([ranks[k][1] for k in keys], dtype=np.int64)
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.marks = special
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pattern = regex.compile(pattern)
        self.splitter = Tokenizer.from_str(text)
        self.bytes_of = {c: b for b, c in enumerate(letters)}
        self.cache = Cache(CACHED_WORDS)

    def words(self, part: str) -> tuple[list[str], int]:
        """The lower-cased pre-tokens of a part, in any order, and the number of special strings in it."""
        specials = 0
        if self.special is not None and any(mark in part for mark in self.marks):
            spans = self.special.split(part)
            specials, part = len(spans) - 1, "\n".join(spans)
        found = []
        if NOT_LATIN.search(part):
            # What is a letter here depends on the Unicode version: the library's counts.
            chunks = part.split(" ")
            odd = " ".join(c for c in chunks if NOT_LATIN.search(c))
            odd = self.splitter.normalizer.normalize_str(odd)
            for word, _ in self.splitter.pre_tokenizer.pre_tokenize_str(odd):
                found.append(bytes(map(self.bytes_of.__getitem__, word)).decode())
            part = " ".join(c for c in chunks if not NOT_LATIN.search(c))
        if not part.isascii():
            part = unicodedata.normalize("NFC", part)
        return found + self.pattern.findall(part.lower()), specials

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rank of each pair (NO_RANK: not a merge) and what it merges to."""
        key = (left << 32) | right
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        known = self.keys[at] == key
        return np.where(known, self.ranks[at], NO_RANK), self.merged[at]

    def merge(self, words: list[bytes]) -> np.ndarray:
        """The number of symbols that each word ends with."""
        size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        raw = np.frombuffer(b"".join(words), dtype=np.uint8)
        symbols = self.inner[raw]
        ends = np.cumsum(size)
        symbols[ends - 1] = self.last[raw[ends - 1]]
        owner = np.repeat(np.arange(len(words)), size)
        counts = size.copy()
        while len(symbols):
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            rank = np.full(len(symbols), NO_RANK, dtype=np.int32)
            merged = np.zeros(len(symbols), dtype=np.int64)
            rank[:-1], merged[:-1] = self.pair_ranks(symbols[:-1], symbols[1:])
            rank[starts[1:] - 1] = NO_RANK
            lowest = np.minimum.reduceat(rank, starts)
            length = np.diff(np.r_[starts, len(symbols)])
            active = lowest != NO_RANK
            counts[owner[starts[~active]]] = length[~active]
            hit = np.flatnonzero((rank == np.repeat(lowest, length)) & (rank != NO_RANK))
            if not len(hit):
                break
            # In a run of overlapping pairs (aaa) every second one merges, from the left.
            at = np.arange(len(hit))
            first = np.r_[True, np.diff(hit) != 1]
            hit = hit[(at - np.maximum.accumulate(np.where(first, at, 0))) % 2 == 0]
            symbols[hit] = merged[hit]
            keep = np.repeat(active, length)
            keep[hit + 1] = False
            symbols, owner = symbols[keep], owner[keep]
        return counts

    def learn(self, words: list[str]) -> None:
        """Put the counts of new words into the cache."""
        counts = self.merge([word.encode() for word in words])
        self.cache.update(zip(words, counts.tolist(), strict=True))

    def count(self, texts: list[str | None]) -> np.ndarray:
        """The number of tokens of each text."""
        totals = np.zeros(len(texts), dtype=np.int64)
        for block in text_blocks(texts):
            split = [self.words(part) for _, part in block]
            needed = set(chain.from_iterable(words for words, _ in split))
            new = [word for word in needed if word not in self.cache]
            if new:
                # What the block needs besides may have to go; then all of it is learnt anew.
                self.cache.room(len(new))
                self.learn(new if self.cache else list(needed))
            get = self.cache.__getitem__
            for (row, _), (words, specials) in zip(block, split, strict=True):
                totals[row] += sum(map(get, words)) + specials
        return totals


@functools.lru_cache(maxsize=2)
def loaded(spec: str) -> WordBpe:
    return WordBpe(spec)


def count_tokens(docs: DataFrame, vocabulary: str, text: str = "text", limit: int = 2048) -> DataFrame:
    """``docs`` with n_bytes, n_tokens and over_limit (n_tokens above ``limit``).

    ``vocabulary`` is the path of a ``tokenizers`` JSON file that the driver can read; its content (a
    fixed 2-4 MB whatever the table) goes to the executors.
    """
    with open(vocabulary, encoding="utf-8") as file:
        spec = docs.sparkSession.sparkContext.broadcast(file.read())

    @F.pandas_udf("long")
    def tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bpe = loaded(spec.value)
        for batch in batches:
            yield pd.Series(bpe.count(batch.tolist()))

    counted = docs.withColumn("n_tokens", tokens(F.col(text)))
    return counted.withColumns(
        {
            "n_bytes": F.coalesce(F.octet_length(F.col(text)).cast("long"), F.lit(0).cast("long")),
            "over_limit": F.col("n_tokens") > limit,
        }
    )
