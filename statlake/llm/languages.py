"""Language identification with one bit-sliced Bloom filter over letter n-grams.

Learning keeps, for each language, the n-grams that make up at least ``MIN_SHARE`` of its n-grams. They
go into one filter in which every slot holds a bit for each language, so that a lookup answers for all
languages at once: the slots of an n-gram are combined by AND into the set of languages that have it. A
text's languages are then counted bit by bit; counts are corrected for the false positives that each
language's share of set bits lets through, and the largest decides.

An n-gram is ``GRAM`` bytes of the lower-cased text in UTF-8, with one space for each run of ASCII that
is not letters, and at both ends. At most ``TRAIN_ROWS`` rows of each language are expected in the
training sample (drawn by a hash of the text); every row is counted and every text is judged whole.

Cases: a NULL text and one without a letter are ``und`` with score 0, as is every text if nothing was
learnt. A text with letters but without n-grams goes to the language with the most rows, with score 0, and
ties go to the language with more rows, then the smaller name. NULL and empty languages are not learnt.
Repeated rows give repeated rows; an empty table gives an empty result. ``identify`` puts its columns
behind those given and replaces a column of their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statlake.llm.blocks import text_blocks
from statlake.llm.scratch import scratch_table
from statlake.llm.text_arrays import mixed

GRAM = 4
MIN_SHARE = 2e-5  # so at most 50,000 n-grams of a language are kept
TRAIN_ROWS = 20_000
HASHES = 3
SLOTS_PER_GRAM = 16
UNDETERMINED = "und"

_FOLD = bytes(b if b >= 0x80 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))
_SPACE = 0x20
_ASCII_LETTER = re.compile("[A-Za-z]")


def has_letter(text: str | None) -> bool:
    if not text:
        return False
    return bool(_ASCII_LETTER.search(text)) or any(map(str.isalpha, text))


def grams_of(parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of texts as numbers, and the text each is from."""
    raw = [b" " + part.lower().encode().translate(_FOLD) for part in parts]
    sizes = np.fromiter(map(len, raw), np.int64, len(raw))
    data = np.frombuffer(b"".join([*raw, b" "]), np.uint8)
    owner = np.repeat(np.arange(len(raw)), sizes)
    space = data == _SPACE
    keep = ~(space[1:] & space[:-1])  # of a run of spaces, the last
    keep = np.append(keep, True)
    data, owner = data[keep], owner[keep[:-1]]
    if len(data) < GRAM:
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    wide = data.astype(np.uint32)
    grams = wide[: len(wide) - GRAM + 1].copy()
    for step in range(1, GRAM):
        grams = grams << np.uint32(8) | wide[step : len(wide) - GRAM + 1 + step]
    # A gram may end with the space in front of the next text, but not go beyond it.
    inside = ~(data[1 : len(grams) + 1] == _SPACE) & ~(data[2 : len(grams) + 2] == _SPACE)
    return grams[inside], owner[: len(grams)][inside]


def gram_counts(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """(lang, gram, times) over all rows given, added up inside each task first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

        def merged(name: str) -> tuple[np.ndarray, np.ndarray]:
            grams = np.concatenate([g for g, _ in held[name]])
            found, place = np.unique(grams, return_inverse=True)
            times = np.bincount(place, np.concatenate([t for _, t in held[name]])).astype(np.int64)
            return found, times

        for batch in batches:
            texts, names = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for block in text_blocks(texts):
                by_name: dict[str, list[str]] = {}
                for row, part in block:
                    by_name.setdefault(names[row], []).append(part)
                for name, parts in by_name.items():
                    held.setdefault(name, []).append(np.unique(grams_of(parts)[0], return_counts=True))
                    if sum(len(g) for g, _ in held[name]) > 2_000_000:
                        held[name] = [merged(name)]
        for name in held:
            grams, times = merged(name)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(grams)), pa.array(grams.astype(np.int64)), pa.array(times)],
                ["lang", "gram", "times"],
            )

    given = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang"))
    made = given.mapInArrow(count, "lang string, gram long, times long")
    return made.groupBy("lang", "gram").agg(F.sum("times").alias("times"))


@dataclass
class LanguageFilter:
    """``table[slot]`` holds, in words of 64 bits, a bit for each language."""

    languages: list[str]
    table: np.ndarray
    false_rate: np.ndarray

    @staticmethod
    def of(grams: dict[str, np.ndarray], order: list[str]) -> LanguageFilter:
        most = max((len(g) for g in grams.values()), default=1)
        slots = 1 << max(10, (most * SLOTS_PER_GRAM - 1).bit_length())
        table = np.zeros((slots, -(-len(order) // 64) or 1), dtype=np.uint64)
        filled = np.zeros(len(order))
        for i, name in enumerate(order):
            bit = np.uint64(1) << np.uint64(i % 64)
            for place in places_of(grams.get(name, np.zeros(0, np.uint32)), slots):
                np.bitwise_or.at(table[:, i // 64], place, bit)
            filled[i] = np.mean(table[:, i // 64] & bit != 0)
        return LanguageFilter(order, table, filled**HASHES)

    def languages_of(self, grams: np.ndarray) -> np.ndarray:
        """The set of languages of each n-gram, as words of bits."""
        found = None
        for place in places_of(grams, len(self.table)):
            found = self.table[place] if found is None else found & self.table[place]
        return found

    def counts(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Per text the n-grams found in each language, and all its n-grams."""
        hits = np.zeros((len(texts), len(self.languages)), dtype=np.int64)
        total = np.zeros(len(texts), dtype=np.int64)
        for block in text_blocks(texts):
            rows = np.array([row for row, _ in block])
            grams, owner = grams_of([part for _, part in block])
            np.add.at(total, rows, np.bincount(owner, minlength=len(rows)))
            sets = self.languages_of(grams)
            for i in range(len(self.languages)):
                bits = (sets[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)
                np.add.at(hits[:, i], rows, np.bincount(owner[bits != 0], minlength=len(rows)))
        return hits, total

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        if not self.languages:
            return [UNDETERMINED] * len(texts), np.zeros(len(texts))
        hits, total = self.counts(texts)
        real = (hits - total[:, None] * self.false_rate) / (1 - self.false_rate)
        real = np.clip(real, 0, None)
        best = real.argmax(axis=1)
        whole = real.sum(axis=1)
        score = np.divide(real[np.arange(len(best)), best], whole, out=np.zeros(len(best)), where=whole > 0)
        lettered = np.array([has_letter(t) for t in texts], dtype=bool)
        names = [self.languages[b] if ok else UNDETERMINED for b, ok in zip(best, lettered, strict=True)]
        return names, np.where(lettered, np.minimum(score, 1.0), 0.0)


def places_of(grams: np.ndarray, slots: int) -> list[np.ndarray]:
    """The slots of each n-gram, one array for each hash."""
    spread = mixed(grams.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    mask = np.uint64(slots - 1)
    step = (spread >> np.uint64(32)) | np.uint64(1)
    return [((spread + np.uint64(i) * step) & mask).astype(np.int64) for i in range(HASHES)]


def learn(
    docs: DataFrame, text: str = "text", lang: str = "lang", rows: int = TRAIN_ROWS, min_share: float = MIN_SHARE
) -> LanguageFilter:
    """The filter of the languages of labelled rows."""
    known = docs.where(F.col(text).isNotNull() & (F.length(F.col(lang)) > 0))
    sizes = {r[0]: r[1] for r in known.groupBy(F.col(lang)).count().collect()}
    if not sizes:
        return LanguageFilter.of({}, [])
    order = sorted(sizes, key=lambda name: (-sizes[name], name))
    scale = 1_000_000
    limits = F.create_map(
        *(F.lit(x) for name in order for x in (name, min(scale, -(-rows * scale // sizes[name]))))
    )
    drawn = known.where(F.pmod(F.xxhash64(F.col(text)), F.lit(scale)) < limits[F.col(lang)])
    counts = scratch_table(gram_counts(drawn, text, lang), "gram-counts")
    totals = {r[0]: r[1] for r in counts.groupBy("lang").agg(F.sum("times")).collect()}
    least = F.create_map(*(F.lit(x) for name in totals for x in (name, min_share * totals[name])))
    kept = counts.where(F.col("times") >= least[F.col("lang")]).select("lang", "gram")
    grams: dict[str, list[int]] = {}
    for row in kept.toLocalIterator():  # at most 1 / min_share rows of each language
        grams.setdefault(row.lang, []).append(row.gram)
    return LanguageFilter.of({n: np.array(g, dtype=np.uint32) for n, g in grams.items()}, order)


def identify(docs: DataFrame, model: LanguageFilter, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score."""
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.table, model.false_rate))
    names = ("lang_pred", "score")

    @F.pandas_udf("lang_pred string, score double")
    def predicted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = LanguageFilter(*shared.value)
        for batch in batches:
            names_, scores = own.predict(batch.tolist())
            yield pd.DataFrame({"lang_pred": names_, "score": scores})

    made = docs.drop(*names).withColumn("_predicted", predicted(F.col(text)))
    return made.select(*(c for c in made.columns if c != "_predicted"), "_predicted.*")


def held_out(doc_id: Column) -> Column:
    """Rows that nothing is learnt from: a quarter, by a checksum of the id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))
