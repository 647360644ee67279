"""Substring duplicates: windows of words whose Rabin-Karp hash occurs earlier are cut out.

Every window of ``size`` words of every text is hashed. The hashes go packed to buckets of hashes
(``window_exchange``), where those of several places are found; of each, all places but the first (by id,
then start) are sent back to their texts in rounds and merge into maximal intervals of words to remove. Windows are
judged on the input, so the order of removing does not matter. A bucket is placed by one 64-bit hash and
its windows are told apart by 56 bits of another.

Cases: NULL, empty and short texts have no windows and lose nothing. Windows of rows with the same id and
start are not earlier than one another; rows with the same id are to have the same text. A NULL id is
less than any other. An empty table gives an empty result. Columns other than id and text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statlake.llm.text_arrays import (
    WINDOW_BASES,
    join_texts,
    mixed,
    stretch_hashes,
    window_starts,
    word_hashes,
    word_spans,
    words_per_text,
)
from statlake.llm.window_exchange import (
    FAN,
    SENT_ON,
    bucket_count,
    equal_runs,
    packed_windows,
    places_by_id,
    sent_on,
    unpack_group,
)

WINDOW = 20
KEPT_BYTES = 7


def hashed_windows(size: int):
    def windows(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        data, text_starts = join_texts(texts)
        starts, ends = word_spans(data)
        first = words_per_text(starts, text_starts)
        hashes = word_hashes(data, starts, ends)
        at, owner = window_starts(first, size)
        place, rest = (mixed(stretch_hashes(hashes, at, at + size, base)) for base in WINDOW_BASES)
        return owner, at - first[:-1][owner], place, rest

    return windows


def later_places(buckets: int, fan: int) -> Callable[[pa.Table], pa.Table]:
    """The places of a bucket's repeated windows but the first of each, sent on to their ids."""

    def later(table: pa.Table) -> pa.Table:
        ids, starts, rest = unpack_group(table, True, KEPT_BYTES)
        order = np.argsort(rest)
        sizes = np.diff(np.r_[equal_runs(rest[order]), len(order)])
        del rest
        several = sizes > 1
        order = order[np.repeat(several, sizes)]
        sizes = sizes[several]
        rank = np.repeat(np.arange(len(sizes)), sizes)
        ids, starts = ids[order], starts[order]
        order = np.lexsort((starts, ids, rank))
        ids, starts, rank = ids[order], starts[order], rank[order]
        firsts = np.flatnonzero(np.r_[True, rank[1:] != rank[:-1]]) if len(rank) else np.zeros(0, int)
        sizes = np.diff(np.r_[firsts, len(rank)])
        again = (ids != np.repeat(ids[firsts], sizes)) | (starts != np.repeat(starts[firsts], sizes))
        return sent_on(table.column("bucket")[0].as_py(), ids[again], starts[again], buckets, 1, fan)

    return later


def repeated_windows(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = WINDOW, fan: int = FAN
) -> DataFrame:
    """(id, starts) of the windows that occur earlier; starts as packed 32-bit word indices."""
    buckets = bucket_count(docs, text)
    sent = packed_windows(docs, doc_id, text, hashed_windows(size), buckets, KEPT_BYTES, True)
    later = sent.groupBy("bucket").applyInArrow(later_places(buckets, fan), SENT_ON)
    return places_by_id(later, buckets, fan)


def covered(starts: bytes, words: int, size: int) -> np.ndarray:
    """Which of a text's words lie in one of its windows that start at ``starts``."""
    steps = np.zeros(words + 1, dtype=np.int32)
    at = np.frombuffer(starts, "<u4").astype(np.int64)
    at = np.unique(at[at + size <= words])
    np.add.at(steps, at, 1)
    np.add.at(steps, at + size, -1)
    return np.cumsum(steps)[:-1] > 0


def remove_substrings(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = WINDOW
) -> DataFrame:
    """A row per document: id, n_words, n_removed, removed (intervals of words), kept_text."""
    later = repeated_windows(docs, doc_id, text, size)
    given = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    key = F.coalesce(F.col("doc_id"), F.lit(np.iinfo(np.int64).min))
    joined = given.withColumn("id", key).join(later, "id", "left").select("doc_id", "text", "starts")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, len(whole), 256):
                batch = whole.slice(at, 256)
                texts = batch.column(1).cast(pa.binary()).to_pylist()
                n_words, n_removed, removed, kept_text = [], [], [], []
                for raw, starts in zip(texts, batch.column(2).to_pylist(), strict=True):
                    words = (raw or b"").split()
                    n_words.append(len(words))
                    if starts:
                        gone = covered(starts, len(words), size)
                        edges = np.flatnonzero(np.diff(np.r_[False, gone, False]))
                        spans = edges.reshape(-1, 2).tolist()
                        words = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
                    else:
                        spans = []
                    n_removed.append(n_words[-1] - len(words))
                    removed.append([{"start": a, "end": b} for a, b in spans])
                    kept_text.append(b" ".join(words))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        pa.array(n_words, pa.int64()),
                        pa.array(n_removed, pa.int64()),
                        pa.array(removed, pa.list_(pa.struct({"start": pa.int32(), "end": pa.int32()}))),
                        pa.array(kept_text, pa.binary()).cast(pa.string()),
                        pa.array([hashlib.sha256(t).hexdigest() for t in kept_text]),
                    ],
                    ["doc_id", "n_words", "n_removed", "removed", "kept_text", "kept_sha256"],
                )

    made = joined.mapInArrow(
        cut,
        "doc_id long, n_words long, n_removed long, removed array<struct<start:int,end:int>>, "
        "kept_text string, kept_sha256 string",
    )
    return made.withColumnRenamed("doc_id", doc_id)
