"""Sends the hashes of word windows of all texts to buckets of hashes, packed, to be counted there.

A row of plain (hash, id, start) takes 30 bytes or more on its way; here a task packs what a block of
texts has for a bucket into one value: ids and starts as differences, hashes without the bits that the
bucket stands for. A bucket is a range of hashes, so equal windows of the whole corpus meet in one, and
its size follows from the number of buckets, which grows with the words of the corpus.

What buckets find goes back to the texts' ids in the same way: ids are spread over as many groups as there
are buckets, and places travel from buckets to groups in rounds, each of which sends a task's places to
``FAN`` others at most. So the values on their way are ``FAN`` for each bucket and round, whatever the
number of documents, and rounds grow with its logarithm.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statlake.llm.text_arrays import from_planes, mixed, planes

BLOCK_BYTES = 2 << 20
BUCKET_BYTES = 8 << 20  # of text, about a million and a half windows
FEWEST_BUCKETS = 32
FAN = 64

# Of the texts of a block: for each window its text, its start, and two numbers: one that places it in a
# bucket, and one whose low bytes tell it from others there.
Windows = Callable[[list[bytes]], tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]


def bucket_count(docs: DataFrame, text: str) -> int:
    """Buckets for the texts of a table, by one pass over their lengths."""
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    return max(FEWEST_BUCKETS, -(-size // BUCKET_BYTES))


def byte_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    """(ids, texts) of batches with an id and a text column, in blocks of bounded size.

    A NULL text is empty and a NULL id is the smallest number.
    """
    for batch in batches:
        ids = batch.column(0).fill_null(np.iinfo(np.int64).min).to_numpy(zero_copy_only=False)
        texts = batch.column(1)
        sizes = pa.compute.fill_null(pa.compute.binary_length(texts), 0).to_numpy(zero_copy_only=False)
        block = np.cumsum(sizes) // BLOCK_BYTES
        cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(sizes)]
        for start, end in zip(cuts, cuts[1:], strict=False):
            if end > start:
                part = texts.slice(start, end - start).cast(pa.binary())
                yield ids[start:end], [t or b"" for t in part.to_pylist()]


def pack(ids: np.ndarray, text: np.ndarray, starts: np.ndarray | None, rest: np.ndarray, kept: int) -> bytes:
    """Windows in the order of their texts and starts as one value."""
    first = np.flatnonzero(np.r_[True, text[1:] != text[:-1]])
    counts = np.diff(np.r_[first, len(text)]).astype(np.uint32)
    own = ids[text[first]].view(np.uint64)
    parts = [
        np.array([len(first), len(text)], dtype=np.uint32).tobytes(),
        planes(np.diff(own, prepend=np.uint64(0))),
        planes(counts),
    ]
    if starts is not None:
        steps = np.diff(starts, prepend=0)
        steps[first] = starts[first]
        parts.append(planes(steps.astype(np.uint32)))
    return b"".join([*parts, planes(rest, kept)])


def unpack(raw: bytes, with_starts: bool, kept: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(id, start, rest) of each window; starts are 0 if none were packed."""
    docs, count = np.frombuffer(raw, np.uint32, 2)
    at = 8
    own, at = from_planes(raw, docs, at, "<u8")
    counts, at = from_planes(raw, docs, at, "<u4")
    ids = np.repeat(np.cumsum(own, dtype=np.uint64).view(np.int64), counts)
    starts = np.zeros(count, dtype=np.int64)
    if with_starts:
        steps, at = from_planes(raw, count, at, "<u4")
        sums = np.cumsum(steps, dtype=np.int64)
        ends = np.cumsum(counts)
        base = np.r_[0, sums[ends[:-1] - 1]] if len(ends) else np.zeros(0, np.int64)
        starts = sums - np.repeat(base, counts)
    rest, _ = from_planes(raw, count, at, "<u8", kept)
    return ids, starts, rest


def bucket_of(place: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of numbers spread over 64 bits: equal ranges of their upper half."""
    return ((place >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def packed_windows(
    docs: DataFrame, doc_id: str, text: str, windows: Windows, buckets: int, kept: int, with_starts: bool
) -> DataFrame:
    """Rows of (bucket, packed): what a block of texts has for a bucket."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in byte_blocks(batches):
            order = np.argsort(ids, kind="stable")
            owner, starts, place, rest = windows([texts[i] for i in order])
            ids = ids[order]
            bucket = bucket_of(place, buckets).astype(np.uint32)
            order = np.argsort(bucket, kind="stable")
            bucket, owner, starts, rest = bucket[order], owner[order], starts[order], rest[order]
            cuts = np.r_[np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]), len(bucket)]
            cuts = cuts if len(bucket) else cuts[:0]
            rows = [
                pack(ids, owner[a:b], starts[a:b] if with_starts else None, rest[a:b], kept)
                for a, b in zip(cuts, cuts[1:], strict=False)
            ]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bucket[cuts[:-1]].astype(np.int32)), pa.array(rows, pa.binary())],
                    ["bucket", "packed"],
                )

    given = docs.select(F.col(doc_id).cast("long"), F.col(text))
    return given.mapInArrow(send, "bucket int, packed binary")


def unpack_group(table: pa.Table, with_starts: bool, kept: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(id, start, rest) of all windows of a bucket, put where they stay value by value."""
    packed = table.column("packed")
    counts = [int(np.frombuffer(raw.as_buffer(), np.uint32, 2)[1]) for raw in packed]
    whole = tuple(np.empty(sum(counts), kind) for kind in (np.int64, np.int64, np.uint64))
    ends = np.cumsum(counts).tolist()
    for raw, count, end in zip(packed, counts, ends, strict=True):
        for column, part in zip(whole, unpack(raw.as_buffer().to_pybytes(), with_starts, kept), strict=True):
            column[end - count : end] = part
    return whole


def equal_runs(order_key: np.ndarray) -> np.ndarray:
    """The starts of runs of equal numbers in a sorted array."""
    return np.flatnonzero(np.r_[True, order_key[1:] != order_key[:-1]])


def rounds_of(buckets: int, fan: int) -> int:
    """Rounds in which ``fan`` ways at each reach as many groups as there are buckets."""
    rounds = 1
    while fan**rounds < buckets:
        rounds += 1
    return rounds


def sent_on(
    near: int, ids: np.ndarray, starts: np.ndarray, buckets: int, step: int, fan: int
) -> pa.Table:
    """Places packed for the next round: (near, far, packed), where buckets meet and groups part."""
    left = fan ** (rounds_of(buckets, fan) - step)
    far = bucket_of(mixed(ids.view(np.uint64)), buckets).astype(np.int64) // left
    order = np.lexsort((starts, ids, far))
    ids, starts, far = ids[order], starts[order], far[order]
    cuts = equal_runs(far) if len(far) else np.zeros(0, np.int64)
    packed = []
    for a, b in itertools.pairwise([*cuts, len(far)]):
        own, text = np.unique(ids[a:b], return_inverse=True)
        packed.append(pack(own, text, starts[a:b], np.zeros(b - a, np.uint64), 1))
    nears = np.full(len(cuts), near // fan, np.int64)
    return pa.table({"near": nears, "far": far[cuts], "packed": pa.array(packed, pa.binary())})


SENT_ON = "near long, far long, packed binary"


def places_by_id(sent: DataFrame, buckets: int, fan: int) -> DataFrame:
    """(id, starts) from what buckets sent in the first round: a row per id, starts packed in 32 bits."""
    def onward(step: int) -> Callable[[pa.Table], pa.Table]:
        def send(table: pa.Table) -> pa.Table:
            ids, starts, _ = unpack_group(table, True, 1)
            return sent_on(table.column("near")[0].as_py(), ids, starts, buckets, step, fan)

        return send

    for step in range(2, rounds_of(buckets, fan) + 1):
        sent = sent.groupBy("near", "far").applyInArrow(onward(step), SENT_ON)

    def opened(table: pa.Table) -> pa.Table:
        ids, starts, _ = unpack_group(table, True, 1)
        order = np.argsort(ids, kind="stable")
        ids, starts = ids[order], starts[order].astype("<u4")
        cuts = equal_runs(ids)
        raw = [starts[a:b].tobytes() for a, b in itertools.pairwise([*cuts, len(ids)])]
        return pa.table({"id": pa.array(ids[cuts], pa.int64()), "starts": pa.array(raw, pa.binary())})

    return sent.groupBy("far").applyInArrow(opened, "id long, starts binary")
