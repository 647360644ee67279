"""Near duplicates: weighted samples of TF-IDF shingles, banded, verified by weighted Jaccard similarity.

1. The distinct shingles (five lower-cased words) of every text go packed to buckets of hashes, where
   the number of texts with each shingle is counted over the whole corpus.
2. What a bucket knows goes to groups of texts: the shingles that several texts have, with their
   frequencies; of all others, which cannot be shared, only the number. A shingle weighs its number in
   the text times 1 + ``IDF_SHARE`` * ln((1 + N) / (1 + df)) / ln(2 + N), with df to the nearest eighth of
   a power of two. The weights of rare and frequent shingles are thus within a factor of 1.5: with more,
   the texts of a large group of near copies would lose similarity by the group's own size.
3. A text can be as similar as ``threshold`` to another only if shared shingles have that part of its
   weight; the others are done. For the rest, improved consistent weighted samples are drawn, with all
   shingles of its own as one element (the chance to be drawn is the same), and banded.
4. In each band, every text is compared with one text of those of equal value, the one that shares values
   with most texts. So a group of n copies takes n comparisons in a band, and a hot group is split over
   tasks. The classes of the links so far are joined. Then, within each value, texts of unlike classes meet by
   their samples, also those that were linked with those that were not, in blocks of bounded size: first the
   pair of each text that agrees most, then the next in two rounds, until all pairs that agree often
   enough have been compared or are in one class. A pair whose 100 samples agree too seldom (``SLACK`` below the
   threshold, nearly four deviations) is passed over; all others are compared shingle by shingle.
5. Verified links are joined into classes.

At similarity 0.8 a pair shares none of the 20 bands of 5 samples with probability 0.00036, and its samples
agree too seldom with probability 0.00015; one or the other, 0.00049. Such a pair is still found over third
texts, if there are any.

Cases: a text of fewer than five words has one shingle, all its words; a text without words is alone, as
are NULL and empty ones. Rows with the same id are one document whose shingles add up. A NULL id is the
smallest number. An empty table gives an empty result. Columns other than id and text are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from statlake.llm.components import components
from statlake.llm.decontaminate import LOWER
from statlake.llm.scratch import scratch_table
from statlake.llm.text_arrays import (
    WINDOW_BASES,
    from_planes,
    join_texts,
    mixed,
    planes,
    stretch_hashes,
    word_hashes,
    word_spans,
    words_per_text,
)
from statlake.llm.weighted_samples import band_values, samples
from statlake.llm.window_exchange import bucket_count, bucket_of, equal_runs, packed_windows, unpack_group

SHINGLE, THRESHOLD = 5, 0.8
BANDS, ROWS = 20, 5
IDF_SHARE = 0.5
SLACK = 0.15
BLOCK_TEXTS = 1024  # of those with equal value in a band that are compared in one task at a time
KEPT_BYTES = 8  # 32 bits of the hash, and how often the text has the shingle
BLOCK_BYTES = 4 << 20  # of packed shingles in a block, where blocks hold them
# The pairs of a text within two blocks in order of agreement, (from, below, only the best of all blocks), that
# are made into rows; the last round compares all others where the blocks are.
ROUNDS = ((0, 1, True), (0, 8, False))
FEW_PAIRS = 2_000  # that are compared one by one
ELEMENTS = 1 << 11  # columns of the matrices that are multiplied at a time
MARGIN = 1e-4  # of similarity, above what the matrices' single precision loses
PAIR_BYTES = 6  # of a shingle's hash, to compare two texts by
NO_ID = np.iinfo(np.int64).min
FOLD = np.frombuffer(LOWER, np.uint8)
LOW = np.uint64(0xFFFFFFFF)


def shingles_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct shingles of each text, for ``packed_windows``."""
    data, text_starts = join_texts(texts)
    data = FOLD[data]
    starts, ends = word_spans(data)
    first = words_per_text(starts, text_starts)
    hashes = word_hashes(data, starts, ends)
    words = np.diff(first)
    counts = np.where(words == 0, 0, np.maximum(words - SHINGLE + 1, 1))
    owner = np.repeat(np.arange(len(words)), counts)
    last = np.cumsum(counts)
    at = first[:-1][owner] + np.arange(len(owner)) - np.repeat(last - counts, counts)
    key = mixed(stretch_hashes(hashes, at, np.minimum(at + SHINGLE, first[1:][owner]), WINDOW_BASES[0]))
    order = np.lexsort((key, owner))
    owner, key = owner[order], key[order]
    new = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (key[1:] != key[:-1])][: len(owner)])
    times = np.diff(np.r_[new, len(owner)]).astype(np.uint64)
    owner, key = owner[new], key[new]
    return owner, np.zeros(len(owner), np.int64), key, (key & LOW) | times << np.uint64(32)


def frequency_codes(df: np.ndarray) -> np.ndarray:
    return np.round(8 * np.log2(df)).astype(np.uint8)


def weights_of_codes(texts: int) -> np.ndarray:
    idf = np.log((1 + texts) / (1 + 2 ** (np.arange(256) / 8))) / np.log(2 + texts)
    return 1 + IDF_SHARE * idf.clip(0)


def count_texts(groups: int):
    """Of a bucket: for each group of texts the shingles that several texts have, and the rest's number."""

    def count(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        ids, _, rest = unpack_group(table, False, KEPT_BYTES)
        key, times = rest & LOW, (rest >> np.uint64(32)).astype(np.uint32)
        order = np.argsort(key, kind="stable")
        runs = equal_runs(key[order])
        sizes = np.diff(np.r_[runs, len(order)])
        df = np.empty(len(order), np.int64)
        df[order] = np.repeat(sizes, sizes)
        group = bucket_of(mixed(ids.view(np.uint64)), groups).astype(np.int64)
        order = np.lexsort((ids, group))
        ids, key, times, df, group = (x[order] for x in (ids, key, times, df, group))
        cuts = np.r_[equal_runs(group), len(group)]
        rows = []
        for a, b in zip(cuts, cuts[1:], strict=False):
            own, several = ids[a:b], df[a:b] > 1
            texts, place = np.unique(own, return_inverse=True)
            lone = np.bincount(place[~several], times[a:b][~several], len(texts)).astype(np.uint32)
            shared = np.bincount(place[several], minlength=len(texts)).astype(np.uint32)
            rows.append(
                np.array([len(texts), several.sum()], np.uint32).tobytes()
                + planes(np.diff(texts.view(np.uint64), prepend=np.uint64(0)))
                + planes(lone)
                + planes(shared)
                + planes(times[a:b][several])
                + frequency_codes(df[a:b][several]).tobytes()
                + planes(key[a:b][several], 4)
            )
        return pa.table(
            {
                "texts": pa.array(group[cuts[:-1]].astype(np.int32)),
                "bucket": pa.array(np.full(len(rows), bucket, np.int32)),
                "packed": pa.array(rows, pa.binary()),
            }
        )

    return count


def read_counts(bucket: int, raw: bytes):
    """(texts, lone, owner, key, times, code) of what ``count_texts`` packed."""
    n, m = np.frombuffer(raw, np.uint32, 2)
    at = 8
    texts, at = from_planes(raw, n, at, "<u8")
    lone, at = from_planes(raw, n, at, "<u4")
    shared, at = from_planes(raw, n, at, "<u4")
    times, at = from_planes(raw, m, at, "<u4")
    code, at = from_planes(raw, m, at, "u1")
    key, at = from_planes(raw, m, at, "<u8", 4)
    texts = np.cumsum(texts, dtype=np.uint64).view(np.int64)
    key = mixed(key | np.uint64(bucket) << np.uint64(32))
    return texts, lone, np.repeat(texts, shared), key, times, code


def sample_texts(n_texts: int, threshold: float):
    """Of a group of texts, those that can have near duplicates: bands, weight and packed shingles."""
    idf = weights_of_codes(n_texts)

    def sample(table: pa.Table) -> pa.Table:
        parts = [
            read_counts(bucket, raw.as_buffer().to_pybytes())
            for bucket, raw in zip(table.column("bucket").to_pylist(), table.column("packed"), strict=True)
        ]
        texts, lone, owner, key, times, code = (np.concatenate(x) for x in zip(*parts, strict=True))
        texts, place = np.unique(texts, return_inverse=True)
        alone = np.bincount(place, lone, len(texts)) * idf[0]
        owner = np.searchsorted(texts, owner)
        weight = times * idf[code]
        shared = np.bincount(owner, weight, len(texts))
        can = shared >= threshold * (alone + shared) - 1e-9 * shared
        can &= shared > 0
        keep = can[owner]
        owner, key, times, code, weight = (x[keep] for x in (owner, key, times, code, weight))
        order = np.lexsort((key, owner))
        owner, key, times, code, weight = (x[order] for x in (owner, key, times, code, weight))
        chosen = np.flatnonzero(can)
        starts = np.searchsorted(owner, chosen)
        ends = np.r_[starts[1:], len(owner)][: len(starts)]
        packed = [
            np.array([b - a], np.uint32).tobytes()
            + planes(key[a:b], PAIR_BYTES)
            + planes(times[a:b])
            + code[a:b].tobytes()
            for a, b in zip(starts, ends, strict=True)
        ]
        total = (alone + shared)[chosen]
        if len(chosen):
            # One element more for all shingles that no other text has.
            own = np.flatnonzero(alone[chosen] > 0)
            keys = np.insert(key, ends[own], mixed(mixed(texts[chosen[own]].view(np.uint64)) + np.uint64(1)))
            weights = np.insert(weight, ends[own], alone[chosen[own]])
            more = np.cumsum(np.r_[0, (alone[chosen] > 0)[:-1]]).astype(np.int64)
            drawn = samples(keys, weights, starts + more, BANDS * ROWS)
        else:
            drawn = np.zeros((0, BANDS * ROWS), np.uint64)
        bands = band_values(drawn, ROWS)
        return pa.table(
            {
                "id": pa.array(texts[chosen], pa.int64()),
                "bands": pa.FixedSizeListArray.from_arrays(pa.array(bands.ravel()), BANDS).cast(
                    pa.list_(pa.int64())
                ),
                "signature": pa.array([row.tobytes() for row in drawn.astype(np.uint8)], pa.binary()),
                "weight": pa.array(total, pa.float64()),
                "packed": pa.array(packed, pa.binary()),
            }
        )

    return sample


def unpacked(raw: bytes, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = int(np.frombuffer(raw, np.uint32, 1)[0])
    key, at = from_planes(raw, n, 4, "<u8", PAIR_BYTES)
    times, at = from_planes(raw, n, at, "<u4")
    code, _ = from_planes(raw, n, at, "u1")
    order = np.argsort(key)
    return key[order], (times * idf[code])[order]


def similarity(a: bytes, weight_a: float, b: bytes, weight_b: float, idf: np.ndarray) -> float:
    """Weighted Jaccard similarity of two packed texts."""
    if a == b and weight_a == weight_b and not len(a) == 4:
        key, weight = unpacked(a, idf)
        both = float(weight.sum())
    else:
        (key_a, w_a), (key_b, w_b) = unpacked(a, idf), unpacked(b, idf)
        at = np.searchsorted(key_b, key_a)
        at[at == len(key_b)] = 0
        same = key_b[at] == key_a if len(key_b) else np.zeros(len(key_a), bool)
        both = float(np.minimum(w_a[same], w_b[at[same]]).sum())
    return both / (weight_a + weight_b - both)


def verified(pairs: DataFrame, sampled: DataFrame, n_texts: int) -> DataFrame:
    """(a, b, similarity) of pairs of ids."""
    idf = weights_of_codes(n_texts)

    @F.pandas_udf("double")
    def compare(a: pd.Series, wa: pd.Series, b: pd.Series, wb: pd.Series) -> pd.Series:
        return pd.Series([similarity(*x, idf) for x in zip(a, wa, b, wb, strict=True)], dtype=float)

    of = lambda x: sampled.select(
        F.col("id").alias(x), F.col("weight").alias(f"w{x}"), F.col("packed").alias(f"p{x}")
    )
    both = pairs.join(of("b"), "b").join(of("a"), "a")
    return both.select("a", "b", compare("pa", "wa", "pb", "wb").alias("similarity"))


def promising(pairs: DataFrame, sampled: DataFrame, least: float) -> DataFrame:
    """The pairs of ids whose samples agree in the part ``least`` or more."""

    @F.pandas_udf("boolean")
    def agree(a: pd.Series, b: pd.Series) -> pd.Series:
        x, y = (np.frombuffer(b"".join(c), np.uint8).reshape(len(c), -1) for c in (a, b))
        return pd.Series((x == y).mean(axis=1) >= least) if len(a) else pd.Series([], dtype=bool)

    of = lambda x: sampled.select(F.col("id").alias(x), F.col("signature").alias(f"s{x}"))
    both = pairs.join(of("b"), "b").join(of("a"), "a")
    return both.where(agree("sa", "sb")).select("a", "b")


def agreeing(left: np.ndarray, right: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The places and the agreement of the pairs of rows that agree in the part ``least`` or more."""
    rows, columns, counts = ([np.zeros(0, np.int64)] for _ in range(3))
    for at in range(0, len(left), 64):
        same = (left[at : at + 64, None, :] == right[None, :, :]).sum(axis=2)
        i, j = np.nonzero(same >= least * left.shape[1])
        rows.append(i + at)
        columns.append(j)
        counts.append(same[i, j])
    return np.concatenate(rows), np.concatenate(columns), np.concatenate(counts)


def shared_weights(left: list[bytes], right: list[bytes], idf: np.ndarray) -> np.ndarray:
    """The weight that each of the left packed texts shares with each of the right ones, in single precision.

    What a shingle adds for two texts is its weight times the lesser number; so each number that occurs is an
    element of its own, which the texts with that number or a greater one have.
    """
    both = np.zeros((len(left), len(right)), np.float32)
    owner, key, times, code = [], [], [], []
    for place, raw in enumerate([*left, *right]):
        n = int(np.frombuffer(raw, np.uint32, 1)[0])
        part, at = from_planes(raw, n, 4, "<u8", PAIR_BYTES)
        key.append(part)
        part, at = from_planes(raw, n, at, "<u4")
        times.append(part.astype(np.int64))
        code.append(from_planes(raw, n, at, "u1")[0])
        owner.append(np.full(n, place, np.int64))
    owner, key, times, code = (np.concatenate(x) for x in (owner, key, times, code))
    order = np.lexsort((times, key))
    owner, key, times, code = owner[order], key[order], times[order], code[order]
    first = equal_runs(key) if len(key) else np.zeros(0, np.int64)
    sizes = np.diff(np.r_[first, len(key)])
    of_left = np.add.reduceat((owner < len(left)).astype(np.int64), first) if len(first) else first
    keep = np.repeat((of_left > 0) & (of_left < sizes), sizes)
    owner, key, times, code = owner[keep], key[keep], times[keep], code[keep]
    if not len(key):
        return both
    element = equal_runs_of(key, times)
    number = np.cumsum(element) - 1
    at = np.flatnonzero(element)
    opens = np.r_[True, key[at][1:] != key[at][:-1]]
    weight = (np.where(opens, times[at], np.diff(times[at], prepend=0)) * idf[code[at]]).astype(np.float32)
    lowest = np.maximum.accumulate(np.where(opens, np.arange(len(at)), 0))[number]
    for low in range(0, len(at), ELEMENTS):
        high = min(low + ELEMENTS, len(at))
        has = np.flatnonzero((lowest < high) & (number >= low))
        a, b = np.maximum(lowest[has], low), np.minimum(number[has], high - 1)
        columns = np.zeros((len(left) + len(right), high - low + 1), np.float32)
        np.add.at(columns, (owner[has], a - low), 1)
        np.add.at(columns, (owner[has], b - low + 1), -1)
        columns = np.cumsum(columns, axis=1)[:, :-1]
        both += (columns[: len(left)] * weight[low:high]) @ columns[len(left) :].T
    return both


def equal_runs_of(*keys: np.ndarray) -> np.ndarray:
    """Of sorted rows, whether each one is unlike the one before."""
    new = np.ones(len(keys[0]), bool)
    new[1:] = False
    for key in keys:
        new[1:] |= key[1:] != key[:-1]
    return new


def blocks_of(compared: Callable[[pa.Table, np.ndarray], pa.RecordBatch]):
    """Calls ``compared`` with rows sorted by value, i and j, and with the ends of the groups among them."""
    keys = ("value", "i", "j")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def cut(table: pa.Table) -> pa.RecordBatch:
            new = equal_runs_of(*(table.column(c).to_numpy() for c in keys))
            return compared(table, np.r_[np.flatnonzero(new), len(table)])

        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not len(batch):
                continue
            # The last group may go on in the next batch.
            ends = [held[-1].slice(len(held[-1]) - 1)] if held else []
            new = equal_runs_of(*(pa.Table.from_batches([*ends, batch]).column(c).to_numpy() for c in keys))
            starts = np.flatnonzero(new[len(ends) :])
            if len(starts) and (held or starts[-1]):
                yield cut(pa.Table.from_batches([*held, batch.slice(0, starts[-1])]))
                held = []
            held.append(batch.slice(starts[-1]) if len(starts) else batch)
        if held:
            yield cut(pa.Table.from_batches(held))

    return each


def sides_of(table: pa.Table, start: int, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The rows of block i and of block j of a group, without those that have no text of an unlike class."""
    block, now = (table.column(c).to_numpy() for c in ("block", "now"))
    i, j = (table.column(c)[start].as_py() for c in ("i", "j"))
    left = start + np.flatnonzero(block[start:end] == i)
    right = start + np.flatnonzero(block[start:end] == j)
    if len(right) and (now[right] == now[right[0]]).all():
        left = left[now[left] != now[right[0]]]
    return left, right


def unlike_pairs(table: pa.Table, own: np.ndarray, left: np.ndarray, right: np.ndarray, least: float):
    """Rows x and y that agree often enough and were of unlike classes ``before``, and their agreement."""
    ids, before = (table.column(c).to_numpy() for c in ("id", "before"))
    x, y, same = agreeing(own[left], own[right], least)
    x, y = left[x], right[y]
    one = len(left) and len(right) and (table.column("i")[int(left[0])] == table.column("j")[int(left[0])])
    keep = before[x] != before[y]
    keep &= ids[x] < ids[y] if one else ids[x] != ids[y]
    return x[keep], y[keep], same[keep]


def signatures_of(table: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(table.column("signature").to_pylist()), np.uint8).reshape(len(table), BANDS * ROWS)


def pairs_of_blocks(least: float, low: int, high: int | None):
    """Of rows sorted by value, i and j: the agreeing pairs of blocks i and j of unlike ``before`` and ``now``.

    Of each text of block i, those that come from ``low`` to below ``high`` in the order of agreement, which
    does not depend on ``now``.
    """

    def compared(table: pa.Table, cuts: np.ndarray) -> pa.RecordBatch:
        ids, now = (table.column(c).to_numpy() for c in ("id", "now"))
        own = signatures_of(table)
        made = [[np.zeros(0, np.int64)] for _ in range(3)]
        for start, end in zip(cuts, cuts[1:], strict=False):
            left, right = sides_of(table, start, end)
            x, y, same = unlike_pairs(table, own, left, right, least)
            order = np.lexsort((ids[y], -same, x))
            x, y, same = x[order], y[order], same[order]
            first = equal_runs(x) if len(x) else np.zeros(0, int)
            rank = np.arange(len(x)) - np.repeat(first, np.diff(np.r_[first, len(x)]))
            keep = (now[x] != now[y]) & (rank >= low)
            if high is not None:
                keep &= rank < high
            for column, part in zip(made, (ids[x], ids[y], same), strict=True):
                column.append(part[keep])
        text, other, same = (np.concatenate(column) for column in made)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in (text, np.minimum(text, other), np.maximum(text, other), same)],
            ["text", "a", "b", "same"],
        )

    return blocks_of(compared)


def links_of_blocks(least: float, threshold: float, idf: np.ndarray):
    """Of rows sorted by value, i and j: the links between blocks i and j of unlike ``before`` and ``now``.

    Two texts are compared where the first value is that both have, in the order of the bands.
    """

    def compared(table: pa.Table, cuts: np.ndarray) -> pa.RecordBatch:
        ids, now, value, weight = (table.column(c).to_numpy() for c in ("id", "now", "value", "weight"))
        own, packed = signatures_of(table), table.column("packed")
        bands = table.column("bands").combine_chunks().flatten().to_numpy().reshape(len(table), -1)
        raw = lambda row: packed[int(row)].as_py()
        found = []
        for start, end in zip(cuts, cuts[1:], strict=False):
            left, right = sides_of(table, start, end)
            x, y, _ = unlike_pairs(table, own, left, right, least)
            keep = now[x] != now[y]
            x, y = x[keep], y[keep]
            keep = np.ones(len(x), bool)
            for at in range(0, len(x), 1 << 16):
                part = slice(at, at + (1 << 16))
                same = bands[x[part]] == bands[y[part]]
                first = np.argmax(same, axis=1)
                keep[part] = bands[x[part], first] == value[x[part]]
            x, y = x[keep], y[keep]
            if len(x) > FEW_PAIRS:
                (of_x, x_at), (of_y, y_at) = (np.unique(side, return_inverse=True) for side in (x, y))
                both = shared_weights([raw(r) for r in of_x], [raw(r) for r in of_y], idf)[x_at, y_at]
                near = both >= (threshold - MARGIN) * (weight[x] + weight[y] - both)
                x, y = x[near], y[near]
            found += [
                (min(ids[a], ids[b]), max(ids[a], ids[b]))
                for a, b in zip(x, y, strict=True)
                if similarity(raw(a), weight[a], raw(b), weight[b], idf) >= threshold
            ]
        pairs = np.array(found, np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    return blocks_of(compared)


def block_rows(members: DataFrame, sampled: DataFrame, *own: str) -> DataFrame:
    """The members (value, id, before, now) once for each pair of blocks (i, j) of their value that they are in.

    Only values of unlike classes. Those outside the largest class of a value meet all others of the value;
    those of the largest do not meet each other. The columns ``own`` of ``sampled`` come along.
    """
    given = sampled.select("id", *own)
    size = F.length("packed") if "packed" in own else F.lit(0)
    members = members.join(sampled.select("id", size.alias("bytes")), "id") if "packed" in own else members.withColumn("bytes", size)
    counts = members.groupBy("value", "before").agg(
        F.count("*").alias("n"), F.sum("bytes").alias("bytes"), F.min("now").alias("least"), F.max("now").alias("most")
    )
    sizes = counts.groupBy("value").agg(
        F.sum("n").alias("n"), F.sum("bytes").alias("bytes"), F.max(F.struct("n", "before", "bytes")).alias("main"),
        F.min("least").alias("x"), F.max("most").alias("y"),
    )
    parts = lambda n, size: F.ceil(F.greatest(n / BLOCK_TEXTS, size / BLOCK_BYTES)).cast("int")
    sizes = sizes.where("n > main.n AND x <> y").select(
        "value",
        F.col("main.before").alias("main"),
        parts(F.col("n") - F.col("main.n"), F.col("bytes") - F.col("main.bytes")).alias("few"),
        parts(F.col("main.n"), F.col("main.bytes")).alias("many"),
    )
    inner = F.col("before") == F.col("main")
    slot = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    placed = (
        members.join(sizes, "value")
        .withColumn("block", F.when(inner, F.col("few") + slot("many")).otherwise(slot("few")))
        .withColumn("last", F.col("few") - 1 + F.when(inner, 0).otherwise(F.col("many")))
        .select("value", "id", "before", "now", "block", "last")
        .join(given, "id")
    )
    columns = ["block", "id", "before", "now", *own]
    both = placed.select("value", *columns, F.explode(F.sequence(F.lit(0), "last")).alias("other"))
    keys = ["value", "i", "j"]
    both = both.select("value", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), *columns)
    return both.repartition(*keys).sortWithinPartitions(*keys)


def pairs_among(
    members: DataFrame, sampled: DataFrame, least: float, ranks: tuple[int, int | None] = (0, None), best: bool = False
) -> DataFrame:
    """(a, b) of the members (value, id) of equal value whose samples agree often enough.

    With columns ``before`` and ``now``, the classes of the members at the first and at this round, only
    pairs of unlike classes. ``best``: only the pair of each text that agrees most.
    """
    if "now" not in members.columns:
        members = members.withColumn("before", F.col("id")).withColumn("now", F.col("id"))
    rows = block_rows(members, sampled, "signature")
    found = rows.mapInArrow(pairs_of_blocks(least, *ranks), "text long, a long, b long, same long")
    if best:
        top = F.max(F.struct("same", "a", "b"))
        found = found.groupBy("text").agg(top.alias("top")).select("top.a", "top.b")
    return found.select("a", "b").distinct()


def links_among(
    members: DataFrame, sampled: DataFrame, least: float, n_texts: int, threshold: float
) -> DataFrame:
    """(a, b) of the members (value, id, before, now) of equal value and unlike classes that are similar.

    Samples that agree seldom are passed over, as in ``pairs_among``.
    """
    rows = block_rows(members, sampled, "signature", "bands", "weight", "packed")
    found = rows.mapInArrow(links_of_blocks(least, threshold, weights_of_codes(n_texts)), "a long, b long")
    return found.distinct()


def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (id, label) after more links (a, b); ids without a label are classes of their own."""
    ends = links.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    known = labels.unionByName(ends.join(labels, "id", "left_anti").withColumn("label", F.col("id")))
    known = scratch_table(known, "labels")
    of = lambda x: known.select(F.col("id").alias(x), F.col("label").alias(f"l{x}"))
    between = links.join(of("a"), "a").join(of("b"), "b").select(F.col("la").alias("a"), F.col("lb").alias("b"))
    joined = components(between).select(F.col("id").alias("label"), F.col("label").alias("next"))
    moved = known.join(joined, "label", "left").select("id", F.coalesce("next", "label").alias("label"))
    return scratch_table(moved, "labels")


def classes_of(sampled: DataFrame, n_texts: int, threshold: float) -> tuple[DataFrame, DataFrame]:
    """(a, b) of the texts found similar, a < b; and (id, label) of their classes by the least id."""
    members = sampled.select(F.explode("bands").alias("value"), "id")
    sizes = members.groupBy("value").agg(F.count("*").alias("n")).where("n > 1")
    members = scratch_table(members.join(sizes, "value").select("value", "id", "n"), "members")
    met = members.groupBy("id").agg(F.sum("n").alias("met"))
    central = F.max(F.struct("met", F.xxhash64("id").alias("order"), F.col("id").alias("id")))
    heads = members.join(met, "id").groupBy("value").agg(central["id"].alias("head"))
    compared = scratch_table(
        members.join(heads, "value")
        .where("id <> head")
        .select("value", "id", "n", F.least("id", "head").alias("a"), F.greatest("id", "head").alias("b")),
        "compared",
    )

    def rated(pairs: DataFrame) -> DataFrame:
        return scratch_table(verified(pairs, sampled, n_texts), "near-pairs")

    least = threshold - SLACK
    pairs = compared.select("a", "b").distinct()
    tested = rated(promising(pairs, sampled, least))
    links = tested.where(F.col("similarity") >= threshold).select("a", "b")
    labels = components(links)
    # The head has met all of its value; what is left to meet are the others that are in unlike classes.
    named = compared.where("n > 2").join(labels, "id", "left")
    named = named.select("value", "id", F.coalesce("label", "id").alias("before"))
    apart = named.groupBy("value").agg(F.min("before").alias("x"), F.max("before").alias("y")).where("x <> y")
    left = scratch_table(named.join(apart.select("value"), "value", "left_semi"), "left")
    for ranks in (*ROUNDS, None):
        now = left.join(labels, "id", "left").select(
            "value", "id", "before", F.coalesce("label", "id").alias("now")
        )
        if ranks is None:
            # Those that were tested are passed over too: what was similar is in one class now.
            more = scratch_table(links_among(now, sampled, least, n_texts, threshold), "near-pairs")
        else:
            low, high, best = ranks
            others = pairs_among(now, sampled, least, (low, high), best)
            found = rated(others.join(tested, ["a", "b"], "left_anti"))
            tested = tested.unionByName(found)
            more = found.where(F.col("similarity") >= threshold).select("a", "b")
        if not more.isEmpty():
            links = links.unionByName(more)
            labels = merged(labels, more)
    return links, labels


def links_of(sampled: DataFrame, n_texts: int, threshold: float) -> DataFrame:
    """(a, b) of the texts found similar, a < b."""
    return classes_of(sampled, n_texts, threshold)[0]


def near_classes(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """A row per id: id, class_id (least id of its class), n_links (verified), kept (one of each class)."""
    n_texts = docs.count()
    buckets = bucket_count(docs, text)
    sent = packed_windows(docs, doc_id, text, shingles_of, buckets, KEPT_BYTES, False)
    counted = sent.groupBy("bucket").applyInArrow(
        count_texts(buckets), "texts int, bucket int, packed binary"
    )
    sampled = counted.groupBy("texts").applyInArrow(
        sample_texts(n_texts, threshold), "id long, bands array<long>, signature binary, weight double, packed binary"
    )
    sampled = scratch_table(sampled, "sampled")
    links, labels = classes_of(sampled, n_texts, threshold)
    ends = links.select(F.explode(F.array("a", "b")).alias("id"))
    n_links = ends.groupBy("id").agg(F.count("*").alias("n_links"))
    ids = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("id")).distinct()
    joined = ids.join(labels, "id", "left").join(n_links, "id", "left")
    made = joined.select(
        F.col("id").alias(doc_id),
        F.coalesce("label", "id").alias("class_id"),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
    )
    return made.withColumn("kept", F.col(doc_id) == F.col("class_id"))


def drop_near_copies(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """``docs`` with the row of the least id of each class, all its columns unchanged.

    Of rows with the same id and text one stays; rows with the same id and other texts are not told apart
    by classes and stay.
    """
    gone = near_classes(docs, doc_id, text, threshold).where("NOT kept").select(F.col(doc_id).alias("gone"))
    given = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("document"),
        F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("id"),
        F.sha2(F.coalesce(F.col(text), F.lit("")), 256).alias("digest"),
    )
    left = given.join(gone, given["id"] == gone["gone"], "left_anti")
    # The join has put rows of one id side by side.
    same = Window.partitionBy("id", "digest").orderBy(F.lit(0))
    return left.withColumn("place", F.row_number().over(same)).where("place = 1").select("document.*")
