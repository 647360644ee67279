"""Ranked lexical search: bit-sliced Bloom signatures bound every score, what they cannot exclude is scored.

A document's signature holds, for each term, the term at every level 2^l that its number of occurrences
reaches. The signatures of a block of documents of like size are stored by slices: one bitmap over the
documents for each bit of the signature. The slices of a term at a level, taken together with AND, give a
bitmap of the documents that may have it so often, so the weighted sum over the terms of an item, taken at
the most occurrences a level allows, is never below the score. The documents of the greatest bounds are
scored first; the tenth best of these scores bounds the result from below, and all documents whose bound
reaches it are then scored exactly from their whole text, so the result is exact.

Score of a document of n terms for an item: with N documents that have terms, L terms in all and df
documents that hold a term, w = floor(1000 ln((2N + 2) / (2 df + 1))), m = 100 - 75 + (75 n N) div L, and the
score sums w ((10^9 tf) div (1000 tf + 8 m)) over the item's terms, repeats included.

Items are worked on in blocks of at most ``BLOCK_TERMS`` different terms (an item with more is a block of its
own); only a block's terms and limits are sent to the tasks. Document frequencies are counted for all
documents, of the terms whose bit is set in a bitmap of fixed size made from the items' terms. The documents
to score are picked by a bitmap of fixed size too, so no text is shuffled. Terms are told apart by 64 bits of hash.

Cases: NULL and empty texts have no terms; such documents are not found and such items find nothing. Each row
is a document, repeated ones too; equal scores rank by id, a NULL id last. An item in several rows is
answered for each. Fewer documents with a score above 0 than asked for give fewer rows. An empty table on
either side gives an empty result. Columns other than id and text are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from statlake.llm.scratch import scratch_table
from statlake.llm.text_arrays import join_texts, mixed, word_hashes, word_spans, words_per_text
from statlake.llm.window_exchange import byte_blocks
from statlake.session import scratch_dir

TOP = 10
FIRST_SCORED = 32  # documents of the greatest bounds that are scored to get a limit
BLOCK_TERMS = 4096
BITMAP_BITS = 1 << 20
KEY_BITS, HASHES = 10, 3  # bits of a signature for each key of its document, and how many a key sets
BLOCK_DOCS, SLICE_BITS = 512, 1 << 23
PIECE = 1 << 20
FILTER_BITS = 1 << 22
CHUNK_DOCS = 512
NO_ID = np.iinfo(np.int64).min

# Bytes of terms: digits, letters, and all that is not ASCII; capital letters become small.
IN_TERM = np.zeros(256, dtype=bool)
IN_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
SMALL = bytes(c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))

SIGNATURES = (
    "ids array<long>, lengths array<long>, bits int, slices binary, terms array<long>, "
    "holding array<long>, n_docs long, n_terms long"
)
LONGS = pa.list_(pa.int64())


def pieces_of(text: bytes, size: int = PIECE) -> Iterator[bytes]:
    """A text cut where no term is, into parts of about a size."""
    start = 0
    while len(text) - start > size:
        end = start + size
        while end < len(text):
            window = ~IN_TERM[np.frombuffer(text, np.uint8, min(4096, len(text) - end), end)]
            if window.any():
                end += int(window.argmax())
                break
            end += len(window)
        yield text[start:end]
        start = end
    yield text[start:]


def sums_of_equal(owner: np.ndarray, term: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, ...]:
    """(owner, term, count) with one row for each owner and term, in their order."""
    order = np.lexsort((term, owner))
    owner, term, count = owner[order], term[order], count[order]
    first = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (term[1:] != term[:-1])][: len(owner)])
    return owner[first], term[first], np.add.reduceat(count, first) if len(first) else count


def term_counts(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, hash, occurrences) of the different terms of each text."""
    found, at = [], 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end]) <= PIECE):
            size += len(texts[end])
            end += 1
        for parts in ([[p] for p in pieces_of(texts[at])] if end == at + 1 else [texts[at:end]]):
            data, text_starts = join_texts([p.translate(SMALL) for p in parts])
            starts, ends = word_spans(data, IN_TERM)
            owner = np.repeat(np.arange(at, at + len(parts)), np.diff(words_per_text(starts, text_starts)))
            found.append(sums_of_equal(owner, word_hashes(data, starts, ends), np.ones(len(owner), np.int64)))
        at = end
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return sums_of_equal(*(np.concatenate(x) for x in zip(*found, strict=True)))


def level_keys(term: np.ndarray, level: int) -> np.ndarray:
    """What a signature holds of terms that occur 2^level times or more."""
    return mixed(term + np.uint64((level + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))


def key_places(keys: np.ndarray, bits: int) -> list[np.ndarray]:
    """The bits that keys set."""
    low, high = keys & np.uint64(0xFFFFFFFF), keys >> np.uint64(32)
    return [((low + np.uint64(j) * high) % np.uint64(bits)).astype(np.int64) for j in range(HASHES)]


def slices_of(owner: np.ndarray, keys: np.ndarray, docs: int, bits: int) -> bytes:
    """Bitmaps over the documents, one for each bit of their signatures."""
    on = np.zeros((bits, -(-docs // 8) * 8), dtype=bool)
    for place in key_places(keys, bits):
        on[place, owner] = True
    return np.packbits(on, axis=1).tobytes()


def signature_table(docs: DataFrame, doc_id: str, text: str, wanted: np.ndarray) -> DataFrame:
    """Blocks of documents with their slices, and in how many of them the wanted terms are."""

    def signed(ids: np.ndarray, texts: list[bytes]) -> Iterator[tuple]:
        owner, term, count = term_counts(texts)
        if not len(owner):
            return
        lengths = np.bincount(owner, count, len(texts)).astype(np.int64)
        hit = term[wanted[term % np.uint64(len(wanted))]]
        terms, holding = np.unique(hit, return_counts=True)
        rest = (terms.view(np.int64), holding, int((lengths > 0).sum()), int(lengths.sum()))
        levels = int(count.max()).bit_length()
        keys = [(owner[often], level_keys(term[often], k)) for k in range(levels) if (often := count >= 1 << k).any()]
        owners, keys = (np.concatenate(x) for x in zip(*keys, strict=True))
        held = np.bincount(owners, minlength=len(texts))
        order = np.argsort(owners, kind="stable")
        owners, keys = owners[order], keys[order]
        starts = np.r_[0, np.cumsum(held)]
        by_size = np.argsort(-held, kind="stable")[: int((held > 0).sum())]
        at = 0
        while at < len(by_size):
            bits = max(64, int(held[by_size[at]]) * KEY_BITS)
            own = by_size[at : at + min(BLOCK_DOCS, max(8, SLICE_BITS // bits))]
            mine = np.concatenate([keys[starts[d] : starts[d + 1]] for d in own])
            places = np.repeat(np.arange(len(own)), held[own])
            yield ids[own], lengths[own], bits, slices_of(places, mine, len(own), bits), *rest
            rest = (terms[:0].view(np.int64), holding[:0], 0, 0)
            at += len(own)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in byte_blocks(batches):
            for own, lengths, bits, slices, terms, holding, n_docs, n_terms in signed(ids, texts):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([own], LONGS),
                        pa.array([lengths], LONGS),
                        pa.array([bits], pa.int32()),
                        pa.array([slices], pa.binary()),
                        pa.array([terms], LONGS),
                        pa.array([holding], LONGS),
                        pa.array([n_docs], pa.int64()),
                        pa.array([n_terms], pa.int64()),
                    ],
                    ["ids", "lengths", "bits", "slices", "terms", "holding", "n_docs", "n_terms"],
                )

    given = docs.select(F.col(doc_id).cast("long"), F.col(text))
    return scratch_table(given.mapInArrow(sign, SIGNATURES), "ranked-signatures")


def item_terms(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """(item, item_id, terms, repeats): a number for each row and the terms of its text."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, term, count = term_counts([t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()])
            bounds = np.searchsorted(owner, np.arange(len(batch) + 1))
            cuts = list(zip(bounds, bounds[1:], strict=False))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([term[a:b].view(np.int64) for a, b in cuts], LONGS),
                    pa.array([count[a:b] for a, b in cuts], LONGS),
                ],
                ["item", "terms", "repeats"],
            )

    numbered = scratch_table(
        items.select(F.monotonically_increasing_id().alias("item"), F.col(item_id).alias("item_id"), F.col(text).alias("text")),
        "ranked-items",
    )
    made = numbered.select("item", "text").mapInArrow(cut, "item long, terms array<long>, repeats array<long>")
    return scratch_table(numbered.select("item", "item_id").join(made, "item"), "ranked-terms")


def bitmap_of(terms: DataFrame) -> np.ndarray:
    """A bitmap of fixed size with the terms of all items."""
    place = F.explode(F.transform("terms", lambda t: t.bitwiseAND(BITMAP_BITS - 1))).alias("place")
    out = np.zeros(BITMAP_BITS, dtype=bool)
    out[[r["place"] for r in terms.select(place).distinct().collect()]] = True  # at most BITMAP_BITS rows
    return out


def weighted_items(terms: DataFrame, signatures: DataFrame, n_docs: int) -> DataFrame:
    """(item, terms, repeats, weights), terms of weight 0 left out."""
    pairs = F.explode(F.arrays_zip("terms", "holding")).alias("pair")
    holding = signatures.select(pairs).groupBy(F.col("pair.terms").alias("term")).agg(
        F.sum("pair.holding").alias("df")
    )
    own = terms.select("item", F.explode(F.arrays_zip("terms", "repeats")).alias("pair"))
    own = own.select("item", F.col("pair.terms").alias("term"), F.col("pair.repeats").alias("repeats"))
    share = F.lit(2.0 * n_docs + 2) / (2 * F.coalesce("df", F.lit(0)) + 1)
    weight = F.floor(1000 * F.log(share)).cast("long")
    known = own.join(holding, "term").withColumn("weight", weight).where("weight > 0")
    row = F.collect_list(F.struct("term", "repeats", "weight")).alias("rows")
    return scratch_table(known.groupBy("item").agg(row).orderBy("item"), "ranked-weights")


class ItemBlock:
    """Items with their different terms, weights, and the terms of each item."""

    def __init__(self, rows: list):
        self.items = np.array([r["item"] for r in rows], dtype=np.int64)
        parts = [np.array([tuple(x) for x in r["rows"]], dtype=np.int64).reshape(-1, 3) for r in rows]
        together = np.concatenate(parts)
        self.terms, first, place = np.unique(together[:, 0].view(np.uint64), return_index=True, return_inverse=True)
        self.weights = together[first, 2]
        cuts = np.cumsum([len(p) for p in parts])[:-1]
        self.places = np.split(place, cuts)
        self.repeats = [p[:, 1][:, None] for p in parts]

    def sums(self, by_term: np.ndarray) -> np.ndarray:
        """Of values by term and document, the weighted sum for each item and document."""
        by_term *= self.weights[:, None]
        return np.stack([(by_term[p] * r).sum(0) for p, r in zip(self.places, self.repeats, strict=True)])


def item_blocks(weighted: DataFrame) -> Iterator[ItemBlock]:
    """The items in blocks; the driver holds one block and the partition it comes from."""
    held, terms = [], 0
    for row in weighted.toLocalIterator():
        if held and terms + len(row["rows"]) > BLOCK_TERMS:
            yield ItemBlock(held)
            held, terms = [], 0
        held.append(row)
        terms += len(row["rows"])
    if held:
        yield ItemBlock(held)


def length_measure(lengths: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    return 100 - 75 + (75 * lengths * n_docs) // n_terms


def saturated(often: np.ndarray | int, measure: np.ndarray) -> np.ndarray:
    """What occurrences are worth, in units of 10^-6."""
    return (1_000_000_000 * often) // (1000 * often + 8 * measure)


def bounds_of(block: ItemBlock, bits: int, raw: bytes, lengths: np.ndarray, measure: np.ndarray) -> np.ndarray:
    """What the score of each document for each item cannot exceed."""
    docs = len(lengths)
    slices = np.frombuffer(raw, np.uint8).reshape(bits, -1)
    worth = np.zeros((len(block.terms), docs), dtype=np.int64)
    alive, held = np.arange(len(block.terms)), None
    level = 0
    while len(alive) and 1 << level <= lengths.max():
        first, *others = key_places(level_keys(block.terms[alive], level), bits)
        maybe = slices[first]
        for place in others:
            maybe &= slices[place]
        if held is not None:
            maybe &= held
        some = maybe.any(1)
        alive, held = alive[some], maybe[some]
        on = np.unpackbits(held, axis=1, count=docs).astype(bool)
        value = saturated(np.minimum((2 << level) - 1, lengths), measure)
        worth[alive] = np.where(on, value, worth[alive])
        level += 1
    return block.sums(worth)


def likely(docs: DataFrame, keys: DataFrame, bits: int = FILTER_BITS) -> DataFrame:
    """The documents whose key may be among some, without moving a text.

    The keys become bitmaps of a size that is fixed whatever their number; these are sent to the documents.
    A document that passes without being asked for is scored needlessly and changes nothing.
    """
    place = F.pmod(F.xxhash64("key"), F.lit(bits))
    maps = keys.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bitmap")
    )
    asked = docs.select("key", "text", place.alias("place")).withColumn("bucket", F.bitmap_bucket_number("place"))
    asked = asked.join(F.broadcast(maps), "bucket").withColumn("bit", F.bitmap_bit_position("place"))
    byte = F.expr("cast(conv(hex(substring(bitmap, cast(bit div 8 as int) + 1, 1)), 16, 10) as int)")
    hit = asked.withColumn("byte", byte).where("shiftright(byte, cast(bit % 8 as int)) & 1 = 1")
    return hit.select("key", "text")


def best_rows(scores: np.ndarray, ids: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    """Of scores and ids by item, the highest, smaller ids first among equals."""
    if scores.shape[1] > 4 * top:
        edge = -np.partition(-scores, top - 1, axis=1)[:, top - 1 : top]
        some = (scores >= np.maximum(edge, 1)).any(0)
        scores, ids = scores[:, some], ids[:, some]
    order = np.lexsort((ids, -scores), axis=-1)[:, :top]
    return np.take_along_axis(scores, order, 1), np.take_along_axis(ids, order, 1)


class BestSoFar:
    """The best rows of each item among all that a task has seen."""

    def __init__(self, items: int, top: int):
        self.scores, self.ids = np.zeros((items, 0), np.int64), np.zeros((items, 0), np.int64)
        self.top = top

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        ids = np.broadcast_to(ids, scores.shape)
        self.scores, self.ids = best_rows(np.c_[self.scores, scores], np.c_[self.ids, ids], self.top)

    def batch(self, items: np.ndarray) -> pa.RecordBatch:
        row, column = np.nonzero(self.scores > 0)
        return pa.RecordBatch.from_arrays(
            [pa.array(items[row]), pa.array(self.ids[row, column]), pa.array(self.scores[row, column])],
            ["item", "key", "score"],
        )


FOUND = "item long, key long, score long"


def ranked(found: DataFrame, top: int) -> DataFrame:
    """The best rows of each item with their ranks; a NULL id has the key of least worth among equals."""
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("key") == NO_ID, "key")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


class Search:
    """One corpus, its signatures and counts, and the items of one block."""

    def __init__(self, docs: DataFrame, signatures: DataFrame, n_docs: int, n_terms: int):
        self.docs, self.signatures = docs, signatures
        self.n_docs, self.n_terms = n_docs, n_terms

    def over_blocks(self, block: ItemBlock, each: Callable, end: Callable, start: Callable, schema: str) -> DataFrame:
        """A function of the bounds of each block of documents, with something kept along a task."""
        n_docs, n_terms = self.n_docs, self.n_terms

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            state = start()
            for batch in batches:
                for ids, lengths, bits, raw in zip(*batch.columns, strict=True):
                    ids, lengths = (x.values.to_numpy(zero_copy_only=False) for x in (ids, lengths))
                    measure = length_measure(lengths, n_docs, n_terms)
                    bounds = bounds_of(block, bits.as_py(), raw.as_py(), lengths, measure)
                    yield from each(state, ids, bounds)
            yield from end(state)

        return self.signatures.select("ids", "lengths", "bits", "slices").mapInArrow(scan, schema)

    def greatest_bounds(self, block: ItemBlock) -> DataFrame:
        """The documents whose bounds are the greatest of an item."""

        def each(best: BestSoFar, ids: np.ndarray, bounds: np.ndarray) -> list:
            best.add(bounds, ids)
            return []

        start = lambda: BestSoFar(len(block.items), FIRST_SCORED)
        found = self.over_blocks(block, each, lambda best: [best.batch(block.items)], start, FOUND)
        return ranked(found, FIRST_SCORED).select("key")

    def not_excluded(self, block: ItemBlock, limits: np.ndarray) -> DataFrame:
        """The documents whose bound reaches the limit of some item."""

        def each(_: None, ids: np.ndarray, bounds: np.ndarray) -> list:
            keys = ids[(bounds >= np.maximum(limits, 1)[:, None]).any(0)]
            return [pa.RecordBatch.from_arrays([pa.array(keys)], ["key"])]

        return self.over_blocks(block, each, lambda _: [], lambda: None, "key long")

    def scored(self, block: ItemBlock, keys: DataFrame, top: int) -> DataFrame:
        """The best documents of each item among some, scored from their texts."""
        n_docs, n_terms = self.n_docs, self.n_terms

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            best = BestSoFar(len(block.items), top)
            for all_ids, all_texts in byte_blocks(batches):
                for at in range(0, len(all_texts), CHUNK_DOCS):
                    ids, texts = all_ids[at : at + CHUNK_DOCS], all_texts[at : at + CHUNK_DOCS]
                    owner, term, count = term_counts(texts)
                    lengths = np.bincount(owner, count, len(texts)).astype(np.int64)
                    measure = length_measure(lengths, n_docs, n_terms)
                    place = np.minimum(np.searchsorted(block.terms, term), len(block.terms) - 1)
                    known = block.terms[place] == term
                    place, owner, count = place[known], owner[known], count[known]
                    worth = np.zeros((len(block.terms), len(texts)), dtype=np.int64)
                    worth[place, owner] = saturated(count, measure[owner])
                    # The least key stands for NULL, which comes last among equals.
                    best.add(block.sums(worth), np.where(ids == NO_ID, np.iinfo(np.int64).max, ids))
            out = best.batch(block.items)
            last = pa.compute.equal(out.column(1), np.iinfo(np.int64).max)
            keys = pa.compute.if_else(last, pa.scalar(NO_ID, pa.int64()), out.column(1))
            yield out.set_column(1, "key", keys)

        return ranked(likely(self.docs, keys).mapInArrow(score, FOUND), top)

    def limits(self, block: ItemBlock, top: int) -> np.ndarray:
        """A score that the last of each item's best documents reaches."""
        least = self.scored(block, self.greatest_bounds(block), top).groupBy("item")
        rows = least.agg(F.min("score").alias("score"), F.count("*").alias("n")).where(F.col("n") == top)
        known = {r["item"]: r["score"] for r in rows.collect()}  # a row per item of the block
        return np.array([known.get(i, 0) for i in block.items.tolist()], dtype=np.int64)

    def answers(self, block: ItemBlock, top: int) -> DataFrame:
        return self.scored(block, self.not_excluded(block, self.limits(block, top)), top)


def rank_documents(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text", top: int = TOP,
) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's highest-scoring documents."""
    spark: SparkSession = docs.sparkSession
    terms = item_terms(items, item_id, item_text)
    signatures = signature_table(docs, doc_id, text, bitmap_of(terms))
    counts = signatures.agg(F.sum("n_docs").alias("n_docs"), F.sum("n_terms").alias("n_terms")).first()
    path = scratch_dir(spark, "ranked-answers")
    spark.createDataFrame([], f"{FOUND}, rank int").write.parquet(path)
    if counts["n_docs"]:
        key = F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("key")
        search = Search(docs.select(key, F.col(text).alias("text")), signatures, counts["n_docs"], counts["n_terms"])
        for block in item_blocks(weighted_items(terms, signatures, counts["n_docs"])):
            search.answers(block, top).select("item", "key", "score", "rank").write.mode("append").parquet(path)
    found = spark.read.schema(f"{FOUND}, rank int").parquet(path)
    named = found.join(terms.select("item", "item_id"), "item")
    return named.select(
        F.col("item_id").alias(item_id), "rank", F.nullif("key", F.lit(NO_ID)).alias(doc_id), "score"
    )


def oracle_sql(top: int = TOP) -> str:
    """DuckDB SQL for the same rows."""
    capital, small = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    term = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    words = f"unnest(regexp_extract_all(translate(text, '{capital}', '{small}'), '{term}'))"
    return f"""
    WITH d AS (SELECT doc_id, {words} AS t FROM documents),
    q AS (SELECT item_id, {words} AS t FROM benchmark),
    n AS (SELECT doc_id, count(*) AS n FROM d GROUP BY 1),
    c AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM n),
    tf AS (SELECT doc_id, t, count(*) AS tf FROM d WHERE t IN (SELECT t FROM q) GROUP BY 1, 2),
    w AS (SELECT t, floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM tf, c GROUP BY 1),
    m AS (SELECT doc_id, 100 - 75 + (75 * n * n_docs) // n_terms AS m FROM n, c),
    s AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
          FROM q JOIN w USING (t) JOIN tf USING (t) JOIN m USING (doc_id) GROUP BY 1, 2)
    SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
    FROM s WHERE score > 0 QUALIFY rank <= {top}
    """
