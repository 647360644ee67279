"""Approximate nearest neighbours by inner product: greedy search in a graph that NN-descent builds.

Equal vectors are one node, which keeps the smallest ids of its rows (as many as an answer can hold, and one
more); equal queries are searched once. A query starts at nodes spread over the part where it lies on the
graph's curve and over some other parts. In a part its search is greedy: it goes on from the nearest nodes it
knows until none of the best ``WIDTH`` is left to go on from; neighbours in other parts are asked for there in
the next round, until no query asks for more. Queries and parts meet by packed messages; a part that many
queries ask is copied to several tasks. Scores are exact inner products in double precision, summed in the
order of the components.

The list of parts, one entry for some thousand vectors, is held by the driver. Queries that find fewer rows
than they ask for, though there are more, are compared with all parts (``rest``), so no answer is short.

Cases: vectors that are NULL, empty, zero, or hold a NULL or non-finite component take no part, nor do rows
with a NULL id or of another length than ``length`` (if not given, the most frequent length, of equally
frequent ones the smallest). Rows with the same id and vector count once; a query leaves out its own row, not
others that are equal. Equal scores go to the smaller id. Empty tables give an empty result. Columns other
than id and vector are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statlake.llm.neighbour_graph import (
    PART_BITS,
    Part,
    build_graph,
    by_part,
    curve_keys,
    number_nodes,
    numbers_of,
    part_of,
    unit_vectors,
)
from statlake.llm.scratch import scratch_table
from statlake.operators.ordered import first_rows_per_key
from statlake.session import remove_path, scratch_dir

NEAREST = 20
WIDTH = 192  # nodes a query keeps and goes on from
STEP = 24  # of them, how many it goes on from at once
ENTRIES, OTHER_PARTS = 48, 2
QUERIES_PER_BLOCK = 64
ASKED_PER_TASK = 100_000
MOST_ROUNDS = 40

ASK, ANSWER, HELD = range(3)
ENTER, GO_ON, ALL = range(3)
MESSAGES = "part long, block long, kind int, n long, a binary, b binary, c binary, d binary, e binary, f binary"
NAMES = ["part", "block", "kind", "n", "a", "b", "c", "d", "e", "f"]


def usable(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(id, vector) of the vectors that take part."""

    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf"))

    c = F.col(embedding)
    whole = c.isNotNull() & F.forall(c, finite) & F.exists(c, lambda x: x != 0)
    return vectors.where(whole & F.col(vec_id).isNotNull()).select(
        F.col(vec_id).cast("long").alias("id"), c.alias("vector")
    )


def usual_length(vectors: DataFrame) -> int:
    """The most frequent length of the vectors, 0 if there are none."""
    counts = vectors.groupBy(F.size("vector").alias("length")).agg(F.count("*").alias("n"))
    row = counts.orderBy(F.desc("n"), "length").first()
    return row["length"] if row else 0


def messages(rows: list[tuple]) -> pa.Table:
    """Rows of (part, block, kind, n, arrays ...) as a table of ``MESSAGES``."""
    out = [pa.array([r[i] for r in rows], t) for i, t in enumerate([pa.int64(), pa.int64(), pa.int32(), pa.int64()])]
    for i in range(4, len(NAMES)):
        raw = [np.ascontiguousarray(r[i]).tobytes() if len(r) > i else None for r in rows]
        out.append(pa.array(raw, pa.binary()))
    return pa.table(out, names=NAMES)


def inner_products(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Of each pair of rows, in double precision, summed from the first component on."""
    if not len(other):
        return np.zeros(0)
    return np.cumsum(one * other, axis=1)[:, -1]


class Found:
    """The best nodes a query knows, and what to ask for next."""

    def __init__(self, numbers: np.ndarray, scores: np.ndarray, width: int):
        order = np.lexsort((numbers, -scores))
        numbers, scores = numbers[order], scores[order]
        _, first = np.unique(numbers, return_index=True)
        first = np.sort(first)[:width]
        self.numbers, self.scores = numbers[first], scores[first]


def search_part(
    part: Part, vectors: np.ndarray, query: np.ndarray, seeds: np.ndarray, known: np.ndarray, floor: float, width: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Greedy search inside a part: (numbers, scores) of the nodes found, how many neighbours each has in
    other parts, and these."""
    seen = np.zeros(len(vectors), dtype=bool)
    seen[known] = True
    place = np.unique(seeds)
    place = place[~seen[place]]
    seen[place] = True
    scores = inner_products(vectors[place], query[None])
    gone_on = np.zeros(len(place), dtype=bool)
    while True:
        if len(place) > width:
            best = np.argpartition(-scores, width - 1)[:width]
            place, scores, gone_on = place[best], scores[best], gone_on[best]
        open_ = np.flatnonzero(~gone_on & (scores >= floor))
        if not len(open_):
            break
        if len(open_) > STEP:
            open_ = open_[np.argpartition(-scores[open_], STEP - 1)[:STEP]]
        gone_on[open_] = True
        near = part.lists[place[open_]].ravel() - part.first
        near = np.unique(near[(near >= 0) & (near < len(vectors))])
        near = near[~seen[near]]
        seen[near] = True
        place = np.concatenate([place, near])
        scores = np.concatenate([scores, inner_products(vectors[near], query[None])])
        gone_on = np.concatenate([gone_on, np.zeros(len(near), dtype=bool)])
    kept = scores >= floor
    place, scores = place[kept], scores[kept]
    lists = part.lists[place]
    away = (lists >= 0) & (lists >> PART_BITS != part.part)
    return place + part.first, scores, away.sum(1), lists[away]


def spread(count: int, wanted: int, turn: int) -> np.ndarray:
    """Some places of a part, evenly spread."""
    steps = np.arange(min(count, wanted))
    return (steps * count // max(1, len(steps)) + turn) % count


def scores_in_part(length: int, kind: str, width: int):
    """Answers of a part to the blocks of queries that ask it."""

    def step(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        held = next(r for r in rows if r["kind"] == HELD)
        part = Part.read({"part": held["part"], "a": held["a"], "b": held["b"], "c": held["c"]}, length + 1, kind)
        vectors = part.vectors[:, :length].astype(np.float64)
        out = []
        for r in rows:
            if r["kind"] != ASK:
                continue
            who, mode = numbers_of(r["a"], "<i4").reshape(-1, 2).T
            queries = numbers_of(r["b"], "<f8").reshape(-1, length)
            floors = numbers_of(r["c"], "<f8")
            ends = numbers_of(r["d"], "<i4").reshape(-1, 2)
            numbers = numbers_of(r["e"], "<i8") - part.first
            at, found = 0, []
            for q, how, query, floor, (n_seeds, n_known) in zip(who, mode, queries, floors, ends, strict=True):
                seeds, known = numbers[at : at + n_seeds], numbers[at + n_seeds : at + n_seeds + n_known]
                at += n_seeds + n_known
                if how == ALL:
                    scores = np.concatenate([
                        inner_products(vectors[a : a + 2048], query[None]) for a in range(0, len(vectors), 2048)
                    ])
                    best = Found(np.arange(len(vectors)) + part.first, scores, width)
                    found.append((q, best.numbers, best.scores, np.zeros(len(best.numbers)), best.numbers[:0]))
                    continue
                if how == ENTER:
                    seeds = spread(len(vectors), ENTRIES, int(q))
                found.append((q, *search_part(part, vectors, query, seeds, known, floor, width)))
            found = [f for f in found if len(f[1])]
            if found:
                out.append(
                    (
                        held["part"], r["block"], ANSWER, len(found),
                        np.array([[f[0], len(f[1]), len(f[4])] for f in found], "<i4"),
                        np.concatenate([f[1] for f in found]).astype("<i8"),
                        np.concatenate([f[2] for f in found]).astype("<f8"),
                        np.concatenate([f[3] for f in found]).astype("<i4"),
                        np.concatenate([f[4] for f in found]).astype("<i8"),
                    )
                )
        return messages(out)

    return step


class Block:
    """Some queries: ids, vectors, the best they know, and all nodes they have asked for. Named by its first id."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, best: list[Found], asked: list[np.ndarray]):
        self.ids, self.vectors, self.best, self.asked = ids, vectors, best, asked
        self.block = int(ids[0])

    @classmethod
    def new(cls, ids: np.ndarray, vectors: np.ndarray, width: int) -> Block:
        none = np.zeros(0, np.int64)
        return cls(ids, vectors, [Found(none, none.astype(float), width) for _ in ids], [none] * len(ids))

    @classmethod
    def read(cls, row: dict, length: int) -> Block:
        vectors = numbers_of(row["a"], "<f8").reshape(-1, length)
        sizes = numbers_of(row["b"], "<i4").reshape(-1, 2)
        numbers, scores, asked = numbers_of(row["c"], "<i8"), numbers_of(row["d"], "<f8"), numbers_of(row["e"], "<i8")
        cuts, ends = np.cumsum(sizes[:-1, 0]), np.cumsum(sizes[:-1, 1])
        best = []
        for n, s in zip(np.split(numbers, cuts), np.split(scores, cuts), strict=True):
            one = Found.__new__(Found)
            one.numbers, one.scores = n, s
            best.append(one)
        return cls(numbers_of(row["f"], "<i8"), vectors, best, np.split(asked, ends))

    def row(self) -> tuple:
        return (
            -1, self.block, HELD, len(self.vectors), self.vectors.astype("<f8"),
            np.array([[len(b.numbers), len(a)] for b, a in zip(self.best, self.asked, strict=True)], "<i4"),
            np.concatenate([b.numbers for b in self.best]).astype("<i8"),
            np.concatenate([b.scores for b in self.best]).astype("<f8"),
            np.concatenate(self.asked).astype("<i8"), self.ids.astype("<i8"),
        )

    def ask(self, part: int, wanted: list[tuple[int, int, np.ndarray]], width: int) -> tuple:
        """A message to a part: (query, how, seeds) with what it knows there and the least score of use."""
        seeds, floors = [], []
        for q, _, own in wanted:
            best = self.best[q]
            here = best.numbers[best.numbers >> PART_BITS == part]
            seeds.append((own, here))
            floors.append(best.scores.min() if len(best.numbers) >= width else -np.inf)
        who = [q for q, _, _ in wanted]
        return (
            part, self.block, ASK, len(wanted), np.array([[q, how] for q, how, _ in wanted], "<i4"),
            self.vectors[who].astype("<f8"), np.array(floors, "<f8"),
            np.array([[len(s), len(k)] for s, k in seeds], "<i4"),
            np.concatenate([x for pair in seeds for x in pair]).astype("<i8"),
        )


def next_questions(length: int, width: int):
    """Merges the answers to a block of queries and asks for what they have named."""

    def step(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        block = Block.read(next(r for r in rows if r["kind"] == HELD), length)
        size = len(block.vectors)
        answers: list[list] = [[] for _ in range(size)]
        for r in rows:
            if r["kind"] != ANSWER:
                continue
            n, s = numbers_of(r["b"], "<i8"), numbers_of(r["c"], "<f8")
            counts, away = numbers_of(r["d"], "<i4"), numbers_of(r["e"], "<i8")
            at = to = 0
            for q, found, named in numbers_of(r["a"], "<i4").reshape(-1, 3):
                here = slice(at, at + found)
                answers[q].append((n[here], s[here], counts[here], away[to : to + named]))
                at, to = at + found, to + named
        wanted: dict[int, list] = {}
        for q in range(size):
            if not answers[q]:
                continue
            numbers, scores, counts, away = (np.concatenate(x) for x in zip(*answers[q], strict=True))
            best = block.best[q]
            best = Found(np.concatenate([best.numbers, numbers]), np.concatenate([best.scores, scores]), width)
            block.best[q] = best
            # It goes on from nodes that are still among the best when all parts have answered.
            away = away[np.repeat(np.isin(numbers, best.numbers), counts)]
            fresh = np.setdiff1d(away, np.union1d(block.asked[q], best.numbers))
            block.asked[q] = np.union1d(block.asked[q], fresh)
            for part, group in by_part(fresh):
                wanted.setdefault(part, []).append((q, GO_ON, fresh[group]))
        return messages([block.row(), *(block.ask(p, w, width) for p, w in sorted(wanted.items()))])

    return step


def first_questions(queries: DataFrame, length: int, norm: float, parts: list[tuple[int, bytes]], width: int) -> DataFrame:
    """Blocks of the queries (rows of query, vector) and where they enter the graph."""
    numbers, keys = [p for p, _ in parts], [k for _, k in parts]

    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), QUERIES_PER_BLOCK):
                rows = batch.slice(at, QUERIES_PER_BLOCK)
                ids = rows.column(0).to_numpy(zero_copy_only=False)
                x = rows.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, length).astype(np.float64)
                unit = query_units(x)
                block, none = Block.new(ids, x, width), np.zeros(0, np.int64)
                wanted: dict[int, list] = {}
                places = np.searchsorted(np.array(keys, object), [k.tobytes() for k in curve_keys(unit, 0)], side="right")
                for q, place in enumerate(places.tolist()):
                    home = max(0, place - 1)
                    step = 1 + (int(ids[q]) * 7919) % max(1, len(parts) - 1)
                    for p in {(home + i * step) % len(parts) for i in range(OTHER_PARTS + 1)}:
                        wanted.setdefault(numbers[p], []).append((q, ENTER, none))
                yield from messages([block.row(), *(block.ask(p, w, width) for p, w in wanted.items())]).to_batches()

    return queries.select("query", "vector").mapInArrow(enter, MESSAGES)


def query_units(x: np.ndarray) -> np.ndarray:
    """Queries at norm one, with nothing in the further component."""
    scaled = x / np.abs(x).max(1, keepdims=True)
    return np.c_[scaled / np.sqrt((scaled * scaled).sum(1, keepdims=True)), np.zeros(len(x))]


def one_round(rows: DataFrame, graph: DataFrame, length: int, kind: str, width: int) -> DataFrame:
    """Asked parts answer, and blocks of queries ask on."""
    asks = rows.where(F.col("kind") == ASK)
    sized = asks.groupBy("part").agg(F.ceil(F.sum("n") / ASKED_PER_TASK).cast("int").alias("salts"))
    copies = F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt")
    none = F.lit(None).cast("binary")
    held = graph.join(sized, "part").select(
        "part", F.lit(-1).cast("long").alias("block"), F.lit(HELD).alias("kind"), F.lit(0).cast("long").alias("n"),
        "a", "b", "c", none.alias("d"), none.alias("e"), none.alias("f"), copies,
    )
    salted = asks.join(sized, "part").select(
        *NAMES, F.pmod(F.xxhash64("block"), F.col("salts")).cast("int").alias("salt")
    )
    together = held.unionByName(salted)
    answers = together.groupBy("part", "salt").applyInArrow(lambda t: scores_in_part(length, kind, width)(t.drop_columns("salt")), MESSAGES)
    blocks = answers.unionByName(rows.where(F.col("kind") == HELD))
    return blocks.groupBy("block").applyInArrow(next_questions(length, width), MESSAGES)


def search_graph(
    queries: DataFrame, graph: DataFrame, parts: list[tuple[int, bytes]], length: int, kind: str, norm: float, width: int
) -> DataFrame:
    """(query, number, score): the best nodes of each query (rows of query, vector)."""
    spark = queries.sparkSession
    state, path = first_questions(queries, length, norm, parts, width), None
    for turn in range(MOST_ROUNDS):
        now = scratch_dir(spark, f"search-round-{turn}")
        state.write.parquet(now)
        if path is not None:
            remove_path(spark, path)
        path, rows = now, spark.read.schema(MESSAGES).parquet(now)
        if rows.where(F.col("kind") == ASK).isEmpty():
            break
        state = one_round(rows, graph, length, kind, width)
    return found_nodes(spark.read.schema(MESSAGES).parquet(path).where(F.col("kind") == HELD), queries, length)


def found_nodes(blocks: DataFrame, queries: DataFrame, length: int) -> DataFrame:
    """The rows that blocks hold, by query."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = Block.read(row, length)
                who = np.repeat(block.ids, [len(b.numbers) for b in block.best])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(who),
                        pa.array(np.concatenate([b.numbers for b in block.best])),
                        pa.array(np.concatenate([b.scores for b in block.best])),
                    ],
                    ["query", "number", "score"],
                )

    return blocks.mapInArrow(unpack, "query long, number long, score double")


class NeighbourIndex:
    """All vectors of a table: nodes with the ids of their rows, and the graph of the nodes."""

    def __init__(self, vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", length: int | None = None, nearest: int = NEAREST):
        given = usable(vectors, vec_id, embedding)
        self.nearest = nearest
        self.length = length or usual_length(given)
        self.kind = "<f4" if given.schema["vector"].dataType.elementType.simpleString() == "float" else "<f8"
        given = given.where(F.size("vector") == self.length).distinct()
        ids = first_rows_per_key(given, ["vector"], ["id"], nearest + 1)
        nodes = ids.groupBy("vector").agg(F.sort_array(F.collect_list("id")).alias("members"))
        square = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
        nodes = scratch_table(nodes, "graph-vectors")
        counts = nodes.agg(F.count("*").alias("n"), F.sqrt(F.max(square)).alias("norm"), F.sum(F.size("members")).alias("rows")).first()
        self.count, self.norm, self.rows = counts["n"], counts["norm"], counts["rows"]
        if not self.count:
            return
        numbered = number_nodes(nodes, self.length, self.norm, self.count)
        self.nodes = numbered.select("number", "vector", "members")
        first = numbered.groupBy(part_of("number").alias("part")).agg(F.min("key").alias("key"))
        self.parts = sorted(((r["part"], bytes(r["key"])) for r in first.collect()), key=lambda p: (p[1], p[0]))
        self.graph = build_graph(numbered, self.length, self.kind, self.norm, self.count)

    def rest(self, short: DataFrame, width: int) -> DataFrame:
        """Queries against all parts, exactly."""
        numbers, length = [p for p, _ in self.parts], self.length

        def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, len(batch)):
                    rows = batch.slice(at, 1)
                    x = rows.column(1).flatten().to_numpy(zero_copy_only=False).reshape(1, length).astype(np.float64)
                    block, none = Block.new(rows.column(0).to_numpy(), x, width), np.zeros(0, np.int64)
                    asks = [block.ask(p, [(0, ALL, none)], width) for p in numbers]
                    yield from messages([block.row(), *asks]).to_batches()

        rows = scratch_table(short.select("query", "vector").mapInArrow(ask, MESSAGES), "search-rest")
        done = one_round(rows, self.graph, length, self.kind, width).where(F.col("kind") == HELD)
        return found_nodes(done, short, length)

    def search(self, queries: DataFrame, query_id: str = "vec_id", embedding: str = "embedding", nearest: int | None = None, width: int = WIDTH) -> DataFrame:
        """(query_id, rank, vec_id, score): the nearest rows found for each query, its own row left out."""
        nearest = nearest or self.nearest
        if nearest > self.nearest:
            raise ValueError("the index keeps the rows for fewer neighbours")
        width = max(width, 2 * nearest)
        spark = queries.sparkSession
        asked = usable(queries, query_id, embedding).where(F.size("vector") == self.length).distinct()
        if not self.count or asked.isEmpty():
            return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
        distinct = scratch_table(asked.select("vector").distinct(), "search-vectors")
        numbered = scratch_table(distinct.select(F.monotonically_increasing_id().alias("query"), "vector"), "search-queries")
        found = scratch_table(
            search_graph(numbered, self.graph, self.parts, self.length, self.kind, self.norm, width), "search-found"
        )
        answers = self.answers(found, numbered, nearest)
        wanted = min(nearest + 1, self.rows)
        short = numbered.join(answers.where(F.size("best") >= wanted), "query", "left_anti")
        if not short.isEmpty():
            again = self.answers(scratch_table(self.rest(short, width), "search-again"), numbered, nearest)
            answers = answers.join(short, "query", "left_anti").unionByName(again)
        own = asked.join(numbered, "vector").join(answers, "query")
        other = F.filter("best", lambda b: ~(b["own"] & (b["id"] == F.col("id"))))
        ranked = own.select(F.col("id").alias("query_id"), F.posexplode(F.slice(other, 1, nearest)).alias("place", "one"))
        return ranked.select(
            "query_id", (F.col("place") + 1).alias("rank"), F.col("one.id").alias("vec_id"), F.col("one.score").alias("score")
        )

    def answers(self, found: DataFrame, queries: DataFrame, nearest: int) -> DataFrame:
        """(query, best): of each query the nearest rows, one more than asked for, in order."""
        own = queries.join(self.nodes.select("vector", F.col("number").alias("own")), "vector", "left").select("query", "own")
        # A node has at least one row, so nodes behind the first ones cannot be in the answer.
        order = Window.partitionBy("query").orderBy(F.desc("score"), "number")
        near = found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= 2 * nearest + 1)
        rows = near.join(self.nodes.select("number", "members"), "number").join(own, "query")
        is_own = F.coalesce(F.col("number") == F.col("own"), F.lit(False)).alias("own")
        rows = rows.select("query", "score", is_own, F.explode("members").alias("id"))
        order = Window.partitionBy("query").orderBy(F.desc("score"), "id")
        best = rows.withColumn("place", F.row_number().over(order)).where(F.col("place") <= nearest + 1)
        one = F.struct("place", "id", "score", "own")
        return best.groupBy("query").agg(F.array_sort(F.collect_list(one)).alias("best"))
