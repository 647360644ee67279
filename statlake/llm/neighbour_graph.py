"""A graph of nearest neighbours, built by NN-descent: neighbours of neighbours are compared until little changes.

Nodes are different vectors, in parts of some thousand that lie near each other on a Hilbert curve, so that
most neighbours share a part. A part is one row (numbers follow from its place); parts exchange packed
messages, and a round is three groupings by part:

* a part gets the edges that lead into it, adds their ends to its own lists (a neighbour's neighbour may be
  near the other way round), and sends its nodes to the parts of the nodes they are joined with;
* each node compares all that came to it, which are neighbours of neighbours of each other, and proposes
  pairs that are nearer than the farthest neighbour so far;
* a part merges the proposals into its lists.

Nearness is the cosine after one component is added that brings all vectors to the greatest norm, so that
neighbours by angle are neighbours by inner product. The lists begin with what lies close on some Hilbert
curves of random projections. A node that more than ``MEETING`` nodes are joined with compares the nearest of
them; this bounds the work and is part of the approximation, which recall measures.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statlake.llm.hilbert import cell_numbers, hilbert_keys
from statlake.llm.scratch import scratch_table
from statlake.session import remove_path, scratch_dir

DEGREE = 24  # neighbours of a node
PART_BITS = 12  # a part has 2^12 nodes: the low bits of a node's number are its place
PART_NODES = 1 << PART_BITS
MEETING = 2 * DEGREE
CENTRES_AT_ONCE = 128
CURVES, CURVE_SIZE, CURVE_BITS = 3, 8, 8
MOST_ROUNDS = 10
LITTLE = 0.03  # of all list places: fewer changes end the building

NODES, EDGES, SENT, PROPOSED = range(4)
PARTS = "part long, kind int, changed long, a binary, b binary, c binary, d binary, e binary"
FIELDS = ["a", "b", "c", "d", "e"]


def packed_rows(rows: list[tuple]) -> pa.Table:
    """Rows of (part, kind, changed, arrays ...) as a table of ``PARTS``."""
    columns = {"part": [r[0] for r in rows], "kind": [r[1] for r in rows], "changed": [r[2] for r in rows]}
    arrays = [pa.array(columns["part"], pa.int64()), pa.array(columns["kind"], pa.int32()), pa.array(columns["changed"], pa.int64())]
    for i in range(len(FIELDS)):
        raw = [np.ascontiguousarray(r[3 + i]).tobytes() if len(r) > 3 + i else None for r in rows]
        arrays.append(pa.array(raw, pa.binary()))
    return pa.table(arrays, names=["part", "kind", "changed", *FIELDS])


def numbers_of(raw: bytes | None, kind: str) -> np.ndarray:
    return np.frombuffer(raw or b"", kind)


class Part:
    """The nodes of a part: vectors, and the numbers and nearness of their neighbours, nearest first."""

    def __init__(self, part: int, vectors: np.ndarray, lists: np.ndarray, near: np.ndarray):
        self.part, self.vectors, self.lists, self.near = part, vectors, lists, near
        self.first = part << PART_BITS

    @classmethod
    def read(cls, row: dict, width: int, kind: str) -> Part:
        vectors = numbers_of(row["a"], kind).reshape(-1, width)
        lists = numbers_of(row["b"], "<i8").reshape(len(vectors), -1)
        return cls(row["part"], vectors, lists, numbers_of(row["c"], "<f4").reshape(len(vectors), -1))

    def row(self, changed: int) -> tuple:
        return self.part, NODES, changed, self.vectors, self.lists.astype("<i8"), self.near.astype("<f4")

    def add(self, place: np.ndarray, number: np.ndarray, near: np.ndarray, degree: int) -> int:
        """Merge candidates into the lists; how many places changed."""
        owners, columns = np.nonzero(self.lists >= 0)
        own = np.concatenate([owners, place])
        numbers = np.concatenate([self.lists[owners, columns], number])
        nears = np.concatenate([self.near[owners, columns], near.astype(np.float32)])
        fresh = np.arange(len(own)) >= len(owners)
        other = numbers != own + self.first
        own, numbers, nears, fresh = own[other], numbers[other], nears[other], fresh[other]
        order = np.lexsort((fresh, numbers, own))
        own, numbers, nears, fresh = own[order], numbers[order], nears[order], fresh[order]
        once = np.r_[True, (own[1:] != own[:-1]) | (numbers[1:] != numbers[:-1])][: len(own)]
        own, numbers, nears, fresh = own[once], numbers[once], nears[once], fresh[once]
        order = np.lexsort((numbers, -nears, own))
        own, numbers, nears, fresh = own[order], numbers[order], nears[order], fresh[order]
        rank = np.arange(len(own)) - np.searchsorted(own, own)
        kept = rank < degree
        self.lists = np.full((len(self.vectors), degree), -1, dtype=np.int64)
        self.near = np.full((len(self.vectors), degree), -np.inf, dtype=np.float32)
        self.lists[own[kept], rank[kept]] = numbers[kept]
        self.near[own[kept], rank[kept]] = nears[kept]
        return int(fresh[kept].sum())


def by_part(numbers: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(part, indices) of node numbers."""
    parts = numbers >> PART_BITS
    order = np.argsort(parts, kind="stable")
    cuts = np.flatnonzero(np.diff(parts[order])) + 1
    for group in np.split(order, cuts):
        if len(group):
            yield int(parts[group[0]]), group


def edge_rows(part: Part) -> list[tuple]:
    """For each other part the edges that lead there; of those to one node the nearest."""
    place, column = np.nonzero(part.lists >= 0)
    to, near = part.lists[place, column], part.near[place, column]
    order = np.lexsort((-near, to))
    place, to, near = place[order], to[order], near[order]
    few = np.arange(len(to)) - np.searchsorted(to, to) < MEETING
    place, to, near = place[few], to[few], near[few]
    return [
        (p, EDGES, 0, place[g] + part.first, to[g], near[g].astype("<f4")) for p, g in by_part(to)
    ]


def own_part(rows: list[dict], width: int, kind: str) -> Part:
    return next(Part.read(r, width, kind) for r in rows if r["kind"] == NODES)


def joined_edges(rows: list[dict], kind: int) -> list[np.ndarray]:
    """The numbers of all rows of a kind, one behind the other."""
    kinds = ["<i8", "<i8", "<f4"]
    found = [r for r in rows if r["kind"] == kind]
    return [np.concatenate([numbers_of(r[f], k) for r in found] or [np.zeros(0, k)]) for f, k in zip("abc", kinds, strict=True)]


def send_nodes(width: int, kind: str, degree: int):
    def step(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        part = own_part(rows, width, kind)
        origin, to, near = joined_edges(rows, EDGES)
        changed = part.add(to - part.first, origin, near, degree)
        # A node goes to those in its list, and to those that have it in theirs.
        place, column = np.nonzero(part.lists >= 0)
        to_place = np.concatenate([place, to - part.first])
        goal = np.concatenate([part.lists[place, column], origin])
        nearness = np.concatenate([part.near[place, column], near])
        order = np.lexsort((-nearness, goal))
        few = order[np.arange(len(order)) - np.searchsorted(goal[order], goal[order]) < MEETING]
        to_place, goal = to_place[few], goal[few]
        pairs = np.unique(np.stack([to_place, goal], axis=1), axis=0)
        out = [part.row(changed)]
        for p, group in by_part(pairs[:, 1]):
            nodes, index = np.unique(pairs[group, 0], return_inverse=True)
            sent = np.stack([index, pairs[group, 1]], axis=1).astype("<i8")
            farthest = part.near[nodes, -1].astype("<f4")
            out.append((p, SENT, 0, nodes + part.first, part.vectors[nodes], farthest, part.lists[nodes], sent))
        return packed_rows(out)

    return step


def nearest_new(
    found: list[tuple[np.ndarray, ...]], lists: np.ndarray, number: np.ndarray, degree: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of pairs (one, other, nearness), those not in the first's list, each once, the nearest of each first."""
    one, other, near = (np.concatenate(f) for f in zip(*found, strict=True))
    _, first = np.unique(one * len(number) + other, return_index=True)
    one, other, near = one[first], other[first], near[first]
    known = one == other
    for a in range(0, len(one), 1 << 14):
        some = slice(a, a + (1 << 14))
        known[some] |= (lists[one[some]] == number[other[some]][:, None]).any(1)
    one, other, near = one[~known], other[~known], near[~known]
    order = np.lexsort((-near, one))
    one, other, near = one[order], other[order], near[order]
    few = np.arange(len(one)) - np.searchsorted(one, one) < degree
    return one[few], other[few], near[few]


def compare_nodes(width: int, kind: str, degree: int, norm: float):
    def step(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        part = own_part(rows, width, kind)
        sent = [r for r in rows if r["kind"] == SENT]
        out = [part.row(next(r["changed"] for r in rows if r["kind"] == NODES))]
        if not sent:
            return packed_rows(out)
        number = np.concatenate([numbers_of(r["a"], "<i8") for r in sent])
        x = np.concatenate([numbers_of(r["b"], kind).reshape(-1, width) for r in sent])
        x = (x / norm).astype(np.float32)
        farthest = np.concatenate([numbers_of(r["c"], "<f4") for r in sent])
        lists = np.concatenate([numbers_of(r["d"], "<i8").reshape(-1, degree) for r in sent])
        starts = np.cumsum([0] + [len(r["a"]) // 8 for r in sent])
        pairs = [numbers_of(r["e"], "<i8").reshape(-1, 2) for r in sent]
        who = np.concatenate([p[:, 0] + s for p, s in zip(pairs, starts, strict=False)])
        at = np.concatenate([p[:, 1] for p in pairs]) - part.first
        order = np.argsort(at, kind="stable")
        who, at = who[order], at[order]
        centre = (part.vectors / norm).astype(np.float32)
        best = (who[:0], who[:0], farthest[:0])
        least = farthest.copy()
        groups = np.split(np.arange(len(at)), np.flatnonzero(np.diff(at)) + 1)
        for start in range(0, len(groups), CENTRES_AT_ONCE):
            found = [best]
            for group in groups[start : start + CENTRES_AT_ONCE]:
                own = who[group]
                if len(own) > MEETING:
                    near = x[own] @ centre[at[group[0]]]
                    own = own[np.argpartition(-near, MEETING)[:MEETING]]
                near = x[own] @ x[own].T
                i, j = np.nonzero(near > least[own][:, None])
                found.append((own[i], own[j], near[i, j]))
            best = nearest_new(found, lists, number, degree)
            full = np.flatnonzero(np.bincount(best[0], minlength=len(number)) == degree)
            ends = np.searchsorted(best[0], full, side="right") - 1
            least[full] = np.maximum(least[full], best[2][ends])
        one, other, near = best
        one, other, near = number[one], number[other], near.astype("<f4")
        out += [(p, PROPOSED, 0, one[g], other[g], near[g]) for p, g in by_part(one)]
        return packed_rows(out)

    return step


def merge_nodes(width: int, kind: str, degree: int):
    def step(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        part = own_part(rows, width, kind)
        own, number, near = joined_edges(rows, PROPOSED)
        changed = part.add(own - part.first, number, near, degree)
        before = next(r["changed"] for r in rows if r["kind"] == NODES)
        return packed_rows([part.row(changed + before), *edge_rows(part)])

    return step


def projections(width: int, curve: int) -> np.ndarray:
    """Random directions of a curve, the same in every task."""
    made = np.random.default_rng([11, curve]).standard_normal((width, CURVE_SIZE))
    return (made / np.sqrt((made * made).sum(0))).astype(np.float64)


def curve_keys(unit: np.ndarray, curve: int) -> np.ndarray:
    """Places of vectors of norm one on a curve; most projections lie within some spreads of zero."""
    width = unit.shape[1]
    reach = 3.0 / np.sqrt(width)
    cells = cell_numbers(unit @ projections(width, curve), -reach, reach, CURVE_BITS)
    return hilbert_keys(cells, CURVE_BITS)


def unit_vectors(vectors: np.ndarray, norm: float) -> np.ndarray:
    """Vectors brought to norm one by a further component."""
    x = vectors.astype(np.float64) / norm
    rest = np.sqrt(np.maximum(1 - (x * x).sum(1), 0))
    return np.c_[x, rest]


def number_nodes(vectors: DataFrame, length: int, norm: float, count: int) -> DataFrame:
    """(number, key, vector, members) for rows of (vector, members): numbered along the first curve, no number
    left out, so parts are full whatever the number of tasks."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, length)
                keys = [k.tobytes() for k in curve_keys(unit_vectors(x, norm), 0)]
                yield batch.append_column("key", pa.array(keys, pa.binary()))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            tasks = pa.array([task] * len(batch), pa.int32())
            yield batch.append_column("task", tasks).append_column("place", pa.array(np.arange(at, at + len(batch))))
            at += len(batch)

    shape = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in vectors.schema)
    along = vectors.mapInArrow(keyed, f"{shape}, key binary")
    dealt = along.repartitionByRange(max(1, -(-count // PART_NODES)), "key", F.element_at("members", 1))
    ordered = dealt.sortWithinPartitions("key", F.element_at("members", 1), "vector")
    placed = scratch_table(ordered.mapInArrow(number, f"{shape}, key binary, task int, place long"), "graph-numbers")
    first, at = [], 0
    for row in placed.groupBy("task").count().orderBy("task").collect():  # a row per task
        first.append((row["task"], at))
        at += row["count"]
    starts = vectors.sparkSession.createDataFrame(first, "task int, first long")
    numbered = placed.join(starts, "task").withColumn("number", F.col("first") + F.col("place"))
    return numbered.drop("task", "place", "first")


def part_of(number: Column | str) -> Column:
    return F.shiftright(number, PART_BITS)


def empty_parts(nodes: DataFrame, length: int, kind: str, norm: float) -> DataFrame:
    """A row for each part with its vectors and no neighbours."""
    rows = nodes.select(part_of("number").alias("part"), "number", "vector")

    def pack(table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("number").to_numpy())
        x = table.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, length)[order]
        width = np.c_[x, unit_vectors(x, norm)[:, -1] * norm].astype(kind)
        part = table.column("part")[0].as_py()
        none = np.zeros((len(x), 0))
        return packed_rows([Part(part, width, none, none).row(0)])

    return rows.groupBy("part").applyInArrow(pack, PARTS)


def close_on_curves(nodes: DataFrame, length: int, norm: float, count: int, degree: int) -> DataFrame:
    """Proposals of nodes that lie close on some curve."""
    reach = max(1, degree // (2 * CURVES))

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, length)
            unit = unit_vectors(x, norm)
            raw = pa.array([v.tobytes() for v in unit.astype("<f4")], pa.binary())
            for curve in range(CURVES):
                keys = pa.array([k.tobytes() for k in curve_keys(unit, curve)], pa.binary())
                which = pa.array([curve] * len(batch), pa.int32())
                yield pa.RecordBatch.from_arrays([which, keys, batch.column(0), raw], ["curve", "key", "number", "unit"])

    def propose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail = None
        for batch in batches:
            parts = [tail, batch] if tail is not None else [batch]
            rows = pa.Table.from_batches(parts).combine_chunks()
            curve, number = rows.column("curve").to_numpy(), rows.column("number").to_numpy()
            unit = np.frombuffer(b"".join(rows.column("unit").to_pylist()), "<f4").reshape(-1, length + 1)
            ones, others, nears = [], [], []
            for step in range(1, reach + 1):
                a, b = np.arange(len(number) - step), np.arange(step, len(number))
                # Pairs within the rows carried over were proposed before.
                same = (curve[a] == curve[b]) & (b >= (len(tail) if tail is not None else 0))
                a, b = a[same], b[same]
                near = np.einsum("ij,ij->i", unit[a], unit[b])
                ones += [number[a], number[b]]
                others += [number[b], number[a]]
                nears += [near, near]
            one, other, near = (np.concatenate(x) for x in (ones, others, nears))
            out = [(p, PROPOSED, 0, one[g], other[g], near[g].astype("<f4")) for p, g in by_part(one)]
            tail = rows.slice(max(0, rows.num_rows - reach)).to_batches()[0]
            yield from packed_rows(out).to_batches()

    rows = nodes.select("number", "vector").mapInArrow(keyed, "curve int, key binary, number long, unit binary")
    dealt = rows.repartitionByRange(max(1, -(-count * CURVES // PART_NODES)), "curve", "key", "number")
    return dealt.sortWithinPartitions("curve", "key", "number").mapInArrow(propose, PARTS)


def build_graph(nodes: DataFrame, length: int, kind: str, norm: float, count: int, degree: int = DEGREE) -> DataFrame:
    """The parts with their lists, written below the shared folder; each round replaces the one before."""
    spark, width = nodes.sparkSession, length + 1

    def grouped(rows: DataFrame, step) -> DataFrame:
        return rows.groupBy("part").applyInArrow(step, PARTS)

    state = empty_parts(nodes, length, kind, norm).unionByName(close_on_curves(nodes, length, norm, count, degree))
    state = grouped(state, merge_nodes(width, kind, degree))
    path = None
    for turn in range(MOST_ROUNDS + 1):
        now = scratch_dir(spark, f"graph-round-{turn}")
        state.write.parquet(now)
        if path is not None:
            remove_path(spark, path)
        path, rows = now, spark.read.schema(PARTS).parquet(now)
        changed = rows.where(F.col("kind") == NODES).agg(F.sum("changed")).first()[0] or 0
        if turn and changed <= LITTLE * count * degree:
            break
        fresh = rows.withColumn("changed", F.lit(0).cast("long"))
        sent = grouped(fresh, send_nodes(width, kind, degree))
        compared = grouped(sent, compare_nodes(width, kind, degree, norm))
        state = grouped(compared, merge_nodes(width, kind, degree))
    return spark.read.schema(PARTS).parquet(path).where(F.col("kind") == NODES)
