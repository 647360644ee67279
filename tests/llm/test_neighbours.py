import math

import numpy as np
import pytest

from statlake.llm import neighbour_graph
from statlake.llm.neighbour_graph import PART_BITS, Part
from statlake.llm.neighbours import NeighbourIndex, search_part

SCHEMA = "vec_id long, embedding array<double>"


def usable(rows, length):
    out = []
    for i, v in rows:
        if i is None or v is None or len(v) != length or not all(x is not None and math.isfinite(x) for x in v):
            continue
        if any(v) and (i, tuple(v)) not in out:
            out.append((i, tuple(v)))
    return out


def brute(rows, asked, length, nearest):
    rows, out = usable(rows, length), {}
    for q, v in usable(asked, length):
        scores = sorted((-sum(np.cumsum(np.multiply(v, w))[-1:]), i) for i, w in rows if (i, w) != (q, v))
        out[q, v] = [(k + 1, i, -s) for k, (s, i) in enumerate(scores[:nearest])]
    return sorted((q, *r) for (q, _), found in out.items() for r in found)


def run(spark, rows, asked, length=None, nearest=20):
    frame = lambda r: spark.createDataFrame(r, SCHEMA).repartition(3)
    made = NeighbourIndex(frame(rows), length=length, nearest=nearest).search(frame(asked))
    assert made.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(tuple(r) for r in made.collect())


def recall(got, true):
    return len({(q, i) for q, _, i, _ in got} & {(q, i) for q, _, i, _ in true}) / len(true)


@pytest.mark.parametrize("grown", [False, True])
def test_recall(spark, grown):
    rng = np.random.default_rng(5)
    x = rng.standard_normal((700, 12)) + 2 * rng.standard_normal((7, 12))[rng.integers(0, 7, 700)]
    if grown:  # norms differ, so the nearest by angle are not the nearest by inner product
        x *= rng.uniform(0.2, 3, (700, 1))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    asked = rows[::20]
    true, got = brute(rows, asked, 12, 20), run(spark, rows, asked)
    assert [(q, k) for q, k, _, _ in got] == [(q, k) for q, k, _, _ in true]
    assert recall(got, true) >= 0.95
    scores = {(q, i): s for q, _, i, s in brute(rows, asked, 12, 700)}
    assert all(scores[q, i] == s for q, _, i, s in got)


def test_recall_over_several_parts(spark):
    """Vectors without groups, the worst case, in more nodes than one part has."""
    x = np.random.default_rng(8).standard_normal((9000, 8))
    x /= np.sqrt((x * x).sum(1, keepdims=True))
    given = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], SCHEMA)
    index = NeighbourIndex(given)
    assert len(index.parts) == -(-9000 // neighbour_graph.PART_NODES) == 3
    got = index.search(given.where("vec_id % 450 = 0")).collect()
    asked = range(0, 9000, 450)
    true = {q: set(np.argsort(-(x[q] @ x.T))[1:21].tolist()) for q in asked}
    assert len(got) == 20 * len(asked)
    assert sum(r["vec_id"] in true[r["query_id"]] for r in got) / len(got) >= 0.95


def test_copies_ties_and_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rng = np.random.default_rng(1)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.standard_normal((60, 4)))]
    rows += [(100 + i, rows[3][1]) for i in range(40)]  # a third have one vector
    rows += [rows[7], rows[7], (7, [0.5, 0.5, 0.5, 0.5]), (200, [0.0] * 4), (201, None), (202, []), (203, [1.0, None, 1.0, 1.0])]
    rows += [(204, [nan, 1.0, 1.0, 1.0]), (205, [inf, 1.0, 1.0, 1.0]), (206, [1.0, 2.0]), (None, [1.0] * 4), (207, [-inf, 0.0, 0.0, 0.0])]
    asked = [r for r in rows if r[0] is None or r[0] % 5 == 0 or r[0] == 7]
    for nearest in (1, 5, 20):
        assert run(spark, rows, asked, nearest=nearest) == brute(rows, asked, 4, nearest)


def test_empty_and_small_tables(spark):
    one = [(1, [1.0, 2.0])]
    assert run(spark, [], []) == []
    assert run(spark, [], one) == []
    assert run(spark, one, []) == []
    assert run(spark, one, one) == []
    two = [*one, (2, [0.5, 0.0])]
    assert run(spark, two, two) == [(1, 1, 2, 0.5), (2, 1, 1, 0.5)]
    assert run(spark, two, [(9, [2.0, 0.0])]) == [(9, 1, 1, 2.0), (9, 2, 2, 1.0)]


def test_far_apart_groups_still_give_whole_answers(spark):
    """Groups smaller than an answer: what the graph does not reach is found by the exact way."""
    rng = np.random.default_rng(2)
    centres = np.eye(10) * 50
    rows = [(i, (centres[i % 10] + rng.standard_normal(10) * 0.01).tolist()) for i in range(60)]
    got = run(spark, rows, rows[::20])
    assert [(q, k) for q, k, _, _ in got] == [(q, k) for q in (0, 20, 40) for k in range(1, 21)]


def test_further_columns_and_float_vectors(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(np.float32(v)) for v in x], 1, "a", 2.0) for i, x in enumerate(rng.standard_normal((50, 3)))]
    given = spark.createDataFrame(rows, "vec_id long, embedding array<float>, number int, vector string, score double")
    got = sorted(tuple(r) for r in NeighbourIndex(given).search(given.where("vec_id < 5")).collect())
    pairs = [r[:2] for r in rows]
    assert got == brute(pairs, pairs[:5], 3, 20)


def test_lists_keep_the_nearest():
    part = Part(2, np.zeros((3, 1)), np.zeros((3, 0)), np.zeros((3, 0)))
    first = 2 << PART_BITS
    assert part.add(np.array([0, 0, 0, 1, 0]), np.array([9, 8, 7, first + 1, 9]), np.array([0.1, 0.3, 0.2, 0.9, 0.1]), 2) == 2
    assert part.lists.tolist() == [[8, 7], [-1, -1], [-1, -1]]
    assert part.add(np.array([0, 2]), np.array([5, 0]), np.array([0.25, 0.0]), 2) == 2
    assert part.lists.tolist() == [[8, 5], [-1, -1], [0, -1]]


def test_search_in_a_part_goes_on_from_the_nearest():
    vectors = np.arange(10, dtype=float)[:, None]
    lists = np.array([[i - 1, i + 1] for i in range(10)])
    lists[0, 0], lists[9, 1] = -1, (1 << PART_BITS) + 3
    part = Part(0, vectors, lists, np.zeros((10, 2)))
    none = np.zeros(0, int)
    place, scores, counts, away = search_part(part, vectors, np.array([2.0]), np.array([4]), none, -np.inf, 3)
    assert sorted(zip(place.tolist(), scores.tolist(), strict=True)) == [(7, 14.0), (8, 16.0), (9, 18.0)]
    assert counts.sum() == 1 and away.tolist() == [(1 << PART_BITS) + 3]
    assert not len(search_part(part, vectors, np.array([2.0]), np.array([4]), none, 99.0, 3)[0])
