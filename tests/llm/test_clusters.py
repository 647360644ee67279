import hashlib
import itertools
import math
import random

import numpy as np
import pytest

from statlake.llm.clusters import cluster_vectors, possible_centroids
from statlake.llm.hilbert import hilbert_keys

SCHEMA = "vec_id long, embedding array<double>"
COLUMNS = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def brute(rows, clusters, rounds, length, scale):
    kept = [
        (i, [math.floor(scale * x) for x in v])
        for i, v in rows
        if v is not None and len(v) == length and all(x is not None and math.isfinite(x) for x in v)
    ]
    drawn = lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1])
    centroids = [p for _, p in sorted(kept, key=drawn)[:clusters]]
    far = lambda p, c: sum((a - b) ** 2 for a, b in zip(p, c, strict=True))

    def assign():
        return [min((far(p, c), k) for k, c in enumerate(centroids)) for _, p in kept]

    for _ in range(rounds):
        found = assign()
        for k in range(len(centroids)):
            own = [p for (_, p), (_, c) in zip(kept, found, strict=True) if c == k]
            if own:
                centroids[k] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    found = assign()
    total = [sum(d for d, c in found if c == k) for k in range(len(centroids))]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(
        ((i, c, d, total[c], sum(total), digest[c]) for (i, _), (d, c) in zip(kept, found, strict=True)),
        key=lambda r: (r[0] is None, r),
    )


def run(spark, rows, **options):
    made = cluster_vectors(spark.createDataFrame(rows, SCHEMA), **options)
    assert made.columns == COLUMNS
    return sorted((tuple(r) for r in made.collect()), key=lambda r: (r[0] is None, r))


@pytest.mark.parametrize("seed", range(4))
def test_against_brute_force(spark, seed):
    rng = random.Random(seed)
    spread = [0.5, 30.0, 2e3, 1e5][seed]
    rows = [(i, [rng.uniform(-spread, spread) for _ in range(3)]) for i in range(700)]
    rows += [(1000 + i, rows[5][1]) for i in range(400)]  # one vector has a third of the rows
    rows += [rows[7], rows[7]]
    options = {"clusters": 5, "rounds": 3, "length": 3, "scale": 64}
    assert run(spark, rows, **options) == brute(rows, **options)


def test_rows_that_are_left_out_and_ties(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [0.0, 0.0]), (2, None), (3, []), (4, [1.0]), (5, [1.0, None]), (6, [nan, 0.0]), (7, [inf, 0.0]),
        (8, [-inf, 1.0]), (9, [1.0, 2.0, 3.0]), (10, [2.0, 0.0]), (11, [1.0, 0.0]), (None, [0.25, 0.5]), (12, [-0.01, -0.0]),
    ]
    for clusters in (1, 2, 3, 16):
        options = {"clusters": clusters, "rounds": 2, "length": 2, "scale": 64}
        got = run(spark, rows, **options)
        assert got == brute(rows, **options)
        assert {r[0] for r in got} == {1, 10, 11, 12, None}


def test_empty_table_and_further_columns(spark):
    assert run(spark, [], length=2) == []
    assert run(spark, [(1, None)], length=2) == []
    rows = [(i, [float(i), 1.0], "a", b"b") for i in range(20)]
    given = spark.createDataFrame(rows, f"{SCHEMA}, point string, key binary")
    made = cluster_vectors(given, length=2, clusters=3)
    assert made.columns == COLUMNS
    assert made.count() == 20


def test_too_large_components_are_an_error(spark):
    with pytest.raises(Exception, match="too large"):
        run(spark, [(1, [1e30, 0.0])], length=2)


def test_hilbert_keys_visit_neighbouring_cells():
    for size, bits in ((2, 4), (3, 3), (5, 2)):
        cells = np.array(list(itertools.product(range(1 << bits), repeat=size)))
        keys = [k.tobytes() for k in hilbert_keys(cells, bits)]
        assert len(set(keys)) == len(cells)
        along = cells[sorted(range(len(cells)), key=keys.__getitem__)]
        assert (np.abs(np.diff(along, axis=0)).sum(1) == 1).all()


def test_boxes_never_leave_out_the_nearest():
    rng = np.random.default_rng(3)
    left_out = 0
    for _ in range(300):
        points = rng.integers(-20, 20, (6, 4)) + rng.integers(-50, 50, 4)
        centroids = rng.integers(-60, 60, (7, 4))
        among = possible_centroids(points.min(0), points.max(0), centroids)
        nearest = ((points[:, None] - centroids) ** 2).sum(2).argmin(1)
        assert set(nearest) <= set(among)
        left_out += 7 - len(among)
    assert left_out > 100
