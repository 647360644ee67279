"""Centroid clustering of integer vectors: Hilbert-ordered blocks with boxes that bound the distances.

Components become integers (``floor(scale * x)``). The vectors are put in the order of a Hilbert curve and
cut into blocks, each with the least and greatest value of every component (a zone map). In a round, the
distance of a block's box to each centroid bounds that of all its vectors from below and above; only
centroids whose lower bound is not above the least upper bound are compared with the vectors, exactly, in
integers. A task sums what its blocks assign, so a row per task and cluster is all that moves, and only
the centroids come to the driver.

Cases: rows whose vector is NULL, of another length, or holds a NULL or non-finite component are left out.
Vectors whose scaled components pass 2^26 would pass 64 bits when squared and raise an error. Repeated rows
count as often as they occur; equal vectors are dealt by their ids, so one vector may hold any share of the
rows. Ties of distance go to the smaller cluster number. With fewer rows than clusters there are as many
clusters as rows; a NULL id starts a cluster only after all others. An empty table gives an empty result.
Columns other than id and vector are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statlake.llm.hilbert import cell_numbers, hilbert_keys
from statlake.llm.scratch import scratch_table

CLUSTERS, ROUNDS, SCALE, LENGTH = 16, 3, 64, 64
SEED = "1"
BLOCK_ROWS = 256
GRID_BITS = 4
LARGEST = 1 << 26  # 64 squares of twice this fit in 64 bits

BLOCK_SCHEMA = "vec_id array<long>, points binary, low binary, high binary"
RESULT_SCHEMA = (
    "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
)


def whole_vector(embedding: Column, length: int) -> Column:
    """Whether a vector has the length and only finite components."""
    finite = F.forall(
        embedding,
        lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")),
    )
    return embedding.isNotNull() & (F.size(embedding) == length) & finite


def integer_vectors(
    vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", length: int = LENGTH,
    scale: int = SCALE,
) -> DataFrame:
    """(vec_id, point) of the whole vectors, components as integers."""

    def scaled(x: Column) -> Column:
        value = F.floor(F.lit(float(scale)) * x.cast("double"))
        fits = F.abs(x.cast("double")) * scale <= LARGEST
        return F.when(fits, value).otherwise(F.raise_error(F.lit("vector component too large")).cast("long"))

    kept = vectors.where(whole_vector(F.col(embedding), length))
    return kept.select(
        F.col(vec_id).cast("long").alias("vec_id"), F.transform(embedding, scaled).alias("point")
    )


def first_centroids(points: DataFrame, clusters: int, seed: str = SEED) -> np.ndarray:
    """The vectors whose seeded id has the smallest SHA-256, one row each."""
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = points.orderBy(drawn.asc_nulls_last(), F.col("vec_id").asc(), F.col("point").asc())
    return np.array([r["point"] for r in rows.select("point").limit(clusters).collect()], dtype=np.int64)


def matrix(column: pa.Array, length: int) -> np.ndarray:
    """A list column as rows of a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, length)


def hilbert_blocks(points: DataFrame, length: int = LENGTH, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Blocks of neighbouring vectors with their boxes, written and read again."""
    bounds = points.agg(F.min(F.array_min("point")), F.max(F.array_max("point"))).first()
    low, high = (float(v or 0) for v in bounds)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                cells = cell_numbers(matrix(batch.column(1), length), low, high + 1, GRID_BITS)
                keys = hilbert_keys(cells, GRID_BITS)
                yield batch.append_column("key", pa.array([k.tobytes() for k in keys], pa.binary()))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), block_rows):
                part = batch.slice(at, block_rows)
                block = matrix(part.column(1), length).astype("<i4")
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part.column(0).to_pylist()], pa.list_(pa.int64())),
                        *(pa.array([b.tobytes()], pa.binary()) for b in (block, block.min(0), block.max(0))),
                    ],
                    ["vec_id", "points", "low", "high"],
                )

    along = points.mapInArrow(keyed, "vec_id long, point array<long>, key binary")
    # The hash splits a vector that many rows share; the order within a partition is total.
    dealt = along.repartitionByRange("key", F.xxhash64("vec_id"))
    ordered = dealt.sortWithinPartitions("key", "vec_id").select("vec_id", "point")
    return scratch_table(ordered.mapInArrow(cut, BLOCK_SCHEMA), "clusters-blocks")


def possible_centroids(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """The centroids that may be nearest to some vector of a box, in ascending order."""
    under, over = low - centroids, centroids - high
    least = np.maximum(np.maximum(under, over), 0)
    most = np.maximum(-under, -over)
    lower, upper = (least * least).sum(1), (most * most).sum(1)
    return np.flatnonzero(lower <= upper.min())


def nearest(points: np.ndarray, centroids: np.ndarray, among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each vector among some, and its squared distance."""
    own = centroids[among]
    distances = (points * points).sum(1)[:, None] - 2 * (points @ own.T) + (own * own).sum(1)
    best = distances.argmin(1)
    return among[best], distances[np.arange(len(points)), best]


def assigned_blocks(
    batches: Iterator[pa.RecordBatch], centroids: np.ndarray
) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]]:
    """Of each block: the ids, the vectors, their clusters and distances."""
    length = centroids.shape[1]
    for batch in batches:
        for ids, *raw in zip(*batch.columns, strict=True):
            points, low, high = (np.frombuffer(r.as_py(), "<i4").astype(np.int64) for r in raw)
            points = points.reshape(-1, length)
            cluster, distance = nearest(points, centroids, possible_centroids(low, high, centroids))
            yield ids.values, points, cluster, distance


def cluster_sums(blocks: DataFrame, centroids: np.ndarray) -> list[tuple[int, int, list[int]]]:
    """(rows, summed distance, summed vector) of each cluster, exact."""
    clusters, length = centroids.shape

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, total = np.zeros(clusters, np.int64), [0] * clusters
        sums = np.zeros((clusters, length), np.int64)
        for _, points, cluster, distance in assigned_blocks(batches, centroids):
            for c in np.unique(cluster):
                mine = cluster == c
                rows[c] += int(mine.sum())
                total[c] += sum(distance[mine].tolist())
                sums[c] += points[mine].sum(0)
        held = np.flatnonzero(rows)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(held.astype(np.int32)),
                pa.array(rows[held]),
                pa.array([str(total[c]) for c in held], pa.string()),
                pa.array([sums[c].tolist() for c in held], pa.list_(pa.int64())),
            ],
            ["cluster", "n", "distance", "sums"],
        )

    exact = "decimal(38,0)"
    each = blocks.mapInArrow(partial, "cluster int, n long, distance string, sums array<long>")
    found = each.groupBy("cluster").agg(
        F.sum("n").alias("n"),
        F.sum(F.col("distance").cast(exact)).alias("distance"),
        F.array(*[F.sum(F.col("sums")[i].cast(exact)) for i in range(length)]).alias("sums"),
    )
    out = [(0, 0, [0] * length)] * clusters
    for r in found.collect():  # a row per cluster
        out[r["cluster"]] = (r["n"], int(r["distance"]), [int(s) for s in r["sums"]])
    return out


def moved_centroids(centroids: np.ndarray, sums: list[tuple[int, int, list[int]]]) -> np.ndarray:
    """Each centroid that has vectors at the floor of their mean."""
    out = centroids.copy()
    for c, (n, _, total) in enumerate(sums):
        if n:
            out[c] = [s // n for s in total]
    return out


def cluster_vectors(
    vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", clusters: int = CLUSTERS,
    rounds: int = ROUNDS, length: int = LENGTH, scale: int = SCALE, seed: str = SEED,
) -> DataFrame:
    """A row per whole vector: id, cluster, squared distance, sums of distances, digest of its centroid."""
    points = integer_vectors(vectors, vec_id, embedding, length, scale)
    centroids = first_centroids(points, clusters, seed)
    if not len(centroids):
        empty = vectors.sparkSession.createDataFrame([], RESULT_SCHEMA)
        return empty.withColumnRenamed("vec_id", vec_id)
    blocks = hilbert_blocks(points, length)
    for _ in range(rounds):
        centroids = moved_centroids(centroids, cluster_sums(blocks, centroids))
    by_cluster = [total for _, total, _ in cluster_sums(blocks, centroids)]
    whole = sum(by_cluster)
    if whole >= 1 << 63:
        raise ValueError("the summed distances do not fit in 64 bits")
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]

    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, _, cluster, distance in assigned_blocks(batches, centroids):
            yield pa.RecordBatch.from_arrays(
                [
                    ids,
                    pa.array(cluster.astype(np.int32)),
                    pa.array(distance),
                    pa.array([by_cluster[c] for c in cluster], pa.int64()),
                    pa.array([whole] * len(cluster), pa.int64()),
                    pa.array([digests[c] for c in cluster]),
                ],
                ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"],
            )

    return blocks.mapInArrow(assigned, RESULT_SCHEMA).withColumnRenamed("vec_id", vec_id)


def oracle_sql(clusters: int = CLUSTERS, rounds: int = ROUNDS, length: int = LENGTH, scale: int = SCALE) -> str:
    """DuckDB SQL for the same rows, with the rounds written out one after another."""
    sql = f"""
    WITH kept AS (
        SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS p
        FROM embeddings
        WHERE len(embedding) = {length} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {length}),
    parts AS (SELECT vec_id, generate_subscripts(p, 1) AS i, unnest(p) AS v FROM kept),
    c0 AS (SELECT row_number() OVER (ORDER BY sha256(concat('{SEED}:', vec_id))) - 1 AS c, p FROM kept QUALIFY c < {clusters}),
    """
    nearest_sql = """
    a{r} AS (SELECT vec_id, arg_min(c, (d, c)) AS c, min(d) AS d FROM (
        SELECT k.vec_id, c.c, list_sum(list_transform(list_zip(k.p, c.p), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
        FROM kept k CROSS JOIN c{r} c) GROUP BY 1),
    """
    for r in range(rounds):
        sql += nearest_sql.format(r=r)
        sql += f"""
    m{r} AS (SELECT c, list(m ORDER BY i) AS p FROM (
        SELECT c, i, CAST((s - ((s % n) + n) % n) // n AS BIGINT) AS m FROM (
            SELECT a.c, parts.i, sum(parts.v)::BIGINT AS s, count(*) AS n
            FROM a{r} a JOIN parts USING (vec_id) GROUP BY 1, 2)) GROUP BY 1),
    c{r + 1} AS (SELECT c.c, coalesce(m.p, c.p) AS p FROM c{r} c LEFT JOIN m{r} m USING (c)),
    """
    sql += nearest_sql.format(r=rounds).rstrip().rstrip(",")
    return sql + f"""
    SELECT vec_id, CAST(a.c AS INTEGER) AS cluster, d AS distance,
           CAST(sum(d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
           sha256(array_to_string(p, ',')) AS centroid_sha256
    FROM a{rounds} a JOIN c{rounds} c USING (c)
    """
