"""Centroid clustering of integer vectors by equal-average equal-variance nearest neighbour search.

A component x becomes floor(scale * x), so sums, centroids and distances are exact whatever the partitioning. The centroids are
sorted by the mean of their components. A vector is placed among them by its own mean and looks outward on both sides, the
nearer mean first: once the mean inequality n * (mean difference)^2 >= best holds strictly, all further centroids are
out; a centroid left is still rejected where n * (mean difference)^2 + (deviation difference)^2 exceeds the best distance;
only the rest get the full integer distance. Both inequalities are applied to all vectors of a batch at a time.

Every round is one pass: tasks add up the vectors of each centroid, Spark adds the tasks' sums, and k rows of exact
sums come to the driver. `k` and the dimension bound what is sent either way, not the table.

Defined cases: vectors of another length, or null, or with a null, NaN or infinite component, or one beyond 2^27 after
scaling (its distance would not fit a long) take no part and are not returned; of equal distances the smaller
centroid number wins; an empty centroid stays where it is; with fewer vectors than k each is a centroid; of repeated
rows each counts, and where several of them hash alike the smaller vector starts first; a null vec_id hashes as an
empty one; an empty table gives an empty result. Columns of other names are ignored."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oddrows.functions.lineage import written
from oddrows.llm.vectors import whole_numbers

DIMS = 64
SCALE = 64
CENTROIDS = 16
ROUNDS = 3
SEED = 1
_BATCH = 8192


class SortedCentroids:
    """Centroids in order of their component sums, with sums and deviations for the two inequalities."""

    def __init__(self, centres: np.ndarray):
        total = centres.sum(axis=1)
        self.number = np.lexsort((np.arange(len(centres)), total))  # place in the order -> centroid number
        self.centres, self.total = centres[self.number], total[self.number]
        self.deviation = _deviation(self.centres, self.total)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Number of the nearest centroid of each row, squared distance, and how many distances were computed."""
        n, k, dims = len(x), len(self.centres), x.shape[1]
        total = x.sum(axis=1)
        deviation = _deviation(x, total)
        best, number = np.full(n, np.iinfo(np.int64).max), np.full(n, k, np.int64)
        right = np.searchsorted(self.total, total)
        left = right - 1
        active, computed = np.arange(n), 0
        far = np.iinfo(np.int64).max
        while len(active):
            lo, hi, own = left[active], right[active], total[active]
            down = np.where(lo >= 0, own - self.total[np.maximum(lo, 0)], far)
            up = np.where(hi < k, self.total[np.minimum(hi, k - 1)] - own, far)
            use_left = down <= up
            gap = np.where(use_left, down, up)
            # (sum difference)^2 / dims <= distance; in doubles with a margin, so equal distances are never rejected
            reach = gap.astype(np.float64) ** 2
            limit = best[active].astype(np.float64) * dims * (1 + 1e-9) + 1
            open_ = (gap < far) & (reach <= limit)
            active, use_left, reach, limit = active[open_], use_left[open_], reach[open_], limit[open_]
            place = np.where(use_left, left[active], right[active])
            left[active] -= use_left
            right[active] += ~use_left
            apart = (deviation[active] - self.deviation[place]) ** 2
            close = reach + dims * apart * (1 - 1e-9) <= limit
            rows, place = active[close], place[close]
            computed += len(rows)
            difference = x[rows] - self.centres[place]
            distance = np.einsum("ij,ij->i", difference, difference)
            named = self.number[place]
            better = (distance < best[rows]) | ((distance == best[rows]) & (named < number[rows]))
            best[rows[better]], number[rows[better]] = distance[better], named[better]
        return number, best, computed


def _deviation(x: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Length of what is left of each row without its mean."""
    square = np.einsum("ij,ij->i", x.astype(np.float64), x.astype(np.float64))
    return np.sqrt(np.maximum(square - total.astype(np.float64) ** 2 / x.shape[1], 0.0))


def _matrices(batches: Iterator[pa.RecordBatch], scale: int, dims: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for whole in batches:
        for at in range(0, whole.num_rows, _BATCH):
            batch = whole.slice(at, _BATCH)
            rows, x = whole_numbers(batch.column("v"), scale, dims)
            if len(rows):
                yield batch.take(pa.array(rows)), x


def starting_centroids(vectors: DataFrame, k: int, seed: int, scale: int, dims: int) -> np.ndarray:
    """The k vectors of the smallest sha256 of `seed:vec_id`, in that order (a distributed top-k)."""
    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, x in _matrices(batches, scale, dims):
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(list(x), pa.list_(pa.int64()))], ["vec_id", "x"])

    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = vectors.mapInArrow(kept, "vec_id long, x array<long>").orderBy(key, "x").limit(k).collect()
    return np.array([r["x"] for r in rows], np.int64).reshape(len(rows), dims)


def moved(vectors: DataFrame, centres: np.ndarray, scale: int) -> np.ndarray:
    """The centroids after one round: floor(sum / count) of the vectors nearest to each."""
    k, dims = centres.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search, sums, counts = SortedCentroids(centres), np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for _, x in _matrices(batches, scale, dims):
            number = search.nearest(x)[0]
            np.add.at(sums, number, x)
            counts += np.bincount(number, minlength=k)
        held = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(held), pa.array(counts[held]), pa.array(list(sums[held]), pa.list_(pa.int64()))], ["number", "n", "sums"])

    exact = [F.sum(F.get("sums", F.lit(i)).cast("decimal(38,0)")).alias(f"s{i}") for i in range(dims)]
    out = centres.copy()
    for r in vectors.mapInArrow(add, "number long, n long, sums array<long>").groupBy("number").agg(F.sum("n").alias("n"), *exact).collect():
        out[r["number"]] = [int(r[f"s{i}"]) // r["n"] for i in range(dims)]
    return out


def cluster(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", k: int = CENTROIDS, rounds: int = ROUNDS,
            seed: int = SEED, scale: int = SCALE, dims: int = DIMS) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, cluster, distance) of every vector that counts, written, and the k final centroids."""
    rows = vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(embedding).alias("v"))
    centres = starting_centroids(rows, k, seed, scale, dims)
    for _ in range(rounds if len(centres) else 0):
        centres = moved(rows, centres, scale)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = SortedCentroids(centres) if len(centres) else None
        for batch, x in _matrices(batches, scale, dims):
            number, distance, _ = search.nearest(x)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(number.astype(np.int32)), pa.array(distance)],
                                             ["vec_id", "cluster", "distance"])

    return written(rows.mapInArrow(assign, "vec_id long, cluster int, distance long")), centres


def op12(vectors: DataFrame) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256."""
    assigned, centres = cluster(vectors)
    sums = assigned.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia")).collect()  # one row per centroid
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres.tolist()]
    rows = [(r["cluster"], r["cluster_inertia"], sum(s["cluster_inertia"] for s in sums), digests[r["cluster"]]) for r in sums]
    known = vectors.sparkSession.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(known), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _op12_sql() -> str:
    rounds = []
    for r in range(ROUNDS + 1):
        rounds.append(f"""d{r} AS MATERIALIZED (SELECT v.row, c.number, sum((v.x - c.x) * (v.x - c.x)) AS distance
    FROM v JOIN c{r} c USING (i) GROUP BY v.row, c.number)""")
        rounds.append(f"""a{r} AS MATERIALIZED (SELECT row, arg_min(number, distance * 100 + number)::INT AS number, min(distance)::BIGINT AS distance
    FROM d{r} GROUP BY row)""")
        if r < ROUNDS:
            rounds.append(f"""c{r + 1} AS MATERIALIZED (SELECT c.number, c.i, coalesce(s.x, c.x) AS x FROM c{r} c LEFT JOIN (
    SELECT a.number, v.i, CAST(floor(sum(v.x) / count(*)) AS BIGINT) AS x FROM v JOIN a{r} a USING (row) GROUP BY a.number, v.i) s
    ON c.number = s.number AND c.i = s.i)""")
    return f"""WITH raw AS MATERIALIZED (SELECT row_number() OVER () AS row, vec_id, embedding FROM embeddings
    WHERE len(embedding) = {DIMS} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
v AS MATERIALIZED (SELECT row, i, CAST(floor({SCALE} * CAST(embedding[i] AS DOUBLE)) AS BIGINT) AS x FROM raw, range(1, {DIMS + 1}) t(i)),
first AS (SELECT row, row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id)) - 1 AS number FROM raw
    ORDER BY sha256('{SEED}:' || vec_id) LIMIT {CENTROIDS}),
c0 AS MATERIALIZED (SELECT f.number, v.i, v.x FROM first f JOIN v USING (row)),
{", ".join(rounds)},
digest AS (SELECT number, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256 FROM c{ROUNDS} GROUP BY number)
SELECT raw.vec_id, a.number AS cluster, a.distance,
    CAST(sum(a.distance) OVER (PARTITION BY a.number) AS BIGINT) AS cluster_inertia, CAST(sum(a.distance) OVER () AS BIGINT) AS inertia,
    centroid_sha256 FROM a{ROUNDS} a JOIN raw USING (row) JOIN digest USING (number)"""


OP12_SQL = _op12_sql()
