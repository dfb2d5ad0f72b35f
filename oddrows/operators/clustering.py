"""Repeatable k-means and the detectors built on it."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oddrows.functions.lineage import written
from oddrows.functions.quantiles import quantiles
from oddrows.operators.joins import assign_nearest, distance_to
from oddrows.operators.sequence import flag_top_fraction


#: points of a file, so that every round is spread over the cores
ROWS_A_FILE = 200_000


@dataclass
class Centroids:
    """k fitted centres with their cluster sizes and the loss of every iteration."""

    columns: list[str]
    centres: list[list[float]]
    sizes: list[int]
    history: list[tuple[int, float]] = field(default_factory=list)

    def history_table(self, df: DataFrame) -> DataFrame:
        return df.sparkSession.createDataFrame(self.history, "step int, loss double")

    def table(self, df: DataFrame) -> DataFrame:
        rows = [(i, c, n) for i, (c, n) in enumerate(zip(self.centres, self.sizes))]
        return df.sparkSession.createDataFrame(rows, "cluster int, centre array<double>, size bigint")


def _round(points: DataFrame, centres: list[list[float]]) -> dict[int, tuple[int, float, list[float]]]:
    """Rows, loss and new centre of every cluster that has rows: every task adds up its Arrow batches as differences from the
    centres, and k short rows a task are summed. A plan without numbers of the round in it costs nothing to compile again."""
    now = np.array(centres, float)
    k, d = now.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, loss, sums = np.zeros(k, np.int64), np.zeros(k), np.zeros((k, d))
        for batch in batches:
            columns = [c.to_numpy(zero_copy_only=False).astype(float, copy=False) for c in batch.columns]
            least, own = None, np.zeros(batch.num_rows, np.intp)
            for i in range(k):  # whole columns at a time: an array of rows, centres and columns is several times slower
                square = np.zeros(batch.num_rows)
                for x, c in zip(columns, now[i]):
                    square += (x - c) ** 2
                if least is None:
                    least = square
                else:
                    own[square < least] = i  # the lowest number on ties
                    np.minimum(least, square, out=least)
            count += np.bincount(own, minlength=k)
            loss += np.bincount(own, least, minlength=k)
            for j, x in enumerate(columns):
                sums[:, j] += np.bincount(own, x - now[own, j], minlength=k)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k, dtype=np.int32)), pa.array(count), pa.array(loss), pa.array(sums.tolist(), pa.list_(pa.float64()))],
                                         ["cluster", "size", "loss", "sums"])

    parts = points.mapInArrow(add, "cluster int, size long, loss double, sums array<double>").filter("size > 0")
    rows = parts.groupBy("cluster").agg(F.sum("size").alias("size"), F.sum("loss").alias("loss"),
                                        F.array(*[F.sum(F.col("sums")[j]) for j in range(d)]).alias("sums")).collect()
    return {r["cluster"]: (r["size"], r["loss"], [c + s / r["size"] for c, s in zip(centres[r["cluster"]], r["sums"])]) for r in rows}


def lloyd(df: DataFrame, columns: Sequence[str], k: int, iterations: int | None = None, tolerance: float = 1e-9) -> Centroids:
    """k-means from a quantile start: centre i begins at the (i + 0.5) / k quantile of every
    column. One aggregate per round; only k centres travel to the driver, so neither the
    plan nor the driver grows with rows or rounds. Empty clusters keep their centre.

    Rounds go on until no centre moves by more than `tolerance` times the spread of a column; where
    sums round worse than that, until the sizes stay and the loss falls no more. With `iterations`
    there are exactly that many rounds, converged or not."""
    cols = list(columns)
    probs = [(i + 0.5) / k for i in range(k)]
    points = written(df.select(*[F.col(c).cast("double").alias(c) for c in cols]).dropna(), ROWS_A_FILE)  # read once per round
    start = {(r["column"], round(r["prob"], 9)): r["value"] for r in quantiles(points, cols, probs).collect()}
    centres = [[start[(c, round(p, 9))] for c in cols] for p in probs]
    ends = points.agg(*[F.max(c) - F.min(c) for c in cols]).first() if iterations is None else []
    limits = [tolerance * float(e or 0) for e in ends]
    history, sizes, step = [], [0] * k, 0
    while True:
        found = _round(points, centres)
        history.append((step, float(sum(loss for _, loss, _ in found.values()))))
        last, sizes = sizes, [found[i][0] if i in found else 0 for i in range(k)]
        if iterations is None:
            moved = any(abs(m - c) > limit for i, (_, _, new) in found.items() for m, c, limit in zip(new, centres[i], limits))
            done = not moved or (step > 0 and sizes == last and history[-1][1] >= history[-2][1])
        else:
            done = step == iterations
        if done:
            break
        for i, (_, _, new) in found.items():
            centres[i] = new
        step += 1
    return Centroids(cols, centres, sizes, history)


def kmeans_fit(df: DataFrame, columns: Sequence[str], k: int, seed: int = 42) -> Centroids:
    """`pyspark.ml` k-means for production use; the start is random but seeded."""
    cols = list(columns)
    vectors = VectorAssembler(inputCols=cols, outputCol="features", handleInvalid="skip").transform(df.select(*cols))
    model = KMeans(k=k, seed=seed).fit(vectors)
    sizes = [int(n) for n in model.summary.clusterSizes]
    return Centroids(cols, [list(map(float, c)) for c in model.clusterCenters()], sizes)


def kmeans_distance_outliers(df: DataFrame, fitted: Centroids, fraction: float = 0.13) -> DataFrame:
    """Distance to the nearest centre as score; the top fraction is flagged, ties included."""
    scored = assign_nearest(df, fitted.columns, fitted.centres).withColumnRenamed("distance", "score")
    return flag_top_fraction(scored, "score", fraction)


def kmeans_threshold_outliers(df: DataFrame, fitted: Centroids, threshold: float) -> DataFrame:
    """Cluster and distance per row; rows farther than `threshold` from their centre are flagged."""
    scored = assign_nearest(df, fitted.columns, fitted.centres).withColumnRenamed("distance", "score")
    return scored.withColumn("is_outlier", (F.col("score") > threshold).cast("int"))


def large_clusters(sizes: Sequence[int], alpha: float = 0.9, beta: float = 5.0) -> list[int]:
    """Clusters that count as large: the smallest leading set (by size) that holds `alpha` of the
    rows and is followed by a drop of factor `beta`; failing both, alpha decides, then beta."""
    order = sorted(range(len(sizes)), key=lambda i: (-sizes[i], i))
    total, held, holds, drops = sum(sizes), 0, [], []
    for cut in range(1, len(order)):
        before, after = sizes[order[cut - 1]], sizes[order[cut]]
        held += before
        if held >= total * alpha:
            holds.append(cut)
        if after == 0 or before / after >= beta:
            drops.append(cut)
    both = sorted(set(holds) & set(drops))
    cut = (both or holds or drops or [len(order)])[0]
    return order[:cut]


def cblof(df: DataFrame, fitted: Centroids, alpha: float = 0.9, beta: float = 5.0, use_weights: bool = False) -> DataFrame:
    """Rows of large clusters score their distance to the own centre, rows of small clusters the
    distance to the nearest large centre; `use_weights` multiplies by the cluster size."""
    large = large_clusters(fitted.sizes, alpha, beta)
    out = assign_nearest(df, fitted.columns, fitted.centres)
    to_large = [distance_to(fitted.columns, fitted.centres[i]) for i in large]
    nearest = to_large[0] if len(to_large) == 1 else F.least(*to_large)
    score = F.when(F.col("cluster").isin(large), F.col("distance")).otherwise(nearest)
    if use_weights:
        score = score * F.element_at(F.array(*[F.lit(float(n)) for n in fitted.sizes]), F.col("cluster") + 1)
    return out.withColumn("score", score)
