"""Isolation forest: samples drawn by hashes, small trees grown inside tasks, rows scored in Arrow batches.

All randomness is a hash of (seed, tree, node or key), so the forest depends neither on
partitioning nor on task order."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from oddrows.functions.columns import hash32, uniform
from oddrows.functions.lineage import written

EULER_GAMMA = 0.5772156649


def average_path(n: float) -> float:
    """Mean path length of an unsuccessful search among n rows."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1) + EULER_GAMMA) - 2.0 * (n - 1) / n


#: rows a tree draws on average, in samples, before it is thinned to the sample
SPARE = 2.0


def _drawn(points: DataFrame, key: str, n: int, trees: int, rate: float, seed: int) -> DataFrame:
    """Rows with the trees that draw them, each tree each row with probability `rate` (all of them at 1 or more).

    A row does not toss for every tree: the gaps between the trees that draw it are geometric, so one hash tells most rows of a
    large table that no tree does."""
    if rate >= 1:
        return points.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))))
    gap = lambda i: F.floor(F.log(uniform(seed, F.lit("s"), key, i)) / F.lit(math.log(1 - rate)))
    some = points.withColumn("_at", gap(F.lit(0))).filter(F.col("_at") < trees)
    start = F.struct(F.col("_at").alias("at"), F.array(F.col("_at").cast("int")).alias("drawn"))

    def step(state, i):
        at = state["at"] + 1 + gap(i)
        more = F.when(at < trees, F.array_append(state["drawn"], at.cast("int"))).otherwise(state["drawn"])
        return F.when(state["at"] >= trees, state).otherwise(F.struct(at.alias("at"), more.alias("drawn")))

    drawn = F.aggregate(F.sequence(F.lit(1), F.lit(trees)), start, step, lambda state: state["drawn"])
    return some.withColumn("tree", F.explode(drawn)).drop("_at")


def _sampled(points: DataFrame, key: str, trees: int, sample: int, seed: int) -> DataFrame:
    """The rows of each tree: `sample` of its draw from the whole table with the smallest hash (all rows of a smaller table)."""
    n, spare = points.count(), SPARE
    while True:
        rate = spare * sample / max(n, 1)
        each = written(_drawn(points, key, n, trees, rate, seed))
        if rate >= 1:
            break
        kept = each.groupBy("tree").count().agg(F.count(F.lit(1)).alias("trees"), F.min("count").alias("least")).first()
        if kept["trees"] == trees and kept["least"] >= sample:
            break
        spare *= 2  # hardly ever: a tree drew less than half of what it expects
    pick = Window.partitionBy("tree").orderBy("_h", key)  # about SPARE * sample rows a tree
    return each.withColumn("_h", hash32(seed, "tree", key)).withColumn("_r", F.row_number().over(pick)).filter(F.col("_r") <= sample)


def _grown(x: np.ndarray, tree: int, levels: int, seed: int) -> list[tuple[int, int, float, int]]:
    """(node, feature, cut, size) of the tree over the rows x; leaves have feature -1."""
    def number(kind: str, node: int) -> int:
        return int(hashlib.md5(f"{seed}:{kind}:{tree}:{node}".encode()).hexdigest()[:8], 16)

    out, todo = [], [(1, 0, np.arange(len(x)))]
    while todo:
        node, depth, rows = todo.pop()
        low, high = x[rows].min(axis=0), x[rows].max(axis=0)
        live = np.flatnonzero(low < high)
        if depth == levels or not len(live):
            out.append((node, -1, 0.0, len(rows)))
            continue
        f = int(live[number("f", node) % len(live)])
        cut = float(low[f] + (number("c", node) + 0.5) / 4294967296.0 * (high[f] - low[f]))
        right = x[rows, f] >= cut
        out.append((node, f, cut, 0))
        todo += [(2 * node + side, depth + 1, part) for side, part in ((0, rows[~right]), (1, rows[right])) if len(part)]
    return out


def fit_isolation_forest(
    df: DataFrame, columns: Sequence[str], key: str, trees: int = 100, sample: int = 256, seed: int = 0,
) -> DataFrame:
    """Nodes of the forest: `tree, node, feature, cut, size`; leaves have feature -1.

    Node 1 is the root, the children of v are 2v (below the cut) and 2v + 1. Every tree draws its sample from the whole
    table. Samples hold `trees * sample` rows, so growing costs the same at any table size; a tree is grown where its
    sample lies."""
    cols, levels = list(columns), math.ceil(math.log2(sample))
    points = df.select(F.col(key).alias("_k"), *[F.col(c).cast("double").alias(c) for c in cols]).dropna()
    rows = _sampled(points, "_k", trees, sample, seed).select("tree", "_h", *cols)

    def grow(own: pd.DataFrame) -> pd.DataFrame:
        tree = int(own["tree"].iloc[0])
        nodes = pd.DataFrame(_grown(own[cols].to_numpy(float), tree, levels, seed), columns=["node", "feature", "cut", "size"])
        return nodes.assign(tree=tree)[["tree", "node", "feature", "cut", "size"]]

    return written(rows.groupBy("tree").applyInPandas(grow, "tree int, node long, feature int, cut double, size long"))


def score_isolation_forest(df: DataFrame, forest: DataFrame, columns: Sequence[str], to: str = "score") -> DataFrame:
    """Anomaly score 2^(-mean path / expected path) in (0, 1); larger is more unusual.

    The forest has at most 2 * trees * sample nodes; it goes to the tasks as dense arrays."""
    nodes = forest.toPandas()
    trees, top = int(nodes["tree"].max()) + 1, int(nodes["node"].max()) + 1
    t, v = nodes["tree"].to_numpy(), nodes["node"].to_numpy()
    leaf = nodes["feature"].to_numpy() < 0
    sizes = nodes["size"].to_numpy()
    # leaves lead back to themselves, so every row can take the same number of steps
    child = np.tile(np.arange(top), (trees, 1))
    child[t[~leaf], v[~leaf]] = 2 * v[~leaf]
    feature = np.zeros((trees, top), dtype=np.int64)
    feature[t, v] = np.maximum(nodes["feature"].to_numpy(), 0)
    cut = np.full((trees, top), np.inf)
    cut[t[~leaf], v[~leaf]] = nodes["cut"].to_numpy()[~leaf]
    depth = np.floor(np.log2(v))
    path = np.zeros((trees, top))
    path[t[leaf], v[leaf]] = depth[leaf] + [average_path(n) for n in sizes[leaf]]
    expected = average_path(float(nodes[leaf].groupby("tree")["size"].sum().max()))
    levels, single = int(depth.max()), len(list(columns)) == 1

    @F.pandas_udf("double")
    def score(xs: pd.Series) -> pd.Series:
        x = np.stack(xs.to_numpy()).astype(float).T
        n = x.shape[1]
        flat, rows, total = np.ascontiguousarray(x).ravel(), np.arange(n), np.zeros(n)
        for tree in range(trees):
            to, cuts, at = child[tree], cut[tree], np.ones(n, dtype=np.int64)
            for _ in range(levels):
                value = flat if single else flat.take(feature[tree].take(at) * n + rows)
                at = to.take(at) + (value >= cuts.take(at))
            total += path[tree].take(at)
        return pd.Series(2.0 ** (-(total / trees) / expected)) if expected else pd.Series(np.full(n, 0.5))

    vector = F.array(*[F.col(c).cast("double") for c in columns])
    whole = F.lit(True)
    for c in columns:
        whole = whole & F.col(c).isNotNull()
    safe = F.when(whole, vector).otherwise(F.array(*[F.lit(0.0)] * len(list(columns))))
    return df.withColumn(to, F.when(whole, score(safe)))
