"""Exact distance to the k-th nearest neighbour, without comparing all pairs.

One column: in sorted order the k nearest lie within k places on either side.
Two columns: distinct points are cut to cells of bounded size; each point looks into its own
cell first and afterwards only into the cells its current k-th distance still reaches."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oddrows.functions.lineage import written
from oddrows.functions.ordering import HOT_ROWS, row_frames

#: distinct points per cell, visits of one cell handled together, most cells
CELL_POINTS = 400
CELL_VISITS = 20_000
MAX_CELLS = 250_000


def knn_distance_1d(
    df: DataFrame, value: str, key: str, k: int = 5, exclude_self: bool = True, hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Distance to the k-th nearest value; null where fewer than k other rows exist."""
    kept = df.filter(F.col(value).isNotNull())
    need = k if exclude_self else k - 1
    out, w, finish = row_frames(kept, [value, key], None, before=k, after=k, hot_rows=hot_rows)
    if need == 0:
        return finish(out.withColumn("score", F.lit(0.0)))
    x = F.col(value).cast("double")
    near = [x - F.lag(value, i).over(w) for i in range(1, need + 1)]
    near += [F.lead(value, i).over(w) - x for i in range(1, need + 1)]
    ranked = F.array_sort(F.array_compact(F.array(*near)))
    return finish(out.withColumn("score", F.get(ranked, F.lit(need - 1))))


class _Cells:
    """Cell borders: slabs along the first column, tiles along the second inside each slab."""

    def __init__(self, slabs: np.ndarray, tiles: list[np.ndarray]):
        self.slabs, self.tiles = slabs, tiles
        self.base = np.concatenate([[0], np.cumsum([len(t) + 1 for t in tiles])]).astype(np.int64)

    @property
    def count(self) -> int:
        return int(self.base[-1])

    def locate(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        slab = np.searchsorted(self.slabs, x, side="left")
        out = np.empty(len(x), dtype=np.int64)
        for s in np.unique(slab):
            rows = slab == s
            out[rows] = self.base[s] + np.searchsorted(self.tiles[s], y[rows], side="left")
        return out

    def enclosed(self, x: np.ndarray, y: np.ndarray, r: np.ndarray, home: np.ndarray) -> np.ndarray:
        """True where the circle of radius r stays inside the home cell."""
        slab = np.searchsorted(self.base, home, side="right") - 1
        sides = np.concatenate([[-np.inf], self.slabs, [np.inf]])
        ends = [np.concatenate([[-np.inf], t, [np.inf]]) for t in self.tiles]
        low = np.concatenate([e[:-1] for e in ends])[home]
        high = np.concatenate([e[1:] for e in ends])[home]
        return (x - r >= sides[slab]) & (x + r <= sides[slab + 1]) & (y - r >= low) & (y + r <= high)

    def reached(self, x: float, y: float, r: float, home: int) -> list[int]:
        """Cells other than `home` nearer than r (all others when r is infinite)."""
        first = int(np.searchsorted(self.slabs, x - r, side="left"))
        last = int(np.searchsorted(self.slabs, x + r, side="left"))
        found = []
        for s in range(first, last + 1):
            left = self.slabs[s - 1] if s else -math.inf
            right = self.slabs[s] if s < len(self.slabs) else math.inf
            dx = max(left - x, x - right, 0.0)
            if dx >= r:
                continue
            dy = math.sqrt(r * r - dx * dx) if math.isfinite(r) else math.inf
            t = self.tiles[s]
            low = int(np.searchsorted(t, y - dy, side="left"))
            high = int(np.searchsorted(t, y + dy, side="left"))
            found += [int(self.base[s]) + j for j in range(low, high + 1)]
        return [c for c in found if c != home]


def _fit_cells(points: DataFrame, two: bool, cell_points: int) -> _Cells:
    n = points.count()
    size = max(cell_points, math.ceil(n / MAX_CELLS))
    parts = math.ceil(n / size)
    wanted = math.ceil(math.sqrt(parts)) if two else parts
    probs = [i / wanted for i in range(1, wanted)]
    cuts = points.approxQuantile("x", probs, 0.1 / wanted) if probs else []
    slabs = np.array(sorted(set(cuts)), dtype=float)
    if not two:
        return _Cells(slabs, [np.array([])] * (len(slabs) + 1))

    edges = F.array(*[F.lit(float(c)) for c in slabs]) if len(slabs) else F.array().cast("array<double>")
    slab = F.size(F.filter(edges, lambda c: c < F.col("x"))).alias("slab")
    rows = points.select(slab, "y").groupBy("slab").agg(F.count(F.lit(1)).alias("n")).collect()
    tiles_of = {r["slab"]: math.ceil(r["n"] / size) for r in rows}
    finest = max(tiles_of.values(), default=1)
    fine = [i / finest for i in range(1, finest)]
    tiles = [np.array([])] * (len(slabs) + 1)
    if fine:
        got = points.select(slab, "y").groupBy("slab").agg(
            F.percentile_approx("y", F.array(*map(F.lit, fine)), 10 * finest).alias("q")).collect()
        for r in got:  # one row per slab
            take = [math.ceil(i * finest / tiles_of[r["slab"]]) for i in range(1, tiles_of[r["slab"]])]
            tiles[r["slab"]] = np.array(sorted({r["q"][t - 1] for t in take}), dtype=float)
    return _Cells(slabs, tiles)


def _nearest(queries: pd.DataFrame, points: pd.DataFrame, k: int, home: bool, exclude_self: bool) -> list[np.ndarray]:
    """k smallest distances of every query to the points of one cell; a point stands for `m` rows."""
    xy, m = points[["x", "y"]].to_numpy(dtype=float), points["m"].to_numpy()
    q = queries[["x", "y"]].to_numpy(dtype=float)
    out: list[np.ndarray] = []
    block = max(1, 4_000_000 // len(points))
    wanted = np.arange(1, k + 1)
    for at in range(0, len(q), block):
        part = q[at:at + block]
        d = np.sqrt((part[:, None, 0] - xy[None, :, 0]) ** 2 + (part[:, None, 1] - xy[None, :, 1]) ** 2)
        few = min(k + 1, d.shape[1])
        near = np.argpartition(d, few - 1, axis=1)[:, :few]
        dist = np.take_along_axis(d, near, axis=1)
        order = np.argsort(dist, axis=1, kind="stable")
        dist, rows = np.take_along_axis(dist, order, axis=1), m[np.take_along_axis(near, order, axis=1)]
        if home and exclude_self:
            rows = rows - (dist == 0.0)  # distinct points: only the query itself lies at 0
        held = np.cumsum(rows, axis=1)
        # place of the j-th nearest row among the points, counting every point `rows` times
        place = (held[:, None, :] < wanted[None, :, None]).sum(axis=2)
        padded = np.column_stack([dist, np.full(len(dist), np.inf)])
        found = np.take_along_axis(padded, place, axis=1)
        out += [row[np.isfinite(row)] for row in found]
    return out


def knn_distance(
    df: DataFrame, columns: Sequence[str], k: int = 5, exclude_self: bool = True,
    queries: DataFrame | None = None, cell_points: int = CELL_POINTS,
) -> DataFrame:
    """Distance to the k-th nearest row in one or two columns (more go to `nearest.knn_distance`), as `score`.

    Scores the rows of `df` (a row does not count itself unless `exclude_self` is False), or
    the rows of `queries` against `df`. Equal rows are combined before any comparison."""
    cols = list(columns)
    if len(cols) > 2:
        if queries is not None or not exclude_self:
            raise ValueError("beyond two columns the rows of one table are scored against each other")
        from oddrows.operators.nearest import knn_distance as in_many_columns
        return in_many_columns(df, cols, k)
    two = len(cols) == 2
    x, y = F.col(cols[0]).cast("double"), F.col(cols[-1]).cast("double") if two else F.lit(0.0)

    def distinct(table: DataFrame) -> DataFrame:
        return table.select(x.alias("x"), y.alias("y")).dropna().groupBy("x", "y").agg(F.count(F.lit(1)).alias("m"))

    points = written(distinct(df))
    cells = _fit_cells(points, two, cell_points)
    borders = df.sparkSession.sparkContext.broadcast((cells.slabs, cells.tiles))  # at most MAX_CELLS numbers

    @F.pandas_udf("bigint")
    def locate(xs: pd.Series, ys: pd.Series) -> pd.Series:
        return pd.Series(_Cells(*borders.value).locate(xs.to_numpy(float), ys.to_numpy(float)))

    @F.pandas_udf("array<bigint>")
    def reached(xs: pd.Series, ys: pd.Series, rs: pd.Series, homes: pd.Series) -> pd.Series:
        grid, r = _Cells(*borders.value), rs.fillna(math.inf)
        done = grid.enclosed(xs.to_numpy(float), ys.to_numpy(float), r.to_numpy(float), homes.to_numpy())
        return pd.Series([[] if ok else grid.reached(*row) for ok, row in zip(done, zip(xs, ys, r, homes))])

    placed = points.withColumn("cell", locate("x", "y"))
    own = queries is None
    asked = (placed if own else distinct(queries).withColumn("cell", locate("x", "y"))).select("x", "y", "cell")

    def visit(visits: DataFrame, home: bool) -> DataFrame:
        """Look up `visits(x, y, cell)`; cells with many visitors are split over salts."""
        load = visits.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / CELL_VISITS).cast("int").alias("salts"))
        load = F.broadcast(load)  # one row per cell, at most about MAX_CELLS
        # as many tasks as the session shuffles with: few bytes here mean much arithmetic
        tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        left = visits.join(load, "cell").select(
            *[F.col(c).alias(c) for c in ("x", "y", "cell")],
            F.pmod(F.xxhash64("x", "y"), F.col("salts")).cast("int").alias("salt"))
        right = placed.join(load, "cell").withColumn(
            "salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).drop("salts")

        def look(ask: pd.DataFrame, pts: pd.DataFrame) -> pd.DataFrame:
            near = [[]] * len(ask) if pts.empty else _nearest(ask, pts, k, home, exclude_self and own)
            return pd.DataFrame({"x": ask["x"], "y": ask["y"], "cell": ask["cell"], "near": near})

        left, right = (side.repartition(tasks, "cell", "salt") for side in (left, right))
        return left.groupBy("cell", "salt").cogroup(right.groupBy("cell", "salt")).applyInPandas(
            look, "x double, y double, cell bigint, near array<double>")

    home = written(visit(asked, True))
    radius = F.get("near", F.lit(k - 1))
    away = home.select("x", "y", F.explode(reached("x", "y", radius, F.col("cell"))).alias("cell"))
    found = home.select("x", "y", "near").unionByName(visit(away, False).select("x", "y", "near"))
    scores = found.groupBy("x", "y").agg(
        F.get(F.array_sort(F.flatten(F.collect_list("near"))), F.lit(k - 1)).alias("score"))
    target = (df if own else queries).withColumns({"_x": x, "_y": y})
    scores = scores.withColumnsRenamed({"x": "_x", "y": "_y"})
    return target.join(scores, ["_x", "_y"], "left").drop("_x", "_y")
