"""A moving baseline of a score: non-linear regression on what the series did before.

Random Fourier features turn a few standardised columns into many cosines whose inner products come close to a Gaussian kernel,
so a ridge regression on them is a kernel machine of a fixed size: one Gram matrix per fold and kernel width, from which
every penalty is solved and judged on the other folds."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oddrows.functions.columns import hash32, names
from oddrows.functions.ordering import HOT_ROWS, row_frames
from oddrows.operators.linear import apply_linear, cross_validated_ridge, fit_linear

COUNT = 32
STRENGTHS = (1.0, 10.0, 100.0)
GAMMAS = (0.1, 1.0, 10.0)
#: the ridge of strength C is PENALTY / C, relative to the mean of the squares
PENALTY = 0.01


def recent_features(df: DataFrame, score: str, order_by, series=None, lags: int = 3, window: int = 5,
                    hot_rows: int | None = HOT_ROWS) -> tuple[DataFrame, list[str]]:
    """Add the `lags` scores before a row and the mean and deviation of the `window` before it; null without that history."""
    out, w, finish = row_frames(df, names(order_by), series, before=max(lags, window), hot_rows=hot_rows)
    frame = w.rowsBetween(-window, -1)
    full = F.count(score).over(frame) == window
    columns = {f"lag_{k}": F.lag(score, k).over(w) for k in range(1, lags + 1)}
    columns |= {"recent_mean": F.when(full, F.avg(score).over(frame)), "recent_std": F.when(full, F.stddev_samp(score).over(frame))}
    return finish(out.withColumns(columns)), list(columns)


def fourier_weights(dims: int, count: int = COUNT, seed: int = 0) -> tuple[list[list[float]], list[float]]:
    """Standard normal weights (count x dims) and phases, repeatable from hashes."""
    def number(*parts) -> float:
        return (int(hashlib.md5(":".join(map(str, (seed, *parts))).encode()).hexdigest()[:8], 16) + 0.5) / 4294967296.0

    normal = lambda i, j: math.sqrt(-2 * math.log(number("r", i, j))) * math.cos(2 * math.pi * number("a", i, j))
    return [[normal(i, j) for j in range(dims)] for i in range(count)], [2 * math.pi * number("b", i) for i in range(count)]


def with_fourier(df: DataFrame, columns: Sequence[str], scales: dict[str, tuple[float, float]], gamma: float,
                 weights: list[list[float]], phases: list[float]) -> tuple[DataFrame, list[str]]:
    """Add the cosines of a kernel exp(-gamma * distance^2) over the standardised columns."""
    size, width = math.sqrt(2.0 / len(phases)), math.sqrt(2.0 * gamma)
    x = [(F.col(c) - scales[c][0]) / scales[c][1] for c in columns]
    out = df.withColumns({f"_x{j}": v for j, v in enumerate(x)})
    cosines = {}
    for i, (row, phase) in enumerate(zip(weights, phases)):
        inner = F.lit(phase)
        for j, weight in enumerate(row):
            inner = inner + F.lit(width * weight) * F.col(f"_x{j}")
        cosines[f"_z{i}"] = F.lit(size) * F.cos(inner)
    return out.withColumns(cosines).drop(*[f"_x{j}" for j in range(len(x))]), list(cosines)


def column_scales(train: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and deviation of each column over the rows that have all of them (1 where a column does not vary)."""
    row = train.dropna(subset=list(columns)).agg(*[f(c).alias(f"{n}_{c}") for c in columns for n, f in (("m", F.avg), ("s", F.stddev_samp))]).first()
    return {c: (row[f"m_{c}"] or 0.0, row[f"s_{c}"] or 1.0) for c in columns}


def nonlinear_baseline(
    train: DataFrame, test: DataFrame, score: str, columns: Sequence[str], key: str | Sequence[str], folds: int = 5,
    strengths: Sequence[float] = STRENGTHS, gammas: Sequence[float] = GAMMAS, count: int = COUNT, seed: int = 0,
) -> tuple[DataFrame, DataFrame]:
    """Cross-validation table (`strength, gamma, mse`, one row per setting) and `test` with `predicted_score` and
    `relative_score` = score / (predicted + 1) by the best setting; both null where a column is.

    Folds come from a hash of the key."""
    scales = column_scales(train, columns)
    weights, phases = fourier_weights(len(columns), count, seed)
    folded = train.dropna(subset=[score, *columns]).withColumn("_fold", hash32(seed, *names(key)) % folds)
    table = None
    for gamma in gammas:
        rows, z = with_fourier(folded, columns, scales, gamma, weights, phases)
        judged = cross_validated_ridge(rows, z, score, "_fold", [PENALTY / c for c in strengths]).select(
            (PENALTY / F.col("ridge")).alias("strength"), F.lit(float(gamma)).alias("gamma"), "mse")
        table = judged if table is None else table.unionByName(judged)
    best = table.orderBy("mse", "strength", "gamma").first()  # one of a few settings
    rows, z = with_fourier(folded, columns, scales, best["gamma"], weights, phases)
    model = fit_linear(rows, z, score, ridge=PENALTY / best["strength"])
    out = apply_linear(with_fourier(test, columns, scales, best["gamma"], weights, phases)[0], model, z, to="predicted_score").drop(*z)
    return table, out.withColumn("relative_score", F.try_divide(score, F.col("predicted_score") + 1))
