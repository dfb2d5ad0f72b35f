"""Forecast residuals and residual scores. The models are linear: they share the contract of
the networks they stand for (fit on normal history, score by error), not their accuracy."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oddrows.functions.columns import hash32, names, scalar
from oddrows.functions.ordering import HOT_ROWS, row_frames, settle
from oddrows.functions.sizes import with_params
from oddrows.operators.linear import (
    apply_linear, centred, cross_validated_ridge, fit_linear, gram, solve_subsets,
)
from oddrows.operators.scaling import seasonal_detrend
from oddrows.operators.sequence import difference, lag_matrix


def seasonal_forecast_residual(days: DataFrame, date: str, value: str, train: Column) -> DataFrame:
    """Actual minus the weekday trend of the training years: adds trend, std, detrended, residual."""
    return seasonal_detrend(days, date, value, train).withColumn("residual", F.col(value) - F.col("trend"))


def _lag_names(value: str, lags: Sequence[int]) -> list[str]:
    return [f"{value}_lag_{k}" for k in lags]


def with_lags(df: DataFrame, value: str, lags: Sequence[int], order_by, series=None,
              hot_rows: int | None = HOT_ROWS) -> DataFrame:
    return lag_matrix(df, value, list(lags), order_by, series, hot_rows=hot_rows)


def fit_ar(df: DataFrame, value: str, order: int | Sequence[int], order_by, series=None,
           ridge: float = 0.0, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Linear autoregression on the `order` previous values (or the listed lags), one model over
    all rows or one per series: lag columns, one Gram aggregate, one small solve per series."""
    lags = range(1, order + 1) if isinstance(order, int) else order
    return fit_linear(with_lags(df, value, lags, order_by, series, hot_rows), _lag_names(value, lags), value, series, ridge)


def ar_forecast(df: DataFrame, params: DataFrame, value: str, order: int | Sequence[int], order_by, series=None,
                hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """One-step predictions and residuals of a fitted autoregression."""
    lags = range(1, order + 1) if isinstance(order, int) else order
    lagged = with_lags(df, value, lags, order_by, series, hot_rows)
    out = apply_linear(lagged, params, _lag_names(value, lags), series)
    return out.withColumn("residual", F.col(value) - F.col("predicted")).drop(*_lag_names(value, lags))


def seasonal_candidates(orders: Sequence[int], seasonal: Sequence[int], period: int) -> list[tuple[int, int, list[int]]]:
    """(p, P, lags) of every combination: lags 1..p and the seasonal lags 1..P times the period."""
    return [(p, q, [*range(1, p + 1), *[period * s for s in range(1, q + 1)]]) for p, q in product(orders, seasonal)]


def seasonal_ar_table(
    df: DataFrame, value: str, order_by, series=None, orders: Sequence[int] = (0, 1, 2),
    seasonal: Sequence[int] = (0, 1, 2), period: int = 12, hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """AIC of every candidate on the differenced series (lag 1, then the period): one row per
    series and candidate with `ar_order, seasonal_order, coef, rss, n, aic`. All candidates share one Gram matrix and
    hence the same rows; AIC = n ln(rss / n) + 2 k with k coefficients."""
    chosen = seasonal_candidates(orders, seasonal, period)
    lags = sorted({lag for _, _, ls in chosen for lag in ls})
    hot_rows = settle(df, series, hot_rows)
    diffs = difference(df, value, order_by, series, 1, period, "_d", hot_rows)
    feats = _lag_names("_d", lags)
    grams = gram(with_lags(diffs, "_d", lags, order_by, series, hot_rows), feats, "_d", series)
    fits = solve_subsets(grams, feats, [_lag_names("_d", ls) for _, _, ls in chosen], by=series)
    pick = lambda values: F.element_at(F.array(*[F.lit(v) for v in values]), F.col("model") + 1)
    n = F.col("n").cast("double")
    k = pick([len(ls) + 1 for _, _, ls in chosen])
    return fits.select(
        *names(series), pick([p for p, _, _ in chosen]).alias("ar_order"), pick([q for _, q, _ in chosen]).alias("seasonal_order"),
        "coef", "rss", "n", (n * F.log(F.col("rss") / n) + 2 * k).alias("aic"))


def seasonal_ar_select(table: DataFrame, series=None) -> DataFrame:
    """The candidate with the lowest AIC per series (smallest order on ties)."""
    best = F.min_by(F.struct("ar_order", "seasonal_order", "coef", "rss", "n", "aic"), F.struct("aic", "ar_order", "seasonal_order"))
    return table.groupBy(*names(series)).agg(best.alias("b")).select(*names(series), "b.*")


def seasonal_ar_predict(
    df: DataFrame, selected: DataFrame, value: str, order_by, series=None, orders: Sequence[int] = (0, 1, 2),
    seasonal: Sequence[int] = (0, 1, 2), period: int = 12, hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """One-step predictions on the original scale: forecast of the difference plus the values it
    is taken against; 0 where the history is too short."""
    lags = sorted({lag for _, _, ls in seasonal_candidates(orders, seasonal, period) for lag in ls})
    hot_rows = settle(df, series, hot_rows)
    out = difference(df, value, order_by, series, 1, period, "_d", hot_rows)
    out = with_lags(out, "_d", lags, order_by, series, hot_rows)
    out = out.withColumn("_base", F.col(value) - F.col("_d"))
    feats = _lag_names("_d", lags)
    out = apply_linear(out, selected, feats, series, "_step")
    return out.withColumn("predict", F.coalesce(F.col("_base") + F.col("_step"), F.lit(0.0))).drop(
        "_d", "_base", "_step", *feats)


def scaled_inverse(a: np.ndarray) -> np.ndarray:
    """(Pseudo-)inverse of a symmetric matrix whose columns may differ much in size."""
    size = np.sqrt(np.diag(a))
    size = np.where(size > 0, size, 1.0)
    outer = np.outer(size, size)
    return np.linalg.pinv(a / outer) / outer


def gaussian_score(df: DataFrame, params: DataFrame, errors: Sequence[str], by=None, ridge: float = 1e-9) -> DataFrame:
    """Squared Mahalanobis distance of the error vector to the training errors.

    `params` is the table of `error_mean_cov`, one row per channel; the small matrices are
    inverted where that table lies and joined to the rows."""
    d, groups = len(errors), names(by)

    @F.pandas_udf("array<double>")
    def inverse(covs: pd.Series) -> pd.Series:
        out = []
        for flat in covs:
            cov = np.asarray(flat, dtype=float).reshape(d, d)
            if not np.isfinite(cov).all():
                out.append(None)  # fewer than two training rows
                continue
            lift = ridge * max(float(np.trace(cov)) / d, 1e-300)
            out.append(scaled_inverse(cov + lift * np.eye(d)).ravel())
        return pd.Series(out)

    model = params.select(*groups, F.col("mean").alias("_mean"), inverse("cov").alias("_inv"))
    if groups:
        out = with_params(df, model, groups)
    else:
        out = df.withColumn("_s", scalar(model)).select(
            *df.columns, F.col("_s._mean").alias("_mean"), F.col("_s._inv").alias("_inv"))
    total = F.lit(0.0)
    c = [F.col(e) - F.col("_mean")[i] for i, e in enumerate(errors)]
    for i in range(d):
        for j in range(d):
            total = total + c[i] * F.col("_inv")[i * d + j] * c[j]
    return out.withColumn("score", total).drop("_mean", "_inv")


def adaptive_threshold(
    train: DataFrame, test: DataFrame, score: str, features: Sequence[str], key: str | Sequence[str],
    folds: int = 5, ridges: Sequence[float] = (0.0, 1e-3, 1e-1), seed: int = 0,
) -> tuple[DataFrame, DataFrame]:
    """Regress the score on features of the series and score relative to the prediction.

    Returns the cross-validation table (`ridge, mse`) and `test` with `predicted_score` and
    `relative_score` = score / (predicted + 1). Folds come from a hash of the key."""
    folded = train.withColumn("_fold", hash32(seed, *names(key)) % folds)
    table = cross_validated_ridge(folded, features, score, "_fold", ridges)
    best = table.orderBy("mse", "ridge").first()["ridge"]
    model = fit_linear(train, features, score, ridge=best)
    out = apply_linear(test, model, features, to="predicted_score")
    return table, out.withColumn("relative_score", F.try_divide(score, F.col("predicted_score") + 1))


def unit_root_test(
    df: DataFrame, value: str, order_by, series=None, lags: int = 0, hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Augmented Dickey-Fuller regression with constant: `gamma, std_error, t_stat, n` per series,
    with the large-sample critical values; t below them speaks against a unit root."""
    # Large-sample critical values of the constant-only test.
    critical = {"crit_1": -3.43, "crit_5": -2.86, "crit_10": -2.57}
    by = names(series)
    base, w, finish = row_frames(df, names(order_by), by, before=lags + 1, hot_rows=hot_rows)
    level = F.lag(value, 1).over(w)
    terms = {"_y": F.col(value) - level, "_level": level}
    for k in range(1, lags + 1):
        terms[f"_d{k}"] = F.lag(value, k).over(w) - F.lag(value, k + 1).over(w)
    feats = ["_level", *[f"_d{k}" for k in range(1, lags + 1)]]
    size = len(feats) + 1
    grams = gram(finish(base.withColumns(terms)), feats, "_y", by)

    @F.pandas_udf("array<double>")
    def solve(ns: pd.Series, cells: pd.Series) -> pd.Series:
        rows = []
        for n, flat in zip(ns, cells):
            c = centred(flat, size)
            inverse = scaled_inverse(c[:-1, :-1])
            b = inverse @ c[:-1, -1]
            free = n - size
            rss = max(c[-1, -1] - b @ c[:-1, -1], 0.0)
            se = np.sqrt(rss / free * inverse[0, 0]) if free > 0 else np.nan
            rows.append([float(b[0]), float(se), float(b[0] / se) if se > 0 else np.nan])
        return pd.Series(rows)

    out = grams.select(*by, "n", solve("n", "cells").alias("r"))
    return out.select(*by, F.col("r")[0].alias("gamma"), F.col("r")[1].alias("std_error"),
                      F.col("r")[2].alias("t_stat"), "n", *[F.lit(v).alias(k) for k, v in critical.items()])
