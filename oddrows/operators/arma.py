"""Seasonal ARMA models of a differenced series by two stages of least squares.

A long autoregression gives the innovations first; then every candidate is a regression on lags of the series and lags of the
innovations, and all candidates share one Gram matrix. A fitted model's own residuals follow from a linear recursion, which
runs as a scan: pieces of a series are worked through apart, and a piece's start is carried on by a small matrix."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oddrows.functions.columns import names
from oddrows.functions.lineage import written
from oddrows.functions.ordering import HOT_ROWS, fits_one_task, settle, sorted_run
from oddrows.functions.sizes import join_groups, with_params
from oddrows.operators.linear import apply_linear, fit_linear, gram, linear_value, solve_subsets
from oddrows.operators.sequence import difference, lag_matrix

#: orders of the full grid: autoregressive, moving-average, seasonal autoregressive, seasonal moving-average
GRID = (range(3), range(3), range(3), range(2))
PERIOD = 12
ORDER = ["p", "q", "sp", "sq"]
#: innovation coefficients whose sizes sum to less keep the recursion of the residuals from growing
STABLE = 0.999


def candidates(grid=GRID, period: int = PERIOD) -> list[tuple[tuple[int, int, int, int], list[int], list[int]]]:
    """((p, q, sp, sq), lags of the series, lags of the innovations) of every combination."""
    out = []
    for p, q, sp, sq in product(*grid):
        out.append(((p, q, sp, sq), [*range(1, p + 1), *[period * s for s in range(1, sp + 1)]],
                    [*range(1, q + 1), *[period * s for s in range(1, sq + 1)]]))
    return out


def _all_lags(grid, period: int) -> tuple[list[int], list[int]]:
    every = candidates(grid, period)
    return sorted({k for _, a, _ in every for k in a}), sorted({k for _, _, b in every for k in b})


def _features(own: Sequence[int], shocks: Sequence[int]) -> list[str]:
    return [*[f"_d_{k}" for k in own], *[f"_e_{k}" for k in shocks]]


def innovations(df: DataFrame, value: str, order_by, series=None, period: int = PERIOD, long_order: int | None = None,
                hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Add `_d`, the series differenced at lag 1 and the period, and `_e`, what a long autoregression leaves of it."""
    lags = range(1, (long_order or 2 * period + 2) + 1)
    out = difference(df, value, order_by, series, 1, period, "_d", hot_rows)
    lagged = lag_matrix(out, "_d", list(lags), order_by, series, prefix="_l", hot_rows=hot_rows)
    feats = [f"_l_{k}" for k in lags]
    params = written(fit_linear(lagged, feats, "_d", series))
    return apply_linear(lagged, params, feats, series, "_e").withColumn("_e", F.col("_d") - F.col("_e")).drop(*feats)


def arma_table(df: DataFrame, value: str, order_by, series=None, grid=GRID, period: int = PERIOD, long_order: int | None = None,
               hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """One row per series and candidate: p, q, sp, sq, coef, rss, n, aic = n ln(rss / n) + 2 k with k coefficients.

    `coef` holds the intercept, the series' lags and the innovations' lags of the whole grid; zeros for those left out."""
    hot_rows = settle(df, series, hot_rows)
    own, shocks = _all_lags(grid, period)
    rows = written(innovations(df, value, order_by, series, period, long_order, hot_rows))
    rows = lag_matrix(rows, "_d", own, order_by, series, prefix="_d", hot_rows=hot_rows) if own else rows
    rows = lag_matrix(rows, "_e", shocks, order_by, series, prefix="_e", hot_rows=hot_rows) if shocks else rows
    feats, every = _features(own, shocks), candidates(grid, period)
    fits = solve_subsets(gram(rows, feats, "_d", series), feats, [_features(a, b) for _, a, b in every], by=series)
    pick = lambda values: F.element_at(F.array(*[F.lit(v) for v in values]), F.col("model") + 1)
    n, k = F.col("n").cast("double"), pick([len(a) + len(b) + 1 for _, a, b in every])
    orders = [pick([o[i] for o, _, _ in every]).alias(c) for i, c in enumerate(ORDER)]
    moving = F.aggregate(F.slice("coef", len(own) + 2, max(len(shocks), 1)), F.lit(0.0), lambda acc, c: acc + F.abs(c)).alias("moving")
    return fits.select(*names(series), *orders, "coef", "rss", "n", (n * F.log(F.col("rss") / n) + 2 * k).alias("aic"), moving)


def arma_select(table: DataFrame, series=None) -> DataFrame:
    """The candidate with the lowest AIC per series (smallest orders on ties) out of those whose residual recursion is sure to
    be stable: the sizes of their innovation coefficients (`moving`) sum to less than `STABLE`."""
    best = F.min_by(F.struct(*ORDER, "coef", "rss", "n", "aic"), F.struct("aic", *ORDER))
    return table.filter(F.col("moving") < STABLE).groupBy(*names(series)).agg(best.alias("b")).select(*names(series), "b.*")


def arma_refit(df: DataFrame, selected: DataFrame, value: str, order_by, series=None, grid=GRID, period: int = PERIOD,
               long_order: int | None = None, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """The orders of `selected` (one row per series) fitted to other rows of the same series."""
    table = arma_table(df, value, order_by, series, grid, period, long_order, hot_rows)
    wanted = selected.select(*names(series), F.struct(*ORDER).alias("_wanted"))
    both = with_params(table, wanted, series, "inner") if names(series) else table.withColumn("_wanted", wanted.select("_wanted").scalar())
    return both.filter(F.struct(*ORDER) == F.col("_wanted")).drop("_wanted")


def _run_on(u: np.ndarray, theta: dict[int, float], state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """e[t] = u[t] - sum of theta[k] * e[t - k], from the residuals `state` (the last one first); an unknown u leaves 0."""
    past, out = list(state[::-1]), []
    depth = len(past)
    for x in u.tolist():
        e = 0.0 if x != x else x - sum(c * past[len(past) - k] for k, c in theta.items())
        past.append(e)
        out.append(e)
    return np.array(out), np.array(past[::-1][:depth])


def recursion(df: DataFrame, u: str, theta: str, lags: Sequence[int], order_by, series=None, to: str = "e",
              hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Add `to` with e[t] = u[t] - sum of theta[i] * e[t - lags[i]] in each series; e is 0 before the first row and where u is null.

    A series that fits a task is one piece. Longer ones are range-partitioned: each piece first runs from zeros; as the
    recursion is linear, a piece turns the residuals before it into those at its end by a matrix of its own, and
    chaining these few numbers per piece gives every piece its true start for the second run."""
    by, order, depth = names(series), names(order_by), max(lags)
    split = not fits_one_task(df, by, hot_rows)
    rows = sorted_run(df, [*by, *order]) if split else df.withColumns({"_run": F.lit(0).cast("bigint"), "_off": F.lit(0).cast("bigint")})
    sort = [(c, "ascending") for c in (["_off"] if split else order)]
    width, columns = range(len(lags)), df.columns

    def coefficients(table: pa.Table) -> dict[int, float]:
        own = table.column(theta)[0].as_py()
        return {lags[i]: own[i] for i in width if own and own[i]}

    def ends(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by(sort)
        c, x = coefficients(table), table.column(u).to_numpy().astype(float)
        local = _run_on(x, c, np.zeros(depth))[1]
        known = np.where(np.isnan(x), np.nan, 0.0)  # the same piece without input: what each earlier residual adds
        carry = np.column_stack([_run_on(known, c, unit)[1] for unit in np.eye(depth)])
        return pa.table({**{k: table.column(k).slice(0, 1) for k in by}, "_run": table.column("_run").slice(0, 1),
                         "local": pa.array([local.tolist()]), "carry": pa.array([carry.ravel().tolist()])})

    def chain(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("_run")
        state, starts = np.zeros(depth), []
        for local, carry in zip(table.column("local").to_pylist(), table.column("carry").to_pylist()):
            starts.append(state.tolist())
            state = np.array(local) + np.array(carry).reshape(depth, depth) @ state
        return table.select([*by, "_run"]).append_column("start", pa.array(starts))

    typed = lambda *extra: rows.select(*by, "_run", *extra).schema
    none = F.lit(None).cast("array<double>")
    if split:
        ended = written(rows.select(*by, "_run", "_off", u, theta).groupBy(*by, "_run").applyInArrow(ends, typed(none.alias("local"), none.alias("carry"))))
        keyed = ended if by else ended.withColumn("_all", F.lit(0))
        starts = keyed.groupBy(*(by or ["_all"])).applyInArrow(chain, typed(none.alias("start")))
        rows = join_groups(rows, starts, [*by, "_run"])
    else:
        rows = rows.withColumn("start", F.array(*[F.lit(0.0)] * depth))

    def run(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by(sort)
        e = _run_on(table.column(u).to_numpy().astype(float), coefficients(table), np.array(table.column("start")[0].as_py()))[0]
        return table.select(columns).append_column(to, pa.array(e))

    return rows.groupBy(*by, "_run").applyInArrow(run, rows.select(*columns, F.lit(0.0).alias(to)).schema)


def arma_predict(df: DataFrame, fitted: DataFrame, value: str, order_by, series=None, grid=GRID, period: int = PERIOD,
                 hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Add `predict`, the one-step prediction on the original scale from a fitted row per series, 0 where the history is too short.

    The innovations are the model's own residuals, 0 before the first row that has all lags. A refit whose innovation
    coefficients sum to `STABLE` or more is scaled down to it, so errors die out."""
    hot_rows = settle(df, series, hot_rows)
    own, shocks = _all_lags(grid, period)
    rows = difference(df, value, order_by, series, 1, period, "_d", hot_rows)
    rows = lag_matrix(rows, "_d", own, order_by, series, prefix="_d", hot_rows=hot_rows)
    params = fitted.select(*names(series), F.col("coef").alias("_coef"))
    rows = with_params(rows, params, series) if names(series) else rows.withColumn("_coef", params.scalar())
    rows = rows.withColumn("_u", F.col("_d") - linear_value(F.col("_coef"), [f"_d_{k}" for k in own]))
    theta = F.slice("_coef", len(own) + 2, len(shocks))
    moving = F.aggregate(theta, F.lit(0.0), lambda acc, c: acc + F.abs(c))
    scale = F.when(moving > STABLE, STABLE / moving).otherwise(F.lit(1.0))
    rows = rows.withColumn("_theta", F.transform(theta, lambda c: c * scale)).drop("_coef", *[f"_d_{k}" for k in own])
    out = recursion(rows, "_u", "_theta", shocks, order_by, series, "_shock", hot_rows)
    predict = F.when(F.col("_u").isNotNull(), F.col(value) - F.col("_shock"))
    return out.withColumn("predict", F.coalesce(predict, F.lit(0.0))).drop("_d", "_u", "_theta", "_shock")
