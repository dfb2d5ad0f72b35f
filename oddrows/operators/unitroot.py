"""Augmented Dickey-Fuller test with the number of lags chosen by AIC and a p-value."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oddrows.functions.columns import names
from oddrows.functions.lineage import written
from oddrows.functions.ordering import HOT_ROWS, largest_group, row_frames
from oddrows.functions.sizes import with_params
from oddrows.operators.forecast import scaled_inverse
from oddrows.operators.linear import centred, gram, solve_subsets

# Published response surface of the p-value (one series, constant). The polynomial in t gives a normal quantile.
T_MIN, T_STAR, T_MAX = -18.83, -1.61, 2.74
SMALL_P = (2.1659, 1.4412, 0.038269)
LARGE_P = (1.7339, 0.93202, -0.12745, -0.010368)


def p_value(t: float) -> float:
    """Probability of a smaller t statistic under a unit root."""
    if t != t:
        return math.nan
    if t > T_MAX:
        return 1.0
    if t < T_MIN:
        return 0.0
    z = sum(c * t**i for i, c in enumerate(SMALL_P if t <= T_STAR else LARGE_P))
    return 0.5 * math.erfc(-z / math.sqrt(2))


def default_lags(n: int) -> int:
    """Most lags tried for n rows: 12 (n / 100)^(1/4), rounded up, and what n rows allow."""
    return max(0, min(math.ceil(12 * (n / 100) ** 0.25), n // 2 - 2))


def unit_root_search(df: DataFrame, value: str, order_by, series=None, max_lag: int | None = None,
                     hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Per series: used_lag, gamma, std_error, t_stat, p_value, n; a small p speaks against a unit root.

    All numbers of lags up to `max_lag` (by default from the longest series) are judged on the rows that have every lag, from one Gram
    matrix; the one with the lowest AIC is fitted again on all rows that have its lags. Series with too few rows for
    that have a null result."""
    by = names(series)
    top = default_lags(largest_group(df, by)) if max_lag is None else max_lag
    base, w, finish = row_frames(df, names(order_by), by, before=top + 1, hot_rows=hot_rows)
    level = F.lag(value, 1).over(w)
    terms = {"_y": F.col(value) - level, "_level": level}
    terms |= {f"_d{k}": F.lag(value, k).over(w) - F.lag(value, k + 1).over(w) for k in range(1, top + 1)}
    feats = ["_level", *[f"_d{k}" for k in range(1, top + 1)]]
    rows = written(finish(base.withColumns(terms)).select(*by, "_y", *feats))
    fits = solve_subsets(gram(rows, feats, "_y", by), feats, [feats[: k + 1] for k in range(top + 1)], by=by)
    aic = F.col("n") * F.log(F.col("rss") / F.col("n")) + 2 * F.col("model")
    able = fits.filter(F.col("n") > top + 2)
    best = able.groupBy(*by).agg(F.min_by("model", F.struct(aic, "model")).cast("int").alias("used_lag"))
    known = with_params(rows, best, by, "inner") if by else rows.withColumn("used_lag", best.scalar()).filter("used_lag IS NOT NULL")
    # lags beyond the chosen one are zero columns; rows need the chosen lags only
    used = {f"_d{k}": F.when(F.lit(k) <= F.col("used_lag"), F.col(f"_d{k}")).otherwise(F.lit(0.0)) for k in range(1, top + 1)}
    grams = gram(known.withColumns(used), feats, "_y", [*by, "used_lag"])
    size = len(feats) + 1

    @F.pandas_udf("array<double>")
    def solve(ns: pd.Series, lags: pd.Series, cells: pd.Series) -> pd.Series:
        out = []
        for n, lag, flat in zip(ns, lags, cells):
            keep = [*range(lag + 1), size - 1]
            c = centred(flat, size)[np.ix_(keep, keep)]
            inverse = scaled_inverse(c[:-1, :-1])
            b = inverse @ c[:-1, -1]
            free = n - lag - 2
            rss = max(c[-1, -1] - b @ c[:-1, -1], 0.0)
            se = math.sqrt(rss / free * inverse[0, 0]) if free > 0 else math.nan
            t = float(b[0] / se) if se > 0 else math.nan
            out.append([float(b[0]), float(se), t, p_value(t)])
        return pd.Series(out)

    solved = grams.select(*by, "used_lag", "n", solve("n", "used_lag", "cells").alias("r"))
    return solved.select(*by, "used_lag", *[F.col("r")[i].alias(c) for i, c in enumerate(("gamma", "std_error", "t_stat", "p_value"))], "n")
