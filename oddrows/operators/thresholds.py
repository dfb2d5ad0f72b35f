"""Fences, thresholds and bands: turn values or scores into flags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oddrows.functions.columns import clean, names, scalar
from oddrows.functions.ordering import HOT_ROWS
from oddrows.functions.quantiles import quantile_table, quantiles
from oddrows.functions.sizes import with_params
from oddrows.operators.sequence import rolling_mean_std

# Severity and sign of an error by the number of bands below it.
SEVERITY_BY_RANK = {0: 3, 1: 2, 2: 1, 3: 0, 4: 0, 5: 1, 6: 2, 7: 3}
REGION_BY_RANK = {
    0: "NEGATIVE", 1: "NEGATIVE", 2: "NEGATIVE", 3: "NEGATIVE",
    4: "POSITIVE", 5: "POSITIVE", 6: "POSITIVE", 7: "POSITIVE",
}


def fit_iqr_fence(df: DataFrame, columns: str | Sequence[str], by=None, reach: float = 1.5) -> DataFrame:
    """Fences per column (and group): `column, lower, upper`."""
    q = quantile_table(df, columns, (0.25, 0.75), by)
    iqr = F.col("q_1") - F.col("q_0")
    return q.select(*names(by), "column", (F.col("q_0") - reach * iqr).alias("lower"),
                    (F.col("q_1") + reach * iqr).alias("upper"))


def score_iqr_fence(df: DataFrame, fences: DataFrame, columns: str | Sequence[str], by=None) -> DataFrame:
    """`<c>_outlier` per column; `score` is how far outside the fences a row lies (largest
    column), `is_outlier` whether any column is outside."""
    cols, groups = names(columns), names(by)
    packed = F.map_from_entries(F.collect_list(F.struct(
        "column", F.struct("lower", "upper").alias("f"))))  # one entry per column
    if groups:
        out = with_params(df, fences.groupBy(*groups).agg(packed.alias("_f")), groups)
    else:
        out = df.withColumn("_f", fences.agg(packed).scalar())
    over, flags = [], {}
    for c in cols:
        f = F.col("_f")[c]
        over.append(F.greatest(f["lower"] - F.col(c), F.col(c) - f["upper"], F.lit(0.0)))
        flags[f"{c}_outlier"] = ((F.col(c) < f["lower"]) | (F.col(c) > f["upper"])).cast("int")
    score = over[0] if len(over) == 1 else F.greatest(*over)
    hit = flags[f"{cols[0]}_outlier"] if len(cols) == 1 else F.greatest(*flags.values())
    return out.withColumns({**flags, "score": score, "is_outlier": hit}).drop("_f")


def fit_contamination(scores: DataFrame, score: str, contamination: float) -> DataFrame:
    """Threshold at the (1 - contamination) quantile of the training scores.

    The scores are read several times: pass a written table when they are costly."""
    return quantiles(scores, score, [1.0 - contamination]).select(F.col("value").alias("threshold"))


def fit_three_sigma(train: DataFrame, error: str, sigmas: float = 3.0) -> DataFrame:
    """Mean + 3 sample stds of the training errors."""
    return train.agg((F.avg(error) + sigmas * F.stddev_samp(error)).alias("threshold"))


def flag_above(df: DataFrame, threshold: DataFrame | float, score: str = "score", flag: str = "is_outlier") -> DataFrame:
    """1 where the score lies above the threshold (a number or a one-row table)."""
    limit = F.lit(threshold) if isinstance(threshold, (int, float)) else threshold.select("threshold").scalar()
    return df.withColumn(flag, (F.col(score) > limit).cast("int"))


def rolling_error_bands(
    df: DataFrame, window: int = 7, date: str = "date", series=None,
    multipliers: Sequence[float] = (2.0, 1.75, 1.5), missing_is_severe: bool = False,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Error bands of a forecast: columns `actuals` and `predicted` per `date`.

    Adds error, percentage_change, trailing mean and std of the error, six bands
    (`low_1..3`, `high_1..3`, widest first), `impact` (number of bands below the error),
    `color` (severity 0-3), `region` (sign) and `anomaly_points`. Missing inputs count as 0.
    Until the window is full, severity is null; with no deviation it is 0. `missing_is_severe`
    gives severity 3 in both cases, as comparing against missing or equal bands would."""
    value = lambda c: F.coalesce(clean(F.col(c)), F.lit(0.0))
    out = df.withColumns({"actuals": value("actuals"), "predicted": value("predicted")})
    error = F.col("actuals") - F.col("predicted")
    out = out.withColumns({"error": error, "percentage_change": F.try_divide(error, F.col("actuals")) * 100})
    out = rolling_mean_std(out, "error", window, [date], series, hot_rows=hot_rows)
    m, d = F.col("meanval"), F.col("deviation")
    lows = {f"low_{i + 1}": m - k * d for i, k in enumerate(multipliers)}
    highs = {f"high_{i + 1}": m + k * d for i, k in enumerate(multipliers)}
    out = out.withColumns(lows | highs)
    bands = [F.col(c) for c in (*lows, "meanval", *highs)]
    rank = sum(((b < F.col("error")).cast("int") for b in bands), F.lit(0))
    flat = d == 0
    if missing_is_severe:
        impact = F.when(d.isNull() | flat, 0).otherwise(rank)
    else:
        impact = F.when(d.isNull(), None).when(flat, 3).otherwise(rank)
    pick = lambda codes: F.when(F.col("impact").isNotNull(), F.element_at(
        F.array(*[F.lit(codes[i]) for i in range(8)]), F.col("impact") + 1))
    return out.withColumn("impact", impact).withColumns({
        "color": pick(SEVERITY_BY_RANK), "region": pick(REGION_BY_RANK),
    }).withColumn("anomaly_points", F.when(F.col("color") == 3, F.col("error")))


def outside(value: Column, lower: Column, upper: Column) -> Column:
    return ((value < lower) | (value > upper)).cast("int")
