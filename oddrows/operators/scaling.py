"""Scaling with fitted parameters, detrending, noise copies, feature arrays."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oddrows.functions.columns import clean, gaussian, names, scalar
from oddrows.functions.ordering import HOT_ROWS, with_position
from oddrows.functions.sizes import with_params


def zscore_fit(train: DataFrame, columns: str | Sequence[str], series=None, ddof: int = 0) -> DataFrame:
    """Mean and std per column (`<c>_mean`, `<c>_std`); ddof 0 = population, 1 = sample.
    A zero std is stored as 1."""
    std = F.stddev_pop if ddof == 0 else F.stddev_samp
    aggs = []
    for c in names(columns):
        s = std(c)
        aggs += [F.avg(c).alias(f"{c}_mean"), F.when(s == 0, F.lit(1.0)).otherwise(s).alias(f"{c}_std")]
    return train.groupBy(*names(series)).agg(*aggs)


def _with_params(df: DataFrame, params: DataFrame, series) -> tuple[DataFrame, Column]:
    by = names(series)
    if not by:
        return df.withColumn("_p", scalar(params)), F.col("_p")
    packed = params.select(*by, F.struct(*[c for c in params.columns if c not in by]).alias("_p"))
    return with_params(df, packed, by), F.col("_p")


def zscore_apply(df: DataFrame, params: DataFrame, columns: str | Sequence[str], series=None, suffix: str = "") -> DataFrame:
    out, p = _with_params(df, params, series)
    return out.withColumns({f"{c}{suffix}": (F.col(c) - p[f"{c}_mean"]) / p[f"{c}_std"]
                            for c in names(columns)}).drop("_p")


def inverse_scale(df: DataFrame, params: DataFrame, columns: str | Sequence[str], series=None, suffix: str = "") -> DataFrame:
    """x * std + mean; `columns` names the scaled columns by their original name."""
    out, p = _with_params(df, params, series)
    return out.withColumns({f"{c}{suffix}": F.col(c) * p[f"{c}_std"] + p[f"{c}_mean"]
                            for c in names(columns)}).drop("_p")


def minmax_fit(train: DataFrame, columns: str | Sequence[str], series=None) -> DataFrame:
    return train.groupBy(*names(series)).agg(
        *[a for c in names(columns) for a in (F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max"))])


def minmax_apply(df: DataFrame, params: DataFrame, columns: str | Sequence[str], series=None, suffix: str = "") -> DataFrame:
    out, p = _with_params(df, params, series)
    return out.withColumns({
        f"{c}{suffix}": F.try_divide(F.col(c) - p[f"{c}_min"], p[f"{c}_max"] - p[f"{c}_min"])
        for c in names(columns)}).drop("_p")


def seasonal_detrend(days: DataFrame, date: str, value: str, train: Column, first_day: str | None = None) -> DataFrame:
    """(value - weekday mean of the `train` rows) / sample std of all rows.

    Adds `dow`, `trend`, `std` and `detrended`. The trend has one row per weekday, so it is
    packed into a scalar subquery instead of joined. `first_day` leaves out earlier days."""
    if first_day is not None:
        days = days.filter(F.col(date) >= F.lit(first_day).cast("date"))
    keyed = days.withColumn("dow", F.weekday(date))
    means = keyed.filter(train).groupBy("dow").agg(F.avg(value).alias("mean"))
    table = means.agg(F.map_from_entries(F.collect_list(F.struct("dow", "mean")))).scalar()
    spread = keyed.agg(F.stddev_samp(value)).scalar()
    out = keyed.withColumns({"trend": F.try_element_at(table, F.col("dow")), "std": spread})
    return out.withColumn("detrended", F.try_divide(F.col(value) - F.col("trend"), F.col("std")))


def noise_augment(
    df: DataFrame, columns: Sequence[str], order_by: str | Sequence[str], params: DataFrame, copies: int = 100,
    noise_ratio: float = 0.05, max_rows: int | None = None, seed: int = 0, one_level: bool = False,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """The series followed by noisy copies of it. `max_rows` stops copies at that many rows, if given;
    the series itself is always whole.

    Copy i adds gaussian noise of `noise_ratio * i / copies` stds (`one_level`: the full ratio
    in every copy). `params` holds `<c>_std`. Copies are made by explode, the place of a row in
    the result is copy * n + position, and the noise is a hash of position and copy."""
    placed = with_position(df, names(order_by), None, "_p", hot_rows)
    total = df.agg(F.count(F.lit(1))).scalar()
    needed = F.lit(copies) if max_rows is None else F.least(F.lit(copies), F.floor(F.lit(max_rows) / F.col("_n")).cast("int"))
    out = placed.withColumns({"_n": total, "_q": scalar(params)}).withColumn(
        "copy", F.explode(F.sequence(F.lit(0), needed)))
    out = out.withColumn("row", F.col("copy") * F.col("_n") + F.col("_p"))
    if max_rows is not None:
        out = out.filter((F.col("row") < max_rows) | (F.col("copy") == 0))
    level = F.lit(noise_ratio) if one_level else F.lit(noise_ratio) * F.col("copy") / copies
    noisy = {}
    for i, c in enumerate(columns):
        noise = level * F.col("_q")[f"{c}_std"] * gaussian(seed, i, "copy", "_p")
        noisy[c] = F.when(F.col("copy") == 0, F.col(c)).otherwise(F.col(c) + noise)
    return out.withColumns(noisy).drop("_p", "_n", "_q")


def assemble_features(df: DataFrame, columns: Sequence[str], to: str = "features") -> DataFrame:
    """Columns to one array<double>; NaN and infinities become null."""
    return df.withColumn(to, F.array(*[clean(F.col(c)) for c in columns]))
