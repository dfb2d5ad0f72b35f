"""Operators that need row order: lags, windows, chunks, splits, curves, islands.

Every operator takes an explicit order. `hot_rows` bounds the rows of one series a single
task sorts; pass None only where the series length has another bound."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oddrows.functions.columns import hash32, names, uniform
from oddrows.functions.ordering import (
    HOT_ROWS, prefix_sums, row_frames, settle, with_position, with_series_size,
)
from oddrows.functions.quantiles import quantiles
from oddrows.functions.sizes import with_params


def lag_matrix(
    df: DataFrame, column: str, lags: Sequence[int], order_by: str | Sequence[str], series=None,
    prefix: str | None = None, hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Columns `<prefix>_<k>` with the value k rows earlier (0 is the row itself)."""
    out, w, finish = row_frames(df, names(order_by), series, before=max(lags), hot_rows=hot_rows)
    tag = prefix or f"{column}_lag"
    return finish(out.withColumns({f"{tag}_{k}": F.lag(column, k).over(w) for k in lags}))


def lead_target(
    df: DataFrame, columns: Mapping[str, str], order_by: str | Sequence[str], series=None, steps: int = 1,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """New columns with the value `steps` rows later: `{new: column}`."""
    out, w, finish = row_frames(df, names(order_by), series, after=steps, hot_rows=hot_rows)
    return finish(out.withColumns({new: F.lead(c, steps).over(w) for new, c in columns.items()}))


def rolling_mean_std(
    df: DataFrame, column: str, window: int, order_by: str | Sequence[str], series=None,
    mean: str = "meanval", std: str = "deviation", hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Trailing mean and sample std over `window` rows, null until the window is full."""
    out, w, finish = row_frames(df, names(order_by), series, before=window - 1, hot_rows=hot_rows)
    frame = w.rowsBetween(-(window - 1), 0)
    full = F.count(column).over(frame) == window
    return finish(out.withColumns({
        mean: F.when(full, F.avg(column).over(frame)),
        std: F.when(full, F.stddev_samp(column).over(frame)),
    }))


def sliding_windows(
    df: DataFrame, column: str, size: int, order_by: str | Sequence[str], series=None, step: int = 1,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Windows of size + 1 rows every `step` rows: array `inputs` and the last value `target`."""
    hot_rows = settle(df, series, hot_rows)
    placed = with_position(df, names(order_by), series, "pos", hot_rows)
    out, w, finish = row_frames(placed, "pos", series, after=size, hot_rows=hot_rows, placed=True)
    block = F.collect_list(F.struct(F.col(column).alias("v"))).over(w.rowsBetween(0, size))
    out = finish(out.withColumn("_w", block)).filter((F.size("_w") == size + 1) & (F.col("pos") % step == 0))
    values = F.transform("_w", lambda s: s["v"])
    return out.withColumns({"inputs": F.slice(values, 1, size), "target": values[size]}).drop("_w")


def tumbling_chunks(
    df: DataFrame, column: str, size: int, order_by: str | Sequence[str], series=None,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Non-overlapping chunks of `size` rows as arrays; the remainder is dropped."""
    by = names(series)
    placed = with_position(df, names(order_by), series, "pos", hot_rows)
    parts = F.sort_array(F.collect_list(F.struct("pos", F.col(column).alias("v"))))
    return (
        placed.groupBy(*by, F.floor(F.col("pos") / size).alias("chunk")).agg(parts.alias("_p"))
        .filter(F.size("_p") == size)
        .select(*by, "chunk", F.transform("_p", lambda s: s["v"]).alias("values"))
    )


def segment_series(
    df: DataFrame, segments: int, order_by: str | Sequence[str], series=None, hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Cut a series into `segments` equal contiguous parts, the remainder trimmed: adds
    `segment` and `pos` (place inside the segment)."""
    placed = with_series_size(with_position(df, names(order_by), series, "_p", hot_rows), series, "_n")
    length = F.floor(F.col("_n") / segments)
    return placed.filter(F.col("_p") < length * segments).withColumns({
        "segment": F.floor(F.col("_p") / length), "pos": F.col("_p") % length}).drop("_p", "_n")


def shifted_chunks(
    df: DataFrame, column: str, size: int, order_by: str | Sequence[str], series=None,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Chunk number, input and next value as target; the last row has no target and is left out."""
    hot_rows = settle(df, series, hot_rows)
    placed = with_position(df, names(order_by), series, "pos", hot_rows)
    out, w, finish = row_frames(placed, "pos", series, after=1, hot_rows=hot_rows, placed=True)
    out = out.withColumns({"input": F.col(column), "target": F.lead(column, 1).over(w),
                           "_next": F.lead("pos", 1).over(w)})
    return finish(out).filter(F.col("_next").isNotNull()).withColumn(
        "chunk", F.floor(F.col("pos") / size)).drop("_next")


def trim_ends(
    df: DataFrame, first: int, last: int, order_by: str | Sequence[str], series=None,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Drop the first `first` and the last `last` rows of every series."""
    placed = with_series_size(with_position(df, names(order_by), series, "_p", hot_rows), series, "_n")
    return placed.filter((F.col("_p") >= first) & (F.col("_p") < F.col("_n") - last)).drop("_p", "_n")


def chronological_split(
    df: DataFrame, order_by: str | Sequence[str], series=None, train: float = 0.4, valid: float = 0.6,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """train / valid / test by place: cuts at floor(n * train) and floor(n * valid); the very
    last row of a series belongs to no split."""
    placed = with_series_size(with_position(df, names(order_by), series, "_p", hot_rows), series, "_n")
    p, n = F.col("_p"), F.col("_n")
    split = (F.when(p < F.floor(n * F.lit(train)), "train").when(p < F.floor(n * F.lit(valid)), "valid")
             .when(p < n - 1, "test"))
    return placed.withColumn("split", split).filter(F.col("split").isNotNull()).drop("_p", "_n")


def random_split(df: DataFrame, key: str | Sequence[str], weights: Mapping[str, float], seed: int = 0) -> DataFrame:
    """Seeded split from a hash of the key: the same under any partitioning, no shuffle."""
    u, total, at = uniform(seed, *names(key)), sum(weights.values()), 0.0
    split = None
    for name, weight in list(weights.items())[:-1]:
        at += weight / total
        split = F.when(u < at, name) if split is None else split.when(u < at, name)
    last = list(weights)[-1]
    return df.withColumn("split", F.lit(last) if split is None else split.otherwise(last))


def shuffle_rows(df: DataFrame, key: str | Sequence[str], seed: int = 0) -> DataFrame:
    """Random but repeatable order: range sort by a hash of the key."""
    return df.orderBy(hash32(seed, *names(key)), *names(key))


def sample_rows(df: DataFrame, key: str | Sequence[str], fraction: float, seed: int = 0) -> DataFrame:
    """Repeatable sample: rows whose hash uniform lies below `fraction`."""
    return df.filter(uniform(seed, *names(key)) < fraction)


def sorted_curve(df: DataFrame, value: str, tie: str | Sequence[str], hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Value against its place in ascending order (ties by `tie`)."""
    return with_position(df, [value, *names(tie)], None, "pos", hot_rows)


def top_fraction_threshold(df: DataFrame, score: str, fraction: float) -> DataFrame:
    """The smallest of the int(fraction * n) largest scores (at least one), as one row."""
    order = lambda n: n - F.greatest(F.floor(n * F.lit(fraction)), F.lit(1))
    return quantiles(df, score, [1.0 - fraction], position=order).select(F.col("value").alias("threshold"))


def flag_top_fraction(df: DataFrame, score: str, fraction: float, flag: str = "is_outlier") -> DataFrame:
    """1 for scores at or above the top-fraction threshold, ties included."""
    return df.withColumn(flag, (F.col(score) >= top_fraction_threshold(df, score, fraction).scalar()).cast("int"))


def multi_horizon_align(
    df: DataFrame, origin: str, horizon: str, predicted: str, steps: int, series=None,
) -> DataFrame:
    """For every target place the predictions made for it 1..steps ahead.

    Adds `p_1 .. p_steps`, their mean, the 1-step and the N-step one; only complete rows."""
    by = names(series)
    return (
        df.filter(F.col(horizon) <= steps)
        .groupBy(*by, (F.col(origin) + F.col(horizon)).alias("target_pos"))
        .agg(*[F.max(F.when(F.col(horizon) == h, F.col(predicted))).alias(f"p_{h}") for h in range(1, steps + 1)])
        .dropna(subset=[f"p_{h}" for h in range(1, steps + 1)])
        .withColumns({
            "mean_prediction": sum((F.col(f"p_{h}") for h in range(1, steps + 1)), F.lit(0.0)) / steps,
            "one_step": F.col("p_1"), "n_step": F.col(f"p_{steps}"),
        })
    )


def difference(
    df: DataFrame, column: str, order_by: str | Sequence[str], series=None, lag: int = 1,
    seasonal: int | None = None, to: str = "diff", hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """x - x[lag], then minus the same `seasonal` rows earlier."""
    reach = lag + (seasonal or 0)
    out, w, finish = row_frames(df, names(order_by), series, before=reach, hot_rows=hot_rows)
    x = F.col(column)
    value = x - F.lag(column, lag).over(w)
    if seasonal:
        value = value - (F.lag(column, seasonal).over(w) - F.lag(column, reach).over(w))
    return finish(out.withColumn(to, value))


def autocorrelation(
    df: DataFrame, column: str, lags: int, order_by: str | Sequence[str], series=None,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """ACF for lags 0..lags with the 95 % band of Bartlett's formula (`half_width`; z = 1.96);
    null for a series without variance.

    All lags come from one ordered pass and one aggregate."""
    by = names(series)
    if by:
        means = df.groupBy(*by).agg(F.avg(column).alias("_m"))
        centred = with_params(df, means, by).withColumn("_c", F.col(column) - F.col("_m"))
    else:
        centred = df.withColumn("_c", F.col(column) - df.agg(F.avg(column)).scalar())
    out, w, finish = row_frames(centred, names(order_by), series, before=lags, hot_rows=hot_rows)
    out = finish(out.withColumns({f"_l{k}": F.lag("_c", k).over(w) for k in range(1, lags + 1)}))
    sums = [F.sum(F.col("_c") * F.col(f"_l{k}")).alias(f"_s{k}") for k in range(1, lags + 1)]
    total = out.groupBy(*by).agg(F.count("_c").alias("_n"), F.sum(F.col("_c") * F.col("_c")).alias("_s0"), *sums)
    acf = F.array(*[F.try_divide(F.coalesce(F.col(f"_s{k}"), F.lit(0.0)), F.col("_s0")) for k in range(lags + 1)])
    out = total.select(*by, "_n", acf.alias("_r")).select("*", F.posexplode("_r").alias("lag", "acf"))
    before = F.slice("_r", F.lit(2), F.greatest(F.col("lag") - 1, F.lit(0)))
    squares = F.aggregate(before, F.lit(0.0), lambda acc, r: acc + r * r)
    width = F.when(F.col("lag") == 0, 0.0).otherwise(1.96 * F.sqrt(F.try_divide(1 + 2 * squares, F.col("_n"))))
    return out.select(*by, "lag", "acf", width.alias("half_width"))


def outlier_regions(
    df: DataFrame, flag: str, value: str, order_by: str | Sequence[str], series=None,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Contiguous stretches of flagged rows: first value, last value and number of points."""
    by, hot_rows = names(series), settle(df, series, hot_rows)
    out, w, finish = row_frames(df, names(order_by), series, before=1, hot_rows=hot_rows)
    start = ((F.col(flag) == 1) & (F.coalesce(F.lag(flag, 1).over(w), F.lit(0)) != 1)).cast("int")
    marked = finish(out.withColumn("_start", start))
    island = prefix_sums(marked, names(order_by), {"region": F.col("_start")}, series, hot_rows)
    return island.filter(F.col(flag) == 1).groupBy(*by, "region").agg(
        F.min(value).alias("lo"), F.max(value).alias("hi"), F.count(F.lit(1)).alias("points"))
