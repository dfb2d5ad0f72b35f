"""Aggregations: profiles, moments, histograms, densities, calendar buckets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oddrows.functions.columns import names, scalar
from oddrows.functions.quantiles import quantile_table, quantiles  # noqa: F401
from oddrows.functions.sizes import join_groups, with_params
from oddrows.operators import linear

#: texts of one key that are joined in one step before the pieces of the key are joined
TEXT_PIECE = 10_000


def daily_sum(df: DataFrame, ts: str, value: str) -> DataFrame:
    return df.groupBy(F.to_date(ts).alias("date")).agg(F.sum(value).alias("total"))


def class_counts(df: DataFrame, by: str | Sequence[str]) -> DataFrame:
    """Rows per class, largest first."""
    return df.groupBy(*names(by)).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), *names(by))


def group_mean_filtered(df: DataFrame, by: str | Sequence[str], value: str, condition: Column) -> DataFrame:
    return df.filter(condition).groupBy(*names(by)).agg(F.avg(value).alias("mean"))


def describe(df: DataFrame, columns: str | Sequence[str], by: str | Sequence[str] | None = None) -> DataFrame:
    """Count, mean, sample std, min, exact quartiles and max per column and group."""
    cols, groups = names(columns), names(by)
    aggs = [F.struct(
        F.lit(c).alias("column"), F.count(c).alias("count"), F.avg(c).alias("mean"),
        F.stddev_samp(c).alias("std"), F.min(c).cast("double").alias("min"),
        F.max(c).cast("double").alias("max")).alias(f"s{i}") for i, c in enumerate(cols)]
    basic = df.groupBy(*groups).agg(*aggs).select(
        *groups, F.inline(F.array(*[f"s{i}" for i in range(len(cols))])))
    quart = quantile_table(df, cols, (0.25, 0.5, 0.75), groups)
    quart = quart.select(*groups, "column", F.col("q_0").alias("p25"), F.col("q_1").alias("p50"),
                         F.col("q_2").alias("p75"))
    return join_groups(basic, quart, [*groups, "column"]).select(*basic.columns, "p25", "p50", "p75")


def skewness_adj(value: str | Column) -> Column:
    """Bias-corrected skewness (aggregate)."""
    n = F.count(value).cast("double")
    return F.when(n > 2, F.skewness(value) * F.sqrt(n * (n - 1)) / (n - 2))


def kurtosis_adj(value: str | Column) -> Column:
    """Bias-corrected excess kurtosis (aggregate)."""
    n = F.count(value).cast("double")
    return F.when(n > 3, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * F.kurtosis(value) + 6))


def bin_number(value: Column, low: Column, high: Column, bins: int) -> Column:
    """Equal-width bin 0..bins-1, last bin closed; a single value falls in bin 0."""
    at = F.floor(F.try_divide((value - low) * bins, high - low))
    return F.when(value.isNotNull(), F.least(F.coalesce(at, F.lit(0)), F.lit(bins - 1)).cast("int"))


def equal_width_histogram(
    df: DataFrame, column: str, bins: int, by: str | Sequence[str] | None = None, upper: float | None = None,
) -> DataFrame:
    """Counts per equal-width bin and group, empty bins included; `upper` cuts values first."""
    groups = names(by)
    kept = df.filter(F.col(column).isNotNull()) if upper is None else df.filter(F.col(column) < upper)
    x = F.col(column).cast("double")
    ends = kept.groupBy(*groups).agg(F.min(x).alias("_lo"), F.max(x).alias("_hi"))
    if groups:
        seen = with_params(kept.select(*dict.fromkeys([*groups, column])), ends, groups, "inner")
        low, high = F.col("_lo"), F.col("_hi")
    else:
        seen = kept.select(column).withColumn("_e", scalar(ends))
        low, high = F.col("_e._lo"), F.col("_e._hi")
    counts = seen.groupBy(*groups, bin_number(x, low, high, bins).alias("bin")).agg(
        F.count(F.lit(1)).alias("count"))
    frame = ends.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    width = (F.col("_hi") - F.col("_lo")) / bins
    return join_groups(frame, counts, [*groups, "bin"]).select(
        *groups, "bin", (F.col("_lo") + F.col("bin") * width).alias("left"),
        (F.col("_lo") + (F.col("bin") + 1) * width).alias("right"),
        F.coalesce("count", F.lit(0).cast("bigint")).alias("count"))


def density_curve(df: DataFrame, column: str, points: int = 200, bins: int = 1024, cut: float = 3.0) -> DataFrame:
    """Gaussian kernel density on an even grid, bandwidth n^(-1/5) * std.

    Rows are counted into `bins` fine bins first, so the curve costs points x bins steps
    whatever the number of rows. Each bin acts at its centre."""
    x = F.col(column).cast("double")
    head = df.agg(F.count(x).alias("n"), F.min(x).alias("lo"), F.max(x).alias("hi"),
                  F.stddev_samp(x).alias("std"))
    seen = df.filter(x.isNotNull()).select(x.alias("x")).withColumn("e", scalar(head))
    binned = seen.groupBy(bin_number(F.col("x"), F.col("e.lo"), F.col("e.hi"), bins).alias("bin")).agg(
        F.count(F.lit(1)).alias("c")).withColumn("e", scalar(head))
    width = (F.col("e.hi") - F.col("e.lo")) / bins
    centres = binned.select(F.struct((F.col("e.lo") + (F.col("bin") + 0.5) * width).alias("x"), "c").alias("b"))
    packed = centres.agg(F.array_sort(F.collect_list("b")).alias("bins"))  # at most `bins` entries
    h = F.pow(F.col("n").cast("double"), F.lit(-0.2)) * F.col("std")
    step = F.col("_i") / F.lit(float(points - 1))
    grid = (
        head.withColumn("h", h)
        .withColumn("bins", packed.scalar())
        .withColumn("_i", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
        .withColumn("x", F.col("lo") - cut * F.col("h") + (F.col("hi") - F.col("lo") + 2 * cut * F.col("h")) * step)
    )
    bell = lambda b: b["c"] * F.exp(-0.5 * F.pow((F.col("x") - b["x"]) / F.col("h"), F.lit(2.0)))
    total = F.aggregate("bins", F.lit(0.0), lambda acc, b: acc + bell(b))
    return grid.select("x", (total / (F.col("n") * F.col("h") * F.sqrt(F.lit(2.0) * F.pi()))).alias("density"))


def concat_text_by_key(df: DataFrame, key: str | Sequence[str], text: str, order_by: str, to: str = "text") -> DataFrame:
    """All texts of a key in order, each followed by a blank.

    Two steps: pieces of at most `TEXT_PIECE` order numbers, then the pieces, so no task
    holds more than a piece of a hot key besides the result itself. `order_by` is integral."""
    keys = names(key)
    piece = F.floor(F.col(order_by) / TEXT_PIECE).alias("_piece")
    join = lambda items: F.array_join(F.transform(F.sort_array(items), lambda s: s["t"]), "")
    one = F.struct(F.col(order_by).alias("o"), F.concat(F.col(text), F.lit(" ")).alias("t"))
    first = df.groupBy(*keys, piece).agg(join(F.collect_list(one)).alias("t"))
    return first.groupBy(*keys).agg(join(F.collect_list(F.struct("_piece", "t"))).alias(to))


def linear_fit(df: DataFrame, x: str, y: str, by: str | Sequence[str] | None = None) -> DataFrame:
    """Least-squares line of y on x: slope, intercept, r2."""
    return df.groupBy(*names(by)).agg(
        F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"),
        F.regr_r2(y, x).alias("r2"))


def calendar_resample(
    df: DataFrame, ts: str, columns: Sequence[str], unit: str = "day", by: str | Sequence[str] | None = None,
) -> DataFrame:
    """Mean and sample std per calendar bucket and column; empty buckets are kept as null."""
    groups = names(by)
    aggs = [a for c in columns for a in (F.avg(c).alias(f"{c}_mean"), F.stddev_samp(c).alias(f"{c}_std"))]
    found = df.groupBy(*groups, F.date_trunc(unit, ts).alias("bucket")).agg(*aggs)
    span = found.groupBy(*groups).agg(F.min("bucket").alias("a"), F.max("bucket").alias("b"))
    step = F.expr(f"INTERVAL 1 {unit}")
    frame = span.select(*groups, F.explode(F.sequence("a", "b", step)).alias("bucket"))
    return join_groups(frame, found, [*groups, "bucket"])


def box_stats(df: DataFrame, column: str, by: str | Sequence[str] | None = None, reach: float = 1.5) -> DataFrame:
    """Five-number summary with whiskers at the last point inside the fences."""
    groups = names(by)
    q = quantile_table(df, column, (0.25, 0.5, 0.75), groups)
    q = q.select(*groups, F.col("q_0").alias("q1"), F.col("q_1").alias("median"), F.col("q_2").alias("q3"))
    if groups:
        seen = with_params(df.select(*dict.fromkeys([*groups, column])), q, groups, "inner")
    else:
        seen = df.select(column).withColumn("_q", scalar(q)).select(column, "_q.*")
    x, iqr = F.col(column), F.col("q3") - F.col("q1")
    inside = (x >= F.col("q1") - reach * iqr) & (x <= F.col("q3") + reach * iqr)
    return seen.groupBy(*groups, "q1", "median", "q3").agg(
        F.min(x).alias("min"), F.max(x).alias("max"),
        F.min(F.when(inside, x)).alias("low_whisker"), F.max(F.when(inside, x)).alias("high_whisker"),
        F.count_if(~inside).alias("outside"))


def best_by(
    df: DataFrame, value: str, by: str | Sequence[str] | None = None, lowest: bool = True, tie: str | None = None,
) -> DataFrame:
    """The row with the lowest (highest) value per group; of equal ones the first by `tie`.

    The extreme is found with a numeric aggregate first, so only rows equal to it reach the
    aggregate that carries whole rows."""
    groups = names(by)
    extreme = df.groupBy(*groups).agg((F.min if lowest else F.max)(value).alias("_best"))
    if groups:
        kept = with_params(df, extreme, groups, "inner").filter(F.col(value) == F.col("_best")).drop("_best")
    else:
        kept = df.filter(F.col(value) == extreme.scalar())
    rest = F.struct(*[c for c in df.columns if c not in groups])
    return kept.groupBy(*groups).agg(F.min_by(rest, F.col(tie or value)).alias("_r")).select(*groups, "_r.*")


def error_mean_cov(df: DataFrame, errors: Sequence[str], by: str | Sequence[str] | None = None) -> DataFrame:
    """Mean vector and sample covariance matrix (row-major) of error columns, one pass."""
    if len(errors) > linear.JVM_CELLS:
        cov = F.transform("cells", lambda c: F.try_divide(c, F.col("n") - 1))
        return linear.gram(df, errors[:-1], errors[-1], by).select(*names(by), "n", "mean", cov.alias("cov"))
    d = range(len(errors))
    pair = lambda i, j: F.covar_samp(errors[min(i, j)], errors[max(i, j)])
    cells = [pair(i, j).alias(f"c{i}_{j}") for i in d for j in d if i <= j]
    means = [F.avg(e).alias(f"m{i}") for i, e in enumerate(errors)]
    full = F.array(*[f"c{min(i, j)}_{max(i, j)}" for i in d for j in d])
    return df.dropna(subset=list(errors)).groupBy(*names(by)).agg(F.count(F.lit(1)).alias("n"), *means, *cells).select(
        *names(by), "n", F.array(*[f"m{i}" for i in d]).alias("mean"), full.alias("cov"))
