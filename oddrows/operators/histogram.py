"""Histogram-based outlier score: independent features, sum of negative log densities."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oddrows.functions.columns import scalar
from oddrows.operators.stats import bin_number


def fit_hbos(df: DataFrame, columns: Sequence[str], bins: int = 10, alpha: float = 0.1) -> DataFrame:
    """One row per feature: `feature, lo, hi, scores` with the log2(density + alpha) of its bins.

    Two passes: ends of all features, then all bin counts in one combined aggregate."""
    cols = list(columns)
    ends = df.agg(*[F.struct(F.min(c).cast("double").alias("lo"), F.max(c).cast("double").alias("hi"),
                             F.count(c).alias("n")).alias(f"e{i}") for i, c in enumerate(cols)])
    seen = df.select(*cols).withColumn("_e", scalar(ends))
    each = F.array(*[
        F.struct(F.lit(i).alias("i"), bin_number(F.col(c).cast("double"), F.col("_e")[f"e{i}"]["lo"],
                                                 F.col("_e")[f"e{i}"]["hi"], bins).alias("bin"))
        for i, c in enumerate(cols)])
    # only integers in the aggregate: a struct in its buffer would turn it into a sort
    counts = seen.select(F.inline(each)).filter("bin is not null").groupBy("i", "bin").agg(F.count(F.lit(1)).alias("c"))
    packed = counts.groupBy("i").agg(F.map_from_entries(F.collect_list(F.struct("bin", "c"))).alias("m"))
    one = F.col("_all")
    spans = F.array(*[one[f"e{i}"] for i in range(len(cols))])
    table = packed.withColumn("_all", scalar(ends)).select(
        "i", "m", F.element_at(F.array(*map(F.lit, cols)), F.col("i") + 1).alias("feature"),
        F.element_at(spans, F.col("i") + 1).alias("e"))
    width = (F.col("e.hi") - F.col("e.lo")) / bins
    density = lambda b: F.try_divide(
        F.coalesce(F.try_element_at("m", b), F.lit(0)).cast("double"), F.col("e.n") * width)
    scores = F.transform(F.sequence(F.lit(0), F.lit(bins - 1)),
                         lambda b: F.log2(F.coalesce(density(b), F.lit(0.0)) + alpha))
    return table.select("i", "feature", F.col("e.lo").alias("lo"), F.col("e.hi").alias("hi"), scores.alias("scores"))


def score_hbos(df: DataFrame, params: DataFrame, columns: Sequence[str], tol: float = 0.5) -> DataFrame:
    """Larger is more unusual. A value outside the fitted range takes the end bin's score when it
    lies within `tol` bin widths, else the lowest score of the feature."""
    fitted = {r["feature"]: r for r in params.collect()}  # one row of `bins` scores per feature
    total = F.lit(0.0)
    for c in columns:
        if c not in fitted:
            continue  # a feature that was null in every fitted row says nothing
        low, high, scores = fitted[c]["lo"], fitted[c]["hi"], fitted[c]["scores"]
        x, bins = F.col(c).cast("double"), len(scores)
        reach, worst = tol * (high - low) / bins, min(scores)
        at = bin_number(x, F.lit(low), F.lit(high), bins)
        inside = F.get(F.array(*[F.lit(s) for s in scores]), at)
        value = (F.when(x < low, F.when(low - x <= reach, scores[0]).otherwise(worst))
                 .when(x > high, F.when(x - high <= reach, scores[-1]).otherwise(worst))
                 .otherwise(inside))
        total = total - value
    return df.withColumn("score", total)
