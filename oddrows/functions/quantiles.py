"""Exact quantiles with linear interpolation, without holding a group in one task.

A mergeable sketch brackets every wanted rank; the second scan counts what lies below the
bracket and keeps only values inside it, combined by value before the shuffle."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from oddrows.functions.columns import names
from oddrows.functions.lineage import written
from oddrows.functions.ordering import HOT_ROWS, prefix_sums
from oddrows.functions.sizes import with_params


def quantiles(
    df: DataFrame,
    columns: str | Sequence[str],
    probs: Sequence[float],
    by: str | Sequence[str] | None = None,
    accuracy: int = 20_000,
    position: Callable[[Column], Column] | None = None,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """One row per group, column and probability: `(*by, column, prob, n, value)`.

    The 0-based rank is prob * (n - 1), or `position(n)`, which must lie within two rows of
    prob * n.

    `accuracy` sets the sketch's rank error (1/accuracy); groups with fewer rows than that
    are ranked whole. The answer is exact at any accuracy: it only moves work between the
    sketch and the bracket, which holds about 6/accuracy of a group's rows. Brackets expected to
    exceed `hot_rows` are ranked over a range-partitioned table."""
    cols, groups = names(columns), names(by)
    wide = 3.0 / accuracy
    lows = [max(0.0, p - wide) for p in probs]
    highs = [min(1.0, p + wide) for p in probs]
    xs = [F.col(c).cast("double") for c in cols]
    # per column: rows, then the bracket ends of all probabilities; small groups are one bracket
    ends = []
    for x in xs:
        n, sketch = F.count(x), F.percentile_approx(x, F.array(*map(F.lit, lows + highs)), accuracy)
        whole = n < accuracy
        ends.append(F.struct(
            *[F.when(whole, F.min(x)).otherwise(sketch[j]).alias(f"low{j}") for j in range(len(probs))],
            *[F.when(whole, F.max(x)).otherwise(sketch[len(probs) + j]).alias(f"high{j}") for j in range(len(probs))]))
    brackets = written(df.groupBy(*groups).agg(F.array(*ends).alias("_b"), F.count(F.lit(1)).alias("_rows")))
    values = F.array(*[F.struct(F.lit(i).alias("i"), x.alias("x")) for i, x in enumerate(xs)])
    if groups:  # the brackets go to the rows, which stay where they are
        seen = with_params(df.select(*groups, *cols), brackets.drop("_rows"), groups, "inner").select(*groups, "_b", F.inline(values))
    else:
        seen = df.select(F.inline(values)).withColumn("_b", brackets.select("_b").scalar())
    # A value stands for itself inside a bracket, else for the nearest bracket end below it.
    # Ordered by (key, after) the counts add up to exact ranks.
    at_column = seen.filter(F.col("x").isNotNull()).withColumn("_e", F.element_at("_b", F.col("i") + 1))
    x, inside, floors = F.col("x"), F.lit(False), [F.lit(float("-inf"))]
    for j in range(len(probs)):
        low, high = F.col("_e")[f"low{j}"], F.col("_e")[f"high{j}"]
        inside = inside | x.between(low, high)
        floors.append(F.when(high < x, high))
    rows = at_column.select(*groups, "i", "x", (~inside).alias("after"), F.greatest(*floors).alias("floor")).select(
        *groups, "i", "after", F.when(F.col("after"), F.col("floor")).otherwise(x).alias("key"))
    counted = rows.groupBy(*groups, "i", "key", "after").agg(
        F.count(F.lit(1)).alias("rows"))
    part = [*groups, "i"]
    largest = None if hot_rows is None else brackets.agg(F.max("_rows")).first()[0] or 0
    if hot_rows is None or largest * min(1.0, 2 * wide * len(probs)) <= hot_rows:
        w = Window.partitionBy(*part)
        upto = w.orderBy("key", "after").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        ranked = counted.withColumns({"cum": F.sum("rows").over(upto), "n": F.sum("rows").over(w)})
    else:  # brackets too long for one task: the same running counts over a range-partitioned table
        table = written(counted)
        ranked = prefix_sums(table, ["key", "after"], {"cum": F.col("rows")}, part, hot_rows=0)
        totals = table.groupBy(*part).agg(F.sum("rows").alias("n"))
        totals = totals.select("n", *[F.col(c).alias(f"_t_{c}") for c in part])
        same = F.lit(True)
        for c in part:
            same = same & F.col(c).eqNullSafe(F.col(f"_t_{c}"))
        ranked = ranked.join(totals, same)
    ranks = [F.lit(float(p)) * (F.col("n") - 1) if position is None else position(F.col("n")).cast("double")
             for p in probs]
    at = lambda r: F.max(F.when(~F.col("after") & (F.col("cum") > r) & (F.col("cum") - F.col("rows") <= r), F.col("key")))
    picked = ranked.groupBy(*groups, "i", "n").agg(F.array(*[
        F.struct(F.lit(float(p)).alias("prob"), F.max(r).alias("rank"), at(F.floor(r)).alias("lo"), at(F.ceil(r)).alias("hi"))
        for p, r in zip(probs, ranks)]).alias("q"))
    value = F.col("lo") + (F.col("hi") - F.col("lo")) * (F.col("rank") - F.floor("rank"))
    missed = F.raise_error(F.lit("quantile bracket missed its rank"))
    return picked.select(*groups, "i", "n", F.inline("q")).select(
        *groups,
        F.element_at(F.array(*map(F.lit, cols)), F.col("i") + 1).alias("column"),
        "prob",
        "n",
        F.when(value.isNull(), missed).otherwise(value).alias("value"),
    )


def quantile_table(df: DataFrame, columns, probs: Sequence[float], by=None, **kw) -> DataFrame:
    """`quantiles` turned to one row per group and column with columns `q_<i>`."""
    long = quantiles(df, columns, probs, by, **kw)
    picks = [
        F.max(F.when(F.abs(F.col("prob") - p) < 1e-12, F.col("value"))).alias(f"q_{i}")
        for i, p in enumerate(probs)
    ]
    return long.groupBy(*names(by), "column").agg(F.max("n").alias("n"), *picks)
