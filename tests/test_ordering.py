"""The split path of ordered operators gives the plain window's answer, with one hot series."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from oddrows.functions.ordering import carried, prefix_sums, row_frames, with_position, with_series_size
from oddrows.functions.quantiles import quantiles
from oddrows.operators import cleaning, neighbours, sequence, thresholds

SMALL = 37  # far below the hot series


@pytest.fixture(scope="module")
def skewed(spark):
    """900 rows; series 0 holds more than a third, series 9 one row, null is a series too."""
    rng = np.random.default_rng(5)
    series = np.where(rng.random(900) < 0.4, 0, rng.integers(0, 8, 900)).astype(object)
    series[0] = 9
    series[1:20] = None
    pdf = pd.DataFrame({"s": pd.array(series, dtype="Int64"), "t": rng.permutation(900),
                        "x": np.round(rng.normal(size=900), 3)})
    pdf["gap"] = np.where(rng.random(900) < 0.5, 0.0, pdf["x"])
    df = spark.createDataFrame(pdf, "s bigint, t bigint, x double, gap double")
    return df.repartition(16).persist()


def same(a, b):
    keys = sorted(a.columns)
    left = sorted(map(repr, (tuple(r[c] if not isinstance(r[c], float) else round(r[c], 9) for c in keys) for r in a.collect())))
    right = sorted(map(repr, (tuple(r[c] if not isinstance(r[c], float) else round(r[c], 9) for c in keys) for r in b.collect())))
    assert left == right


@pytest.mark.parametrize("by", [None, "s"])
def test_prefix_sums_and_position(skewed, by):
    sums = {"run": F.col("x"), "cnt": F.lit(1)}
    same(prefix_sums(skewed, "t", sums, by, hot_rows=SMALL), prefix_sums(skewed, "t", sums, by, hot_rows=None))
    same(with_position(skewed, "t", by, hot_rows=SMALL), with_position(skewed, "t", by, hot_rows=None))
    down = [F.desc("t")]
    same(prefix_sums(skewed, down, {"run": F.col("x")}, hot_rows=SMALL), prefix_sums(skewed, down, {"run": F.col("x")}, hot_rows=None))


@pytest.mark.parametrize("by", [None, "s"])
def test_carried(skewed, by):
    v = {"a": F.when(F.col("gap") != 0, F.col("x"))}
    w = {"b": F.when(F.col("gap") != 0, F.col("t"))}
    same(carried(skewed, "t", v, w, by, hot_rows=SMALL), carried(skewed, "t", v, w, by, hot_rows=None))


@pytest.mark.parametrize("by", [None, "s"])
def test_row_frames(skewed, by):
    def run(hot):
        out, w, finish = row_frames(skewed, "t", by, before=4, after=3, hot_rows=hot)
        return finish(out.withColumns({"a": F.lag("x", 4).over(w), "b": F.lead("x", 3).over(w),
                                       "c": F.sum("x").over(w.rowsBetween(-4, 3)), "d": F.count("x").over(w.rowsBetween(-2, 0))}))
    same(run(SMALL), run(None))
    same(run(5), run(None))


OPERATORS = {
    "lag": lambda d, h: sequence.lag_matrix(d, "x", [0, 1, 7], "t", "s", hot_rows=h),
    "lead": lambda d, h: sequence.lead_target(d, {"n": "x"}, "t", "s", 2, hot_rows=h),
    "rolling": lambda d, h: sequence.rolling_mean_std(d, "x", 7, "t", "s", hot_rows=h),
    "sliding": lambda d, h: sequence.sliding_windows(d, "x", 5, "t", "s", 2, hot_rows=h).withColumn("inputs", F.concat_ws(",", F.col("inputs").cast("array<string>"))),
    "tumbling": lambda d, h: sequence.tumbling_chunks(d, "x", 8, "t", "s", hot_rows=h).withColumn("values", F.concat_ws(",", F.col("values").cast("array<string>"))),
    "segment": lambda d, h: sequence.segment_series(d, 3, "t", "s", hot_rows=h),
    "shifted": lambda d, h: sequence.shifted_chunks(d, "x", 10, "t", "s", hot_rows=h),
    "trim": lambda d, h: sequence.trim_ends(d, 3, 1, "t", "s", hot_rows=h),
    "split": lambda d, h: sequence.chronological_split(d, "t", "s", hot_rows=h),
    "difference": lambda d, h: sequence.difference(d, "x", "t", "s", 1, 4, hot_rows=h),
    "acf": lambda d, h: sequence.autocorrelation(d.filter("s < 8"), "x", 6, "t", "s", hot_rows=h),
    "regions": lambda d, h: sequence.outlier_regions(d.withColumn("f", (F.col("x") > 0.3).cast("int")), "f", "x", "t", "s", hot_rows=h),
    "gaps": lambda d, h: cleaning.fill_gaps_with_neighbours(d, "t", ["gap"], "s", hot_rows=h),
    "knn1": lambda d, h: neighbours.knn_distance_1d(d, "x", "t", 5, hot_rows=h),
    "curve": lambda d, h: sequence.sorted_curve(d, "x", "t", hot_rows=h),
    "bands": lambda d, h: thresholds.rolling_error_bands(d.select("s", F.col("t").alias("date"), F.col("x").alias("actuals"), F.lit(0.1).alias("predicted")), 7, series="s", hot_rows=h),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_operator_split_path(skewed, name):
    same(OPERATORS[name](skewed, SMALL), OPERATORS[name](skewed, None))


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_operator_partitioning(skewed, name):
    same(OPERATORS[name](skewed.repartition(1), None), OPERATORS[name](skewed.repartition(13), None))


def test_series_size(skewed):
    sizes = {r["s"]: r["n"] for r in with_series_size(skewed, "s").select("s", "n").distinct().collect()}
    counts = {r["s"]: r["count"] for r in skewed.groupBy("s").count().collect()}
    assert sizes == counts


@pytest.mark.parametrize("accuracy,hot", [(20_000, None), (50, None), (50, 10), (20_000, 10)])
@pytest.mark.parametrize("kind", ["normal", "ties", "hot"])
def test_quantiles(spark, accuracy, hot, kind):
    rng = np.random.default_rng(3)
    x = rng.normal(size=3001)
    if kind == "ties":
        x = np.round(x, 1)
    if kind == "hot":
        x[:1200] = 0.25
    g = np.where(np.arange(3001) < 2000, "a", "b")
    df = spark.createDataFrame(pd.DataFrame({"g": g, "x": x, "y": x * 2 + 1})).repartition(7)
    probs = [0.0, 0.01, 0.25, 0.5, 0.87, 0.99, 1.0]
    for r in quantiles(df, ["x", "y"], probs, accuracy=accuracy, hot_rows=hot).collect():
        base = x if r["column"] == "x" else x * 2 + 1
        assert r["value"] == pytest.approx(np.quantile(base, r["prob"]), abs=1e-12) and r["n"] == 3001
    grouped = quantiles(df, "x", probs, "g", accuracy=accuracy, hot_rows=hot).collect()
    assert len(grouped) == 14
    for r in grouped:
        assert r["value"] == pytest.approx(np.quantile(x[g == r["g"]], r["prob"]), abs=1e-12)


def test_top_fraction_matches_nlargest(spark):
    rng = np.random.default_rng(8)
    x = np.round(rng.exponential(size=777), 2)
    df = spark.createDataFrame(pd.DataFrame({"x": x}))
    for f in (0.0, 0.01, 0.13, 0.5, 1.0):
        want = np.sort(x)[::-1][max(int(f * len(x)), 1) - 1]
        assert sequence.top_fraction_threshold(df, "x", f).first()["threshold"] == want


@pytest.mark.parametrize("operator", [lambda df: sequence.sliding_windows(df, "x", 3, "t", hot_rows=5), lambda df: sequence.shifted_chunks(df, "x", 4, "t", hot_rows=5)])
def test_windows_of_a_long_series_sort_it_once(spark, operator, monkeypatch):
    """Places come from one range sort; the frames are cut from those places."""
    from oddrows.functions import ordering
    sorts, run = [], ordering.sorted_run
    monkeypatch.setattr(ordering, "sorted_run", lambda *a: sorts.append(1) or run(*a))
    out = operator(spark.range(60).selectExpr("id AS t", "id * 2.0 AS x"))
    assert out.count() in (57, 59) and len(sorts) == 1
    assert "rangepartitioning" not in out._jdf.queryExecution().executedPlan().toString()
