"""Empty tables, single rows, all-null columns; gap filling against a plain loop."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from oddrows.functions.columns import gaussian, uniform
from oddrows.functions.quantiles import quantiles
from oddrows.operators import cleaning, joins, sequence, stats, text, thresholds
from oddrows.operators.scaling import noise_augment, zscore_fit


def filled_by_loop(x):
    """Half the filled previous value plus half the raw next one, for zeros between values."""
    out, last = list(x), len(x)
    inner = [i for i, v in enumerate(x) if v != 0]
    for i in range(1, last - 1):
        if x[i] == 0 and inner and inner[0] < i < inner[-1]:
            out[i] = 0.5 * out[i - 1] + 0.5 * x[i + 1]
    return out


@pytest.mark.parametrize("x", [
    [1.0, 0.0, 3.0], [1.0, 0.0, 0.0, 0.0, 8.0, 0.0, 2.0], [0.0, 0.0, 4.0, 0.0, 0.0, 6.0, 0.0], [0.0, 0.0], [5.0],
])
def test_gaps_match_loop(spark, x):
    df = spark.createDataFrame(pd.DataFrame({"t": np.arange(len(x)), "x": x}))
    got = [r["x"] for r in cleaning.fill_gaps_with_neighbours(df, "t", ["x"]).orderBy("t").collect()]
    assert got == pytest.approx(filled_by_loop(x))


def test_empty_and_null(spark):
    empty = spark.createDataFrame([], "t int, x double")
    assert quantiles(empty, "x", [0.5]).count() == 0
    assert sequence.lag_matrix(empty, "x", [1], "t").count() == 0
    assert cleaning.has_missing(empty).first()["has_missing"] is False
    assert thresholds.score_iqr_fence(empty, thresholds.fit_iqr_fence(empty, "x"), "x").count() == 0
    assert stats.equal_width_histogram(empty, "x", 3).filter("count > 0").count() == 0
    nulls = spark.createDataFrame([(1, None), (2, None)], "t int, x double")
    assert quantiles(nulls, "x", [0.5]).count() == 0
    assert cleaning.missing_profile(nulls).collect()[0]["percent"] == 1.0
    assert sequence.rolling_mean_std(nulls, "x", 2, "t").filter("meanval is not null").count() == 0


def test_single_row(spark):
    one = spark.createDataFrame([(1, 5.0)], "t int, x double")
    assert quantiles(one, "x", [0.25]).first()["value"] == 5.0
    assert stats.equal_width_histogram(one, "x", 3).agg(F.sum("count")).first()[0] == 1
    assert sequence.sliding_windows(one, "x", 3, "t").count() == 0
    assert sequence.chronological_split(one, "t").count() == 0


def test_missing_counts_nan(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), None), (None, "b"), (2.0, "c")], "x double, s string")
    assert {r["column"]: r["percent"] for r in cleaning.missing_profile(df).collect()} == {"x": 0.5, "s": 0.25}
    assert [r["x"] for r in cleaning.impute_mean(df, ["x"]).collect()] == [1.0, 1.5, 1.5, 2.0]


def test_overlapping_ranges_do_not_repeat(spark):
    rows = spark.range(100).withColumn("f", F.lit("a"))
    ranges = spark.createDataFrame([("a", 10, 20), ("a", 15, 40), ("b", 0, 99)], "f string, lo bigint, hi bigint")
    out = joins.label_by_ranges(rows, ranges, "id", "f", few=0)
    assert out.count() == 100
    assert {r["id"] for r in out.filter("label = 1").collect()} == set(range(11, 40))


def test_random_split_is_disjoint_and_stable(spark):
    df = spark.range(5000)
    a = {r["id"]: r["split"] for r in sequence.random_split(df.repartition(1), "id", {"a": 0.7, "b": 0.3}, 1).collect()}
    b = {r["id"]: r["split"] for r in sequence.random_split(df.repartition(11), "id", {"a": 0.7, "b": 0.3}, 1).collect()}
    assert a == b and len(a) == 5000
    assert abs(sum(v == "a" for v in a.values()) / 5000 - 0.7) < 0.03


def test_hash_numbers_look_right(spark):
    row = spark.range(20000).select(uniform(7, "id").alias("u"), gaussian(7, "id").alias("g")).agg(
        F.avg("u"), F.stddev("u"), F.avg("g"), F.stddev("g")).first()
    assert row[0] == pytest.approx(0.5, abs=0.01) and row[1] == pytest.approx(12**-0.5, abs=0.01)
    assert row[2] == pytest.approx(0.0, abs=0.03) and row[3] == pytest.approx(1.0, abs=0.03)


def test_noise_copies_stop_at_the_limit(spark):
    df = spark.range(30).select(F.col("id").alias("t"), F.col("id").cast("double").alias("x"))
    out = noise_augment(df, ["x"], "t", zscore_fit(df, "x", ddof=1), copies=100, max_rows=100)
    assert out.count() == 100 and out.filter("copy = 0 and x <> t").count() == 0
    one = noise_augment(df, ["x"], "t", zscore_fit(df, "x", ddof=1), copies=2, one_level=True)
    assert one.count() == 90 and one.filter("copy > 0 and x = t").count() == 0


@pytest.mark.parametrize("most", [text.LOOKUP_WORDS, 1])
def test_texts_keep_their_own_words(spark, monkeypatch, most):
    monkeypatch.setattr(text, "LOOKUP_WORDS", most)
    rows = [(1, "One two, two! three"), (2, "Three three. four"), (3, "nothing"), (4, None), (5, ""), (1, "four"), (1, "four"), (None, "two")]
    df = spark.createDataFrame(rows, "k int, s string")
    vocabulary = text.build_vocabulary(df.limit(2), "s", 4)
    index = {r["word"]: r["index"] for r in vocabulary.collect()}
    assert index == {"three": 1, "two": 2, "four": 3}
    got = sorted(((r["k"], r["s"], list(r["sequence"])) for r in text.texts_to_sequences(df, "s", vocabulary, "k").collect()), key=repr)
    want = [[2, 2, 1], [1, 1, 3], [], [], [], [3], [3], [2]]
    assert got == sorted([(*r, w) for r, w in zip(rows, want)], key=repr)
    vectors = text.hash_vectors(vocabulary, 3)
    table = {r["word"]: list(r["vec"]) for r in vectors.collect()}
    names = {v: k for k, v in index.items()}
    for how, join in (("mean", lambda x: [sum(c) / len(c) for c in zip(*x)]), ("max", lambda x: [max(c) for c in zip(*x)])):
        pooled = text.pooled_text_vector(df, "s", vectors, "k", 3, how).collect()
        assert len(pooled) == len(rows)
        for r in pooled:
            own = want[rows.index((r["k"], r["s"]))]
            assert (r["vec"] is None) == (not own)
            if own:
                assert list(r["vec"]) == pytest.approx(join([table[names[i]] for i in own]))


def test_least_squares_far_from_zero(spark):
    from oddrows.operators.forecast import unit_root_test
    from oddrows.operators.linear import cross_validated_ridge, fit_linear

    df = spark.range(2000).selectExpr("id", "CAST(id + 1000000000 AS double) AS x", "CAST(3 * id + 1 + 1e9 AS double) AS y", "id % 4 AS fold")
    coef = fit_linear(df, ["x"], "y").first()["coef"]
    assert coef[1] == pytest.approx(3, rel=1e-9) and coef[0] + coef[1] * 1e9 == pytest.approx(1e9 + 1, rel=1e-9)
    assert cross_validated_ridge(df, ["x"], "y", "fold", [0.0]).first()["mse"] < 1e-6
    import random
    rng = random.Random(1)
    noise = [(k, rng.gauss(0, 1)) for k in range(400)]
    t = [unit_root_test(spark.createDataFrame([(k, v + up) for k, v in noise], "k int, v double"), "v", "k", lags=lags).first()["t_stat"]
         for lags in (0, 2) for up in (0.0, 1e9)]
    assert t[0] == pytest.approx(t[1], rel=1e-4) and t[2] == pytest.approx(t[3], rel=1e-4) and t[0] < -10


def test_null_groups_and_constants(spark):
    from oddrows.functions.sizes import with_params
    from oddrows.operators import evaluation, scaling, sequence, stats, thresholds

    rows = [(g, float(k), float(k * k % 7)) for g in ("a", None) for k in range(1, 9)] + [("c", 1.0, 1.0), ("c", 2.0, 1.0)]
    df = spark.createDataFrame(rows, "g string, t double, x double")
    groups = {"a", None, "c"}
    assert {r["g"] for r in stats.best_by(df, "x", "g", tie="t").collect()} == groups
    assert {r["g"] for r in stats.box_stats(df, "x", "g").collect()} == groups
    assert all(r["p50"] is not None for r in stats.describe(df, "x", "g").collect())
    bins = stats.equal_width_histogram(df, "x", 3, "g").groupBy("g").sum("count").collect()
    assert {(r["g"], r["sum(count)"]) for r in bins} == {("a", 8), (None, 8), ("c", 2)}
    assert {r["g"] for r in evaluation.regression_errors(df, "t", "x", "g").collect()} == groups
    acf = sequence.autocorrelation(df, "x", 1, "t", "g").filter("lag = 1").collect()
    assert {r["g"]: r["acf"] is None for r in acf} == {"a": False, None: False, "c": True}
    fences = thresholds.fit_iqr_fence(df, "x", "g")
    assert thresholds.score_iqr_fence(df, fences, "x", "g").filter("score IS NULL").count() == 0
    flat = spark.createDataFrame([("2020-01-01", 5.0), ("2020-01-02", 5.0)], "d string, v double").selectExpr("CAST(d AS date) AS d", "v")
    assert [r["detrended"] for r in scaling.seasonal_detrend(flat, "d", "v", F.lit(True)).collect()] == [None, None]
    means = df.groupBy("g").agg(F.avg("x").alias("m"))
    near = sorted(map(repr, with_params(df, means, "g").collect()))
    assert near == sorted(map(repr, with_params(df, means, "g", bytes_limit=0).collect())) and len(near) == len(rows)


def test_nearest_with_null_coordinates(spark):
    from oddrows.operators.joins import assign_nearest

    df = spark.createDataFrame([(1.0,), (None,), (40.2,)], "x double")
    for k in (1, 16, 17, 50):
        got = [(r["x"], r["cluster"], r["distance"]) for r in assign_nearest(df, ["x"], [[float(i)] for i in range(k)]).collect()]
        assert got[1] == (None, None, None) and got[0][1] == min(1, k - 1) and got[2][1] == min(40, k - 1)


def test_noise_keeps_the_series(spark):
    df = spark.range(10).selectExpr("id AS t", "CAST(id AS double) AS x")
    params = zscore_fit(df, "x", ddof=1)
    assert noise_augment(df, ["x"], "t", params, max_rows=4).filter("copy = 0").count() == 10
    assert noise_augment(df, ["x"], "t", params, copies=3).count() == 40


def test_pad(spark):
    df = spark.createDataFrame([([1, 2, 3],), ([],), ([1, 2, 3, 4, 5],)], "s array<int>")
    assert [r["s"] for r in text.pad_sequences(df, "s", 4).collect()] == [[0, 1, 2, 3], [0, 0, 0, 0], [2, 3, 4, 5]]
