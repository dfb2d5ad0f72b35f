"""Seasonal ARMA, unit roots, score baselines and itemsets: known answers and brute force."""

import itertools
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from oddrows.operators import arma, baseline, itemsets, linear, unitroot


def frame(spark, **columns):
    return spark.createDataFrame(pd.DataFrame(columns)).repartition(5)


def test_gram_in_batches_equals_numpy(spark, monkeypatch):
    rng = np.random.default_rng(1)
    z = rng.normal(1e6, 1, (600, 8)) * np.arange(1, 9)
    group = np.array(["a", "b", None], object)[rng.integers(0, 3, 600)]
    names = [f"x{i}" for i in range(7)]
    df = frame(spark, g=group, **{n: z[:, i] for i, n in enumerate([*names, "y"])}).withColumn(
        "x0", F.when(F.col("x0") > z[5, 0] + 2, None).otherwise(F.col("x0")))
    monkeypatch.setattr(linear, "GROUPS_HELD", 1)
    got = {r["g"]: r for r in linear.gram(df, names, "y", "g").collect()}
    assert set(got) == {"a", "b", None}
    for g, r in got.items():
        own = z[(group == g) & (z[:, 0] <= z[5, 0] + 2)]
        c = own - own.mean(axis=0)
        assert r["n"] == len(own) and np.allclose(r["mean"], own.mean(axis=0)) and np.allclose(r["cells"], (c.T @ c).ravel(), rtol=1e-6)
    assert linear.gram(df.limit(0), names, "y", "g").count() == 0
    assert [(r["n"], len(r["mean"]), len(r["cells"])) for r in linear.gram(df.limit(0), names, "y").collect()] == [(0, 8, 64)]


# --- seasonal ARMA

def seasonal_series(n, seed, ma):
    """A series whose difference at lags 1 and 4 is an MA(1) process."""
    rng = np.random.default_rng(seed)
    e = rng.normal(0, 1, n + 1)
    d = e[1:] + ma * e[:-1]
    x = np.zeros(n)
    for t in range(n):
        x[t] = d[t] + (x[t - 1] if t else 0) + ((x[t - 4] if t >= 4 else 0) - (x[t - 5] if t >= 5 else 0))
    return x


def brute_recursion(u, lags, theta):
    e = []
    for t, v in enumerate(u):
        e.append(0.0 if math.isnan(v) else v - sum(c * (e[t - k] if t >= k else 0.0) for k, c in zip(lags, theta)))
    return e


@pytest.mark.parametrize("hot_rows", [None, 7])
def test_recursion_runs_over_pieces(spark, hot_rows):
    rng = np.random.default_rng(2)
    u = rng.normal(size=400)
    u[[0, 1, 2, 130]] = np.nan
    series = np.repeat([1, 2], [330, 70])
    df = frame(spark, s=series, t=np.arange(400), u=u).withColumn("u", F.when(F.isnan("u"), None).otherwise(F.col("u")))
    df = df.withColumn("theta", F.when(F.col("s") == 1, F.array(F.lit(0.5), F.lit(-0.4))).otherwise(F.array(F.lit(0.0), F.lit(0.9))))
    out = arma.recursion(df, "u", "theta", [1, 4], "t", "s", "e", hot_rows)
    got = np.array([r["e"] for r in out.orderBy("t").collect()])
    want = [*brute_recursion(u[:330], [1, 4], [0.5, -0.4]), *brute_recursion(u[330:], [1, 4], [0.0, 0.9])]
    assert np.allclose(got, want)
    assert out.columns == ["s", "t", "u", "theta", "e"]


@pytest.mark.parametrize("hot_rows", [None, 100])
def test_moving_average_is_found_and_refitted(spark, hot_rows):
    grid = (range(2), range(2), range(1), range(2))
    x = np.concatenate([seasonal_series(700, 3, 0.7), seasonal_series(700, 4, 0.7)])
    df = frame(spark, s=np.repeat(["a", "b"], 700), t=np.arange(1400), x=x)
    table = arma.arma_table(df, "x", "t", "s", grid, 4, 9, hot_rows)
    assert table.count() == 2 * 8
    best = {r["s"]: r for r in arma.arma_select(table, "s").collect()}
    assert all(r["q"] == 1 for r in best.values())
    assert all(abs(r["coef"][2] - 0.7) < 0.15 for r in best.values())  # intercept, series lag, innovation lags
    if hot_rows:
        return
    selected = arma.arma_select(table, "s")
    again = arma.arma_refit(df.filter("t % 700 >= 350"), selected, "x", "t", "s", grid, 4, 9)
    assert {r["s"]: (r["p"], r["q"], r["sp"], r["sq"]) for r in again.collect()} == {s: (r["p"], r["q"], r["sp"], r["sq"]) for s, r in best.items()}
    out = arma.arma_predict(df, selected, "x", "t", "s", grid, 4).filter("predict <> 0").withColumn("r", F.col("x") - F.col("predict"))
    left = out.filter("t % 700 > 100").agg(F.stddev("r")).first()[0]
    assert left < 1.15  # the shocks have deviation 1; the difference itself 1.22


# --- unit root

def test_p_values():
    # critical values of the constant-only test
    for t, p in ((-3.43, 0.01), (-2.86, 0.05), (-2.57, 0.10)):
        assert abs(unitroot.p_value(t) - p) < 0.003
    assert unitroot.p_value(5) == 1 and unitroot.p_value(-30) == 0 and abs(unitroot.p_value(-1.61) - unitroot.p_value(-1.6099)) < 0.01


def test_unit_root_finds_lags(spark):
    rng = np.random.default_rng(5)
    e = rng.normal(size=(3, 900))
    stay, walk, deep = np.zeros(900), np.cumsum(e[1]), np.zeros(900)
    for t in range(3, 900):
        stay[t] = 0.3 * stay[t - 1] + e[0, t]
        deep[t] = 0.2 * deep[t - 1] + 0.5 * deep[t - 3] + e[2, t]
    df = frame(spark, s=np.repeat(["stay", "walk", "deep", "tiny"], [900, 900, 900, 6]), t=np.arange(2706), x=np.concatenate([stay, walk, deep, np.arange(6.0)]))
    got = {r["s"]: r for r in unitroot.unit_root_search(df, "x", "t", "s", max_lag=8).collect()}
    assert set(got) == {"stay", "walk", "deep"}
    assert got["stay"]["p_value"] < 0.001 and got["walk"]["p_value"] > 0.1 and got["deep"]["used_lag"] >= 2
    r, k = got["deep"], got["deep"]["used_lag"]
    d = np.diff(deep)
    y, cols = d[k:], [deep[k:-1], *[d[k - j: len(d) - j] for j in range(1, k + 1)], np.ones(len(d) - k)]
    m = np.column_stack(cols)
    b, rss = np.linalg.lstsq(m, y, rcond=None)[:2]
    se = math.sqrt(rss[0] / (len(y) - k - 2) * np.linalg.inv(m.T @ m)[0, 0])
    assert r["n"] == len(y) and math.isclose(r["gamma"], b[0], rel_tol=1e-6) and math.isclose(r["t_stat"], b[0] / se, rel_tol=1e-6)
    split = unitroot.unit_root_search(df, "x", "t", "s", max_lag=8, hot_rows=200).filter("s = 'deep'").first()
    assert math.isclose(split["t_stat"], r["t_stat"], rel_tol=1e-6)


# --- score baseline

def test_baseline_beats_the_line_on_a_curve(spark):
    rng = np.random.default_rng(6)
    a, b = rng.uniform(-2, 2, 3000), rng.uniform(-2, 2, 3000)
    y = np.sin(2 * a) * np.cos(b) + 2 + rng.normal(0, 0.1, 3000)
    df = frame(spark, id=np.arange(3000), a=a, b=b, y=y)
    train, test = df.filter("id < 2000"), df.filter("id >= 2000")
    table, out = baseline.nonlinear_baseline(train, test, "y", ["a", "b"], "id")
    assert table.count() == 9 and len({(r["strength"], r["gamma"]) for r in table.collect()}) == 9
    line = linear.apply_linear(test, linear.fit_linear(train, ["a", "b"], "y"), ["a", "b"])
    error = lambda d, c: d.agg(F.avg(F.pow(F.col("y") - F.col(c), 2))).first()[0]
    assert error(out, "predicted_score") < 0.3 * error(line, "predicted")
    assert out.filter("abs(relative_score - y / (predicted_score + 1)) > 1e-9").count() == 0


# --- itemsets

def brute_sets(rows, support, longest):
    found = {}
    for _, items in rows:
        own = sorted({i for i in items or [] if i is not None})
        for k in range(1, longest + 1):
            for s in itertools.combinations(own, k):
                found[s] = found.get(s, 0) + 1
    return {s: n for s, n in found.items() if n >= max(1, math.ceil(round(support * len(rows), 9)))}


@pytest.mark.parametrize("support,longest", [(0.1, 4), (0.4, 2)])
def test_itemsets_against_brute_force(spark, support, longest):
    rng = np.random.default_rng(7)
    rows = [(k, [i for i in "abcdefgh" if rng.random() < {"a": 0.9, "b": 0.8, "c": 0.7}.get(i, 0.2)]) for k in range(200)]
    rows += [(500, None), (501, []), (502, ["a", "a", None, "b"])]
    df = spark.createDataFrame(rows, "id long, items array<string>")
    want = brute_sets(rows, support, longest)
    got = {tuple(r["itemset"]): r["n"] for r in itemsets.frequent_itemsets(df, support, longest=longest).collect()}
    assert got == want
    total = sum(want.values())
    scores = {r["id"]: r["score"] for r in itemsets.rare_itemset_outliers(df, "id", min_support=support, longest=longest).collect()}
    for k, items in rows:
        own = {i for i in items or [] if i is not None}
        assert math.isclose(scores[k], 1 - sum(n for s, n in want.items() if set(s) <= own) / total, abs_tol=1e-9)


def test_itemsets_edges(spark):
    empty = spark.createDataFrame([], "id long, items array<string>")
    assert itemsets.frequent_itemsets(empty, 0.5).count() == 0
    alone = spark.createDataFrame([(k, [f"i{k}"]) for k in range(4)], "id long, items array<string>")
    assert {r["score"] for r in itemsets.rare_itemset_outliers(alone, "id", min_support=0.5).collect()} == {None}
