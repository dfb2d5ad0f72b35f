"""Detectors against brute force and by their properties."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from oddrows.operators import clustering, forecast, forest, histogram, linear, neighbours, stats, thresholds
from oddrows.operators.scaling import zscore_apply, zscore_fit


def frame(spark, **columns):
    return spark.createDataFrame(pd.DataFrame(columns))


@pytest.fixture(scope="module")
def planted(spark):
    """Two clusters, a point repeated in a third of the rows, and three planted outliers."""
    rng = np.random.default_rng(1)
    a, b = rng.normal(0, 1, (150, 2)), rng.normal(8, 1, (130, 2))
    same = np.tile([[2.0, 2.0]], (140, 1))
    far = np.array([[40.0, -30.0], [-25.0, 35.0], [60.0, 60.0]])
    xy = np.vstack([a, b, same, far])
    return xy, frame(spark, id=np.arange(len(xy)), x=xy[:, 0], y=xy[:, 1]).repartition(5).persist()


def brute(points, queries, k, exclude_self):
    d = np.sqrt(((queries[:, None, :] - points[None, :, :]) ** 2).sum(axis=2))
    return np.sort(d, axis=1)[:, k if exclude_self else k - 1]


@pytest.mark.parametrize("cell", [5, 40, 1000])
@pytest.mark.parametrize("k", [1, 5])
def test_knn_two_columns(planted, cell, k):
    xy, df = planted
    got = {r["id"]: r["score"] for r in neighbours.knn_distance(df, ["x", "y"], k, cell_points=cell).collect()}
    assert np.allclose([got[i] for i in range(len(xy))], brute(xy, xy, k, True))


def test_knn_one_column_both_ways(planted):
    xy, df = planted
    want = brute(xy[:, :1], xy[:, :1], 5, True)
    for out in (neighbours.knn_distance(df, ["x"], 5, cell_points=20), neighbours.knn_distance_1d(df, "x", "id", 5)):
        got = {r["id"]: r["score"] for r in out.collect()}
        assert np.allclose([got[i] for i in range(len(xy))], want)
    counted = {r["id"]: r["score"] for r in neighbours.knn_distance_1d(df, "x", "id", 5, exclude_self=False).collect()}
    assert np.allclose([counted[i] for i in range(len(xy))], brute(xy[:, :1], xy[:, :1], 5, False))


def test_knn_new_rows(spark, planted):
    xy, df = planted
    new = np.array([[0.0, 0.0], [2.0, 2.0], [100.0, 100.0], [-3.0, 9.0]])
    asked = frame(spark, id=np.arange(4), x=new[:, 0], y=new[:, 1])
    got = {r["id"]: r["score"] for r in neighbours.knn_distance(df, ["x", "y"], 5, queries=asked, cell_points=30).collect()}
    assert np.allclose([got[i] for i in range(4)], brute(xy, new, 5, False))


def test_knn_visits_are_split(planted, monkeypatch):
    xy, df = planted
    monkeypatch.setattr(neighbours, "CELL_VISITS", 7)
    got = {r["id"]: r["score"] for r in neighbours.knn_distance(df, ["x", "y"], 5, cell_points=60).collect()}
    assert np.allclose([got[i] for i in range(len(xy))], brute(xy, xy, 5, True))


def test_knn_too_few_rows(spark):
    df = frame(spark, id=[0, 1, 2], x=[0.0, 1.0, 3.0], y=[0.0, 0.0, 0.0])
    assert all(r["score"] is None for r in neighbours.knn_distance(df, ["x", "y"], 5).collect())


def test_salaries(spark):
    """A hundred salaries with two planted ones: both are found, and new values are judged."""
    rng = np.random.default_rng(7)
    salary = rng.integers(1000, 2500, 100).astype(float)
    salary[[16, 65]] = [23, 17]
    df = frame(spark, row=np.arange(100), salary=salary)
    scored = neighbours.knn_distance_1d(df, "salary", "row", 5)
    flagged = thresholds.flag_above(scored, thresholds.fit_contamination(scored, "score", 0.02))
    assert {r["row"] for r in flagged.filter("is_outlier = 1").collect()} == {16, 65}
    limit = thresholds.fit_contamination(scored, "score", 0.02)
    probes = frame(spark, row=[0, 1], salary=[37.0, 1256.0])
    judged = thresholds.flag_above(neighbours.knn_distance(df, ["salary"], 5, queries=probes), limit)
    assert {r["row"]: r["is_outlier"] for r in judged.collect()} == {0: 1, 1: 0}


@pytest.mark.parametrize("columns", [["x"], ["x", "y"]])
def test_forest_ranks_planted_first(planted, columns):
    xy, df = planted
    trees = forest.fit_isolation_forest(df, columns, "id", trees=50, sample=128)
    top = forest.score_isolation_forest(df, trees, columns).orderBy(F.desc("score")).limit(3).collect()
    want = {420, 421, 422} if len(columns) == 2 else {420, 422, 421}
    assert {r["id"] for r in top} == want


def test_forest_is_repeatable_and_small(planted):
    _, df = planted
    a = forest.fit_isolation_forest(df.repartition(1), ["x", "y"], "id", trees=10, sample=32).toPandas()
    b = forest.fit_isolation_forest(df.repartition(9), ["x", "y"], "id", trees=10, sample=32).toPandas()
    order = ["tree", "node"]
    pd.testing.assert_frame_equal(a.sort_values(order).reset_index(drop=True), b.sort_values(order).reset_index(drop=True))
    assert (a[a.feature < 0].groupby("tree")["size"].sum() == 32).all()
    assert len(a) <= 10 * 2 * 32


def test_forest_draws_from_the_whole_table(spark):
    """Each tree draws at its rate, different trees draw different rows, and all of the table is reached."""
    df = spark.range(20_000).select(F.col("id").alias("_k"))
    each = forest._drawn(df, "_k", 20_000, 100, 0.02, 3)
    sizes = [r["count"] for r in each.groupBy("tree").count().collect()]
    assert len(sizes) == 100 and 300 < min(sizes) and max(sizes) < 500
    assert each.count() == each.distinct().count()
    assert 0.8 < each.select("_k").distinct().count() / (20_000 * (1 - 0.98**100)) < 1.2
    rows = forest._sampled(df, "_k", 100, 256, 3)
    assert {r["count"] for r in rows.groupBy("tree").count().collect()} == {256}
    assert rows.select("_k").distinct().count() > 10_000
    few = forest._sampled(df.limit(100), "_k", 7, 256, 3).groupBy("tree").count().collect()
    assert {(r["tree"], r["count"]) for r in few} == {(t, 100) for t in range(7)}


def test_constant_column_in_forest(spark):
    df = frame(spark, id=np.arange(20), x=np.full(20, 3.0))
    trees = forest.fit_isolation_forest(df, ["x"], "id", trees=3, sample=8)
    scores = {r["score"] for r in forest.score_isolation_forest(df, trees, ["x"]).collect()}
    assert len(scores) == 1


def test_lloyd_never_gets_worse(planted):
    _, df = planted
    fitted = clustering.lloyd(df, ["x", "y"], 3, 8)
    losses = [loss for _, loss in fitted.history]
    assert all(b <= a + 1e-9 for a, b in zip(losses, losses[1:]))
    assert sum(fitted.sizes) == df.count()
    flagged = clustering.kmeans_distance_outliers(df, fitted, 0.13).filter("is_outlier = 1").count()
    assert flagged >= int(0.13 * df.count())


def test_lloyd_goes_on_until_centres_stay(spark):
    rng = np.random.default_rng(3)
    xy = rng.uniform(0, 100, (3000, 2))
    df = frame(spark, id=np.arange(3000), x=xy[:, 0], y=xy[:, 1])
    fitted = clustering.lloyd(df, ["x", "y"], 4)
    assert len(fitted.history) > 11  # more than the ten rounds of before
    centres = np.array(fitted.centres)
    own = ((xy[:, None] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)
    assert np.allclose(centres, [xy[own == c].mean(axis=0) for c in range(4)], atol=1e-6)
    shifted = frame(spark, id=np.arange(3000), x=xy[:, 0] + 1e9, y=xy[:, 1])  # sums round worse than the tolerance
    assert sum(clustering.lloyd(shifted, ["x", "y"], 4, tolerance=0.0).sizes) == 3000


@pytest.mark.parametrize("sizes,want", [
    ([50, 45, 3, 2], {0, 1}), ([40, 30, 30], {0, 1, 2}), ([90, 5, 5], {0}), ([60, 31, 9], {0, 1}), ([10], {0}),
])
def test_large_clusters(sizes, want):
    assert set(clustering.large_clusters(sizes)) >= want if len(sizes) == 3 and want == {0, 1, 2} else \
        set(clustering.large_clusters(sizes)) == want


def test_kmeans_rounds_are_spread(spark, monkeypatch):
    """The points of one input partition lie in several files, so a round has several tasks; the centres are those of plain rounds."""
    monkeypatch.setattr(clustering, "ROWS_A_FILE", 250)
    seen, plain_round = [], clustering._round
    monkeypatch.setattr(clustering, "_round", lambda points, centres: seen.append(len(points.inputFiles())) or plain_round(points, centres))
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(0, 1, (600, 2)), rng.normal(5, 2, (400, 2))])
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], "x double, y double").coalesce(1)
    fitted = clustering.lloyd(df, ["x", "y"], 3, 6)
    assert set(seen) == {4}
    centres = np.array([[np.quantile(x[:, j], (i + 0.5) / 3) for j in range(2)] for i in range(3)])
    for _ in range(6):
        own = ((x[:, None, :] - centres[None, :, :]) ** 2).sum(axis=2).argmin(axis=1)
        centres = np.array([x[own == i].mean(axis=0) for i in range(3)])
    own = ((x[:, None, :] - centres[None, :, :]) ** 2).sum(axis=2).argmin(axis=1)
    assert np.allclose(fitted.centres, centres) and fitted.sizes == np.bincount(own, minlength=3).tolist()


def test_cblof_weights(planted):
    _, df = planted
    fitted = clustering.lloyd(df, ["x", "y"], 4, 4)
    plain = {r["id"]: r["score"] for r in clustering.cblof(df, fitted).collect()}
    heavy = clustering.cblof(df, fitted, use_weights=True).collect()
    for r in heavy:
        assert r["score"] == pytest.approx(plain[r["id"]] * fitted.sizes[r["cluster"]])
    assert max(plain, key=plain.get) in (420, 421, 422)


def test_hbos_against_numpy(spark, planted):
    xy, df = planted
    params = histogram.fit_hbos(df, ["x", "y"])
    got = {r["id"]: r["score"] for r in histogram.score_hbos(df, params, ["x", "y"]).collect()}
    want = np.zeros(len(xy))
    for c in range(2):
        dens, edges = np.histogram(xy[:, c], bins=10, density=True)
        at = np.minimum(np.digitize(xy[:, c], edges) - 1, 9)
        want -= np.log2(dens[at] + 0.1)
    assert np.allclose([got[i] for i in range(len(xy))], want)
    lo, hi = xy[:, 0].min(), xy[:, 0].max()
    width = (hi - lo) / 10
    new = frame(spark, x=[lo - 0.4 * width, lo - 2 * width, hi + 0.4 * width, hi + 2 * width], y=[0.0] * 4)
    s = [r["score"] for r in histogram.score_hbos(new, params, ["x"]).orderBy("x").collect()]
    table = {r["feature"]: r["scores"] for r in params.collect()}["x"]
    assert s == pytest.approx([-min(table), -table[0], -table[-1], -min(table)])


def test_pca_properties(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 20)) @ rng.normal(size=(20, 20)) + 5
    df = spark.createDataFrame([(int(i), [float(v) for v in row]) for i, row in enumerate(x)], "id int, v array<double>").repartition(6)
    params = linear.pca_fit(df, "v", width=20)
    rows = params.orderBy("component").collect()
    basis = np.array([r["vector"] for r in rows])
    assert np.allclose(basis @ basis.T, np.eye(20), atol=1e-9)
    assert sum(r["variance"] for r in rows) == pytest.approx(np.trace(np.cov(x.T)))
    errors = []
    for k in (1, 5, 20):
        scored = linear.reconstruction_error(df, linear.pca_fit(df, "v", k=k, width=20), "v")
        errors.append(scored.agg(F.sum("score")).first()[0])
    assert errors[0] > errors[1] > errors[2] and errors[2] == pytest.approx(0, abs=1e-9)
    small = linear.pca_fit(df.select(*[F.col("v")[i].alias(f"c{i}") for i in range(5)]), [f"c{i}" for i in range(5)], standardize=True)
    z = (x[:, :5] - x[:, :5].mean(0)) / x[:, :5].std(0)
    assert [r["variance"] for r in small.orderBy("component").collect()] == pytest.approx(sorted(np.linalg.eigvalsh(np.cov(z.T)))[::-1])


def test_ar_recovers_coefficients(spark):
    rng = np.random.default_rng(4)
    parts = []
    for s in range(2):
        x = np.zeros(3000)
        for i in range(2, 3000):
            x[i] = 1.0 + 0.5 * x[i - 1] - 0.3 * x[i - 2] + rng.normal(scale=0.1)
        parts.append(pd.DataFrame({"s": s, "t": np.arange(3000), "x": x}))
    df = spark.createDataFrame(pd.concat(parts)).repartition(4)
    for r in forecast.fit_ar(df, "x", 2, "t", "s").collect():
        assert r["coef"] == pytest.approx([1.0, 0.5, -0.3], abs=0.06)
    one = df.filter("s = 0")
    x = parts[0]["x"].to_numpy()
    lags = np.column_stack([np.ones(2990), *[x[10 - k:3000 - k] for k in range(1, 11)]])
    want = np.linalg.lstsq(lags, x[10:], rcond=None)[0]
    assert forecast.fit_ar(one, "x", 10, "t").first()["coef"] == pytest.approx(want.tolist(), abs=1e-6)


def test_features_of_very_different_size(spark):
    rng = np.random.default_rng(14)
    big, small = rng.normal(3e6, 1e5, 200), rng.normal(0.01, 1e-4, 200)
    y = 2 * big + 1e9 * small + rng.normal(size=200)
    df = frame(spark, big=big, small=small, y=y)
    coef = linear.fit_linear(df, ["big", "small"], "y").first()["coef"]
    assert coef[1] == pytest.approx(2, rel=1e-4) and coef[2] == pytest.approx(1e9, rel=1e-4)


def test_seasonal_select_finds_the_lag(spark):
    rng = np.random.default_rng(6)
    d = np.zeros(2000)
    for i in range(12, 2000):
        d[i] = 0.7 * d[i - 12] + rng.normal()
    x = np.cumsum(d)
    y = x.copy()
    for i in range(12, 2000):
        y[i] = x[i] + (y[i - 12] if i >= 12 else 0)
    df = frame(spark, t=np.arange(2000), x=y)
    best = forecast.seasonal_ar_select(forecast.seasonal_ar_table(df, "x", "t")).first()
    assert best["seasonal_order"] >= 1
    out = forecast.seasonal_ar_predict(df, spark.createDataFrame([best]), "x", "t").orderBy("t").toPandas()
    assert (out["predict"][:13] == 0).all()
    assert np.abs(out["x"] - out["predict"])[100:].mean() < 1.2


def test_unit_root(spark):
    rng = np.random.default_rng(9)
    noise = rng.normal(size=1000)
    series = {"white": noise, "walk": np.cumsum(noise)}
    df = frame(spark, t=np.arange(1000), **series)
    for name, x in series.items():
        d = np.diff(x)
        z = np.column_stack([np.ones(997), x[2:-1], d[1:-1], d[:-2]])
        b, rss = np.linalg.lstsq(z, d[2:], rcond=None)[:2]
        se = np.sqrt(rss[0] / (997 - 4) * np.linalg.inv(z.T @ z)[1, 1])
        row = forecast.unit_root_test(df, name, "t", lags=2).first()
        assert row["t_stat"] == pytest.approx(b[1] / se, rel=1e-6) and row["n"] == 997
    assert forecast.unit_root_test(df, "white", "t", lags=2).first()["t_stat"] < -3.43


def test_gaussian_score_is_mahalanobis(spark):
    rng = np.random.default_rng(10)
    e = rng.normal(size=(400, 3)) @ rng.normal(size=(3, 3))
    df = frame(spark, id=np.arange(400), a=e[:, 0], b=e[:, 1], c=e[:, 2])
    params = stats.error_mean_cov(df, ["a", "b", "c"])
    got = {r["id"]: r["score"] for r in forecast.gaussian_score(df, params, ["a", "b", "c"], ridge=0.0).collect()}
    z = e - e.mean(0)
    want = np.einsum("ij,jk,ik->i", z, np.linalg.inv(np.cov(e.T)), z)
    assert np.allclose([got[i] for i in range(400)], want)


def test_cross_validation_prefers_signal(spark):
    rng = np.random.default_rng(11)
    f = rng.normal(size=500)
    df = frame(spark, id=np.arange(500), f=f, score=3 * f + rng.normal(scale=0.1, size=500))
    table, out = forecast.adaptive_threshold(df, df, "score", ["f"], "id", ridges=(0.0, 10.0))
    mse = {r["ridge"]: r["mse"] for r in table.collect()}
    assert mse[0.0] < mse[10.0] and mse[0.0] == pytest.approx(0.01, rel=0.3)
    assert out.filter("predicted_score is null").count() == 0


def test_error_bands_modes(spark):
    flat = frame(spark, date=np.arange(10), actuals=[5.0] * 10, predicted=[4.0] * 10)
    default = thresholds.rolling_error_bands(flat, 3).orderBy("date").collect()
    assert [r["color"] for r in default] == [None, None] + [0] * 8
    severe = thresholds.rolling_error_bands(flat, 3, missing_is_severe=True).collect()
    assert {r["color"] for r in severe} == {3}
    dirty = frame(spark, date=[0], actuals=[float("nan")], predicted=[float("inf")])
    row = thresholds.rolling_error_bands(dirty, 3).first()
    assert row["error"] == 0.0 and row["percentage_change"] is None


def test_scaler_zero_std_and_split(spark):
    df = frame(spark, g=["a", "a", "b", "b"], x=[3.0, 3.0, 1.0, 5.0])
    out = zscore_apply(df, zscore_fit(df, "x", "g"), "x", "g").orderBy("g", "x").collect()
    assert [r["x"] for r in out] == [0.0, 0.0, -1.0, 1.0]


def test_average_path():
    assert forest.average_path(1) == 0 and forest.average_path(2) == 1
    assert forest.average_path(256) == pytest.approx(2 * (math.log(255) + 0.5772156649) - 2 * 255 / 256)
