"""Neighbour lists in any number of columns against brute force."""

from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from oddrows.functions import meeting
from oddrows.functions.lineage import shared_folder
from oddrows.operators import nearest


def table(spark, x, extra=()):
    rows = [(k, [float(c) for c in v]) for k, v in enumerate(x)] + list(extra)
    return spark.createDataFrame(rows, "id long, v array<double>").repartition(4)


def distances(x):
    d = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(axis=2))
    np.fill_diagonal(d, np.inf)
    return d


def brute_lof(x, k):
    d = distances(x)
    kd = np.sort(d, axis=1)[:, k - 1]
    near = d <= kd[:, None]
    reach = np.where(near, np.maximum(kd[None, :], np.where(near, d, 0)), 0)
    density = near.sum(axis=1) / (reach.sum(axis=1) + 1e-10 * near.sum(axis=1))
    return (near * density[None, :]).sum(axis=1) / near.sum(axis=1) / density


@pytest.fixture(scope="module")
def clouds():
    """Two clusters in eight columns, half the rows on one point, and three rows far away."""
    rng = np.random.default_rng(2)
    a, b = rng.normal(0, 1, (90, 8)), rng.normal(6, 0.5, (70, 8))
    return np.vstack([a, b, np.full((163, 8), 3.0), rng.normal(0, 1, (3, 8)) * 40])


def scores(df):
    return {r["id"]: r["score"] for r in df.select("id", "score").collect()}


@pytest.mark.parametrize("k,cell,fan", [(5, 10, 3), (40, 25, 8)])
def test_distance_in_many_columns(spark, clouds, k, cell, fan):
    got = scores(nearest.knn_distance(table(spark, clouds), "v", k, cell, fan))
    assert np.allclose([got[i] for i in range(len(clouds))], np.sort(distances(clouds), axis=1)[:, k - 1])


def test_distance_spread_over_salts(spark, clouds, monkeypatch):
    monkeypatch.setattr(meeting, "VISITS", 7)
    got = scores(nearest.knn_distance(table(spark, clouds), "v", 5, 20, 4))
    assert np.allclose([got[i] for i in range(len(clouds))], np.sort(distances(clouds), axis=1)[:, 4])


def test_cells_are_split_until_they_are_small(spark):
    rng = np.random.default_rng(4)
    x = np.exp(rng.uniform(0, 12, (3000, 3)))  # most points lie in a corner
    points = nearest.as_points(table(spark, x), "v")
    cells = nearest.build_cells(points, 50, 8)
    sizes = [r["count"] for r in cells.placed.groupBy("cell").count().collect()]
    assert max(sizes) <= 50 and sum(sizes) == 3000 and cells.levels > 2
    assert cells.placed.agg(F.min(F.size("up"))).first()[0] >= 2


def test_visits_are_fewer_than_all(spark):
    rng = np.random.default_rng(5)
    x = rng.uniform(0, 100, (2000, 3))
    points = nearest.as_points(table(spark, x), "v")
    cells = nearest.build_cells(points, 60, 8)
    asking = cells.placed.select("pid", "v", F.lit(8.0).alias("r"), F.col("cell").alias("home"))
    leaves = cells.nodes.filter("leaf").count()
    visits = nearest._descend(cells.nodes, asking, cells.levels).count()
    assert visits < 0.25 * 2000 * leaves


@pytest.mark.parametrize("k,cell", [(12, 40)])
def test_local_outlier_factor(spark, clouds, k, cell):
    x = clouds[:-100]
    got = scores(nearest.local_outlier_factor(table(spark, x), "v", k, cell, 4))
    want = brute_lof(x, k)
    assert np.allclose([got[i] for i in range(len(x))], want, rtol=1e-6)


def test_local_outlier_factor_finds_planted_rows(spark):
    rng = np.random.default_rng(6)
    x = np.vstack([rng.normal(0, 0.1, (150, 3)), rng.normal(10, 2, (150, 3)), [[0.9, 0.9, 0.9], [20.0, 1.0, 20.0]]])
    df = spark.createDataFrame([(k, *map(float, v)) for k, v in enumerate(x)], "id long, a double, b double, c double")
    top = nearest.local_outlier_factor(df, ["a", "b", "c"], 15).orderBy(F.desc("score")).limit(2)
    assert {r["id"] for r in top.collect()} == {300, 301}


def test_lattice_ties_stay(spark):
    """On a lattice every row has many neighbours at the k-th distance; all of them count."""
    x = np.array([[a, b, c] for a in range(6) for b in range(6) for c in range(6)], float)
    lists = nearest.neighbour_lists(nearest.as_points(table(spark, x), "v"), 2, 20, 4).groupBy("pid").count()
    want = sorted((distances(x) <= 1).sum(axis=1).tolist())
    assert sorted(r["count"] for r in lists.collect()) == want
    got = scores(nearest.local_outlier_factor(table(spark, x), "v", 2, 20, 4))
    assert np.allclose([got[i] for i in range(len(x))], brute_lof(x, 2))


def test_few_and_odd_rows(spark):
    odd = [(10, None), (11, [1.0, None]), (12, [float("nan"), 1.0]), (13, [-0.0, 0.0])]
    got = scores(nearest.knn_distance(table(spark, np.array([[0.0, 0.0], [3.0, 4.0]]), odd), "v", 2))
    assert got == {0: 5.0, 1: 5.0, 13: 5.0, 10: None, 11: None, 12: None}
    assert set(scores(nearest.knn_distance(table(spark, np.array([[0.0, 0.0], [3.0, 4.0]]), odd), "v", 3)).values()) == {None}
    assert nearest.local_outlier_factor(table(spark, np.zeros((0, 2))), "v", 2).count() == 0
    same = scores(nearest.local_outlier_factor(table(spark, np.ones((30, 4))), "v", 5))
    assert set(same.values()) == {1.0}


def bytes_below(folder):
    return sum(f.stat().st_size for f in Path(folder.removeprefix("file:")).rglob("*.parquet"))


def test_points_that_reach_all_cells_are_not_copied_for_each(spark):
    """Without structure in many columns every ball reaches every cell; what is written follows the points, not points times cells."""
    x = np.random.default_rng(7).normal(0, 1, (2000, 24))
    df = table(spark, x)
    before = bytes_below(shared_folder(spark))
    got = scores(nearest.knn_distance(df, "v", 5, 30, 12))
    assert bytes_below(shared_folder(spark)) - before < 25 * x.nbytes
    assert np.allclose([got[i] for i in range(len(x))], np.sort(distances(x), axis=1)[:, 4])


@pytest.mark.parametrize("k,cell,fan", [(5, 10, 3), (40, 25, 8)])
def test_all_points_over_tiles(spark, clouds, monkeypatch, k, cell, fan):
    for name, value in (("MOST_CELLS", 0), ("TILE_PAIRS", 5000), ("TILE_BYTES", 4000), ("_STRIPE", 16), ("_ROWS", 32), ("HOT_ROWS", 20)):
        monkeypatch.setattr(nearest, name, value)
    got = scores(nearest.knn_distance(table(spark, clouds, [(900, None), (901, [None] * 8)]), "v", k, cell, fan))
    assert np.allclose([got[i] for i in range(len(clouds))], np.sort(distances(clouds), axis=1)[:, k - 1])
    assert got[900] is None and got[901] is None and len(got) == len(clouds) + 2


def test_lattice_ties_stay_over_tiles(spark, monkeypatch):
    for name, value in (("MOST_CELLS", 0), ("TILE_PAIRS", 5000), ("TILE_BYTES", 1500), ("_STRIPE", 16)):
        monkeypatch.setattr(nearest, name, value)
    x = np.array([[a, b, c] for a in range(6) for b in range(6) for c in range(6)], float)
    lists = nearest.neighbour_lists(nearest.as_points(table(spark, x), "v"), 2, 20, 4).groupBy("pid").count()
    assert sorted(r["count"] for r in lists.collect()) == sorted((distances(x) <= 1).sum(axis=1).tolist())


def test_local_outlier_factor_over_tiles(spark, clouds, monkeypatch):
    for name, value in (("MOST_CELLS", 0), ("TILE_PAIRS", 5000), ("TILE_BYTES", 4000)):
        monkeypatch.setattr(nearest, name, value)
    x = clouds[:-100]
    got = scores(nearest.local_outlier_factor(table(spark, x), "v", 12, 40, 4))
    assert np.allclose([got[i] for i in range(len(x))], brute_lof(x, 12), rtol=1e-6)


def test_vectors_are_written_few_times(spark):
    """Floats stay floats; levels of cells, lists and scores go by ids, so vectors are written as points, at home and in blocks only."""
    x = np.random.default_rng(8).normal(0, 1, (1500, 32)).astype(np.float32)
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "id long, v array<float>").repartition(4)
    before = bytes_below(shared_folder(spark))
    got = scores(nearest.local_outlier_factor(df, "v", 4, 30, 12))
    assert bytes_below(shared_folder(spark)) - before < 7 * x.nbytes
    assert np.allclose([got[i] for i in range(len(x))], brute_lof(x.astype(float), 4), rtol=1e-6)


def test_vectors_of_one_hash(spark, clouds, monkeypatch):
    monkeypatch.setattr(nearest, "_pid", lambda v: F.pmod(F.xxhash64(v), F.lit(3)), raising=False)
    got = scores(nearest.knn_distance(table(spark, clouds, [(900, None)]), "v", 5, 60, 4))
    assert np.allclose([got[i] for i in range(len(clouds))], np.sort(distances(clouds), axis=1)[:, 4]) and got[900] is None
