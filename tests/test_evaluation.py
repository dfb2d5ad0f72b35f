"""Curves and errors on small tables with ties and one-sided labels."""

import numpy as np
import pandas as pd
import pytest

from oddrows.operators import evaluation


@pytest.fixture(scope="module")
def tied(spark):
    rng = np.random.default_rng(12)
    s, y = np.round(rng.random(200) * 5, 1), (rng.random(200) < 0.3).astype(int)
    return s, y, spark.createDataFrame(pd.DataFrame({"id": np.arange(200), "s": s, "y": y})).repartition(6)


@pytest.mark.parametrize("hot", [None, 5])
def test_curves(tied, hot):
    s, y, df = tied
    for r in evaluation.roc_curve(df, "s", "y", hot_rows=hot).collect():
        assert r["tpr"] == pytest.approx((s[y == 1] >= r["threshold"]).mean())
        assert r["fpr"] == pytest.approx((s[y == 0] >= r["threshold"]).mean())
    for r in evaluation.pr_curve(df, "s", "y", hot_rows=hot).collect():
        assert r["precision"] == pytest.approx(y[s >= r["threshold"]].mean())
    pairs = (s[y == 1][:, None] > s[y == 0]).mean() + 0.5 * (s[y == 1][:, None] == s[y == 0]).mean()
    assert evaluation.roc_auc(df, "s", "y", hot_rows=hot).first()["auc"] == pytest.approx(pairs)


@pytest.mark.parametrize("spacing", ["equal", "log"])
def test_sweep(tied, spacing):
    s, y, df = tied
    out = evaluation.fbeta_sweep(df, "s", "y", 50, beta=2.0, spacing=spacing).collect()
    assert len(out) == 50
    for r in out:
        flag = s > r["threshold"]
        tp = (flag & (y == 1)).sum()
        if min(abs(s - r["threshold"])) > 1e-9:
            assert r["recall"] == pytest.approx(tp / y.sum())
            if flag.any():
                assert r["precision"] == pytest.approx(tp / flag.sum())
                assert r["fbeta"] == pytest.approx(5 * tp / (4 * y.sum() + flag.sum()))


def test_one_sided_labels(spark):
    ones = spark.createDataFrame([(1.0, 1), (2.0, 1)], "s double, y int")
    assert evaluation.roc_auc(ones, "s", "y").first()["auc"] is None
    row = evaluation.precision_recall_f1(spark.createDataFrame([(0, 0)], "p int, y int"), "p", "y").first()
    assert row["accuracy"] == 1.0 and row["precision"] is None and row["f1"] is None


def test_hit_rate_cuts_abnormal_rows(spark):
    rows = [(i, 0.1, 0) for i in range(3)] + [(i, 9.0 if i < 13 else 0.0, 1) for i in range(10, 20)]
    out = {r["part"]: (r["hits"], r["rows"]) for r in evaluation.threshold_hit_rate(
        spark.createDataFrame(rows, "k int, s double, y int"), "s", "y", 1.0, "k").collect()}
    assert out == {"normal": (3, 3), "abnormal": (3, 3)}


def test_regression_errors(spark):
    rng = np.random.default_rng(13)
    t = rng.normal(10, 3, 100)
    p = t + rng.normal(size=100)
    r = evaluation.regression_errors(spark.createDataFrame(pd.DataFrame({"t": t, "p": p})), "t", "p").first()
    assert r["corr"] == pytest.approx(np.corrcoef(p, t)[0, 1])
    assert r["rae"] == pytest.approx(abs(p - t).sum() / abs(t - t.mean()).sum())
    assert r["rrse"] == pytest.approx(np.sqrt(((p - t) ** 2).sum() / ((t - t.mean()) ** 2).sum()))
    assert r["mape"] == pytest.approx(abs((p - t) / t).mean() * 100)
    bad = evaluation.regression_errors(spark.createDataFrame([(1.0, 50.0), (2.0, -70.0)], "t double, p double"), "t", "p").first()
    assert bad["r2"] == 0.0
