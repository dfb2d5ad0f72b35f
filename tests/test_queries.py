"""Every registered query against its SQL on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_points
from oddrows.plans import catalog

SF = os.environ.get("ODDROWS_TEST_SF", "0.001")
FOLDER = f"/root/testdata/sf{SF}"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


def rows(columns, values):
    """Rows with columns in name order, sorted by their exact columns first."""
    order = sorted(columns)
    place = [list(columns).index(c) for c in order]
    table = [tuple(v[i] for i in place) for v in values]
    exact = lambda r: repr([v for v in r if not isinstance(v, float)])
    near = lambda r: [v for v in r if isinstance(v, float)]
    return order, sorted(table, key=lambda r: (exact(r), near(r)))


def same(a, b):
    """Equal up to one unit of the rounded digits (a sum may end on a rounding tie)."""
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, rel_tol=1e-6, abs_tol=2e-6)
    return a == b


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, db, name):
    df = catalog.QUERIES[name](spark, FOLDER)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    if name not in catalog.ORACLES:
        assert got[1]
        return
    cursor = db.execute(catalog.ORACLES[name])
    want = rows([c[0] for c in cursor.description], cursor.fetchall())
    assert got[0] == want[0] and len(got[1]) == len(want[1])
    for g, w in zip(got[1], want[1]):
        assert all(same(x, y) for x, y in zip(g, w)), (g, w)


def test_entry(spark):
    out = entry_points.entry(spark)
    assert out.columns == ["color", "region", "n"] and out.count() > 0
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
