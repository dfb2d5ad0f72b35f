"""Labels and splits by ranges: the look-up and the ordered merge against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from oddrows.operators import joins

CASES = [(512, None), (0, None), (0, 40)]


def made(seed=1):
    rng = random.Random(seed)
    rows = [(k, rng.choice(["a", "a", "a", "b", None]), rng.choice([None, *range(60)] if k % 9 == 0 else range(60))) for k in range(300)]
    ranges = [(rng.choice("abc"), lo, lo + rng.randint(-1, 9), rng.choice(["train", "valid", "test"])) for lo in (rng.randrange(60) for _ in range(40))]
    ranges += [("a", 5, 9, "train"), ("a", 9, 12, "train"), (None, 0, 60, "train"), ("b", None, 4, "test"), ("b", 1, None, "test")]
    return rows, ranges


def tables(spark, rows, ranges):
    return (spark.createDataFrame(rows, "id long, f string, at int").repartition(4),
            spark.createDataFrame(ranges, "f string, lo int, hi int, split string"))


@pytest.mark.parametrize("few,hot_rows", CASES)
def test_labels(spark, few, hot_rows):
    rows, ranges = made()
    df, by = tables(spark, rows, ranges)
    got = {r["id"]: r["label"] for r in joins.label_by_ranges(df, by, "at", "f", few=few, hot_rows=hot_rows).collect()}
    whole = [r for r in ranges if None not in r]
    assert got == {i: int(at is not None and any(f == g and lo < at < hi for g, lo, hi, _ in whole)) for i, f, at in rows}


@pytest.mark.parametrize("few,hot_rows", CASES)
def test_splits(spark, few, hot_rows):
    rows, ranges = made(2)
    df, by = tables(spark, rows, ranges)
    got = sorted((r["id"], r["split"]) for r in joins.split_by_ranges(df, by, "at", "f", few=few, hot_rows=hot_rows).collect())
    whole = [r for r in ranges if None not in r]
    assert got == sorted({(i, s) for i, f, at in rows for g, lo, hi, s in whole if at is not None and f == g and lo <= at < hi})


@pytest.mark.parametrize("few,hot_rows", CASES)
def test_one_file_without_a_key(spark, few, hot_rows):
    rows, ranges = made(3)
    df, by = tables(spark, rows, [r for r in ranges if None not in r])
    got = {r["id"]: r["label"] for r in joins.label_by_ranges(df, by.drop("f"), "at", few=few, hot_rows=hot_rows).collect()}
    assert got == {i: int(at is not None and any(lo < at < hi for _, lo, hi, s in ranges if lo is not None and hi is not None and _)) for i, f, at in rows}
    none = joins.label_by_ranges(df, by.limit(0), "at", "f", few=few, hot_rows=hot_rows)
    assert none.count() == 300 and none.filter("label <> 0").count() == 0


def test_segments_are_disjoint(spark):
    _, ranges = made(4)
    by = tables(spark, [(1, "a", 1)], ranges)[1]
    found = sorted((r["f"] or "", r["lo"], r["hi"]) for r in joins.disjoint_segments(by, "f").collect())
    assert all(a[0] != b[0] or a[2] <= b[1] for a, b in zip(found, found[1:]))


def test_a_million_ranges(spark):
    ranges = spark.range(1_000_000).select(F.lit("a").alias("f"), (F.col("id") * 10).alias("lo"), (F.col("id") * 10 + 5).alias("hi"))
    rows = spark.range(200_000).select(F.lit("a").alias("f"), (F.col("id") * 50 + F.col("id") % 10).alias("at"))
    out = joins.label_by_ranges(rows, ranges, "at", "f", hot_rows=500_000)
    assert out.filter((F.col("label") == 1) != (F.col("at") % 10).between(1, 4)).count() == 0 and out.count() == 200_000
