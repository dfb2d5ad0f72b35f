"""Importance resampling, centroid clustering and top-k search against brute force, and their edge cases."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from oddrows.llm import centroids, importance, topk
from oddrows.llm.vectors import whole_numbers

SCHEMA = "doc_id long, text string, row string, rank int, score string"
VECTORS = "vec_id long, embedding array<float>, cluster int, score string, key string"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "r", 1, "s") for i, t in rows], SCHEMA)


def vectors_of(spark, rows):
    return spark.createDataFrame([(i, v, 1, "s", "k") for i, v in rows], VECTORS)


# --- importance resampling

def words_in(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def features(text):
    w = words_in(text)
    return [" ".join(w[i:i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def brute_sample(rows, target, percent=5, min_words=20):
    bucket = lambda f: zlib.crc32(f.encode()) % 10000
    s = collections.Counter(bucket(f) for _, t in rows for f in features(t))
    t = collections.Counter(bucket(f) for x in target for f in features(x))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (all_s + 10000) / ((s[b] + 1) * (all_t + 10000))))
    out = []
    for i, x in rows:
        f = features(x)
        weight = sum(gain(bucket(y)) for y in f)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(f), weight, score, None, len(words_in(x)) >= min_words])
    able = [r for r in out if r[5]]
    for k, r in enumerate(sorted(able, key=lambda r: (-r[3], r[0] is not None, r[0] or 0))[: percent * len(able) // 100]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in out), key=repr)


def sample_rows(n, seed):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(300)] + ["É", "don't", "ß", "日本", "x" * 70, "y" * 300]
    return [(k, rng.choice([" ", ", ", "\n"]).join(rng.choice(vocabulary) for _ in range(rng.choice([0, 2, 19, 20, 60, 150])))) for k in range(n)]


def test_feature_buckets_are_crc32_of_the_joined_words():
    texts = ["One two, THREE four", None, "", "a" * 64 + " " + "b" * 65 + " " + "c" * 5000 + " d", "É日本 x", "...", "last"]
    found, begins, at = importance.feature_buckets(pa.array(texts), 3, 10_000)
    got = collections.Counter(int(b) for f in found for b in f)
    assert got == collections.Counter(zlib.crc32(f.encode()) % 10_000 for t in texts for f in features(t))
    assert np.diff(at).tolist() == [len(words_in(t)) for t in texts]


@pytest.mark.parametrize("accuracy", [importance.ACCURACY, 20])
def test_importance_sample_against_brute_force(spark, accuracy):
    rows = sample_rows(400, 1)
    rows += [(1000, None), (1001, ""), (1002, "…"), (1003, "long word " * 60_000), (None, "w1 w2 w3 w4 " * 20), (5, rows[5][1])]
    target = [t for _, t in sample_rows(30, 2)] + [None, "w1 w2 w3 " * 200]
    bench = spark.createDataFrame([(t, 1) for t in target], "text string, bucket int")
    got = importance.importance_sample(docs_of(spark, rows), bench, accuracy=accuracy)
    got = got.select("doc_id", "n_features", "weight", "score", "rank").collect()
    assert sorted(map(tuple, got), key=repr) == brute_sample(rows, target)
    assert max(r["rank"] for r in got if r["rank"]) == 5 * sum(len(words_in(t)) >= 20 for _, t in rows) // 100


def test_importance_sample_ties(spark):
    """Equal rows have equal scores: exactly as many as fit are drawn, with ranks 1, 2, ..."""
    text = "a b c d e " * 5
    rows = [(7, text)] * 60 + [(None, text)] * 20
    got = importance.op11(docs_of(spark, rows), docs_of(spark, [(1, "a b c")])).collect()
    assert sorted(r["rank"] for r in got if r["rank"]) == [1, 2, 3, 4] and len(got) == 80
    one = {r["doc_id"]: r["score"] for r in got}
    first = 7 if one[7] > one[None] else None
    assert all(r["doc_id"] == first for r in got if r["rank"])


def test_importance_sample_edges(spark):
    bench = docs_of(spark, [(1, "x y z")])
    assert importance.op11(docs_of(spark, []), bench).count() == 0
    few = importance.op11(docs_of(spark, [(1, "too few words"), (2, None)]), bench.limit(0)).collect()
    assert {(r["doc_id"], r["n_features"], r["rank"]) for r in few} == {(1, 6, None), (2, 0, None)}


# --- centroid clustering

def brute_clusters(rows, k=16, rounds=3):
    kept = [(i, [math.floor(64 * x) for x in v]) for i, v in rows
            if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centres = [v for _, v in order[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centres))
    for _ in range(rounds):
        own = [near(v)[1] for _, v in kept]
        for n in range(len(centres)):
            inside = [v for (_, v), o in zip(kept, own) if o == n]
            if inside:
                centres[n] = [sum(c) // len(inside) for c in zip(*inside)]
    last = [(i, *near(v)) for i, v in kept]
    total = collections.Counter()
    for _, d, n in last:
        total[n] += d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(((i, n, d, total[n], sum(total.values()), digest[n]) for i, d, n in last), key=repr)


def vector_rows(n, seed, spread=0.3):
    rng = np.random.default_rng(seed)
    heads = rng.normal(size=(6, 64))
    return [(k, (heads[k % 6] * 0.4 + rng.normal(size=64) * spread).astype(np.float32).tolist()) for k in range(n)]


ODD = [(900, None), (901, []), (902, [0.5] * 63), (903, [0.5] * 65), (904, [None] + [0.1] * 63), (905, [float("nan")] + [0.1] * 63),
       (906, [float("inf")] + [0.1] * 63), (907, [0.0] * 64), (907, [0.0] * 64), (None, [0.25] * 64)]


@pytest.mark.parametrize("n", [0, 5, 300])
def test_clusters_against_brute_force(spark, n):
    rows = vector_rows(n, 3) + ODD
    got = sorted(map(tuple, centroids.op12(vectors_of(spark, rows)).collect()), key=repr)
    assert got == brute_clusters(rows)


def test_search_rejects_and_keeps_ties():
    rng = np.random.default_rng(1)
    centres = np.concatenate([rng.integers(-20, 20, (40, 64)), np.zeros((3, 64), int), rng.integers(-9, 90, (40, 64))])
    x = np.concatenate([rng.integers(-20, 90, (500, 64)), np.zeros((5, 64), int), centres])
    number, best, computed = centroids.SortedCentroids(centres).nearest(x)
    d = ((x[:, None, :] - centres[None, :, :]) ** 2).sum(axis=2)
    assert (number == d.argmin(axis=1)).all() and (best == d.min(axis=1)).all()
    assert computed < 0.7 * d.size


def test_clusters_edges(spark):
    assert centroids.op12(vectors_of(spark, [])).count() == 0
    assert centroids.op12(vectors_of(spark, ODD[:7])).count() == 0
    same = centroids.op12(vectors_of(spark, [(k, [1.0] * 64) for k in range(40)])).collect()
    assert {(r["cluster"], r["distance"]) for r in same} == {(0, 0)}


# --- top-k search

def brute_top(rows, k=5, every=50, scale=256):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for i, q in kept:
        if i % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in kept if j != i)[:k]
            out |= {(i, r + 1, j, -s) for r, (s, j) in enumerate(scores)}
    return sorted(out)


@pytest.mark.parametrize("tile,shard,fan,scale", [(topk.TILE_QUERIES, None, topk.FAN, 256), (7, 40, 2, 256), (7, 40, 3, 100_000), (50, 90, 2, 60_000_000)])
def test_top_k_against_brute_force(spark, tile, shard, fan, scale):
    rows = [(7 * k - 300, v) for k, v in vector_rows(700, 4, 0.02)]
    rows += [(i + 10_000, v) for i, v in ODD if i] + [(None, [9.0] * 64)] + [(20_000 + k, rows[3][1]) for k in range(60)]
    rows = [(i, None if v is None else [x if x is None or not math.isfinite(x) else float(np.clip(x, -2, 2)) for x in v]) for i, v in rows]
    got = topk.top_k(vectors_of(spark, rows), topk.F.col("vec_id") % 50 == 0, scale=scale, tile_queries=tile, shard_rows=shard, fan=fan)
    assert sorted(map(tuple, got.collect())) == brute_top(rows, scale=scale)


def test_top_k_edges(spark):
    assert topk.op13(vectors_of(spark, [])).count() == 0
    rows = [(0, [1.0, 2.0]), (1, [1.0]), (2, []), (3, None), (50, [0.0, 0.0, 5.0]), (0, [1.0, 2.0]), (7, [4.0, 4.0]), (7, [4.0, 4.0])]
    got = sorted(map(tuple, topk.op13(vectors_of(spark, rows)).collect()))
    one = 256 * 256
    assert got == [(0, 1, 7, 12 * one), (0, 2, 7, 12 * one), (0, 3, 1, one), (0, 4, 2, 0), (0, 5, 50, 0),
                   (50, 1, 0, 0), (50, 2, 0, 0), (50, 3, 1, 0), (50, 4, 2, 0), (50, 5, 7, 0)]
    assert topk.op13(vectors_of(spark, [(50, [1.0])])).count() == 0


def test_product_is_exact():
    rng = np.random.default_rng(5)
    for top in (200, 70_000, 1 << 27):
        a, b = (rng.integers(-top, top + 1, (9, 64)) for _ in range(2))
        want = [[sum(int(x) * int(y) for x, y in zip(u, v)) for v in b] for u in a]
        assert topk._product(a, b).astype(object).tolist() == want


def test_whole_numbers_of_sliced_columns():
    column = pa.array([[1.0], None, [0.5, None], [2.5, -2.5], []]).slice(1)
    rows, vectors = whole_numbers(column, 2)
    assert rows.tolist() == [2, 3] and [v.tolist() for v in vectors] == [[5, -5], []]
