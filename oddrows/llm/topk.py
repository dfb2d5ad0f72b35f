"""Exact top-k search by inner product: tiled matrix products, partial selection per tile, tree merging.

A component x becomes floor(scale * x). The queries are dealt to tiles of about `tile_queries` rows and all vectors to shards; a tile and a
shard make a cell, which is one task: it reads its queries (sorted before the vectors) as one matrix and streams the
vectors past it, so it holds one tile of queries and one batch of vectors whatever the table's size. Products of sub-tiles run as
matrix products in single or double precision where all sums are exact there, in 64-bit integers otherwise. Each product is
partially selected to k entries a query, and a sub-tile without a product that reaches the k-th score so far is passed
over. What leaves a cell is one list of k a query. The lists are merged as a tree, `fan` at a time. A query is
moved once per shard and a vector once per tile of queries.

Defined cases: null vectors, vectors with a null, NaN or infinite component or one beyond 2^27 after scaling (the product would
not fit a long), and rows without vec_id take no part; missing components of a shorter vector count as zero, so an empty vector scores 0; of
equal scores the smaller vec_id comes first; rows that share a query's vec_id are never its candidates; repeated rows are candidates
each, repeated query rows give one list; an empty table gives an empty result. Columns of other names are ignored."""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oddrows.functions.lineage import written
from oddrows.llm.vectors import whole_numbers

SCALE = 256
EVERY = 50
K = 5
#: queries held by a task (about 300 bytes each as a matrix, and k results), and vectors streamed past them
TILE_QUERIES = 65_536
SHARD_ROWS = 16_384
MOST_SHARD_ROWS = 1_000_000
FAN = 16
#: rows and columns of one matrix product
_TILE, _STRIPE = 1024, 4096


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact a @ b.T of integer matrices, in the fastest kind of number that holds every partial sum."""
    largest = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * a.shape[1]
    kind = np.float32 if largest <= 1 << 24 else np.float64 if largest <= 1 << 53 else np.int64
    return a.astype(kind) @ b.astype(kind).T


class Best:
    """The k best of every query so far: scores falling, of equal ones the smaller id first."""

    def __init__(self, ids: np.ndarray, k: int):
        self.own, self.k = ids, k
        self.score = np.full((len(ids), k), np.iinfo(np.int64).min)
        self.id = np.full((len(ids), k), np.iinfo(np.int64).max)

    def add(self, rows: slice, product: np.ndarray, ids: np.ndarray) -> None:
        """Take in the products of some queries with vectors in order of their ids."""
        own = self.own[rows]
        k = min(self.k, product.shape[1])
        hidden = product.dtype.type(-np.inf) if product.dtype.kind == "f" else np.iinfo(np.int64).min
        low, high = np.searchsorted(ids, own, "left"), np.searchsorted(ids, own, "right")
        for r in np.flatnonzero(low < high):  # the query itself is in this stripe
            product[r, low[r]: high[r]] = hidden
        floor = self.score[rows, -1]
        some = np.flatnonzero(product.max(axis=1) >= floor)  # an equal score may still have a smaller id
        if not len(some):
            return
        product = product[some]
        least = np.partition(product, product.shape[1] - k, axis=1)[:, product.shape[1] - k]
        over, tied = product > least[:, None], product == least[:, None]
        room = k - over.sum(axis=1)
        take = over | (tied & (np.cumsum(tied, axis=1) <= room[:, None]))  # exactly k a row, the first of equal ones
        at = np.nonzero(take)[1].reshape(len(some), k)
        found = np.take_along_axis(product, at, axis=1)
        hit = ids[at]
        gone = found == hidden
        score = np.where(gone, np.iinfo(np.int64).min, np.where(gone, 0, found).astype(np.int64))
        hit = np.where(gone, np.iinfo(np.int64).max, hit)
        row = np.arange(len(self.own))[rows][some]
        score, hit = np.concatenate([self.score[row], score], axis=1), np.concatenate([self.id[row], hit], axis=1)
        order = np.lexsort((hit, ~score), axis=1)[:, : self.k]  # ~score falls as score rises
        self.score[row], self.id[row] = np.take_along_axis(score, order, axis=1), np.take_along_axis(hit, order, axis=1)


def _padded(vectors: list[np.ndarray], dims: int) -> np.ndarray:
    """One matrix of vectors, shorter ones filled with zeros, longer ones cut (their rest meets only zeros)."""
    if all(len(v) == dims for v in vectors):
        return np.stack(vectors) if vectors else np.zeros((0, dims), np.int64)
    out = np.zeros((len(vectors), dims), np.int64)
    for i, v in enumerate(vectors):
        out[i, : min(dims, len(v))] = v[:dims]
    return out


def _stripes(pieces: list[tuple[np.ndarray, list[np.ndarray]]], size: int):
    """The collected vectors as (ids, vectors) of at most `size` rows, in order."""
    ids, vectors = np.concatenate([p[0] for p in pieces]), [v for p in pieces for v in p[1]]
    for at in range(0, len(ids), size):
        yield ids[at: at + size], vectors[at: at + size]


def _search_cell(pieces: Iterator[tuple[bool, np.ndarray, list, np.ndarray]], k: int) -> tuple[list, Best] | None:
    """One cell: (is_query, ids, keys, vectors) pieces, the queries first."""
    keys, own, held, best, matrix, dims = [], [], [], None, None, 0

    def flush() -> None:
        for ids, vectors in _stripes(held, _STRIPE):
            b = _padded(vectors, dims)
            for at in range(0, len(matrix), _TILE):
                best.add(slice(at, at + _TILE), _product(matrix[at: at + _TILE], b), ids)
        held.clear()

    waiting = 0
    for is_query, ids, key, vectors in pieces:
        if is_query:
            keys += key
            own.append((ids, vectors))
            continue
        if not own:  # vectors of a cell without queries
            continue
        if matrix is None:
            ids_of, vectors_of = np.concatenate([o[0] for o in own]), [v for o in own for v in o[1]]
            dims = max(map(len, vectors_of))
            matrix, best = _padded(vectors_of, dims), Best(ids_of, k)
        held.append((ids, vectors))
        waiting += len(ids)
        if waiting >= _STRIPE:
            flush()
            waiting = 0
    if matrix is None:
        return None
    if held:
        flush()
    return keys, best


def _cells(batches: Iterator[pa.RecordBatch], scale: int) -> Iterator[tuple[int, tuple]]:
    """(cell, piece) of the vectors that count; a piece lies in one cell and on one side."""
    for batch in batches:
        rows, vectors = whole_numbers(batch.column("v"), scale)
        if not len(rows):
            continue
        cell, side, ids, key = (batch.column(c).to_numpy(zero_copy_only=False)[rows] for c in ("cell", "side", "vec_id", "key"))
        cuts = np.flatnonzero((np.diff(cell) != 0) | (np.diff(side) != 0)) + 1
        for a, b in zip([0, *cuts], [*cuts, len(rows)]):
            yield int(cell[a]), (side[a] == 0, ids[a:b], key[a:b].tolist(), vectors[a:b])


def partial_lists(vectors: DataFrame, queries: DataFrame, k: int, tiles: int, shards: int, scale: int) -> DataFrame:
    """query_id, key, shard, top (score, vec_id): the k best of a query in a shard."""
    tile = F.pmod(F.xxhash64("key", F.lit(3)), F.lit(tiles)).cast("int")
    shard = F.pmod(F.xxhash64("vec_id", F.lit(5)), F.lit(shards)).cast("int")
    upto = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    asked = queries.select(tile.alias("tile"), upto(shards).alias("shard"), F.lit(0).alias("side"), "vec_id", "key", "v")
    given = vectors.select(upto(tiles).alias("tile"), shard.alias("shard"), F.lit(1).alias("side"), "vec_id", "key", "v")
    rows = asked.unionByName(given).select((F.col("tile") * shards + F.col("shard")).alias("cell"), "side", "vec_id", "key", "v")
    dealt = rows.repartitionById(tiles * shards, F.col("cell")).sortWithinPartitions("cell", "side", "vec_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell, pieces in groupby(_cells(batches, scale), lambda p: p[0]):
            found = _search_cell((p for _, p in pieces), k)
            if found is None:
                continue
            keys, best = found
            for at in range(0, len(keys), 8192):
                part = slice(at, at + 8192)
                real = best.id[part] != np.iinfo(np.int64).max
                ends = np.concatenate([[0], np.cumsum(real.sum(axis=1))]).astype(np.int32)
                entries = pa.StructArray.from_arrays(
                    [pa.array(-best.score[part][real]), pa.array(best.id[part][real])], ["minus", "vec_id"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(best.own[part]), pa.array(keys[part], pa.int64()), pa.array(np.full(len(real), cell % shards, np.int32)),
                     pa.ListArray.from_arrays(pa.array(ends), entries)], ["query_id", "key", "node", "top"])

    return dealt.mapInArrow(run, "query_id long, key long, node int, top array<struct<minus:long,vec_id:long>>")


def merged(lists: DataFrame, k: int, nodes: int, fan: int) -> DataFrame:
    """One list a query: `fan` lists of a query become one, until a single one is left."""
    while nodes > 1:
        together = F.array_sort(F.flatten(F.collect_list("top")))  # at most fan * k entries
        lists = lists.groupBy("query_id", "key", F.floor(F.col("node") / fan).cast("int").alias("node")).agg(
            F.slice(together, 1, k).alias("top"))
        nodes = math.ceil(nodes / fan)
    return lists


def top_k(vectors: DataFrame, is_query: Column, vec_id: str = "vec_id", embedding: str = "embedding", k: int = K, scale: int = SCALE,
          tile_queries: int = TILE_QUERIES, shard_rows: int | None = None, fan: int = FAN) -> DataFrame:
    """query_id, rank, vec_id, score: for each row of `vectors` where `is_query` (a condition on vec_id) holds its k best others.

    The number of shards follows the table: `shard_rows` rows each or, where that makes more tasks than the session
    shuffles with, larger ones of up to `MOST_SHARD_ROWS`."""
    rows = vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(embedding).alias("v"), is_query.alias("asked")).filter(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull())
    rows = rows.withColumn("key", F.xxhash64("vec_id", "v"))
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if("asked").alias("q")).first()
    tiles = max(1, math.ceil(size["q"] / tile_queries))
    if shard_rows is None:
        parallel = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        shards = min(math.ceil(size["n"] / SHARD_ROWS), max(math.ceil(parallel / tiles), math.ceil(size["n"] / MOST_SHARD_ROWS)))
    else:
        shards = math.ceil(size["n"] / shard_rows)
    shards = max(1, shards)
    # equal rows of one query are one query
    queries = rows.filter("asked").groupBy("vec_id", "key").agg(F.first("v").alias("v"))
    lists = written(partial_lists(rows, queries, k, tiles, shards, scale))
    best = merged(lists, k, shards, fan)
    out = best.select("query_id", F.posexplode("top").alias("at", "hit"))
    return out.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"), (-F.col("hit.minus")).alias("score"))


def op13(vectors: DataFrame) -> DataFrame:
    return top_k(vectors, F.col("vec_id") % EVERY == 0)


OP13_SQL = f"""WITH v AS MATERIALIZED (SELECT vec_id, [floor({SCALE} * CAST(x AS DOUBLE)) FOR x IN embedding] AS x FROM embeddings
    WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.x, c.x) AS BIGINT) AS score
    FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % {EVERY} = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs)
SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score FROM ranked WHERE rank <= {K}"""
