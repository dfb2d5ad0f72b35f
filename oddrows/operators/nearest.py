"""Exact neighbour lists in any number of columns, and the detectors on them.

Equal rows are one point with a count. Points are parted around pivots (each goes to its nearest one), and a cell with
too many points is parted again around pivots of its own, so cells are small whatever the distances look like. A point
first looks into its own cell, which bounds the distance to its k-th neighbour; a cell with fewer than k rows takes the
bound of the smallest cell above it that has enough, so no radius is infinite. It then descends from the top to cells that the
triangle inequality does not exclude: by the ring of distances that a cell's points have to their pivot, and by the border
to the nearest pivot. A point whose ball reaches many cells (in many dimensions nearly all) would be copied for each of them; it
is compared with the whole table instead: vectors are written once in packed blocks, and a task holds the blocks of one tile
while others pass by, so no vector is copied for it. Only vectors, cells and lists of about k rows move; no pairs of points are
formed outside a task."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from oddrows.functions import meeting
from oddrows.functions.columns import uniform
from oddrows.functions.lineage import written
from oddrows.functions.meeting import meet, salted
from oddrows.functions.sizes import BROADCAST_BYTES, with_params

CELL_POINTS = 400
FAN = 32
#: cells are numbered by FAN digits in 63 bits; at this depth a cell stays as it is
DEPTH = 12
#: a ball that reaches more cells than this goes to tiles; the upper cells that tell so are sent to the tasks
MOST_CELLS = 24
TOP_BYTES = 4_000_000
#: levels of the tree that are worked out again rather than written
LAZY_LEVELS = 3
#: vectors that a tile holds, in bytes; pairs worth a task of their own; points of a packed block
TILE_BYTES = 64_000_000
TILE_PAIRS = 500_000_000
BLOCK_POINTS = 2048
#: rows and columns of one matrix product
_ROWS, _STRIPE = 512, 4096
#: rows of one vector that make it a key of its own when scores go back to the rows
HOT_ROWS = 10_000
#: rows of two numbers that are sent to the tasks
SENT_ROWS = BROADCAST_BYTES // 16
_LIST = "array<struct<d:double,other:long,m:long>>"


@dataclass
class Cells:
    """`placed`: pid, v, m, cell, up (cell and distance to its pivot on every level). `nodes`: cell, parent, pivot, the
    distances lo .. hi of its points to the pivot, its points n, its rows, its depth and whether it is a leaf."""

    placed: DataFrame
    nodes: DataFrame
    levels: int


def vector_of(columns: str | Sequence[str], kind: str = "array<double>") -> Column:
    """An array column, or several number columns, as array<double>; null where a component is null, NaN or infinite.

    `kind` array<float> holds the same numbers in half the bytes where the column has no others."""
    v = F.col(columns).cast("array<double>") if isinstance(columns, str) else F.array(*[F.col(c).cast("double") for c in columns])
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    # -0.0 and 0.0 are one place
    return F.when(~odd, F.transform(v, lambda x: x + F.lit(0.0)).cast(kind))


def _vectors(df: DataFrame, columns: str | Sequence[str]) -> Column:
    """`vector_of` in the narrowest type that is exact."""
    narrow = isinstance(columns, str) and df.select(columns).schema[0].dataType.simpleString() == "array<float>"
    return vector_of(columns, "array<float>" if narrow else "array<double>")


def _pid(v: str) -> Column:
    return F.xxhash64(v)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(len(column), -1)


def _exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(((a - b) ** 2).sum(axis=1))


def _apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All distances, computed from differences in blocks."""
    out = np.empty((len(a), len(b)))
    block = max(1, 2_000_000 // max(b.size, 1))
    for at in range(0, len(a), block):
        out[at: at + block] = np.sqrt(((a[at: at + block, None, :] - b[None, :, :]) ** 2).sum(axis=2))
    return out


def _assigned(todo: DataFrame, pivots: DataFrame, fan: int, first: int) -> DataFrame:
    """todo with the child cell whose pivot is nearest and the distance to it; the pivots are sent to the tasks."""
    kind, known = todo.schema["v"].dataType.simpleString(), {}
    for row in pivots.orderBy("cell", "at").collect():
        known.setdefault(row["cell"], []).append((row["at"], row["pivot"]))
    known = {cell: (np.array([at for at, _ in found], np.int64), np.array([pivot for _, pivot in found], float)) for cell, found in known.items()}

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            v, parent = _matrix(batch.column("v")), batch.column("cell").to_numpy()
            order = np.argsort(parent, kind="stable")
            child, near = np.empty(len(v), np.int64), np.empty(len(v))
            for rows in np.split(order, np.flatnonzero(np.diff(parent[order])) + 1):
                at, pivot = known[int(parent[rows[0]])]
                d = _apart(v[rows], pivot)
                best = d.argmin(axis=1)
                child[rows], near[rows] = parent[rows[0]] * fan + at[best] + first, d[np.arange(len(best)), best]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("pid", "v", "m", "cell")), pa.array(child), pa.array(near), batch.column("up")],
                ["pid", "v", "m", "parent", "cell", "d", "up"])

    return todo.select("pid", "v", "m", "cell", "up").mapInArrow(
        assign, f"pid long, v {kind}, m long, parent long, cell long, d double, up array<struct<cell:long,d:double>>")


def build_cells(points: DataFrame, cell_points: int = CELL_POINTS, fan: int = FAN) -> Cells:
    """Part points (pid, v, m) into cells of at most about `cell_points`.

    While the pivots of a level are few they are sent to the tasks: the points are neither moved nor written, but assigned again when needed."""
    todo = points.select("pid", "v", "m", F.lit(0).cast("bigint").alias("cell"), F.lit(None).cast("array<struct<cell:long,d:double>>").alias("up"))
    kind, size = points.schema["v"].dataType.simpleString(), points.count()
    opened = points.sparkSession.createDataFrame([(0, size)], "cell long, n long")
    leaves, nodes, level, lazy = [], [], 0, 0
    while True:
        # pivots: points of the smallest hash, out of a sample of about four times as many
        wanted, first = (1, 1) if level == 0 else (fan, 0)
        drawn = with_params(todo, opened, "cell", "inner").withColumn("_h", uniform(level, "pid"))
        drawn = drawn.filter(F.col("_h") * F.col("n") < 4.0 * max(wanted, 8))
        pivots = drawn.groupBy("cell").agg(F.slice(F.array_sort(F.collect_list(F.struct("_h", "pid", "v"))), 1, wanted).alias("_p"))
        pivots = written(pivots.select("cell", F.posexplode("_p").alias("at", "_q")).select("cell", "at", F.col("_q.v").alias("pivot")))

        def assign(group: pa.RecordBatch, batch: pa.RecordBatch) -> pa.RecordBatch:
            d = _apart(_matrix(batch.column("v")), _matrix(group.column("pivot")))
            best = d.argmin(axis=1)
            child = batch.column("cell").to_numpy() * fan + group.column("at").to_numpy()[best] + first
            return pa.RecordBatch.from_arrays(
                [batch.column("pid"), batch.column("v"), batch.column("m"), batch.column("cell"), pa.array(child),
                 pa.array(d[np.arange(len(best)), best]), batch.column("up")],
                ["pid", "v", "m", "parent", "cell", "d", "up"])

        if (pivots.agg(F.sum(F.size("pivot") + 2)).first()[0] or 0) * 8 <= TOP_BYTES:
            rows, lazy = _assigned(todo, pivots, fan, first), lazy + 1
            if lazy > LAZY_LEVELS:
                rows, lazy = written(rows), 0
        else:
            held, passing = salted(pivots, todo, "cell", "pid")
            rows, lazy = written(meet(held, passing, ["cell", "salt"], f"pid long, v {kind}, m long, parent long, cell long, d double, "
                                      "up array<struct<cell:long,d:double>>", assign)), 0
        up = F.concat(F.coalesce("up", F.array().cast("array<struct<cell:long,d:double>>")), F.array(F.struct("cell", "d")))
        stats = rows.groupBy("cell", "parent").agg(F.min("d").alias("lo"), F.max("d").alias("hi"), F.count(F.lit(1)).alias("n"), F.sum("m").alias("rows"))
        place = F.col("parent") * fan + F.col("at") + first
        named = pivots.withColumnRenamed("cell", "parent").withColumn("cell", place).select("cell", "pivot")
        leaf = (F.col("n") <= cell_points) | F.lit(level + 1 >= DEPTH)
        here = written(stats.join(named, "cell").withColumn("leaf", leaf).withColumn("depth", F.lit(level)))
        nodes.append(here)
        opened = here.filter("not leaf").select("cell", "n")
        known = with_params(rows.withColumn("up", up), here.select("cell", "leaf"), "cell", "inner")
        level, last = level + 1, opened.isEmpty()
        if last or not here.filter("leaf").isEmpty():
            leaves.append(known.filter("leaf").select("pid", "v", "m", "cell", "up"))
        if last:
            break
        todo = known.filter("not leaf").select("pid", "v", "m", "cell", "up")
    union = lambda tables: tables[0] if len(tables) == 1 else union([tables[0].unionByName(tables[1]), *tables[2:]])
    return Cells(union(leaves), written(union(nodes)), level)


def _near(q: np.ndarray, radius: np.ndarray, q_id: np.ndarray, p: np.ndarray, p_id: np.ndarray, m: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """(query, point, distance, rows) of the points of one cell that can be among the k nearest rows of a query, ties kept.

    Products of matrices select, differences give the distances."""
    found = []
    p2 = (p * p).sum(axis=1)
    for at in range(0, len(q), 512):
        part = q[at: at + 512]
        q2 = (part * part).sum(axis=1)
        rough = q2[:, None] + p2[None, :] - 2 * part @ p.T
        slack = 1e-12 * (part.shape[1] + 8) * (q2[:, None] + p2[None, :])
        few = min(k + 1, rough.shape[1])
        limit = np.minimum(np.partition(rough + slack, few - 1, axis=1)[:, few - 1], radius[at: at + 512] ** 2 * (1 + 1e-12))
        i, j = np.nonzero(rough - slack <= limit[:, None])
        d = _exact(part[i], p[j])
        rows = m[j] - (p_id[j] == q_id[at + i])
        keep = (d <= radius[at + i]) & (rows > 0)
        found.append((i[keep] + at, j[keep], d[keep], rows[keep]))
    return tuple(np.concatenate(x) for x in zip(*found))


def _lists(i: np.ndarray, d: np.ndarray, other: np.ndarray, rows: np.ndarray, n: int, k: int) -> tuple[pa.Array, np.ndarray]:
    """One sorted list a query, cut after the k-th row and its ties, and the distance of that row (NaN if there are fewer)."""
    order = np.lexsort((other, d, i))
    i, d, other, rows = i[order], d[order], other[order], rows[order]
    starts = np.searchsorted(i, np.arange(n + 1))
    total = np.concatenate([[0], np.cumsum(rows)])
    held = total[1:] - total[starts[i]]  # rows up to and with each entry of its query
    kth = np.full(n, np.nan)
    first = np.flatnonzero((held >= k) & (held - rows < k))
    kth[i[first]] = d[first]
    keep = ~(d > kth[i])  # all where there is no k-th
    ends = np.concatenate([[0], np.cumsum(np.bincount(i[keep], minlength=n))]).astype(np.int32)
    entries = pa.StructArray.from_arrays([pa.array(d[keep]), pa.array(other[keep]), pa.array(rows[keep])], ["d", "other", "m"])
    return pa.ListArray.from_arrays(pa.array(ends), entries), kth


def _looked_up(cells: DataFrame, asking: DataFrame, k: int) -> DataFrame:
    """asking (pid, v, r, cell) against the points (pid, v, m, cell) of its cell: pid, near."""
    held, passing = salted(cells.select("cell", F.col("pid").alias("other"), F.col("v").alias("w"), "m"), asking, "cell", "pid")

    def look(group: pa.RecordBatch, batch: pa.RecordBatch) -> pa.RecordBatch:
        p_id, q_id = group.column("other").to_numpy(), batch.column("pid").to_numpy()
        i, j, d, rows = _near(_matrix(batch.column("v")), batch.column("r").to_numpy(), q_id, _matrix(group.column("w")), p_id, group.column("m").to_numpy(), k)
        return pa.RecordBatch.from_arrays([batch.column("pid"), _lists(i, d, p_id[j], rows, len(q_id), k)[0]], ["pid", "near"])

    return meet(held, passing, ["cell", "salt"], f"pid long, near {_LIST}", look)


def _bounds(cells: Cells, k: int) -> DataFrame:
    """cell, reach: for each leaf, from the top down, how far the points of the cells above it lie from their pivot; infinite for cells
    of k rows or fewer, which bound nothing."""
    far = F.when(F.col("rows") > k, F.col("hi")).otherwise(float("inf"))
    found = cells.nodes.filter("leaf").select("cell", F.col("parent").alias("node"), F.array(far).alias("reach"))
    above = cells.nodes.select(F.col("cell").alias("node"), "parent", far.alias("far"))
    for _ in range(cells.levels - 1):
        longer = F.when(F.col("far").isNull(), F.col("reach")).otherwise(F.concat(F.array("far"), "reach"))
        found = found.join(above, "node", "left").select("cell", F.col("parent").alias("node"), longer.alias("reach"))
    return found.drop("node")


def _at_home(cells: Cells, k: int) -> DataFrame:
    """pid, v, m, cell, r, many, near: what the points of its own cell say about each point.

    r bounds the distance of the k-th row: by the cell's own points or, if they are too few, by the distance of a cell's pivot above it and
    that cell's reach; infinite where the table has too few rows. `many`: whether the ball reaches more than MOST_CELLS of the upper cells;
    such a point meets the whole table, so it needs no list of its cell."""
    told = _teller(cells) if cells.levels > 1 else lambda v, r: np.zeros(len(v), bool)
    kind = cells.placed.schema["v"].dataType.simpleString()
    bound = F.array_min(F.zip_with("up", "reach", lambda a, b: a["d"] + b))
    points = with_params(cells.placed, _bounds(cells, k), "cell", "inner").select("pid", "v", "m", "cell", bound.alias("r"))
    schema = f"pid long, v {kind}, m long, cell long, r double, many boolean, near {_LIST}"

    def look(group: pa.RecordBatch, batch: pa.RecordBatch) -> pa.RecordBatch:
        v, p_id, q_id = _matrix(batch.column("v")), group.column("other").to_numpy(), batch.column("pid").to_numpy()
        i, j, d, rows = _near(v, np.full(len(v), np.inf), q_id, _matrix(group.column("w")), p_id, group.column("held").to_numpy(), k)
        near, kth = _lists(i, d, p_id[j], rows, len(q_id), k)
        r = np.where(np.isnan(kth), batch.column("r").to_numpy(), kth)
        many = np.zeros(len(r), bool)
        some = np.flatnonzero(np.isfinite(r))
        many[some] = told(v[some], r[some])
        own = ~many[i]
        near = _lists(i[own], d[own], p_id[j[own]], rows[own], len(q_id), k)[0]
        return pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("pid", "v", "m", "cell")), pa.array(r), pa.array(many), near],
                                          ["pid", "v", "m", "cell", "r", "many", "near"])

    def look_around(cell: pa.Table) -> pa.Table:
        batch = cell.combine_chunks().to_batches()[0]
        group = pa.RecordBatch.from_arrays([batch.column("pid"), batch.column("v"), batch.column("m")], ["other", "w", "held"])
        return pa.Table.from_batches([look(group, batch)])

    parts = int(cells.placed.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # few bytes can mean much arithmetic: no coalescing
    dealt = lambda rows: rows.repartition(parts, "cell").groupBy("cell").applyInArrow(look_around, schema)
    large = cells.nodes.filter(F.col("leaf") & (F.col("n") > meeting.VISITS)).select("cell", F.lit(True).alias("large"))
    if large.isEmpty():
        return written(dealt(points))
    # a cell that could not be parted: its points go to several tasks, each with the whole cell
    points = with_params(points, large, "cell")
    big = points.filter("large").drop("large")
    held, passing = salted(big.select("cell", F.col("pid").alias("other"), F.col("v").alias("w"), F.col("m").alias("held")), big, "cell", "pid")
    return written(dealt(points.filter("large IS NULL").drop("large")).unionByName(meet(held, passing, ["cell", "salt"], schema, look)))


def _descend(nodes: DataFrame, asking: DataFrame, levels: int) -> DataFrame:
    """pid, v, r, cell: the leaves other than `home` that the ball of radius r around v can reach."""
    children = nodes.select(F.col("parent").alias("cell"), F.col("cell").alias("child"), "pivot", "lo", "hi", "leaf")
    kind = asking.schema["v"].dataType.simpleString()
    found, at = None, asking.select("pid", "v", "r", "home", F.lit(1).cast("bigint").alias("cell"))
    for _ in range(levels - 1):
        held, passing = salted(children, at, "cell", "pid")

        def reach(group: pa.RecordBatch, batch: pa.RecordBatch) -> pa.RecordBatch:
            d = _apart(_matrix(batch.column("v")), _matrix(group.column("pivot")))
            home = batch.column("home").to_numpy()
            lo, hi, child = (group.column(c).to_numpy() for c in ("lo", "hi", "child"))
            near = _reached(d, batch.column("r").to_numpy(), lo, hi) & (child[None, :] != home[:, None])
            i, j = np.nonzero(near)
            take = pa.array(i)
            return pa.RecordBatch.from_arrays(
                [*(batch.column(c).take(take) for c in ("pid", "v", "r", "home")), pa.array(child[j]), group.column("leaf").take(pa.array(j))],
                ["pid", "v", "r", "home", "cell", "leaf"])

        rows = written(meet(held, passing, ["cell", "salt"], f"pid long, v {kind}, r double, home long, cell long, leaf boolean", reach))
        leaf = rows.filter("leaf").select("pid", "v", "r", "cell")
        found = leaf if found is None else found.unionByName(leaf)
        at = rows.filter("not leaf").drop("leaf")
    return found


def _top(cells: Cells) -> list[dict]:
    """The upper levels of the tree as far as they are small: per parent its children's cell, pivot, lo, hi, and whether they end there."""
    dims = cells.nodes.filter("depth = 0").select(F.size("pivot")).first()[0]
    room, last = TOP_BYTES // (8 * max(dims, 1)), 1
    for row in cells.nodes.groupBy("depth").count().filter("depth > 0").orderBy("depth").collect():
        room -= row["count"]
        if row["depth"] > 1 and room < 0:
            break
        last = row["depth"]
    found: dict[int, list] = {}
    for row in cells.nodes.filter(F.col("depth").between(1, last)).orderBy("cell").collect():
        found.setdefault(row["parent"], []).append(row)
    return [{"parent": parent, "cell": [r["cell"] for r in rows], "pivot": np.array([r["pivot"] for r in rows], float),
             "lo": np.array([r["lo"] for r in rows]), "hi": np.array([r["hi"] for r in rows]), "end": [r["leaf"] or r["depth"] == last for r in rows]}
            for parent, rows in sorted(found.items(), key=lambda x: (x[1][0]["depth"], x[0]))]


def _reached(d: np.ndarray, r: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Which children balls of radius r can reach, from the distances of their centres to the pivots."""
    r = (r * (1 + 1e-9) + 1e-12 * d.max(axis=1))[:, None]
    return (d - hi <= r) & (lo - d <= r) & (d - d.min(axis=1)[:, None] <= 2 * r)


def _teller(cells: Cells) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """Tells of balls (centres, radii) whether they reach more than MOST_CELLS of the upper cells."""
    top, most = _top(cells), MOST_CELLS

    def tell(v: np.ndarray, r: np.ndarray) -> np.ndarray:
        ends, within = np.zeros(len(v), np.int64), {1: np.arange(len(v))}
        for group in top:
            rows = within.pop(group["parent"], np.zeros(0, np.int64))
            rows = rows[ends[rows] <= most]
            if not len(rows):
                continue
            near = _reached(_apart(v[rows], group["pivot"]), r[rows], group["lo"], group["hi"])
            wide = near.sum(axis=1) > most  # each of them would have cells below
            ends[rows[wide]] = most + 1
            for child, end, hit in zip(group["cell"], group["end"], near.T):
                if end:
                    ends[rows[hit]] += 1
                else:
                    within[child] = rows[hit]
        return ends > most

    return tell


def _stripes(p: np.ndarray) -> list[tuple[slice, np.ndarray, float]]:
    """Runs of points with their mean and the distance from it to the farthest one."""
    found = []
    for at in range(0, len(p), _STRIPE):
        run = slice(at, at + _STRIPE)
        centre = p[run].mean(axis=0)
        found.append((run, centre, float(np.sqrt(((p[run] - centre) ** 2).sum(axis=1)).max())))
    return found


class _Closest:
    """The k nearest rows of some points and all at the same distance, while blocks of points pass by: the radius shrinks from stripe to stripe.

    Products of matrices give a lower bound of the squared distance, differences the distance of what it does not exclude."""

    def __init__(self, q: np.ndarray, radius: np.ndarray, q_id: np.ndarray, k: int):
        self.q, self.q_id, self.k, self.limit = q, q_id, k, radius * (1 + 1e-9)
        q2 = (q * q).sum(axis=1)
        self.left = np.column_stack([-2 * q, np.ones(len(q)), q2 * (1 - 1e-12 * (q.shape[1] + 8))])
        none = np.zeros(0, np.int64)
        self.found = [(none, np.zeros(0), none, none) for _ in range(0, len(q), _ROWS)]  # query, distance, point, rows

    def meet(self, p: np.ndarray, p_id: np.ndarray, m: np.ndarray) -> None:
        k, dims = self.k, p.shape[1]
        wide = np.column_stack([p, (p * p).sum(axis=1) * (1 - 1e-12 * (dims + 8)), np.ones(len(p))])
        stripes = _stripes(p)
        for number, at in enumerate(range(0, len(self.q), _ROWS)):
            part, own, left, limit = (x[at: at + _ROWS] for x in (self.q, self.q_id, self.left, self.limit))
            for run, centre, reach in stripes:
                apart = np.sqrt(((part - centre) ** 2).sum(axis=1))
                some = np.flatnonzero(~(apart - reach > limit + 1e-9 * (apart + reach)))
                if not len(some):
                    continue
                low = left[some] @ wide[run].T
                hit = ~(low > (limit[some] ** 2)[:, None])
                if k < low.shape[1] and np.count_nonzero(hit) > 8 * (k + 1) * len(some):
                    # k + 1 points, of which one can be the query itself, bound the k-th distance
                    first = np.argpartition(low, k, axis=1)[:, : k + 1]
                    bound = np.array([np.sqrt(((p[run][f] - x) ** 2).sum(axis=1)).max() for f, x in zip(first, part[some])])
                    limit[some] = np.minimum(limit[some], bound * (1 + 1e-9))
                    hit = ~(low > (limit[some] ** 2)[:, None])
                a, b = np.nonzero(hit)
                a, b = some[a], b + run.start
                fresh = np.concatenate([_exact(part[a[x: x + 100_000]], p[b[x: x + 100_000]]) for x in range(0, len(a), 100_000)] or [np.zeros(0)])
                rows = m[b] - (p_id[b] == own[a])
                keep = (fresh <= limit[a]) & (rows > 0)
                if not keep.any():
                    continue
                i, d, j, rows = (np.concatenate(x) for x in zip(self.found[number], (a[keep], fresh[keep], p_id[b[keep]], rows[keep])))
                order = np.lexsort((d, i))
                i, d, j, rows = i[order], d[order], j[order], rows[order]
                place = np.arange(len(i)) - np.searchsorted(i, i)  # each point holds a row at least
                last = place == k - 1
                limit[i[last]] = np.minimum(limit[i[last]], d[last])
                keep = d <= limit[i]
                self.found[number] = i[keep], d[keep], j[keep], rows[keep]

    def lists(self) -> pa.RecordBatch:
        i, d, j, rows = (np.concatenate(x) for x in zip(*[(f[0] + n * _ROWS, *f[1:]) for n, f in enumerate(self.found)]))
        return pa.RecordBatch.from_arrays([pa.array(self.q_id), _lists(i, d, j, rows, len(self.q), self.k)[0]], ["pid", "near"])


def _blocks(home: DataFrame) -> DataFrame:
    """block, ids, v, m, r, many, asks: up to BLOCK_POINTS points as bytes; asks counts those that are to meet all others."""
    dtype = "<f4" if home.schema["v"].dataType.simpleString() == "array<float>" else "<f8"
    most = BLOCK_POINTS

    def packed(rows: pa.Table) -> pa.RecordBatch:
        rows = rows.combine_chunks().to_batches()[0]
        v, ids, many = _matrix(rows.column("v")), rows.column("pid").to_numpy(), rows.column("many").to_numpy(zero_copy_only=False)
        data = [ids.astype("<i8"), v.astype(dtype), rows.column("m").to_numpy().astype("<i8"), rows.column("r").to_numpy().astype("<f8"), many.astype("u1")]
        return pa.RecordBatch.from_arrays([pa.array([int(ids[0])]), *(pa.array([x.tobytes()], pa.binary()) for x in data), pa.array([int(many.sum())])],
                                          ["block", "ids", "v", "m", "r", "many", "asks"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, count = [], 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                piece = batch.slice(at, most - count)
                left, count, at = [*left, piece], count + piece.num_rows, at + piece.num_rows
                if count == most:
                    yield packed(pa.Table.from_batches(left))
                    left, count = [], 0
        if count:
            yield packed(pa.Table.from_batches(left))

    schema = "block long, ids binary, v binary, m binary, r binary, many binary, asks long"
    return home.select("pid", "v", "m", "r", "many").mapInArrow(pack, schema)


def _tiled(home: DataFrame, k: int) -> tuple[DataFrame, int]:
    """pid, near: the points (pid, v, m, r, many) with `many` against all points; and the number of lists that each has.

    A row of the cross join is a pair of blocks. A task reads the blocks of one tile from the written table and holds them, other blocks pass by,
    so nothing is copied for it; one list of each point and tile comes out."""
    size = home.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("dims"), F.count(F.when(F.col("many"), 1)).alias("asks")).first()
    dims, dtype = size["dims"], "<f4" if home.schema["v"].dataType.simpleString() == "array<float>" else "<f8"
    blocks = written(_blocks(home))
    tiles = math.ceil(size["n"] * 8 * dims / TILE_BYTES)
    held = blocks.select(F.col("ids").alias("p_ids"), F.col("v").alias("p"), F.col("m").alias("p_m"))
    held = held.coalesce(1) if tiles == 1 else held.repartition(tiles)
    asking = blocks.filter("asks > 0").select("block", "ids", "v", "r", "many")
    parts = int(home.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = min(parts, math.ceil(size["n"] * size["asks"] / TILE_PAIRS / tiles))
    if asking.rdd.getNumPartitions() < tasks:
        asking = asking.repartition(tasks)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, closest = None, None
        for batch in batches:
            columns = {c: batch.column(c) for c in batch.schema.names}
            value = lambda c, row, kind: np.frombuffer(columns[c][row].as_buffer(), kind)
            for row, block in enumerate(columns["block"].to_pylist()):
                if block != now:
                    if closest:
                        yield closest.lists()
                    asks = np.flatnonzero(value("many", row, "u1"))
                    q = value("v", row, dtype).reshape(-1, dims)[asks].astype(np.float64)
                    now, closest = block, _Closest(q, value("r", row, "<f8")[asks], value("ids", row, "<i8")[asks], k)
                closest.meet(value("p", row, dtype).reshape(-1, dims).astype(np.float64), value("p_ids", row, "<i8"), value("p_m", row, "<i8"))
        if closest:
            yield closest.lists()

    return asking.hint("shuffle_replicate_nl").crossJoin(held).mapInArrow(look, f"pid long, near {_LIST}"), tiles


def neighbour_lists(points: DataFrame, k: int, cell_points: int | None = None, fan: int = FAN) -> DataFrame:
    """pid, other, d, m: every point with the points (their distance and rows) that hold its k nearest rows.

    All rows at the distance of the k-th stay; a point does not count its own row, but counts its equals at distance 0.
    Points with fewer than k other rows have no list."""
    cells = build_cells(points, cell_points or max(CELL_POINTS, 2 * (k + 1)), fan)
    home = _at_home(cells, k)
    rows, whole = home.filter("not many").select("pid", F.inline("near")), None
    if cells.levels > 1:
        kinds = {r["many"] for r in home.filter(F.col("r") < float("inf")).select("many").distinct().collect()}
        if False in kinds:
            asking = home.filter(~F.col("many") & (F.col("r") < float("inf"))).select("pid", "v", "r", F.col("cell").alias("home"))
            away = _descend(cells.nodes, asking, cells.levels)
            rows = rows.unionByName(_looked_up(home.select("pid", "v", "m", "cell"), away, k).select("pid", F.inline("near")))
        if True in kinds:
            near, lists = _tiled(home, k)
            whole = near.select("pid", F.inline("near"))
            if lists > 1:
                rows, whole = rows.unionByName(whole), None
        if False not in kinds and whole is not None:
            return whole.select("pid", "other", "d", "m")
    by_distance = Window.partitionBy("pid").orderBy("d")  # lists of about k entries for each cell reached
    counted = rows.withColumn("_held", F.sum("m").over(by_distance))
    kth = F.min(F.when(F.col("_held") >= k, F.col("d"))).over(Window.partitionBy("pid"))
    merged = counted.withColumn("_kth", kth).filter("d <= _kth").select("pid", "other", "d", "m")
    return merged if whole is None else merged.unionByName(whole)


def as_points(df: DataFrame, columns: str | Sequence[str]) -> DataFrame:
    """pid, v, m: the distinct vectors and how many rows each has; written, so the ids stay.

    A vector's hash is its id, so rows find their point without their vector; should two vectors have one hash, points are numbered."""
    rows = df.select(_vectors(df, columns).alias("v")).filter("v IS NOT NULL")
    points = written(rows.groupBy("v").agg(F.count(F.lit(1)).alias("m")).withColumn("pid", _pid("v")))
    if points.groupBy("pid").count().filter("count > 1").isEmpty():
        return points
    return written(points.withColumn("pid", F.monotonically_increasing_id()))


def _sent(df: DataFrame) -> DataFrame:
    """A table of a number for each point, written, and sent to the tasks while it has few rows."""
    stored = written(df)
    return F.broadcast(stored) if stored.count() <= SENT_ROWS else stored


def _attached(df: DataFrame, columns: str | Sequence[str], points: DataFrame, scores: DataFrame) -> DataFrame:
    """df with the score of each row's point; null without one.

    Only points of more than HOT_ROWS rows are worth a copy for every salt."""
    rows, key = df.withColumn("_v", _vectors(df, columns)), "_v"
    if points.filter(F.col("pid") != _pid("v")).isEmpty():
        rows, key = rows.withColumn("_pid", F.when(F.col("_v").isNotNull(), _pid("_v"))).drop("_v"), "_pid"
    named = points.join(scores, "pid", "left").select(F.col("pid" if key == "_pid" else "v").alias(key), "score", "m")
    named = written(named)
    hot = named.filter(F.col("m") > HOT_ROWS).select(key, "score", F.lit(True).alias("_hot"))
    if not hot.isEmpty():
        rows = with_params(rows, hot, key)
    else:
        rows = rows.withColumns({"score": F.lit(None).cast("double"), "_hot": F.lit(None).cast("boolean")})
    done = F.col("_hot").isNotNull() | F.col(key).isNull()
    other = named.filter(F.col("m") <= HOT_ROWS).drop("m")
    if key == "_pid" and named.count() <= SENT_ROWS:
        other = F.broadcast(other)
    left = rows.filter(~done).drop("score", "_hot").join(other, key, "left")
    return left.drop(key).unionByName(rows.filter(done).drop(key, "_hot"))


def knn_distance(df: DataFrame, columns: str | Sequence[str], k: int = 5, cell_points: int | None = None, fan: int = FAN) -> DataFrame:
    """Add `score`, the distance to the k-th nearest other row; null with fewer than k others or an incomplete vector."""
    points = as_points(df, columns)
    lists = neighbour_lists(points, k, cell_points, fan)
    return _attached(df, columns, points, lists.groupBy("pid").agg(F.max("d").alias("score")))


def local_outlier_factor(df: DataFrame, columns: str | Sequence[str], k: int = 20, cell_points: int | None = None, fan: int = FAN) -> DataFrame:
    """Add `score`, the local outlier factor: how much thinner a row's place is than its neighbours' places.

    The reachability of a neighbour is the larger of their distance and the neighbour's own k-th distance; density is one over
    its mean (plus 1e-10, so rows with k equals have a finite one); the factor is the neighbours' mean density over the own."""
    points = as_points(df, columns)
    lists = written(neighbour_lists(points, k, cell_points, fan))
    kth = _sent(lists.groupBy("pid").agg(F.max("d").alias("kd")).withColumnRenamed("pid", "other"))
    density = _sent(lists.join(kth, "other").groupBy("pid").agg(
        (F.sum("m") / (F.sum(F.col("m") * F.greatest("kd", "d")) + F.lit(1e-10) * F.sum("m"))).alias("density")))
    around = lists.join(density.withColumnRenamed("pid", "other"), "other").groupBy("pid").agg(
        (F.sum(F.col("m") * F.col("density")) / F.sum("m")).alias("around"))
    scores = around.join(density, "pid").select("pid", (F.col("around") / F.col("density")).alias("score"))
    return _attached(df, columns, points, scores)
