"""Lookups and joins: event text, labels and splits by range, grids, nearest centroid."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from oddrows.functions.columns import names, scalar
from oddrows.functions.lineage import written
from oddrows.functions.ordering import HOT_ROWS, carried
from oddrows.functions.sizes import broadcast_if_small
from oddrows.operators.stats import concat_text_by_key


def attach_event_text(days: DataFrame, events: DataFrame, key: str, text: str, order_by: str) -> DataFrame:
    """Per day: flag 1 and all texts of the day in order, or 0 and "None"."""
    joined = days.join(concat_text_by_key(events, key, text, order_by, to="txt_desc"), key, "left")
    return joined.withColumns({
        "txt": F.col("txt_desc").isNotNull().cast("int"),
        "txt_desc": F.coalesce(F.col("txt_desc"), F.lit("None")),
    })


def flag_event_days(days: DataFrame, events: DataFrame, key: str, text: str) -> DataFrame:
    """Per day: is there an event text. Only the distinct days are joined, no text is gathered."""
    seen = events.filter(F.col(text).isNotNull()).select(F.col(key).alias("_day")).distinct()
    return days.join(seen, F.col(key) == F.col("_day"), "left").withColumn("txt", F.col("_day").isNotNull().cast("int")).drop("_day")


def match_label_timestamps(df: DataFrame, labels: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows whose timestamp (and series) is in the label list. Labels are de-duplicated, so a
    hot timestamp costs one label row; Spark picks the join from measured sizes."""
    return df.join(labels.select(*names(on)).distinct(), names(on), "left_semi")


#: segments of all files up to which they go to the tasks, where a row looks through those of its file
FEW_SEGMENTS = 512


def disjoint_segments(ranges: DataFrame, on: str | Sequence[str] | None = None) -> DataFrame:
    """The union of each file's ranges as disjoint segments `lo, hi`: one sweep in order of `lo` that opens a segment where no earlier
    range reaches. Ranges that only touch stay apart; empty ones and those with a null end are left out."""
    keys = names(on)
    past = Window.partitionBy(*keys).orderBy("lo", "hi")
    reach = F.max("hi").over(past.rowsBetween(Window.unboundedPreceding, -1))
    opened = ranges.filter("lo < hi").select(*keys, "lo", "hi", (F.coalesce(F.col("lo") >= reach, F.lit(True))).cast("int").alias("_opens"))
    numbered = opened.withColumn("_segment", F.sum("_opens").over(past.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(*keys, "_segment").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).drop("_segment")


def _inside(df: DataFrame, ranges: DataFrame, index: str, keys: list[str], first: bool, to: str, few: int, hot_rows: int | None) -> DataFrame:
    """Add whether lo < index < hi (lo <= index with `first`) for a range of the row's keys.

    A few segments go to the tasks. Many are met in an ordered merge: rows and segments are sorted by place together, and each row
    sees the end of the last segment that began before it; a hot file is range-partitioned."""
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    segments = written(disjoint_segments(ranges.filter(known), keys))
    i = F.col(index)
    if segments.limit(few + 1).count() <= few:
        lists = F.broadcast(segments.groupBy(*keys).agg(F.collect_list(F.struct("lo", "hi")).alias("_own")))
        begun = (lambda r: r["lo"] <= i) if first else (lambda r: r["lo"] < i)
        found = F.coalesce(F.exists("_own", lambda r: begun(r) & (i < r["hi"])), F.lit(False))
        joined = df.join(lists, keys, "left") if keys else df.withColumn("_own", lists.select("_own").scalar())
        return joined.select(*df.columns, found.alias(to))
    order = {"_place": i, "_turn": F.lit(int(first))}
    marks = segments.select(*keys, F.col("lo").alias("_place"), F.lit(1 - int(first)).alias("_turn"), F.col("hi").alias("_end"), F.lit(True).alias("_mark"))
    both = df.withColumns(order).withColumn("_mark", F.lit(False)).unionByName(marks, allowMissingColumns=True)
    met = carried(both, [F.col("_place").asc_nulls_first(), F.col("_turn").asc()], back={"_reach": F.col("_end")}, series=keys, hot_rows=hot_rows)
    return met.filter(~F.col("_mark")).select(*df.columns, F.coalesce(i < F.col("_reach"), F.lit(False)).alias(to))


def label_by_ranges(
    df: DataFrame, ranges: DataFrame, index: str, on: str | Sequence[str] | None = None,
    label: str = "label", few: int = FEW_SEGMENTS, hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """1 where lo < index < hi for any range of the row's file, else 0 (also where the index or the file is null)."""
    out = _inside(df, ranges, index, names(on), False, "_inside", few, hot_rows)
    return out.select(*df.columns, F.col("_inside").cast("int").alias(label))


def split_by_ranges(
    df: DataFrame, ranges: DataFrame, index: str, on: str | Sequence[str] | None = None,
    split: str = "split", few: int = FEW_SEGMENTS, hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Split name of the half-open range lo <= index < hi; rows outside every range are left
    out, a row inside the ranges of two splits appears in both."""
    keys = names(on)
    offered = broadcast_if_small(written(ranges.select(*keys, split).distinct()))  # the splits of each file
    rows = df.join(offered, keys) if keys else df.withColumn(split, F.explode(offered.agg(F.collect_set(split)).scalar()))
    return _inside(rows, ranges, index, [*keys, split], True, "_inside", few, hot_rows).filter("_inside").select(*df.columns, split)


def broadcast_group_stat(df: DataFrame, stats: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Attach group statistics (one row per group) computed on another set of rows."""
    return df.join(broadcast_if_small(stats), names(on), "left")


def lookup_word_vectors(vocabulary: DataFrame, vectors: DataFrame, dim: int, limit: int | None = None) -> DataFrame:
    """Vector of every vocabulary word, zeros when unknown; `limit` keeps indexes below it."""
    kept = vocabulary.filter(F.col("index") < limit) if limit else vocabulary
    zeros = F.array_repeat(F.lit(0.0).cast("float"), dim)
    return kept.join(vectors, "word", "left").withColumn("vec", F.coalesce("vec", zeros))


def parameter_grid(df: DataFrame, grid: Mapping[str, Sequence]) -> DataFrame:
    """Every row of `df` (usually one row of statistics) with every parameter combination."""
    out = df
    for name, values in grid.items():
        out = out.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))
    return out


def value_grid(df: DataFrame, columns: str | Sequence[str], points: int) -> DataFrame:
    """Evenly spaced values from min to max of each column; all combinations of the axes."""
    cols = names(columns)
    ends = df.agg(*[f(c).alias(f"{n}_{c}") for c in cols for n, f in (("lo", F.min), ("hi", F.max))])
    cells = df.sparkSession.range(points ** len(cols)).withColumn("_e", scalar(ends))
    out = {}
    for axis, c in enumerate(cols):
        i = F.floor(F.col("id") / points**axis) % points
        low, high = F.col("_e")[f"lo_{c}"], F.col("_e")[f"hi_{c}"]
        out[c] = low + (high - low) * i / max(points - 1, 1)
    return cells.select(*[v.alias(c) for c, v in out.items()])


def attach_scores(df: DataFrame, scores: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Write scores back by key (never by row position)."""
    return df.join(scores, names(key), "left")


def distance_to(columns: Sequence[str], centre: Sequence[float]) -> Column:
    """Euclidean distance of the columns to a constant point."""
    total = F.lit(0.0)
    for c, m in zip(columns, centre):
        total = total + F.pow(F.col(c) - F.lit(float(m)), F.lit(2.0))
    return F.sqrt(total)


def assign_nearest(df: DataFrame, columns: Sequence[str], centroids: Sequence[Sequence[float]]) -> DataFrame:
    """Nearest centroid (lowest number on ties) and the distance to it: projections only."""
    options = F.array(*[F.struct(distance_to(columns, c).alias("distance"), F.lit(i).alias("cluster"))
                        for i, c in enumerate(centroids)])
    near = df.withColumn("_near", F.array_min(options))
    known = F.col("_near.distance").isNotNull()  # a row with a null coordinate has no cluster
    return near.select(*df.columns, F.when(known, F.col("_near.cluster")).alias("cluster"), F.col("_near.distance").alias("distance"))


def union_rows(first: DataFrame, *others: DataFrame) -> DataFrame:
    out = first
    for o in others:
        out = out.unionByName(o)
    return out


def attach_scalars(df: DataFrame, params: DataFrame, prefix: str = "") -> DataFrame:
    """Put the columns of a one-row table on every row (a scalar subquery, not a join)."""
    packed = df.withColumn("_one", scalar(params))
    return packed.withColumns({f"{prefix}{c}": F.col("_one")[c] for c in params.columns}).drop("_one")
