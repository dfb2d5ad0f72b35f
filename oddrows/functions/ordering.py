"""Ordered work without a single-task window.

A window by series is the plain and fast form, and it is used whenever the largest
series is known or measured to fit one task. Beyond that size the same result comes
from a range-partitioned, sorted table: positions and running sums add a per-partition
offset, and row frames run on chunks of a series that carry a halo of neighbour rows.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from oddrows.functions.columns import names
from oddrows.functions.lineage import written
from oddrows.functions.sizes import with_params

#: rows of one series that a single window task may sort; pass `hot_rows=None` where the
#: size has another proven bound (for example one row per calendar day).
HOT_ROWS = 4_000_000

_ROW_BITS = 33  # monotonically_increasing_id keeps the partition above bit 33


def largest_group(df: DataFrame, series: list[str]) -> int:
    """Rows of the largest series (map-side combined count; all rows when no series)."""
    if not series:
        return df.count()
    top = df.groupBy(*series).count().agg(F.max("count").alias("top")).first()
    return top["top"] or 0


class Split(int):
    """A row limit already measured to be exceeded: the split path is taken without a count."""


def fits_one_task(df: DataFrame, series: list[str], hot_rows: int | None) -> bool:
    if isinstance(hot_rows, Split):
        return False
    return hot_rows is None or largest_group(df, series) <= hot_rows


def settle(df: DataFrame, series: str | list[str] | None, hot_rows: int | None) -> int | None:
    """Measure the largest series once for an operator of several ordered steps."""
    return None if fits_one_task(df, names(series), hot_rows) else Split(hot_rows)


def sorted_run(df: DataFrame, order: list) -> DataFrame:
    """Range-partition and sort by `order`; `_run` is the partition, `_off` the place in it.

    The result is written once: both later passes then see the same partition bounds."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = (
        df.repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id())
    )
    mask = (1 << _ROW_BITS) - 1
    return written(placed).select(
        "*",
        F.shiftright("_at", _ROW_BITS).alias("_run"),
        F.col("_at").bitwiseAND(F.lit(mask)).alias("_off"),
    ).drop("_at")


def prefix_sums(
    df: DataFrame,
    order_by: str | list,
    sums: Mapping[str, Column],
    series: str | list[str] | None = None,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Add running sums (current row included) of `sums` per series, in a total order."""
    by, order = names(series), order_by if isinstance(order_by, list) else [order_by]
    back = (Window.unboundedPreceding, Window.currentRow)
    if fits_one_task(df, by, hot_rows):
        w = Window.partitionBy(*by).orderBy(*order).rowsBetween(*back)
        return df.withColumns({k: F.sum(v).over(w) for k, v in sums.items()})

    run = sorted_run(df, [*by, *order])
    parts = run.groupBy("_run", *by).agg(*[F.sum(v).alias(k) for k, v in sums.items()])
    earlier = Window.partitionBy(*by).orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(
        F.col("_run").alias("_run0"),
        *[F.col(c).alias(f"_s_{c}") for c in by],
        *[F.coalesce(F.sum(k).over(earlier), F.lit(0)).alias(f"_o_{k}") for k in sums],
    )
    here = Window.partitionBy("_run", *by).orderBy("_off").rowsBetween(*back)
    local = run.withColumns({k: F.sum(v).over(here) for k, v in sums.items()})
    match = F.col("_run") == F.col("_run0")
    for c in by:
        match = match & F.col(c).eqNullSafe(F.col(f"_s_{c}"))
    # without series: one offset row per range partition, which bounds the broadcast
    joined = local.join(offsets if by else F.broadcast(offsets), match)
    total = {k: F.col(k) + F.col(f"_o_{k}") for k in sums}
    return joined.withColumns(total).select(*df.columns, *sums)


def with_position(
    df: DataFrame,
    order_by: str | list,
    series: str | list[str] | None = None,
    name: str = "pos",
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Add the 0-based place of each row in its series."""
    out = prefix_sums(df, order_by, {name: F.lit(1).cast("bigint")}, series, hot_rows)
    return out.withColumn(name, F.col(name) - 1)


def row_frames(
    df: DataFrame,
    order_by: str | list[str],
    series: str | list[str] | None = None,
    before: int = 0,
    after: int = 0,
    hot_rows: int | None = HOT_ROWS,
    placed: bool = False,
) -> tuple[DataFrame, WindowSpec, Callable[[DataFrame], DataFrame]]:
    """Table, ordered window and finisher for frames of `before`/`after` rows.

    Frames no wider than asked for give the same answer on both paths. Apply the window to
    the returned table, then call the finisher, which drops halo rows and helper columns. With
    `placed` the order column holds the 0-based places already, so nothing is sorted for them again."""
    by, order = names(series), names(order_by)
    if fits_one_task(df, by, hot_rows):
        return df, Window.partitionBy(*by).orderBy(*order), lambda out: out
    numbered = df.withColumn("_pos", F.col(order[0])) if placed else with_position(df, order, by, "_pos", Split(hot_rows))
    size = max(int(hot_rows), before + after + 1)
    chunk = F.floor(F.col("_pos") / size)
    lowest = F.greatest(F.floor((F.col("_pos") - after) / size), F.lit(0).cast("bigint"))
    highest = F.floor((F.col("_pos") + before) / size)
    framed = numbered.withColumn("_chunk", F.explode(F.sequence(lowest, highest))).withColumn(
        "_own", F.col("_chunk") == chunk
    )
    window = Window.partitionBy(*by, "_chunk").orderBy("_pos")
    return framed, window, lambda out: out.filter("_own").drop("_own", "_chunk", "_pos")


def carried(
    df: DataFrame,
    order_by: str | list,
    back: Mapping[str, Column] | None = None,
    ahead: Mapping[str, Column] | None = None,
    series: str | list[str] | None = None,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Add the nearest non-null value at or before (`back`) / at or after (`ahead`) each row."""
    back, ahead = dict(back or {}), dict(ahead or {})
    by, order = names(series), order_by if isinstance(order_by, list) else [order_by]
    past = (Window.unboundedPreceding, Window.currentRow)
    future = (Window.currentRow, Window.unboundedFollowing)
    if fits_one_task(df, by, hot_rows):
        w = Window.partitionBy(*by).orderBy(*order)
        return df.withColumns(
            {k: F.last(v, True).over(w.rowsBetween(*past)) for k, v in back.items()}
            | {k: F.first(v, True).over(w.rowsBetween(*future)) for k, v in ahead.items()}
        )
    run = sorted_run(df, [*by, *order])
    tagged = run.withColumns({f"_v_{k}": v for k, v in (back | ahead).items()})
    valued = lambda k: F.when(F.col(f"_v_{k}").isNotNull(), F.col("_off"))
    parts = tagged.groupBy("_run", *by).agg(
        *[F.max_by(f"_v_{k}", valued(k)).alias(k) for k in back],
        *[F.min_by(f"_v_{k}", valued(k)).alias(k) for k in ahead],
    )
    runs = Window.partitionBy(*by).orderBy("_run")
    outside = parts.select(
        F.col("_run").alias("_run0"),
        *[F.col(c).alias(f"_s_{c}") for c in by],
        *[F.last(k, True).over(runs.rowsBetween(Window.unboundedPreceding, -1)).alias(f"_o_{k}")
          for k in back],
        *[F.first(k, True).over(runs.rowsBetween(1, Window.unboundedFollowing)).alias(f"_o_{k}")
          for k in ahead],
    )
    here = Window.partitionBy("_run", *by).orderBy("_off")
    local = tagged.withColumns(
        {k: F.last(f"_v_{k}", True).over(here.rowsBetween(*past)) for k in back}
        | {k: F.first(f"_v_{k}", True).over(here.rowsBetween(*future)) for k in ahead}
    )
    match = F.col("_run") == F.col("_run0")
    for c in by:
        match = match & F.col(c).eqNullSafe(F.col(f"_s_{c}"))
    joined = local.join(outside if by else F.broadcast(outside), match)
    filled = {k: F.coalesce(F.col(k), F.col(f"_o_{k}")) for k in back | ahead}
    return joined.withColumns(filled).select(*df.columns, *filled)


def with_series_size(df: DataFrame, series: str | list[str] | None = None, name: str = "n") -> DataFrame:
    """Add the row count of each row's series, counted with a map-side combine and sent to the rows."""
    by = names(series)
    if not by:
        return df.withColumn(name, df.agg(F.count(F.lit(1))).scalar())
    return with_params(df, df.groupBy(*by).agg(F.count(F.lit(1)).alias(name)), by, "inner")
