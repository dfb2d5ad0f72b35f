"""Projection, missing values and gap repair."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oddrows.functions.columns import clean, names, scalar
from oddrows.functions.ordering import HOT_ROWS, carried, settle, with_position
from oddrows.functions.sizes import broadcast_if_small


def rename_last_column(df: DataFrame, name: str = "target") -> DataFrame:
    return df.withColumnRenamed(df.columns[-1], name)


def parse_timestamp(df: DataFrame, column: str, fmt: str | None = None, to: str | None = None) -> DataFrame:
    """String to timestamp; text that does not parse becomes null."""
    parsed = F.try_to_timestamp(F.col(column), F.lit(fmt)) if fmt else F.try_to_timestamp(F.col(column))
    return df.withColumn(to or column, parsed)


def derive_date_key(df: DataFrame, ts: str, to: str = "date") -> DataFrame:
    return df.withColumn(to, F.date_format(ts, "yyyy-MM-dd"))


def calendar_fields(df: DataFrame, ts: str) -> DataFrame:
    """Year and weekday with Monday = 0."""
    return df.withColumns({"year": F.year(ts), "dow": F.weekday(ts)})


def missing(column: str, kind: T.DataType) -> Column:
    """True for null and, in floating columns, for NaN."""
    test = F.col(column).isNull()
    return test | F.isnan(column) if isinstance(kind, (T.DoubleType, T.FloatType)) else test


def has_missing(df: DataFrame) -> DataFrame:
    """One row: is any cell missing? One pass over all columns."""
    tests = [F.max(missing(f.name, f.dataType).cast("int")) for f in df.schema]
    seen = tests[0] if len(tests) == 1 else F.greatest(*tests)
    return df.agg((F.coalesce(seen, F.lit(0)) == 1).alias("has_missing"))


def missing_profile(df: DataFrame) -> DataFrame:
    """Share of missing cells per column, columns without any left out, largest first."""
    shares = df.agg(*[
        F.avg(missing(f.name, f.dataType).cast("double")).alias(f"c{i}") for i, f in enumerate(df.schema)
    ])
    rows = F.array(*[
        F.struct(F.lit(f.name).alias("column"), F.col(f"c{i}").alias("percent"))
        for i, f in enumerate(df.schema)
    ])
    return (
        shares.select(F.inline(rows)).filter("percent > 0").orderBy(F.desc("percent"), "column")
    )


def drop_missing_rows(df: DataFrame, after_top: int | None = None, columns: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a missing cell in `columns`, in all columns, or, with `after_top`, in
    the columns ranked below the `after_top` most missing ones."""
    subset = list(columns) if columns else df.columns
    if after_top is not None:
        ranked = [r["column"] for r in missing_profile(df).collect()]  # at most one row per column
        subset = ranked[after_top:]
    return df.dropna("any", subset=subset) if subset else df


def impute_mean(df: DataFrame, columns: Sequence[str], train: DataFrame | None = None) -> DataFrame:
    """Fill missing cells with the column mean of `train` (default: of the table itself)."""
    means = scalar((train or df).agg(*[F.avg(clean(F.col(c))).alias(c) for c in columns]))
    return df.withColumn("_means", means).withColumns(
        {c: F.coalesce(clean(F.col(c)), F.col("_means")[c]) for c in columns}).drop("_means")


def clean_infinite(df: DataFrame, columns: Sequence[str], fill: float | None = None) -> DataFrame:
    """NaN and infinities to null, or to `fill`."""
    value = lambda c: clean(F.col(c)) if fill is None else F.coalesce(clean(F.col(c)), F.lit(fill))
    return df.withColumns({c: value(c) for c in columns})


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast columns; values that do not fit become null."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})


def override_by_key(df: DataFrame, overrides: DataFrame, key: str, column: str) -> DataFrame:
    """Replace `column` in the rows whose key is listed in `overrides(key, column)`."""
    new = overrides.select(key, F.col(column).alias("_new"), F.lit(True).alias("_hit"))
    joined = df.join(broadcast_if_small(new), key, "left")
    value = F.when(F.col("_hit"), F.col("_new")).otherwise(F.col(column))
    return joined.withColumn(column, value).select(*df.columns)


def map_codes(column: str | Column, codes: Mapping) -> Column:
    """Look a code up in a small constant dictionary; unknown codes become null."""
    pairs = [F.lit(x) for kv in codes.items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), F.col(column) if isinstance(column, str) else column)


def flag_where(column: str | Column, condition: Column) -> Column:
    """The value where the condition holds, else null."""
    return F.when(condition, F.col(column) if isinstance(column, str) else column)


def fill_gaps_with_neighbours(
    df: DataFrame, order_by: str, channels: Sequence[str], series: str | None = None,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Replace zeros by half the filled previous value plus half the raw next value.

    In a run of m zeros between p and q, place j gets p / 2^j, and the last one q / 2 more.
    Runs that touch an end of the series stay zero."""
    hot_rows = settle(df, series, hot_rows)
    out = with_position(df, [order_by], series, "_p", hot_rows)
    here = {c: F.when(F.col(c) != 0, F.struct(F.col("_p").alias("p"), F.col(c).alias("x"))) for c in channels}
    out = carried(out, ["_p"], {f"_b_{c}": v for c, v in here.items()},
                  {f"_a_{c}": v for c, v in here.items()}, series, hot_rows)
    filled = {}
    for c in channels:
        prev, nxt = F.col(f"_b_{c}"), F.col(f"_a_{c}")
        decayed = prev["x"] / F.pow(F.lit(2.0), F.col("_p") - prev["p"])
        last = nxt["p"] == F.col("_p") + 1
        value = decayed + F.when(last, nxt["x"] / 2.0).otherwise(0.0)
        gap = (F.col(c) == 0) & prev.isNotNull() & nxt.isNotNull()
        filled[c] = F.when(gap, value).otherwise(F.col(c))
    return out.withColumns(filled).select(*df.columns)


def preview(df: DataFrame, order_by: str | Sequence[str], n: int = 5) -> DataFrame:
    """First rows in a stated order."""
    return df.orderBy(*names(order_by)).limit(n)


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(df.columns)))
