"""Small column helpers shared by the operators."""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def names(value: str | Iterable[str] | None) -> list[str]:
    """One name, several names or none, as a list."""
    if value is None:
        return []
    return [value] if isinstance(value, str) else list(value)


def clean(value: Column) -> Column:
    """NaN and infinities become null; every other value is kept."""
    v = value.cast("double")
    return F.when(F.isnan(v) | (F.abs(v) == float("inf")), None).otherwise(v)


def scalar(df: DataFrame, *columns: Column | str) -> Column:
    """A one-row table as a struct-valued scalar subquery: no join, no driver round trip."""
    return df.select(F.struct(*(columns or ["*"])).alias("row")).scalar()


def rounded(value: Column | str, digits: int) -> Column:
    """Round and turn -0.0 into 0.0, so equal results print equally."""
    col = F.col(value) if isinstance(value, str) else value
    return F.round(col.cast("double"), digits) + F.lit(0.0)


def hash32(*parts: Column | str | int) -> Column:
    """Repeatable 32-bit hash of the parts, the same on any partitioning and any engine
    with md5. Strings are taken as column names, integers as constants."""
    cols = [F.lit(str(p)) if isinstance(p, int) else
            (F.col(p) if isinstance(p, str) else p).cast("string") for p in parts]
    text = F.concat_ws(":", *cols)
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def uniform(*parts: Column | str | int) -> Column:
    """Repeatable uniform number in (0, 1) from a hash of the parts."""
    return (hash32(*parts) + F.lit(0.5)) / F.lit(4294967296.0)


def gaussian(*parts: Column | str | int) -> Column:
    """Repeatable standard normal number (Box-Muller on two hash uniforms)."""
    radius = F.sqrt(F.lit(-2.0) * F.log(uniform(1, *parts)))
    return radius * F.cos(F.lit(2.0 * math.pi) * uniform(2, *parts))


def literal_array(values: Iterable[float]) -> Column:
    """Constant array<double> column from driver-side numbers."""
    return F.array(*[F.lit(float(v)) for v in values])


def dot(x: Column, weights: Iterable[float]) -> Column:
    """Inner product of an array column with constant weights."""
    pairs = F.zip_with(x, literal_array(weights), lambda a, b: a.cast("double") * b)
    return F.aggregate(pairs, F.lit(0.0), lambda acc, v: acc + v)
