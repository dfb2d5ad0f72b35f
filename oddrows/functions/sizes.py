"""Broadcast behind a measured size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oddrows.functions.columns import names
from oddrows.functions.lineage import written

BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 16_000_000
SALTS = 32


def measured_bytes(df: DataFrame) -> Column:
    """Aggregate: bytes of the rows, counted on their JSON form."""
    return F.coalesce(F.sum(F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))), F.lit(0))


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS, bytes_limit: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint only when the table really has at most `rows` rows and `bytes_limit` bytes;
    otherwise the same join runs as a shuffle join."""
    size = df.limit(rows + 1).agg(F.count(F.lit(1)).alias("n"), measured_bytes(df).alias("b")).first()
    return F.broadcast(df) if size["n"] <= rows and size["b"] <= bytes_limit else df


def join_groups(df: DataFrame, other: DataFrame, by, how: str = "left") -> DataFrame:
    """Equi-join of two tables of one row per group and the like; null keys match each other."""
    keys = names(by)
    right = other.select(*[F.col(k).alias(f"_group_{i}") for i, k in enumerate(keys)],
                         *[c for c in other.columns if c not in keys])
    match = F.lit(True)
    for i, k in enumerate(keys):
        match = match & F.col(k).eqNullSafe(F.col(f"_group_{i}"))
    return df.join(right, match, how).drop(*[f"_group_{i}" for i in range(len(keys))])


def with_params(df: DataFrame, params: DataFrame, by, how: str = "left", bytes_limit: int = BROADCAST_BYTES) -> DataFrame:
    """Attach the one parameter row of each group; a null group is a group like any other.

    Parameters are written once and their size is measured in bytes. Up to the limit they are sent
    to the tasks, so the rows are not moved. Beyond it both sides are dealt by group and a salt, so a group
    that holds most rows is spread over `SALTS` tasks."""
    keys = names(by)
    stored = written(params.select(*[F.col(k).alias(f"_group_{i}") for i, k in enumerate(keys)],
                                   *[c for c in params.columns if c not in keys]))
    size = stored.agg(measured_bytes(stored)).first()[0]
    match = F.lit(True)
    for i, k in enumerate(keys):
        match = match & F.col(k).eqNullSafe(F.col(f"_group_{i}"))
    drop = [f"_group_{i}" for i in range(len(keys))]
    if size <= bytes_limit:
        return df.join(F.broadcast(stored), match, how).drop(*drop)
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(SALTS)))
    spread = stored.withColumn("_salt_of", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))))
    return salted.join(spread, match & (F.col("_salt") == F.col("_salt_of")), how).drop(*drop, "_salt", "_salt_of")
