"""Rows of one table that pass by a group of another one, without a cogroup held in memory."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oddrows.functions.sizes import with_params

#: passing rows that one task handles of a key
VISITS = 20_000


def salted(held: DataFrame, passing: DataFrame, key: str, spread: str, visits: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Both tables with a column `salt`: keys with many passing rows are spread over several tasks, their group goes to each."""
    load = passing.groupBy(key).agg(F.ceil(F.count(F.lit(1)) / (visits or VISITS)).cast("int").alias("_salts"))
    counted = with_params(passing, load, key, "inner")
    passing = counted.withColumn("salt", F.pmod(F.xxhash64(spread), F.col("_salts")).cast("int")).drop("_salts")
    held = held.join(load, key).withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1))).drop("_salts")
    return held, passing


def meet(held: DataFrame, passing: DataFrame, by: list[str], schema: str,
         run: Callable[[pa.RecordBatch, pa.RecordBatch], pa.RecordBatch]) -> DataFrame:
    """`run(group, batch)` for the rows of `passing`, batch by batch, with the rows of `held` of the same integer keys.

    A task reads its rows in order of key with the held ones first, so it holds one group and one batch. Passing rows
    whose group is empty make nothing."""
    ours, theirs = held.columns, passing.columns
    both = held.withColumn("_side", F.lit(0)).unionByName(passing.withColumn("_side", F.lit(1)), allowMissingColumns=True)
    parts = int(held.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # few bytes can mean much arithmetic: no coalescing
    dealt = both.repartition(parts, *by).sortWithinPartitions(*by, "_side")

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, group, pieces = None, None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in (*by, "_side")])
            cuts = np.flatnonzero((np.diff(keys, axis=0) != 0).any(axis=1)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)]):
                key, piece = tuple(keys[a, :-1]), batch.slice(a, b - a)
                if key != now:
                    now, group, pieces = key, None, []
                if keys[a, -1] == 0:
                    pieces.append(piece.select(ours))
                elif pieces or group is not None:
                    if group is None:
                        group, pieces = pa.Table.from_batches(pieces).combine_chunks().to_batches()[0], []
                    yield run(group, piece.select(theirs))

    return dealt.mapInArrow(stream, schema)
