"""Sinks: metric rows, result tables, labelled splits, fitted parameters."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_metric_rows(metrics: DataFrame, path: str, run: str, model: str) -> None:
    """Append one row per metric column (a one-row table), partitioned by metric."""
    rows = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value"))
                     for c in metrics.columns])
    metrics.select(F.lit(run).alias("run"), F.lit(model).alias("model"), F.inline(rows)).write.mode(
        "append").partitionBy("metric").parquet(path)


def write_result_tables(tables: Mapping[str, DataFrame], path: str, partition: str = "channel") -> None:
    """One Parquet table per result, partitioned by channel where the table has one."""
    for name, df in tables.items():
        writer = df.write.mode("overwrite")
        (writer.partitionBy(partition) if partition in df.columns else writer).parquet(f"{path}/{name}")


def read_result_tables(spark: SparkSession, path: str, names: list[str]) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{path}/{n}") for n in names}


def write_labeled_splits(df: DataFrame, path: str, split: str = "split") -> None:
    """One labelled table partitioned by split: readers of one split never open the others."""
    df.write.mode("overwrite").partitionBy(split).parquet(path)


def save_params(params: DataFrame, path: str) -> None:
    params.write.mode("overwrite").parquet(path)


def load_params(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
