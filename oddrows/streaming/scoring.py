"""The fitted detectors on a stream: frozen parameters in, flagged rows out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def stream_score(stream: DataFrame, score: Callable[[DataFrame], DataFrame], path: str, checkpoint: str,
                 once: bool = True) -> StreamingQuery:
    """Score every micro-batch with a batch operator and append to a table.

    Parameters are tables, so each batch runs the same plan as a batch job would."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        score(batch).withColumn("batch", F.lit(batch_id)).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    writer = stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def stream_resample(stream: DataFrame, ts: str, column: str, width: str = "1 day", delay: str = "1 hour") -> DataFrame:
    """Mean, sample std and count per event-time bucket, late rows dropped after the watermark."""
    return stream.withWatermark(ts, delay).groupBy(F.window(ts, width)).agg(
        F.avg(column).alias("mean"), F.stddev_samp(column).alias("std"), F.count(column).alias("n")
    ).select(F.col("window.start").alias("bucket"), "mean", "std", "n")


def stream_outlier_regions(
    flagged: DataFrame, ts: str, value: str, series: str, gap: str = "1 hour", delay: str = "1 hour",
) -> DataFrame:
    """Stretches of flagged rows of a series no further apart than `gap`, as session windows."""
    return flagged.filter(F.col("is_outlier") == 1).withWatermark(ts, delay).groupBy(
        series, F.session_window(ts, gap)
    ).agg(F.count(F.lit(1)).alias("points"), F.min(value).alias("lo"), F.max(value).alias("hi")).select(
        series, F.col("session_window.start").alias("start"), "points", "lo", "hi")
