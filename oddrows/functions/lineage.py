"""Cut lineage by writing a table to the folder the session names for checkpoints."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """`spark.checkpoint.dir` of the session; a temporary folder only in local mode."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="oddrows-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def written(df: DataFrame, rows_a_file: int = 0) -> DataFrame:
    """Write `df` once and go on from the files, so lost executors cost no recomputation.

    A file of few bytes is read by one task; `rows_a_file` makes more files of a table whose rows cost much arithmetic."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/oddrows-{uuid.uuid4().hex}"
    df.write.option("maxRecordsPerFile", rows_a_file).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
