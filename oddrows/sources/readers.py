"""Readers for the file shapes the analyses start from. Schemas are declared, not inferred."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oddrows.functions.columns import clean
from oddrows.functions.lineage import written


def _as_schema(schema: str | T.StructType) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def nan_to_null(df: DataFrame) -> DataFrame:
    """Null is the one missing marker: NaN and infinities become null on read."""
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: clean(F.col(c)) for c in floats}) if floats else df


def read_csv_table(spark: SparkSession, path: str, schema: str | T.StructType, **options) -> DataFrame:
    """CSV with a header line."""
    return nan_to_null(spark.read.schema(schema).options(header=True, nanValue="NaN", **options).csv(path))


def read_tsv_events(
    spark: SparkSession, path: str, schema: str | T.StructType, time: str = "start_time", fmt: str = "yyyy-MM-dd HH:mm",
) -> DataFrame:
    """Tab-separated event texts; `time` is read as text and parsed, with a date key added."""
    raw = spark.read.schema(schema).options(header=True, sep="\t").csv(path)
    return raw.withColumn(time, F.try_to_timestamp(F.col(time), F.lit(fmt))).withColumn(
        "date", F.date_format(time, "yyyy-MM-dd"))


def read_sheet_export(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """A spreadsheet saved as CSV or Parquet (Spark reads no binary sheet format)."""
    if path.rstrip("/").endswith(".parquet"):
        return nan_to_null(spark.read.schema(schema).parquet(path))
    return read_csv_table(spark, path, schema)


def read_arff(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """ARFF files with the same attributes: header lines give the schema, the rest is CSV.

    Only the attribute lines (one per column) come to the driver."""
    lines = spark.read.text(paths if isinstance(paths, str) else list(paths))
    text = F.trim("value")
    head = lines.filter(F.lower(text).startswith("@attribute")).select(
        F.monotonically_increasing_id().alias("at"),
        F.regexp_extract(text, r"(?i)^@attribute\s+('[^']*'|\"[^\"]*\"|\S+)\s+(.*)$", 1).alias("name"),
        F.regexp_extract(text, r"(?i)^@attribute\s+('[^']*'|\"[^\"]*\"|\S+)\s+(.*)$", 2).alias("kind"),
    )
    fields: dict[str, T.DataType] = {}
    for r in head.orderBy("at").collect():
        numeric = r["kind"].strip().lower().split()[0] in ("numeric", "real", "integer") if r["kind"].strip() else False
        fields.setdefault(r["name"].strip("'\""), T.DoubleType() if numeric else T.StringType())
    schema = T.StructType([T.StructField(n, t) for n, t in fields.items()])
    data = lines.filter((text != "") & ~text.rlike(r"(?i)^@(relation|attribute|data)\b") & ~text.startswith("%"))
    row = F.from_csv(text, schema.simpleString()[len("struct<"):-1].replace(":", " "), {"nullValue": "?"}) \
        if all(n.isidentifier() for n in fields) else F.from_csv(
            text, ", ".join(f"`{n}` {t.simpleString()}" for n, t in fields.items()), {"nullValue": "?"})
    return data.select(row.alias("r")).select("r.*")


def label_map(column: str | Column) -> Column:
    """JSON object text to a map series -> timestamps (as text)."""
    return F.from_json(column, "map<string,array<string>>")


def read_label_map(spark: SparkSession, path: str, fmt: str | None = None, by_line: bool = False) -> DataFrame:
    """JSON files {series: [timestamp, ...]} to rows (series, ts): one object per file, or with
    `by_line` one per line, which can be split."""
    whole = spark.read.text(path, wholetext=not by_line)
    pairs = whole.select(F.explode(label_map("value")).alias("series", "stamps"))
    stamp = F.explode("stamps").alias("stamp")
    parsed = F.try_to_timestamp(F.col("stamp"), F.lit(fmt)) if fmt else F.try_to_timestamp(F.col("stamp"))
    return pairs.select("series", stamp).select("series", parsed.alias("ts"))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines with their file and 0-based line number.

    Lines of a file come in order inside its splits, and splits are ordered by their offset;
    the number is a running count per file over the splits (one row per split), not an id."""
    raw = written(spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("at")))
    splits = raw.groupBy("file", "start").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    earlier = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    offset = splits.select("file", "start", "first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    return raw.join(offset, ["file", "start"]).select(
        "file", (F.col("at") - F.col("first") + F.col("before")).alias("line"), "value")


def read_numeric_lines(spark: SparkSession, path: str, drop_first: bool = False) -> DataFrame:
    """Blank-separated numbers per line: `file, line, channels`; the first one may be a time."""
    from oddrows.operators.text import split_strip_cast
    lines = read_lines(spark, path)
    return lines.filter(F.trim("value") != "").withColumn(
        "channels", split_strip_cast("value", r"\s+", 1 if drop_first else 0)).drop("value")


def read_headerless_csv(spark: SparkSession, path: str, schema: str | T.StructType, drop_first: bool = True) -> DataFrame:
    """CSV without a header; the first column is left out by default."""
    full = _as_schema(schema)
    out = spark.read.schema(full).option("header", False).csv(path)
    return out.drop(full.fieldNames()[0]) if drop_first else out


def read_word_vectors(spark: SparkSession, path: str) -> DataFrame:
    """Lines `word f1 f2 ...` to (word, vec)."""
    parts = F.split(F.trim("value"), r"\s+")
    return spark.read.text(path).filter(F.trim("value") != "").select(
        parts[0].alias("word"),
        F.transform(F.slice(parts, 2, F.size(parts)), lambda v: v.cast("float")).alias("vec"))
