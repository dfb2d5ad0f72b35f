"""Documents to token ids: quality rules, line dedup, near-dedup, decontamination, SentencePiece.

Each stage takes the documents that the stage before it kept and returns documents with the same
columns; the last returns doc_id, n_tokens, ids and decoded_sha256. Where a stage changes a text, n_chars
follows it. Every stage is written as Parquet and reread by the next one. A null text, a repeated row and an
empty table go through as each operator's docstring says; other columns of documents are carried along."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oddrows.functions.lineage import written
from oddrows.llm import decontaminate, lines, minhash, pieces, quality, texts

#: near-duplicates of the pipeline: five-word shingles, a similarity of 0.8 or more
SHINGLE, PERCENT = 5, 80
ORACLE_SQL = None  # SentencePiece encoding is not expressible in SQL; tests hold the stages against brute force


def _with_text(rows: DataFrame, docs: DataFrame) -> DataFrame:
    out = texts.restored(rows, docs.columns, "text", F.col("kept_text"))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return out.select(*[f"`{c}`" for c in docs.columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go, lines over the limits leave the others."""
    return _with_text(quality.quality_rules(docs).filter("kept"), docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of three-line passages leave the texts; every document stays."""
    return _with_text(lines.line_dedup(docs), docs)


def _where(docs: DataFrame, rows: DataFrame, how: str) -> DataFrame:
    """Documents with (left_semi) or without (left_anti) a row of the same doc_id and text."""
    keyed = docs.withColumn("_pipeline_row", texts.row_key("text"))
    match = keyed["doc_id"].eqNullSafe(rows["doc_id"]) & (keyed["_pipeline_row"] == rows["row"])
    return keyed.join(rows, match, how).drop("_pipeline_row")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: the one with the smallest doc_id."""
    kept = minhash.near_duplicates(docs, shingle=SHINGLE, percent=PERCENT).filter("kept")
    return _where(docs, kept.select("doc_id", "row").distinct(), "left_semi")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    benchmark = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    found = decontaminate.leaks(docs, benchmark)
    return _where(docs, found.select("doc_id", "row").distinct(), "left_anti")


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what is left, with the digest of the text decoded from them."""
    coded = pieces.encode_texts(docs, pieces.default_model())
    return coded.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids",
                        F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("sentencepiece", sentencepiece),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
    return docs
