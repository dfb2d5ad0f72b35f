"""Registered queries of the operators, each on its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from oddrows.llm import (centroids, decontaminate, importance, language, licenses, lines, minhash, pieces, quality, suffixes, topk, urls,
                         warc)


def _on(table: str, operator: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: operator(spark.read.parquet(f"{folder.rstrip('/')}/{table}.parquet"))


def _against_benchmark(operator: Callable[[DataFrame, DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        read = lambda t: spark.read.parquet(f"{folder.rstrip('/')}/{t}.parquet")
        return operator(read("documents"), read("benchmark"))
    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_license_scan": _on("documents", licenses.op1),
    "op2_decontamination": _against_benchmark(decontaminate.op2),
    "op3_minhash_near_dedup": _on("documents", minhash.op3),
    "op4_quality_rules": _on("documents", quality.op4),
    "op5_warc": _on("pages", warc.op5),
    "op6_line_dedup": _on("documents", lines.op6),
    "op7_url_filter": _on("pages", urls.op7),
    "op8_suffix_dedup": _on("documents", suffixes.op8),
    "op9_sentencepiece": _on("documents", pieces.op9),
    "op10_language_id": _on("documents", language.op10),
    "op11_importance_sample": _against_benchmark(importance.op11),
    "op12_centroid_clusters": _on("embeddings", centroids.op12),
    "op13_top_k": _on("embeddings", topk.op13),
}
ORACLES: dict[str, str] = {
    "op1_license_scan": licenses.OP1_SQL,
    "op4_quality_rules": quality.OP4_SQL,
    "op5_warc": warc.OP5_SQL,
    "op6_line_dedup": lines.OP6_SQL,
    "op7_url_filter": urls.OP7_SQL,
    "op12_centroid_clusters": centroids.OP12_SQL,
    "op13_top_k": topk.OP13_SQL,
}
