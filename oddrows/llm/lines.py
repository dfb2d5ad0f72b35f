"""Line dedup over windows of three consecutive lines.

Lines are trimmed; lines without a word are left out before windows are formed. Each window is
hashed (MD5 of the three lines). The first occurrence of a window over all documents, in the order
of (doc_id, row, place in the text), stays; every later one covers its three lines, and the union of
the covered lines is removed. Windows are compared on the input, not on what is left.

Defined cases: a null text is empty; with fewer than three lines nothing is removed; a null doc_id
comes first; rows equal in doc_id and text are one document, so they do not remove each other. A text
that loses lines comes back as its remaining lines with a word, joined by newlines; any other text
comes back unchanged. An empty table gives an empty result; texts of any length are hashed whole.
Columns of other names are ignored."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oddrows.llm import texts

WINDOW = 3


def _lines(text: Column) -> Column:
    return F.filter(F.transform(texts.lines_of(text), lambda x: F.regexp_replace(
        x, f"^{texts.SPACE}+|{texts.SPACE}+$", "")), lambda x: x != "")


def line_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """doc_id, text, carried (the other columns), n_lines, n_removed (lines with a word), kept_text."""
    base = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), texts.carried(docs, text))
    lines = base.select("doc_id", texts.row_key("text").alias("_row"), _lines(texts.text_or_empty("text")).alias("_lines"))
    hashes = texts.bound(F.col("_lines"), lambda x: F.when(F.size(x) >= window, F.transform(
        F.sequence(F.lit(0), F.size(x) - window), lambda i: F.unhex(F.md5(F.array_join(F.slice(x, i + 1, window), "\n"))))))
    # outer: the plain form would put the whole expression into a filter of its own as well
    each = lines.withColumn("_hashes", hashes).select(
        "doc_id", "_row", F.posexplode_outer("_hashes").alias("_at", "_window"))
    each = each.filter(F.col("_window").isNotNull())
    place = F.struct("doc_id", "_row", "_at")
    first = each.groupBy("_window").agg(F.min(place).alias("_first"), F.max(place).alias("_last"))
    first = first.filter(~F.col("_first").eqNullSafe(F.col("_last"))).select("_window", "_first")
    later = each.join(first, "_window").filter(~place.eqNullSafe(F.col("_first")))
    hits = later.groupBy("doc_id", "_row").agg(F.array_sort(F.collect_set("_at")).alias("_hits"))
    hits = hits.select("_hits", F.col("doc_id").alias("_id"), F.col("_row").alias("_key"))
    keyed = base.withColumn("_row", texts.row_key("text"))
    out = keyed.join(hits, keyed["doc_id"].eqNullSafe(hits["_id"]) & (keyed["_row"] == hits["_key"]), "left")
    out = out.withColumn("_lines", _lines(texts.text_or_empty("text")))
    out = out.withColumn("_kept", F.when(F.col("_hits").isNull(), F.col("_lines")).otherwise(
        texts.without_ranges(F.col("_lines"), F.col("_hits"), window)))
    return out.select(
        "doc_id", "text", "carried", F.size("_lines").cast("bigint").alias("n_lines"),
        (F.size("_lines") - F.size("_kept")).cast("bigint").alias("n_removed"),
        F.when(F.col("_hits").isNull(), F.col("text")).otherwise(F.array_join("_kept", "\n")).alias("kept_text"))


def op6(docs: DataFrame) -> DataFrame:
    return line_dedup(docs).select("doc_id", "n_lines", "n_removed",
                                   F.sha2(F.coalesce("kept_text", F.lit("")), 256).alias("kept_sha256"))


OP6_SQL = """
WITH raw AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS p FROM documents),
lines AS (
  SELECT doc_id, line, row_number() OVER (PARTITION BY doc_id ORDER BY p) AS i FROM (
    SELECT doc_id, p, regexp_replace(line, '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g') AS line FROM raw)
  WHERE line <> ''),
windows AS (
  SELECT doc_id, i, line || chr(10) || l2 || chr(10) || l3 AS g FROM (
    SELECT doc_id, i, line, lead(line) OVER w AS l2, lead(line, 2) OVER w AS l3
    FROM lines WINDOW w AS (PARTITION BY doc_id ORDER BY i)) WHERE l3 IS NOT NULL),
later AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS n FROM windows)
  WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, i + k AS i FROM later, (SELECT unnest([0, 1, 2]) AS k)),
kept AS (
  SELECT l.doc_id, count(*) AS n, count(g.i) AS removed,
    string_agg(CASE WHEN g.i IS NULL THEN line END, chr(10) ORDER BY l.i) AS left_over
  FROM lines l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.i = g.i GROUP BY l.doc_id)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_lines, coalesce(removed, 0)::BIGINT AS n_removed,
  sha256(CASE WHEN coalesce(removed, 0) = 0 THEN coalesce(text, '') ELSE coalesce(left_over, '') END) AS kept_sha256
FROM documents d LEFT JOIN kept USING (doc_id)
"""
