"""Quality rules: measures of each text and the frequency of its lines across the documents of a host.

A line is normalised (lower case, digit runs to 0, white space runs to one blank, trimmed) and
hashed. For each host the documents that hold the line are counted; a line held by more than
`line_docs` documents and by more than `line_share` per cent of the host's documents is over the
limits and is removed. A document left with less than `left_share` per cent of its words is depleted.

Defined cases: a null text is an empty one and fails the base rules; a null host is a host of its
own; each row counts as a document; lines without a word are never counted or removed; rows equal
in doc_id and text get the same verdict. An empty table gives an empty result; texts of any length are measured whole.
Columns of other names are ignored."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oddrows.functions.lineage import written
from oddrows.functions.sizes import broadcast_if_small
from oddrows.llm import texts

MIN_WORDS = 20
REPEAT_WINDOW = 8
REPEAT_SHARE = 30
LINE_DOCS = 10
LINE_SHARE = 5
LEFT_SHARE = 50
SYMBOLS = "#*$%&|<>"


def normalised_lines(text: Column) -> Column:
    """Normalised lines in order; lines without a word come out empty."""
    flat = F.regexp_replace(F.regexp_replace(F.lower(text), "[0-9]+", "0"), "[\\x20\\x09\\x0B-\\x0D]+", " ")
    return F.transform(texts.lines_of(flat), lambda line: F.trim(line))


def _window_hashes(words: Column, size: int) -> Column:
    return texts.bound(words, lambda w: F.when(F.size(w) >= size, F.transform(
        F.sequence(F.lit(0), F.size(w) - size), lambda i: F.xxhash64(F.slice(w, i + 1, size)))
    ).otherwise(F.array().cast("array<bigint>")))


def _covered(hashes: Column, size: int) -> Column:
    """Words in windows whose hash occurs twice or more."""
    def repeated(s: Column) -> Column:
        same = lambda p, j: F.coalesce(F.get(s, j)["h"] == p["h"], F.lit(False))
        return F.filter(s, lambda p, i: same(p, i - 1) | same(p, i + 1))
    ordered = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    places = F.array_sort(F.transform(texts.bound(ordered, repeated), lambda p: p["i"]))
    start = F.struct(F.lit(0).alias("n"), F.lit(-size).alias("last"))
    total = F.aggregate(places, start, lambda a, p: F.struct(
        (a["n"] + F.least(F.lit(size), p - a["last"])).alias("n"), p.alias("last")), lambda a: a["n"])
    return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), total).otherwise(F.lit(0))


def measures(docs: DataFrame, text: str, size: int = REPEAT_WINDOW) -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (all long)."""
    body = texts.text_or_empty(text)
    step = docs.withColumns({"_words": texts.words_of(body), "_lines": F.filter(texts.lines_of(body), texts.has_word)})
    step = step.withColumn("_hashes", _window_hashes(F.col("_words"), size))
    long = {
        "n_words": F.size("_words"),
        "word_chars": F.length(F.regexp_replace(body, f"{texts.SPACE}+", "")),
        "n_symbols": F.length(body) - F.length(F.regexp_replace(body, "[#*$%&|<>]+", "")),
        "n_dup_lines": F.size("_lines") - F.size(F.array_distinct("_lines")),
        "n_repeat_words": _covered(F.col("_hashes"), size),
    }
    return step.withColumns({k: v.cast("bigint") for k, v in long.items()}).drop("_words", "_lines", "_hashes")


def frequent_lines(docs: DataFrame, host: str, text: str, line_docs: int = LINE_DOCS,
                   line_share: int = LINE_SHARE) -> DataFrame:
    """_host, _line (hash) of the lines over the limits. Counts combine before the shuffle."""
    hashes = F.transform(F.filter(normalised_lines(texts.text_or_empty(text)), lambda x: x != ""), lambda x: F.xxhash64(x))
    each = docs.select(F.col(host).alias("_host"), F.explode_outer(F.array_distinct(hashes)).alias("_line"))
    each = each.filter(F.col("_line").isNotNull())  # outer: no second evaluation in an inferred filter
    counts = each.groupBy("_host", "_line").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > line_docs)
    sizes = docs.groupBy(F.col(host).alias("_of")).agg(F.count(F.lit(1)).alias("_docs"))
    over = counts.join(sizes, counts["_host"].eqNullSafe(sizes["_of"]))
    return over.filter(F.col("_n") * 100 > F.col("_docs") * line_share).select("_host", "_line")


def quality_rules(docs: DataFrame, doc_id: str = "doc_id", host: str = "source", text: str = "text",
                  line_docs: int = LINE_DOCS, line_share: int = LINE_SHARE, left_share: int = LEFT_SHARE) -> DataFrame:
    """doc_id, host, text, the measures, base_failed, n_line_words (words in removed lines), kept,
    kept_text (the text without its removed lines, the text itself if none is removed), and
    carried: the other columns of docs."""
    base = docs.select(F.col(doc_id).alias("doc_id"), F.col(host).alias("host"), F.col(text).alias("text"),
                       texts.carried(docs, text))
    over = broadcast_if_small(written(frequent_lines(base, "host", "text", line_docs, line_share)))
    body = texts.text_or_empty("text")
    per_line = F.transform(normalised_lines(body), lambda x: F.struct(
        F.xxhash64(x).alias("h"), F.when(x == "", 0).otherwise(F.size(F.split(x, " "))).alias("w")))
    rows = base.select("doc_id", texts.row_key("text").alias("_row"), F.col("host").alias("_h"),
                       F.posexplode_outer(per_line).alias("_at", "_is"))
    rows = rows.filter(F.col("_is.w") > 0)
    found = rows.join(over, rows["_h"].eqNullSafe(over["_host"]) & (rows["_is"]["h"] == over["_line"]))
    hits = found.groupBy("doc_id", "_row").agg(
        F.array_sort(F.collect_set(F.struct(F.col("_at").alias("at"), F.col("_is.w").alias("w")))).alias("_hits"))
    hits = hits.select("_hits", F.col("doc_id").alias("_id"), F.col("_row").alias("_key"))
    judged = measures(base.withColumn("_row", texts.row_key("text")), "text")
    judged = judged.join(hits, judged["doc_id"].eqNullSafe(hits["_id"]) & (judged["_row"] == hits["_key"]), "left")
    gone = F.coalesce(F.aggregate("_hits", F.lit(0).cast("bigint"), lambda a, x: a + x["w"]), F.lit(0))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_SHARE * F.col("n_words"))
    depleted = 100 * (F.col("n_words") - F.col("n_line_words")) < left_share * F.col("n_words")
    lines = texts.lines_of(F.col("text"))
    cleaned = F.array_join(texts.without_ranges(lines, F.transform("_hits", lambda x: x["at"]), 1), "\n")
    return judged.withColumns({"n_line_words": gone.cast("bigint"), "base_failed": failed}).select(
        "doc_id", "host", "text", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "carried", "base_failed", "n_line_words", (~F.col("base_failed") & ~depleted).alias("kept"),
        F.when(F.col("_hits").isNull(), F.col("text")).otherwise(cleaned).alias("kept_text"))


def op4(docs: DataFrame) -> DataFrame:
    return quality_rules(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                                      "n_repeat_words", "base_failed", "n_line_words", "kept")


OP4_SQL = f"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
words AS (SELECT doc_id, list_filter(string_split_regex(text, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w FROM d),
word_rows AS (SELECT doc_id, i, w[i] AS word FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM words)),
windows AS (
  SELECT doc_id, i, concat_ws(' ', {", ".join(f"word{k}" for k in range(8))}) AS g FROM (
    SELECT doc_id, i, word AS word0, {", ".join(f"lead(word, {k}) OVER w AS word{k}" for k in range(1, 8))}
    FROM word_rows WINDOW w AS (PARTITION BY doc_id ORDER BY i)) WHERE word7 IS NOT NULL),
repeated AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM windows) WHERE n > 1),
covered AS (
  SELECT doc_id, count(DISTINCT i + k)::BIGINT AS n FROM repeated, (SELECT unnest(range(0, 8)) AS k) GROUP BY doc_id),
raw_lines AS (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line FROM d),
dups AS (
  SELECT doc_id, (count(*) - count(DISTINCT line))::BIGINT AS n FROM raw_lines
  WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id),
lines AS (
  SELECT doc_id, source, trim(regexp_replace(regexp_replace(lower(line), '[0-9]+', '0', 'g'),
    '[\\x20\\x09\\x0B-\\x0D]+', ' ', 'g')) AS line FROM raw_lines),
hosts AS (SELECT source, count(*) AS docs FROM d GROUP BY source),
over_limits AS (
  SELECT l.source, l.line FROM lines l JOIN hosts USING (source) WHERE line <> '' GROUP BY l.source, l.line, docs
  HAVING count(DISTINCT doc_id) > {LINE_DOCS} AND count(DISTINCT doc_id) * 100 > docs * {LINE_SHARE}),
gone AS (
  SELECT doc_id, sum(len(string_split(l.line, ' ')))::BIGINT AS n
  FROM lines l JOIN over_limits o ON l.source = o.source AND l.line = o.line GROUP BY doc_id),
m AS (
  SELECT d.doc_id, len(w)::BIGINT AS n_words,
    length(regexp_replace(text, '[\\x20\\x09-\\x0D]+', '', 'g'))::BIGINT AS word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]+', '', 'g')))::BIGINT AS n_symbols,
    coalesce(dups.n, 0)::BIGINT AS n_dup_lines, coalesce(covered.n, 0)::BIGINT AS n_repeat_words,
    coalesce(gone.n, 0)::BIGINT AS n_line_words
  FROM d JOIN words USING (doc_id) LEFT JOIN dups USING (doc_id) LEFT JOIN covered USING (doc_id)
  LEFT JOIN gone USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < {MIN_WORDS} OR 100 * n_repeat_words > {REPEAT_SHARE} * n_words AS base_failed, n_line_words,
  NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {REPEAT_SHARE} * n_words)
    AND NOT (100 * (n_words - n_line_words) < {LEFT_SHARE} * n_words) AS kept
FROM m
"""
