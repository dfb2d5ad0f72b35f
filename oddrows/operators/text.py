"""Event text as features: vocabulary, index sequences, padding, pooled word vectors."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from oddrows.functions.columns import uniform
from oddrows.functions.lineage import written
from oddrows.functions.ordering import HOT_ROWS, with_position

# Characters that separate words.
FILTERED = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~\t\n"

#: words looked up inside the tasks at most; larger vocabularies are joined
LOOKUP_WORDS = 100_000


def spaced(text: str | Column) -> Column:
    """Lower case, every filtered character a blank."""
    col = F.col(text) if isinstance(text, str) else text
    return F.regexp_replace(F.lower(col), "[" + re.escape(FILTERED) + "]", " ")


def words(text: str | Column) -> Column:
    """Lower case, punctuation to blanks, split on blanks, empty pieces dropped."""
    return F.filter(F.split(spaced(text), " "), lambda w: w != "")


def build_vocabulary(df: DataFrame, text: str, num_words: int | None = None, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """`word, count, index`: index 1 is the most frequent word, ties in word order. `num_words`
    keeps the indexes below it. Counts combine before the shuffle, so hot words are no burden."""
    pieces = df.select(F.explode(F.split(spaced(text), " ")).alias("word")).filter("word <> ''")
    counts = pieces.groupBy("word").agg(F.count(F.lit(1)).alias("count"))
    if num_words is not None:
        top = counts.orderBy(F.desc("count"), "word").limit(max(num_words - 1, 0))
        order = Window.orderBy(F.desc("count"), "word")  # fewer than num_words rows
        return top.withColumn("index", F.row_number().over(order).cast("bigint"))
    # texts are scanned once; ordering works on the written counts
    placed = with_position(written(counts), [F.desc("count"), F.col("word")], name="index", hot_rows=hot_rows)
    return placed.withColumn("index", F.col("index") + 1)


def texts_to_sequences(df: DataFrame, text: str, vocabulary: DataFrame, key: str, to: str = "sequence") -> DataFrame:
    """Word indexes of every text in order, unknown words dropped.

    Up to `LOOKUP_WORDS` words the dictionary goes to the tasks and texts are not shuffled; a larger
    vocabulary is joined word by word and gathered per key and text. Both give each row its own words."""
    if vocabulary.limit(LOOKUP_WORDS + 1).count() <= LOOKUP_WORDS:
        table = df.sparkSession.sparkContext.broadcast({r["word"]: int(r["index"]) for r in vocabulary.select("word", "index").collect()})

        @F.pandas_udf("array<int>")
        def look(lines: pd.Series) -> pd.Series:
            index = table.value
            return pd.Series([[index[w] for w in (s or "").split(" ") if w in index] for s in lines])

        return df.withColumn(to, look(spaced(text)))
    texts = df.select(F.col(key).alias("_key"), F.col(text).alias("_text")).distinct()
    spread = texts.select("*", F.posexplode(words("_text")).alias("_at", "word"))
    known = vocabulary.select("word", F.col("index").cast("int").alias("_i"))
    hits = spread.join(known, "word").groupBy("_key", "_text").agg(
        F.sort_array(F.collect_list(F.struct("_at", "_i"))).alias("_s"))
    match = F.col(key).eqNullSafe(F.col("_key")) & F.col(text).eqNullSafe(F.col("_text"))
    found = F.coalesce(F.transform("_s", lambda s: s["_i"]), F.array().cast("array<int>"))
    return df.join(hits, match, "left").withColumn(to, found).drop("_key", "_text", "_s")


def pad_sequences(df: DataFrame, sequence: str, length: int = 350, to: str | None = None) -> DataFrame:
    """Zeros in front up to `length`; longer sequences keep their last `length` entries."""
    s = F.col(sequence)
    short = F.concat(F.array_repeat(F.lit(0), F.greatest(length - F.size(s), F.lit(0))), s)
    cut = F.slice(s, -length, length)
    return df.withColumn(to or sequence, F.when(F.size(s) > length, cut).otherwise(short))


def hash_vectors(vocabulary: DataFrame, dim: int, seed: int = 0) -> DataFrame:
    """Stand-in word vectors in [-0.5, 0.5) from a hash of (seed, place, word)."""
    vec = F.transform(F.sequence(F.lit(0), F.lit(dim - 1)), lambda i: uniform(seed, i, "word") - 0.5)
    return vocabulary.select("word", vec.alias("vec"))


def embed_vocabulary(vocabulary: DataFrame, vectors: DataFrame, dim: int, num_words: int = 600) -> DataFrame:
    """Vector matrix in index order: row 0 for padding, one row per kept word, zeros when unknown."""
    from oddrows.operators.joins import lookup_word_vectors
    rows = lookup_word_vectors(vocabulary, vectors, dim, num_words).select("index", "vec")
    zero = vocabulary.sparkSession.range(1).select(
        F.lit(0).cast("bigint").alias("index"), F.array_repeat(F.lit(0.0).cast("float"), dim).alias("vec"))
    return zero.unionByName(rows)


def pooled_text_vector(
    df: DataFrame, text: str, vectors: DataFrame, key: str, dim: int, how: str = "mean", to: str = "vec",
) -> DataFrame:
    """Mean or element-wise maximum of the vectors of a text's known words (null without any).

    Words are joined with their vectors and pooled per key and text by one vector aggregate, however many
    numbers a vector has; no vector comes to the driver."""
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # short texts mean much arithmetic: no coalescing
    texts = df.select(F.col(key).alias("_key"), F.col(text).alias("_text")).repartition(tasks, "_key", "_text").distinct()
    spread = texts.select("*", F.explode(words("_text")).alias("word"))
    # one row per text and word first: repeated words weigh by their count
    counted = spread.groupBy("_key", "_text", "word").agg(F.count(F.lit(1)).cast("double").alias("c"))
    numbers = vectors.select("word", array_to_vector(F.slice(F.col("vec").cast("array<double>"), 1, dim)).alias("_n"))
    pooled = counted.join(numbers, "word").groupBy("_key", "_text").agg(
        Summarizer.mean(F.col("_n"), F.col("c")).alias("_v") if how == "mean" else Summarizer.max(F.col("_n")).alias("_v"))
    pooled = pooled.select("_key", "_text", vector_to_array("_v").alias(to))
    match = F.col(key).eqNullSafe(F.col("_key")) & F.col(text).eqNullSafe(F.col("_text"))
    return df.join(pooled, match, "left").drop("_key", "_text")


def split_strip_cast(line: str | Column, sep: str = r"\s+", skip: int = 0) -> Column:
    """Trimmed line split on a pattern, first `skip` fields dropped, the rest as doubles."""
    col = F.col(line) if isinstance(line, str) else line
    fields = F.split(F.trim(col), sep)
    return F.transform(F.slice(fields, skip + 1, F.size(fields)), lambda v: v.try_cast("double"))
