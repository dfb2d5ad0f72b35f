"""Importance resampling of documents towards a target distribution.

The features of a text are its runs of 1 to `longest` consecutive words (A-Z lower-cased; a word is a run of digits, letters
and non-ASCII characters), joined by one blank, repeats counted, each in bucket crc32 % `buckets`. The corpus and the target are counted per bucket, one
array of `buckets` numbers per task. The gain of a bucket is the floored log ratio of its smoothed shares; a document's
weight sums the gains of its features through that array. Its score adds Gumbel noise from a hash of doc_id, so taking
the highest scores draws without replacement in proportion to exp(weight / 1000).

The cutoff needs no sort of the table: a mergeable sketch of the scores brackets it, one exact count of the rows above and
inside the bracket validates it (or the next wider bracket is taken, the whole range in the end), and only the bracket is
range-partitioned and sorted to find the last drawn row. The drawn rows then get their ranks from the places in
range partitions.

Defined cases: a null or wordless text has no features and weight 0; texts of any length are worked through in blocks; of equal
scores the smaller doc_id wins, a null doc_id (hashed as an empty one) before all others, then the smaller hash of the text; repeated rows are rows
of their own; an empty corpus gives an empty result, an empty target gives the gains of no counts. Columns of other
names are ignored."""

from __future__ import annotations

import functools
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oddrows.functions.lineage import written
from oddrows.functions.ordering import sorted_run
from oddrows.llm import texts, words

BUCKETS = 10_000
LONGEST = 3
PERCENT = 5
MIN_WORDS = 20
SEED = 42
#: rank error of the sketch is 1 / ACCURACY; the first bracket is 3 / ACCURACY wide on either side
ACCURACY = 20_000
_ALL = np.uint32(0xFFFFFFFF)
_POLYNOMIAL = 0xEDB88320


@functools.cache
def _byte_table() -> np.ndarray:
    """CRC-32 of one byte: what a register whose low byte is `i` turns into."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(_POLYNOMIAL), table >> 1)
    return table


def _step(register: np.ndarray) -> np.ndarray:
    return _byte_table()[register & 255] ^ (register >> 8)


def _looked_up(table: np.ndarray, register: np.ndarray) -> np.ndarray:
    return (table[..., 0, :][register & 255] ^ table[..., 1, :][(register >> 8) & 255]
            ^ table[..., 2, :][(register >> 16) & 255] ^ table[..., 3, :][register >> 24])


@functools.cache
def _zeros_table() -> np.ndarray:
    """[n, byte, value]: the register after n zero bytes, n < 64, as the xor of the entries of its four bytes."""
    out = np.empty((64, 4, 256), np.uint32)
    out[0] = np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32)[:, None])
    for n in range(1, 64):
        out[n] = _step(out[n - 1])
    return out


@functools.cache
def _long_table(k: int) -> np.ndarray:
    """The same for 64 * 2**k zero bytes."""
    return _step(_zeros_table()[63]) if k == 0 else _looked_up(_long_table(k - 1), _long_table(k - 1))


def _followed(crc: np.ndarray, after: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC of two strings one after the other, from their CRCs and the length of the second."""
    table, low = _zeros_table(), length & 63
    out = (table[low, 0, crc & 255] ^ table[low, 1, (crc >> 8) & 255]
           ^ table[low, 2, (crc >> 16) & 255] ^ table[low, 3, crc >> 24])
    high, k = length >> 6, 0
    while (high >> k).any():
        rows = np.flatnonzero((high >> k) & 1)
        out[rows] = _looked_up(_long_table(k), out[rows])
        k += 1
    return out ^ after


def word_crcs(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """CRC-32 and byte length of every word, and the n + 1 places where each text's words begin."""
    body, ends = words.text_bytes(column)
    low, _, sign = words._byte_tables()
    first = np.zeros(len(body) + 1, bool)
    first[ends[:-1]] = True
    crcs, lengths, places, at = [], [], [], 0
    while at < len(body):
        stop = min(len(body), at + words.BLOCK_BYTES)
        while stop < len(body):  # on to the next byte that is no part of a word, or the next text
            free = np.flatnonzero(sign[body[stop: stop + words.BLOCK_BYTES]] | first[stop: min(stop + words.BLOCK_BYTES, len(body))])
            stop = stop + int(free[0]) if len(free) else min(len(body), stop + words.BLOCK_BYTES)
            if len(free):
                break
        block, cut = low[body[at:stop]], first[at:stop]
        inside = ~sign[block]
        starts = np.flatnonzero(inside & (~np.concatenate([[False], inside[:-1]]) | cut))
        stops = np.flatnonzero(inside & (~np.concatenate([inside[1:], [False]]) | np.concatenate([cut[1:], [True]]))) + 1
        size = stops - starts
        order = np.argsort(-size, kind="stable")
        from_, left = starts[order], size[order]
        register = np.full(len(order), _ALL, np.uint32)
        n = len(order)
        for step in range(64):  # one byte of all words that have it
            n = int(np.searchsorted(-left, -step, "left"))
            if not n:
                break
            register[:n] = _byte_table()[(register[:n] ^ block[from_[:n] + step]) & 255] ^ (register[:n] >> 8)
        crc = np.empty(len(order), np.uint32)
        crc[order] = register ^ _ALL
        for long in np.flatnonzero(size > 64):
            crc[long] = zlib.crc32(block[starts[long]: stops[long]].tobytes())
        crcs.append(crc)
        lengths.append(size)
        places.append(starts + at)
        at = stop
    join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
    return join(crcs, np.uint32), join(lengths, np.int64), np.searchsorted(join(places, np.int64), ends)


def feature_buckets(column: pa.Array, longest: int, buckets: int) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
    """Per run length: buckets of the runs and the words they begin at; and where each text's words begin."""
    crc, length, at = word_crcs(column)
    text_of = np.repeat(np.arange(len(at) - 1), np.diff(at))
    found, begins, run = [], [], crc
    for n in range(1, longest + 1):
        if n > 1:
            if len(crc) < n:
                break
            spaced = _step(run[:-1] ^ _ALL ^ np.uint32(32)) ^ _ALL
            run = _followed(spaced, crc[n - 1:], length[n - 1:])
        begin = np.flatnonzero(text_of[: len(run)] == text_of[n - 1:])
        found.append((run[begin] % np.uint32(buckets)).astype(np.int64))
        begins.append(begin)
    return found, begins, at


def bucket_counts(table: DataFrame, text: str = "text", longest: int = LONGEST, buckets: int = BUCKETS) -> np.ndarray:
    """Features per bucket over all rows: one array a task, summed by Spark; `buckets` numbers come back."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for whole in batches:
            for batch in words.slices(whole, "text"):
                for found in feature_buckets(batch.column("text"), longest, buckets)[0]:
                    total += np.bincount(found, minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["bucket", "n"])

    rows = table.select(F.col(text).cast("string").alias("text")).mapInArrow(count, "bucket long, n long")
    summed = rows.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(buckets, np.int64)
    out[summed.column("bucket").to_numpy()] = summed.column("n").to_numpy()
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln) of target share over corpus share per bucket, one added to every count."""
    all_s, all_t = float(int(corpus.sum()) + len(corpus)), float(int(target.sum()) + len(target))
    return np.array([math.floor(1000 * math.log((t + 1.0) * all_s / ((s + 1.0) * all_t)))
                     for s, t in zip(corpus.tolist(), target.tolist())], np.int64)


def scored(docs: DataFrame, gain: np.ndarray, longest: int = LONGEST, seed: int = SEED) -> DataFrame:
    """doc_id, row (hash of the text), n_words, n_features, weight and score of every row of docs (doc_id, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in words.slices(whole, "text"):
                found, begins, at = feature_buckets(batch.column("text"), longest, len(gain))
                sums, counts = np.zeros(at[-1] + 1, np.int64), np.zeros(at[-1] + 1, np.int64)
                for bucket, begin in zip(found, begins):
                    sums[begin + 1] += gain[bucket]
                    counts[begin + 1] += 1
                sums, counts = np.cumsum(sums), np.cumsum(counts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("row"), pa.array(np.diff(at)), pa.array(np.diff(counts[at])), pa.array(np.diff(sums[at]))],
                    ["doc_id", "row", "n_words", "n_features", "weight"])

    rows = docs.select("doc_id", texts.row_key("text").alias("row"), "text").mapInArrow(
        run, "doc_id long, row long, n_words long, n_features long, weight long")
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("bigint")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))
    return rows.withColumn("score", F.col("weight") + noise)


def bracket(rows: DataFrame, column: str, wanted: int, share: float, accuracy: int = ACCURACY) -> tuple[int | None, int | None, int]:
    """Ends (low, high) of a range of scores that holds the `wanted`-th highest one, and the rows above it; null ends are open.

    The ends are sketched at once for brackets of growing width; each is held against exact counts before it is believed."""
    widths = []
    while not widths or widths[-1] < 1:
        widths.append(3.0 / accuracy * 4 ** len(widths))
    lows = [max(0.0, 1 - share - w) for w in widths]
    highs = [min(1.0, 1 - share + w) for w in widths]
    ends = rows.agg(F.percentile_approx(column, F.array(*map(F.lit, lows + highs)), accuracy)).first()[0]
    for low, high in zip(ends[: len(widths)], ends[len(widths):]):
        c = F.col(column)
        seen = rows.agg(F.count_if(c > high).alias("above"), F.count_if(c.between(low, high)).alias("inside")).first()
        if seen["above"] < wanted <= seen["above"] + seen["inside"]:
            return low, high, seen["above"]
    return None, None, 0


def importance_sample(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", target_text: str = "text",
                      percent: int = PERCENT, min_words: int = MIN_WORDS, longest: int = LONGEST, buckets: int = BUCKETS,
                      seed: int = SEED, accuracy: int = ACCURACY) -> DataFrame:
    """doc_id, row, n_words, n_features, weight, score of every row of docs, and rank (1, 2, ...) of the drawn ones, else null.

    floor(percent * N / 100) of the N documents with at least `min_words` words are drawn."""
    docs = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    gain = gains(bucket_counts(docs, "text", longest, buckets), bucket_counts(target, target_text, longest, buckets))
    table = written(scored(docs, gain, longest, seed))
    able = table.filter(F.col("n_words") >= min_words)
    wanted = able.count() * percent // 100
    unranked = F.lit(None).cast("bigint").alias("rank")
    if not wanted:
        return table.select("*", unranked)
    low, high, above = bracket(able, "score", wanted, percent / 100, accuracy)
    inside = able if low is None else able.filter(F.col("score").between(low, high))
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_first(), F.col("row").asc()]
    last = _at_place(sorted_run(inside.select("score", "doc_id", "row"), order), wanted - above - 1)
    same_score = F.when(F.lit(last["doc_id"] is None), F.col("doc_id").isNull() & (F.col("row") <= last["row"])).otherwise(
        F.col("doc_id").isNull() | (F.col("doc_id") < last["doc_id"]) | ((F.col("doc_id") == last["doc_id"]) & (F.col("row") <= last["row"])))
    drawn = (F.col("n_words") >= min_words) & ((F.col("score") > last["score"]) | ((F.col("score") == last["score"]) & same_score))
    ranked = sorted_run(table.filter(drawn), order)
    starts, at = [], 0
    for r, n in _run_sizes(ranked):
        starts.append((r, at))
        at += n
    begin = F.create_map(*[F.lit(v) for pair in starts for v in pair])  # one entry per range partition
    rank = F.element_at(begin, F.col("_run").cast("int")) + F.col("_off") + 1
    rank = F.when(rank <= wanted, rank).cast("bigint")  # of repeats of the last row only as many as fit
    return ranked.select(*table.columns, rank.alias("rank")).unionByName(
        table.filter(~F.coalesce(drawn, F.lit(False))).select("*", unranked))


def _run_sizes(run: DataFrame) -> list[tuple[int, int]]:
    """Rows of each range partition, in order."""
    return sorted((int(r["_run"]), r["count"]) for r in run.groupBy("_run").count().collect())


def _at_place(run: DataFrame, place: int):
    """The row at a 0-based place of a range-partitioned table."""
    for r, n in _run_sizes(run):
        if place < n:
            return run.filter((F.col("_run") == r) & (F.col("_off") == place)).first()
        place -= n
    raise ValueError("the bracket does not hold the cutoff")


def op11(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return importance_sample(docs, benchmark).select("doc_id", "n_features", "weight", "score", "rank")
