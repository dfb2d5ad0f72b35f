"""Benchmark decontamination: item-sized windows of documents against benchmark items.

Words are runs of letters, digits and marks of any script, A-Z lower-cased; in scripts written without blanks
(Chinese, Japanese, Thai and the like) each character is a word; shingles are five
words (an item with fewer words is one shingle, met by windows of its size). Each item and each window of
an item's size has a 64-bit SimHash, in which a shingle weighs as often as it occurs. Fingerprints are
cut into `BLOCKS` blocks of 8 bits; within the radius some block differs in at most radius // BLOCKS bits, and a
table of all such blocks gives the candidates, so every fingerprint within the radius is found. Candidates
are confirmed by the exact weighted Jaccard similarity of the shingle counts (sum of minima by sum
of maxima) of at least `percent`. A document with fewer words than an item is one window for it: the items that
share enough shingles with it are confirmed in the same way, without fingerprints. Windows that hold no shingle of an item of their size have similarity 0
and are not fingerprinted.

Items are sent to the tasks in blocks of about `block_words` words, each with a pass over the documents; the number of
passes grows with the benchmark, what is sent does not.

Defined cases: null or wordless texts and items match nothing; repeated items are reported each; rows
equal in doc_id and text are one document; of equal windows the first is reported. An empty benchmark or table finds nothing; texts of any length are searched whole.
Columns of other names are ignored."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oddrows.functions.lineage import written
from oddrows.llm import texts, words

SHINGLE = 5
PERCENT = 80
RADIUS = 23
BLOCKS = 8
BLOCK_WORDS = 2_000_000
_WINDOWS_AT_ONCE = 4096


@dataclass
class Size:
    """Items of one length in words."""
    length: int
    shingle: int
    ids: np.ndarray
    counts: list[Counter]
    prints: np.ndarray
    tables: np.ndarray  # blocks x 256 x items: may the item have a fingerprint with this block nearby
    known: np.ndarray   # sorted shingles of the items
    owners: np.ndarray  # items that hold known[k]: owners[first[k]: first[k + 1]]
    first: np.ndarray


def _bits(shingles: np.ndarray) -> np.ndarray:
    """+1 or -1 for each of the 64 bits of each shingle."""
    octets = np.ascontiguousarray(shingles).view(np.uint8).reshape(-1, 8)
    return np.unpackbits(octets, axis=1, bitorder="little").astype(np.int8) * np.int8(2) - np.int8(1)


def _prints(sums: np.ndarray) -> np.ndarray:
    return np.packbits(sums > 0, axis=1, bitorder="little").view(np.uint64).ravel()


def _shingles(hashes: np.ndarray, length: int) -> np.ndarray:
    return words.run_hashes(hashes, min(SHINGLE, length))


def index_items(items: list[tuple[object, np.ndarray]], radius: int = RADIUS) -> list[Size]:
    """Items (number, word hashes) by length, with their fingerprints and block tables."""
    by_length: dict[int, list[tuple[object, np.ndarray]]] = {}
    for number, hashes in items:
        if len(hashes):
            by_length.setdefault(len(hashes), []).append((number, _shingles(hashes, len(hashes))))
    octets = np.arange(256, dtype=np.uint8)
    near = np.bitwise_count(octets[:, None] ^ octets[None, :]) <= radius // BLOCKS
    out = []
    for length, own in sorted(by_length.items()):
        prints = np.concatenate([_prints(_bits(s).sum(axis=0, dtype=np.int64, keepdims=True)) for _, s in own])
        parts = prints.view(np.uint8).reshape(-1, BLOCKS)
        tables = np.stack([near[:, parts[:, b]] for b in range(BLOCKS)])
        sets = [np.unique(s) for _, s in own]
        held, owner = np.concatenate(sets), np.repeat(np.arange(len(own), dtype=np.int32), [len(s) for s in sets])
        known, first = np.unique(np.sort(held), return_index=True)
        out.append(Size(length, min(SHINGLE, length), np.array([n for n, _ in own], object),
                        [Counter(s.tolist()) for _, s in own], prints, tables, known, owner[np.argsort(held, kind="stable")], np.append(first, len(held))))
    return out


def _similar(window: Counter, item: Counter, total: int) -> tuple[int, int]:
    """Numerator and denominator of the weighted Jaccard similarity of two multisets that have `total` elements together."""
    common = sum(min(n, window[s]) for s, n in item.items() if s in window)
    return common, total - common


def _short_matches(shingles: np.ndarray, size: Size, percent: int) -> list[tuple[int, int, float]]:
    """(0, item, similarity) of a text with fewer words than the items, taken as one window."""
    span, own = size.length - size.shingle + 1, len(shingles)
    if 100 * own < percent * span:
        return []
    each, times = np.unique(shingles, return_counts=True)
    place = np.minimum(np.searchsorted(size.known, each), len(size.known) - 1)
    hit = np.flatnonzero(size.known[place] == each)
    most = np.zeros(len(size.ids), np.int64)  # no item has more in common than this
    for p, n in zip(place[hit].tolist(), times[hit].tolist()):
        most[size.owners[size.first[p]: size.first[p + 1]]] += n
    found, window = [], Counter(shingles.tolist())
    for item in np.flatnonzero((most > 0) & (100 * most >= percent * (own + span - most))).tolist():
        common, total = _similar(window, size.counts[item], own + span)
        if 100 * common >= percent * total:
            found.append((0, item, common / total))
    return found


def _matches(shingles: np.ndarray, seeds: np.ndarray, size: Size, radius: int, percent: int) -> list[tuple[int, int, float]]:
    """(start, item, similarity) of every window of one text that reaches the threshold."""
    span = size.length - size.shingle + 1  # shingles of a window
    starts = np.unique((seeds[:, None] - np.arange(span)[None, :]).ravel())
    starts = starts[(starts >= 0) & (starts + span <= len(shingles))]
    found = []
    for at in range(0, len(starts), _WINDOWS_AT_ONCE):
        own = starts[at: at + _WINDOWS_AT_ONCE]
        needed = np.unique(np.concatenate([own[:1], *(own + k for k in range(span))])) if span > 1 else own
        place = np.searchsorted(needed, own)
        sums = np.concatenate([np.zeros((1, 64), np.int32), np.cumsum(_bits(shingles[needed]), axis=0, dtype=np.int32)])
        prints = _prints(sums[place + span] - sums[place])
        parts = prints.view(np.uint8).reshape(-1, BLOCKS)
        candidates = size.tables[0][parts[:, 0]]
        for b in range(1, BLOCKS):
            candidates = candidates | size.tables[b][parts[:, b]]
        rows, items = np.nonzero(candidates)
        close = np.bitwise_count(prints[rows] ^ size.prints[items]) <= radius
        for row, item in zip(rows[close].tolist(), items[close].tolist()):
            start = int(own[row])
            common, total = _similar(Counter(shingles[start: start + span].tolist()), size.counts[item], 2 * span)
            if 100 * common >= percent * total:
                found.append((start, item, common / total))
    return found


def leaks(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
          item_text: str = "text", radius: int = RADIUS, percent: int = PERCENT, block_words: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, row (hash of the text), item_id, start (word), n_words, similarity: the best window of
    every document and item that reach the threshold."""
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_id).cast("bigint").alias("item_id"), F.col(item_text).cast("string").alias("text"))
    source = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), texts.row_key(text).alias("row"),
                         F.col(text).cast("string").alias("text"))

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, at = words.word_hashes(words.unicode_words(batch.column("text")), letters_only=True)
            lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(hashes.view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("item_id"), lists], ["item_id", "hashes"])

    tokenised = written(items.mapInArrow(tokens, "item_id long, hashes array<long>"))
    total = tokenised.agg(F.sum(F.size("hashes"))).first()[0] or 0
    passes = max(1, -(-total // block_words))
    result = None
    for k in range(passes):
        own = tokenised.filter(F.pmod(F.xxhash64("hashes"), F.lit(passes)) == k).collect() if total else []
        sizes = index_items([(r.item_id, np.array(r.hashes, np.int64).view(np.uint64)) for r in own], radius)
        found = _scan(source, spark.sparkContext.broadcast(sizes), radius, percent)
        result = found if result is None else result.unionByName(found)
    return result


def _scan(source: DataFrame, sizes, radius: int, percent: int) -> DataFrame:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_shingle: dict[int, list[Size]] = {}
        for s in sizes.value:
            by_shingle.setdefault(s.shingle, []).append(s)
        known = {k: np.unique(np.concatenate([s.known for s in own])) for k, own in by_shingle.items()}
        marks = {}
        for k, all_known in known.items():  # a bit for the upper 22 bits of each known shingle
            marks[k] = np.zeros(1 << 22, bool)
            marks[k][all_known >> np.uint64(42)] = True
        for whole in batches:
            for batch in words.slices(whole, "text"):
                yield from _scan_batch(batch, by_shingle, known, marks, radius, percent)

    return source.mapInArrow(scan, "doc_id long, row long, item_id long, start long, n_words long, similarity double")


def _scan_batch(batch, by_shingle, known, marks, radius, percent) -> Iterator[pa.RecordBatch]:
    hashes, at = words.word_hashes(words.unicode_words(batch.column("text")), letters_only=True)
    out: list[tuple[int, object, int, int, float]] = []
    for k, own in by_shingle.items():
        runs = words.run_hashes(hashes, k)
        maybe = np.flatnonzero(marks[k][runs >> np.uint64(42)])
        maybe = maybe[np.isin(runs[maybe], known[k])]
        text_of = np.searchsorted(at, maybe, "right") - 1
        maybe_ok = maybe + k <= at[text_of + 1]
        maybe, text_of = maybe[maybe_ok], text_of[maybe_ok]
        for t in np.unique(text_of).tolist():
            shingles = runs[at[t]: at[t + 1] - k + 1]
            seeds = maybe[text_of == t] - at[t]
            for size in own:
                mine = seeds[np.isin(shingles[seeds], size.known)]
                best: dict[int, tuple[float, int]] = {}
                if not len(mine):
                    continue
                short = len(shingles) < size.length - size.shingle + 1
                pairs = _short_matches(shingles, size, percent) if short else _matches(shingles, mine, size, radius, percent)
                for start, item, value in pairs:
                    if item not in best or value > best[item][0]:
                        best[item] = (value, start)
                out += [(t, size.ids[item], start, min(size.length, int(at[t + 1] - at[t])), value) for item, (value, start) in best.items()]
    rows = pa.array([o[0] for o in out], pa.int64())
    yield pa.RecordBatch.from_arrays(
        [batch.column("doc_id").take(rows), batch.column("row").take(rows), *(
            pa.array([o[k] for o in out], kind) for k, kind in ((1, pa.int64()), (2, pa.int64()), (3, pa.int64()), (4, pa.float64())))],
        ["doc_id", "row", "item_id", "start", "n_words", "similarity"])


def op2(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, contaminated, n_items, item_ids (sorted), best_similarity of every document."""
    found = leaks(docs, benchmark).groupBy("doc_id", "row").agg(
        F.array_sort(F.collect_set("item_id")).alias("items"), F.max("similarity").alias("best"))
    found = found.select(F.col("doc_id").alias("_id"), F.col("row").alias("_row"), "items", "best")
    rows = docs.select("doc_id", texts.row_key("text").alias("row"))
    out = rows.join(found, rows["doc_id"].eqNullSafe(found["_id"]) & (rows["row"] == found["_row"]), "left")
    items = F.coalesce("items", F.array().cast("array<bigint>"))
    return out.select("doc_id", F.col("items").isNotNull().alias("contaminated"), F.size(items).cast("bigint").alias("n_items"),
                      items.alias("item_ids"), F.round(F.coalesce("best", F.lit(0.0)), 6).alias("best_similarity"))
