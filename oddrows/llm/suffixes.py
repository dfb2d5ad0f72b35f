"""Repeated byte strings: remove every byte that a string of `length` bytes covers which also starts earlier.

1. Exact copies of a text are taken out first: all but the first are covered whole.
2. Each text is winnowed: every `length`-byte window picks the smallest hash among its `GRAM`-byte grams, the rightmost
   of equals. Equal windows pick equal grams, so all occurrences of a repeated string meet at one gram. A picked gram
   (an anchor) comes with the range of window starts that picked it and a hash of the bytes those windows span (its context).
3. Equal contexts of one batch are collapsed before the shuffle, so a text that very many documents share sends one row a
   batch. The rest is dealt by gram hash and sorted. Equal contexts are collapsed while streaming: all but the first occurrence are
   covered. Only grams that occur in different contexts go on, one row per distinct context.
4. Their contexts go into suffix arrays, with the shared gram as one symbol. The suffix array is built by
   linear grouping: suffixes are grouped by their Lyndon prefix, groups are processed in descending order with previous-smaller
   pointers, then each group's order is emitted in one pass, without recursion or renaming. Neighbours with equal windows
   are repeats; all but the earliest are covered.
   Grams with more than `GROUP_CONTEXTS` different contexts are dealt again by whole windows, so no group has to fit a task.
5. Covered ranges are merged per text and cut out.

Defined cases: a null text is empty; strings are compared as UTF-8 bytes within one text; documents are ordered by doc_id
(null first), rows of one doc_id by a hash of the text; rows equal in doc_id and text are one document and get the same result.
An empty table gives an empty result; long texts are worked through in blocks, nothing of them is left out.
Columns of other names are ignored."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oddrows.functions.lineage import written
from oddrows.functions.ordering import with_position
from oddrows.functions.sizes import broadcast_if_small
from oddrows.llm import texts
from oddrows.llm.words import mixed

LENGTH = 100
GRAM = 64
GROUP_CONTEXTS = 20_000
BLOCK = 1 << 20
BATCH_SYMBOLS = 200_000
_STEP = 0x100000001B3
_LOW_BITS = (1 << 21) - 1


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffix array of integers whose last one is the smallest and occurs once.

    Groups lie in `order` as ranges; `group[i]` is the start of the range of suffix i, so groups compare by their starts."""
    n = len(text)
    first = np.argsort(text, kind="stable")
    sorted_text = text[first]
    heads = np.concatenate([[True], sorted_text[1:] != sorted_text[:-1]])
    starts = np.maximum.accumulate(np.where(heads, np.arange(n), 0))
    group_of = np.empty(n, np.int64)
    group_of[first] = starts
    place_of = np.empty(n, np.int64)
    place_of[first] = np.arange(n)
    order, group, place = first.tolist(), group_of.tolist(), place_of.tolist()
    size = np.bincount(starts, minlength=n).tolist()
    before = [-1] * n  # previous suffix that lies in a lower group

    end = n - 1
    while end >= 0:
        start = group[order[end]]
        if start == end:  # a group of one suffix: the pointed-to suffix leaves its group for one right behind it
            i = order[end]
            j = i - 1
            while j >= 0 and group[j] >= start:
                j = before[j]
            before[i] = j
            if j >= 0:
                g = group[j]
                left = size[g] - 1
                if left:
                    size[g] = left
                    last = g + left
                    p, k = place[j], order[last]
                    order[p], place[k] = k, p
                    order[last], place[j] = j, last
                    group[j] = last
                    size[last] = 1
        else:
            pointed: dict[int, int] = {}
            for i in sorted(order[start:end + 1]):
                j = i - 1
                while j >= 0 and group[j] >= start:
                    j = before[j]
                before[i] = j
                if j >= 0:
                    pointed[j] = pointed.get(j, 0) + 1
            by_count: dict[int, list[int]] = {}
            for j, c in pointed.items():
                by_count.setdefault(c, []).append(j)
            for c in sorted(by_count, reverse=True):  # those most often pointed to stand highest
                own = by_count[c]
                for j in own:
                    g = group[j]
                    size[g] -= 1
                    last = g + size[g]
                    p, k = place[j], order[last]
                    order[p], place[k] = k, p
                    order[last], place[j] = j, last
                moved = [group[j] + size[group[j]] for j in own]
                for j, g in zip(own, moved):
                    group[j] = g
                    size[g] += 1
        end = start - 1

    out, free, placed = [0] * n, list(range(n)), [False] * n
    out[0] = n - 1
    placed[n - 1] = True
    for r in range(n):
        j = out[r] - 1
        while j >= 0 and not placed[j]:
            g = group[j]
            out[free[g]] = j
            free[g] += 1
            placed[j] = True
            j = before[j]
    return np.array(out)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    one = np.ones(1, np.uint64)
    return (np.cumprod(np.concatenate([one, np.full(n, _STEP, np.uint64)])),
            np.cumprod(np.concatenate([one, np.full(n, pow(_STEP, -1, 2**64), np.uint64)])))


def anchors(body: np.ndarray, length: int, gram: int, powers: np.ndarray, back: np.ndarray, letters: np.ndarray) -> tuple:
    """(gram hash, context hash, gram place, first and last window start) of the anchors of a block of bytes."""
    n, width = len(body), length - gram + 1
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(letters[body] * powers[:n])])
    hashed = lambda a, b: mixed((sums[b] - sums[a]) * back[a] + (b - a).astype(np.uint64))
    at = np.arange(n - gram + 1)
    grams = hashed(at, at + gram)
    ranked = (grams & ~np.uint64(_LOW_BITS)) | (np.uint64(_LOW_BITS) - at.astype(np.uint64))  # rightmost of equals
    rows = np.concatenate([ranked, np.full(-len(ranked) % width, np.uint64(2**64 - 1))]).reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    count = n - length + 1
    least = np.minimum(behind[:count], ahead[width - 1: width - 1 + count])
    chosen = _LOW_BITS - (least & np.uint64(_LOW_BITS)).astype(np.int64)
    lo = np.flatnonzero(np.concatenate([[True], chosen[1:] != chosen[:-1]]))
    hi = np.concatenate([lo[1:] - 1, [count - 1]])
    place = chosen[lo]
    return grams[place], hashed(lo, hi + length), place, lo, hi


def _seen_here(gram: np.ndarray, context: np.ndarray, doc: np.ndarray, lo: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which anchors of a batch follow an equal context of the same batch, and which repeat its first row."""
    later, twice = np.zeros(len(gram), bool), np.zeros(len(gram), bool)
    key = mixed(gram.view(np.uint64) * np.uint64(_STEP) + context.view(np.uint64))
    order = np.argsort(key, kind="stable")
    equal = key[order[1:]] == key[order[:-1]]
    some = order[np.concatenate([[False], equal]) | np.concatenate([equal, [False]])]
    some = some[np.lexsort((lo[some], doc[some], context[some], gram[some]))]
    if len(some):
        head = np.concatenate([[True], (gram[some[1:]] != gram[some[:-1]]) | (context[some[1:]] != context[some[:-1]])])
        first = some[np.maximum.accumulate(np.where(head, np.arange(len(some)), 0))]
        same = (doc[some] == doc[first]) & (lo[some] == lo[first])
        later[some[~head & ~same]] = True
        twice[some[~head & same]] = True
    return later, twice


def _anchor_rows(distinct: DataFrame, length: int, gram: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, back = _powers(BLOCK + length)
        letters = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        for batch in batches:
            out, size = [], 0
            for doc, text in zip(batch.column("doc").to_pylist(), batch.column("text")):
                body = np.frombuffer(text.as_buffer(), np.uint8) if text.is_valid else np.zeros(0, np.uint8)
                for at in range(0, max(len(body) - length + 1, 0), BLOCK):  # blocks share length - 1 bytes
                    gram_hash, context, place, lo, hi = anchors(body[at: at + BLOCK + length - 1], length, gram, powers, back, letters)
                    out.append((gram_hash.view(np.int64), context.view(np.int64), np.full(len(lo), doc), lo + at, place - lo, hi - lo))
                    size += len(lo)
                if size > 200_000:
                    yield _columns(out)
                    out, size = [], 0
            if out:
                yield _columns(out)

    def _columns(out: list[tuple]) -> pa.RecordBatch:
        joined = [np.concatenate(c) for c in zip(*out)]
        later, twice = _seen_here(*joined[:4])
        kinds = (np.int64, np.int64, np.int64, np.int32, np.int16, np.int16)
        arrays = [pa.array(joined[0], mask=later), *(pa.array(c.astype(k)) for c, k in zip(joined[1:], kinds[1:]))]
        return pa.RecordBatch.from_arrays(arrays, names).filter(pa.array(~twice))

    names = ["gram", "context", "doc", "lo", "at", "more"]
    return distinct.select("doc", "text").mapInArrow(run, "gram long, context long, doc long, lo int, at short, more short")


def _collapse(rows: DataFrame, length: int) -> DataFrame:
    """Streams anchors in the order (gram, context, doc, lo). Anchors found to be repeats before the shuffle come without a gram,
    are dealt anywhere and are covered. All but the first of a context are covered (gram is null); the
    firsts of a gram with two or more contexts go on with their gram."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # the last row seen
        held = None  # first row of the gram's only context so far
        for whole in batches:
            known = whole.column("gram").is_valid()
            done = whole.filter(pc.invert(known))
            if done.num_rows:
                stop = done.column("lo").to_numpy() + done.column("more").to_numpy() + length
                yield pa.RecordBatch.from_arrays([done.column("gram"), done.column("doc"), done.column("lo"),
                                                  pa.array(stop.astype(np.int32)), done.column("at")], out)
            batch = whole.filter(known)
            if not batch.num_rows:
                continue
            gram, context, doc, lo, at, more = (batch.column(c).to_numpy() for c in names)
            before = lambda x, k: np.concatenate([[last[k] if last else x[0] + 1], x[:-1]])
            new_gram = gram != before(gram, 0)
            if last is None:
                new_gram[0] = True
            new = new_gram | (context != before(context, 1))
            same = ~new & (doc == before(doc, 2)) & (lo == before(lo, 3))  # a repeated row
            later = np.flatnonzero(~new & ~same)
            firsts = np.flatnonzero(new)
            alone = new_gram[firsts]
            followed = np.append(~alone[1:], False)  # the next first row is of the same gram
            onward = firsts[~alone | followed]
            carried = []
            if held is not None and len(firsts) and not alone[0]:
                carried, held = [held], None  # the gram of the batch before has a second context
            elif len(firsts) and alone[0]:
                held = None
            if len(firsts) and alone[-1]:
                k = firsts[-1]
                held = tuple(int(c[k]) for c in (gram, context, doc, lo, at, more))
            last = tuple(int(c[-1]) for c in (gram, context, doc, lo))
            pick = np.concatenate([later, onward])
            own = np.concatenate([np.zeros(len(later), bool), np.ones(len(onward), bool)])
            parts = [pa.array(gram[pick], mask=~own), pa.array(doc[pick]), pa.array(lo[pick].astype(np.int32)),
                     pa.array((lo[pick] + more[pick] + length).astype(np.int32)), pa.array(at[pick].astype(np.int16))]
            yield pa.RecordBatch.from_arrays(parts, out)
            for g, _, d, a, p, m in carried:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([g], pa.int64()), pa.array([d], pa.int64()), pa.array([a], pa.int32()),
                     pa.array([a + m + length], pa.int32()), pa.array([p], pa.int16())], out)

    names, out = ["gram", "context", "doc", "lo", "at", "more"], ["gram", "doc", "lo", "stop", "at"]
    dealt = rows.withColumn("deal", F.coalesce("gram", F.xxhash64("doc", "lo"))).repartition("deal").drop("deal")
    dealt = dealt.sortWithinPartitions("gram", "context", "doc", "lo")
    return dealt.mapInArrow(run, "gram long, doc long, lo int, stop int, at short")


def _contexts(rows: DataFrame, distinct: DataFrame, gram: int) -> DataFrame:
    """gram, doc, lo, at, and the bytes of each context before and behind its gram."""
    lists = rows.groupBy("doc").agg(F.collect_list(F.struct("gram", "lo", "stop", "at")).alias("own"))
    both = distinct.select("doc", "text").join(lists, "doc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                body = batch.column("text")[k].as_buffer().to_pybytes()
                own = batch.column("own")[k].values
                pick = [own.field(c) for c in ("gram", "lo", "stop", "at")]
                lo, stop, at = (c.to_pylist() for c in pick[1:])
                before = [body[a: a + p] for a, p in zip(lo, at)]
                behind = [body[a + p + gram: z] for a, p, z in zip(lo, at, stop)]
                yield pa.RecordBatch.from_arrays(
                    [pick[0], pa.array(np.full(len(lo), batch.column("doc")[k].as_py())), pick[1], pick[3],
                     pa.array(before, pa.binary()), pa.array(behind, pa.binary())], ["gram", "doc", "lo", "at", "before", "behind"])

    return both.mapInArrow(run, "gram long, doc long, lo int, at short, before binary, behind binary")


def repeats(grams: list[int], before: list[bytes], behind: list[bytes], width: int) -> np.ndarray:
    """Places (context number, window start) of all but the earliest of equal windows, from one suffix array over the
    contexts, which must come in the order of (gram, document, place). A window spans `width` symbols, the gram being one."""
    count = len(grams)
    sizes = np.array([len(x) + 1 + len(y) for x, y in zip(before, behind)])
    starts = np.concatenate([[0], np.cumsum(sizes + 1)])
    numbers = np.unique(np.array(grams), return_inverse=True)[1]
    body = np.frombuffer(b"".join(x + b"\0" + y + b"\0" for x, y in zip(before, behind)), np.uint8).astype(np.int64)
    text = np.append(body + count + 1, 0)
    text[starts[:-1] + np.array([len(x) for x in before])] = count + 257 + numbers
    text[starts[1:] - 1] = np.arange(1, count + 1)  # ends differ, so that no match runs on
    order = suffix_array(text)
    owner = np.searchsorted(starts, order, "right") - 1
    ok = (owner < count)
    order, owner = order[ok], owner[ok]
    full = order + width <= starts[owner + 1] - 1
    order, owner = order[full], owner[full]
    if not len(order):
        return np.zeros((0, 2), np.int64)
    equal = np.ones(len(order) - 1, bool)
    for k in range(width):
        symbols = text[order + k]
        equal &= symbols[1:] == symbols[:-1]
    run = np.concatenate([[0], np.cumsum(~equal)])
    earliest = np.full(run[-1] + 1, np.iinfo(np.int64).max)
    np.minimum.at(earliest, run, order)
    again = order != earliest[run]
    return np.stack([owner[again], order[again] - starts[owner[again]]], axis=1)


def _compare(contexts: DataFrame, length: int, gram: int) -> DataFrame:
    """doc, lo, stop of the ranges covered by repeated windows, many grams to a suffix array."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple] = []
        symbols = 0
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in names)):
                if waiting and row[:3] == waiting[-1][:3]:
                    continue  # a repeated row
                if symbols > BATCH_SYMBOLS and row[0] != waiting[-1][0]:
                    yield ranges(waiting)
                    waiting, symbols = [], 0
                waiting.append(row)
                symbols += len(row[4]) + len(row[5]) + 2
        if waiting:
            yield ranges(waiting)

    def ranges(rows: list[tuple]) -> pa.RecordBatch:
        grams, docs, lo, _, before, behind = zip(*rows)
        found = repeats(grams, before, behind, length - gram + 1)
        found = found[np.lexsort((found[:, 1], found[:, 0]))]
        owner, at = found[:, 0], found[:, 1]
        head = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (at[1:] != at[:-1] + 1)])) if len(owner) else at
        tail = np.append(head[1:] - 1, len(owner) - 1) if len(owner) else at
        base = np.array(lo)[owner[head]]
        return pa.RecordBatch.from_arrays(
            [pa.array(np.array(docs, np.int64)[owner[head]]), pa.array((base + at[head]).astype(np.int32)),
             pa.array((base + at[tail] + length).astype(np.int32))], ["doc", "lo", "stop"])

    names = ["gram", "doc", "lo", "at", "before", "behind"]
    dealt = contexts.repartition("gram").sortWithinPartitions("gram", "doc", "lo")
    return dealt.mapInArrow(run, "doc long, lo int, stop int")


def _whole_windows(contexts: DataFrame, length: int, gram: int) -> DataFrame:
    """The same for grams with very many contexts: each window is a key of its own."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, docs, starts = [], [], []
            for g, doc, lo, x, y in zip(*(batch.column(c).to_pylist() for c in ("gram", "doc", "lo", "before", "behind"))):
                for k in range(len(x) + len(y) - (length - gram) + 1):
                    o = len(x) - k
                    keys.append(hashlib.blake2b(x[k:] + y[: length - gram - o], digest_size=16,
                                                salt=g.to_bytes(8, "little", signed=True) + o.to_bytes(8, "little")).digest())
                    docs.append(doc)
                    starts.append(lo + k)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(docs, pa.int64()), pa.array(starts, pa.int32())],
                                             ["key", "doc", "lo"])

    rows = contexts.mapInArrow(run, "key binary, doc long, lo int")
    first = rows.groupBy("key").agg(F.min(F.struct("doc", "lo")).alias("first"))
    later = rows.join(first, "key").filter(F.struct("doc", "lo") != F.col("first"))
    return later.select("doc", "lo", (F.col("lo") + length).alias("stop"))


def _distinct(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc, doc_id, row, text) of the first of equal texts, and (digest, first) of texts that occur again."""
    keys = rows.select("doc_id", "row", "digest")
    again = keys.groupBy("digest").agg(F.min(F.struct("doc_id", "row")).alias("first"), F.max(F.struct("doc_id", "row")).alias("other"))
    again = written(again.filter(~F.col("first").eqNullSafe(F.col("other"))).select("digest", "first"))
    joined = rows.join(broadcast_if_small(again), "digest", "left")
    kept = joined.filter(F.col("first").isNull() | F.struct("doc_id", "row").eqNullSafe(F.col("first"))).select("doc_id", "row", "text")
    names = kept.select("doc_id", "row").distinct()
    count = names.agg(F.count(F.lit(1)), F.count_distinct("doc_id")).first()
    if count[0] == count[1]:
        return kept.withColumn("doc", F.col("doc_id")), again
    placed = written(with_position(names, ["doc_id", "row"], name="doc"))
    placed = placed.select("doc", F.col("doc_id").alias("_id"), F.col("row").alias("_row"))
    match = kept["doc_id"].eqNullSafe(placed["_id"]) & (kept["row"] == placed["_row"])
    return kept.join(placed, match).select("doc_id", "row", "text", "doc"), again


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM,
                   group_contexts: int = GROUP_CONTEXTS) -> DataFrame:
    """doc_id, n_bytes, spans (array of start and stop of the removed runs), kept (the remaining bytes)."""
    body = texts.text_or_empty(text).cast("binary")
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), texts.row_key(text).alias("row"), body.alias("text"))
    rows = rows.withColumn("digest", F.unhex(F.md5("text")))
    distinct, again = _distinct(rows)
    found = written(_collapse(_anchor_rows(distinct, length, gram), length))
    open_rows = found.filter("gram IS NOT NULL")
    crowded = open_rows.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > group_contexts).select("gram")
    crowded = broadcast_if_small(written(crowded))
    covered = found.filter("gram IS NULL").select("doc", "lo", "stop").unionByName(
        _compare(_contexts(open_rows.join(crowded, "gram", "left_anti"), distinct, gram), length, gram)).unionByName(
        _whole_windows(_contexts(open_rows.join(crowded, "gram", "left_semi"), distinct, gram), length, gram))
    lists = covered.groupBy("doc").agg(F.collect_list(F.struct("lo", "stop")).alias("own"))
    names = distinct.select("doc", F.col("doc_id").alias("_id"), F.col("row").alias("_row")).distinct()
    lists = lists.join(names, "doc").select("_id", "_row", "own")
    marked = rows.join(broadcast_if_small(again), "digest", "left").select(
        "doc_id", "row", "text", (F.col("first").isNotNull() & ~F.struct("doc_id", "row").eqNullSafe(F.col("first"))).alias("copy"))
    both = marked.join(lists, marked["doc_id"].eqNullSafe(lists["_id"]) & (marked["row"] == lists["_row"]), "left")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for k in range(batch.num_rows):
                data = batch.column("text")[k].as_buffer().to_pybytes()
                own = batch.column("own")[k]
                if batch.column("copy")[k].as_py():
                    spans = [(0, len(data))] if len(data) >= length else []
                else:
                    spans = merged(own.values) if own.is_valid else []
                ends = [0, *(x for s in spans for x in s), len(data)]
                out.append((len(data), [{"start": a, "stop": b} for a, b in spans],
                            b"".join(data[a:b] for a, b in zip(ends[::2], ends[1::2]))))
            kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], kind),
                 pa.array([o[2] for o in out], pa.binary())], ["doc_id", "n_bytes", "spans", "kept"])

    def merged(own: pa.StructArray) -> list[tuple[int, int]]:
        lo, stop = (own.field(c).to_numpy() for c in ("lo", "stop"))
        order = np.argsort(lo, kind="stable")
        lo, reach = lo[order], np.maximum.accumulate(stop[order])
        head = np.flatnonzero(np.concatenate([[True], lo[1:] > reach[:-1]]))
        return list(zip(lo[head].tolist(), reach[np.append(head[1:] - 1, len(lo) - 1)].tolist()))

    return both.select("doc_id", "text", "copy", "own").mapInArrow(
        cut, "doc_id long, n_bytes long, spans array<struct<start:int,stop:int>>, kept binary")


def op8(docs: DataFrame) -> DataFrame:
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, s: a + s["stop"] - s["start"])
    return remove_repeats(docs).select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("bigint").alias("n_spans"),
                                       F.sha2("kept", 256).alias("kept_sha256"))
