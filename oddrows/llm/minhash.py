"""Near-duplicate documents by a multi-index Hamming join of b-bit MinHash signatures.

A document's set holds its distinct word shingles. Its signature has `SLOTS` MinHash values of 16 bits
(and `MORE` of 8 bits, which only narrow the candidates down);
two sets of similarity J differ in about (1 - J) of the slots. Signatures within a distance of `radius`
slots are candidates: cut into chunks so that, by the pigeonhole principle, one chunk of such a pair has at most
`ERRORS` differing slots, and each document enters one bucket per chunk and choice of slots left out. So every pair
within the radius meets in a bucket. The radius is set so that a pair at the threshold lies beyond it with a
probability below 1e-6. Candidates are confirmed on the full sets of their whole texts.

Equal sets are one class from the start. In the first rounds each class is held against one leader of its
buckets only: the smallest member of a bucket, then that of another component, whichever has the nearest signature. Buckets
that then still span several components are cut into blocks of bounded size, and block pairs are compared inside
tasks, each pair in the first bucket it shares: first on signatures, then on full sets, and only links that join two components come out,
fewer than a block pair has members. So neither copies nor near copies below the threshold are expanded into
pairs, and no link that joins components is lost.

Defined cases: a text without words has the empty set and no link; a null doc_id takes part, and
is the component id only where all ids are null; rows that share a doc_id belong to each text's class;
repeated rows repeat their result. An empty table gives an empty result; sets are taken from whole texts of any length.
Columns of other names are ignored."""

from __future__ import annotations

import hashlib
import itertools
import math
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oddrows.functions.lineage import written
from oddrows.llm import texts, words
from oddrows.llm.components import components

SLOTS = 64
MORE = 192
ERRORS = 1
MISS = 1e-6
LEADER_ROUNDS = 2
BLOCK_MEMBERS = 1024
BLOCK_BYTES = 32 << 20


def radius_for(percent: int, slots: int = SLOTS, miss: float = MISS) -> int:
    """Smallest distance that a pair at the threshold exceeds with a probability below `miss`."""
    p, beyond = 1 - percent / 100, 1.0
    for d in range(slots + 1):
        beyond -= math.comb(slots, d) * p**d * (1 - p) ** (slots - d)
        if beyond < miss:
            return d
    return slots


def chunk_masks(radius: int, slots: int = SLOTS, errors: int = ERRORS) -> list[tuple[int, ...]]:
    """Slot choices, one bucket key each: chunks with `errors` of their slots left out in turn."""
    count = radius // (errors + 1) + 1  # more chunks than radius / (errors + 1): one has few errors
    cuts = [slots * k // count for k in range(count + 1)]
    chunks = [tuple(range(a, b)) for a, b in zip(cuts[:-1], cuts[1:])]
    return [kept for c in chunks for kept in itertools.combinations(c, max(len(c) - errors, 1))]


def _signature(sets: list[np.ndarray]) -> np.ndarray:
    """`SLOTS` MinHash values of 16 bits and `MORE` of 8 bits as bytes, one row per non-empty set."""
    flat, starts = np.concatenate(sets), np.cumsum([0, *(len(s) for s in sets[:-1])])
    out = np.empty((len(sets), 2 * SLOTS + MORE), np.uint8)
    salts = words.mixed(np.arange(1, 2 * (SLOTS + MORE) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    for k in range(SLOTS + MORE):
        low = words.mixed(np.minimum.reduceat((flat ^ salts[2 * k]) * (salts[2 * k + 1] | np.uint64(1)), starts))
        if k < SLOTS:
            out[:, 2 * k: 2 * k + 2] = (low >> np.uint64(48)).astype("<u2").reshape(-1, 1).view(np.uint8)
        else:
            out[:, SLOTS + k] = (low >> np.uint64(56)).astype(np.uint8)
    return out


def _rows_of(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, 2 * SLOTS + MORE)


def signatures(docs: DataFrame, shingle: int) -> DataFrame:
    """doc_id, row (hash of the text), n_shingles, node and check (two halves of the set's digest), sig; null for an empty set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in words.slices(whole, "text"):
                sets = list(words.shingle_sets(batch.column("text"), shingle))
                full = [s for s in sets if len(s)]
                sigs = iter(_signature(full)) if full else iter(())
                halves = [struct.unpack("<qq", hashlib.blake2b(s.tobytes(), digest_size=16).digest()) if len(s) else (None, None)
                          for s in sets]
                sig = [next(sigs).tobytes() if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("row"), pa.array([len(s) for s in sets], pa.int64()),
                     *(pa.array([h[k] for h in halves], pa.int64()) for k in (0, 1)), pa.array(sig, pa.binary())],
                    ["doc_id", "row", "n_shingles", "node", "check", "sig"])

    source = docs.select("doc_id", texts.row_key("text").alias("row"), "text")
    return source.mapInArrow(run, "doc_id long, row long, n_shingles long, node long, check long, sig binary")


def _buckets(classes: DataFrame, radius: int) -> DataFrame:
    """key, mask, node: the buckets of every class and the slot choice of each."""
    masks = chunk_masks(radius)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 4096):
                batch = whole.slice(at, 4096)
                sig = np.ascontiguousarray(_rows_of(batch.column("sig"))[:, : 2 * SLOTS]).view("<u2").astype(np.uint64)
                keys = np.empty((len(sig), len(masks)), np.uint64)
                for m, mask in enumerate(masks):
                    keys[:, m] = m + 1
                    for slot in mask:
                        keys[:, m] = words.mixed(keys[:, m] * np.uint64(0x9E3779B97F4A7C15) + sig[:, slot] + np.uint64(1))
                nodes = np.repeat(batch.column("node").to_numpy(), len(masks))
                which = np.tile(np.arange(len(masks), dtype=np.int32), len(sig))
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), pa.array(which), pa.array(nodes)], ["key", "mask", "node"])

    return classes.select("node", "sig").mapInArrow(run, "key long, mask int, node long")


def _near(pairs: DataFrame, classes: DataFrame, radius: int, percent: int) -> DataFrame:
    """Pairs (a, b, apart) whose signatures lie within the radius and whose set sizes allow the threshold; `apart` is their
    distance over all slots, for which a radius of its own holds."""
    wide = radius_for(percent, SLOTS + MORE)
    side = lambda x: classes.select(F.col("node").alias(x), F.col("sig").alias(f"sig_{x}"), F.col("n_shingles").alias(f"n_{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").filter(
        100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                differ = _rows_of(batch.column("sig_a")) != _rows_of(batch.column("sig_b"))
                first = (differ[:, 0: 2 * SLOTS: 2] | differ[:, 1: 2 * SLOTS: 2]).sum(axis=1)
                apart = first + differ[:, 2 * SLOTS:].sum(axis=1)
                yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(apart.astype(np.int32))],
                                                 ["a", "b", "apart"]).filter(pa.array((first <= radius) & (apart <= wide)))

    return both.select("a", "b", "sig_a", "sig_b").mapInArrow(run, "a long, b long, apart int")


def _dealt(rows: DataFrame, payload: DataFrame, block: int) -> DataFrame:
    """Members (key, mask, node, root, n_shingles) with the payload of their class, in pairs of blocks of their bucket.

    A bucket is cut into blocks of about `block` members and of `BLOCK_BYTES` of shingles, so a task holds two blocks at most."""
    count = F.greatest(F.ceil(F.count(F.lit(1)) / block), F.ceil(F.sum("n_shingles") * 8 / BLOCK_BYTES)).cast("int")
    sizes = rows.groupBy("key").agg(count.alias("blocks"))
    cut = rows.join(sizes, "key").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).join(payload, "node")
    extra = [c for c in payload.columns if c != "node"]
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "key", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "mask", "own", "node", "root", "n_shingles", *extra)
    return cut.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")


def _block_pairs(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[tuple[bool, int, tuple]]:
    """Whether two blocks meet, the mask of the bucket, and the columns of the members, one block pair at a time."""
    names = ["key", "lo", "hi", "mask", *columns]
    each = (row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in names)))
    for (_, lo, hi), group in itertools.groupby(each, lambda r: r[:3]):
        members = list(zip(*group))
        yield lo != hi, members[3][0], members[4:]


def _candidates(two: bool, mask: int, own: np.ndarray, root: np.ndarray, size: np.ndarray, sig: np.ndarray,
                radius: int, percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each member with those after it that pass the bounds on sizes and signatures, lie in another component at that
    moment and have this bucket as the first that they share."""
    wide, masks = radius_for(percent, SLOTS + MORE), chunk_masks(radius)
    for i in range(len(root) - 1):
        rest = np.arange(i + 1, len(root))
        ok = (root[rest] != root[i]) & (100 * np.minimum(size[rest], size[i]) >= percent * np.maximum(size[rest], size[i]))
        if two:
            ok &= own[rest] != own[i]
        rest = rest[ok]
        if not len(rest):
            continue
        differ = sig[rest] != sig[i]
        slots = differ[:, 0: 2 * SLOTS: 2] | differ[:, 1: 2 * SLOTS: 2]
        first = slots.sum(axis=1)
        near = (first <= radius) & (first + differ[:, 2 * SLOTS:].sum(axis=1) <= wide)
        rest, slots = rest[near], slots[near]
        if len(rest):
            earlier = np.zeros(len(rest), bool)
            for m in masks[:mask]:
                earlier |= ~slots[:, list(m)].any(axis=1)
            rest = rest[~earlier & ~slots[:, list(masks[mask])].any(axis=1)]
        if len(rest):
            yield i, rest


def _linked(two: bool, mask: int, own, node, root, size, sig, sets: list[np.ndarray], radius: int, percent: int) -> tuple[list, list]:
    """Confirmed links between members of a block pair, each of which joins two components: fewer than there are members."""
    ends = np.cumsum([0, *map(len, sets)])
    ids = np.unique(np.concatenate(sets), return_inverse=True)[1]  # shingles numbered within the block pair
    here = np.zeros(int(ids.max(initial=-1)) + 1, bool)
    a, b = [], []
    for i, rest in _candidates(two, mask, own, root, size, sig, radius, percent):
        here[ids[ends[i]: ends[i + 1]]] = True
        for j in rest.tolist():
            if root[i] != root[j]:
                common = int(here[ids[ends[j]: ends[j + 1]]].sum())
                if 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                    root[root == root[j]] = root[i]
                    a.append(min(node[i], node[j]))
                    b.append(max(node[i], node[j]))
        here[ids[ends[i]: ends[i + 1]]] = False
    return a, b


def _across(here: DataFrame, classes: DataFrame, docs: DataFrame, radius: int, shingle: int, percent: int, block: int) -> DataFrame:
    """Links (a, b) that join the components of members of one bucket, confirmed on full sets where the pair is found.

    The first pass compares signatures and only says which members have a candidate in which bucket; the sets of
    those alone then go to the blocks. Pairs that are not confirmed cost time but never become rows."""
    bare = _dealt(here.join(classes.select("node", "n_shingles"), "node"), classes.select("node", "sig"), block)

    def flag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for two, mask, (key, node, root, size, own, sigs) in _block_pairs(batches, ["key", "node", "root", "n_shingles", "own", "sig"]):
            found = np.zeros(len(node), bool)
            sig = np.frombuffer(b"".join(sigs), np.uint8).reshape(len(node), -1)
            for i, rest in _candidates(two, mask, np.array(own), np.array(root), np.array(size), sig, radius, percent):
                found[i] = True
                found[rest] = True
            if found.any():
                nodes = np.array(node, np.int64)[found]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(nodes), key[0], np.int64)), pa.array(nodes)], ["key", "node"])

    flagged = written(bare.mapInArrow(flag, "key long, node long").distinct())
    sets = written(_sets(flagged.select("node").distinct(), classes, docs, shingle))
    rows = here.join(flagged, ["key", "node"]).join(classes.select("node", "n_shingles"), "node")
    full = _dealt(rows, classes.select("node", "sig").join(sets, "node"), block)

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for two, mask, (node, root, size, own, sigs, packed) in _block_pairs(batches, ["node", "root", "n_shingles", "own", "sig", "shingles"]):
            a, b = _linked(two, mask, np.array(own), node, np.array(root), np.array(size),
                           np.frombuffer(b"".join(sigs), np.uint8).reshape(len(node), -1), [np.frombuffer(p, np.uint64) for p in packed],
                           radius, percent)
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return full.mapInArrow(confirm, "a long, b long")


def _texts_of(nodes: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """node, text: the text of one row of each wanted class."""
    rows = classes.join(nodes, "node").select("node", F.col("rep.doc_id").alias("_id"), F.col("rep.row").alias("_row"))
    keyed = docs.select("doc_id", texts.row_key("text").alias("row"), "text")
    found = keyed.join(rows, keyed["doc_id"].eqNullSafe(rows["_id"]) & (keyed["row"] == rows["_row"]))
    return found.groupBy("node").agg(F.first("text").alias("text"))


def _sets(nodes: DataFrame, classes: DataFrame, docs: DataFrame, shingle: int) -> DataFrame:
    """node, shingles: the full set of each wanted class as packed 64-bit hashes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in words.slices(whole, "text"):
                packed = [s.tobytes() for s in words.shingle_sets(batch.column("text"), shingle)]
                yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(packed, pa.binary())], ["node", "shingles"])

    return _texts_of(nodes, classes, docs).mapInArrow(run, "node long, shingles binary")


def _confirmed(pairs: DataFrame, classes: DataFrame, docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The pairs whose full sets reach the threshold, from the texts of one row per class."""
    wanted = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    found = written(_texts_of(wanted, classes, docs))
    side = lambda x: found.select(F.col("node").alias(x), F.col("text").alias(f"text_{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "text_a", "text_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in words.slices(whole, "text_a"):
                keep = []
                for x, y in zip(words.shingle_sets(batch.column("text_a"), shingle),
                                words.shingle_sets(batch.column("text_b"), shingle)):
                    common = len(np.intersect1d(x, y, assume_unique=True))
                    keep.append(100 * common >= percent * (len(x) + len(y) - common))
                yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(run, "a long, b long")


def _told_apart(rows: DataFrame) -> DataFrame:
    """Classes are named by 64 bits of a set's digest; where different sets share them (the other 64 bits differ), all but one get another name."""
    while True:
        shared = written(rows.groupBy("node").agg(F.min("check").alias("_least"), F.max("check").alias("_most")).filter(
            "_least <> _most").select(F.col("node").alias("_node"), "_least"))
        if shared.isEmpty():
            return rows
        name = F.when(F.col("check") > F.col("_least"), F.xxhash64("node", "check")).otherwise(F.col("node"))
        rows = written(rows.join(shared, F.col("node") == F.col("_node"), "left").withColumn("node", name).drop("_node", "_least"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 5,
                    percent: int = 80, leader_rounds: int = LEADER_ROUNDS, block_members: int = BLOCK_MEMBERS) -> DataFrame:
    """doc_id, row, n_shingles, component_id (smallest doc_id reachable), kept, one row per row of docs."""
    docs = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    radius = radius_for(percent)
    all_rows = written(signatures(docs, shingle))
    all_rows = _told_apart(all_rows)
    classes = written(all_rows.filter("node IS NOT NULL").groupBy("node").agg(
        F.min(F.struct("doc_id", "row")).alias("rep"), F.min("doc_id").alias("id"),
        F.first("sig").alias("sig"), F.first("n_shingles").alias("n_shingles")))

    keys = _buckets(classes, radius)
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    members = written(keys.join(shared.select("key"), "key"))
    links, tried, roots = None, None, None

    def spread(parts: DataFrame) -> DataFrame:
        """Members of buckets that still span several components, with their component."""
        here = members.join(parts, "node", "left").withColumn("root", F.coalesce("root", "node")) if parts is not None \
            else members.withColumn("root", F.col("node"))
        open_keys = here.groupBy("key").agg(F.min("root").alias("_low"), F.max("root").alias("_high"))
        return here.join(open_keys.filter("_low <> _high").select("key"), "key")

    for k in range(leader_rounds + 1):
        here = written(spread(roots))
        if here.isEmpty():
            break
        if k < leader_rounds:  # each member against its bucket's leader: the smallest, then that of the largest component name
            lead = here.groupBy("key").agg((F.min_by if k == 0 else F.max_by)(
                F.struct("node", "root"), F.struct("root", "node")).alias("l"))
            pairs = here.join(lead, "key").filter("root <> l.root").select(F.col("node").alias("a"), F.col("l.node").alias("b"))
        else:
            sure = written(_across(here, classes, docs, radius, shingle, percent, block_members))
            links = sure if links is None else links.unionByName(sure)
            roots = components(links)
            break
        pairs = pairs.distinct()
        if tried is not None:
            both = tried.unionByName(tried.select(F.col("b").alias("a"), F.col("a").alias("b")))
            pairs = pairs.join(both, ["a", "b"], "left_anti")
        near = _near(pairs, classes, radius, percent)  # the nearest leader of each class
        near = near.groupBy("a").agg(F.min(F.struct("apart", "b")).alias("l")).select("a", F.col("l.b").alias("b"))
        near = written(near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
        tried = near if tried is None else tried.unionByName(near)
        sure = written(_confirmed(near, classes, docs, shingle, percent))
        links = sure if links is None else links.unionByName(sure)
        roots = components(links)
    named = classes.select("node", "id")
    if roots is not None:
        rooted = classes.select("node", "id").join(roots, "node")
        least = rooted.groupBy("root").agg(F.min("id").alias("least"))
        inside = rooted.join(least, "root").select("node", "least")
        named = named.join(inside, "node", "left").select("node", F.coalesce("least", "id").alias("id"))
    out = all_rows.join(named, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("id"))
    return out.select("doc_id", "row", "n_shingles", component.alias("component_id"),
                      F.col("doc_id").eqNullSafe(component).alias("kept"))


def op3(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs, shingle=3, percent=85).drop("row")
