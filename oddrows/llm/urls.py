"""URL filter: path rules first, then a listed-host test by a cascade of Bloom filters.

Level 1 encodes the listed keys. The unlisted keys of the universe that level 1 lets through are
encoded by level 2, the listed keys that level 2 lets through by level 3, and so on until nothing is
let through. Because the cascade is built against every key of the corpus, a look-up in it is exact
for every row: the first level that says no gives the answer, and no join is needed.

Filters are sent to every task. Their size is bounded: beyond `shard_keys` listed keys the universe is
cut by hash into shards, each with a cascade of its own, and each shard's rows are judged in a pass
of their own. Bits are set in the tasks and combined by Spark; keys never come to the driver.

Defined cases: a null url, or one without `://`, has an empty host and path, fits no rule and is not
listed; repeated rows are judged alike; a rule's host fits that host and all its subdomains. An empty table gives an empty result; urls of any length are judged whole.
Columns of other names are ignored."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oddrows.functions.lineage import written

#: fixed values of the query: (verdict, rule); a rule is a host and a path prefix
RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
         ("block", "net/es/"), ("block", "net/fr/")]
SHARD_KEYS = 20_000_000
MAX_LEVELS = 500
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    text = F.coalesce(url.cast("string"), F.lit(""))
    at = F.instr(text, "://")
    rest = F.when(at > 0, F.substring(text, at + 3, F.length(text))).otherwise("")
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def match_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """Longest fitting rule and its verdict, null where none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, text in sorted(rules, key=lambda r: len(r[1])):
        name, slash, rest = text.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit(slash + rest))
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return rule, verdict


def _hashes(key: Column) -> list[Column]:
    # the constant comes first: as a seed of the key's hash it makes the two independent
    return [F.xxhash64(key).alias("_a"), F.xxhash64(F.lit(1), key).alias("_b")]


def _mixed(x: np.ndarray, salt: int) -> np.ndarray:
    x = x.astype(np.uint64) + np.uint64((salt * 0x9E3779B97F4A7C15) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _places(a: np.ndarray, b: np.ndarray, level: int, bits: int, probes: int) -> np.ndarray:
    """Bit numbers of each key at a level, one row per probe."""
    x, y = _mixed(a, level), _mixed(b, level) | np.uint64(1)
    return np.stack([(x + np.uint64(i) * y) % np.uint64(bits) for i in range(probes)])


def _pair(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    read = lambda n: batch.column(n).to_numpy(zero_copy_only=False).view(np.uint64)
    return read("_a"), read("_b")


def _inside(words: np.ndarray, places: np.ndarray) -> np.ndarray:
    found = (words[places >> np.uint64(6)] >> (places & np.uint64(63))) & np.uint64(1)
    return found.all(axis=0)


def _filter_of(keys: DataFrame, level: int, bits: int, probes: int) -> np.ndarray:
    """The filter's words; tasks set bits, Spark combines them, the driver gets bits / 64 numbers."""
    def set_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = _places(*_pair(batch), level, bits, probes).ravel()
            at, back = np.unique(places >> np.uint64(6), return_inverse=True)
            words = np.zeros(len(at), np.uint64)
            np.bitwise_or.at(words, back, np.uint64(1) << (places & np.uint64(63)))
            yield pa.RecordBatch.from_arrays([pa.array(at.view(np.int64)), pa.array(words.view(np.int64))], ["_at", "_word"])

    parts = keys.select("_a", "_b").mapInArrow(set_bits, "_at long, _word long")
    got = parts.groupBy("_at").agg(F.bit_or("_word").alias("_word")).toArrow()
    words = np.zeros(-(-bits // 64), np.uint64)
    words[got.column("_at").to_numpy()] = got.column("_word").to_numpy().view(np.uint64)
    return words


def _let_through(keys: DataFrame, level: int, bits: int, probes: int, words: np.ndarray) -> DataFrame:
    sent = keys.sparkSession.sparkContext.broadcast(words)

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_inside(sent.value, _places(*_pair(batch), level, bits, probes))))

    return keys.mapInArrow(test, keys.schema)


def build_cascade(keys: DataFrame) -> list[tuple[int, int, np.ndarray]]:
    """(bits, probes, words) of each level for keys (_a, _b, _listed), which must be distinct."""
    inside, outside = keys.filter("_listed").drop("_listed"), keys.filter("NOT _listed").drop("_listed")
    n_in, n_out = inside.count(), outside.count()
    levels: list[tuple[int, int, np.ndarray]] = []
    while n_in:
        if len(levels) == MAX_LEVELS:
            raise ValueError("a listed and an unlisted key share both hashes")
        rate = 0.5 if levels else min(0.5, math.sqrt(0.5) * n_in / max(n_out, 1))
        bits = max(64, math.ceil(n_in * math.log2(1 / rate) / math.log(2)))
        level = len(levels) + 1, bits, max(1, round(math.log2(1 / rate)))
        words = _filter_of(inside, *level)
        levels.append((level[1], level[2], words))
        through = written(_let_through(outside, *level, words))
        inside, outside, n_in, n_out = through, inside, through.count(), n_in
    return levels


def in_cascade(rows: DataFrame, levels: list[tuple[int, int, np.ndarray]], name: str = "listed") -> DataFrame:
    """Replace _a, _b by a boolean: is the row's key listed."""
    sent = rows.sparkSession.sparkContext.broadcast(levels)
    kept = [c for c in rows.columns if c not in ("_a", "_b")]

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = _pair(batch)
            listed, left = np.zeros(len(a), bool), np.arange(len(a))
            for k, (bits, probes, words) in enumerate(sent.value):
                yes = _inside(words, _places(a[left], b[left], k + 1, bits, probes))
                listed[left[~yes]] = k % 2 == 1
                left = left[yes]
            listed[left] = len(sent.value) % 2 == 1
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(listed)], [*kept, name])

    schema = rows.select(*kept, F.lit(True).alias(name)).schema
    return rows.mapInArrow(look_up, schema)


def listed_rows(rows: DataFrame, key: str, listed: DataFrame, shard_keys: int = SHARD_KEYS) -> DataFrame:
    """Add `listed`: is the row's key in the one-column table `listed`. The universe is all keys of rows."""
    names = listed.select(F.col(listed.columns[0]).alias("_key")).distinct().withColumn("_listed", F.lit(True))
    universe = rows.select(F.col(key).alias("_key")).distinct().withColumn("_listed", F.lit(False))
    marked = names.unionByName(universe).groupBy("_key").agg(F.max("_listed").alias("_listed"))
    shard = lambda k, n: F.pmod(F.xxhash64(F.lit(2), F.col(k)), F.lit(n))
    keys = written(marked.select(*_hashes(F.col("_key")), "_listed", F.xxhash64(F.lit(2), F.col("_key")).alias("_cut")))
    count = max(1, -(-keys.filter("_listed").count() // shard_keys))
    judged = None
    for s in range(count):
        levels = build_cascade(keys.filter(F.pmod("_cut", F.lit(count)) == s).drop("_cut"))
        part = rows.filter(shard(key, count) == s) if count > 1 else rows
        part = in_cascade(part.select("*", *_hashes(F.col(key))), levels)
        judged = part if judged is None else judged.unionByName(part)
    return judged


def op7(pages: DataFrame) -> DataFrame:
    """Verdicts of all pages; the list holds the hosts of which a block rule hits some url."""
    host, path = host_and_path(F.col("url"))
    urls = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = match_rule(F.col("host"), F.col("path"), RULES)
    urls = urls.select("*", rule.alias("rule"), verdict.alias("_says"))
    judged = listed_rows(urls, "host", urls.filter("_says = 'block'").select("host"))
    return judged.select("page_id", "host", "path", "rule", F.coalesce(
        "_says", F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"), "listed")


OP7_SQL = """
WITH rules(says, rule, host, path) AS (VALUES
  ('allow', 'com/', 'com', '/'), ('block', 'example.com/en/', 'example.com', '/en/'),
  ('allow', 'www.example.com/en/', 'www.example.com', '/en/'), ('block', 'net/es/', 'net', '/es/'),
  ('block', 'net/fr/', 'net', '/fr/')),
rest AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r FROM pages),
urls AS (
  SELECT page_id, translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
matched AS (
  SELECT u.*, r.rule, r.says FROM urls u LEFT JOIN rules r
    ON (u.host = r.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path)
  QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(r.rule) DESC NULLS LAST) = 1),
listed AS (SELECT DISTINCT host FROM matched WHERE says = 'block')
SELECT page_id, host, path, rule, coalesce(says, CASE WHEN host IN (FROM listed) THEN 'block' ELSE 'allow' END) AS verdict,
  host IN (FROM listed) AS listed
FROM matched
"""
