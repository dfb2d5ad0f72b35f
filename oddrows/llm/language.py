"""Language of a text by the nearest of several centroids per language.

A text becomes a vector of its letter n-grams (one to three characters of lower-cased words with a
blank on either side), hashed to `DIMS` cells: term frequency as 1 + log(count), times the inverse document
frequency, scaled to length one. Document frequencies are counted over all training rows. The centroids of a language come
from spherical k-means over a sample of its training rows, about `sample_rows` of them drawn by a hash of the
key (a documented bound; counts and predictions cover all rows). A text gets the language of the centroid with the
largest cosine, which is also its score; further away than `reject_below` it is marked as rejected.

Defined cases: a null text, or one without a letter, is `und` with score 0 and rejected; rows without a language are not
learned from; without any training row every text is `und`; of equal cosines the first language in
order of name wins; repeated rows get the same answer. An empty table gives an empty result; texts of any length are counted whole.
Columns of other names are ignored."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oddrows.llm import words

DIMS = 8192
CENTROIDS = 4
ROUNDS = 12
SAMPLE_ROWS = 1500
REJECT_BELOW = 0.15
UNKNOWN = "und"
_BLANK = np.uint32(32)


def _letters(points: np.ndarray, table: list[np.ndarray]) -> np.ndarray:
    """Which code points are letters; `table` keeps the answers for the common ones."""
    if not table:
        table.append(np.array([chr(c).isalpha() for c in range(0x3000)]))
    if points.max() < 0x3000:
        return table[0][points]
    kinds = np.unique(points)
    return np.isin(points, kinds[[chr(int(c)).isalpha() for c in kinds]])


_TABLE: list[np.ndarray] = []


def _folded(text: str) -> np.ndarray:
    """Code points of lower-cased letters; every run of other characters is one blank."""
    low = text.lower()
    points = np.frombuffer(low.encode("utf-32-le", "replace"), np.uint32)
    if not len(points):
        return points
    is_letter = _letters(points, _TABLE)
    if not is_letter.any():
        return points[:0]
    folded = np.where(is_letter, points, _BLANK)
    keep = is_letter | np.concatenate([[True], is_letter[:-1]])
    return np.concatenate([[_BLANK], folded[keep], [_BLANK]])


def _counts(text: str | None) -> np.ndarray | None:
    """Counts per cell of the n-grams of a text, or None without a letter."""
    points = _folded(text) if text else np.zeros(0, np.uint32)
    if not len(points):
        return None
    x = points.astype(np.uint64)
    grams = [x]
    for n in (2, 3):
        if len(x) >= n:
            rolled = np.zeros(len(x) - n + 1, np.uint64)
            for k in range(n):
                rolled = rolled * np.uint64(0x110000) + x[k: len(x) - n + 1 + k]
            grams.append(rolled + np.uint64(n) * np.uint64(1 << 62 >> 1))
    cells = words.mixed(np.concatenate(grams)) % np.uint64(DIMS)
    return np.bincount(cells.astype(np.int64), minlength=DIMS)


def _vector(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = np.where(counts > 0, 1 + np.log(np.maximum(counts, 1)), 0.0) * idf
    size = math.sqrt(float(v @ v))
    return (v / size if size else v).astype(np.float32)


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        yield from words.slices(whole, "text", 1 << 20)


def document_frequency(train: DataFrame) -> tuple[np.ndarray, int]:
    """Rows that hold each cell, and all rows with a letter, over the whole table."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(DIMS, np.int64), 0
        for batch in _texts(batches):
            for text in batch.column("text").to_pylist():
                own = _counts(text)
                if own is not None:
                    total += own > 0
                    rows += 1
        cells = np.append(np.arange(DIMS), DIMS)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(np.append(total, rows))], ["cell", "n"])

    summed = train.select("text").mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(DIMS + 1, np.int64)
    out[summed.column("cell").to_numpy()] = summed.column("n").to_numpy()
    return out[:DIMS], int(out[DIMS])


def fit(train: DataFrame, sample_rows: int = SAMPLE_ROWS, centroids: int = CENTROIDS, rounds: int = ROUNDS) -> dict:
    """Model from train (key, text, lang): idf and, per language in order of name, its centroids."""
    held, rows = document_frequency(train)
    idf = np.log((1 + rows) / (1 + held)) + 1
    sizes = {r.lang: r["count"] for r in train.groupBy("lang").count().collect()}
    if not sizes:
        return {"idf": idf, "langs": [], "centres": np.zeros((0, DIMS), np.float32)}
    share = F.lit(None).cast("double")
    for lang, n in sizes.items():
        share = F.when(F.col("lang") == lang, min(1.0, sample_rows / n)).otherwise(share)
    place = F.pmod(F.xxhash64("key", F.lit(11)), F.lit(1 << 20)) / float(1 << 20)
    sample = train.filter(place < share)
    sent = train.sparkSession.sparkContext.broadcast(idf)

    def cluster(rows_of: pd.DataFrame) -> pd.DataFrame:
        rows_of = rows_of.sort_values("key", kind="stable")
        counted = [c for c in map(_counts, rows_of["text"]) if c is not None]
        if not counted:
            return pd.DataFrame({"lang": [], "number": [], "centre": []})
        x = np.stack([_vector(c, sent.value) for c in counted])
        centre = _spherical(x, min(centroids, len(x)), rounds)
        return pd.DataFrame({"lang": rows_of["lang"].iloc[0], "number": range(len(centre)), "centre": list(centre)})

    found = sample.groupBy("lang").applyInPandas(cluster, "lang string, number int, centre array<float>")
    got = found.orderBy("lang", "number").collect()
    return {"idf": idf, "langs": [r.lang for r in got],
            "centres": np.array([r.centre for r in got], np.float32).reshape(len(got), DIMS)}


def _spherical(x: np.ndarray, k: int, rounds: int) -> np.ndarray:
    """k-means by cosine, started from the row nearest the mean and then the rows furthest from those chosen."""
    mean = x.mean(axis=0)
    chosen = [int(np.argmax(x @ mean))]
    while len(chosen) < k:
        chosen.append(int(np.argmin((x @ x[chosen].T).max(axis=1))))
    centre = x[chosen].copy()
    for _ in range(rounds):
        own = np.argmax(x @ centre.T, axis=1)
        for c in range(k):
            total = x[own == c].sum(axis=0)
            size = np.linalg.norm(total)
            if size:
                centre[c] = total / size
    return centre


def predict(docs: DataFrame, model: dict, reject_below: float = REJECT_BELOW) -> DataFrame:
    """Add lang_pred, score and rejected to docs (key columns and text); the text is dropped."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in docs.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, centres, idf = sent.value["langs"], sent.value["centres"], sent.value["idf"]
        for batch in _texts(batches):
            lang, score = [], []
            for text in batch.column("text").to_pylist():
                counts = _counts(text) if langs else None
                if counts is None:
                    lang.append(UNKNOWN)
                    score.append(0.0)
                else:
                    cosine = centres @ _vector(counts, idf)
                    best = int(np.argmax(cosine))
                    lang.append(langs[best])
                    score.append(float(min(max(cosine[best], 0.0), 1.0)))
            rejected = [s < reject_below for s in score]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())],
                [*kept, "lang_pred", "score", "rejected"])

    schema = docs.select(*kept, F.lit("").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(False).alias("rejected")).schema
    return docs.mapInArrow(run, schema)


def identify(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
             sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected. Rows whose crc32(doc_id) mod 4 is 2 are held out."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"), F.col(lang).alias("lang"))
    held = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))
    train = rows.filter(~held & F.col("lang").isNotNull() & F.col("text").isNotNull()).select(
        F.col("doc_id").cast("string").alias("key"), "text", "lang")
    model = fit(train, sample_rows)
    return predict(rows.select("doc_id", held.alias("held_out"), "text"), model)


def op10(docs: DataFrame) -> DataFrame:
    return identify(docs)
