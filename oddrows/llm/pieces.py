"""SentencePiece encoding and decoding for merge-type vocabularies.

A text is normalised by the model's own rules, cut where no piece of the vocabulary can reach across
(before a space mark that follows another character, and around characters that only stand alone), and
each part is merged by an agenda of adjacent symbol pairs: the pair whose joined piece has the
best score goes first, the leftmost among equals. What is no piece falls back to its bytes.
Parts repeat, so each Python worker keeps the first `cache_size` parts it has encoded.

Every part that is encoded is also encoded by the sentencepiece library, all new parts of an Arrow
batch in one call, and a difference stops the job. The model is read on the driver from the given
path and sent along; it is half a megabyte.

Defined cases: a null text is empty and gives the end id alone; repeated rows give repeated rows;
memory is bounded by the longest text and the cache. Models with user-defined symbols are not supported.
An empty table gives an empty result.
Columns of other names are ignored."""

from __future__ import annotations

import heapq
import operator
import re
import sys
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CACHE_SIZE = 600_000
MARK = "▁"


class Vocabulary:
    """Pieces, scores and kinds of a model, and what follows from them."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.library = sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        size = sp.get_piece_size()
        self.pieces = [sp.id_to_piece(i) for i in range(size)]
        self.bytes = {int(p[3:5], 16): i for i, p in enumerate(self.pieces) if sp.is_byte(i)}
        self.unknown = sp.unk_id()
        plain = [i for i in range(size) if not (sp.is_control(i) or sp.is_byte(i) or i == self.unknown)]
        self.unused = {self.pieces[i] for i in plain if sp.is_unused(i)}
        self.ids = {self.pieces[i]: i for i in plain}
        self.costs = {self.pieces[i]: -sp.get_score(i) for i in plain}
        self.spelled = [bytes([int(p[3:5], 16)]) if sp.is_byte(i) else b"" if sp.is_control(i) else
                        " ⁇ ".encode() if i == self.unknown else p.replace(MARK, " ").encode()
                        for i, p in enumerate(self.pieces)]
        self.end = sp.eos_id()
        joined = [p for p in self.ids if len(p) > 1]
        inner = any(MARK in p.lstrip(MARK) for p in joined)  # a mark after another character
        alone = "".join(c for c in "\n" if not any(c in p for p in joined))
        self.alone = alone
        only = re.escape(alone)
        self.part = re.compile(f"[{only}]|{MARK}*[^{MARK}{only}]+|{MARK}+" if alone else f"{MARK}*[^{MARK}]+|{MARK}+") \
            if not inner else re.compile("(?s).+")


def merge(part: str, v: Vocabulary) -> list[int]:
    """Ids of one part: adjacent symbols joined in the order of the agenda (best score, then leftmost)."""
    symbols: list[str] = list(part)
    last = len(symbols) - 1
    before, after = list(range(-1, last)), [*range(1, last + 1), -1]
    cost, push, pop = v.costs.get, heapq.heappush, heapq.heappop
    agenda = [(c, k, k + 1, pair) for k, pair in enumerate(map(operator.add, symbols, symbols[1:]))
              if (c := cost(pair)) is not None]
    heapq.heapify(agenda)
    taken_apart: dict[str, tuple[str, str]] = {}
    while agenda:
        _, left, right, joined = pop(agenda)
        one, two = symbols[left], symbols[right]
        if not one or not two or len(one) + len(two) != len(joined):
            continue  # one of the two has been joined with another symbol meanwhile
        if joined in v.unused:
            taken_apart[joined] = (one, two)
        symbols[left], symbols[right] = joined, ""
        far = after[left] = after[right]
        if far >= 0:
            before[far] = left
            pair = joined + symbols[far]
            if (c := cost(pair)) is not None:
                push(agenda, (c, left, far, pair))
        near = before[left]
        if near >= 0:
            pair = symbols[near] + joined
            if (c := cost(pair)) is not None:
                push(agenda, (c, near, left, pair))
    left = [s for s in symbols if s]
    try:
        if not v.unused:
            return [v.ids[s] for s in left]
    except KeyError:
        pass
    ids: list[int] = []

    def put(symbol: str) -> None:
        if symbol in taken_apart:
            for half in taken_apart[symbol]:
                put(half)
        elif symbol in v.ids:
            ids.append(v.ids[symbol])
        elif v.bytes:
            ids.extend(v.bytes[b] for b in symbol.encode())
        else:
            ids.append(v.unknown)

    for s in left:
        put(s)
    return ids


def decode(ids: list[int], v: Vocabulary) -> str:
    """Text of ids: pieces with marks as blanks, byte pieces as the bytes they name, without the
    blank that encoding puts in front."""
    text = b"".join([v.spelled[i] for i in ids]).decode("utf-8", "replace")
    return text[1:] if text[:1] == " " else text


def _library_ids(parts: list[str], v: Vocabulary) -> list[list[int]]:
    """The library's ids of parts. It puts a mark before every text: parts with one are given
    without it, others behind a character that stands alone, whose ids are then taken off."""
    lead = v.alone[:1]
    marked = [p[0] == MARK and p != MARK for p in parts]
    texts = [(p[1:] if m else lead + p).replace(MARK, " ") for p, m in zip(parts, marked)]
    found = v.library.encode(texts, num_threads=1)
    cut = len(v.library.encode(lead)) if lead else 0
    return [ids if m else ids[cut:] for m, ids in zip(marked, found)]


def coder(v: Vocabulary, known: dict[str, bytes], check: bool = True,
          cache_size: int = CACHE_SIZE) -> Callable[[list[str]], list[tuple[bytes, str]]]:
    """A function from texts to (ids as int32 bytes with the end id, decoded text). `known` keeps the
    ids of parts seen before."""
    end = array("i", [v.end]).tobytes()

    def code(texts: list[str]) -> list[tuple[bytes, str]]:
        fresh: dict[str, list[int]] = {}
        spare: dict[str, bytes] = {}  # parts of this batch that `known` has no room for
        out: list[tuple[bytes, str]] = []
        for t in texts:
            parts = v.part.findall(v.library.normalize(t)) if t else []
            found = list(map(known.get, parts))
            if None in found:
                for k, p in enumerate(parts):
                    if found[k] is None:
                        ids = known.get(p) or spare.get(p)
                        if ids is None:
                            fresh[p] = merge(p, v)
                            ids = array("i", fresh[p]).tobytes()
                            (known if len(known) < cache_size else spare)[p] = ids
                        found[k] = ids
            ids = b"".join(found)
            out.append((ids + end, decode(memoryview(ids).cast("i").tolist(), v)))
        tried = [p for p in fresh if v.alone or (p[0] == MARK and p != MARK)] if check else []
        for p, ids in zip(tried, _library_ids(tried, v)):
            if ids != fresh[p]:
                raise ValueError(f"the library encodes {p!r} as {ids}, the agenda as {fresh[p]}")
        return out

    return code


def _worker_cache(model: bytes) -> dict[str, bytes]:
    """Parts this Python worker has encoded with the model, in earlier tasks as well."""
    return vars(sys).setdefault("_oddrows_parts", {}).setdefault(hash(model), {})


def encode_texts(docs: DataFrame, model_path: str, doc_id: str = "doc_id", text: str = "text", check: bool = True,
                 cache_size: int = CACHE_SIZE, batch_chars: int = 2_000_000) -> DataFrame:
    """doc_id, ids (array<int>, end id last), decoded: one row per row of docs."""
    with open(model_path, "rb") as f:
        model = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = None
        for batch in batches:
            code = code or coder(Vocabulary(model.value), _worker_cache(model.value), check, cache_size)
            column, start = batch.column("text"), 0
            sizes = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False))
            while start < len(column):
                base = sizes[start - 1] if start else 0
                stop = max(start + 1, int(np.searchsorted(sizes, base + batch_chars, "right")))
                coded = code([t or "" for t in column.slice(start, stop - start).to_pylist()])
                flat = np.frombuffer(b"".join([c[0] for c in coded]), np.int32)
                ends = np.cumsum([0, *(len(c[0]) // 4 for c in coded)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(start, stop - start),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)), pa.array([c[1] for c in coded], pa.string())],
                    ["doc_id", "ids", "decoded"])
                start = stop

    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, ids array<int>, decoded string")


def digests(coded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of coded rows."""
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return coded.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
                        F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op9(docs: DataFrame, model_path: str | None = None) -> DataFrame:
    return digests(encode_texts(docs, model_path or default_model()))
