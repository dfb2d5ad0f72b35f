"""WARC archives: a writer and a splittable reader.

Writer: one gzip member per record. Of records with equal payloads the one with the smallest page_id is
a response, the others are revisit records that refer to it. Spark's text writer ends each row
with one byte; members end with a zero byte (the top byte of their length), so that byte is left
to the writer and the files are plain concatenated members. Longer records get an empty member behind.

Reader: Spark deals out byte ranges of the files and its line reader finds the gzip magic, used as
the line separator; a range owns the pieces that start inside it. A piece is a candidate member: its
header must decode to a WARC version line. Other pieces belong to the member before them,
whose compressed bytes happened to hold the magic. Members that such a magic and the end of a range cut are
put together afterwards from the few pieces left over. The line reader would unpack files named *.gz before it
sees the magic, so for this read another codec with a longer ending (.!.gz) hides the one of .gz: Hadoop compares
a name only with the last ending that sorts before it. A file that is unpacked all the same stops the job.

Defined cases: null html is an empty payload, a null url an empty one, a null page_id is written as such and
is the response only if its group has no other id; rows that share the smallest page_id of a group are all
responses; repeated rows are repeated records; bytes that are no WARC/1 record (damaged or cut members, other
versions, anything between members but zeros) stop the job, or with undecoded="skip" are left out;
undecoded_members lists them. Empty members are no records and no damage. An empty table makes archives without records; a payload of any size is one member.
Columns of other names are ignored."""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections import deque
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from oddrows.functions.lineage import shared_folder
from oddrows.functions.sizes import broadcast_if_small

MAGIC = b"\x1f\x8b\x08"
HEAD = b"WARC/1."
#: hides the codec of .gz from the line reader; the second key is the one of Spark's shaded Hadoop client
NOT_UNPACKED = {"io.compression.codecs": "org.apache.hadoop.io.compress.PassthroughCodec",
                "io.compress.passthrough.extension": ".!.gz",
                "org.apache.hadoop.shaded.io.compress.passthrough.extension": ".!.gz"}
_UNPACKED_NAME = re.compile(r"(?i)\.(gz|bz2|deflate|snappy|lz4|zst)$")
DATE = "1970-01-01T00:00:00Z"
_URN = "urn:x-page:"


def _gzip(data: bytes) -> bytes:
    """A member, or two, whose last byte is zero."""
    def pack(part: bytes) -> bytes:
        z = zlib.compressobj(6, zlib.DEFLATED, 31)
        return z.compress(part) + z.flush()
    packed = pack(data)
    return packed if packed[-1] == 0 else packed + pack(b"")


def record(page_id: int | None, url: str, payload: bytes, sha1_hex: str, refers_to: int | None, date: str = DATE) -> bytes:
    """One WARC record, not compressed."""
    kind = "response" if refers_to is None else "revisit"
    http = ("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = http + payload if refers_to is None else http
    uri = re.sub("[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
    head = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{_URN}{page_id}>", f"WARC-Date: {date}",
        f"WARC-Target-URI: {uri}", f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(sha1_hex)).decode()}",
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        head += [f"WARC-Refers-To: <{_URN}{refers_to}>",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write_warc(pages: DataFrame, path: str, min_bytes: int = 0, date: str = DATE) -> None:
    """Write pages (page_id, url, html) as archives under `path`."""
    body = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"),
                        body.alias("payload"), F.sha1(body).alias("sha1"))
    # the sketch of a group is its digest, size and smallest id; payloads are not moved for it
    groups = rows.filter(F.octet_length("payload") >= min_bytes).groupBy("sha1").agg(
        F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    groups = broadcast_if_small(groups.filter("n > 1 AND first IS NOT NULL").select(F.col("sha1").alias("of"), "first"))
    linked = rows.join(groups, rows["sha1"] == groups["of"], "left").select(
        "page_id", "url", "payload", "sha1",
        F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                members = [_gzip(record(**r, date=date)) for r in _arguments(whole.slice(at, 256))]
                yield pa.RecordBatch.from_arrays([pa.array([m[:-1] for m in members], pa.binary())], ["member"])

    members = linked.mapInArrow(pack, "member binary")
    members.select(F.col("member").cast("string").alias("value")).write.option("lineSep", "\0").text(path)


def _arguments(batch: pa.RecordBatch) -> list[dict]:
    rows = batch.to_pylist()
    for r in rows:
        r["sha1_hex"] = r.pop("sha1")
    return rows


class _Member:
    """Compressed pieces of one member as they come in."""

    def __init__(self) -> None:
        self.raw: list[bytes] = []
        self.text: list[bytes] = []
        self.start = b""
        self.unpack = zlib.decompressobj(31)

    def add(self, piece: bytes) -> bool:
        """False if the bytes do not go on with the member, or do not begin a WARC record."""
        try:
            text = self.unpack.decompress(piece)
        except zlib.error:
            return False
        self.raw.append(piece)
        self.text.append(text)
        if len(self.start) < len(HEAD):
            self.start += text[: len(HEAD) - len(self.start)]
        return HEAD.startswith(self.start) and (self.sure or not self.unpack.eof)

    @property
    def sure(self) -> bool:
        """The version line has been decoded."""
        return self.start == HEAD

    @property
    def whole(self) -> bool:
        return self.unpack.eof


def _members(pieces: Iterator[bytes]) -> Iterator[tuple[str, _Member | bytes]]:
    """Pieces in file order as ("record", member), ("open", member) cut off, or ("stray", piece)."""
    queue: deque[bytes] = deque()
    member: _Member | None = None
    while True:
        if not queue:
            piece = next(pieces, None)
            if piece is None:
                if member is None:
                    return
                if member.sure:
                    yield "open", member
                    return
                yield "stray", member.raw[0]
                queue.extend(member.raw[1:])
                member = None
                continue
            queue.append(piece)
        piece = queue.popleft()
        if member is None:
            member = _Member()
            if not member.add(piece):
                member = None
                yield "stray", piece
        elif not member.add(piece):
            queue.appendleft(piece)
            if member.sure:
                yield "open", member
            else:  # what looked like a header was none: its later pieces are looked at again
                rest = [r for r in member.raw if r is not piece]
                yield "stray", rest[0]
                queue.extendleft(reversed(rest[1:]))
            member = None
        if member and member.whole:
            yield "record", member
            if rest := member.unpack.unused_data.strip(b"\0"):  # a member whose magic is damaged
                yield "stray", rest
            member = None


def _parsed(member: _Member) -> tuple[list[tuple[str, str]], bytes]:
    head, _, rest = b"".join(member.text).partition(b"\r\n\r\n")
    fields = [line.partition(b":")[::2] for line in head.split(b"\r\n")[1:]]
    named = [(k.decode("latin-1").strip().lower(), v.decode("utf-8", "replace").strip()) for k, v in fields if k]
    size = int(dict(named).get("content-length", len(rest)))
    return named, rest[:size]


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    read = spark.read.options(**NOT_UNPACKED).option("lineSep", MAGIC.decode("latin-1")).option("encoding", "ISO-8859-1").text(path)
    return read.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                       F.col("value").cast("binary").alias("piece"))


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, int, str, _Member | bytes]]:
    """(file, block, number, kind, content) of each byte range of the task."""
    rows = (row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in ("file", "block", "piece"))))
    for (file, block), own in groupby(rows, lambda r: r[:2]):
        if block == 0:
            ahead = next(own)[2]  # what stands before the first magic of a file
            if ahead.strip(b"\0"):
                if _UNPACKED_NAME.search(file):
                    raise ValueError(f"{file} does not begin with the gzip magic, or was unpacked for its name")
                yield file, block, -1, "stray", ahead
        for number, (kind, what) in enumerate(_members(MAGIC + r[2] for r in own)):
            yield file, block, number, kind, what


_RECORD = "headers map<string,string>, content binary"


def _table(records: list[tuple[list[tuple[str, str]], bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in records], pa.map_(pa.string(), pa.string())), pa.array([r[1] for r in records], pa.binary())],
        ["headers", "content"])


def _leftovers(pieces: DataFrame) -> DataFrame:
    """file, parts: what the byte ranges did not decode, from one open member to the next."""
    def leftovers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for file, block, number, kind, what in _walk(batches):
            if kind != "record":
                raw = b"".join(what.raw) if kind == "open" else what
                yield pa.RecordBatch.from_arrays(
                    [pa.array([file]), pa.array([block], pa.int64()), pa.array([number], pa.int64()),
                     pa.array([kind]), pa.array([raw], pa.binary())], ["file", "block", "number", "kind", "raw"])

    left = pieces.mapInArrow(leftovers, "file string, block long, number long, kind string, raw binary")
    # an open member goes on in the stray pieces that follow it; both are rare and short
    order = Window.partitionBy("file").orderBy("block", "number")
    runs = left.withColumn("run", F.sum(F.when(F.col("kind") == "open", 1).otherwise(0)).over(order))
    return runs.groupBy("file", "run").agg(F.array_sort(F.collect_list(F.struct("block", "number", "raw"))).alias("parts")).select("file", "parts")


def _joined(batch: pa.RecordBatch) -> Iterator[tuple[str, str, _Member | bytes]]:
    """(file, "record" or why there is none, content) of leftovers put together."""
    for file, parts in zip(batch.column("file").to_pylist(), batch.column("parts").to_pylist()):
        for kind, what in _members(p["raw"] for p in parts):
            reason = kind if kind == "record" else _reason(kind, what)
            if reason:
                yield file, reason, what


def _reason(kind: str, what: _Member | bytes) -> str | None:
    """Why these bytes are no record; None for an empty member."""
    if kind == "open":
        return "cut"
    unpack = zlib.decompressobj(31)
    try:
        text = unpack.decompress(what)
    except zlib.error:
        return "damaged"
    if not unpack.eof:
        return "cut"
    return "no WARC/1 record" if text else "damaged" if unpack.unused_data.strip(b"\0") else None


def _n_bytes(what: _Member | bytes) -> int:
    return len(what) if isinstance(what, bytes) else sum(map(len, what.raw))


def read_warc(spark: SparkSession, path: str, undecoded: str = "raise") -> DataFrame:
    """headers (names in lower case), content (the record's block) of all records under `path`. Bytes that
    are no WARC/1 record stop the job, or are left out with undecoded="skip"."""
    if undecoded not in ("raise", "skip"):
        raise ValueError("undecoded is raise or skip")
    pieces = _pieces(spark, path)

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready, size = [], 0
        for *_, kind, member in _walk(batches):
            if kind == "record":
                ready.append(_parsed(member))
                size += len(ready[-1][1])
                if size > 4 << 20:
                    yield _table(ready)
                    ready, size = [], 0
        yield _table(ready)

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ready = []
            for file, kind, what in _joined(batch):
                if kind == "record":
                    ready.append(_parsed(what))
                elif undecoded == "raise":
                    raise ValueError(f"{_n_bytes(what)} bytes of {file} did not decode ({kind}); undecoded_members lists such bytes, "
                                     "undecoded='skip' leaves them out")
            yield _table(ready)

    return pieces.mapInArrow(records, _RECORD).unionByName(_leftovers(pieces).mapInArrow(joined, _RECORD))


def undecoded_members(spark: SparkSession, path: str) -> DataFrame:
    """file, n_bytes, reason ("cut", "damaged", "no WARC/1 record") of all bytes under `path` that read_warc
    cannot give as a record."""
    def failed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(file, _n_bytes(what), kind) for file, kind, what in _joined(batch) if kind != "record"]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in rows], kind) for k, kind in enumerate((pa.string(), pa.int64(), pa.string()))],
                ["file", "n_bytes", "reason"])

    return _leftovers(_pieces(spark, path)).mapInArrow(failed, "file string, n_bytes long, reason string")


def page_records(records: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, payload of records read back.
    The payload of a response is hashed again; a difference from its header stops the job."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for pairs, content in zip(batch.column("headers").to_pylist(), batch.column("content").to_pylist()):
                h = dict(pairs)
                http, _, payload = content.partition(b"\r\n\r\n")
                size = int(re.search(rb"(?i)\r\ncontent-length:\s*(\d+)", http)[1])
                digest = h["warc-payload-digest"].removeprefix("sha1:")
                revisit = h["warc-type"] == "revisit"
                if not revisit and (len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
                    raise ValueError(f"record {h['warc-record-id']} is damaged")
                number = lambda v: None if v is None or v[len(_URN) + 1:-1] == "None" else int(v[len(_URN) + 1:-1])
                out.append((number(h["warc-record-id"]), size, digest, h["warc-type"], number(h.get("warc-refers-to")),
                            None if revisit else payload))
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], kind) for k, kind in enumerate(kinds)], names)

    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
    return records.mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, "
                                   "refers_to long, payload binary")


def op5(pages: DataFrame) -> DataFrame:
    path = f"{shared_folder(pages.sparkSession)}/oddrows-warc-{uuid.uuid4().hex}"
    write_warc(pages, path)
    return page_records(read_warc(pages.sparkSession, path)).drop("payload")


OP5_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
g AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first FROM p)
SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((('0x' || substr(h, 1 + 5 * (k // 4), 5))::BIGINT >> (15 - 5 * (k % 4))) & 31), 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM g
"""
