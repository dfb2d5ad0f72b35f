import hashlib
import random
import zlib

from oddrows.llm import warc
from pyspark.sql import types as T

SCHEMA = "page_id long, url string, html string, member string"


def test_round_trip_and_groups(spark, folder):
    rows = [(3, "http://a/\r\nx y", "same", "m"), (1, None, "same", "m"), (2, "u", None, "m"), (5, "u", "", "m"),
            (None, "u", "same", "m"), (7, "u", "é" * 3000, "m"), (1, "u", "same", "m"), (None, "u", "only null", "m")]
    pages = spark.createDataFrame(rows, SCHEMA)
    warc.write_warc(pages, folder + "/w")
    got = warc.page_records(warc.read_warc(spark, folder + "/w")).collect()
    view = sorted(((r.page_id is not None, r.page_id or 0, r.record_type, r.refers_to, r.payload_bytes) for r in got), key=repr)
    assert view == sorted([
        (True, 3, "revisit", 1, 4), (True, 1, "response", None, 4), (True, 1, "response", None, 4), (False, 0, "revisit", 1, 4),
        (True, 2, "response", None, 0), (True, 5, "revisit", 2, 0), (True, 7, "response", None, 6000),
        (False, 0, "response", None, 9)], key=repr)
    assert {bytes(r.payload) for r in got if r.payload is not None} == {b"same", b"", ("é" * 3000).encode(), b"only null"}


def test_smaller_payloads_are_all_responses(spark, folder):
    pages = spark.createDataFrame([(1, "u", "ab", "m"), (2, "u", "ab", "m"), (3, "u", "abcd", "m"), (4, "u", "abcd", "m")], SCHEMA)
    warc.write_warc(pages, folder + "/w", min_bytes=3)
    got = {r.page_id: r.refers_to for r in warc.page_records(warc.read_warc(spark, folder + "/w")).collect()}
    assert got == {1: None, 2: None, 3: None, 4: 3}


def test_empty_table(spark, folder):
    warc.write_warc(spark.createDataFrame([], SCHEMA), folder + "/w")
    assert warc.read_warc(spark, folder + "/w").count() == 0


def test_long_members_end_with_a_zero_byte():
    data = b"x" * (1 << 24)
    packed = warc._gzip(data)
    assert packed[-1] == 0 and zlib.decompressobj(31).decompress(packed) == data


def test_byte_ranges_and_false_magic(spark, folder):
    """Stored members that hold the magic, cut into ranges shorter than a member."""
    rng = random.Random(5)
    payloads = []
    for k in range(60):
        parts = [rng.randbytes(rng.randint(0, 900)) for _ in range(rng.randint(1, 5))]
        payloads.append(rng.choice([warc.MAGIC, b"WARC/1.", b"\r\n\r\n", warc.MAGIC * 3]).join(parts))

    def stored(data):
        z = zlib.compressobj(0, zlib.DEFLATED, 31)
        return z.compress(data) + z.flush()

    body = b"".join(stored(warc.record(k, "u", p, hashlib.sha1(p).hexdigest(), None)) for k, p in enumerate(payloads))
    spark.createDataFrame([(bytearray(body),)], T.StructType([T.StructField("b", T.BinaryType())]))
    with open(folder + "/one.warc", "wb") as f:
        f.write(body)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        for size in (257, 1000, 4099, 1 << 20):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", 1)
            got = warc.page_records(warc.read_warc(spark, folder + "/one.warc")).collect()
            assert sorted((r.page_id, bytes(r.payload)) for r in got) == list(enumerate(payloads)), size
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old[0])
        spark.conf.set("spark.sql.files.openCostInBytes", old[1])


def _record(k, size=600):
    payload = random.Random(k).randbytes(size)
    return warc._gzip(warc.record(k, "u", payload, hashlib.sha1(payload).hexdigest(), None))


def test_names_of_compressed_files(spark, folder):
    """*.warc.gz is read in ranges like any other name; what the reader unpacks all the same is an error."""
    import gzip
    import pytest

    for name in ("a.warc.gz", "B.WARC.GZ", "c.warc"):
        with open(f"{folder}/{name}", "wb") as f:
            f.write(b"".join(_record(k) for k in range(50)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", 5000)
        spark.conf.set("spark.sql.files.openCostInBytes", 1)
        got = warc.page_records(warc.read_warc(spark, folder)).collect()
        assert sorted(r.page_id for r in got) == sorted(list(range(50)) * 3)
        assert warc._pieces(spark, folder + "/a.warc.gz").select("block").distinct().count() > 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old[0])
        spark.conf.set("spark.sql.files.openCostInBytes", old[1])
    with open(f"{folder}/d.bz2", "wb") as f:
        f.write(__import__("bz2").compress(gzip.decompress(_record(1))))
    with pytest.raises(Exception, match="was unpacked for its name"):
        warc.read_warc(spark, folder + "/d.bz2").count()


def test_undecoded_members_are_counted(spark, folder):
    import gzip
    import pytest

    damaged = bytearray(_record(2))
    damaged[300] ^= 255
    lost = b"\0" + _record(4)[1:]  # its magic is gone
    with open(folder + "/one.warc.gz", "wb") as f:
        f.write(_record(1) + bytes(damaged) + _record(3) + lost + gzip.compress(b"WARC/0.18\r\nA: b\r\n\r\n") + gzip.compress(b"")
                + _record(5) + _record(6)[:400])
    found = warc.undecoded_members(spark, folder).collect()
    assert sorted(r.reason for r in found) == ["cut", "damaged", "damaged", "no WARC/1 record"]
    assert all(r.file.endswith("one.warc.gz") and r.n_bytes > 0 for r in found)
    left = warc.page_records(warc.read_warc(spark, folder, undecoded="skip")).collect()
    assert sorted(r.page_id for r in left) == [1, 3, 5]
    with pytest.raises(Exception, match="did not decode"):
        warc.read_warc(spark, folder).count()
