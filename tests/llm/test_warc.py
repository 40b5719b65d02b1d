"""Packages: round trip, ZIP64 directories, missing indexes."""

import hashlib
import io
import json
import zipfile
from base64 import b32encode

import pyarrow as pa
from pyspark.sql import functions as F

from pipewatch.llm import warc

BIG = 2**60 + 1
ROWS = [
    (1, "http://a/\r\nX: 1%0d", "same"),
    (7, None, "same"),
    (7, "http://b/", "same"),
    (BIG, "u", "é\r\n\r\n" * 50),
    (None, "n", "alone"),
    (None, "n", "same"),
    (5, "e", None),
    (6, "f", ""),
    (8, "long", "x" * 3_000_000),
    (9, "zip", "PK\x05\x06WARC/1.1\r\n\r\n"),
]


def test_round_trip(spark, tmp_path):
    pages = spark.createDataFrame(ROWS, "page_id long, url string, html string").withColumn("payload", F.lit(1))
    packages = warc.write_packages(pages, str(tmp_path / "p"))
    got = warc.read_packages(packages).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1] or "", r[2] or "")
    assert packages.agg(F.sum("records")).first()[0] == len(ROWS) == len(got)
    bodies = {b32encode(hashlib.sha1((r[2] or "").encode()).digest()).decode(): (r[2] or "") for r in ROWS}
    assert sorted(((r.page_id, r.url, bodies[r.payload_digest]) for r in got), key=key) == sorted(
        ((a, b, c or "") for a, b, c in ROWS), key=key
    )
    for r in got:
        assert r.payload_bytes == len(bodies[r.payload_digest].encode())
        assert r.record_type == "revisit" or r.payload.decode() == bodies[r.payload_digest]
    same = [r for r in got if bodies[r.payload_digest] == "same"]
    assert sorted(r.record_type for r in same) == ["response"] + 3 * ["revisit"]
    assert {(r.record_type, r.refers_to) for r in same} == {("response", None), ("revisit", 7)}
    assert next(r for r in same if r.record_type == "response").page_id == 7
    assert [(r.page_id, r.refers_to) for r in got if not r.payload_bytes and r.record_type == "revisit"] == [(5, 6)]
    few = warc.round_trip(spark, pages, revisit_from=5)
    assert {r.record_type for r in few.where("payload_bytes < 5").collect()} == {"response"}
    assert warc.round_trip(spark, pages.limit(0)).count() == 0


def package(zip64: bool, index: bool, packed_index: bool = False) -> tuple[bytes, list[bytes]]:
    records = [warc.record_bytes(i, f"u{i}", b"body %d" % i, "", None, False, "d") for i in range(5)]
    out, lines, at = io.BytesIO(), [], 0
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("readme.txt", "x" * 100)
        with z.open(warc.DATA, "w", force_zip64=zip64) as f:
            for r in records:
                f.write(r)
                lines.append("com,a)/ 2020 " + json.dumps({"offset": str(at), "length": str(len(r)), "filename": warc.DATA}))
                at += len(r)
        if index:
            z.writestr(warc.INDEX, "\n".join(lines), zipfile.ZIP_DEFLATED if packed_index else zipfile.ZIP_STORED)
    return out.getvalue(), records


def as_zip64(raw: bytes) -> bytes:
    """The same package with a ZIP64 end of the directory, as beyond 4 GB."""
    import struct

    at = raw.rfind(b"PK\x05\x06")
    count, size, start = struct.unpack("<H2L", raw[at + 10 : at + 20])
    wide = b"PK\x06\x06" + struct.pack("<Q2H2L4Q", 44, 45, 45, 0, 0, count, count, size, start)
    locator = b"PK\x06\x07" + struct.pack("<LQL", 0, at, 1)
    end = raw[at : at + 8] + struct.pack("<2H2L", 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF) + raw[at + 20 :]
    return raw[:at] + wide + locator + end


def test_directories_and_indexes():
    for zip64 in (False, True):
        for index, packed in ((True, False), (True, True), (False, False)):
            raw, records = package(zip64, index, packed)
            for data in (raw, as_zip64(raw)):
                file = pa.BufferReader(data)
                places = sorted(warc.record_places(file))
                assert [data[a : a + n] for a, n in places] == records
                assert [warc.parse_record(data[a : a + n])["payload"] for a, n in places] == [b"body %d" % i for i in range(5)]


def test_digest_is_base32(spark):
    row = spark.createDataFrame([(b"abc",), (b"",)], "b binary").select(warc.base32_sha1(F.col("b"))).collect()
    assert [r[0] for r in row] == [b32encode(hashlib.sha1(x).digest()).decode() for x in (b"abc", b"")]
