"""WARC records in ZIP packages: written by many tasks, read back by byte ranges without extraction.

A package is a ZIP file whose members are stored as they are: ``archive/data.warc.gz`` (one gzip
member per record) and ``indexes/index.cdxj`` (where each record lies). A reader parses the end of
the central directory, in its 32-bit or ZIP64 form, the directory itself, and the local headers;
then it takes the index for the list of records and reads each record's bytes where they are.

Equal payloads are written once. Of records with equal payloads the one with the largest key is a
``response``; the others are ``revisit`` records that refer to it. Keys are whole numbers or
strings. Defined results: a NULL body is
an empty payload; a NULL key is smaller than any other and comes back as NULL; a NULL address is
left out; records that repeat key and payload make one response, the others revisit it; payloads
below ``revisit_from`` bytes are always responses; an empty table gives no package and no rows.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import struct
import uuid
import zipfile
import zlib
from base64 import b32encode
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from pipewatch.llm.common import scratch_path, whole_text
from pipewatch.session import durable

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
# Compressed bytes after which a task begins another package, and bytes of a range that is read at once.
PACKAGE_BYTES = 64 << 20
RANGE_BYTES = 4 << 20
LEVEL = 3
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = "page_id {kind}, url string, record_type string, payload_bytes bigint, payload_digest string, refers_to {kind}, payload binary"


def base32_sha1(body: Column) -> Column:
    """The upper-case base32 SHA-1 of a binary column: 10 hex digits are 8 digits of base 32."""
    digest = F.sha1(body)
    parts = [F.lpad(F.conv(F.substring(digest, at, 10), 16, 32), 8, "0") for at in (1, 11, 21, 31)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[5:]
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


# -- records ------------------------------------------------------------------


def _record_id(key: object) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, repr(key))}>"


def _one_line(value: object) -> str:
    """A header value: control characters and the per cent sign itself are escaped."""
    return "".join(f"%{ord(c):02X}" if c < " " or c in "%\x7f" else c for c in str(value))


def _from_line(value: str) -> str:
    head, *rest = value.split("%")
    return head + "".join(chr(int(p[:2], 16)) + p[2:] for p in rest)


def record_bytes(key: object, url: str | None, payload: bytes, digest: str, refers_to: object, revisit: bool, date: str) -> bytes:
    """One WARC record as a gzip member. A revisit has the HTTP headers of the whole response, no payload."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block += b"" if revisit else payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", _record_id(key)),
        ("WARC-Date", date),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", len(block)),
        ("X-Record-Key", json.dumps(key)),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", _one_line(url)))
    if revisit:
        fields += [
            ("WARC-Profile", REVISIT_PROFILE),
            ("WARC-Refers-To", _record_id(refers_to)),
            ("X-Refers-To-Key", json.dumps(refers_to)),
        ]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return gzip.compress(head.encode() + block + b"\r\n\r\n", LEVEL, mtime=0)


def parse_record(member: bytes) -> dict:
    """The fields of one record; the digest of a response is taken from its payload."""
    raw = gzip.decompress(member)
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record here")
    field = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    block = rest[: int(field["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    url = field.get("warc-target-uri")
    out = {
        "page_id": json.loads(field.get("x-record-key", "null")),
        "url": None if url is None else _from_line(url),
        "record_type": field["warc-type"],
        "payload_bytes": len(payload),
        "payload_digest": field.get("warc-payload-digest", "").removeprefix("sha1:"),
        "refers_to": json.loads(field.get("x-refers-to-key", "null")),
        "payload": payload,
    }
    if out["record_type"] == "revisit":
        lengths = [x.split(b":")[1] for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
        out |= {"payload_bytes": int(lengths[0]), "payload": None}
    else:
        digest = b32encode(hashlib.sha1(payload).digest()).decode()
        if out["payload_digest"] not in ("", digest):
            raise ValueError(f"payload of {out['page_id']} does not have the digest of its record")
        out["payload_digest"] = digest
    return out


# -- writing ------------------------------------------------------------------


def with_revisits(pages: DataFrame, revisit_from: int = 0, key: str = "page_id", body: str = "html", url: str = "url") -> DataFrame:
    """``key, url, payload, digest, refers_to, revisit`` of every page.

    Groups are summed up by digest on the map side; only those with two pages or more are joined
    back, in a join whose hot digests adaptive execution splits.
    """
    payload = F.encode(whole_text(body), "UTF-8")
    rows = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", base32_sha1(F.col("payload")))
    same = rows.where(F.octet_length("payload") >= revisit_from).groupBy("digest", "key").agg(F.count(F.lit(1)).alias("n"))
    groups = durable(
        same.groupBy("digest")
        .agg(F.max(F.struct("key", "n")).alias("kept"), F.sum("n").alias("pages"))
        .where("pages > 1")
        .select(F.col("digest").alias("of"), F.col("kept.key").alias("response"), F.col("kept.n").alias("rivals"))
    )
    joined = rows.join(groups, F.col("digest") == F.col("of"), "left")
    chosen = F.col("of").isNotNull() & F.col("key").eqNullSafe(F.col("response"))
    columns = ["key", "url", "payload", "digest", F.when(F.col("revisit"), F.col("response")).alias("refers_to"), "revisit"]
    if not groups.where("rivals > 1").head(1):
        return joined.withColumn("revisit", F.col("of").isNotNull() & ~chosen).select(*columns)
    # Some rows repeat the key of a response: the first of them is the response.
    plain = joined.where(~(chosen & (F.col("rivals") > 1))).withColumn("revisit", F.col("of").isNotNull() & ~chosen)
    first = F.row_number().over(Window.partitionBy("digest").orderBy("url"))
    tied = joined.where(chosen & (F.col("rivals") > 1)).withColumn("revisit", first > 1)
    return plain.select(*columns).unionByName(tied.select(*columns))


def write_packages(pages: DataFrame, folder: str, revisit_from: int = 0, date: str = "1970-01-01T00:00:00Z", **names: str) -> DataFrame:
    """Write all pages into packages under ``folder``; the list of packages is the only table returned.

    A task names its files after its own attempt, and the list, which is durable, has those of the
    attempts that counted. Files of lost attempts are never read.
    """
    rows = with_revisits(pages, revisit_from, **names)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        filesystem, root = _filesystem(folder)
        package = None

        def begin() -> None:
            nonlocal package
            name = f"{root}/part-{context.partitionId():05d}-{context.taskAttemptId()}-{len(done)}.zip"
            filesystem.create_dir(root, recursive=True)
            stream = filesystem.open_output_stream(name)
            packed = zipfile.ZipFile(stream, "w", zipfile.ZIP_STORED)
            package = (name, stream, packed, packed.open(DATA, "w", force_zip64=True), [])

        def end() -> None:
            nonlocal package
            name, stream, packed, data, index = package
            data.close()
            packed.writestr(INDEX, "".join(json.dumps(line) + "\n" for line in index))
            packed.close()
            stream.close()
            done.append((f"{folder}/{name.rpartition('/')[2]}", len(index)))
            package = None

        done: list[tuple[str, int]] = []
        for batch in batches:
            for row in batch.to_pylist():
                if package is None:
                    begin()
                data, index = package[3], package[4]
                record = record_bytes(row["key"], row["url"], row["payload"], row["digest"], row["refers_to"], row["revisit"], date)
                at = index[-1]["offset"] + index[-1]["length"] if index else 0
                index.append({"offset": at, "length": len(record), "filename": DATA, "digest": row["digest"]})
                data.write(record)
                if at + len(record) >= PACKAGE_BYTES:
                    end()
        if package is not None:
            end()
        yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in done], pa.string()), pa.array([n for _, n in done], pa.int64())], ["package", "records"])

    return durable(rows.mapInArrow(write, "package string, records bigint"))


# -- reading ------------------------------------------------------------------


def directory(file: pa.NativeFile) -> dict[str, tuple[int, int, int, int]]:
    """Members of a ZIP file by name: method, stored bytes, bytes, place of the local header."""
    total = file.size()
    tail_at = max(0, total - 65_557)
    file.seek(tail_at)
    tail = file.read(total - tail_at)
    at = tail.rfind(b"PK\x05\x06")
    if at < 0:
        raise ValueError("no end of a central directory")
    count, size, start = struct.unpack("<H2L", tail[at + 10 : at + 20])
    if at >= 20 and tail[at - 20 : at - 16] == b"PK\x06\x07":
        place = struct.unpack("<Q", tail[at - 12 : at - 4])[0]
        file.seek(place)
        end = file.read(56)
        if end[:4] != b"PK\x06\x06":
            raise ValueError("no ZIP64 end of the central directory")
        count, size, start = struct.unpack("<3Q", end[32:56])
    file.seek(start)
    raw, members, at = file.read(size), {}, 0
    for _ in range(count):
        if raw[at : at + 4] != b"PK\x01\x02":
            raise ValueError("broken central directory")
        method = struct.unpack("<H", raw[at + 10 : at + 12])[0]
        stored, plain, n_name, n_extra, n_comment = struct.unpack("<2L3H", raw[at + 20 : at + 34])
        place = struct.unpack("<L", raw[at + 42 : at + 46])[0]
        name = raw[at + 46 : at + 46 + n_name].decode()
        extra, e = raw[at + 46 + n_name : at + 46 + n_name + n_extra], 0
        while e + 4 <= len(extra):
            tag, n = struct.unpack("<2H", extra[e : e + 4])
            if tag == 1:
                # Only the numbers that do not fit above are here, in this order.
                wide = iter(struct.unpack(f"<{n // 8}Q", extra[e + 4 : e + 4 + n // 8 * 8]))
                plain = next(wide) if plain == 0xFFFFFFFF else plain
                stored = next(wide) if stored == 0xFFFFFFFF else stored
                place = next(wide) if place == 0xFFFFFFFF else place
            e += 4 + n
        members[name] = (method, stored, plain, place)
        at += 46 + n_name + n_extra + n_comment
    return members


def data_start(file: pa.NativeFile, place: int) -> int:
    """Where the bytes of the member whose local header is at ``place`` begin."""
    file.seek(place)
    head = file.read(30)
    if head[:4] != b"PK\x03\x04":
        raise ValueError("no local header")
    n_name, n_extra = struct.unpack("<2H", head[26:30])
    return place + 30 + n_name + n_extra


def _scan(file: pa.NativeFile, start: int, size: int) -> Iterator[tuple[int, int]]:
    """Places of gzip members where a package has no index: the member is read through once."""
    at = begin = start
    unzip, held = zlib.decompressobj(31), b""
    while at < start + size or held:
        if not held:
            file.seek(at)
            held = file.read(min(1 << 20, start + size - at))
            at += len(held)
        unzip.decompress(held)
        held = unzip.unused_data if unzip.eof else b""
        if unzip.eof:
            end = at - len(held)
            yield begin, end - begin
            begin, unzip = end, zlib.decompressobj(31)


def record_places(file: pa.NativeFile) -> list[tuple[int, int]]:
    """Place in the file and bytes of every record of a package."""
    members = directory(file)
    starts: dict[str, int] = {}
    for name, (method, _, _, place) in members.items():
        if name.endswith((".warc.gz", ".warc")):
            if method:
                raise ValueError(f"{name} is compressed, so its records can't be read in place")
            starts[name] = data_start(file, place)
    places: list[tuple[int, int]] = []
    indexed: set[str] = set()
    for name, (method, stored, _, place) in members.items():
        if name.endswith(".cdxj"):
            file.seek(data_start(file, place))
            raw = file.read(stored)
            text = (zlib.decompress(raw, -15) if method == 8 else raw).decode()
            for line in filter(None, text.split("\n")):
                entry = json.loads(line[line.index("{") :])
                indexed.add(entry["filename"])
                places.append((starts[entry["filename"]] + int(entry["offset"]), int(entry["length"])))
    for name in starts.keys() - indexed:
        places += _scan(file, starts[name], members[name][1])
    return places


def read_packages(packages: DataFrame, key_type: str = "bigint", tasks: int | None = None) -> DataFrame:
    """All records of the packages (column ``package``): see ``RECORD``.

    Packages give ranges of neighbouring records first; these are dealt out anew, so that one
    large package is read by many tasks.
    """

    def ranges(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for package in frame["package"]:
                filesystem, path = _filesystem(package)
                with filesystem.open_input_file(path) as file:
                    places = sorted(record_places(file))
                out, lengths = [], []
                for i, (at, length) in enumerate(places):
                    if not lengths:
                        begin = at
                    lengths.append(length)
                    ends = i + 1 == len(places) or places[i + 1][0] != at + length
                    if ends or at + length - begin >= RANGE_BYTES:
                        out.append((package, begin, lengths))
                        lengths = []
                yield pd.DataFrame(out, columns=["package", "at", "lengths"])

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for package, at, lengths in zip(frame["package"], frame["at"], frame["lengths"]):
                filesystem, path = _filesystem(package)
                with filesystem.open_input_file(path) as file:
                    file.seek(at)
                    raw = file.read(int(sum(lengths)))
                records, start = [], 0
                for length in lengths:
                    records.append(parse_record(raw[start : start + length]))
                    start += length
                # As objects: numbers beside NULLs must not become floats.
                yield pd.DataFrame({k: pd.Series([r[k] for r in records], dtype=object) for k in records[0]})

    spark = packages.sparkSession
    tasks = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = packages.select("package").repartition(tasks).mapInPandas(ranges, "package string, at bigint, lengths array<bigint>")
    return found.repartition(tasks).mapInPandas(read, RECORD.format(kind=key_type))


def round_trip(spark: SparkSession, pages: DataFrame, revisit_from: int = 0) -> DataFrame:
    """Write ``pages`` into packages of a new folder and read them back."""
    packages = write_packages(pages, scratch_path(spark, "warc"), revisit_from)
    return read_packages(packages, pages.schema["page_id"].dataType.simpleString())
