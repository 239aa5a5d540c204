"""WARC records in ZIP archives: written by tasks, found through the ZIP's own directories, read by ranges.

Each task writes archives of bounded size to a folder that all executors reach: stored (not compressed) members
``archive/data.warc.gz``, one gzip member per record, and ``indexes/index.cdxj``, a line per record. A
manifest of the archives of successful attempts is written as a table, so that files of lost or repeated attempts are never read.

Reading starts from archive paths alone. One task per archive reads the end of the file, the ZIP64 records
where there are any, the central directory and the index member; the record ranges are then dealt out anew
and read piece by piece, so a large archive is read by many tasks and nothing is unpacked to disk.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from burstline.llm.common import hinted, new_path, table

ARCHIVE_BYTES = 32 * 1024 * 1024  # of records in one archive, about
RANGE_BYTES = 4 * 1024 * 1024  # read at once by a task
LEAST_SHARED = 100  # payloads below are never revisits
DATA, INDEX = b"archive/data.warc.gz", b"indexes/index.cdxj"

RECORD = T.StructType([
    T.StructField("record_id", T.StringType()), T.StructField("record_type", T.StringType()), T.StructField("url", T.StringType()),
    T.StructField("refers_to", T.StringType()), T.StructField("payload_bytes", T.LongType()),
    T.StructField("payload_digest", T.StringType()), T.StructField("payload", T.BinaryType()),
])


def filesystem(uri: str):
    """The file system and path of a folder of the cluster, as pyarrow names them."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("/") else re.sub("^file:", "file://", uri))


# --- ZIP: only what stored members need, by the published format ---


def zip_local(name: bytes, crc: int, size: int, force64: bool) -> bytes:
    """A local header of a stored member; beyond 4 GB, or if asked for, sizes go to a ZIP64 field."""
    big = force64 or size >= 0xFFFFFFFF
    extra = struct.pack("<HHQQ", 1, 16, size, size) if big else b""
    shown = 0xFFFFFFFF if big else size
    return struct.pack("<4sHHHHHIIIHH", b"PK\3\4", 45 if big else 20, 0, 0, 0, 0x21, crc, shown, shown, len(name), len(extra)) + name + extra


def zip_directory(members: list[tuple[bytes, int, int, int]], start: int, force64: bool) -> bytes:
    """The central directory of (name, crc, size, place of the local header) with its end records."""
    out = b""
    for name, crc, size, place in members:
        big = force64 or size >= 0xFFFFFFFF or place >= 0xFFFFFFFF
        extra = struct.pack("<HHQQQ", 1, 24, size, size, place) if big else b""
        shown, at = (0xFFFFFFFF, 0xFFFFFFFF) if big else (size, place)
        out += struct.pack(
            "<4sHHHHHHIIIHHHHHII", b"PK\1\2", 45 if big else 20, 45 if big else 20, 0, 0, 0, 0x21, crc, shown, shown, len(name),
            len(extra), 0, 0, 0, 0, at,
        ) + name + extra
    length, count = len(out), len(members)
    big = force64 or start >= 0xFFFFFFFF or count >= 0xFFFF
    if big:
        out += struct.pack("<4sQHHIIQQQQ", b"PK\6\6", 44, 45, 45, 0, 0, count, count, length, start)
        out += struct.pack("<4sIQI", b"PK\6\7", 0, start + length, 1)
    shown = (0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF) if big else (count, length, start)
    return out + struct.pack("<4sHHHHIIH", b"PK\5\6", 0, 0, shown[0], shown[0], shown[1], shown[2], 0)


def zip_members(file, size: int) -> dict[str, tuple[int, int]]:
    """Name -> (place of the data, its length) of the stored members, from the directories at the end of the file."""

    def at(place: int, length: int) -> bytes:
        file.seek(place)
        return file.read(length)

    low = max(0, size - 22 - 0xFFFF)
    tail = at(low, size - low)
    # The end record is the last one whose comment reaches exactly to the end of the file.
    found = next((i for i in range(len(tail) - 22, -1, -1) if tail[i : i + 4] == b"PK\5\6" and i + 22 + struct.unpack_from("<H", tail, i + 20)[0] == len(tail)), None)
    if found is None:
        raise ValueError("no end of a ZIP directory: the archive is cut off or not a ZIP")
    count, length, start = struct.unpack_from("<HII", tail, found + 10)
    end = low + found
    if count == 0xFFFF or length == 0xFFFFFFFF or start == 0xFFFFFFFF:
        mark, _, place, _ = struct.unpack("<4sIQI", at(end - 20, 20))
        if mark != b"PK\6\7":
            raise ValueError("ZIP64 locator missing")
        mark, _, _, _, _, _, _, count, length, start = struct.unpack("<4sQHHIIQQQQ", at(place, 56))
        if mark != b"PK\6\6":
            raise ValueError("ZIP64 end record missing")
    directory, i, members = at(start, length), 0, {}
    for _ in range(count):
        if directory[i : i + 4] != b"PK\1\2":
            raise ValueError("broken ZIP directory")
        method, packed, unpacked, names, extras, comments, place = struct.unpack_from("<10xH8xIIHHH8xI", directory, i)
        name = directory[i + 46 : i + 46 + names].decode()
        j, until = i + 46 + names, i + 46 + names + extras
        while j + 4 <= until:
            kind, n = struct.unpack_from("<HH", directory, j)
            if kind == 1:
                wide = [struct.unpack_from("<Q", directory, j + 4 + k)[0] for k in range(0, n - n % 8, 8)]
                unpacked = wide.pop(0) if unpacked == 0xFFFFFFFF else unpacked
                packed = wide.pop(0) if packed == 0xFFFFFFFF else packed
                place = wide.pop(0) if place == 0xFFFFFFFF else place
            j += 4 + n
        if method == 0 and not name.endswith("/"):
            mark, n, m = struct.unpack("<4s22xHH", at(place, 30))
            if mark != b"PK\3\4":
                raise ValueError(f"no local header for {name}")
            members[name] = (place + 30 + n + m, packed)
        i = until + comments
    return members


# --- WARC records ---


def warc_record(record_id: str, kind: str, url: str | None, refers_to: str | None, payload: bytes | None, digest: str, length: int) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    block = http + (payload or b"" if kind == "response" else b"")
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:row:{record_id}>", "WARC-Date: 1970-01-01T00:00:00Z"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\r\n]", lambda m: f"%{ord(m[0]):02X}", url))
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:row:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += [f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> tuple:
    """A row of RECORD; the payload of a response is checked against its digest."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.strip().lower(): v.strip(" ") for k, _, v in (line.partition(":") for line in lines[1:])}
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    declared = next(int(line.split(b":")[1]) for line in http.split(b"\r\n") if line.lower().startswith(b"content-length"))
    kind, digest = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha256:")
    if kind == "response" and (len(payload) != declared or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError("the payload does not have the digest its record names")
    row = lambda name: re.sub(r"^<urn:row:|>$", "", fields[name]) if name in fields else None
    return row("warc-record-id"), kind, fields.get("warc-target-uri"), row("warc-refers-to"), declared, digest, payload if kind == "response" else None


# --- writing ---


def _archive(store, path: str, records: list[bytes], index: list[str], force64: bool) -> int:
    """Write one archive; its length."""
    crc = 0
    for raw in records:
        crc = zlib.crc32(raw, crc)
    size, text = sum(map(len, records)), "".join(index).encode()
    first, second = zip_local(DATA, crc, size, force64), zip_local(INDEX, zlib.crc32(text), len(text), force64)
    at = len(first) + size
    start = at + len(second) + len(text)
    tail = zip_directory([(DATA, crc, size, 0), (INDEX, zlib.crc32(text), len(text), at)], start, force64)
    with store.open_output_stream(path) as file:
        for piece in (first, *records, second, text, tail):
            file.write(piece)
    return start + len(tail)


def _writer(folder: str, archive_bytes: int, force64: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = filesystem(folder)
        store.create_dir(base, recursive=True)
        done: list[tuple[str, int]] = []
        records: list[bytes] = []
        index: list[str] = []
        size = 0

        def close():
            nonlocal records, index, size
            # A name of its own for each attempt: a repeated task never writes over another's archive.
            name = f"{uuid.uuid4().hex}.zip"
            done.append((name, _archive(store, f"{base}/{name}", records, index, force64)))
            records, index, size = [], [], 0

        for batch in batches:
            for r in batch.to_pylist():
                payload = (r["payload"] or "").encode()
                name = "" if r["record_id"] is None else str(r["record_id"])
                raw = warc_record(name, r["record_type"], r["url"], r["refers_to"], payload, r["digest"], len(payload))
                packed = gzip.compress(raw, 4, mtime=0)
                index.append(json.dumps({"record_id": name, "offset": size, "length": len(packed)}) + "\n")
                records.append(packed)
                size += len(packed)
                if size >= archive_bytes:
                    close()
        if records:
            close()
        yield pa.RecordBatch.from_arrays([pa.array([n for n, _ in done], pa.string()), pa.array([n for _, n in done], pa.int64())], names=["name", "size"])

    return run


def classified(pages: DataFrame, record_id: str = "page_id", payload: str = "html", url: str = "url", least: int = LEAST_SHARED) -> DataFrame:
    """record_id, url, payload, digest, record_type and refers_to of every row.

    Of rows with equal payloads of at least ``least`` bytes, those with the smallest id are responses and the rest revisits
    of it. A null payload counts as empty. Rows without id are revisits if a row of that payload has one, else responses.
    Only digests travel: the groups that share one are found by a count, and come back as a lookup.
    """
    rows = pages.select(
        F.col(f"`{record_id}`").alias("record_id"), F.col(f"`{url}`").cast("string").alias("url"),
        F.coalesce(F.col(f"`{payload}`").cast("string"), F.lit("")).alias("payload"),
    )
    digest = F.sha2(F.encode("payload", "UTF-8"), 256)
    shared = (
        rows.where(F.octet_length("payload") >= least).select(digest.alias("digest"), "record_id")
        .groupBy("digest").agg(F.min("record_id").alias("first"), F.count("*").alias("n")).where("n > 1 and first is not null")
        .select("digest", "first")
    ).persist()
    found = rows.withColumn("digest", digest).join(hinted(shared, 96), "digest", "left")
    again = F.col("first").isNotNull() & ~F.col("record_id").eqNullSafe(F.col("first"))
    return found.select(
        "record_id", "url", "payload", "digest", F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.when(again, F.col("first")).cast("string").alias("refers_to"),
    )


def write_archives(records: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES, force64: bool = False) -> None:
    """Write ``records`` (as ``classified`` gives them) as archives in ``folder`` with a manifest of them.

    ``folder`` must be one that all executors and pyarrow reach. No rows make no archives and an empty manifest.
    """
    made = records.mapInArrow(_writer(f"{folder}/data", archive_bytes, force64), "name string, size long")
    made.write.parquet(f"{folder}/manifest")


# --- reading ---


def _locate(folder: str, range_bytes: int):
    """For each archive: runs of whole records of about ``range_bytes``, from the member table and the index."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = filesystem(folder)
        for batch in batches:
            rows: list[tuple] = []
            for r in batch.to_pylist():
                with store.open_input_file(f"{base}/{r['name']}") as file:
                    members = zip_members(file, r["size"])
                    place, length = members[INDEX.decode()]
                    data, _ = members[DATA.decode()]
                    file.seek(place)
                    lengths: list[int] = []
                    start = 0
                    for line in file.read(length).splitlines():
                        entry = json.loads(line)
                        if lengths and entry["offset"] + entry["length"] - start > range_bytes:
                            rows.append((r["name"], data + start, lengths))
                            lengths = []
                        if not lengths:
                            start = entry["offset"]
                        lengths.append(entry["length"])
                    if lengths:
                        rows.append((r["name"], data + start, lengths))
            yield pa.RecordBatch.from_arrays([
                pa.array([x[0] for x in rows], pa.string()), pa.array([x[1] for x in rows], pa.int64()),
                pa.array([x[2] for x in rows], pa.list_(pa.int64())),
            ], names=["name", "start", "lengths"])

    return run


def _read(folder: str, payloads: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = filesystem(folder)
        kinds = [pa.string()] * 4 + [pa.int64(), pa.string(), pa.binary()]
        names = [f.name for f in RECORD.fields]
        for batch in batches:
            for r in batch.to_pylist():
                with store.open_input_file(f"{base}/{r['name']}") as file:
                    file.seek(r["start"])
                    raw = file.read(sum(r["lengths"]))
                rows, at = [], 0
                for length in r["lengths"]:
                    row = parse_record(gzip.decompress(raw[at : at + length]))
                    rows.append(row if payloads else (*row[:-1], None))
                    at += length
                yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in rows], kind) for k, kind in enumerate(kinds)], names=names)

    return run


def read_archives(spark, folder: str, range_bytes: int = RANGE_BYTES, payloads: bool = True) -> DataFrame:
    """The records (RECORD) of the archives that the folder's manifest names; payloads null for revisits or if not asked for."""
    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    manifest = spark.read.schema("name string, size long").parquet(f"{folder}/manifest")
    ranges = manifest.repartition(count).mapInArrow(_locate(f"{folder}/data", range_bytes), "name string, start long, lengths array<long>")
    return ranges.repartition(count).mapInArrow(_read(f"{folder}/data", payloads), RECORD)


def op2_warc_zip(spark, sf_dir: str) -> DataFrame:
    folder = new_path(spark, "warc")
    write_archives(classified(table(spark, sf_dir, "pages")), folder)
    return read_archives(spark, folder, payloads=False).select(
        F.expr("nullif(record_id, '')").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast("long").alias("refers_to"),
    )
