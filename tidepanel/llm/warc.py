"""WARC records in ZIP-packaged archives: writing, parsing the directories, and reading records by range.

An archive is a ZIP file whose members are stored, not compressed: `archive/data.warc.gz`, a WARC file
of one gzip member per record, and `indexes/index.jsonl`, a line per record with its offset and
length in the former. A reader finds the members in the central directory, adds the data offset of
the stored member to an index entry and reads just that range of the ZIP file.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import struct
import zipfile
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import shared_dir, written

DATA, INDEX = "archive/data.warc.gz", "indexes/index.jsonl"


def _filesystem(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


# ---- ZIP directories


def zip_members(f: BinaryIO, size: int) -> dict[str, tuple[int, int]]:
    """name -> (data offset, size) of the stored members of a ZIP file, from its central or ZIP64 directory."""
    tail_at = max(0, size - 65557)
    f.seek(tail_at)
    tail = f.read(size - tail_at)
    at = tail.rfind(b"PK\x05\x06")
    if at < 0:
        raise ValueError("no end of central directory")
    entries, length, start = struct.unpack("<HII", tail[at + 10 : at + 20])
    if entries == 0xFFFF or length == 0xFFFFFFFF or start == 0xFFFFFFFF:
        f.seek(tail_at + at - 20)
        locator = f.read(20)
        if locator[:4] != b"PK\x06\x07":
            raise ValueError("no ZIP64 locator")
        f.seek(struct.unpack("<Q", locator[8:16])[0])
        end = f.read(56)
        if end[:4] != b"PK\x06\x06":
            raise ValueError("no ZIP64 end of central directory")
        entries, length, start = struct.unpack("<QQQ", end[32:56])
    f.seek(start)
    directory, p, found = f.read(length), 0, {}
    for _ in range(entries):
        if directory[p : p + 4] != b"PK\x01\x02":
            raise ValueError("damaged central directory")
        method, = struct.unpack("<H", directory[p + 10 : p + 12])
        packed, plain, n, m, k = struct.unpack("<IIHHH", directory[p + 20 : p + 34])
        offset, = struct.unpack("<I", directory[p + 42 : p + 46])
        name = directory[p + 46 : p + 46 + n].decode()
        extra = directory[p + 46 + n : p + 46 + n + m]
        q = 0
        while q + 4 <= len(extra):
            kind, width = struct.unpack("<HH", extra[q : q + 4])
            if kind == 1:  # 64-bit values stand for those that are all ones, in this order
                field = q + 4
                if plain == 0xFFFFFFFF:
                    plain, = struct.unpack("<Q", extra[field : field + 8])
                    field += 8
                if packed == 0xFFFFFFFF:
                    packed, = struct.unpack("<Q", extra[field : field + 8])
                    field += 8
                if offset == 0xFFFFFFFF:
                    offset, = struct.unpack("<Q", extra[field : field + 8])
            q += 4 + width
        if method == 0:
            f.seek(offset)
            head = f.read(30)
            if head[:4] != b"PK\x03\x04":
                raise ValueError(f"no local header for {name}")
            name_length, extra_length = struct.unpack("<HH", head[26:30])
            found[name] = (offset + 30 + name_length + extra_length, packed)
        p += 46 + n + m + k
    return found


# ---- WARC records


def warc_record(page_id, url, payload: bytes, digest: bytes, refers_to) -> bytes:
    """A response record, or a revisit one, whose HTTP head keeps the length of the full payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (b"" if refers_to is not None else payload)
    uri = "".join(c if 33 <= ord(c) < 127 else "".join(f"%{b:02X}" for b in c.encode("utf-8", "replace")) for c in url or "")
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{page_id}>"]
    head += [f"WARC-Target-URI: {uri}", "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{base64.b32encode(digest).decode()}"]
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _fields(head: bytes) -> dict[str, str]:
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in head.decode().split("\r\n")[1:])}


def read_warc_record(record: bytes) -> dict:
    """The parts of one record; a response's payload is checked against its digest."""
    head, _, rest = record.partition(b"\r\n\r\n")
    if not head.startswith(b"WARC/"):
        raise ValueError("not a WARC record")
    fields = _fields(head)
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
    kind = fields["warc-type"]
    if kind == "response" and hashlib.sha1(payload).hexdigest() != digest:
        raise ValueError(f"payload of {fields['warc-record-id']} differs from its digest")
    number = lambda v: int(v.removeprefix("<urn:page:").removesuffix(">"))
    return {
        "page_id": number(fields["warc-record-id"]),
        "url": fields["warc-target-uri"],
        "payload_bytes": int(_fields(b"\r\n" + http.partition(b"\r\n")[2])["content-length"]),
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": number(fields["warc-refers-to"]) if kind == "revisit" else None,
        "payload": payload if kind == "response" else None,
    }


# ---- Spark jobs


def mark_revisits(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html", least: int = 1000) -> DataFrame:
    """page_id, url, html, digest, refers_to: the largest id with an equal payload of at least `least` bytes, null where that is the page's own."""
    html = F.coalesce(F.col(html_column), F.lit(""))
    rows = pages.where(F.col(id_column).isNotNull()).select(
        F.col(id_column).cast("long").alias("page_id"), F.col(url_column).cast("string").alias("url"), html.alias("html"), F.sha1(html.cast("binary")).alias("digest")
    )
    large = F.octet_length("html") >= least
    repeated = rows.where(large).groupBy("digest").agg(F.max("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").select(F.col("digest").alias("key"), "first")
    # small payloads match nothing: keys of their own spread them, however many are alike
    joined = rows.withColumn("key", F.when(large, F.col("digest")).otherwise(F.col("page_id").cast("string"))).join(repeated, "key", "left")
    return joined.select("page_id", "url", "html", "digest", F.when(large & (F.col("first") != F.col("page_id")), F.col("first")).alias("refers_to"))


def write_archives(marked: DataFrame, folder: str, roll_bytes: int = 1 << 28) -> DataFrame:
    """Write each partition's records to ZIP archives of about roll_bytes in `folder`; returns (archive, records, bytes).

    A file's name holds the task's attempt, and only the rows of attempts that succeeded are kept, so a
    task that ran twice leaves no record twice.
    """

    def write(batches):
        context = TaskContext.get()
        stem, rolled = f"part-{context.partitionId():05d}-{context.taskAttemptId()}", 0
        out = None
        for batch in batches:
            for page_id, url, html, digest, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    out = _ArchiveWriter(f"{folder}/{stem}-{rolled:03d}.zip")
                out.add(page_id, url, html.encode("utf-8", "surrogatepass"), bytes.fromhex(digest), refers_to)
                if out.bytes >= roll_bytes:
                    yield out.close()
                    out, rolled = None, rolled + 1
        if out is not None:
            yield out.close()

    files, _ = written(marked.mapInArrow(write, "archive string, records long, bytes long"), "archives")
    return files


class _ArchiveWriter:
    def __init__(self, uri: str):
        self.uri, self.bytes, self.lines = uri, 0, []
        system, path = _filesystem(uri)
        system.create_dir(path.rpartition("/")[0], recursive=True)
        self.stream = system.open_output_stream(path)
        self.zip = zipfile.ZipFile(self.stream, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.data = self.zip.open(DATA, "w", force_zip64=True)

    def add(self, page_id, url, payload: bytes, digest: bytes, refers_to) -> None:
        member = gzip.compress(warc_record(page_id, url, payload, digest, refers_to), 3, mtime=0)
        self.data.write(member)
        self.lines.append(json.dumps({"page_id": page_id, "offset": self.bytes, "length": len(member)}))
        self.bytes += len(member)

    def close(self) -> pa.RecordBatch:
        self.data.close()
        self.zip.writestr(INDEX, "\n".join(self.lines))
        self.zip.close()
        self.stream.close()
        return pa.record_batch([pa.array([self.uri]), pa.array([len(self.lines)], pa.int64()), pa.array([self.bytes], pa.int64())], names=["archive", "records", "bytes"])


def read_archives(spark: SparkSession, files: DataFrame, span_bytes: int = 1 << 22, keep_payload: bool = True) -> DataFrame:
    """Every record of the archives listed in files (archive, bytes): page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload.

    Directories and indexes are read first, a small row per record; the records are then read by range
    in tasks that each take spans of about span_bytes of neighbouring records, so a large archive is
    shared out. The number of tasks follows from the archives' bytes, not from the small rows of the index.
    """

    def index(batches):
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                system, path = _filesystem(uri)
                with system.open_input_file(path) as f:
                    members = zip_members(f, f.size())
                    base = members[DATA][0]
                    at, length = members[INDEX]
                    f.seek(at)
                    lines = [json.loads(x) for x in f.read(length).decode().split("\n") if x]
                yield pa.record_batch(
                    [pa.array([uri] * len(lines)), pa.array([base + x["offset"] for x in lines], pa.int64()), pa.array([x["length"] for x in lines], pa.int64())],
                    names=["archive", "offset", "length"],
                )

    def read(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, uri, f = [], None, None
            for archive, offset, length in sorted(zip(*(batch.column(k).to_pylist() for k in range(3)))):
                if archive != uri:
                    system, path = _filesystem(archive)
                    uri, f = archive, system.open_input_file(path)
                f.seek(offset)
                row = read_warc_record(gzip.decompress(f.read(length)))
                if not keep_payload:
                    del row["payload"]
                rows.append(row)
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema)

    fields = [("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]
    schema = pa.schema(fields + ([("payload", pa.binary())] if keep_payload else []))
    entries = files.select("archive").mapInArrow(index, "archive string, offset long, length long")
    tasks = max(1, -(-(files.agg(F.sum("bytes")).first()[0] or 0) // span_bytes))
    spread = entries.repartition(tasks, "archive", F.floor(F.col("offset") / span_bytes))
    out = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long" + (", payload binary" if keep_payload else "")
    return spread.mapInArrow(read, out)


def pages_through_archives(pages: DataFrame, folder: str | None = None, keep_payload: bool = False, **columns) -> DataFrame:
    """Write a record per page and read the archives back.

    A null html is an empty payload, a null url an empty URI; rows that repeat a page_id each keep their
    record, and of equal payloads all rows with the largest id are responses; rows without an id are
    left out; an empty table writes no archive and gives no rows. The folder defaults to a new one in
    the shared folder. Pages move only where the table of repeated payloads is too large to send whole.
    """
    import uuid

    spark = pages.sparkSession
    folder = folder or f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    folder = folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"
    return read_archives(spark, write_archives(mark_revisits(pages, **columns), folder), keep_payload=keep_payload)
