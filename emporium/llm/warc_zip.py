"""WARC records in ZIP-packaged archives: writer, and a reader that never extracts.

An archive is a ZIP file with two stored members: ``archive/data.warc.gz``,
one gzip member a record, and ``indexes/index.cdxj``, one line a record with
its offset and length in the first. The reader fetches the end of the file,
follows the (ZIP64) end records to the central directory, finds where the
members' bytes start, reads the index, and then range-reads single records,
many tasks to an archive.

Archives go to the shared folder through the file system that its address
names. A task's archives count only if the task's row is in the written list,
so files that lost or repeated attempts leave behind are never read.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
import zipfile
import zlib

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

#: Payload bytes after which a task starts the next archive.
ARCHIVE_BYTES = 128 << 20
#: Index lines whose records one reading task fetches at least from one stretch of an archive.
STRETCH_BYTES = 8 << 20
#: Parts into which pages of one payload are dealt when they are told which of them is the response.
SPREAD = 64
DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
DATE = "1970-01-01T00:00:00Z"  # the table has no time of capture
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = "urn:page:"


def file_system(path: str) -> tuple[pa.fs.FileSystem, str]:
    """File system and path of an address such as ``s3://...``, ``hdfs://...``, ``file:/...`` or a plain path."""
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    return pa.fs.FileSystem.from_uri(path)


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# --- records ------------------------------------------------------------------

def make_record(page_id, url, payload: bytes, size: int, sha1: str, refers_to) -> bytes:
    """One record, compressed. A revisit has no payload, only its size and digest."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    kind = "response" if refers_to is None else "revisit"
    block = http + payload if refers_to is None else http
    head = [("WARC-Type", kind), ("WARC-Record-ID", f"<{RECORD}{'null' if page_id is None else page_id}>"), ("WARC-Date", DATE)]
    if url is not None:
        head.append(("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")))
    head.append(("WARC-Payload-Digest", f"sha1:{sha1}"))
    if refers_to is not None:
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<{RECORD}{refers_to}>")]
    head += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    text = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n"
    z = zlib.compressobj(1, zlib.DEFLATED, 31)
    return z.compress(text.encode() + block + b"\r\n\r\n") + z.flush()


def _headers(block: bytes) -> dict:
    return {k.lower(): v for k, _, v in (line.partition(": ") for line in block.decode().split("\r\n")[1:])}


def _page(urn: str):
    name = urn.strip("<>").removeprefix(RECORD)
    return None if name == "null" else int(name)


def parse_record(data: bytes) -> dict:
    """Fields of a compressed record; the payload's digest is checked."""
    raw = zlib.decompress(data, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    if not head.startswith(b"WARC/1."):
        raise ValueError("not a WARC record")
    h = _headers(head)
    block = rest[:int(h["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    sha1 = h["warc-payload-digest"].removeprefix("sha1:")
    if h["warc-type"] == "response" and digest(payload) != sha1:
        raise ValueError(f"payload of {h['warc-record-id']} does not match its digest")
    return {"page_id": _page(h["warc-record-id"]), "url": h.get("warc-target-uri"), "record_type": h["warc-type"],
            "payload_bytes": len(payload) if h["warc-type"] == "response" else int(_headers(http)["content-length"]),
            "payload_digest": sha1, "refers_to": _page(h["warc-refers-to"]) if "warc-refers-to" in h else None,
            "payload": payload if h["warc-type"] == "response" else None}


# --- archives -----------------------------------------------------------------

class _Sink:
    """What ``zipfile`` needs of a stream that cannot seek."""

    def __init__(self, stream):
        self.stream = stream

    def write(self, data):
        self.stream.write(data)
        return len(data)

    def flush(self):
        pass


class ArchiveWriter:
    """One archive; records go straight to the stream, index lines wait in memory."""

    def __init__(self, path: str):
        self.path = path
        fs, name = file_system(path)
        self.stream = fs.open_output_stream(name)
        self.zip = zipfile.ZipFile(_Sink(self.stream), "w", zipfile.ZIP_STORED, allowZip64=True)
        self.data = self.zip.open(zipfile.ZipInfo(DATA), "w", force_zip64=True)
        self.offset, self.lines = 0, []

    def add(self, key: str, record: bytes) -> None:
        self.data.write(record)
        self.lines.append(f"{key} {json.dumps({'offset': self.offset, 'length': len(record)})}\n")
        self.offset += len(record)

    def close(self) -> tuple[str, int]:
        self.data.close()
        self.zip.writestr(zipfile.ZipInfo(INDEX), "".join(self.lines))
        self.zip.close()
        self.stream.close()
        return self.path, len(self.lines)


def read_directory(f, size: int) -> dict[str, tuple[int, int]]:
    """Offset and size of each stored member's bytes, from the central directory at the end of a file."""
    tail_at = max(0, size - (1 << 16) - 22)
    f.seek(tail_at)
    tail = f.read(size - tail_at)
    end = tail.rfind(b"PK\x05\x06")
    if end < 0:
        raise ValueError("no end of central directory")
    count, length, start = struct.unpack("<H2I", tail[end + 10:end + 20])
    if end >= 20 and tail[end - 20:end - 16] == b"PK\x06\x07":  # locator of the ZIP64 end record
        f.seek(struct.unpack("<Q", tail[end - 12:end - 4])[0])
        end64 = f.read(56)
        if end64[:4] != b"PK\x06\x06":
            raise ValueError("no ZIP64 end of central directory")
        count, length, start = struct.unpack("<3Q", end64[32:56])
    f.seek(start)
    directory, at, members = f.read(length), 0, {}
    for _ in range(count):
        if directory[at:at + 4] != b"PK\x01\x02":
            raise ValueError("broken central directory")
        method, packed, plain = struct.unpack("<H", directory[at + 10:at + 12])[0], *struct.unpack("<2I", directory[at + 20:at + 28])
        n_name, n_extra, n_comment = struct.unpack("<3H", directory[at + 28:at + 34])
        offset = struct.unpack("<I", directory[at + 42:at + 46])[0]
        name = directory[at + 46:at + 46 + n_name].decode()
        extra, k = directory[at + 46 + n_name:at + 46 + n_name + n_extra], 0
        while k + 4 <= len(extra):
            tag, n = struct.unpack("<2H", extra[k:k + 4])
            if tag == 1:  # ZIP64: the fields that did not fit, in this order
                wide = list(struct.unpack(f"<{n // 8}Q", extra[k + 4:k + 4 + n // 8 * 8]))
                plain = wide.pop(0) if plain == 0xFFFFFFFF else plain
                packed = wide.pop(0) if packed == 0xFFFFFFFF else packed
                offset = wide.pop(0) if offset == 0xFFFFFFFF else offset
            k += 4 + n
        if method != 0 or packed != plain:
            raise ValueError(f"{name} is not stored")
        f.seek(offset)
        local = f.read(30)
        members[name] = (offset + 30 + sum(struct.unpack("<2H", local[26:30])), plain)
        at += 46 + n_name + n_extra + n_comment
    return members


def read_index(path: str) -> list[tuple[int, int]]:
    """Offset in the file and length of every record of an archive."""
    fs, name = file_system(path)
    size = fs.get_file_info(name).size
    with fs.open_input_file(name) as f:
        members = read_directory(f, size)
        base, (at, n) = members[DATA][0], members[INDEX]
        f.seek(at)
        entries = [json.loads(line[line.index(" {") + 1:]) for line in f.read(n).decode().splitlines()]
    return [(base + e["offset"], e["length"]) for e in entries]


# --- jobs ---------------------------------------------------------------------

def with_revisits(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``id``, ``url``, ``html``, ``size``, ``sha1`` (hex) and ``refers_to``: the largest id of those with an equal payload, if that is another.

    Edge cases: a null html is an empty payload; a null id is smaller than
    every other, and pages of which none has an id are all responses; of rows
    that repeat the largest id all are responses; an empty table gives an
    empty result. A payload that fills a third of the table is dealt into
    ``SPREAD`` parts by id, each with its own copy of the answer.
    """
    p = pages.select(pages["page_id"].cast("long").alias("id"), pages["url"].cast("string").alias("url"),
                     F.coalesce(pages["html"].cast("string"), F.lit("")).alias("html"))
    body = F.encode("html", "UTF-8")
    p = p.withColumn("size", F.octet_length("html").cast("long")).withColumn("sha1", F.sha1(body))
    groups = C.written(p.where(F.col("size") >= least_bytes).groupBy("sha1").agg(F.max("id").alias("largest"), F.count("*").alias("n"))
                       .where("n > 1").select("sha1", "largest"), "warc-groups")
    other = F.col("largest").isNotNull() & ~F.col("largest").eqNullSafe(F.col("id"))
    spread = groups.withColumn("deal", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
    p = p.withColumn("deal", F.pmod(F.xxhash64("id"), F.lit(SPREAD)).cast("int"))
    return p.join(spread, ["sha1", "deal"], "left").select("id", "url", "html", "size", "sha1", F.when(other, F.col("largest")).alias("refers_to"))


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write one record for each page; returns the list of archives, ``path``, ``records`` and ``bytes``, itself written.

    Edge cases: a null url gives a record without one, line breaks in a url
    are escaped; rows that repeat an id get a record each; an empty table
    gives no archive. One payload is held whole in a worker, however long. A
    retried task writes archives of new names; only those of the attempt that
    succeeded are listed.
    """
    C.ship(pages.sparkSession)

    def run(batches):
        part, attempt = TaskContext.get().partitionId(), uuid.uuid4().hex[:12]
        writer, done, filled = None, [], 0
        for b in batches:
            for page_id, url, html, size, sha1, refers in zip(*(b.column(c).to_pylist() for c in ("id", "url", "html", "size", "sha1", "refers_to"))):
                if writer is None:
                    fs, name = file_system(folder)
                    fs.create_dir(name, recursive=True)
                    writer, filled = ArchiveWriter(f"{folder}/part-{part:05d}-{attempt}-{len(done)}.wacz"), 0
                key = base64.b32encode(bytes.fromhex(sha1)).decode()
                writer.add(f"{RECORD}{'null' if page_id is None else page_id}",
                           make_record(page_id, url, html.encode() if refers is None else b"", size, key, refers))
                filled += size
                if filled >= archive_bytes:
                    done.append((*writer.close(), writer.offset))
                    writer = None
        if writer is not None:
            done.append((*writer.close(), writer.offset))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done]), *(pa.array([d[k] for d in done], pa.int64()) for k in (1, 2))],
                                             names=["path", "records", "bytes"])

    return C.written(with_revisits(pages, least_bytes).mapInArrow(run, "path string, records long, bytes long"), "warc-list")


RECORDS = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long"


def read_archives(archives: DataFrame, payload: bool = True) -> DataFrame:
    """Every record of the listed archives, by range reads; with ``payload`` also its bytes (null for revisits).

    An archive's index is read by one task, its records by one task for each
    ``STRETCH_BYTES`` of all archives, about: the shuffle between moves places
    only, so its size says nothing about the bytes to be read and the number
    of tasks is stated. No archives give an empty result; an archive that
    lacks what its index names raises.
    """

    def indexes(batches):
        for b in batches:
            for path in b.column("path").to_pylist():
                at = read_index(path)
                yield pa.RecordBatch.from_arrays([pa.array([path] * len(at)), pa.array([a for a, _ in at], pa.int64()), pa.array([n for _, n in at], pa.int64())],
                                                 names=["path", "at", "length"])

    names = [x.split()[0] for x in RECORDS.split(", ")] + ["payload"] * payload
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]

    def records(batches):
        name, f = None, None
        for b in batches:
            rows = list(zip(*(b.column(c).to_pylist() for c in ("path", "at", "length"))))
            for i in range(0, len(rows), 256):
                out = []
                for path, at, length in rows[i:i + 256]:
                    if path != name:
                        fs, local = file_system(path)
                        name, f = path, fs.open_input_file(local)
                    f.seek(at)
                    out.append(parse_record(f.read(length)))
                yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in out], k) for n, k in zip(names, kinds)], names=names)

    size = archives.agg(F.count("*").alias("archives"), F.sum("bytes").alias("bytes")).first()
    tasks = max(1, -(-(size.bytes or 0) // STRETCH_BYTES))
    at = archives.select("path").repartition(max(1, min(size.archives, tasks)), F.col("path")).mapInArrow(indexes, "path string, at long, length long")
    stretch = F.floor(F.col("at") / STRETCH_BYTES)
    return (at.repartition(tasks, F.col("path"), stretch).sortWithinPartitions("path", "at")
            .mapInArrow(records, RECORDS + (", payload binary" if payload else "")))


def op8_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract of the registered query: pages written as archives and read back."""
    archives = write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), C.new_folder(spark, "warc"))
    return read_archives(archives, payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP8_SQL = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages
), d AS (SELECT page_id, sha1(html) AS h, CAST(strlen(html) AS BIGINT) AS n FROM p
), b AS (
  SELECT *, array_to_string(list_transform(range(1, 41), lambda i:
    ['0000','0001','0010','0011','0100','0101','0110','0111','1000','1001','1010','1011','1100','1101','1110','1111'][strpos('0123456789abcdef', h[i])]), '') AS bits
  FROM d
), e AS (
  SELECT *, array_to_string(list_transform(range(0, 32), lambda j: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[
    1 + 16 * CAST(bits[5 * j + 1] AS INT) + 8 * CAST(bits[5 * j + 2] AS INT) + 4 * CAST(bits[5 * j + 3] AS INT)
      + 2 * CAST(bits[5 * j + 4] AS INT) + CAST(bits[5 * j + 5] AS INT)]), '') AS payload_digest,
    max(page_id) OVER (PARTITION BY h) AS largest FROM b
)
SELECT page_id, n AS payload_bytes, payload_digest, CASE WHEN page_id = largest THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> largest THEN largest END AS refers_to
FROM e
"""
