"""Helpers shared by the operators: flat word splitting, hashing, blocks and the shard exchange.

Word counts over a corpus do not fit on one machine and a row per word is too
many rows to shuffle. The operators that need them (`lm_score`,
`substring_dedup`) therefore work in *blocks* and *shards*:

* a block is a few MB of documents, picked by a hash of the row, so its
  content does not depend on file layout or task order;
* each block sends every shard one row: its sorted distinct keys of that
  shard, delta-coded, with their local statistics;
* a shard merges what all blocks sent and answers each block, key by key.

A key that fills a third of the corpus costs one entry per block, so hot keys
need no special case, and nothing is ever gathered on the driver.
"""

from __future__ import annotations

import ctypes
import io
import math
import os
import time
import uuid
import zipfile
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emporium.operators.fs import delete_paths
from emporium.session import ensure_checkpoint_dir

#: White space of the word rule ``[^\x20\x09-\x0D]+``; ``bytes.split()`` splits at the same six bytes.
SPACES = b" \t\n\x0b\x0c\r"
IS_WORD = np.ones(256, bool)
IS_WORD[list(SPACES)] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes of text split and hashed at once; keeps the working arrays in cache.
SLICE_BYTES = 1 << 20
#: Text bytes of one block: about 1.3 million words, some 200 MB of arrays at the peak.
BLOCK_BYTES = 8 << 20
NULL_ID = np.iinfo(np.int64).max

U64 = np.uint64


#: Size of the batches between Spark and its Python workers. The defaults are meant for narrow rows; of texts,
#: each batch would be held several times over, in the JVM and in the worker, at tens of MB.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2500", "spark.sql.execution.arrow.maxBytesPerBatch": "8m"}

# --- Spark side -------------------------------------------------------------

def ship(spark: SparkSession) -> None:
    """Prepare a session: batch sizes that suit texts, and this package, as a zip in the shared folder, for Python
    workers that do not run in the repository's folder."""
    sc = spark.sparkContext
    for name, value in BATCHES.items():
        spark.conf.set(name, value)
    if getattr(sc, "_emporium_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if os.path.isdir(root):
        data = io.BytesIO()
        with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as z:
            for folder, _, names in os.walk(root):
                for name in names:
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        z.write(full, os.path.relpath(full, os.path.dirname(root)))
        path = f"{new_folder(spark, 'package')}/emporium_pkg.zip"
        jvm = sc._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        stream = target.getFileSystem(sc._jsc.hadoopConfiguration()).create(target)
        try:
            stream.write(bytearray(data.getvalue()))
        finally:
            stream.close()
        sc.addPyFile(path)
    sc._emporium_shipped = True


#: Folders that this driver has named, in order.
_FOLDERS: list[str] = []


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared checkpoint folder."""
    _FOLDERS.append(f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}")
    return _FOLDERS[-1]


def folders() -> list[str]:
    """Folders named so far, apart from those of the shipped package; the last is the newest."""
    return [f for f in _FOLDERS if "/package-" not in f]


def drop_folders(spark: SparkSession, paths: list[str]) -> None:
    """Delete tables on the way that nothing will read again."""
    delete_paths(spark, paths)
    _FOLDERS[:] = [f for f in _FOLDERS if f not in set(paths)]


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: cuts lineage, survives lost executors."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def as_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id (long) and the text (null as empty), under fixed names; other columns cannot clash."""
    return docs.select(docs[id_col].cast("long").alias("id"),
                       F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))


def block_count(docs: DataFrame, block_bytes: int) -> int:
    """Number of blocks: total text bytes over ``block_bytes``, and at least two for each core of a small cluster."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    cores = min(16, docs.sparkSession.sparkContext.defaultParallelism)
    return max(math.ceil(total / block_bytes), 2 * cores if total > 1 << 20 else 2)


def with_blocks(docs: DataFrame, blocks: int) -> DataFrame:
    """Add the column ``block``. Id and text decide, so rows that repeat one id spread out too."""
    key = F.xxhash64("id", "text")
    return docs.withColumn("block", F.pmod(key, F.lit(blocks)).cast("int"))


def power_of_two(x: float) -> int:
    """Smallest exponent e >= 0 with 2**e >= x."""
    return max(0, math.ceil(math.log2(max(x, 1))))


# --- memory of Python workers ---------------------------------------------------

_TRIMMED = [0.0]


def trim(at_once: bool = False) -> None:
    """Hand memory that earlier batches or groups of this worker have freed back to the system.

    Workers live through many tasks; without this, the allocators of Arrow
    and libc keep the largest of them for good.
    """
    now = time.monotonic()
    if not at_once and now - _TRIMMED[0] < 0.1:
        return
    _TRIMMED[0] = now
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another libc
        pass


def of_group(f):
    """``f`` of a group's table; what it used goes back to the system before the worker waits for the next."""
    def run(table):
        out = f(table)
        trim(True)
        return out
    return run


def of_groups(f):
    """As :func:`of_group`, of the tables of two cogrouped sides."""
    def run(left, right):
        out = f(left, right)
        trim(True)
        return out
    return run


def of_batches(f):
    """As :func:`of_group`, of a task's batches."""
    def run(batches):
        yield from f(batches)
        trim(True)
    return run


# --- words of an Arrow column -------------------------------------------------

def flat(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all strings and the offsets of each; null counts as empty."""
    trim()
    arr = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(arr, pa.ChunkedArray):
        arr = pa.concat_arrays(arr.chunks) if arr.num_chunks else pa.array([], arr.type)
    arr = pc.fill_null(arr, "").cast(pa.large_string())
    off = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset:arr.offset + len(arr) + 1]
    if len(arr) == 0 or arr.buffers()[2] is None:
        return np.empty(0, np.uint8), np.zeros(len(arr) + 1, np.int64)
    return np.frombuffer(arr.buffers()[2], np.uint8)[off[0]:off[-1]], off - off[0]


def slices(off: np.ndarray, size: int = SLICE_BYTES):
    """(first, last) document ranges of about ``size`` bytes; a longer document is a range of its own."""
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + size, "right")) - 1)
        yield i, j
        i = j


def word_bounds(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the index of each document's first word (one more entry at the end)."""
    word = IS_WORD[buf]
    first = word.copy()
    first[1:] &= ~word[:-1]
    last = word.copy()
    last[:-1] &= ~word[1:]
    cut = off[1:-1]
    cut = cut[(cut > 0) & (cut < len(buf))]
    first[cut] = word[cut]
    last[cut - 1] = word[cut - 1]
    start = np.flatnonzero(first)
    return start, np.flatnonzero(last) + 1, np.searchsorted(start, off)


def _table(seed: int) -> np.ndarray:
    t = np.random.Generator(np.random.PCG64(seed)).integers(1, 1 << 63, 256, dtype=np.int64).astype(U64)
    t = t * U64(2) + U64(1)
    t[list(SPACES)] = 0
    return t


TABLES = (_table(11), _table(12))
BASES = (U64(0x9E3779B97F4A7C15), U64(0xC2B2AE3D27D4EB4F))


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (bijective)."""
    h = h ^ (h >> U64(30))
    h = h * U64(0xBF58476D1CE4E5B9)
    h ^= h >> U64(27)
    h *= U64(0x94D049BB133111EB)
    h ^= h >> U64(31)
    return h


def powers(n: int, base: np.uint64) -> np.ndarray:
    p = np.full(max(n, 1), base, U64)
    p[0] = 1
    return np.cumprod(p, dtype=U64)


def hash_words(buf: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hash of each word's bytes."""
    if not len(start):
        return np.empty(0, U64)
    lo, hi = int(start[0]), int(end[-1])
    gaps = np.diff(np.append(start, hi))
    pos = np.arange(lo, hi) - np.repeat(start, gaps)
    terms = TABLES[seed][buf[lo:hi]] * powers(int(gaps.max()), BASES[seed])[pos]
    return mix(np.add.reduceat(terms, start - lo) + (end - start).astype(U64))


class Words(NamedTuple):
    """Words of a column: hashes (one array per seed) and the index of each document's first word."""
    hashes: list
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def document(self) -> np.ndarray:
        """Document index of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def words(column, lower: bool = False, seeds=(0,)) -> Words:
    """Split and hash the words ``[^\\x20\\x09-\\x0D]+`` of a string column, slice by slice."""
    buf, off = flat(column)
    found, counts = [[] for _ in seeds], [np.zeros(0, np.int64)]
    for i, j in slices(off):
        part = buf[off[i]:off[j]]
        if lower:
            part = LOWER[part]
        start, end, first = word_bounds(part, off[i:j + 1] - off[i])
        for k, seed in enumerate(seeds):
            found[k].append(hash_words(part, start, end, seed))
        counts.append(np.diff(first))
    per_doc = np.concatenate(counts)
    return Words([np.concatenate(x) if x else np.empty(0, U64) for x in found],
                 np.concatenate([[0], np.cumsum(per_doc)]).astype(np.int64))


def windows(hashes: np.ndarray, first: np.ndarray, k: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``k`` words inside one document, and the index of its first word."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.empty(0, U64), np.empty(0, np.int64)
    p = powers(k + 1, BASES[1 - seed])
    acc = hashes[:n] * p[1]
    for j in range(1, k):
        acc += hashes[j:j + n] * p[j + 1]
    ends = np.repeat(first[1:], np.diff(first))[:n]
    at = np.flatnonzero(np.arange(k, n + k) <= ends)
    return mix(acc[at]), at


# --- compact arrays in binary cells --------------------------------------------

_CODEC = None


def _codec():
    global _CODEC
    if _CODEC is None:
        _CODEC = pa.Codec("zstd", compression_level=1)
    return _CODEC


def pack(a: np.ndarray) -> bytes:
    """Integers as byte planes, each compressed: high bytes of small numbers cost next to nothing."""
    a = np.ascontiguousarray(a)
    width = a.dtype.itemsize
    if not len(a):
        return bytes([width]) + (0).to_bytes(8, "little")
    planes = np.ascontiguousarray(a.view(np.uint8).reshape(-1, width).T)
    used = width
    while used > 1 and not planes[used - 1].any():
        used -= 1
    parts = [bytes([width, used]) + len(a).to_bytes(8, "little")]
    for plane in planes[:used]:
        z = _codec().compress(plane.tobytes(), asbytes=True)
        parts += [len(z).to_bytes(4, "little"), z]
    return b"".join(parts)


def unpack(b: bytes, dtype) -> np.ndarray:
    """Inverse of :func:`pack`."""
    width = b[0]
    if len(b) == 9:
        return np.empty(0, dtype)
    used, n, at = b[1], int.from_bytes(b[2:10], "little"), 10
    planes = np.zeros((width, n), np.uint8)
    for k in range(used):
        size = int.from_bytes(b[at:at + 4], "little")
        planes[k] = np.frombuffer(_codec().decompress(b[at + 4:at + 4 + size], decompressed_size=n, asbytes=True), np.uint8)
        at += 4 + size
    return np.ascontiguousarray(planes.T).reshape(-1).view(dtype)


def pack_sorted(a: np.ndarray) -> bytes:
    """Ascending unsigned integers as differences."""
    a = a.astype(U64, copy=False)
    return pack(np.diff(a, prepend=U64(0)) if len(a) else a)


def unpack_sorted(b: bytes) -> np.ndarray:
    return np.cumsum(unpack(b, U64), dtype=U64)


def pack_parts(*parts: bytes) -> bytes:
    return b"".join(x for p in parts for x in (len(p).to_bytes(4, "little"), p))


def unpack_parts(b: bytes) -> list[bytes]:
    out, at = [], 0
    while at < len(b):
        n = int.from_bytes(b[at:at + 4], "little")
        out.append(b[at + 4:at + 4 + n])
        at += 4 + n
    return out


# --- the exchange ---------------------------------------------------------------

MESSAGE = "shard int, block int, payload binary"
MESSAGE_ARROW = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("payload", pa.binary())])


def messages(rows: list[tuple[int, int, bytes]]) -> pa.Table:
    s, b, p = zip(*rows) if rows else ((), (), ())
    return pa.table([pa.array(s, pa.int32()), pa.array(b, pa.int32()), pa.array(p, pa.binary())], schema=MESSAGE_ARROW)


def received(table: pa.Table) -> list[tuple[int, int, bytes]]:
    """Rows of a message table, ordered by (shard, block)."""
    trim()
    cols = [table.column(n).to_pylist() for n in ("shard", "block", "payload")]
    return sorted(zip(*cols), key=lambda r: r[:2])


def by_shard(keys: np.ndarray, bits: int, total_bits: int = 64) -> np.ndarray:
    """Bounds of each shard in ascending ``keys``: the shard is the top ``bits`` of ``total_bits``."""
    if bits == 0:
        return np.array([0, len(keys)])
    edges = (np.arange(1, 1 << bits, dtype=U64) << U64(total_bits - bits))
    return np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]])


def ordered_block(table: pa.Table) -> pa.Table:
    """Rows of a block in a fixed order, whatever order the shuffle brought them in."""
    return table.sort_by([("id", "ascending"), ("text", "ascending")])


def ids_of(table: pa.Table) -> np.ndarray:
    """Ids of a block; a null id counts as larger than every other."""
    return pc.fill_null(table.column("id"), int(NULL_ID)).to_numpy().astype(np.int64)
