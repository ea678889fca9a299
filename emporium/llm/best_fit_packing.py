"""Tokenise documents and pack them into sequences by best-fit decreasing.

Tokens come from a public tokenizer file. Its words end at white space, so a
document's ids are its words' ids one after the other; each task encodes a
word once, keeps it in a bounded cache, and puts the documents together with
numpy. (Documents that spell a special token are encoded whole.)

Packing deals the pieces out by hash into groups of some thousand, each with
the same mix of lengths, and packs each group on its own: longest first, into
the open sequence with the least room that still fits. A segment tree over
the remaining capacities finds it in log2(capacity) steps. A group leaves at
most a few sequences half empty, so the loss against one global packing is a
small part of a percent, and no task ever sees more than one group.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

CAPACITY = 2048
END_ID = 0
GROUP_PIECES = 16384
#: Words whose ids a Python worker keeps, in flat arrays: some 40 MB at the most.
CACHE_WORDS = 1 << 20
VOCABULARY = "word_bpe_49k.json"

_TOKENIZERS: dict = {}


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class WordEncoder:
    """Ids of texts, word by word, with a cache of words' ids."""

    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.limit = cache_words
        self._forget()

    def _forget(self) -> None:
        """The cache: ascending word hashes, and where each word's ids begin in one table and how many they are."""
        self.keys = np.empty(0, np.uint64)
        self.begin, self.size, self.table = np.empty(0, np.int64), np.empty(0, np.int32), np.empty(0, np.uint32)

    def word(self, w: str) -> np.ndarray:
        t = self.tokenizer
        pieces = t.pre_tokenizer.pre_tokenize_str(t.normalizer.normalize_str(w))
        return np.array([x.id for p, _ in pieces for x in t.model.tokenize(p)], np.uint32)

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def encode(self, column) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts after each other, and the offsets of each text."""
        buf, off = C.flat(column)
        parts, counts = [], []
        for i, j in C.slices(off, 4 << 20):
            ids, n = self._slice(C.LOWER[buf[off[i]:off[j]]], off[i:j + 1] - off[i], buf[off[i]:off[j]])
            parts.append(ids)
            counts.append(n)
        n = np.concatenate(counts) if counts else np.empty(0, np.int64)
        return (np.concatenate(parts) if parts else np.empty(0, np.uint32)), np.concatenate([[0], np.cumsum(n)]).astype(np.int64)

    def _slice(self, low: np.ndarray, off: np.ndarray, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        start, end, first = C.word_bounds(low, off)
        h = np.concatenate([C.hash_words(low, start[a:b], end[a:b]) for a, b in _runs(len(start))]) if len(start) else np.empty(0, np.uint64)
        keys, at, inverse = np.unique(h, return_index=True, return_inverse=True)
        if len(self.keys) + len(keys) > self.limit:
            self._forget()
        place = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        inside = place < len(self.keys)
        known[inside] = self.keys[place[inside]] == keys[inside]
        new, data = np.flatnonzero(~known), low.tobytes()
        if len(new):
            found = [self.word(data[a:z].decode()) for a, z in zip(start[at[new]].tolist(), end[at[new]].tolist())]
            size = np.array([len(x) for x in found], np.int32)
            begin = len(self.table) + np.cumsum(size, dtype=np.int64) - size
            self.table = np.concatenate([self.table, *found])
            self.keys, self.begin, self.size = (np.insert(old, place[new], fresh) for old, fresh in (
                (self.keys, keys[new]), (self.begin, begin), (self.size, size)))
        place = np.searchsorted(self.keys, keys)
        table, begin, sizes = self.table, self.begin[place], self.size[place].astype(np.int64)
        each = sizes[inverse]
        total = np.concatenate([[0], np.cumsum(each)])
        ids = table[np.repeat(begin[inverse] - total[:-1], each) + np.arange(total[-1])]
        n = total[first[1:]] - total[first[:-1]]
        text = raw.tobytes()
        if b"<|" in text:
            docs = np.split(ids, np.cumsum(n)[:-1])
            for d in range(len(n)):
                if b"<|" in text[off[d]:off[d + 1]]:
                    docs[d] = self.whole(text[off[d]:off[d + 1]].decode())
            ids, n = np.concatenate(docs), np.array([len(x) for x in docs], np.int64)
        return ids, n


def _runs(n: int, size: int = 1 << 18):
    return [(a, min(n, a + size)) for a in range(0, n, size)]


def encoder(path: str) -> WordEncoder:
    """The worker's encoder; it stays between batches and tasks."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordEncoder(path)
    return _TOKENIZERS[path]


def _pieces(batches, path: str, capacity: int, end_id: int, keep_ids: bool):
    enc = encoder(path)
    for batch in batches:
        ids, off = enc.encode(batch.column("text"))
        raw = batch.column("id").to_pylist()
        rows: list = []
        for d, doc in enumerate(raw):
            x = np.append(ids[off[d]:off[d + 1]], np.uint32(end_id)).astype("<u4")
            for k, a in enumerate(range(0, len(x), capacity)):
                part = x[a:a + capacity]
                rows.append((doc, k, a, len(part), zlib.crc32(part.tobytes()), part if keep_ids else None))
        cols = list(zip(*rows)) if rows else [()] * 6
        arrays = [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()), *(pa.array(c, pa.int64()) for c in cols[2:5])]
        names = ["id", "piece", "start", "length", "ids_crc32"]
        if keep_ids:
            arrays.append(pa.array([p.astype(np.int32) for p in cols[5]], pa.list_(pa.int32())))
            names.append("ids")
        yield pa.RecordBatch.from_arrays(arrays, names=names)


def token_pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID,
                 keep_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Token ids of each document, ``end_id`` after them, cut into pieces of at most ``capacity``.

    Returns per piece ``id``, ``piece`` (from 0), ``start``, ``length``,
    ``ids_crc32`` (of the little-endian 32-bit ids) and, with ``keep_ids``,
    the ids. A null or empty text is one piece that holds only ``end_id``.
    """
    C.ship(docs.sparkSession)
    path = path or vocabulary_path()
    schema = "id long, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if keep_ids else "")
    return C.as_documents(docs, id_col, text_col).mapInArrow(
        C.of_batches(lambda batches: _pieces(batches, path, capacity, end_id, keep_ids)), schema)


def best_fit_decreasing(lengths, capacity: int = CAPACITY) -> tuple[list[int], list[int]]:
    """Bin and offset of each length, which must come longest first and be at most ``capacity``."""
    leaves = 1 << C.power_of_two(capacity + 1)
    tree = [0] * (2 * leaves)  # open bins below each node; leaf r: bins with room r
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins, offsets, n = [], [], 0
    for size in lengths:
        i = leaves + size
        while i > 1 and not tree[i]:  # up to the first subtree at or right of this room that has a bin
            while i > 1 and i & 1:
                i >>= 1
            i = i + 1 if i > 1 else 1
            if i == 1:
                break
        if i > 1:
            while i < leaves:
                i = 2 * i if tree[2 * i] else 2 * i + 1
            room = i - leaves
            b = open_bins[room].pop()
            while i:
                tree[i] -= 1
                i >>= 1
        else:
            room, b, n = capacity, n, n + 1
        bins.append(b)
        offsets.append(capacity - room)
        if room > size:
            open_bins[room - size].append(b)
            i = leaves + room - size
            while i:
                tree[i] += 1
                i >>= 1
    return bins, offsets


def _pack_group(table: pa.Table, capacity: int) -> pa.Table:
    table = table.sort_by([("length", "descending"), ("id", "ascending"), ("piece", "ascending"), ("ids_crc32", "ascending")])
    bins, offsets = best_fit_decreasing(table.column("length").to_pylist(), capacity)
    group = table.column("group")[0].as_py()
    out = table.drop_columns(["group"])
    out = out.append_column("sequence_id", pa.array((np.int64(group) << 32) + np.array(bins, np.int64)))
    return out.append_column("offset", pa.array(offsets, pa.int64()))


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to the rows of :func:`token_pieces`.

    The pieces are written once to the shared folder, so that counting them
    does not tokenise twice. Reruns give the same packing: groups come from a
    hash, ties in length go by id and piece. An empty table packs to none.
    """
    pieces = C.written(pieces, "pieces")
    groups = max(1, math.ceil(pieces.count() / group_pieces))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema) + ", sequence_id long, offset long"
    return (pieces.withColumn("group", F.pmod(F.xxhash64("id", "piece"), F.lit(groups)).cast("int"))
            .groupBy("group").applyInArrow(C.of_group(lambda t: _pack_group(t, capacity)), schema))


def op9_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    """Contract of the registered query: the pieces of all documents and their place."""
    return packed_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def packed_documents(docs: DataFrame) -> DataFrame:
    return pack_pieces(token_pieces(docs)).withColumnRenamed("id", "doc_id")
