"""Exact removal of repeated passages behind a count-min prefilter.

A window is ``window`` consecutive words of one document. A word goes if some
window that covers it also starts in a document with a smaller id.

1. Every block of documents sketches its windows: two rows of counters,
   of which it sends only the non-zero cells. Shards add the sketches of all
   blocks up and tell each block which of its cells reach two. The sketch has
   ``cells_per_window`` counters a window, so it grows with the corpus; an
   estimate is never too low, so no repeated window is missed.
2. Windows estimated repeated (and only those) are grouped exactly, by a
   128-bit fingerprint of their words: each block sends a fingerprint once,
   with the smallest id that has it there; shards answer whether some other
   block has a smaller one.
3. Blocks mark and drop the covered words.

The text is shuffled once (all three steps reuse the exchange by block); the
messages hold a few bytes a window. A passage that a third of all documents
share is one entry per block.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common as C

WINDOW = 13
ROWS = 2
CELLS_PER_WINDOW = 8
#: Entries that one shard merges at once.
SHARD_ENTRIES = 1 << 21
ROW_MULTIPLIERS = (np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F))


def _cells(h: np.ndarray, row: int, cell_bits: int) -> np.ndarray:
    return C.mix(h * ROW_MULTIPLIERS[row]) >> np.uint64(64 - cell_bits)


def _sketch(table: pa.Table, window: int, cell_bits: int, shard_bits: int) -> pa.Table:
    """One message per row and shard: the block's cells, and which of them it alone brings to two."""
    table = C.ordered_block(table)
    w = C.words(table.column("text"))
    h, _ = C.windows(w.hashes[0], w.first, window)
    block, rows = table.column("block")[0].as_py(), []
    for r in range(ROWS):
        cells, n = np.unique(_cells(h, r, cell_bits), return_counts=True)
        edges = C.by_shard(cells, shard_bits, cell_bits)
        for s, (a, b) in enumerate(zip(edges, edges[1:])):
            if b > a:
                rows.append(((r << shard_bits) + s, block,
                             C.pack_parts(C.pack_sorted(cells[a:b]), np.packbits(n[a:b] > 1).tobytes())))
    return C.messages(rows)


def _merge_sketches(table: pa.Table, cell_bits: int, shard_bits: int) -> pa.Table:
    """Add the sketches of one shard up (counters stop at two) and answer each block's cells in their order."""
    width = 1 << (cell_bits - shard_bits)
    counters = np.zeros(width, np.uint8)
    asked = []
    for shard, block, payload in C.received(table):
        cells, twice = C.unpack_parts(payload)
        at = (C.unpack_sorted(cells) & np.uint64(width - 1)).astype(np.int64)
        counters[at] = np.minimum(counters[at] + 1 + np.unpackbits(np.frombuffer(twice, np.uint8), count=len(at)), 2)
        asked.append((shard, block, at))
    return C.messages([(s, b, C.pack_parts(len(at).to_bytes(8, "little"), np.packbits(counters[at] > 1).tobytes()))
                       for s, b, at in asked])


def _answers(replies: list[tuple[int, int, bytes]]) -> np.ndarray:
    bits = []
    for _, _, payload in replies:
        n, b = C.unpack_parts(payload)
        bits.append(np.unpackbits(np.frombuffer(b, np.uint8), count=int.from_bytes(n, "little")).astype(bool))
    return np.concatenate(bits) if bits else np.empty(0, bool)


def _distinct(h: np.ndarray, h2: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of windows by fingerprint then id; the start of each fingerprint in it; the group of each ordered window."""
    order = np.lexsort((ids, h2, h))
    new = np.ones(len(h), bool)
    new[1:] = (np.diff(h[order]) != 0) | (np.diff(h2[order]) != 0)
    return order, np.flatnonzero(new), np.cumsum(new) - 1


def _suspects(table: pa.Table, replies: pa.Table, window: int, cell_bits: int, shard_bits: int, exact_bits: int) -> pa.Table:
    """Fingerprints of the windows estimated repeated, with their smallest id here; and a note of these windows to the block itself."""
    if not table.num_rows:
        return C.messages([])
    table = C.ordered_block(table)
    w = C.words(table.column("text"), seeds=(0, 1))
    h, at = C.windows(w.hashes[0], w.first, window)
    block, got = table.column("block")[0].as_py(), C.received(replies)
    repeated = np.ones(len(h), bool)
    for r in range(ROWS):
        _, inverse = np.unique(_cells(h, r, cell_bits), return_inverse=True)
        bits = _answers([x for x in got if x[0] >> shard_bits == r])
        repeated &= bits[inverse]
    at = at[repeated]
    h2, at2 = C.windows(w.hashes[1], w.first, window, seed=1)
    h, h2 = h[repeated], h2[np.searchsorted(at2, at)]
    ids = C.ids_of(table)[w.document()[at]]
    order, starts, _ = _distinct(h, h2, ids)
    keys, keys2, least = h[order][starts], h2[order][starts], ids[order][starts]
    edges = C.by_shard(keys, exact_bits)
    rows = [(s, block, C.pack_parts(C.pack_sorted(keys[a:b]), C.pack(keys2[a:b]), C.pack(least[a:b])))
            for s, (a, b) in enumerate(zip(edges, edges[1:])) if b > a]
    # a shard of its own, which only hands the note on
    rows.append(((1 << exact_bits) + block, block, C.pack(np.packbits(repeated))))
    return C.messages(rows)


def _smallest(table: pa.Table, exact_bits: int) -> pa.Table:
    """Per fingerprint of a shard the smallest id of all blocks; each block learns where that is below its own."""
    got = C.received(table)
    if not got or got[0][0] >= 1 << exact_bits:
        return C.messages(got)
    parts = [C.unpack_parts(p) for _, _, p in got]
    keys = [C.unpack_sorted(p[0]) for p in parts]
    least = np.concatenate([C.unpack(p[2], np.int64) for p in parts])
    order, starts, group = _distinct(np.concatenate(keys), np.concatenate([C.unpack(p[1], np.uint64) for p in parts]), least)
    below = np.empty(len(least), bool)
    below[order] = least[order][starts][group] < least[order]
    bounds = np.cumsum([0] + [len(k) for k in keys])
    return C.messages([(s, b, C.pack_parts((z - a).item().to_bytes(8, "little"), np.packbits(below[a:z]).tobytes()))
                       for (s, b, _), a, z in zip(got, bounds, bounds[1:])])


def _remove(table: pa.Table, replies: pa.Table, window: int, exact_bits: int, as_is: bool, schema: pa.Schema) -> pa.Table:
    """Drop the covered words of a block's documents."""
    if not table.num_rows:
        return schema.empty_table()
    table = C.ordered_block(table)
    w = C.words(table.column("text"), seeds=(0, 1))
    h, at = C.windows(w.hashes[0], w.first, window)
    h2, at2 = C.windows(w.hashes[1], w.first, window, seed=1)
    got = C.received(replies)
    note = np.unpackbits(C.unpack(got[-1][2], np.uint8), count=len(at)).astype(bool)
    at = at[note]
    h, h2 = h[note], h2[np.searchsorted(at2, at)]
    ids = C.ids_of(table)[w.document()[at]]
    order, starts, group = _distinct(h, h2, ids)
    elsewhere = _answers(got[:-1])
    gone = np.empty(len(at), bool)
    gone[order] = elsewhere[group] | (ids[order] > ids[order][starts][group])
    step = np.zeros(len(w.hashes[0]) + window + 1, np.int32)
    np.add.at(step, at[gone], 1)
    np.add.at(step, at[gone] + window, -1)
    covered = np.cumsum(step)[:len(w.hashes[0])] > 0
    total = np.concatenate([[0], np.cumsum(covered)])
    removed = total[w.first[1:]] - total[w.first[:-1]]
    buf, off = C.flat(table.column("text"))
    data, kept = buf.tobytes(), []
    for d, n in enumerate(removed):
        if as_is and not n:
            kept.append(data[off[d]:off[d + 1]])
            continue
        tokens = data[off[d]:off[d + 1]].split()
        if n:
            drop = covered[w.first[d]:w.first[d + 1]]
            tokens = [t for t, x in zip(tokens, drop) if not x]
        kept.append(b" ".join(tokens))
    cols = {"id": table.column("id"), "n_words": pa.array(w.counts, pa.int64()), "n_removed": pa.array(removed, pa.int64()),
            "kept_text": pa.array(kept, pa.binary()).cast(pa.string())}
    if "carried" in schema.names:
        cols["carried"] = table.column("carried")
    return pa.table([cols[n] for n in schema.names], names=schema.names)


def remove_repeated(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
                    carry: Sequence[str] = (), as_is: bool = False, cells_per_window: int = CELLS_PER_WINDOW,
                    block_bytes: int = C.BLOCK_BYTES, shard_entries: int = SHARD_ENTRIES) -> DataFrame:
    """Drop every word covered by a ``window``-word run that also starts in a document with a smaller id.

    Returns one row per input row: ``id``, ``n_words``, ``n_removed``,
    ``kept_text`` (kept words joined by one space; with ``as_is``, a text that
    loses nothing stays as it is) and, with ``carry``, a struct ``carried`` of
    the named input columns.

    Edge cases: a null text counts as empty and gives "" with zero words; a
    null id is larger than every other, so it loses its copies to any other
    document; rows with equal ids do not remove each other's words; a document
    of fewer than ``window`` words loses nothing; an empty table gives none.
    """
    C.ship(docs.sparkSession)
    base = C.as_documents(docs, id_col, text_col)
    blocks = C.block_count(base, block_bytes)
    if carry:
        base = docs.select(docs[id_col].cast("long").alias("id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"),
                           F.struct(*[docs[c].alias(c) for c in carry]).alias("carried"))
    # an upper estimate of the corpus' windows: no word is shorter than a letter and a space, most are longer than four
    n = blocks * block_bytes / 5
    shard_bits = C.power_of_two(n / shard_entries)
    cell_bits = max(shard_bits + 3, C.power_of_two(n * cells_per_window))
    exact_bits = max(0, shard_bits - 1)
    placed = C.with_blocks(base, blocks).groupBy("block")

    sketches = placed.applyInArrow(C.of_group(lambda t: _sketch(t, window, cell_bits, shard_bits)), C.MESSAGE)
    merged = sketches.groupBy("shard").applyInArrow(C.of_group(lambda t: _merge_sketches(t, cell_bits, shard_bits)), C.MESSAGE)
    suspects = placed.cogroup(merged.groupBy("block")).applyInArrow(
        C.of_groups(lambda a, b: _suspects(a, b, window, cell_bits, shard_bits, exact_bits)), C.MESSAGE)
    smallest = suspects.groupBy("shard").applyInArrow(C.of_group(lambda t: _smallest(t, exact_bits)), C.MESSAGE)

    fields = [T.StructField("id", T.LongType()), T.StructField("n_words", T.LongType()),
              T.StructField("n_removed", T.LongType()), T.StructField("kept_text", T.StringType())]
    arrow = [("id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_text", pa.string())]
    if carry:
        from pyspark.sql.pandas.types import to_arrow_type

        kind = base.schema["carried"].dataType
        fields.append(T.StructField("carried", kind))
        arrow.append(("carried", to_arrow_type(kind)))
    schema = pa.schema(arrow)
    return placed.cogroup(smallest.groupBy("block")).applyInArrow(
        C.of_groups(lambda a, b: _remove(a, b, window, exact_bits, as_is, schema)), T.StructType(fields))


def op3_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """Contract of the registered query: per document the words removed and a digest of what is kept."""
    out = remove_repeated(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select(F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2(F.encode("kept_text", "UTF-8"), 256).alias("kept_sha256"))


OP3_SQL = r"""
WITH w AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents
), win AS (
  SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w WHERE len(ws) >= 13)
), gone AS (
  SELECT DISTINCT doc_id, i + unnest(range(0, 13)) AS pos
  FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY g) AS least FROM win) WHERE least < doc_id
), lost AS (SELECT doc_id, list(pos) AS ps, count(*) AS n FROM gone GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(CASE WHEN n IS NULL THEN array_to_string(ws, ' ')
              ELSE array_to_string(list_filter(ws, lambda x, k: NOT list_contains(ps, k)), ' ') END) AS kept_sha256
FROM w LEFT JOIN lost USING (doc_id)
"""
