"""Fill-in-the-middle documents, cut through memoized content-defined chunks.

A document is cut at two code points into prefix, middle and suffix, which
are put into another order between markers. Where a code point lies in the
UTF-8 bytes is found through chunks:

* a rolling hash over 16 bytes ends a chunk wherever its high bits are zero,
  so a passage that many documents share falls into the same chunks in all;
* a chunk's *boundary summary* is what its place in any text depends on: how
  many code points begin in it, whether it holds a marker, and its outermost
  two bytes, as a marker may lie across a boundary. Each worker keeps the
  summaries of the chunks it has met, under the chunks' whole content, so a
  hit is a verified one; a full cache starts again from empty;
* summaries combine from left to right: their counts lead to the chunk that
  holds a cut, and only that chunk is searched.

The work is one pass over the rows, without a shuffle; the cuts depend on the
id and the number of code points only, so retried tasks give the same rows.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from itertools import accumulate
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as C

SEED = "1"
#: Percent of documents that are transformed, and of these the percent whose suffix comes first.
RATE, SUFFIX_FIRST = 90, 20
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKERS = tuple(m.encode() for m in (PREFIX, SUFFIX, MIDDLE))
#: A chunk ends where the rolling hash over 16 bytes has this many leading zero bits: about every 512 bytes.
CUT_BITS = 9
LONGEST_CHUNK = 1 << 13
#: Bytes of chunks whose summaries one worker keeps.
CACHE_BYTES = 16 << 20
SCHEMA = "id long, n long, form string, prefix_chars long, middle_chars long, output string"


class Summary(NamedTuple):
    """What a chunk adds to any text it stands in."""
    points: int
    marked: bool
    head: bytes
    tail: bytes


NOTHING = Summary(0, False, b"", b"")


def summarize(chunk: bytes) -> Summary:
    points = int(np.count_nonzero((np.frombuffer(chunk, np.uint8) & 0xC0) != 0x80))
    return Summary(points, any(m in chunk for m in MARKERS), chunk[:2], chunk[-2:])


def combine(a: Summary, b: Summary) -> Summary:
    """Summary of two neighbours; the outer bytes of short ones are all they have, so nothing is lost between them."""
    seam = a.tail + b.head
    return Summary(a.points + b.points, a.marked or b.marked or any(m in seam for m in MARKERS),
                   (a.head + b.head)[:2] if len(a.head) < 2 else a.head, (a.tail + b.tail)[-2:] if len(b.tail) < 2 else b.tail)


class Memo:
    """Summaries by content, up to so many bytes of it."""

    def __init__(self, most: int = CACHE_BYTES):
        self.most, self.held, self.known, self.hits = most, 0, {}, 0

    def __call__(self, chunk: bytes) -> Summary:
        found = self.known.get(chunk)  # equal hash and equal bytes
        if found is None:
            if self.held + len(chunk) > self.most:
                self.known, self.held = {}, 0
            found = self.known[chunk] = summarize(chunk)
            self.held += len(chunk)
        else:
            self.hits += 1
        return found


def chunk_ends(buf: np.ndarray, off: np.ndarray, bits: int = CUT_BITS, longest: int = LONGEST_CHUNK) -> np.ndarray:
    """Ends of all chunks of the texts ``buf[off[i]:off[i + 1]]``, ascending; a text's end is always one."""
    h = C.TABLES[0][buf] + buf.astype(np.uint64)  # the table has zeros for white space
    base = C.powers(9, C.BASES[0])
    for reach in (1, 2, 4, 8):  # each step doubles the window
        more = h.copy()
        more[reach:] += h[:-reach] * base[reach]
        h = more
    cut = h >> np.uint64(64 - bits) == 0
    since = np.arange(len(buf)) - np.repeat(off[:-1], np.diff(off))
    cut &= since >= 15  # a window that reaches back into the text before decides nothing
    ends = np.union1d(np.flatnonzero(cut) + 1, off[1:][np.diff(off) > 0])
    starts = np.concatenate([off[:1], ends[:-1]])
    parts = -(-(ends - starts) // longest)
    if (parts > 1).any():
        own = np.repeat(np.arange(len(ends)), parts)
        step = np.arange(len(own)) - np.repeat(np.cumsum(parts) - parts, parts) + 1
        ends = np.minimum(starts[own] + step * longest, ends[own])
    return ends


def locate(text: bytes, ends: list[int], points: list[int], k: int) -> int:
    """Byte at which code point ``k`` begins. ``ends`` of the chunks, and code points up to each end."""
    j = bisect_right(points, k)
    if j == len(points):
        return len(text)
    start = ends[j - 1] if j else 0
    leads = np.flatnonzero((np.frombuffer(text, np.uint8, ends[j] - start, start) & 0xC0) != 0x80)
    return start + int(leads[k - (points[j - 1] if j else 0)])


def transform(doc_id, text: bytes, ends: list[int], memo: Memo, seed: str = SEED, rate: int = RATE, suffix_first: int = SUFFIX_FIRST):
    """``n``, ``form``, ``prefix_chars``, ``middle_chars`` and output bytes of one text, whose chunks end at ``ends``."""
    found = [memo(text[a:b]) for a, b in zip([0, *ends], ends)]
    whole = NOTHING
    for s in found:
        whole = combine(whole, s)
    n = whole.points
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    h = [int.from_bytes(digest[i:i + 4], "big") for i in (0, 4, 8, 12)]
    if not n or whole.marked or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    points = list(accumulate(s.points for s in found))
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    i, j = locate(text, ends, points, a), locate(text, ends, points, b)
    p, s, m = MARKERS
    if h[3] % 100 < suffix_first:
        return n, "spm", a, b - a, b"".join((s, text[j:], p, text[:i], m, text[i:j]))
    return n, "psm", a, b - a, b"".join((p, text[:i], s, text[j:], m, text[i:j]))


_MEMO = Memo()


def _rows(batches, seed, rate, suffix_first):
    for batch in batches:
        ids = batch.column("id").to_pylist()
        buf, off = C.flat(batch.column("text"))
        for i, j in C.slices(off):
            part, bounds = buf[off[i]:off[j]], off[i:j + 1] - off[i]
            raw, ends = part.tobytes(), chunk_ends(part, bounds)
            at = np.searchsorted(ends, bounds, "right")  # chunks end after their text's start
            rows = []
            for k in range(j - i):
                a = int(bounds[k])
                rows.append((ids[i + k], *transform(ids[i + k], raw[a:int(bounds[k + 1])], (ends[at[k]:at[k + 1]] - a).tolist(),
                                                    _MEMO, seed, rate, suffix_first)))
            columns = list(zip(*rows))
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                             names=[x.split()[0] for x in SCHEMA.split(", ")])


def fill_in_middle(docs: DataFrame, seed: str = SEED, rate: int = RATE, suffix_first: int = SUFFIX_FIRST,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, ``n`` (code points), ``form``, ``prefix_chars``, ``middle_chars`` and the ``output`` text of every row.

    Edge cases: a null text counts as empty; empty texts, and texts that hold
    a marker, stay plain, so :func:`restored` is always exact; rows that
    repeat an id are each cut on their own, at the same places if their
    texts are as long; a null id is cut as if its number were an empty text;
    an empty table gives an empty result; other columns are not looked at. A
    text is held whole in a worker, a few times over, however long it is.
    """
    C.ship(docs.sparkSession)
    return C.as_documents(docs, id_col, text_col).mapInArrow(
        C.of_batches(lambda batches: _rows(batches, seed, rate, suffix_first)), SCHEMA)


def restored(output: Column, form: Column) -> Column:
    """The text that ``output`` was made from: what follows each marker, in the order of the text."""
    def after(marker: str, until: str | None) -> Column:
        rest = F.split_part(output, F.lit(marker), F.lit(2))
        return F.split_part(rest, F.lit(until), F.lit(1)) if until else rest
    psm = F.concat(after(PREFIX, SUFFIX), after(MIDDLE, None), after(SUFFIX, MIDDLE))
    spm = F.concat(after(PREFIX, MIDDLE), after(MIDDLE, None), after(SUFFIX, PREFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def op13_fill_in_middle(spark, sf_dir: str) -> DataFrame:
    """Contract of the registered query: form, cuts and digests of every document."""
    out = fill_in_middle(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return out.select(F.col("id").alias("doc_id"), "n", "form", "prefix_chars", "middle_chars", digest(F.col("output")).alias("output_sha256"),
                      digest(restored(F.col("output"), F.col("form"))).alias("restored_sha256"))


OP13_SQL = r"""
WITH h AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || doc_id) AS s FROM documents
), k AS (
  SELECT doc_id, t, length(t) AS n, CAST('0x' || substr(s, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(s, 9, 8) AS BIGINT) AS h2,
         CAST('0x' || substr(s, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(s, 25, 8) AS BIGINT) AS h4 FROM h
), c AS (
  SELECT doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM k
), p AS (SELECT *, substring(t, 1, a) AS p, substring(t, a + 1, b - a) AS m, substring(t, b + 1) AS s FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(t) AS restored_sha256
FROM p
"""
