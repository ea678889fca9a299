"""Importance resampling towards a target distribution, with CRC buckets.

A text's features are its runs of one to three words; a feature's bucket is
the CRC-32 of its bytes modulo ``BUCKETS``. What a bucket gains is the
smoothed ratio of its share among the target's features and among all
documents'. A document weighs the sum over its features, and adding Gumbel
noise to the weights and taking the highest draws without replacement, in
proportion to their importance.

CRCs are computed in *length-bucketed matrices*: the distinct features of a
slice of text are grouped by their number of bytes into two-dimensional
uint8 arrays, one column of bytes after the other updates all CRCs of a
group, and the buckets are scattered back to where the features occur.

1. One pass over the texts writes every document's feature buckets (two bytes
   a feature) to the shared folder.
2. Counts by bucket are sums of one fixed-size array a task; the table of
   gains, ``BUCKETS`` numbers, is all that the driver ever holds.
3. Scores are sorted in ranges that are written once; a range's offset is the
   sum of the ranges before it, so no task sees more than its range.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import common as C

#: Fixed values of the contract.
BUCKETS = 10_000
LONGEST_RUN = 3
SEED = "42"
LEAST_WORDS = 20
PERCENT = 5

#: Bytes of words: digits, lower-case letters and everything beyond ASCII (texts are lower-cased first).
IN_WORD = np.zeros(256, bool)
IN_WORD[0x30:0x3A] = IN_WORD[0x61:0x7B] = IN_WORD[0x80:] = True

#: Longer features (a text without a break) would be a matrix of one row each; zlib takes these whole.
LONGEST_COLUMN = 1 << 10
#: Bytes of one matrix.
MATRIX_BYTES = 8 << 20


def _crc_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, np.uint32(0xEDB88320) ^ (c >> np.uint32(1)), c >> np.uint32(1))
    return c


CRC = _crc_table()


def crc32_spans(buf: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """CRC-32 of each span of ``buf``, all spans of one length together."""
    out = np.zeros(len(start), np.uint32)
    order = np.argsort(size, kind="stable")
    bounds = np.flatnonzero(np.diff(size[order], prepend=-1, append=-1))
    for a, b in zip(bounds, bounds[1:]):
        length = int(size[order[a]])
        if length > LONGEST_COLUMN:
            for k in order[a:b]:
                out[k] = zlib.crc32(buf[start[k]:start[k] + length].tobytes())
            continue
        step = max(1, MATRIX_BYTES // max(length, 1))
        for c in range(a, b, step):
            rows = order[c:min(b, c + step)]
            matrix = buf[start[rows] + np.arange(length)[:, None]]  # a column of the features' bytes is a row here
            crc = np.full(len(rows), 0xFFFFFFFF, np.uint32)
            for column in matrix:
                crc = CRC[(crc ^ column) & np.uint32(0xFF)] ^ (crc >> np.uint32(8))
            out[rows] = ~crc
    return out


def normal_words(part: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased words, each with one space after it: bytes, start and end of each, and each text's first word."""
    part = C.LOWER[part]
    word = IN_WORD[part]
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    cut = off[1:-1]
    cut = cut[(cut > 0) & (cut < len(part))]
    first[cut], last[cut - 1] = word[cut], word[cut - 1]
    was, until = np.flatnonzero(first), np.flatnonzero(last) + 1
    size = until - was
    end = np.cumsum(size + 1) - 1
    start = end - size
    out = np.full(int(end[-1]) + 1 if len(end) else 0, 0x20, np.uint8)
    shift = np.repeat(was - start, size)
    place = np.flatnonzero(np.repeat(np.tile([True, False], len(size)), np.stack([size, np.ones_like(size)], 1).ravel()))
    out[place] = part[place + shift]
    return out, start, end, np.searchsorted(was, off)


def word_numbers(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A number for each distinct word, by hash and then by content: words that only share a hash get numbers of their own."""
    _, least, number = np.unique(C.hash_words(buf, start, end), return_index=True, return_inverse=True)
    like, size = least[number], end - start
    same = size == size[like]
    at = np.repeat(np.where(same, start, 0), size) + _within(size)
    other = np.repeat(np.where(same, start[like], 0), size) + _within(size)
    differs = np.add.reduceat((buf[at] != buf[other]).astype(np.int64), np.cumsum(size) - size) > 0 if len(size) else np.zeros(0, bool)
    odd = np.flatnonzero(~same | differs)
    number[odd] = len(least) + np.arange(len(odd))
    return number


def _within(size: np.ndarray) -> np.ndarray:
    """0, 1, ... inside each of consecutive runs."""
    return np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)


def feature_buckets(part: np.ndarray, off: np.ndarray, longest: int = LONGEST_RUN, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket of every feature of the texts in order, features of each text, and its words."""
    buf, start, end, first = normal_words(part, off)
    counts = np.diff(first)
    n = len(start)
    text_end = np.repeat(first[1:], counts)
    grid, there = np.zeros((n, longest), np.uint16), np.zeros((n, longest), bool)
    number = word_numbers(buf, start, end)
    run = number
    for k in range(longest):
        at = np.flatnonzero(np.arange(n) + k < text_end)
        if k:  # a run is a shorter run and one more word
            run = run[:len(number) - k] * np.int64(number.max(initial=0) + 1) + number[k:] if len(number) > k else run[:0]
        _, least, run_number = np.unique(run[at], return_index=True, return_inverse=True)
        spans = at[least]
        crc = crc32_spans(buf, start[spans], end[spans + k] - start[spans]) % np.uint32(buckets)
        grid[at, k], there[at, k] = crc.astype(np.uint16)[run_number], True
        known = np.zeros(len(run), np.int64)
        known[at] = run_number
        run = known
    return grid[there], np.maximum(counts[:, None] - np.arange(longest), 0).sum(1), counts


def _featured(batches):
    for batch in batches:
        buf, off = C.flat(batch.column("text"))
        for i, j in C.slices(off):
            found, sizes, counts = feature_buckets(buf[off[i]:off[j]], off[i:j + 1] - off[i])
            bounds = np.concatenate([[0], np.cumsum(sizes) * 2]).astype(np.int32)
            cells = pa.Array.from_buffers(pa.binary(), j - i, [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(found))])
            yield pa.RecordBatch.from_arrays([batch.column("id").slice(i, j - i), pa.array(counts.astype(np.int64)), cells], names=["id", "n_words", "buckets"])


def _cells(batch) -> tuple[np.ndarray, np.ndarray]:
    """All buckets of a batch after each other, and the features of each row."""
    column = batch.column("buckets")
    off = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    if not len(column) or off[-1] == off[0]:
        return np.empty(0, np.uint16), np.zeros(len(column), np.int64)
    return np.frombuffer(column.buffers()[2], np.uint8)[off[0]:off[-1]].view(np.uint16), np.diff(off).astype(np.int64) // 2


def features(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id``, ``n_words`` and the feature ``buckets`` of each row, written."""
    return C.written(C.as_documents(docs, id_col, text_col).mapInArrow(C.of_batches(_featured), "id long, n_words long, buckets binary"), "features")


def bucket_counts(featured: DataFrame) -> DataFrame:
    """``bucket`` and ``n``, the features in it."""
    def run(batches):
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            total += np.bincount(_cells(batch)[0], minlength=BUCKETS)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(total[seen])], names=["bucket", "n"])

    return featured.select("buckets").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def _dense(counts: DataFrame) -> np.ndarray:
    found = counts.toArrow()  # at most BUCKETS rows
    out = np.zeros(BUCKETS, np.int64)
    out[found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    return out


def gains(target: np.ndarray, source: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of each bucket's smoothed share in the target over that in the source."""
    t, s = target.astype(float), source.astype(float)
    ratio = (t + 1) * (s.sum() + BUCKETS) / ((s + 1) * (t.sum() + BUCKETS))
    return np.array([math.floor(1000 * math.log(x)) for x in ratio], np.int64)


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: str = SEED,
             id_col: str = "doc_id", text_col: str = "text", target_id: str = "item_id", ranges: int | None = None) -> DataFrame:
    """``id``, ``n_features``, ``weight``, ``score`` and ``rank`` (null if not drawn) of every row of ``docs``.

    Edge cases: a null text has no features and weighs 0; texts with fewer
    than ``least_words`` words are scored but never drawn; ties in score go
    to the smaller id, then to fewer features, equal rows take consecutive
    ranks; a null id is drawn after all others of its score, with noise of
    its own; an empty table gives an empty result, an empty target draws by
    smoothed shares; other columns are not looked at. A text is held whole in
    a worker, however long it is.
    """
    spark = docs.sparkSession
    C.ship(spark)
    featured = features(docs, id_col, text_col)
    table = gains(_dense(bucket_counts(features(target, target_id, text_col))), _dense(bucket_counts(featured)))

    def weigh(batches):
        for batch in batches:
            found, sizes = _cells(batch)
            sums = np.concatenate([[0], np.cumsum(table[found])])
            ends = np.cumsum(sizes)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("n_words"), pa.array(sizes), pa.array(sums[ends] - sums[ends - sizes])],
                                             names=["id", "n_words", "n_features", "weight"])

    weighed = featured.mapInArrow(C.of_batches(weigh), "id long, n_words long, n_features long, weight long")
    noise = F.conv(F.substring(F.sha2(F.concat(F.lit(seed + ":"), F.coalesce(F.col("id").cast("string"), F.lit(""))).cast("binary"), 256), 1, 8), 16, 10)
    gumbel = F.floor(F.lit(-1000.0) * F.log(-F.log((noise.cast("double") + 0.5) / F.lit(4294967296.0))))
    scored = weighed.withColumn("score", F.col("weight") + gumbel.cast("long"))
    order = [F.col("score").desc(), F.col("id").asc_nulls_last(), F.col("n_features")]
    n = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    enough = F.col("n_words") >= least_words
    # partitions of the range sort, best first, frozen by being written; documents that cannot be drawn sort last
    placed = C.written(scored.withColumn("enough", enough).repartitionByRange(n, F.col("enough").desc(), *order)
                       .withColumn("part", F.spark_partition_id()), "ranges")
    sizes = placed.where("enough").groupBy("part").agg(F.count("*").alias("size"))  # a row a partition
    before = sizes.select("part", F.coalesce(F.sum("size").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before"),
                          F.floor(F.sum("size").over(W.partitionBy(F.lit(1))) * percent / 100).alias("drawn"))
    drawn = placed.where("enough").join(F.broadcast(before), "part")  # as many rows as range partitions
    rank = F.row_number().over(W.partitionBy("part").orderBy(*order)) + F.col("before")
    ranked = drawn.withColumn("rank", rank).withColumn("rank", F.when(F.col("rank") <= F.col("drawn"), F.col("rank")).cast("long"))
    columns = ["id", "n_features", "weight", "score", "rank"]
    return ranked.select(columns).unionByName(placed.where(~F.col("enough")).withColumn("rank", F.lit(None).cast("long")).select(columns))


def op12_importance_resampling(spark, sf_dir: str) -> DataFrame:
    """Contract of the registered query: features, weight, score and rank of every document."""
    out = resample(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return out.withColumnRenamed("id", "doc_id")
