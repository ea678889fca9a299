"""Language-model scoring by deleted interpolation of bigram, unigram and uniform estimates.

The model mixes maximum-likelihood estimates, P(w | h) = l1 c(h,w)/c(h) +
l2 c(w)/N + l3/(V+1), with weights that depend on the bucket (power of two)
of the context's frequency c(h). Expectation-maximisation learns them on
held-out counts: every training token is taken out of its own counts and
predicted from the rest.

Counts cover the whole corpus and stay distributed. Each block of documents
sends its distinct unigrams and bigrams with their training counts to shards,
which add them up and answer with totals; the block looks its tokens up in
the answers and writes each token's two counts (a few bytes a token) to the
shared folder. Expectation-maximisation sees that table as a histogram of
(bucket, bigram estimate, unigram estimate) on a logarithmic grid, whose size
does not depend on the corpus; scoring then is one pass over the table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as C

FOLDS, HELD_OUT = 7, 2
#: Entries that one shard adds up at once.
SHARD_ENTRIES = 1 << 21
BUCKETS = 32
#: Grid of the estimates: so many steps for each factor e, and the least estimate told from zero.
STEPS, FLOOR = 8, 1e-12
END, START = C.mix(np.array([101, 102], np.uint64))
BIGRAM = np.uint64(0xD1B54A32D192ED03)


def _tokens(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of every token (words, then one end a document), hash of the token before it, and document bounds."""
    w = C.words(table.column("text"), lower=True)
    first = w.first + np.arange(len(w.first))
    tokens = np.full(first[-1], END)
    is_end = np.zeros(first[-1], bool)
    is_end[first[1:] - 1] = True
    tokens[~is_end] = w.hashes[0]
    before = np.concatenate([[START], tokens[:-1]]) if len(tokens) else tokens
    before[first[:-1]] = START
    return tokens, before, first


def _bigrams(before: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    return C.mix(before * BIGRAM + tokens)


def _distinct(keys: np.ndarray, counted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, and how many of their occurrences are counted."""
    s = np.sort(keys)
    u = s[np.concatenate([[True], s[1:] != s[:-1]])] if len(s) else s
    t = np.sort(keys[counted])
    return u, np.searchsorted(t, u, "right") - np.searchsorted(t, u, "left")


def _ask(table: pa.Table, word_bits: int, pair_bits: int) -> pa.Table:
    """A block's distinct unigrams, to the first shards, and bigrams, to the others, with training counts."""
    table = C.ordered_block(table)
    tokens, before, first = _tokens(table)
    learned = np.repeat(~np.asarray(table.column("held_out")), np.diff(first))
    docs = np.append(tokens, np.full(len(first) - 1, START))
    block, rows = table.column("block")[0].as_py(), []
    for kind, bits, keys, counted in (
            (0, word_bits, docs, np.append(learned, ~np.asarray(table.column("held_out")))),
            (1, pair_bits, _bigrams(before, tokens), learned)):
        u, n = _distinct(keys, counted)
        edges = C.by_shard(u, bits)
        for s, (a, b) in enumerate(zip(edges, edges[1:])):
            if b > a:
                rows.append(((kind << word_bits) + s, block, C.pack_parts(C.pack_sorted(u[a:b]), C.pack(n[a:b].astype(np.uint32)))))
    return C.messages(rows)


def _answer(table: pa.Table, word_bits: int) -> pa.Table:
    got = C.received(table)
    parts = [C.unpack_parts(p) for _, _, p in got]
    keys = [C.unpack_sorted(p[0]) for p in parts]
    u, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(inverse, np.concatenate([C.unpack(p[1], np.uint32) for p in parts]), len(u)).astype(np.uint64)
    known = total[u != START] if got and got[0][0] < 1 << word_bits else total[:0]
    # the shard's part of N and V goes to one of the blocks that asked
    sums = [C.pack(np.array(x, np.uint64)) for x in ([known.sum(), np.count_nonzero(known)], [0, 0])]
    bounds = np.cumsum([0] + [len(k) for k in keys])
    return C.messages([(s, b, C.pack_parts(C.pack(total[inverse[a:z]]), sums[i > 0])) for i, ((s, b, _), a, z) in enumerate(zip(got, bounds, bounds[1:]))])


TABLE = ("block int, ids binary, held_out binary, first binary, pairs binary, ones binary, starts long, train_tokens long, vocabulary long")


def _look_up(table: pa.Table, replies: pa.Table, word_bits: int, schema: pa.Schema) -> pa.Table:
    """Counts of every token of a block, as one row; ``train_tokens`` and ``vocabulary`` are parts that add up over all rows."""
    if not table.num_rows:
        return schema.empty_table()
    table = C.ordered_block(table)
    tokens, before, first = _tokens(table)
    got = [(s, C.unpack_parts(p)) for s, _, p in C.received(replies)]
    words = [p for s, p in got if s < 1 << word_bits]
    sums = np.stack([C.unpack(p[1], np.uint64) for p in words])
    found = []
    for keys, parts in ((np.append(tokens, START), words), (_bigrams(before, tokens), [p for s, p in got if s >= 1 << word_bits])):
        u = np.unique(keys)
        total = np.concatenate([C.unpack(p[0], np.uint64) for p in parts])
        found.append(total[np.searchsorted(u, keys)])
    row = [table.column("block")[0].as_py(), C.pack(np.asarray(pa.compute.fill_null(table.column("id"), 0)).astype(np.int64)),
           C.pack(np.asarray(table.column("held_out")).astype(np.uint8) + 2 * np.asarray(pa.compute.is_null(table.column("id"))).astype(np.uint8)),
           C.pack(first), C.pack(found[1]), C.pack(found[0][:-1]), int(found[0][-1]), int(sums[:, 0].sum()), int(sums[:, 1].sum())]
    return pa.table([pa.array([v], f.type) for v, f in zip(row, schema)], schema=schema)


class _Block:
    """One row of the table of counts: per token the counts of itself, of its context and of both."""

    def __init__(self, row: dict, n: int, v: int):
        flags = C.unpack(row["held_out"], np.uint8)
        self.ids, self.held_out, self.null = C.unpack(row["ids"], np.int64), flags & 1 == 1, flags & 2 == 2
        self.first, self.pair, self.one = (C.unpack(row[k], t) for k, t in (("first", np.int64), ("pairs", np.uint64), ("ones", np.uint64)))
        self.n, self.v = n, v
        self.pair, self.one = self.pair.astype(np.float64), self.one.astype(np.float64)
        self.context = np.concatenate([[0.0], self.one[:-1]])
        self.context[self.first[:-1]] = row["starts"]

    def estimates(self, less: int):
        """Bucket, bigram estimate and unigram estimate, with ``less`` occurrences taken out of each count."""
        c = np.maximum(self.context - less, 0)
        bucket = np.where(c > 0, np.minimum(np.log2(np.maximum(c, 1)).astype(np.int64) + 1, BUCKETS - 1), 0)
        x1 = np.where(c > 0, np.maximum(self.pair - less, 0) / np.maximum(c, 1), 0)
        return bucket, x1, np.maximum(self.one - less, 0) / max(self.n - less, 1)


def _rows(batches):
    for batch in batches:
        names = batch.schema.names
        for k in range(batch.num_rows):
            yield {n: batch.column(n)[k].as_py() for n in names}


def _histogram(batches, n: int):
    """Training tokens of each bucket and grid cell, each token out of its own counts."""
    for row in _rows(batches):
        b = _Block(row, n, 0)
        token = np.repeat(~b.held_out, np.diff(b.first))
        bucket, x1, x2 = (a[token] for a in b.estimates(1))
        cells = [np.where(x < FLOOR, 0, 1 + np.rint((np.log(np.maximum(x, FLOOR)) - np.log(FLOOR)) * STEPS)).astype(np.int64) for x in (x1, x2)]
        code, times = np.unique((bucket << 32) | (cells[0] << 16) | cells[1], return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(times.astype(np.int64))], names=["code", "n"])


def learn_weights(code: np.ndarray, n: np.ndarray, vocabulary: int, rounds: int = 200, least: float = 1e-4) -> np.ndarray:
    """Mixture weights of each bucket by expectation-maximisation on the histogram.

    The uniform estimate keeps at least ``least``, so that no text is impossible.
    """
    grid = lambda c: np.where(c == 0, 0, np.exp((c - 1) / STEPS + np.log(FLOOR)))
    x = np.stack([grid((code >> 16) & 0xFFFF), grid(code & 0xFFFF), np.full(len(code), 1 / (vocabulary + 1))], 1)
    weights = np.tile([0.0, 0.9, 0.1], (BUCKETS, 1))
    for b in np.unique(code >> 32):
        rows, w = code >> 32 == b, np.array([0.0, 0.9, 0.1]) if b == 0 else np.array([0.4, 0.5, 0.1])
        for _ in range(rounds):
            joint = x[rows] * w
            new = (joint / joint.sum(1, keepdims=True) * n[rows, None]).sum(0) / n[rows].sum()
            new = np.maximum(new, [0, 0, least])
            new /= new.sum()
            if np.abs(new - w).max() < 1e-7:
                break
            w = new
        weights[int(b)] = w
    seen = np.unique(code >> 32)
    for b in range(1, BUCKETS):  # a bucket without training contexts borrows from the nearest below it
        if b not in seen:
            lower = seen[(seen < b) & (seen > 0)]
            weights[b] = weights[int(lower.max())] if len(lower) else [0.0, 0.9, 0.1]
    return weights


def is_held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(True))


SCORES = "id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _scores(batches, weights: np.ndarray, n: int, v: int):
    for row in _rows(batches):
        b = _Block(row, n, v)
        bucket, x1, x2 = b.estimates(0)
        w = weights[bucket]
        logs = [np.log10((b.one + 1) / (b.n + b.v + 1)), np.log10(w[:, 0] * x1 + w[:, 1] * x2 + w[:, 2] / (b.v + 1))]
        base, score, known = (np.add.reduceat(a, b.first[:-1]) for a in (*logs, (b.one > 0).astype(np.int64)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(b.ids, mask=b.null), pa.array(b.held_out), pa.array(np.diff(b.first)), pa.array(known),
             pa.array(np.full(len(b.ids), b.n, np.int64)), pa.array(base), pa.array(score)], names=[x.split()[0] for x in SCORES.split(", ")])


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    block_bytes: int = C.BLOCK_BYTES, shard_entries: int = SHARD_ENTRIES) -> DataFrame:
    """Log10 probability of every whole text, learned from the documents outside the held-out fold.

    Returns per input row ``id``, ``held_out``, ``n_tokens``, ``n_known``,
    ``train_tokens``, ``base_score`` (add-one unigrams) and ``score``.

    Edge cases: a null or empty text is one end token; a null id is scored and
    never learned from; repeated rows count as often as they occur; without
    training documents every token has the uniform probability of an empty
    vocabulary, 1; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    C.ship(spark)
    base = C.as_documents(docs, id_col, text_col)
    blocks = C.block_count(base, block_bytes)
    entries = blocks * block_bytes / 6  # about as many tokens as six bytes of text give
    pair_bits = C.power_of_two(entries / shard_entries)
    word_bits = max(0, pair_bits - 2)
    placed = C.with_blocks(base.withColumn("held_out", is_held_out(F.col("id"))), blocks).groupBy("block")
    asked = placed.applyInArrow(C.of_group(lambda t: _ask(t, word_bits, pair_bits)), C.MESSAGE)
    answers = asked.groupBy("shard").applyInArrow(C.of_group(lambda t: _answer(t, word_bits)), C.MESSAGE)
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = to_arrow_schema(StructType.fromDDL(TABLE))
    counts = C.written(placed.cogroup(answers.groupBy("block")).applyInArrow(C.of_groups(lambda a, b: _look_up(a, b, word_bits, schema)), TABLE), "lm-counts")
    n, v = (x or 0 for x in counts.agg(F.sum("train_tokens"), F.sum("vocabulary")).first())
    grid = counts.mapInArrow(C.of_batches(lambda batches: _histogram(batches, n)), "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).toArrow()  # bounded by the grid
    weights = learn_weights(grid.column("code").to_numpy(), grid.column("n").to_numpy().astype(float), v)
    return counts.mapInArrow(C.of_batches(lambda batches: _scores(batches, weights, n, v)), SCORES)


def op2_lm_score(spark, sf_dir: str) -> DataFrame:
    """Contract of the registered query: both scores of every document."""
    return score_documents(spark.read.parquet(f"{sf_dir}/documents.parquet")).withColumnRenamed("id", "doc_id")
