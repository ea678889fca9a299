"""Exact top-k search by BM25: sharded inverted index, block-max pruning, exact merge.

Documents fall into shards by hash. A first pass counts document frequencies
over the whole corpus (blocks send term counts to key ranges, which add them
up and answer for the terms of queries), so every shard scores with global
statistics and the shards' results merge exactly.

Words are split and counted once; what follows reads the written counts. A
shard indexes the terms that its queries use. Its documents fall into clusters
that use the same frequent terms, and these are cut into blocks of
``DOC_BLOCK``; each term keeps its largest impact in each block. For a batch of
queries the sums of these maxima bound every block from above, before any
posting is read. Blocks go by falling bound, and the pivot of a query is the
first block whose bound does not reach its k-th best score so far: from there
on the query's postings are not read, as no document there can enter the
result. Terms that many documents of a cluster share are scored as a dense
matrix product, the others through their postings, both in single precision;
what is within its error of the best is summed again exactly.

Queries meet the shards in blocks: each pair of a query block and a shard is
one task, so neither side has to fit a broadcast. A sixth of the shards is
searched first; the others start from the k-th best scores found there.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from . import common as C

K1, B, K = 1.2, 0.75, 10
#: Text bytes of a shard, documents of a block, queries scored together.
INDEX_BYTES, DOC_BLOCK, BATCH = 24 << 20, 1024, 1024
#: Clusters of a shard's documents at most, documents of one on average at least, and the terms that tell clusters apart.
CLUSTERS, CLUSTER_DOCS, FEATURES = 16, 256, 512
#: Postings in a row, and rows read at once.
WIDTH, AT_ONCE = 8, 1 << 12
#: Runs of postings held for the queries of one batch.
BATCH_RUNS = 1 << 21
#: Terms in at least this part of a cluster's documents are scored densely there.
FREQUENT = 1 / 24
#: Candidates that are summed exactly at once.
PAIRS = 1 << 20
#: One shard of so many is searched first.
FIRST = 6
QUERY_BYTES = 32 << 20
SHARD_ENTRIES = 1 << 21
#: Scores are rounded to so many digits before they are ranked, so that equal texts tie; ties go by id.
DIGITS = 6


def _term_counts(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Document, term hash and frequency of every distinct term of every document, and document lengths."""
    column, parts, lengths, base = table.column("text"), [], [], 0
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks)
    _, off = C.flat(column)
    for i, j in C.slices(off, 4 << 20):
        w = C.words(column.slice(i, j - i), lower=True)
        doc, h = w.document(), w.hashes[0]
        order = np.lexsort((h, doc))
        doc, h = doc[order], h[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
        at = np.flatnonzero(new)
        parts.append((doc[at] + base, h[at], np.diff(np.append(at, len(h)))))
        lengths.append(w.counts)
        base += j - i
    if not parts:
        return *[np.empty(0, t) for t in (np.int64, np.uint64, np.int64)], np.empty(0, np.int64)
    return *[np.concatenate(x) for x in zip(*parts)], np.concatenate(lengths)


class Counts(NamedTuple):
    """Words of a block: of document ``i`` the entries from ``first[i]`` on, each a place in ``terms`` (ascending hashes) and a frequency."""
    ids: np.ndarray
    null: np.ndarray
    is_query: np.ndarray
    lengths: np.ndarray
    first: np.ndarray
    terms: np.ndarray
    at: np.ndarray
    tf: np.ndarray

    @classmethod
    def of(cls, table: pa.Table) -> Counts:
        doc, term, tf, lengths = _term_counts(table)
        terms, at = np.unique(term, return_inverse=True)
        asks = np.asarray(table.column("is_query")) if "is_query" in table.column_names else np.zeros(len(lengths), bool)
        return cls(C.ids_of(table), np.asarray(pc.is_null(table.column("id"))), asks, lengths, np.searchsorted(doc, np.arange(len(lengths) + 1)),
                   terms, at.astype(np.uint32), tf.astype(np.uint32))

    def packed(self) -> bytes:
        return C.pack_parts(C.pack(self.ids), np.packbits(self.null).tobytes(), np.packbits(self.is_query).tobytes(), C.pack(self.lengths.astype(np.uint64)),
                            C.pack(np.diff(self.first).astype(np.uint32)), C.pack_sorted(self.terms), C.pack(self.at), C.pack(self.tf))

    @classmethod
    def unpacked(cls, payload: bytes) -> Counts:
        ids, null, asks, lengths, held, terms, at, tf = C.unpack_parts(payload)
        ids = C.unpack(ids, np.int64)
        null, asks = (np.unpackbits(np.frombuffer(x, np.uint8), count=len(ids)).astype(bool) for x in (null, asks))
        return cls(ids, null, asks, C.unpack(lengths, np.uint64).astype(np.int64), np.concatenate([[0], np.cumsum(C.unpack(held, np.uint32).astype(np.int64))]),
                   C.unpack_sorted(terms), C.unpack(at, np.uint32), C.unpack(tf, np.uint32))

    def document(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.ids)), np.diff(self.first))


COUNTED = "block int, payload binary"


def _count(table: pa.Table, schema: pa.Schema) -> pa.Table:
    """A block's words, split and counted once for all that follows."""
    return pa.table([pa.array([table.column("block")[0].as_py()], pa.int32()), pa.array([Counts.of(C.ordered_block(table)).packed()], pa.binary())], schema=schema)


def _counts(table: pa.Table) -> Counts:
    return Counts.unpacked(table.column("payload")[0].as_py())


def _ask(table: pa.Table, bits: int) -> pa.Table:
    """A block's distinct terms with document frequencies, marked where a query of this block uses them."""
    x = _counts(table)
    df, wanted = np.bincount(x.at, minlength=len(x.terms)), np.zeros(len(x.terms), bool)
    wanted[x.at[np.repeat(x.is_query, np.diff(x.first))]] = True
    edges, block = C.by_shard(x.terms, bits), table.column("block")[0].as_py()
    return C.messages([(s, block, C.pack_parts(C.pack_sorted(x.terms[a:b]), C.pack(df[a:b].astype(np.uint32)), np.packbits(wanted[a:b]).tobytes()))
                       for s, (a, b) in enumerate(zip(edges, edges[1:])) if b > a])


def _answer(table: pa.Table) -> pa.Table:
    got = C.received(table)
    parts = [C.unpack_parts(p) for _, _, p in got]
    keys = [C.unpack_sorted(p[0]) for p in parts]
    u, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(inverse, np.concatenate([C.unpack(p[1], np.uint32) for p in parts]), len(u)).astype(np.uint64)
    bounds, rows = np.cumsum([0] + [len(k) for k in keys]), []
    for (s, b, _), p, k, a, z in zip(got, parts, keys, bounds, bounds[1:]):
        wanted = np.unpackbits(np.frombuffer(p[2], np.uint8), count=len(k)).astype(bool)
        if wanted.any():
            rows.append((s, b, C.pack_parts(C.pack_sorted(k[wanted]), C.pack(total[inverse[a:z][wanted]]))))
    return C.messages(rows)


QUERIES = "id long, terms binary, frequencies binary, documents long, words long"


def _queries(table: pa.Table, replies: pa.Table, schema: pa.Schema) -> pa.Table:
    """Queries of a block as terms and global document frequencies; and one row with the block's part of the statistics."""
    if not table.num_rows:
        return schema.empty_table()
    x = _counts(table)
    parts = [C.unpack_parts(p) for _, _, p in C.received(replies)]
    keys = np.concatenate([C.unpack_sorted(p[0]) for p in parts]) if parts else np.empty(0, np.uint64)
    total = np.concatenate([C.unpack(p[1], np.uint64) for p in parts]) if parts else np.empty(0, np.uint64)
    rows: list = [(None, None, None, len(x.ids), int(x.lengths.sum()))]
    for d in np.flatnonzero(x.is_query):
        own = x.terms[x.at[x.first[d]:x.first[d + 1]]]
        if len(own):
            rows.append((None if x.null[d] else int(x.ids[d]), C.pack_sorted(own), C.pack(total[np.searchsorted(keys, own)]), None, None))
    return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


class Index:
    """Impacts of one shard's documents for the terms of some queries; ``idf``, if given, has the weight that every term has in all of them."""

    def __init__(self, table: pa.Table | Counts, vocabulary: np.ndarray, mean_length: float, idf: np.ndarray | None = None):
        held = table if isinstance(table, Counts) else Counts.of(table)
        self.ids, self.null, lengths, self.n, self.size = held.ids, held.null, held.lengths, len(held.ids), len(vocabulary)
        at = np.minimum(np.searchsorted(vocabulary, held.terms), max(self.size - 1, 0)).astype(np.int32)
        known = vocabulary[at] == held.terms if self.size else np.zeros(len(held.terms), bool)
        used = known[held.at]
        doc, at, tf = held.document()[used], at[held.at[used]], held.tf[used].astype(np.int64)
        impact = tf * (K1 + 1) / (tf + K1 * (1 - B + B * lengths[doc] / max(mean_length, 1e-9)))
        cluster = self._clusters(doc, at)
        self.order = np.lexsort((lengths, cluster))  # place -> document
        # entries by place: those of a cluster are neighbours
        first = np.searchsorted(doc, np.arange(self.n + 1))
        held = np.diff(first)[self.order]
        by_place = _ranges(first[:-1][self.order], held)
        at, impact = at[by_place], impact[by_place]
        self.doc_term, self.doc_impact, self.doc_first = at, impact, np.concatenate([[0], np.cumsum(held)])
        place = np.repeat(np.arange(self.n), held)
        edges = np.searchsorted(cluster[self.order], np.arange(len(self.centres) + 1))
        self.blocks = np.concatenate([np.arange(a, z, DOC_BLOCK) for a, z in zip(edges, edges[1:])]).astype(np.int64)
        self.ends = np.minimum(self.blocks + DOC_BLOCK, edges[np.searchsorted(edges, self.blocks, "right")]) if self.n else self.blocks
        block_of = np.repeat(np.arange(len(self.blocks)), self.ends - self.blocks)
        #: No score in a block exceeds what its documents have in all.
        self.cap = np.full(len(self.blocks), np.inf)
        if idf is not None and self.n:
            self.cap = np.maximum.reduceat(np.bincount(place, impact * idf[at], self.n), self.blocks)
        # terms that many documents of a cluster share are dense there
        self.parts, frequent, rare = [], [], np.ones(len(at), bool)
        for a, z in zip(edges, edges[1:]):
            mine = slice(self.doc_first[a], self.doc_first[z])
            terms = np.flatnonzero(np.bincount(at[mine], minlength=self.size) > max((z - a) * FREQUENT, 1))
            column = np.full(self.size, -1, np.int32)
            column[terms] = np.arange(len(terms))
            column = column[at[mine]]
            rare[mine] = column < 0
            dense = np.zeros((len(terms), z - a), np.float32)
            dense[column[column >= 0], place[mine][column >= 0] - a] = impact[mine][column >= 0]
            own = slice(*np.searchsorted(self.blocks, [a, z]))
            top = np.maximum.reduceat(dense, self.blocks[own] - a, axis=1) if z > a else dense
            self.parts.append((int(a), own, dense, top))
            frequent.append(terms)
        some = np.unique(np.concatenate(frequent)) if frequent else np.empty(0, np.int64)
        self.dense_of = np.full(self.size, -1, np.int32)
        self.dense_of[some] = np.arange(len(some))
        self.columns = np.full((len(frequent), len(some)), -1, np.int32)
        for own, terms in zip(self.columns, frequent):
            own[self.dense_of[terms]] = np.arange(len(terms))
        # runs: the postings of one term in one block of documents, each with its largest impact; a block's runs are neighbours
        at, place, impact = at[rare], place[rare], impact[rare]
        by_term = np.lexsort((at, block_of[place]))
        at, place = at[by_term], place[by_term]
        impact, block = impact[by_term].astype(np.float32), block_of[place]
        new = np.ones(len(at), bool)
        new[1:] = (at[1:] != at[:-1]) | (block[1:] != block[:-1])
        first = np.flatnonzero(new)
        self.run_size = np.diff(np.append(first, len(at)))
        self.run_block = block[first].astype(np.int32)
        self.run_max = np.maximum.reduceat(impact, first) if len(first) else np.empty(0, np.float32)
        self.by_term = np.argsort(at[first], kind="stable").astype(np.int32)
        self.term_runs = np.concatenate([[0], np.cumsum(np.bincount(at[first], minlength=self.size))])
        # a run is kept in rows of ``WIDTH`` postings; what fills its last row up adds nothing
        rows = -(-self.run_size // WIDTH)
        self.run_first = np.concatenate([[0], np.cumsum(rows)]).astype(np.int32)
        self.post_doc = np.repeat(place[first], rows * WIDTH)
        self.post_impact = np.zeros(len(self.post_doc), np.float32)
        at = _ranges(self.run_first[:-1].astype(np.int64) * WIDTH, self.run_size)
        self.post_doc[at], self.post_impact[at] = place, impact
        self.post_doc, self.post_impact = (np.ascontiguousarray(x.reshape(-1, WIDTH).T) for x in (self.post_doc, self.post_impact))
        self.held = self.read = 0  # postings of all terms searched for, and those that were read

    def _features(self, row: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
        """Directions of ``n`` sets of terms, over the terms that most documents use."""
        x = np.zeros((n, len(self.feature_weight)), np.float32)
        column = self.feature_of[at]
        has = column >= 0
        x[row[has], column[has]] = self.feature_weight[column[has]]
        x /= np.maximum(np.sqrt(np.einsum("ij,ij->i", x, x)), 1e-9)[:, None]
        return x

    def _clusters(self, doc: np.ndarray, at: np.ndarray, rounds: int = 5) -> np.ndarray:
        """A cluster for each document, by the frequent terms it uses (spherical k-means from evenly spaced documents)."""
        df = np.bincount(at, minlength=self.size)
        terms = np.sort(np.argsort(-df, kind="stable")[:FEATURES])
        self.feature_of = np.full(self.size, -1, np.int32)
        self.feature_of[terms] = np.arange(len(terms))
        self.feature_weight = np.log1p(self.n / np.maximum(df[terms], 1)).astype(np.float32)
        x = self._features(doc, at, self.n)
        k = min(CLUSTERS, -(-self.n // CLUSTER_DOCS))
        self.centres = x[np.arange(k) * self.n // max(k, 1)]
        if k < 2:
            return np.zeros(self.n, np.int64)
        for _ in range(rounds):
            nearest = np.argmax(x @ self.centres.T, axis=1)
            member = np.zeros((k, self.n), np.float32)
            member[nearest, np.arange(self.n)] = 1
            total = member @ x
            norm = np.sqrt(np.einsum("ij,ij->i", total, total))
            self.centres = np.where(norm[:, None] > 0, total / np.maximum(norm, 1e-9)[:, None], self.centres)
        return np.argmax(x @ self.centres.T, axis=1)

    def nearest(self, terms: list[np.ndarray]) -> np.ndarray:
        """The cluster that each query is most like."""
        found = [np.empty(0, np.int64)]
        for a in range(0, len(terms), 1024):
            some = terms[a:a + 1024]
            row = np.repeat(np.arange(len(some)), [len(t) for t in some])
            found.append(np.argmax(self._features(row, np.concatenate(some), len(some)) @ self.centres.T, axis=1))
        return np.concatenate(found)

    def runs(self, terms: np.ndarray) -> np.ndarray:
        """How many runs of postings the terms have."""
        return self.term_runs[terms + 1] - self.term_runs[terms]

    def search(self, terms: list[np.ndarray], weights: list[np.ndarray], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Places and rounded scores of the best ``k`` documents of each query (ties by id come later: all of the k-th score stay)."""
        query, places = self.candidates(terms, weights, k)
        scores = self.exact(places, query, terms, weights)
        by_query, out = np.argsort(query, kind="stable"), []
        places, scores, edges = places[by_query], scores[by_query], np.searchsorted(query[by_query], np.arange(len(terms) + 1))
        for a, z in zip(edges, edges[1:]):
            p, s = places[a:z], scores[a:z]
            keep = s > 0
            if z - a > k:
                keep &= s >= -np.partition(-s, k - 1)[k - 1]
            out.append((p[keep], s[keep]))
        return out

    def candidates(self, terms: list[np.ndarray], weights: list[np.ndarray], k: int, floor: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of query and place that hold the best ``k`` documents of each query, of those that score ``floor`` at least.

        Scores are summed in single precision here. All are sums of positive
        terms, so their relative error is bounded by the number of terms; what
        could be among the best within that bound stays.
        """
        n_q, n_b = len(terms), len(self.blocks)
        if not n_b or not n_q:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        count = np.array([len(t) for t in terms])
        query, t, w = np.repeat(np.arange(n_q, dtype=np.int32), count), np.concatenate(terms), np.concatenate(weights)
        slack = (count + 16) * 2.0 ** -23
        n = self.runs(t)
        run, weight, asks = self.by_term[_ranges(self.term_runs[t], n)], np.repeat(w.astype(np.float32), n), np.repeat(query, n)
        block = self.run_block[run]
        bound = np.bincount(asks * np.int64(n_b) + block, self.run_max[run] * weight, n_q * n_b).reshape(n_q, n_b).astype(float)
        shared = self.dense_of[t] >= 0
        d_query, d_term, d_weight = query[shared], self.dense_of[t[shared]], w[shared]
        factors = []
        for column, (_, own, dense, top) in zip(self.columns, self.parts):
            column = column[d_term]
            here = column >= 0
            used = np.flatnonzero(np.bincount(column[here], minlength=len(dense)))
            small = np.zeros(len(dense), np.int64)
            small[used] = np.arange(len(used))
            q = np.zeros((n_q, len(used)), np.float32)
            q[d_query[here], small[column[here]]] = d_weight[here]
            bound[:, own] += q @ top[used]
            factors.append((q, dense[used]))
        bound = np.minimum(bound, self.cap) * (1 + slack[:, None]) + 10.0 ** -DIGITS
        by_block = np.argsort(block.astype(np.uint16) if n_b <= 1 << 16 else block, kind="stable")
        edges = np.concatenate([[0], np.cumsum(np.bincount(block, minlength=n_b))])
        run, weight, asks = run[by_block], weight[by_block], asks[by_block]
        first = self.run_first[run]
        sizes = self.run_first[run + 1] - first
        self.held += int(self.run_size[run].sum())
        part_of = np.repeat(np.arange(len(self.parts)), [own.stop - own.start for _, own, _, _ in self.parts])
        best, least, row_of = np.zeros((n_q, k), np.float32), np.zeros(n_q) if floor is None else floor.astype(float), np.zeros(n_q, np.int64)
        cells, values = np.empty((WIDTH, AT_ONCE), np.int64), np.empty((WIDTH, AT_ONCE), np.float32)
        found: list = []
        for b in np.argsort(-bound.max(0), kind="stable"):
            alive = (bound[:, b] >= least) & (bound[:, b] > 2 * 10.0 ** -DIGITS)
            active = np.flatnonzero(alive)
            if not len(active):
                continue
            a, z, (q, dense) = self.blocks[b], self.ends[b], factors[part_of[b]]
            base = self.parts[part_of[b]][0]
            score = q[active] @ dense[:, a - base:z - base]
            # the postings of this block, where its bound can still reach the query's k-th score
            mine = slice(edges[b], edges[b + 1])
            if len(active) < n_q:
                mine = edges[b] + np.flatnonzero(alive[asks[mine]])
            row_of[active] = np.arange(len(active)) * (z - a) - a
            n = sizes[mine]
            take = _ranges(first[mine], n)
            self.read += int(self.run_size[run[mine]].sum())
            start, factor, flat = np.repeat(row_of[asks[mine]], n), np.repeat(weight[mine], n), score.reshape(-1)
            for x in range(0, len(take), AT_ONCE):
                some = take[x:x + AT_ONCE]
                cell, value = cells[:, :len(some)], values[:, :len(some)]
                for j in range(WIDTH):
                    np.take(self.post_doc[j], some, out=cell[j], mode="clip")
                    np.take(self.post_impact[j], some, out=value[j], mode="clip")
                cell += start[x:x + AT_ONCE]
                value *= factor[x:x + AT_ONCE]
                for j in range(WIDTH):
                    np.add.at(flat, cell[j], value[j])
            # what is below the k-th score by more than the error of both is out
            rows = np.flatnonzero(score.max(1) >= (least * (1 - slack) - 10.0 ** -DIGITS)[active])
            if not len(rows):
                continue
            score, owner = score[rows], active[rows]
            top = score if score.shape[1] <= k else -np.partition(-score, k - 1, axis=1)[:, :k]
            best[owner] = -np.partition(-np.concatenate([best[owner], top], 1), k - 1, axis=1)[:, :k]
            least[owner] = np.maximum(least[owner], best[owner].min(1) * (1 - slack[owner]))
            row, col = np.nonzero((score >= (least[owner] * (1 - slack[owner]) - 10.0 ** -DIGITS)[:, None]) & (score > 0))
            found.append((owner[row], col + a, score[row, col]))
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        query, places, rough = (np.concatenate(x) for x in zip(*found))
        keep = rough >= (least * (1 - slack) - 10.0 ** -DIGITS)[query]
        return query[keep], places[keep]

    def exact(self, places: np.ndarray, query: np.ndarray, terms: list[np.ndarray], weights: list[np.ndarray]) -> np.ndarray:
        """Rounded scores of pairs of document and query."""
        first = np.concatenate([[0], np.cumsum([len(t) for t in terms])]).astype(np.int64)
        t, w = np.concatenate([np.empty(0, np.int64), *terms]), np.concatenate([np.empty(0), *weights])
        by_place, out, of = np.argsort(places, kind="stable"), np.empty(len(places)), np.zeros(self.size)
        edges = np.flatnonzero(np.diff(places[by_place], prepend=-1, append=-1))
        for a, z in zip(edges, edges[1:]):
            own = slice(*self.doc_first[places[by_place[a]] + np.arange(2)])
            of[self.doc_term[own]] = self.doc_impact[own]
            asks = query[by_place[a:z]]
            n = first[asks + 1] - first[asks]
            take = _ranges(first[asks], n)
            out[by_place[a:z]] = np.add.reduceat(of[t[take]] * w[take], np.cumsum(n) - n)
            of[self.doc_term[own]] = 0
        return np.round(out, DIGITS)


def _ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Indices first, first + 1, ... of ranges of the given sizes, after each other."""
    return np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())


HITS = "query_id long, doc_id long, score double"


def _batches(runs: np.ndarray) -> list[tuple[int, int]]:
    """Queries scored together: at most ``BATCH`` of them, with ``BATCH_RUNS`` runs unless one alone has more."""
    cuts, total = [0], 0
    for i, n in enumerate(runs):
        if i > cuts[-1] and (i - cuts[-1] == BATCH or total + n > BATCH_RUNS):
            cuts.append(i)
            total = 0
        total += n
    return list(zip(cuts, cuts[1:] + [len(runs)]))


PACKED = "part int, payload binary"


def _pack_queries(table: pa.Table, schema: pa.Schema) -> pa.Table:
    """The queries of a part in one cell: their vocabulary with document frequencies, and each one's places in it."""
    table = table.sort_by([("id", "ascending"), ("terms", "ascending")])
    terms = [C.unpack_sorted(x) for x in table.column("terms").to_pylist()]
    vocabulary, at = np.unique(np.concatenate(terms), return_inverse=True)
    df = np.zeros(len(vocabulary), np.uint64)
    df[at] = np.concatenate([C.unpack(x, np.uint64) for x in table.column("frequencies").to_pylist()])
    ids, floor = np.asarray(table.column("id")).astype(np.int64), np.asarray(table.column("floor")).astype(np.float64)
    payload = C.pack_parts(C.pack(ids), C.pack(floor), C.pack(np.array([len(t) for t in terms], np.uint32)), C.pack_sorted(vocabulary), C.pack(df), C.pack(at.astype(np.uint32)))
    return pa.table([pa.array([table.column("part")[0].as_py()], pa.int32()), pa.array([payload], pa.binary())], schema=schema)


def _search(table: pa.Table, queries: pa.Table, k: int, n_docs: int, n_words: int, schema: pa.Schema) -> pa.Table:
    if not table.num_rows or not queries.num_rows:
        return schema.empty_table()
    ids, floor, count, vocabulary, df, at = C.unpack_parts(queries.column("payload")[0].as_py())
    ids, floor, count, vocabulary = C.unpack(ids, np.int64), C.unpack(floor, np.float64), C.unpack(count, np.uint32).astype(np.int64), C.unpack_sorted(vocabulary)
    df, at = C.unpack(df, np.uint64).astype(float), C.unpack(at, np.uint32).astype(np.int32)
    idf, cuts = np.log1p((n_docs - df + 0.5) / (df + 0.5)), np.cumsum(count[:-1])
    local, weights = np.split(at, cuts), np.split(idf[at], cuts)
    index = Index(_counts(table), vocabulary, n_words / max(n_docs, 1), idf)
    # queries of the same kind are searched together, as they use the same dense terms
    turn = np.lexsort((count, index.nearest(local)))
    found, waiting, hits = [], 0, [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))]
    batches = _batches(np.add.reduceat(index.runs(at), np.append(0, cuts))[turn])
    for a, z in batches:
        own = turn[a:z]
        query, places = index.candidates([local[i] for i in own], [weights[i] for i in own], k, floor[own])
        found.append((own[query], places))
        waiting += len(query)
        if waiting >= PAIRS or z == len(turn):
            query, places = (np.concatenate(x) for x in zip(*found))
            found, waiting = [], 0
            score, doc = index.exact(places, query, local, weights), index.order[places]
            order = np.lexsort((index.ids[doc], index.null[doc], -score, query))
            order = order[score[order] > 0]
            start = np.searchsorted(query[order], query[order])
            order = order[np.arange(len(order)) - start < k]
            hits.append((query[order], doc[order], score[order]))
    query, doc, score = (np.concatenate(x) for x in zip(*hits))
    return pa.table([pa.array(ids[query], pa.int64()), pa.array(index.ids[doc], pa.int64(), mask=index.null[doc]), pa.array(score)], schema=schema)


def search(docs: DataFrame, is_query: Column, k: int = K, id_col: str = "doc_id", text_col: str = "text",
           index_bytes: int = INDEX_BYTES, query_bytes: int = QUERY_BYTES, shard_entries: int = SHARD_ENTRIES) -> DataFrame:
    """The best ``k`` documents for each row where ``is_query`` holds (a column over ``id``): ``query_id``, ``rank``, ``doc_id``, ``score``.

    A query's terms are the distinct lower-case words of its whole text; the
    query itself is among the documents. Equal scores rank by id, null last.

    Edge cases: a query without words, and documents that share no term with
    it, give no rows, so a query can have fewer than ``k``; a null text has
    no words; rows with a null id can be found, not ask; rows that repeat an
    id are documents (and queries) of their own, but a query id is ranked
    once over all of them; an empty table gives an empty result.
    """
    C.ship(docs.sparkSession)
    base = C.as_documents(docs, id_col, text_col)
    shards = C.block_count(base, index_bytes)
    bits = C.power_of_two(shards * index_bytes / 8 / shard_entries)
    placed = C.with_blocks(base.withColumn("is_query", F.coalesce(is_query, F.lit(False))), shards)
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    q_schema, h_schema, c_schema, p_schema = (to_arrow_schema(StructType.fromDDL(x)) for x in (QUERIES, HITS, COUNTED, PACKED))
    counted = C.written(placed.groupBy("block").applyInArrow(C.of_group(lambda t: _count(t, c_schema)), COUNTED), "counts")
    asked = counted.groupBy("block").applyInArrow(C.of_group(lambda t: _ask(t, bits)), C.MESSAGE)
    answers = asked.groupBy("shard").applyInArrow(C.of_group(_answer), C.MESSAGE)
    found = C.written(counted.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(C.of_groups(lambda a, b: _queries(a, b, q_schema)), QUERIES), "queries")
    stats = found.agg(F.sum("documents"), F.sum("words"), F.sum(F.octet_length("terms") + F.octet_length("frequencies"))).first()
    n_docs, n_words, size = (int(x or 0) for x in stats)
    parts = max(1, math.ceil(size / query_bytes))
    here = counted.select("block", "payload", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"))
    queries = (found.where(F.col("id").isNotNull()).dropDuplicates(["id", "terms"])
               .select("id", "terms", "frequencies", F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int").alias("part")))

    def met(shard_ids: list[int], asking: DataFrame) -> DataFrame:
        """Hits of some shards; every query block meets every shard once."""
        asking = asking.groupBy("part").applyInArrow(C.of_group(lambda t: _pack_queries(t, p_schema)), PACKED).withColumn("block", F.explode(F.lit(shard_ids).cast("array<int>")))
        return here.where(F.pmod("block", F.lit(FIRST)).isin(sorted({x % FIRST for x in shard_ids}))).groupBy("block", "part").cogroup(asking.groupBy("block", "part")).applyInArrow(
            C.of_groups(lambda a, b: _search(a, b, k, n_docs, n_words, h_schema)), HITS)

    # the k-th best score in the first shards is one that the result has at least, so the others start from it
    first = C.written(met(list(range(0, shards, FIRST)), queries.withColumn("floor", F.lit(0.0))), "hits")
    nth = F.row_number().over(W.partitionBy("query_id").orderBy(F.col("score").desc()))
    floors = first.withColumn("nth", nth).where(F.col("nth") == k).select(F.col("query_id").alias("id"), F.col("score").alias("floor"))
    rest = [x for x in range(shards) if x % FIRST]
    hits = first
    if rest:
        hits = hits.union(met(rest, queries.join(floors, "id", "left").withColumn("floor", F.coalesce("floor", F.lit(0.0)))))
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last()))
    return hits.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "doc_id", "score")


def op6_block_max_wand(spark, sf_dir: str) -> DataFrame:
    """Top ten of all documents for every document whose id is divisible by 100, by its whole text."""
    return search(spark.read.parquet(f"{sf_dir}/documents.parquet"), F.col("id") % 100 == 0)


OP6_SQL = r"""
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents
), t AS (SELECT doc_id, len(ws) AS dl, unnest(ws) AS term FROM d
), p AS (SELECT doc_id, dl, term, count(*) AS tf FROM t GROUP BY doc_id, dl, term
), s AS (SELECT count(*) AS n, avg(len(ws)) AS mean FROM d
), f AS (SELECT term, ln(1 + (n - count(*) + 0.5) / (count(*) + 0.5)) AS idf FROM p, s GROUP BY term, n
), h AS (
  SELECT q.doc_id AS query_id, p.doc_id, round(sum(idf * p.tf * 2.2 / (p.tf + 1.2 * (0.25 + 0.75 * p.dl / mean))), 6) AS score
  FROM p q JOIN p ON p.term = q.term JOIN f ON f.term = q.term, s WHERE q.doc_id % 100 = 0 GROUP BY q.doc_id, p.doc_id
), r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM h)
SELECT query_id, rank, doc_id, score FROM r WHERE rank <= 10
"""
