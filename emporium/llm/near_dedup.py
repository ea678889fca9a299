"""Near duplicates by HyperMinHash.

A document's set are its distinct shingles of five lower-case words, hashed
to 64 bits. The first bits of a hash pick one of 256 buckets; of the least
remainder in a bucket a register stores the count of leading zeros and ten
mantissa bits, 16 bits in all.

1. Equal sets are one class, found by a 128-bit fingerprint; its smallest id
   stands for it, so a group of exact copies, however large, is one node.
2. Nodes get buckets by bands of six registers. Empty registers first borrow
   from filled ones of their set, in an order fixed for each register, so a
   band always compares six draws from the set and not mere emptiness. Sets
   below ``TINY`` shingles go by prefixes instead, which lose no pair.
3. The buckets' stars, each member to the smallest, are candidate edges
   (linear in the members); their connected components are clusters.
4. A cluster's texts meet in one task. Pairs not yet connected there go
   through the size bound, then the Jaccard estimate of their registers,
   corrected for registers that agree by chance, and then the exact test on
   the full sets. It emits a spanning forest of the links, never all pairs.
5. Components of these links, smallest id first, are the result.

A cluster above ``cluster_nodes`` or ``cluster_bytes`` of text is verified in
steps (:func:`_large_groups`): first every node with the smallest node it
shares a bucket with, which takes rows in proportion to the cluster and joins
up a group of true copies; then, only where a bucket still holds nodes that
are not connected, by bucket or by pairs of slices of what is left, whichever
needs fewer rows. At similarity 0.85 a pair of larger sets misses all 42
bands with a chance of about 2e-9, at 0.8 of 3e-6; the README has the recall
measured for each size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C
from .components import components

SHINGLE = 5
BUCKET_BITS, MANTISSA_BITS = 8, 10
BUCKETS = 1 << BUCKET_BITS
BAND_REGISTERS = 6
BANDS = BUCKETS // BAND_REGISTERS
#: Least similarity in percent.
PERCENT = 85
#: Sets with fewer shingles are matched by shared shingles of their prefixes, exactly.
TINY = 40
#: Shingles that two prefixes must share, unless so few are needed at all.
SHARED = 3
#: Most nodes verified in one group, and most bytes of their texts; the hashes take some more than the texts.
CLUSTER_NODES = 8192
CLUSTER_BYTES = 64 << 20
#: Standard deviations that an estimate may lie below the least similarity.
MARGIN = 5.0


# --- sets and registers -----------------------------------------------------------

def shingle_sets(column, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Ascending distinct shingle hashes of all texts after each other, and the bounds of each."""
    w = C.words(column, lower=True)
    h, at = C.windows(w.hashes[0], w.first, k)
    first = np.searchsorted(at, w.first)
    sets = []
    for d, n in enumerate(w.counts):
        if n >= k:
            s = np.sort(h[first[d]:first[d + 1]])
            sets.append(s[np.concatenate([[True], s[1:] != s[:-1]])])
        elif n:  # the whole sequence is the only shingle
            own = w.hashes[0][w.first[d]:w.first[d + 1]] * C.powers(int(n) + 1, C.BASES[1])[1:]
            sets.append(C.mix(own.sum(keepdims=True) + np.uint64(n)))
        else:
            sets.append(np.empty(0, np.uint64))
    sizes = np.array([len(s) for s in sets], np.int64)
    return (np.concatenate(sets) if sets else np.empty(0, np.uint64)), np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


def registers(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """HyperMinHash registers of each set: 0 if empty, else 1 + (leading zeros, mantissa) of the bucket's least remainder."""
    out = np.zeros((len(first) - 1, BUCKETS), np.uint16)
    if not len(values):
        return out
    rest_bits = 64 - BUCKET_BITS
    bucket = (values >> np.uint64(rest_bits)).astype(np.int64)
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    new = np.ones(len(values), bool)
    new[1:] = (bucket[1:] != bucket[:-1]) | (doc[1:] != doc[:-1])  # sets ascend: the first of a bucket is its least
    rest = values[new] & np.uint64((1 << rest_bits) - 1)
    # position of the highest one, exact also where a float rounds up
    top = np.frexp((rest >> np.uint64(8)).astype(np.float64))[1].astype(np.int64) + 8
    small = rest < np.uint64(256)
    top[small] = np.frexp(rest[small].astype(np.float64))[1]
    zeros = np.minimum(rest_bits - top, 53)
    below = np.maximum(rest_bits - 1 - zeros, 0)  # bits after the leading one
    shift = below - MANTISSA_BITS
    mantissa = np.where(shift >= 0, rest >> np.maximum(shift, 0).astype(np.uint64), rest << np.maximum(-shift, 0).astype(np.uint64))
    mantissa = mantissa & np.uint64((1 << MANTISSA_BITS) - 1)
    out[doc[new], bucket[new]] = 1 + (zeros << MANTISSA_BITS) + mantissa.astype(np.int64)
    return out


def _lenders() -> np.ndarray:
    """For each register the order in which it looks at the others when it is empty."""
    g = np.random.Generator(np.random.PCG64(7))
    return np.array([g.permutation(BUCKETS) for _ in range(BUCKETS)])


LENDERS = _lenders()


def densified(regs: np.ndarray) -> np.ndarray:
    """Registers with every empty one filled from the first filled one in its order; sets without any stay empty."""
    out = regs.copy()
    row, at = np.nonzero((regs == 0) & regs.any(1)[:, None])
    for step in range(BUCKETS):
        if not len(row):
            break
        value = regs[row, LENDERS[at, step]]
        found = value > 0
        out[row[found], at[found]] = value[found]
        row, at = row[~found], at[~found]
    return out


def band_keys(regs: np.ndarray) -> np.ndarray:
    """Key of every band of each set."""
    bands = densified(regs)[:, :BANDS * BAND_REGISTERS].reshape(len(regs), BANDS, BAND_REGISTERS)
    key = np.zeros(bands.shape[:2], np.uint64)
    for j in range(BAND_REGISTERS):
        key = C.mix(key * C.BASES[0] + bands[:, :, j].astype(np.uint64) + np.uint64(1))
    return C.mix(key + np.arange(BANDS, dtype=np.uint64)).view(np.int64)


def prefix_keys(values: np.ndarray, percent: int, shared: int) -> np.ndarray:
    """Keys of one small ascending set: every choice of ``shared`` shingles among its first ones.

    Two sets of similarity ``percent`` have at least c = percent % of the
    larger's shingles in common. Of all shingles in the order of their hashes,
    the first n - c + shared of either set then hold ``shared`` common ones.
    """
    common = -(-percent * len(values) // 100)
    first = values[:len(values) - common + shared]
    keys = np.zeros(1, np.uint64)
    last = np.full(1, -1)
    for _ in range(shared):  # grow each choice by every later shingle
        grow = len(first) - 1 - last
        own = np.repeat(np.arange(len(keys)), grow)
        last = np.arange(len(own)) - np.repeat(np.cumsum(grow) - grow, grow) + last[own] + 1
        keys = C.mix(keys[own] * C.BASES[1] + first[last])
    return keys.view(np.int64)


def bucket_keys(values: np.ndarray, first: np.ndarray, regs: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and key of every bucket of the sets. Sizes around ``TINY`` take part in both ways, so no pair falls between."""
    sizes, least = np.diff(first), _least_size(percent)
    shared = min(SHARED, -(-percent * least // 100))
    banded = np.flatnonzero(sizes >= max(TINY, least))
    keys = band_keys(regs[banded])
    rows, found = [np.repeat(banded, BANDS)], [keys.reshape(-1)]
    for d in np.flatnonzero((sizes >= least) & (sizes * percent < 100 * TINY)):
        k = prefix_keys(values[first[d]:first[d + 1]], percent, shared)
        rows.append(np.full(len(k), d)), found.append(k)
    return np.concatenate(rows), np.concatenate(found)


def _least_size(percent: int) -> int:
    """Two different sets that are linked have a union of so many shingles at least; smaller sets only link with equals."""
    return -(-percent * -(-100 // max(100 - percent, 1)) // 100)


#: Chance that registers of different least elements agree: equal leading zeros (1/3) and equal mantissa.
COLLISION = 2.0 ** -MANTISSA_BITS / 3


def estimate(one: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Collision-corrected Jaccard estimate of a register row with others, and the registers it rests on."""
    agree = ((others == one) & (one > 0)).sum(1)
    filled = np.maximum(((others > 0) | (one > 0)).sum(1), 1)
    return np.maximum((agree / filled - COLLISION) / (1 - COLLISION), 0), filled


# --- tasks ------------------------------------------------------------------------

SIGNS = "id long, n long, size long, print1 long, print2 long, keys binary"


def _sign(batches, percent: int):
    for batch in batches:
        texts, ids = batch.column("text"), batch.column("id")
        others = [name for name in batch.schema.names if name == "carried"]
        _, off = C.flat(texts)
        for i, j in C.slices(off, 8 << 20):
            values, first = shingle_sets(texts.slice(i, j - i))
            sizes = np.diff(first)
            prints = [np.zeros(j - i, np.uint64) for _ in range(2)]
            full = np.flatnonzero(sizes)
            for k, p in enumerate(prints):
                if len(full):
                    p[full] = np.add.reduceat(C.mix(values * C.BASES[k] + np.uint64(k + 1)), first[full])
            row, key = bucket_keys(values, first, registers(values, first), percent)
            order = np.argsort(row, kind="stable")
            keys, bounds = key[order], np.searchsorted(row[order], np.arange(j - i + 1))
            yield pa.RecordBatch.from_arrays(
                [ids.slice(i, j - i), pa.array(sizes), pa.array(np.diff(off[i:j + 1])), *(pa.array(p.view(np.int64)) for p in prints),
                 pa.array([keys[a:b].tobytes() for a, b in zip(bounds, bounds[1:])], pa.binary()), *(batch.column(c).slice(i, j - i) for c in others)],
                names=[x.split()[0] for x in SIGNS.split(", ")] + others)


def _buckets(batches):
    for batch in batches:
        if batch.num_rows:
            cells = batch.column("keys").to_pylist()
            key = np.frombuffer(b"".join(cells), np.int64)
            node = np.repeat(np.asarray(batch.column("id")), [len(c) // 8 for c in cells])
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(node)], names=["key", "node"])


def linked(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    """The exact test on two ascending sets: 100 * intersection >= percent * union."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if not len(small):
        return False
    at = np.minimum(np.searchsorted(large, small), len(large) - 1)
    both = int(np.count_nonzero(large[at] == small))
    return 100 * both >= percent * (len(a) + len(b) - both)


def spanning_links(ids: np.ndarray, values: np.ndarray, first: np.ndarray, percent: int = PERCENT,
                   labels: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links that connect what all links among these sets connect: pairs already connected, or with equal labels, are not tested."""
    regs, sizes = registers(values, first), np.diff(first)
    group = np.arange(len(ids)) if labels is None else np.unique(labels, return_inverse=True)[1]
    found, least = [], percent / 100
    for i in range(len(ids) - 1):
        rest = np.arange(i + 1, len(ids))
        rest = rest[(group[rest] != group[i]) & (100 * np.minimum(sizes[rest], sizes[i]) >= percent * np.maximum(sizes[rest], sizes[i]))]
        if not len(rest):
            continue
        guess, filled = estimate(regs[i], regs[rest])
        near = guess >= least - MARGIN * np.sqrt(least * (1 - least) / filled)
        for j in rest[near][np.argsort(-guess[near], kind="stable")]:
            if group[j] != group[i] and linked(values[first[i]:first[i + 1]], values[first[j]:first[j + 1]], percent):
                found.append((int(ids[i]), int(ids[j])))
                group[group == group[j]] = group[i]
    return found


def _verify(table: pa.Table, percent: int) -> pa.Table:
    table = table.sort_by([("node", "ascending"), ("text", "ascending")])
    values, first = shingle_sets(table.column("text"))
    labels = np.asarray(table.column("label")) if "label" in table.column_names else None
    found = spanning_links(np.asarray(table.column("node")), values, first, percent, labels)
    a, b = zip(*found) if found else ((), ())
    return pa.table([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


# --- clusters above the bounds ------------------------------------------------------

def _slices(members, weight, cluster_nodes: int, cluster_bytes: int):
    """Into how many slices by hash a group is dealt, so that two of them are within the bounds, about."""
    return F.greatest(F.lit(1), F.ceil(members / cluster_nodes * 2), F.ceil(weight / cluster_bytes * 2)).cast("int")


def _large_groups(joined: DataFrame, large: DataFrame, verified, cluster_nodes: int, cluster_bytes: int) -> DataFrame:
    """Links in clusters above the bounds. ``large``: their nodes with ``weight`` and ``cluster``; ``joined``: all buckets.

    First each node meets the smallest node it shares a bucket with, in
    slices that take that node along: one row a node. Buckets whose members
    are then all connected are done. Nodes of the others are verified again,
    without what is connected: as slices of their cluster, every two of them
    together, or bucket by bucket (again in slices where one is too large),
    by whichever needs fewer rows in that cluster. Every pair that shares a
    bucket is so tested or connected.
    """
    own = F.pmod(F.xxhash64("node"), F.col("slices")).cast("int")
    mine = C.written(joined.join(large, "node"), "large-buckets")  # key, node, least, weight, cluster
    hubs = mine.groupBy("node").agg(F.min("least").alias("hub"), F.first("weight").alias("weight"))
    sizes = hubs.groupBy("hub").agg(_slices(F.count("*"), F.sum("weight"), cluster_nodes, cluster_bytes).alias("slices"))
    dealt = hubs.join(sizes, "hub").select("node", F.xxhash64("hub", own).alias("group"))
    along = sizes.withColumn("own", F.explode(F.sequence(F.lit(0), F.col("slices") - 1))).select(
        F.col("hub").alias("node"), F.xxhash64("hub", "own").alias("group"))
    found = C.written(verified(dealt.unionByName(along)), "hub-links")

    label = components(found)
    labelled = C.written(mine.join(label, "node", "left").withColumn("label", F.coalesce("label", "node")), "labelled")
    mixed = labelled.groupBy("key").agg(
        F.min("label").alias("x"), F.max("label").alias("y"),
        _slices(F.count("*"), F.sum("weight"), cluster_nodes, cluster_bytes).alias("slices")).where("x <> y").select("key", "slices")
    rest = C.written(labelled.join(mixed, "key"), "rest")
    rows = F.greatest(F.lit(1), F.col("slices") - 1)
    one = rest.groupBy("cluster", "node").agg(F.first("weight").alias("weight"), F.first("label").alias("label"), F.sum(rows).alias("by_bucket"))
    costs = one.groupBy("cluster").agg(_slices(F.count("*"), F.sum("weight"), cluster_nodes, cluster_bytes).alias("slices"),
                                       F.count("*").alias("nodes"), F.sum("by_bucket").alias("by_bucket"))
    whole = C.written(costs.where(F.col("nodes") * rows <= F.col("by_bucket")).select("cluster", "slices"), "whole")
    units = (one.join(whole, "cluster").select("node", "label", F.col("cluster").alias("unit"), F.lit(True).alias("all"), "slices")
             .unionByName(rest.join(whole, "cluster", "left_anti")
                          .select("node", "label", F.col("key").alias("unit"), F.lit(False).alias("all"), "slices")))
    pairs = (units.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
             .where((F.col("slices") == 1) | (F.col("own") != F.col("other")))
             .select("node", "label", F.xxhash64("all", "unit", F.least("own", "other"), F.greatest("own", "other")).alias("group")))
    return found.unionByName(verified(pairs))


# --- the operator -------------------------------------------------------------------

def near_duplicates(docs: DataFrame, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text",
                    cluster_nodes: int = CLUSTER_NODES, carry=(), cluster_bytes: int = CLUSTER_BYTES) -> DataFrame:
    """``id``, ``n_shingles``, ``component`` (smallest id reachable by links) and ``kept`` of each input row.

    ``carry`` names input columns to pass on in a struct ``carried``; they are
    written with the registers, so they should be narrow.

    Edge cases: a text without words (or null) has an empty set and is linked
    with nothing; fewer than five words are one shingle; equal rows are one
    document; rows that share an id but not the text count as one document
    with several sets; a row with a null id is linked with nothing, has a
    null component and stays; an empty table gives an empty result.
    """
    C.ship(docs.sparkSession)
    base = C.as_documents(docs, id_col, text_col)
    wide = docs.select(docs[id_col].cast("long").alias("id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"),
                       F.struct(*[docs[c].alias(c) for c in carry]).alias("carried")) if carry else base
    more = ["carried"] if carry else []
    kinds = SIGNS + (f", carried {wide.schema['carried'].dataType.simpleString()}" if carry else "")
    signs = C.written(wide.mapInArrow(C.of_batches(lambda batches: _sign(batches, percent)), kinds), "signs")
    named = signs.where(F.col("id").isNotNull() & (F.col("n") > 0))
    copies = C.written(named.groupBy("print1", "print2").agg(F.min("id").alias("least"), F.count("*").alias("rows")).where("rows > 1")
                       .select("print1", "print2", "least"), "copies")
    slim = signs.select("id", "n", "print1", "print2", *more)
    known = F.col("id").isNotNull() & (F.col("n") > 0)
    members = slim.join(copies, ["print1", "print2"], "left").select("id", "n", F.when(known, F.coalesce("least", "id")).alias("node"), *more)
    nodes = (named.where(F.col("n") >= _least_size(percent)).join(copies, ["print1", "print2"], "left")
             .where(F.coalesce("least", "id") == F.col("id")).select("id", "keys"))
    buckets = C.written(nodes.mapInArrow(C.of_batches(_buckets), "key long, node long"), "keys")
    shared = C.written(buckets.groupBy("key").agg(F.min("node").alias("least"), F.max("node").alias("most"))
                       .where("least <> most").select("key", "least"), "buckets")
    joined = buckets.join(shared, "key")
    clusters = components(joined.select(F.col("node").alias("a"), F.col("least").alias("b")))
    # all rows of a node's id come into its group
    weights = signs.where("id is not null").groupBy(F.col("id").alias("node")).agg(F.sum("size").alias("weight"))
    weighed = C.written(clusters.join(weights, "node").withColumnRenamed("label", "cluster"), "weights")
    sizes = weighed.groupBy("cluster").agg(F.count("*").alias("members"), F.sum("weight").alias("bytes"))
    sized = C.written(weighed.join(sizes, "cluster"), "clusters")
    fits = (F.col("members") <= cluster_nodes) & (F.col("bytes") <= cluster_bytes)
    texts = base.select(F.col("id").alias("node"), "text")

    def verified(grouped: DataFrame) -> DataFrame:
        """Links within each ``group`` of nodes; rows of one id and text come once into each."""
        return (grouped.distinct().join(texts, "node").groupBy("group")
                .applyInArrow(C.of_group(lambda t: _verify(t, percent)), "a long, b long"))

    links = verified(sized.where(fits).select("node", F.col("cluster").alias("group")))
    large = C.written(sized.where(~fits).select("node", "weight", "cluster"), "large")
    if not large.isEmpty():
        links = links.unionByName(_large_groups(joined, large, verified, cluster_nodes, cluster_bytes))
    label = components(links).select("node", "label")
    out = members.join(label, "node", "left")
    component = F.coalesce("label", "node", "id")
    return out.select("id", F.col("n").alias("n_shingles"), component.alias("component"),
                      F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"), *more)


def op1_hyperminhash(spark, sf_dir: str) -> DataFrame:
    """Contract of the registered query: set size, component and decision of every document."""
    out = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select(F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"), "kept")


OP1_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i FROM w WHERE len(ws) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), e AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id
  JOIN n x ON x.doc_id = a.doc_id JOIN n y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))
), r(doc_id, c) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.doc_id WHERE r.c < e.b
)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, min(r.c) AS component_id, d.doc_id = min(r.c) AS kept
FROM documents d LEFT JOIN n USING (doc_id) JOIN r USING (doc_id) GROUP BY d.doc_id, n.n
"""
