"""Quality by histogram gradient-boosted trees over document statistics.

Statistics are computed for a whole Arrow batch with numpy: shares of byte
classes, word and line shapes, repetition. The trees are fitted on a bounded
sample of labelled documents: features are cut into at most 64 bins at their
quantiles, a node's gradient histogram takes one ``bincount``, and the best
split is read off its running sums. A fitted forest is five flat arrays, and
scoring moves all documents of a batch one level down at a time.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C
from .labelled import held_out, sample_labelled

#: Documents of each label that the trees may learn from: the bound of the sample.
PER_CLASS = 6000
TREES, DEPTH, RATE, BINS, LEAST, PULL = 120, 4, 0.1, 64, 10, 1.0

#: Byte classes whose share of the text is a feature.
CLASSES = {
    "lower": b"abcdefghijklmnopqrstuvwxyz", "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": b"0123456789",
    "symbol": b"#*$%&<>", "bar": b"|", "stop": b".", "comma": b",", "bang": b"!", "ask": b"?", "colon": b":;",
    "bracket": b"()[]{}", "quote": b"\"'`", "slash": b"/\\", "at": b"@", "dash": b"-_", "other": b"+=^~",
    "space": b" ", "line": b"\n", "white": b"\t\r\x0b\x0c", "wide": bytes(range(128, 256)),
}
FEATURES = (*CLASSES, "log_bytes", "log_words", "word_bytes", "longest_word", "line_words", "copied_lines",
            "distinct_words", "repeated_triples", "byte_entropy", "capital_words", "symbol_ends", "single_bytes")
_CLASS = np.zeros((256, len(CLASSES)))
for _k, _chars in enumerate(CLASSES.values()):
    _CLASS[list(_chars), _k] = 1
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>!")] = True


def _distinct_share(first: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Distinct values over values in each document's run of ``h``; 1 where there are none."""
    out = np.ones(len(first) - 1)
    for d in range(len(out)):
        a, z = first[d], first[d + 1]
        if z - a > 1:
            s = np.sort(h[a:z])
            out[d] = (1 + np.count_nonzero(s[1:] != s[:-1])) / (z - a)
    return out


def statistics(column) -> np.ndarray:
    """Feature matrix of a string column, one row a text; null counts as empty."""
    buf, off = C.flat(column)
    rows = [_statistics(buf[off[i]:off[j]], off[i:j + 1] - off[i]) for i, j in C.slices(off, 4 << 20)]
    return np.concatenate(rows) if rows else np.empty((0, len(FEATURES)))


def _statistics(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    docs, size = len(off) - 1, np.diff(off)
    counts = np.array([np.bincount(buf[a:z], minlength=256) for a, z in zip(off, off[1:])], float)
    share = counts / np.maximum(size, 1)[:, None]
    with np.errstate(divide="ignore", invalid="ignore"):
        entropy = -np.nansum(np.where(share > 0, share * np.log2(share), 0), axis=1)
    start, end, first = C.word_bounds(buf, off)
    n, length = np.diff(first), end - start
    h = np.concatenate([C.hash_words(buf, start[a:a + (1 << 18)], end[a:a + (1 << 18)]) for a in range(0, len(start), 1 << 18)]) if len(start) else np.empty(0, np.uint64)
    triples, at = C.windows(h, first, 3)
    many = np.maximum(n, 1)

    def per_word(x):
        total = np.concatenate([[0.0], np.cumsum(x)])
        return (total[first[1:]] - total[first[:-1]]) / many

    longest = np.zeros(docs)
    if len(start):
        full = np.flatnonzero(n)
        longest[full] = np.maximum.reduceat(length, first[full])
    heads, tails = buf[start] if len(start) else buf[:0], buf[end - 1] if len(start) else buf[:0]
    copied, lines_with = np.zeros(docs), np.ones(docs)
    data = buf.tobytes()
    for d in range(docs):
        lines = [x for x in data[off[d]:off[d + 1]].split(b"\n") if x.strip()]
        if lines:
            lines_with[d] = len(lines)
            copied[d] = 1 - len(set(lines)) / len(lines)
    more = [np.log1p(size), np.log1p(n), per_word(length), np.log1p(longest), n / lines_with, copied,
            _distinct_share(first, h), _distinct_share(np.searchsorted(at, first), triples), entropy,
            per_word((heads >= 65) & (heads <= 90)), per_word(_SYMBOL[tails]), per_word(length == 1)]
    return np.concatenate([share @ _CLASS, np.stack(more, 1)], 1)


class Forest(NamedTuple):
    """Trees in flat arrays; node 0 of each tree is its root and a leaf points to itself."""
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    base: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(DEPTH):
                inner = self.left[node] >= 0
                right = x[rows, self.feature[node]] > self.threshold[node]
                node = np.where(inner, self.left[node] + right, node)
            total += self.value[node]
        return total

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x), -700, 700)))


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, rate: float = RATE,
        bins: int = BINS, least: int = LEAST, pull: float = PULL) -> Forest:
    """Boost trees on the logistic loss; splits lie between quantile bins of each feature."""
    n, width = x.shape
    share = np.clip(y.mean() if n else 0.5, 1e-3, 1 - 1e-3)
    feature, threshold, left, value, roots = [], [], [], [], []
    base = float(np.log(share / (1 - share)))
    if not n or y.min() == y.max():
        return Forest(*[np.zeros(0, int)] * 3, np.zeros(0), np.zeros(0, int), base)
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(width)]
    code = np.stack([np.searchsorted(edges[f], x[:, f], "left") for f in range(width)], 1)  # bin b: at most edges[b]
    flat = code + np.arange(width) * bins
    raw = np.full(n, base)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-raw))
        g, h = y - p, p * (1 - p)
        roots.append(len(feature))
        level = [(len(feature), np.arange(n))]
        feature.append(0), threshold.append(0.0), left.append(-1), value.append(0.0)
        for deep in range(depth + 1):
            after = []
            for node, rows in level:
                gs, hs = g[rows].sum(), h[rows].sum()
                value[node] = rate * gs / (hs + pull)
                if deep == depth or len(rows) < 2 * least:
                    raw[rows] += value[node]
                    continue
                cells = flat[rows].ravel()
                sums = [np.cumsum(np.bincount(cells, np.repeat(v, width), width * bins).reshape(width, bins), 1)[:, :-1]
                        for v in (g[rows], h[rows], np.ones(len(rows)))]
                gain = sums[0] ** 2 / (sums[1] + pull) + (gs - sums[0]) ** 2 / (hs - sums[1] + pull) - gs ** 2 / (hs + pull)
                gain[(sums[2] < least) | (len(rows) - sums[2] < least)] = -1
                f, b = divmod(int(gain.argmax()), bins - 1)
                if gain[f, b] <= 1e-6 or b >= len(edges[f]):
                    raw[rows] += value[node]
                    continue
                feature[node], threshold[node], left[node] = f, float(edges[f][b]), len(feature)
                below = code[rows, f] <= b
                for side in (rows[below], rows[~below]):
                    after.append((len(feature), side))
                    feature.append(0), threshold.append(0.0), left.append(-1), value.append(0.0)
            level = after
    return Forest(np.array(feature), np.array(threshold), np.array(left), np.array(value), np.array(roots), base)


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, **options) -> Forest:
    """Fit on at most ``2 * per_class`` labelled documents outside the held-out fold; each label weighs as it occurs."""
    C.ship(docs.sparkSession)
    sample = sample_labelled(docs, labels, "quality", per_class)

    def run(batches):
        for b in batches:
            x = statistics(b.column("text"))
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("label"), pa.array(list(x), pa.list_(pa.float64()))], names=["id", "label", "x"])

    found = sample.mapInArrow(run, "id long, label int, x array<double>").toArrow().sort_by("id")
    if not found.num_rows:
        return fit(np.empty((0, len(FEATURES))), np.empty(0))
    x = np.array(found.column("x").to_pylist())
    return fit(x, found.column("label").to_numpy().astype(float), **options)


def score_quality(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, **options) -> DataFrame:
    """Probability of label 1 of every whole text: ``id``, ``score``.

    Edge cases: a null text counts as empty and is scored on its statistics
    (all zero); with labels of one kind only, or none, every score is their
    (clipped) share, 0.5 without any; a null id is scored but never learned
    from; extra columns do no harm.
    """
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels, per_class, **options))  # some thousand nodes
    d = docs.select(docs["doc_id"].cast("long").alias("id"), docs["text"].cast("string").alias("text"))

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(shared.value.probability(statistics(b.column("text"))))], names=["id", "score"])

    return d.mapInArrow(C.of_batches(run), "id long, score double")


def op7_quality_trees(spark, sf_dir: str) -> DataFrame:
    """Contract of the registered query: score and decision of every document."""
    out = score_quality(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return out.select(F.col("id").alias("doc_id"), held_out(F.col("id")).alias("held_out"), "score",
                      (F.col("score") >= 0.3).cast("int").alias("predicted"))
