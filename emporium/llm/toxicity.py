"""Toxicity by two class-conditional Kneser-Ney models of how words are spelled.

Toxic expressions come in many inflections, most of them rare, so the models
read words byte by byte: the probability of a byte after the ``order - 1``
bytes before it, once in toxic and once in ordinary documents. Each class has
its own counts at the highest order; what they lack backs off to one chain of
lower orders shared by both, with Kneser-Ney's continuation counts. A rare
byte sequence thus gets the same backoff on both sides and weighs nothing,
unless one class's history rules it out.

A toxic document is mostly ordinary text, so its likelihood is that of a
mixture which draws ``share`` of the words from the toxic model. The evidence
is the log likelihood ratio of mixture and ordinary model over the number of
words; a logistic curve, fitted on sampled documents that the counts never
saw, turns it into a score.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C
from .labelled import held_out, sample_labelled

ORDER = 6
DISCOUNT = 0.75
SHARE = 0.03
#: Documents of each class that the models may learn from: the bound of the sample.
PER_CLASS = 4000
#: One in so many sampled documents only serves to fit the curve.
CURVE_FOLD = 4
BEGIN, END = 2, 3
LETTERS = np.zeros(256, bool)
LETTERS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def _spans(buf: np.ndarray, off: np.ndarray):
    """Runs of letters, digits and non-ASCII bytes, and the index of each document's first run."""
    clean = np.where(LETTERS[buf], C.LOWER[buf], np.uint8(32))
    return clean, *C.word_bounds(clean, off)


def _distinct_words(clean, start, end):
    """Distinct words as (first place, index of each word in them)."""
    h = np.concatenate([C.hash_words(clean, start[a:a + (1 << 18)], end[a:a + (1 << 18)]) for a in range(0, len(start), 1 << 18)])
    _, at, inverse = np.unique(h, return_index=True, return_inverse=True)
    return at, inverse


def grams(buf: np.ndarray, start: np.ndarray, end: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Every byte of the words, and their ends, with the ``order - 1`` before it as one number; and the first of each word."""
    size = end - start + 1
    first = np.cumsum(size) - size
    pos = np.arange(size.sum()) - np.repeat(first, size)
    src = np.minimum(np.repeat(start, size) + pos, len(buf) - 1)
    stop = pos == np.repeat(size - 1, size)
    now = np.where(stop, np.uint8(END), buf[src]).astype(np.uint64)
    code = now.copy()
    for k in range(1, order):
        before = np.zeros_like(now)
        before[k:] = now[:-k]
        code |= np.where(pos >= k, before, np.uint64(BEGIN)) << np.uint64(8 * k)
    return code, first


def _sums(codes: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys, inverse = np.unique(codes, return_inverse=True)
    return keys, np.bincount(inverse, weights, len(keys))


def _find(keys: np.ndarray, values: np.ndarray, at: np.ndarray, default: float = 0.0) -> np.ndarray:
    if not len(keys):
        return np.full(len(at), default)
    i = np.minimum(np.searchsorted(keys, at), len(keys) - 1)
    return np.where(keys[i] == at, values[i], default)


class Model(NamedTuple):
    """Log ratios by whole gram and, for grams that no class has, by history; and the curve."""
    order: int
    keys: np.ndarray
    ratios: np.ndarray
    history_keys: np.ndarray
    history_ratios: np.ndarray
    share: float
    slope: float
    offset: float
    constant: float | None = None


def _shared(codes: np.ndarray, grams_above: np.ndarray, order: int, discount: float) -> np.ndarray:
    """Kneser-Ney probability by continuation counts: in how many histories one byte longer a gram occurs."""
    if order == 0:
        return np.full(len(codes), 1 / 256)
    mask = np.uint64((1 << (8 * order)) - 1)
    keys, n = np.unique(grams_above & mask, return_counts=True)
    h, total = _sums(keys >> np.uint64(8), n.astype(float))
    _, kinds = _sums(keys >> np.uint64(8), np.ones(len(keys)))
    codes = codes & mask
    total_at = _find(h, total, codes >> np.uint64(8))
    lower = _shared(codes, keys, order - 1, discount)
    with np.errstate(divide="ignore", invalid="ignore"):
        p = (np.maximum(_find(keys, n.astype(float), codes) - discount, 0) + discount * _find(h, kinds, codes >> np.uint64(8)) * lower) / total_at
    return np.where(total_at > 0, p, lower)


def fit(words: list[bytes], counts: np.ndarray, order: int = ORDER, discount: float = DISCOUNT, share: float = SHARE) -> Model:
    """Models from distinct words and their counts in ordinary (column 0) and toxic documents (column 1)."""
    size = np.array([len(w) for w in words], np.int64)
    end = np.cumsum(size)
    code, _ = grams(np.frombuffer(b"".join(words), np.uint8), end - size, end, order)
    keys, inverse = np.unique(code, return_inverse=True)
    each = np.repeat(counts, size + 1, axis=0)
    history, group = np.unique(keys >> np.uint64(8), return_inverse=True)
    shared = _shared(keys, keys, order - 1, discount)
    p, weights = [], []
    for k in (0, 1):
        n = np.bincount(inverse, each[:, k], len(keys))
        total = np.bincount(group, n, len(history))
        kinds = np.bincount(group, n > 0, len(history))
        weight = np.where(total > 0, discount * kinds / np.maximum(total, 1), 1.0)
        p.append(np.where(total[group] > 0, np.maximum(n - discount, 0) / np.maximum(total[group], 1), 0) + weight[group] * shared)
        weights.append(weight)
    return Model(order, keys, np.log(p[1] / p[0]).astype(np.float32), history, np.log(weights[1] / weights[0]).astype(np.float32), share, 1.0, 0.0)


def evidence(column, model: Model, slice_bytes: int = 4 << 20) -> np.ndarray:
    """Log likelihood ratio of toxic mixture and ordinary model, per word, of each text; 0 without words."""
    buf, off = C.flat(column)
    out = []
    for i, j in C.slices(off, slice_bytes):
        clean, start, end, first = _spans(buf[off[i]:off[j]], off[i:j + 1] - off[i])
        if not len(start):
            out.append(np.zeros(j - i))
            continue
        at, inverse = _distinct_words(clean, start, end)
        code, begin = grams(clean, start[at], end[at], model.order)
        k = np.minimum(np.searchsorted(model.keys, code), len(model.keys) - 1)
        ratio = np.where(model.keys[k] == code, model.ratios[k], np.nan)
        missing = np.flatnonzero(np.isnan(ratio))
        ratio[missing] = _find(model.history_keys, model.history_ratios, code[missing] >> np.uint64(8))
        word = np.add.reduceat(ratio, begin)
        gain = np.logaddexp(np.log(1 - model.share), np.log(model.share) + word)
        total = np.concatenate([[0], np.cumsum(gain[inverse])])
        out.append((total[first[1:]] - total[first[:-1]]) / np.maximum(np.diff(first), 1))
    return np.concatenate(out) if out else np.empty(0)


def _stretch(x: np.ndarray) -> np.ndarray:
    """Evidence on a log scale: from one toxic word in some hundred on, twice the rate is the same step."""
    return np.log(np.maximum(x, 0) + 0.03)


def fit_curve(x: np.ndarray, y: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and offset of a logistic curve on standardised evidence, with a weak pull to zero; classes weigh the same."""
    mean, scale = x.mean(), x.std() or 1.0
    a = np.stack([(x - mean) / scale, np.ones(len(x))], 1)
    w, weight = np.zeros(2), np.where(y == 1, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9))
    pull = np.diag([1e-2, 1e-6]) * len(x) / 10
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a.T * (weight * p * (1 - p))) @ a + pull, a.T @ (weight * (y - p)) - pull @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w[0] / scale, w[1] - w[0] * mean / scale


def _count_words(batches):
    """Distinct words of each label in a batch, with their counts."""
    for batch in batches:
        label = np.asarray(batch.column("label"))
        for k in (0, 1):
            texts = batch.column("text").filter(pa.array(label == k))
            buf, off = C.flat(texts)
            clean, start, end, _ = _spans(buf, off)
            if not len(start):
                continue
            at, inverse = _distinct_words(clean, start, end)
            data = clean.tobytes()
            yield pa.RecordBatch.from_arrays(
                [pa.array([data[a:z] for a, z in zip(start[at].tolist(), end[at].tolist())], pa.binary()),
                 pa.array(np.full(len(at), k, np.int32)), pa.array(np.bincount(inverse).astype(np.int64))], names=["word", "label", "n"])


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, order: int = ORDER, share: float = SHARE) -> Model:
    """Fit the models on a bounded sample of labelled documents outside the held-out fold."""
    C.ship(docs.sparkSession)
    sample = C.written(sample_labelled(docs, labels, "toxic", per_class), "toxicity-sample")
    curve = F.pmod(F.xxhash64("id", F.lit("curve")), F.lit(CURVE_FOLD)) == 0
    found = (sample.where(~curve).select("text", "label").mapInArrow(C.of_batches(_count_words), "word binary, label int, n long")
             .groupBy("word").agg(F.sum(F.when(F.col("label") == 0, F.col("n"))).alias("a"), F.sum(F.when(F.col("label") == 1, F.col("n"))).alias("b")).toArrow())
    counts = np.stack([np.nan_to_num(found.column(c).to_numpy().astype(float)) for c in ("a", "b")], 1) if found.num_rows else np.zeros((0, 2))
    if not (counts.sum(0) > 0).all():  # one class is missing: nothing to compare
        mean = sample.agg(F.avg("label")).first()[0]
        return Model(order, *[np.empty(0)] * 4, share, 0.0, 0.0, constant=float(mean or 0.0))
    model = fit(found.column("word").to_pylist(), counts, order, DISCOUNT, share)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the sample
    seen = (sample.where(curve).mapInArrow(
        lambda batches: (pa.RecordBatch.from_arrays([pa.array(evidence(b.column("text"), shared.value)), b.column("label")], names=["x", "label"])
                         for b in batches), "x double, label int").toArrow())
    x, y = (seen.column(c).to_numpy() for c in ("x", "label"))
    if len(set(y.tolist())) < 2:
        return model._replace(slope=6.0, offset=15.0)
    slope, offset = fit_curve(_stretch(x), y.astype(float))
    return model._replace(slope=float(slope), offset=float(offset))


def score_texts(column, model: Model) -> np.ndarray:
    if model.constant is not None:
        return np.full(len(column), model.constant)
    return 1 / (1 + np.exp(-np.clip(model.slope * _stretch(evidence(column, model)) + model.offset, -700, 700)))


def score_toxicity(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, carry=(), **options) -> DataFrame:
    """Toxicity of every whole text as ``id``, ``score`` in [0, 1], and ``carried`` (a struct) with ``carry``.

    Edge cases: a null or empty text has no evidence and gets the curve's
    value at 0, a low score; without labels of both classes every score is
    the share of toxic labels (0 without any); a null id is scored like any
    other and never learned from; extra columns do no harm.
    """
    model = train(docs, labels, per_class, **options)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    inside = "text" in carry  # the text then travels once, inside the struct
    d = docs.select(docs["doc_id"].cast("long").alias("id"), *([] if inside else [docs["text"].cast("string").alias("text")]),
                    *([F.struct(*[docs[c].alias(c) for c in carry]).alias("carried")] if carry else []))

    def run(batches):
        for b in batches:
            text = b.column("carried").field("text") if inside else b.column("text")
            columns = [b.column("id"), pa.array(score_texts(text, shared.value), pa.float64())]
            yield pa.RecordBatch.from_arrays(columns + ([b.column("carried")] if carry else []), names=["id", "score"] + ["carried"] * bool(carry))

    kinds = "id long, score double" + (f", carried {d.schema['carried'].dataType.simpleString()}" if carry else "")
    return d.mapInArrow(C.of_batches(run), kinds)


def op10_toxicity(spark, sf_dir: str) -> DataFrame:
    """Contract of the registered query: score and decision of every document."""
    out = score_toxicity(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return out.select(F.col("id").alias("doc_id"), held_out(F.col("id")).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))
