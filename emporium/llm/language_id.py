"""Language identification in two steps: family, then one-versus-one machines.

A text is a histogram of its hashed byte runs of one to four letters, words
bounded by a space; the square roots of the shares make it a unit vector.

1. *Families* come from the labelled sample: languages whose mean vectors are
   alike are merged pair by pair (average linkage), up to the widest gap
   between two merges. Languages that are easily told apart so end up in
   different families, closely related ones share one.
2. A multinomial logistic model tells the family.
3. Inside a family a linear support vector machine for each pair of languages
   (squared hinge loss) votes; equal votes go by the sum of margins. Each
   machine's margins are turned into a probability by a logistic curve.

The models are fitted on the driver from at most ``SAMPLE`` labelled texts,
as sparse histograms; all texts are then scored in one pass.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import common as C
from .labelled import held_out

#: Bounds of the labelled sample: texts of one language, texts of all, and languages (the most frequent ones).
PER_LANGUAGE, SAMPLE, LANGUAGES = 800, 6400, 200
WIDTH_BITS = 12
WIDTH = 1 << WIDTH_BITS
LONGEST_RUN = 4
#: Texts whose histograms are held at once: 8 MB of them.
ROWS_AT_ONCE = 512
FOLDS, REST = 4, 2
UNKNOWN = "und"

#: ASCII letters in lower case, other ASCII as space, bytes of other characters as they are.
LETTERS = np.full(256, 0x20, np.uint8)
LETTERS[0x61:0x7B] = LETTERS[0x41:0x5B] = np.arange(0x61, 0x7B)
LETTERS[0x80:] = np.arange(0x80, 0x100)


# --- texts as vectors ---------------------------------------------------------------

def histograms(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Counts of hashed runs, a row for each text ``buf[off[i]:off[i + 1]]``."""
    n = len(off) - 1
    text = np.insert(LETTERS[buf], off[:-1], 0x20)  # a space before each text, which also ends the one before
    begin = off[:-1] + np.arange(n)
    opens = np.zeros(len(text), bool)
    opens[begin] = True
    space = text == 0x20
    keep = ~space | opens
    keep[1:] |= space[1:] & ~space[:-1]
    keep[:-1] &= ~(space[:-1] & opens[1:] & ~opens[:-1])  # the next text's space is enough
    own = np.cumsum(opens)[keep] - 1
    text = np.append(text[keep], np.uint8(0x20))
    stop = np.append(np.flatnonzero(opens[keep])[1:], len(text) - 1)[own] if n else own  # place of the closing space
    h = np.zeros(len(own), C.U64)
    cells = []
    for k in range(LONGEST_RUN):
        more = text[k:k + len(h)].astype(C.U64)
        h = h[:len(more)] * C.BASES[0] + more + C.U64(1)
        at = np.flatnonzero(np.arange(len(h)) + k <= stop[:len(h)])
        if not k:
            at = at[text[at] != 0x20]
        bucket = (C.mix(h[at] + C.U64(k)) >> C.U64(64 - WIDTH_BITS)).astype(np.int64)
        cells.append(own[at] * WIDTH + bucket)
    return np.bincount(np.concatenate(cells), minlength=n * WIDTH).reshape(n, WIDTH)


def vectors(counts: np.ndarray) -> np.ndarray:
    return np.sqrt(counts / np.maximum(counts.sum(1, keepdims=True), 1)).astype(np.float32)


# --- models --------------------------------------------------------------------------

def descend(gradient, shape, rounds: int = 300, step: float = 1.0) -> np.ndarray:
    """Minimise a smooth convex loss by accelerated gradient steps."""
    w = ahead = np.zeros(shape, np.float32)
    for t in range(rounds):
        new = ahead - step * gradient(ahead)
        ahead = new + t / (t + 3) * (new - w)
        w = new
    return w


def _biased(x: np.ndarray) -> np.ndarray:
    return np.hstack([x, np.ones((len(x), 1), np.float32)])


def fit_machine(x: np.ndarray, y: np.ndarray, pull: float = 1e-4) -> np.ndarray:
    """Weights (the last is the offset) of a linear support vector machine for labels -1 and 1: mean squared hinge loss."""
    b = _biased(x)

    def gradient(w):
        short = np.maximum(1 - y * (b @ w), 0)
        return -2 * b.T @ (y * short) / len(y) + pull * w
    return descend(gradient, b.shape[1], step=0.25)  # rows have length 2 at most (squared), twice that bounds the curvature


def fit_softmax(x: np.ndarray, group: np.ndarray, groups: int, pull: float = 1e-5) -> np.ndarray:
    """Weights of a multinomial logistic model, a column a group."""
    b, hot = _biased(x), np.eye(groups, dtype=np.float32)[group]

    def gradient(w):
        return b.T @ (softmax(b @ w) - hot) / len(b) + pull * w
    return descend(gradient, (b.shape[1], groups), rounds=600, step=1.0)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def fit_slope(margin: np.ndarray, y: np.ndarray) -> float:
    """Slope of the logistic curve from margins to probabilities, by Newton steps on slightly softened labels."""
    target, slope = np.where(y > 0, 1 - 1 / (len(y) + 2), 1 / (len(y) + 2)), 1.0
    for _ in range(20):
        p = 1 / (1 + np.exp(-np.clip(slope * margin, -50, 50)))
        bend = (p * (1 - p) * margin ** 2).sum() + 1e-3
        slope = float(np.clip(slope + ((target - p) * margin).sum() / bend, 0.1, 50))
    return slope


def families(means: np.ndarray) -> list[list[int]]:
    """Groups of like rows: merges by average cosine, cut where two merges after each other are furthest apart.

    One or two languages are one family.
    """
    n = len(means)
    unit = means / np.maximum(np.linalg.norm(means, axis=1, keepdims=True), 1e-12)
    alike = unit @ unit.T
    groups, states, likeness = [[i] for i in range(n)], [], []
    while len(groups) > 1:
        pairs = [(alike[np.ix_(a, b)].mean(), i, j) for i, a in enumerate(groups) for j, b in enumerate(groups[:i])]
        best, i, j = max(pairs)
        groups = [g for k, g in enumerate(groups) if k not in (i, j)] + [groups[j] + groups[i]]
        likeness.append(best), states.append(groups)
    if n < 3:
        return [list(range(n))] if n else []
    gaps = -np.diff(likeness)
    return sorted(sorted(g) for g in states[int(np.argmax(gaps))])


class Model(NamedTuple):
    names: list
    families: list
    family_weights: np.ndarray
    #: for each pair (one, other) of a family: weights and slope; positive margins speak for ``one``
    pairs: dict

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the language and score of each row."""
        best, score = np.zeros(len(x), int), np.zeros(len(x))
        b = _biased(x)
        family = softmax(b @ self.family_weights) if len(self.families) > 1 else np.ones((len(x), 1))
        chosen = family.argmax(1)
        for f, members in enumerate(self.families):
            rows = np.flatnonzero(chosen == f)
            votes, margins, chance = (np.zeros((len(rows), len(members))) for _ in range(3))
            for i, one in enumerate(members):
                for j, other in enumerate(members[:i]):
                    w, slope = self.pairs[one, other]
                    m = b[rows] @ w
                    p = 1 / (1 + np.exp(-np.clip(slope * m, -50, 50)))
                    votes[:, i] += m > 0
                    votes[:, j] += m <= 0
                    margins[:, i] += m
                    margins[:, j] -= m
                    chance[:, i] += p
                    chance[:, j] += 1 - p
            top = votes == votes.max(1, keepdims=True)
            pick = np.where(top, margins, -np.inf).argmax(1)
            best[rows] = np.array(members)[pick]
            sure = chance[np.arange(len(rows)), pick] / (len(members) - 1) if len(members) > 1 else 1.0
            score[rows] = family[rows, f] * sure
        return best, np.clip(score, 0, 1)


def fit(x: np.ndarray, language: np.ndarray, names: list) -> Model:
    """``language`` numbers the rows' ``names``."""
    found = families(np.stack([x[language == k].mean(0) for k in range(len(names))]))
    of = {k: f for f, members in enumerate(found) for k in members}
    group = np.array([of[k] for k in language])
    weights = fit_softmax(x, group, len(found)) if len(found) > 1 else np.zeros((WIDTH + 1, 1), np.float32)
    pairs = {}
    for members in found:
        for i, one in enumerate(members):
            for other in members[:i]:
                rows = (language == one) | (language == other)
                y = np.where(language[rows] == one, 1, -1).astype(np.float32)
                w = fit_machine(x[rows], y)
                pairs[one, other] = (w, fit_slope(_biased(x[rows]) @ w, y))
    return Model(names, found, weights, pairs)


# --- Spark side -------------------------------------------------------------------------

def sample_languages(docs: DataFrame, per_language: int = PER_LANGUAGE, total: int = SAMPLE) -> DataFrame:
    """``id``, ``lang`` and ``text`` of at most ``per_language`` texts of each language, and ``total`` in all.

    Learned from are rows with an id outside the held-out fold, a language,
    and a text with a letter. A language's sample are its first ids in hash
    order and one row of each id and language, the one with the least text
    hash, so neither a frequent language nor a repeated id widens it.
    """
    known = docs.where(docs["lang"].isNotNull() & docs["doc_id"].isNotNull() & docs["text"].rlike(r"\p{L}")
                       & ~held_out(docs["doc_id"], FOLDS, REST)).select(docs["doc_id"].cast("long").alias("id"), "lang", "text")
    counts = known.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES).collect()  # names only
    each = min(per_language, max(20, total // max(len(counts), 1)))
    # a share by hash that holds more than enough, before anything is sorted
    part = F.lit(None).cast("double")
    for r in counts:
        part = F.when(F.col("lang") == r.lang, F.lit(min(1.0, 2.0 * each / r.n + 10.0 / r.n))).otherwise(part)
    place = F.xxhash64("id")
    likely = known.select("id", "lang").where(F.pmod(place, F.lit(1 << 20)) < part * (1 << 20)).groupBy("lang", "id").agg(F.count("*").alias("rows"))
    ranked = likely.withColumn("k", F.row_number().over(W.partitionBy("lang").orderBy(place, "id"))).where(F.col("k") <= each)
    chosen = known.join(F.broadcast(ranked.select("lang", "id")), ["lang", "id"])  # at most total rows
    return chosen.groupBy("lang", "id").agg(F.min(F.struct(F.xxhash64("text").alias("place"), "text")).alias("least")).select("id", "lang", "least.text")


def train(docs: DataFrame, **bounds) -> Model:
    """Fit on the sample. What the driver gets are sparse histograms: at most ``WIDTH`` small numbers a text."""
    C.ship(docs.sparkSession)

    def run(batches):
        for batch in batches:
            buf, off = C.flat(batch.column("text"))
            for i, j in C.slices(off):
                cells = []
                for a in range(i, j, ROWS_AT_ONCE):
                    b = min(j, a + ROWS_AT_ONCE)
                    for row in histograms(buf[off[a]:off[b]], off[a:b + 1] - off[a]):
                        at = np.flatnonzero(row)
                        cells.append(C.pack_parts(C.pack(at.astype(np.uint16)), C.pack(row[at].astype(np.uint32))))
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(i, j - i), batch.column("lang").slice(i, j - i), pa.array(cells, pa.binary())],
                                                 names=["id", "lang", "counts"])

    found = sample_languages(docs, **bounds).mapInArrow(run, "id long, lang string, counts binary").toArrow().sort_by([("lang", "ascending"), ("id", "ascending")])
    if not found.num_rows:
        return Model([], [], np.zeros((WIDTH + 1, 1), np.float32), {})
    x = np.zeros((found.num_rows, WIDTH), np.float32)
    for row, cell in zip(x, found.column("counts").to_pylist()):
        at, n = (C.unpack(p, kind) for p, kind in zip(C.unpack_parts(cell), (np.uint16, np.uint32)))
        row[at] = np.sqrt(n / max(n.sum(), 1))
    names = sorted(set(found.column("lang").to_pylist()))
    number = {name: k for k, name in enumerate(names)}
    return fit(x, np.array([number[v] for v in found.column("lang").to_pylist()]), names)


def identify(docs: DataFrame, **bounds) -> DataFrame:
    """``id``, ``lang_pred`` and ``score`` of every row's whole text.

    Edge cases: a null text, or one without a letter, is ``und`` with score 0,
    as is every text where nothing could be learned; a single learned
    language is predicted for all others with score 1; a null id is predicted
    but never learned from, a null language neither; repeated rows are each
    predicted; an empty table gives an empty result; other columns are not
    looked at. A text is held whole in a worker, however long it is.
    """
    spark = docs.sparkSession
    model = train(docs, **bounds)
    shared = spark.sparkContext.broadcast(model)  # one vector a pair of related languages and a family
    text = docs["text"].cast("string")
    d = docs.select(docs["doc_id"].cast("long").alias("id"), F.when(text.rlike(r"\p{L}"), text).alias("text"))

    def run(batches):
        m = shared.value
        for batch in batches:
            there = np.asarray(batch.column("text").is_valid()) & bool(m.names)
            names, scores = np.full(batch.num_rows, UNKNOWN, object), np.zeros(batch.num_rows)
            rows = np.flatnonzero(there)
            buf, off = C.flat(batch.column("text").take(pa.array(rows)))
            for i, j in C.slices(off):
                for a in range(i, j, ROWS_AT_ONCE):
                    b = min(j, a + ROWS_AT_ONCE)
                    best, score = m.predict(vectors(histograms(buf[off[a]:off[b]], off[a:b + 1] - off[a])))
                    names[rows[a:b]], scores[rows[a:b]] = np.array(m.names, object)[best], score
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(names, pa.string()), pa.array(scores)], names=["id", "lang_pred", "score"])

    return d.mapInArrow(C.of_batches(run), "id long, lang_pred string, score double")


def op11_language_id(spark, sf_dir: str) -> DataFrame:
    """Contract of the registered query: predicted language and score of every document."""
    out = identify(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select(F.col("id").alias("doc_id"), held_out(F.col("id"), FOLDS, REST).alias("held_out"), "lang_pred", "score")
