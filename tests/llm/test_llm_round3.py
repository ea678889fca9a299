"""Language identification, importance resampling and fill-in-the-middle against brute force and on odd input."""

import collections
import hashlib
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from emporium.llm import fill_middle, importance, labelled, language_id, lm_score, quality_trees, toxicity, warc_zip
from emporium.llm import common as C
from test_llm_operators import SCHEMA, SF, SF_SMALL, docs, key, lower, none, rows  # noqa: F401


def flat(texts):
    return C.flat(pa.array(texts, pa.string()))


# --- 11 -----------------------------------------------------------------------

def brute_histogram(t):
    """Bytes of words, with a space before each and after the last, in runs of one to four."""
    b = " ".join(re.findall(r"[a-z\x80-\U0010ffff]+", lower(t))).encode()
    b = b" " + b + b" "
    runs = collections.Counter()
    for k in range(1, 5):
        runs.update(b[i:i + k] for i in range(len(b) - k + 1) if k > 1 or b[i:i + 1] != b" ")
    return runs


def test_histograms():
    texts = ["The cat, the  CAT!", "", "a", "ÄÖ 12 x", "  ", "x" * 50, "\n b\tc"]
    got = language_id.histograms(*flat(texts))
    seen = {}
    for row, t in zip(got, texts):
        want = brute_histogram(t)
        assert row.sum() == sum(want.values())
        for run, n in want.items():
            h = 0
            for c in run:
                h = (h * int(C.BASES[0]) + c + 1) % 2 ** 64
            bucket = int(C.mix(np.array([h + len(run) - 1], C.U64))[0] >> C.U64(64 - language_id.WIDTH_BITS))
            seen[run] = bucket
            assert row[bucket] >= n
        assert row.sum() == sum(want.values()) and set(np.flatnonzero(row)) == {seen[r] for r in want}


def test_languages_on_held_out_texts(spark):
    got = {r.doc_id: r for r in language_id.op11_language_id(spark, SF).collect()}
    docs_ = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= r.score <= 1 for i, r in got.items())
    held = [got[r.doc_id].lang_pred == r.lang for r in docs_ if got[r.doc_id].held_out]
    assert len(got) == len(docs_) and np.mean(held) > 0.97


def test_families_and_machines():
    """Two pairs of related languages; inside a pair only a few runs of letters differ."""
    g = np.random.default_rng(0)
    common, own = [g.integers(0, 4096, 300) for _ in range(2)], [g.integers(0, 4096, 20) for _ in range(4)]
    x, y = [], []
    for i in range(400):
        k = i % 4
        counts = np.bincount(np.concatenate([g.choice(common[k // 2], 200), g.choice(own[k], 12)]), minlength=4096)
        x.append(np.sqrt(counts / counts.sum())), y.append(k)
    x, y = np.array(x, np.float32), np.array(y)
    model = language_id.fit(x[:300], y[:300], list("abcd"))
    assert model.families == [[0, 1], [2, 3]] and set(model.pairs) == {(1, 0), (3, 2)}
    best, score = model.predict(x[300:])
    assert (best == y[300:]).mean() > 0.95 and score.min() > 0.2
    # the machine is at the minimum of its loss: small changes of the weights do not lower it
    rows_ = y[:300] < 2
    a, t = np.hstack([x[:300][rows_], np.ones((rows_.sum(), 1))]), np.where(y[:300][rows_] == 1, 1, -1)
    loss = lambda w: (np.maximum(1 - t * (a @ w), 0) ** 2).mean() + 0.5e-4 * w @ w
    w = model.pairs[1, 0][0].astype(float)
    assert all(loss(w) <= loss(w + 0.3 * g.normal(size=len(w)) / math.sqrt(len(w))) + 1e-4 for _ in range(20))


def test_languages_on_odd_input(spark, docs, rows, none):  # noqa: F811
    got = collections.Counter((r.id, r.lang_pred, r.score) for r in language_id.identify(docs).collect())
    assert sum(got.values()) == len(rows) and {p for _, p, _ in got} <= {"en", "de", "und"}
    for i, t, *_ in rows:
        known = bool(t) and any(c.isalpha() for c in t)
        assert all(known == (p != "und") and (known or s == 0) for j, p, s in got if j == i and (i is not None))
    assert language_id.identify(none).count() == 0
    nothing = docs.drop("lang").withColumn("lang", docs["shard"].substr(5, 5)).selectExpr("*", "nullif(lang, '') as l").drop("lang").withColumnRenamed("l", "lang")
    assert {(r.lang_pred, r.score) for r in language_id.identify(nothing).collect()} == {("und", 0.0)}
    one = docs.drop("lang").withColumnRenamed("shard", "lang")
    assert {(r.lang_pred, r.score) for r in language_id.identify(one).collect()} == {("s", 1.0), ("und", 0.0)}


def test_samples_are_bounded(spark):
    """Many rows of one id give the sample one."""
    from pyspark.sql import functions as F

    many = spark.range(6000).select(F.when(F.col("id") < 3000, 5).otherwise(F.col("id")).alias("doc_id"),
                                    F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"), F.lit("en").alias("lang"))
    got = language_id.sample_languages(many, per_language=50).collect()
    assert len(got) == 50 == len({r.id for r in got})
    labels = spark.createDataFrame([(i, i % 2) for i in [5, *range(3000, 3400)]], "doc_id long, quality int")
    found = labelled.sample_labelled(many, labels, "quality", 1000).collect()
    assert len(found) == len({r.id for r in found}) and 5 in {r.id for r in found}


# --- 12 -----------------------------------------------------------------------

def brute_features(t):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t or ""))
    return len(w), [zlib.crc32(" ".join(w[i:i + k]).encode()) % 10000 for k in (1, 2, 3) for i in range(len(w) - k + 1)]


def brute_resample(rows_, targets):
    """Weight and score of each row, and what is drawn in which order."""
    found = [(i, *brute_features(t)) for i, t in rows_]
    s, t = collections.Counter(), collections.Counter()
    for _, _, f in found:
        s.update(f)
    for x in targets:
        t.update(brute_features(x)[1])
    ns, nt = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (ns + 10000) / ((s[b] + 1) * (nt + 10000))))
    out = []
    for i, n, f in found:
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(map(gain, f))
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    able = sorted((r for r in out if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for k, r in enumerate(able[:5 * len(able) // 100]):
        r[4] = k + 1
    return [tuple(r[:5]) for r in out]


def test_crc_matrices():
    g = np.random.default_rng(1)
    buf = g.integers(0, 256, 9000).astype(np.uint8)
    size = np.concatenate([g.integers(1, 40, 300), [1500, 1024, 1025, 1]])
    start = g.integers(0, len(buf) - size)
    assert importance.crc32_spans(buf, start, size).tolist() == [zlib.crc32(buf[a:a + n].tobytes()) for a, n in zip(start, size)]


def test_words_that_share_a_hash_stay_apart(monkeypatch):
    monkeypatch.setattr(C, "hash_words", lambda buf, start, end, seed=0: (end - start).astype(np.uint64))
    texts = ["ab cd ab ef cd", "ab xyz cd"]
    got, sizes, counts = importance.feature_buckets(*flat(texts))
    assert sorted(got.tolist()) == sorted(x for t in texts for x in brute_features(t)[1]) and counts.tolist() == [5, 3] and sizes.tolist() == [12, 6]


def test_resampling(spark, docs, rows):  # noqa: F811
    r = random.Random(8)
    more = [(5000 + i, " ".join(r.choice(["alpha", "béta", "GAMMA-4", "x_y", "delta"]) for _ in range(r.randint(15, 40)))) for i in range(300)]
    more += [(6000, "z" * 3000 + " " + "y " * 30), (6001, more[0][1]), (6001, more[0][1])]
    extra = spark.createDataFrame([(i, t, *[None] * 8) for i, t in more], SCHEMA)
    targets = ["alpha béta alpha", None, "", "w3 w4 w5", "alpha béta alpha"]
    target = spark.createDataFrame([(i, t, 1) for i, t in enumerate(targets)], "item_id long, text string, weight int")
    want = brute_resample([(i, t) for i, t, *_ in rows] + more, targets)
    for parts in (1, 7):
        got = importance.resample(docs.unionByName(extra), target, ranges=parts).collect()
        assert sorted(key(tuple(x)) for x in got) == sorted(map(key, want))
    assert sum(x[4] is not None for x in want) > 10


def test_resampling_without_rows(spark, docs, none):  # noqa: F811
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert importance.resample(none, nothing).count() == 0
    got = importance.resample(docs, nothing).collect()
    assert len(got) == docs.count() and all(r.weight == 0 for r in got if not r.n_features)


# --- 13 -----------------------------------------------------------------------

def brute_form(i, t):
    t = t or ""
    d = hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    h, n = [int(d[k:k + 8], 16) for k in (0, 8, 16, 24)], len(t)
    if not t or any(m in t for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return i, n, "plain", None, None, t
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if h[3] % 100 < 20:
        return i, n, "spm", a, b - a, f"<S>{t[b:]}<P>{t[:a]}<M>{t[a:b]}"
    return i, n, "psm", a, b - a, f"<P>{t[:a]}<S>{t[b:]}<M>{t[a:b]}"


def test_fill_in_middle(spark, docs, rows):  # noqa: F811
    from pyspark.sql import functions as F

    r = random.Random(3)
    shared = "".join(r.choice("aé€😀 \n<>PSM") for _ in range(3000)).replace("<P>", "").replace("<S>", "").replace("<M>", "")
    more = [(7000 + i, "é" * i + shared + "😀" * (i % 3)) for i in range(40)] + [(7100, "<" * 20000), (7101, "<<P"), (7102, "x<S>y"), (7103, "€" * 30001)]
    extra = spark.createDataFrame([(i, t, *[None] * 8) for i, t in more], SCHEMA)
    got = fill_middle.fill_in_middle(docs.unionByName(extra)).withColumn("back", fill_middle.restored(F.col("output"), F.col("form"))).collect()
    texts = [(i, t) for i, t, *_ in rows] + more
    assert sorted(key(tuple(x)[:6]) for x in got) == sorted(key(brute_form(i, t)) for i, t in texts)
    assert collections.Counter(x.back for x in got) == collections.Counter(t or "" for _, t in texts)
    assert {x.form for x in got} == {"plain", "psm", "spm"}


def test_empty_table(none):  # noqa: F811
    assert fill_middle.fill_in_middle(none).count() == 0


def test_shared_passages_are_the_same_chunks():
    """Behind what differs, copies fall into the same chunks; a small cache forgets and stays right."""
    g = random.Random(9)
    shared = "".join(g.choice("abcdefgh ") for _ in range(60000))
    texts = ["x" * k + shared for k in (0, 5, 777)]
    buf, off = flat(texts)
    ends = fill_middle.chunk_ends(buf, off)
    assert set(off[1:]) <= set(ends) and np.diff(ends).max() <= fill_middle.LONGEST_CHUNK
    chunks = [{bytes(buf[a:b]) for a, b in zip([off[k], *ends], ends) if off[k] <= a and b <= off[k + 1]} for k in range(3)]
    assert len(chunks[0] & chunks[1] & chunks[2]) > 0.9 * len(chunks[0]) > 50
    for most in (1 << 24, 2000):
        memo = fill_middle.Memo(most)
        for i, t in enumerate(texts):
            raw, own = t.encode(), [int(e - off[i]) for e in ends if off[i] < e <= off[i + 1]]
            n, form, a, m, out = fill_middle.transform(i, raw, own, memo)
            assert (i, n, form, a, m, out.decode()) == brute_form(i, t)
        assert (memo.hits > 100) == (most > 2000) and memo.held <= max(most, fill_middle.LONGEST_CHUNK)


def test_markers_across_chunks():
    """Every way to split a text gives the same summary."""
    for t in (b"a<P>b", b"<M>", b"ab<", b"x<S", "é<S>€".encode(), b"<P<S<M>"):
        for a in range(len(t) + 1):
            for b in range(a, len(t) + 1):
                whole = fill_middle.NOTHING
                for part in (t[:a], t[a:b], t[b:]):
                    whole = fill_middle.combine(whole, fill_middle.summarize(part))
                assert whole == fill_middle.summarize(t)


def test_fill_in_middle_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF_SMALL}/documents.parquet')")
    got = fill_middle.op13_fill_in_middle(spark, SF_SMALL)
    rel = con.sql(fill_middle.OP13_SQL)
    assert got.columns == rel.columns and sorted(map(tuple, got.collect())) == sorted(rel.fetchall())


@pytest.mark.parametrize("op", [language_id.op11_language_id, importance.op12_importance_resampling, fill_middle.op13_fill_in_middle])
def test_reruns_agree(spark, op):
    once, again = (sorted(map(str, op(spark, SF_SMALL).collect())) for _ in range(2))
    assert once == again and len(once) == spark.read.parquet(f"{SF_SMALL}/documents.parquet").count()


# --- earlier operators: what had no brute force ----------------------------------------

def test_interpolated_scores(docs, rows):  # noqa: F811
    """Scores from plain counts: weights learned on each training token taken out of its own counts, then one mixture a token."""
    tokens = lambda t: re.findall(r"[^\x20\x09-\x0D]+", lower(t or "")) + [None]
    held = lambda i: i is None or zlib.crc32(str(i).encode()) % 7 == 2
    one, two, context = collections.Counter(), collections.Counter(), collections.Counter()
    for i, t, *_ in rows:
        if not held(i):
            s = tokens(t)
            one.update(s), two.update(zip([0, *s], s)), context.update([0, *s[:-1]])
    n, v = sum(one.values()), len(one)
    steps, floor = lm_score.STEPS, lm_score.FLOOR

    def estimates(h, w, less):
        # the end of a text is a context of nothing; every other token is one as often as it occurs
        c = max((context[0] if h == 0 else one[h]) - less, 0)
        bucket = min(int(math.log2(c)) + 1, lm_score.BUCKETS - 1) if c else 0
        return bucket, (max(two[h, w] - less, 0) / c if c else 0.0), max(one[w] - less, 0) / max(n - less, 1)
    cell = lambda x: 0 if x < floor else 1 + round((math.log(x) - math.log(floor)) * steps)
    seen = collections.Counter()
    for i, t, *_ in rows:
        if not held(i):
            s = tokens(t)
            for h, w in zip([0, *s], s):
                b, x1, x2 = estimates(h, w, 1)
                seen[(b << 32) | (cell(x1) << 16) | cell(x2)] += 1
    weights = lm_score.learn_weights(np.array(list(seen)), np.array(list(seen.values()), float), v)
    want = []
    for i, t, *_ in rows:
        s, total = tokens(t), 0.0
        for h, w in zip([0, *s], s):
            b, x1, x2 = estimates(h, w, 0)
            total += math.log10(weights[b] @ [x1, x2, 1 / (v + 1)])
        want.append((i, len(s), total))
    got = lm_score.score_documents(docs, block_bytes=4096, shard_entries=64).collect()
    order = lambda r: (r[0] is None, r[0] or 0, r[1], round(r[2], 6))
    for a, b in zip(sorted(((r.id, r.n_tokens, r.score) for r in got), key=order), sorted(want, key=order)):
        assert a[:2] == b[:2] and abs(a[2] - b[2]) < 1e-9 * max(1, abs(b[2]))


def test_first_split_by_exhaustive_search():
    """A single stump takes the split of highest gain among all features and all bounds between bins."""
    g = np.random.default_rng(6)
    x = g.integers(0, 6, (60, 3)).astype(float)
    y = (x[:, 1] + g.normal(size=60) > 3).astype(float)
    forest = quality_trees.fit(x, y, trees=1, depth=1, rate=0.5, bins=32, least=5, pull=1.0)
    p = y.mean()
    gain = lambda s: (y - p)[s].sum() ** 2 / (p * (1 - p) * s.sum() + 1.0)
    best = max(((gain(x[:, f] <= cut) + gain(x[:, f] > cut), f, cut) for f in range(3) for cut in range(5)
                if 5 <= (x[:, f] <= cut).sum() <= 55))
    root = forest.roots[0]
    left = x[:, best[1]] <= best[2]
    assert forest.feature[root] == best[1] and ((x[:, best[1]] <= forest.threshold[root]) == left).all()
    leaf = lambda s: 0.5 * (y - p)[s].sum() / (p * (1 - p) * s.sum() + 1.0)
    want = np.where(left, leaf(left), leaf(~left)) + math.log(p / (1 - p))
    assert np.allclose(forest.raw(x), want)


def test_kneser_ney_by_dictionaries():
    """Log ratios of two models with a shared backoff, from counts in dictionaries."""
    words = [b"abab", b"abc", b"ba", b"cab", b"zz"]
    counts = np.array([[3, 1], [2, 0], [0, 4], [1, 1], [0, 2]])
    order, d = 3, 0.75
    grams = collections.defaultdict(lambda: np.zeros(2))
    for w, n in zip(words, counts):
        padded = b"\x02\x02" + w + b"\x03"
        for k in range(2, len(padded)):
            grams[padded[k - 2:k + 1]] += n
    seen = [g for g in grams]

    def shared(g, k):
        """Probability of the last byte of ``g`` after the ``k - 1`` before it, by histories one byte longer."""
        if k == 0:
            return 1 / 256
        longer = {x[-k - 1:] for x in seen} if k < order else set(seen)
        lower = collections.Counter(x[-k:] for x in longer)
        same = {x: n for x, n in lower.items() if x[:-1] == g[-k:-1]}
        rest = shared(g, k - 1)
        if not same:
            return rest
        return (max(lower.get(g[-k:], 0) - d, 0) + d * len(same) * rest) / sum(same.values())

    def ratio(g):
        p = []
        for k in (0, 1):
            same = {x: c[k] for x, c in grams.items() if x[:-1] == g[:-1] and c[k]}
            total = sum(same.values())
            p.append((max(same.get(g, 0) - d, 0) + d * len(same) * shared(g, order - 1)) / total if total else shared(g, order - 1))
        return math.log(p[1] / p[0])
    model = toxicity.fit(words, counts, order=order, discount=d)
    code = lambda g: sum(c << (8 * i) for i, c in enumerate(reversed(g)))
    assert model.keys.tolist() == sorted(map(code, seen))
    got = dict(zip(model.keys.tolist(), model.ratios))
    assert all(abs(got[code(g)] - ratio(g)) < 1e-5 for g in seen)


def test_archives_are_read_by_stated_tasks(spark, monkeypatch):
    """As many reading tasks as the archives have stretches of bytes, however small the index; a hot payload is dealt out."""
    monkeypatch.setattr(warc_zip, "STRETCH_BYTES", 4096)
    pages = spark.createDataFrame([(i, "u", "same" if i % 3 else "".join(random.Random(i).choices("abcdefghij", k=900))) for i in range(300)],
                                  "page_id long, url string, html string")
    listed = warc_zip.write_archives(pages, C.new_folder(spark, "warc-test"), archive_bytes=20000)
    total = listed.agg({"bytes": "sum"}).first()[0]
    got = warc_zip.read_archives(listed)
    assert got.rdd.getNumPartitions() == -(-total // 4096) > 10
    kinds = collections.Counter((r.record_type, r.refers_to) for r in got.collect())
    assert kinds == {("revisit", 299): 199, ("response", None): 101}


# --- 6: postings behind the pivot ----------------------------------------------------

def test_postings_behind_the_pivot_are_not_read():
    """Random texts: the best ten of every query are those of a plain sum over all postings, from a part of them."""
    from emporium.llm import block_max_wand as S
    from emporium.llm import common

    rng = np.random.default_rng(3)
    topics = [[f"t{k}x{j}" for j in range(150)] for k in range(40)]
    texts = [" ".join(rng.choice(topics[i % 40], 25)) + " " + " ".join(f"r{x}" for x in rng.integers(0, 1500, 10)) for i in range(4000)]
    texts += texts[:30] + ["", "x " * 3000]
    table = pa.table({"id": pa.array(range(len(texts))), "text": texts})
    vocabulary = np.unique(common.words(pa.array(texts), lower=True).hashes[0])
    index = S.Index(table, vocabulary, 35.0)
    doc, term, tf, lengths = S._term_counts(table)
    column = np.searchsorted(vocabulary, term)
    impact = np.zeros((len(texts), len(vocabulary)))
    impact[doc, column] = tf * (S.K1 + 1) / (tf + S.K1 * (1 - S.B + S.B * lengths[doc] / 35.0))
    idf = np.log1p((len(texts) - np.bincount(column) + .5) / (np.bincount(column) + .5))
    asked = [np.flatnonzero(impact[i]) for i in range(0, 4000, 40)]
    for (places, scores), own in zip(index.search(asked, [idf[t] for t in asked], 10), asked):
        whole = np.round(impact[:, own] @ idf[own], S.DIGITS)
        want = np.flatnonzero((whole >= np.sort(whole)[-10]) & (whole > 0))
        assert sorted(index.order[places].tolist()) == want.tolist()
        np.testing.assert_allclose(scores, whole[index.order[places]], atol=2e-6)
    assert 0 < index.read < index.held
    assert S._batches(np.array([S.BATCH_RUNS + 1, 1, 1])) == [(0, 1), (1, 3)] and len(S._batches(np.ones(S.BATCH + 1, int))) == 2
    print("postings read", index.read / index.held)


# --- 6: dense terms of a cluster, floors ------------------------------------------------

def test_search_multiplies_within_clusters_and_from_a_floor(monkeypatch):
    """Two languages: a shard multiplies by the frequent terms of each alone. Words are counted once. A floor takes no hit away."""
    from emporium.llm import block_max_wand as S
    from emporium.llm import common

    rng = np.random.default_rng(5)
    texts = [" ".join(f"{'ab'[i % 2]}{x}" for x in np.minimum(rng.geometric(0.05, 30), 90)) for i in range(1500)] + ["", "a1 b1"]
    table = pa.table({"id": pa.array(range(len(texts))), "text": texts})
    vocabulary = np.unique(common.words(pa.array(texts), lower=True).hashes[0])
    doc, term, tf, lengths = S._term_counts(table)
    column = np.searchsorted(vocabulary, term)
    impact = np.zeros((len(texts), len(vocabulary)))
    impact[doc, column] = tf * (S.K1 + 1) / (tf + S.K1 * (1 - S.B + S.B * lengths[doc] / 30.0))
    idf = np.log1p((len(texts) - np.bincount(column) + .5) / (np.bincount(column) + .5))
    counts = S.Counts.unpacked(S.Counts.of(table).packed())
    monkeypatch.setattr(S, "_term_counts", None)
    index = S.Index(counts, vocabulary, 30.0, idf)
    dense = [part[2] for part in index.parts]
    assert 0 < sum(x.size for x in dense) < 0.6 * len(texts) * (index.dense_of >= 0).sum()
    asked = [np.flatnonzero(impact[i]).astype(np.int32) for i in range(0, 1500, 30)]
    whole = [np.round(impact[:, own] @ idf[own], S.DIGITS) for own in asked]
    tenth = np.array([np.sort(x)[-10] for x in whole])
    for floor in (None, tenth * 0.9, tenth):
        query, places = index.candidates(asked, [idf[t] for t in asked], 10, floor)
        scores = index.exact(places, query, asked, [idf[t] for t in asked])
        for i, x in enumerate(whole):
            best = index.order[places[(query == i) & (scores >= tenth[i] - 2e-6)]]
            assert sorted(best.tolist()) == np.flatnonzero(x >= tenth[i] - 2e-6).tolist()
