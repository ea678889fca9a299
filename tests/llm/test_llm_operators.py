"""Operators of ``emporium.llm`` against brute force, with nulls, empty and long texts, ties, repeated rows and clashing columns."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest


from emporium.llm import (best_fit_packing, block_max_wand, common, components, lm_score, near_dedup, quality_rules, quality_trees,
                          source_mixing, substring_dedup, toxicity, warc_zip)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, block int, shard string, label string, size string"


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def corpus():
    r = random.Random(5)
    vocabulary = [f"w{i}" for i in range(40)] + ["Été", "naïve", "ÄB,", "don't", "x#$", "!!"]
    texts = [" ".join(r.choice(vocabulary) for _ in range(r.choice([1, 3, 4, 5, 12, 13, 14, 60, 200]))) for _ in range(40)]
    passage = " ".join(f"p{i}" for i in range(60))
    base = [f"b{i}" for i in range(150)]
    rows = list(enumerate(texts))
    rows += [(100 + k, " ".join(base[:k] + [f"e{k}"] + base[k + 1:])) for k in range(0, 60, 4)]  # near copies in a chain
    rows += [(200 + k, f"start{k} {passage}\nend{k} {texts[k]}") for k in range(6)]
    rows += [(300, texts[7]), (301, texts[7]), (302, texts[7].upper()), (303, ""), (304, None), (305, " \t\n"), (306, "a b \x1c c")]
    rows += [(307, " ".join(f"l{i % 977}" for i in range(30000))), (308, "<|endoftext|> x <|startoftext|>"), (None, texts[8]), (None, None)]
    rows += [(309, texts[9]), (309, texts[9]), (310, "line one\nline one\n\nline two\nline one")]
    r.shuffle(rows)
    return [(i, t, r.choice(["en", "de", None]), r.choice(["a", "b", None, "c"]), None, 7, 1, "s", "l", "z") for i, t in rows]


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def key(r):
    return tuple((x is None, x) for x in r)


# --- 1 -------------------------------------------------------------------------

def shingles(t):
    w = words(lower(t or ""))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute_components(pairs, percent=85):
    sets = [(i, shingles(t)) for i, t in pairs if i is not None]
    label = {i: i for i, _ in sets}
    changed = True
    links = [(i, j) for a, (i, x) in enumerate(sets) for j, y in sets[a + 1:] if x and y and 100 * len(x & y) >= percent * len(x | y)]
    while changed:
        changed = False
        for i, j in links:
            m = min(label[i], label[j])
            if label[i] != m or label[j] != m:
                label[i] = label[j] = m
                changed = True
    return label


@pytest.mark.parametrize("cap", [8192, 3])
def test_near_duplicates(docs, rows, cap):
    label = brute_components([(r[0], r[1]) for r in rows])
    got = near_dedup.near_duplicates(docs, cluster_nodes=cap).collect()
    assert sorted((key((r.id, r.n_shingles, r.component, r.kept)) for r in got)) == sorted(
        key((i, len(shingles(t)), label.get(i), i is None or label[i] == i)) for i, t, *_ in rows)
    assert len(set(label.values())) < len(label) - 15


def test_near_duplicates_bound_bytes(spark, monkeypatch):
    """Forty near copies of 3.4 kB and an exact copy: verified in groups of about the bound, not all together."""
    base, bound, whole = [f"b{i}" for i in range(700)], 40_000, near_dedup._verify
    near = [(k, " ".join(base[:9 * k] + [f"e{k}"] + base[9 * k + 1:])) for k in range(40)]

    def checked(table, percent):
        if sum(len(t) for t in table.column("text").to_pylist()) > 2 * bound:
            raise ValueError("too many bytes in one group")
        return whole(table, percent)
    monkeypatch.setattr(near_dedup, "_verify", checked)
    df = spark.createDataFrame(near + [(99, near[3][1])], "doc_id long, text string")
    assert {(r.component, r.kept == (r.id == 0)) for r in near_dedup.near_duplicates(df, cluster_bytes=bound).collect()} == {(0, True)}
    with pytest.raises(Exception, match="too many bytes"):  # the cluster as a whole is above the bound
        near_dedup.near_duplicates(df).collect()


@pytest.mark.parametrize("percent", [80, 85, 95])
def test_pairs_at_the_limit_share_a_bucket(percent):
    """Two sets just at the similarity: small ones always meet, larger ones all but never miss."""
    g = np.random.default_rng(4)
    missed, tried = 0, 0
    for n in list(range(near_dedup._least_size(percent), 60)) * 6 + [80, 200, 700] * 25:
        most = n * (100 - percent) // percent  # shingles that only one of them has, at most
        one = int(g.integers(0, most + 1))
        draw = np.unique(g.integers(0, 1 << 63, n + most, dtype=np.int64).astype(np.uint64) * np.uint64(2))
        both, left, right = draw[:n], draw[n:n + one], draw[n + one:]
        sets = [np.sort(np.concatenate([both, x])) for x in (left, right)]
        if 100 * len(both) < percent * len(draw) or not len(left) + len(right):
            continue
        first = np.cumsum([0] + [len(x) for x in sets])
        values = np.concatenate(sets)
        row, key = near_dedup.bucket_keys(values, first, near_dedup.registers(values, first), percent)
        met = len(np.intersect1d(key[row == 0], key[row == 1])) > 0
        assert met or min(map(len, sets)) >= near_dedup.TINY
        missed, tried = missed + (not met), tried + 1
    assert tried > 100 and missed <= 1


def test_densified_registers():
    g = np.random.default_rng(5)
    draw = np.unique(g.integers(0, 1 << 63, 90, dtype=np.int64).astype(np.uint64) * np.uint64(2))
    regs = near_dedup.registers(np.concatenate([draw, draw[:60]]), np.array([0, len(draw), len(draw) + 60, len(draw) + 60]))
    full = near_dedup.densified(regs)
    assert (full[:2] > 0).all() and (full[2] == 0).all() and (full[regs > 0] == regs[regs > 0]).all()
    assert set(full[0]) == set(regs[0][regs[0] > 0]) and 0.5 < (full[0] == full[1]).mean() < 0.85


def test_large_group_takes_rows_in_proportion(spark, monkeypatch):
    """Copies that are all linked are verified once each, whatever the bound; what shares buckets without being linked is split."""
    base = [f"b{i}" for i in range(300)]
    near = [(k, " ".join(base[:k] + [f"e{k}"] + base[k + 1:])) for k in range(120)]
    far = [(1000 + k, " ".join(w if (i + k) % 24 else f"f{k}-{i}" for i, w in enumerate(base))) for k in range(24)]
    monkeypatch.setattr(near_dedup, "_verify", lambda t, percent, real=near_dedup._verify: (
        real(t, percent) if t.num_rows <= 40 else (_ for _ in ()).throw(ValueError("too many rows in one group"))))
    got = {r.id: r.component for r in near_dedup.near_duplicates(spark.createDataFrame(near + far, "doc_id long, text string"), cluster_nodes=20).collect()}
    label = brute_components(near + far)
    assert got == label and len({label[k] for k, _ in near}) == 1 and len({label[k] for k, _ in far}) == 24


def test_hyperminhash_estimate():
    g = np.random.default_rng(1)
    for share in (0.5, 0.85, 0.95):
        errors = []
        for _ in range(30):
            draw = lambda n: g.integers(0, 1 << 63, n, dtype=np.int64).astype(np.uint64) * np.uint64(2)
            both, n = draw(3000), int(1500 * (1 - share) / share)
            a, b = (np.unique(np.concatenate([both, draw(n)])) for _ in range(2))
            regs = near_dedup.registers(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
            errors.append(near_dedup.estimate(regs[0], regs[1:])[0][0] - 3000 / (3000 + 2 * n))
        assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.06


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + k) for k in range(1, 40)] + [(5000, 4000), (4000, 5000), (7, 7)]
    got = {r.node: r.label for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(61)) and all(got[1000 + k] == 1000 for k in range(40)) and got[5000] == 4000


# --- 2 -------------------------------------------------------------------------

def test_lm_scores(docs, rows):
    out = lm_score.score_documents(docs, block_bytes=4096, shard_entries=64).collect()
    tokens = lambda t: words(lower(t or "")) + [None]
    held = lambda i: i is None or zlib.crc32(str(i).encode()) % 7 == 2
    one, two, contexts = collections.Counter(), collections.Counter(), collections.Counter()
    for i, t, *_ in rows:
        if not held(i):
            s = tokens(t)
            one.update(s), two.update(zip([0, *s], s)), contexts.update([0, *s[:-1]])
    n, v = sum(one.values()), len(one)
    want, pairs = [], []
    for i, t, *_ in rows:
        s = tokens(t)
        want.append((i, held(i), len(s), sum(one[x] > 0 for x in s), n, round(sum(math.log10((one[x] + 1) / (n + v + 1)) for x in s), 6)))
    assert sorted((key((r.id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6))) for r in out)) == sorted(map(key, want))
    assert all(r.score <= 0 for r in out)
    # a mixture of distributions: with the learned weights, what follows a seen context adds up to one
    grid = np.array([[(3 << 32) | (90 << 16) | 60, 5]])
    w = lm_score.learn_weights(grid[:, 0], grid[:, 1].astype(float), v)
    assert np.allclose(w.sum(1), 1) and (w[:, 2] >= 1e-4 - 1e-9).all() and pairs == []
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


def test_weights_find_the_generating_mixture():
    g = np.random.default_rng(3)
    steps, floor = lm_score.STEPS, lm_score.FLOOR
    cell = lambda x: np.where(x < floor, 0, 1 + np.rint((np.log(np.maximum(x, floor)) - np.log(floor)) * steps)).astype(np.int64)
    # three events with bigram (.9 .1 0) and unigram (.2 .3 .5) estimates, drawn from 0.6 / 0.4
    x1, x2 = np.array([.9, .1, 0]), np.array([.2, .3, .5])
    n = g.multinomial(100000, .6 * x1 + .4 * x2)
    w = lm_score.learn_weights((5 << 32) | (cell(x1) << 16) | cell(x2), n.astype(float), 10 ** 9)
    assert abs(w[5, 0] - .6) < .05


# --- 3 -------------------------------------------------------------------------

def brute_removal(rows, k=13):
    least = {}
    for i, t, *_ in rows:
        w = words(t)
        for a in range(len(w) - k + 1):
            g = tuple(w[a:a + k])
            least[g] = min(least.get(g, math.inf), math.inf if i is None else i)
    out = []
    for i, t, *_ in rows:
        w = words(t)
        gone = {a + j for a in range(len(w) - k + 1) if least[tuple(w[a:a + k])] < (math.inf if i is None else i) for j in range(k)}
        out.append((i, len(w), len(gone), " ".join(x for a, x in enumerate(w) if a not in gone)))
    return out


@pytest.mark.parametrize("cells", [8, 0.01])
def test_removal(docs, rows, cells):
    """Also with a sketch so small that most estimates are too high."""
    got = substring_dedup.remove_repeated(docs, carry=["id", "text"], cells_per_window=cells, block_bytes=4096, shard_entries=256).collect()
    assert sorted((key((r.id, r.n_words, r.n_removed, r.kept_text)) for r in got)) == sorted(map(key, brute_removal(rows)))
    assert all(r.carried.id == 7 for r in got) and sum(r.n_removed for r in got) > 300


# --- 4 -------------------------------------------------------------------------

def test_text_counts(docs, rows):
    def brute(t):
        t = t or ""
        w = words(t)
        n = collections.Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
        lines = [x for x in t.split("\n") if words(x)]
        return (len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)),
                len({i + j for i in range(len(w) - 2) if n[tuple(w[i:i + 3])] > 1 for j in range(3)}))
    got = quality_rules.text_counts(docs).collect()
    assert sorted(key((r.id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)) for r in got) == sorted(
        key((i, *brute(t))) for i, t, *_ in rows)


def test_binomial_tail(spark):
    from pyspark.sql import functions as F

    cases = [(0, 10), (3, 500), (9, 1000), (40, 5000), (20, 1000), (0, 0)]
    df = spark.createDataFrame(cases, "k long, n long").select("k", "n", quality_rules.lower_tail(F.col("k"), F.col("n"), 0.01).alias("p"))
    for r in df.collect():
        exact = sum(math.comb(r.n, i) * 0.01 ** i * 0.99 ** (r.n - i) for i in range(r.k + 1))
        assert abs(r.p - (1 if r.k >= r.n * 0.01 else exact)) < 1e-9


def test_cutoffs_keep_the_risk(spark):
    """A rule is cut where good documents are lost at a proven rate, and not at all in a stratum with few labels."""
    r = random.Random(2)
    counts, labels = [], []
    for i in range(4000):
        bad = i % 5 == 0
        small = i >= 3950
        symbols = r.randint(30, 40) if bad else (r.randint(20, 49) if r.random() < 0.002 else r.randint(0, 3))
        counts.append((i, "=few" if small else "=en", 0, 100, 100, symbols, 0, 0, 5, 0))
        labels.append((i, 0 if bad else 1))
    c = spark.createDataFrame(counts, "id long, stratum string, n_repeat_words long, n_words long, word_chars long, n_symbols long, n_bangs long,"
                                      "n_capitals long, n_lines long, n_dup_lines long")
    got = {x.stratum: x for x in quality_rules.certified_cutoffs(c, spark.createDataFrame(labels, "doc_id long, quality int")).collect()}
    assert set(got) == {"=en"} and 2 <= got["=en"].from_symbols <= 15 and got["=en"].from_capitals is None


# --- 5 -------------------------------------------------------------------------

def test_mixing(docs, rows, spark):
    sources = [(f"s{i}", 1000 * (i + 1)) for i in range(7)] + [(None, 400)]
    got = {r.source: r.target for r in source_mixing.source_targets(spark.createDataFrame(sources, "source string, source_size long")).collect()}
    weight = dict(zip([s for s, _ in sources], [5, 2, 1] * 3))
    want, left, open_ = {}, 1.5 * sum(n for _, n in sources), dict(sources)
    while True:  # share by weight, stop what is above, share the rest again
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        full = [s for s in open_ if share[s] > 2 * open_[s]]
        if not full:
            want |= share
            break
        for s in full:
            want[s] = 2.0 * open_.pop(s)
            left -= want[s]
    assert all(abs(got[s] - want[s]) < 1e-6 for s in want)
    mixed = source_mixing.mix_sources(docs, range_documents=2).collect()
    assert len(mixed) == len(rows)
    by = collections.defaultdict(list)
    for r in mixed:
        assert 0 <= r.taken <= 2 * r.size and r.taken == sum(c.taken for c in r.copies)
        by[r.source].append(r)
    for s, rs in by.items():
        assert abs(sum(r.taken for r in rs) - rs[0].target) <= 1 and rs[0].source_size == sum(r.size for r in rs)
    again = source_mixing.mix_sources(docs.repartition(5), range_documents=2).collect()
    assert sorted(key((r.id, r.size, r.taken)) for r in again) == sorted(key((r.id, r.size, r.taken)) for r in mixed)
    assert source_mixing.mixed_documents(docs).columns == docs.columns


# --- 6 -------------------------------------------------------------------------

@pytest.mark.parametrize("query_bytes", [1 << 25, 200])
def test_search(docs, rows, query_bytes):
    from pyspark.sql import functions as F

    bags = [(i, collections.Counter(words(lower(t or "")))) for i, t, *_ in rows]
    n, mean = len(bags), sum(sum(b.values()) for _, b in bags) / len(bags)
    df = collections.Counter(x for _, b in bags for x in b)
    want = set()
    for q, query in {i: b for i, b in bags if i is not None and i % 10 == 0}.items():
        hits = []
        for i, b in bags:
            length = sum(b.values())
            s = round(sum(math.log(1 + (n - df[x] + .5) / (df[x] + .5)) * b[x] * 2.2 / (b[x] + 1.2 * (.25 + .75 * length / mean)) for x in query if x in b), 6)
            if s > 0:
                hits.append((-s, i is None, i or 0, i))
        want |= {(q, k + 1, i, -s) for k, (s, _, _, i) in enumerate(sorted(hits)[:5])}
    got = block_max_wand.search(docs, F.col("id") % 10 == 0, 5, index_bytes=4096, query_bytes=query_bytes, shard_entries=64).collect()
    assert len(got) == len(want) and {(r.query_id, r.rank, r.doc_id, round(r.score, 5)) for r in got} == {(q, k, i, round(s, 5)) for q, k, i, s in want}


def test_pruning_skips_blocks():
    """Documents of another vocabulary are never scored."""
    import pyarrow as pa

    texts = [" ".join(f"a{(i * 7 + j) % 50}" for j in range(30)) for i in range(640)] + [f"z z{i}" for i in range(640)]
    table = pa.table({"id": pa.array(range(len(texts))), "text": texts})
    vocabulary = np.unique(common.words(pa.array(texts), lower=True).hashes[0])
    index = block_max_wand.Index(table, vocabulary, 16.0)
    terms = np.searchsorted(vocabulary, np.unique(common.words(pa.array([texts[0]]), lower=True).hashes[0]))
    (places, scores), = index.search([terms], [np.ones(len(terms))], 10)
    assert len(places) >= 10 and all(index.order[p] < 640 for p in places)


# --- 7, 10 -----------------------------------------------------------------------

def held_out_accuracy(spark, out, label):
    got = {r.doc_id: r for r in out.collect()}
    known = {r.doc_id: r[label] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1 for i, r in got.items())
    return np.mean([got[i].predicted == y for i, y in known.items() if i in got and got[i].held_out])


SF, SF_SMALL = "/root/testdata/sf0.01", "/root/testdata/sf0.001"


def test_quality_accuracy(spark):
    assert held_out_accuracy(spark, quality_trees.op7_quality_trees(spark, SF), "quality") > 0.93


def test_toxicity_accuracy(spark):
    assert held_out_accuracy(spark, toxicity.op10_toxicity(spark, SF), "toxic") > 0.93


@pytest.mark.parametrize("score", [quality_trees.score_quality, toxicity.score_toxicity])
@pytest.mark.parametrize("labelled", [[], [(1, 1, 1), (2, 1, 1)], [(i, i % 2, i % 2) for i in range(300)]])
def test_classifiers_on_odd_input(spark, docs, none, rows, score, labelled):
    labels = spark.createDataFrame(labelled + [(None, 1, 0)], "doc_id long, quality int, toxic int")
    got = score(docs, labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert score(none, labels).count() == 0


def test_forest_learns_a_rule():
    g = np.random.default_rng(0)
    x = g.normal(size=(2000, 5))
    y = ((x[:, 1] > 0.3) ^ (x[:, 3] > 0)).astype(float)
    forest = quality_trees.fit(x[:1500], y[:1500])
    assert ((forest.probability(x[1500:]) > 0.5) == y[1500:]).mean() > 0.95


# --- 8 -------------------------------------------------------------------------

def test_archives_round_trip(spark):
    import base64

    pages = [(i, f"http://h/{i}", f"<p>{i % 4}</p>é") for i in range(20)] + [(30, None, None), (31, "u\r\nX: y", ""), (33, "u", None), (None, "v", "<p>1</p>é"),
                                                                          (40, "w", "x" * 300000), (41, "r", "same"), (41, "r", "same")]
    df = spark.createDataFrame([(*p, 1, "z") for p in pages], "page_id long, url string, html string, size int, sha1 string").repartition(3)
    listed = warc_zip.write_archives(df, common.new_folder(spark, "warc-test"), archive_bytes=50)
    got = warc_zip.read_archives(listed).collect()
    largest = collections.defaultdict(lambda: -1)
    for i, _, h in pages:
        largest[h or ""] = max(largest[h or ""], -1 if i is None else i)
    want = []
    for i, u, h in pages:
        body = (h or "").encode()
        other = largest[h or ""] != i and largest[h or ""] >= 0
        want.append((i, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), "revisit" if other else "response",
                     largest[h or ""] if other else None, None if other else body))
    assert sorted(key((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, None if r.payload is None else bytes(r.payload))) for r in got) == sorted(map(key, want))
    assert listed.count() > 5


def test_zip64_directory(tmp_path):
    """A member that declares ZIP64 sizes, and an archive with more members than a plain end record can count."""
    import zipfile

    path = str(tmp_path / "many.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_STORED) as z:
        for i in range(66000):
            z.writestr(zipfile.ZipInfo(f"m{i}"), b"x%d" % i)
        with z.open(zipfile.ZipInfo("last"), "w", force_zip64=True) as f:
            f.write(b"payload")
    with open(path, "rb") as f:
        import os

        members = warc_zip.read_directory(f, os.path.getsize(path))
        assert len(members) == 66001
        at, n = members["last"]
        f.seek(at)
        assert f.read(n) == b"payload"


# --- 9 -------------------------------------------------------------------------

def test_tokens_and_packing(spark, docs, rows):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(best_fit_packing.vocabulary_path())
    pieces = best_fit_packing.token_pieces(docs, keep_ids=True, capacity=512)
    got = best_fit_packing.pack_pieces(pieces, capacity=512, group_pieces=64).collect()
    want = collections.Counter()
    for i, text, *_ in rows:
        ids = t.encode(text or "", add_special_tokens=False).ids + [0]
        for k, a in enumerate(range(0, len(ids), 512)):
            part = ids[a:a + 512]
            want[i, k, a, len(part), zlib.crc32(np.array(part, "<u4").tobytes()), tuple(part)] += 1
    assert collections.Counter((r.id, r.piece, r.start, r.length, r.ids_crc32, tuple(r.ids)) for r in got) == want
    bins = collections.defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for b in bins.values():
        at = 0
        for offset, n in sorted(b):
            assert offset == at
            at += n
        assert at <= 512


def test_tokens_of_all_small_documents(spark):
    """Word by word gives the same ids as whole texts."""
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(best_fit_packing.vocabulary_path())
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = best_fit_packing.token_pieces(docs, keep_ids=True, capacity=10 ** 9)
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in got.collect():
        assert list(r.ids) == t.encode(texts[r.id] or "", add_special_tokens=False).ids + [0]


def test_best_fit_matches_plain_search():
    r = random.Random(1)
    sizes = sorted((r.randint(1, 100) for _ in range(400)), reverse=True)
    bins, offsets = best_fit_packing.best_fit_decreasing(sizes, 100)
    room = []
    for size, b, at in zip(sizes, bins, offsets):
        fits = [x for x in room if x >= size]
        if fits:
            assert 100 - at == min(fits)
            room.remove(min(fits))
        else:
            assert at == 0
            min_fit = 100
        room.append((min(fits) if fits else 100) - size)


# --- all -----------------------------------------------------------------------

def test_empty_tables(spark, none):
    from pyspark.sql import functions as F

    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    frames = [near_dedup.near_duplicates(none), lm_score.score_documents(none), substring_dedup.remove_repeated(none),
              quality_rules.apply_rules(none, labels), source_mixing.mix_sources(none), block_max_wand.search(none, F.col("id") % 100 == 0),
              quality_trees.score_quality(none, labels), best_fit_packing.pack_pieces(best_fit_packing.token_pieces(none)),
              toxicity.score_toxicity(none, labels)]
    assert [f.count() for f in frames] == [0] * len(frames)
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc_zip.read_archives(warc_zip.write_archives(pages, common.new_folder(spark, "warc-test"))).count() == 0


def test_rules_on_odd_input(spark, docs, rows):
    labels = spark.createDataFrame([(0, 1), (1, None), (None, 1)], "doc_id long, quality int")
    got = quality_rules.apply_rules(docs, labels).collect()
    assert len(got) == len(rows) and all(r.kept == (not r.base_failed) for r in got)
