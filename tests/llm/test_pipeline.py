"""The pipeline's stages, each against brute force on what the stage before it kept."""

import collections

import pytest

import corpus_pipeline as P
from emporium.llm import common as C
from emporium.llm import toxicity
from test_llm_operators import SF_SMALL, brute_components, brute_removal, docs, none, rows, words  # noqa: F401


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output of every stage over the smallest tables."""
    found, kept = {}, spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    for name, stage in P.STAGES:
        out = C.written(stage(spark, kept, SF_SMALL), "test-stage")
        found[name] = (kept, out)
        kept = out
    return found


def table(df):
    return sorted((r.doc_id, r.text, r.lang, r.source) for r in df.collect())


def test_order():
    assert [n for n, _ in P.STAGES] == ["toxicity", "near_dedup", "substring_dedup", "source_mixing", "best_fit_packing"]


def test_columns(stages):
    for name, (before, after) in stages.items():
        if name != "best_fit_packing":
            assert after.columns == before.columns


def test_toxicity_stage(spark, stages):
    before, after = stages["toxicity"]
    scores = {r.id: r.score for r in toxicity.score_toxicity(before, spark.read.parquet(f"{SF_SMALL}/labels.parquet")).collect()}
    assert table(after) == [r for r in table(before) if scores[r[0]] < 0.5]


def test_near_dedup_stage(stages):
    before, after = stages["near_dedup"]
    label = brute_components([(r.doc_id, r.text) for r in before.collect()], percent=80)
    assert table(after) == [r for r in table(before) if label[r[0]] == r[0]]


def test_substring_stage(stages):
    before, after = stages["substring_dedup"]
    rows_ = table(before)
    want = []
    for (i, t, lang, source), (_, n, gone, kept) in zip(rows_, brute_removal(rows_)):
        if gone == 0 or gone < n:
            want.append((i, (t or "") if gone == 0 else kept, lang, source))
    assert table(after) == sorted(want)
    sizes = {r.doc_id: r.n_chars for r in after.collect()}
    assert all(sizes[i] == len(t) for i, t, *_ in table(after) if t)


def test_mixing_stage(stages):
    before, after = stages["source_mixing"]
    had, got = collections.Counter(table(before)), collections.Counter(table(after))
    assert set(got) <= set(had) and all(n <= 2 * had[r] for r, n in got.items())
    size = collections.Counter()
    longest = collections.Counter()
    for i, t, _, s in had:
        size[s] += len(words(t))
        longest[s] = max(longest[s], len(words(t)))
    from emporium.llm.source_mixing import source_targets

    totals = before.sparkSession.createDataFrame(list(size.items()), "source string, source_size long")
    target = {r.source: r.target for r in source_targets(totals).collect()}
    taken = collections.Counter()
    for (i, t, _, s), n in got.items():
        taken[s] += n * len(words(t))
    assert all(abs(taken[s] - target[s]) <= longest[s] / 2 + 1 for s in size)


def test_packing_stage(stages):
    before, after = stages["best_fit_packing"]
    bins, pieces = collections.defaultdict(list), collections.Counter()
    for r in after.collect():
        bins[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id] += r.length
    for b in bins.values():
        at = 0
        for offset, n in sorted(b):
            assert offset == at
            at += n
        assert at <= 2048
    assert set(pieces) == {r.doc_id for r in before.select("doc_id").collect()}
    assert len(bins) <= sum(pieces.values()) / 2048 * 1.05 + 2


def test_stages_on_odd_input(spark, docs, none):  # noqa: F811
    """Nulls, empty and repeated rows, clashing columns, and no rows at all, through every stage."""
    for start in (docs, none):
        kept = start
        for _, stage in P.STAGES:
            kept = C.written(stage(spark, kept, SF_SMALL), "test-stage")
        assert (kept.count() > 0) == (start is docs)
    once = P.near_dedup(spark, docs, SF_SMALL)
    ids = [r.doc_id for r in once.collect() if r.doc_id is not None]
    assert len(ids) == len(set(ids)) and once.where("doc_id is null").count() == docs.where("doc_id is null").count()


def test_rows_of_one_id(spark):
    """A row that is a copy goes, the unique one with its id stays; of several unique ones always the same stays."""
    text = {k: " ".join(f"{k}{i}" for i in range(40)) for k in "abcd"}
    start = [(1, text["a"], "s"), (5, text["b"], "s"), (5, text["a"], "s"), (7, text["c"], "s"), (7, text["d"], "s"), (7, text["d"], "t")]
    found = []
    for rows_ in (start, start[::-1]):
        df = spark.createDataFrame(rows_, "doc_id long, text string, source string").coalesce(1)
        found.append(sorted((r.doc_id, r.text, r.source) for r in P.near_dedup(spark, df, SF_SMALL).collect()))
    assert found[0] == found[1] and [r[0] for r in found[0]] == [1, 5, 7]
    assert found[0][:2] == [(1, text["a"], "s"), (5, text["b"], "s")]


def test_a_run_leaves_only_its_result(spark):
    """The stages' tables are deleted on the way; the result is whole and can be read again."""
    import os

    before = set(C.folders())
    out = P.run(spark, SF_SMALL)
    left = [f for f in C.folders() if f not in before]
    assert len(left) == 1 and "/stage-best_fit_packing-" in left[0] and out.count() > 0
    folder = os.path.dirname(left[0]).removeprefix("file:")
    mine = [n for n in os.listdir(folder) if n.startswith(("stage-", "signs-"))]
    assert sum(n.startswith("stage-best_fit_packing") for n in mine) == 1 and not any(n.startswith("stage-near_dedup") for n in mine)
