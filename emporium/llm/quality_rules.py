"""Quality rules whose cutoffs keep false rejections under a proven limit.

Rules are shares of a text: symbols, exclamation marks, capitals, repeated
three-word windows, copied lines. A rule rejects from some step of a grid of
``STEPS`` on. Which step is learned from labelled documents, for each stratum
(language) on its own: from the most lenient step down, the exact binomial
test must rule out that good documents are rejected more often than the
rule's part of ``RISK``; the first step that fails ends the sequence, so steps
need no correction, and strata and rules share ``DOUBT`` evenly (Bonferroni).
Of the certified steps a rule takes the one that tells good from bad best,
and none if that is no gain. With too few labels nothing is certified and
only the fixed base rules reject.

Everything here is DataFrame functions: the text is read once, all else runs
on one narrow row a document and on a small table of counts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from . import common as C

SPACE = r"[\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
STEPS = 50
#: Share of a stratum's good documents that all rules together may reject, and the chance that some bound fails.
RISK, DOUBT = 0.05, 0.05
#: Rule: numerator and denominator, columns of `text_counts`.
RULES = {
    "symbols": ("n_symbols", "word_chars"),
    "bangs": ("n_bangs", "word_chars"),
    "capitals": ("n_capitals", "word_chars"),
    "repeats": ("n_repeat_words", "n_words"),
    "copied_lines": ("n_dup_lines", "n_lines"),
}


def _without(chars: str) -> Column:
    """Characters of the text that are among ``chars``."""
    return F.char_length("text") - F.char_length(F.translate("text", chars, ""))


def _covered(words: Column, order: str) -> list[tuple[str, Column]]:
    """Columns, to be added one by one, up to the number of words in three-word windows that occur twice."""
    n = F.size("words")
    hashed = F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.struct(
        F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2)).alias("h"), i.alias("i")))
    same = lambda a, b: F.coalesce(a["h"] == b["h"], F.lit(False))
    twice = F.filter("windows", lambda w, k: same(F.get("windows", k + 1), w) | same(F.when(k > 0, F.get("windows", k - 1)), w))
    count = F.aggregate(
        F.sort_array(F.transform("twice", lambda w: w["i"])), F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda s, i: F.struct((s["n"] + i + 3 - F.greatest(i, s["end"])).alias("n"), (i + 3).alias("end")), lambda s: s["n"])
    return [("windows", F.when(n >= 3, F.sort_array(hashed))), ("twice", twice),
            ("n_repeat_words", F.coalesce(count, F.lit(0)).cast("long"))]


def text_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str | None = "lang") -> DataFrame:
    """One narrow row a document: ``id``, ``stratum`` and the counts that base rules and `RULES` use.

    A null or empty text has zeros; a null stratum is a stratum of its own.
    """
    stratum = F.coalesce(F.concat(F.lit("="), docs[stratum_col].cast("string")), F.lit("null")) if stratum_col else F.lit("all")
    d = docs.select(docs[id_col].cast("long").alias("id"), stratum.alias("stratum"),
                    F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))
    d = d.withColumn("words", F.filter(F.split("text", SPACE), lambda x: x != ""))
    for name, column in _covered(F.col("words"), "i"):
        d = d.withColumn(name, column)
    d = d.withColumn("lines", F.filter(F.split("text", "\n"), lambda x: F.length(F.translate(x, BLANKS, "")) > 0))
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    counts = {"n_words": F.size("words"), "word_chars": F.char_length(F.translate("text", BLANKS, "")),
              "n_symbols": _without(SYMBOLS), "n_bangs": _without("!"), "n_capitals": _without(capitals),
              "n_lines": F.size("lines"), "n_dup_lines": F.size("lines") - F.size(F.array_distinct("lines"))}
    return d.select("id", "stratum", "n_repeat_words", *[v.cast("long").alias(k) for k, v in counts.items()])


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _step(rule: str) -> Column:
    """Grid step of a rule's share, 0 to ``STEPS - 1``; 0 where the share is undefined."""
    top, below = (F.col(c) for c in RULES[rule])
    return F.when(below > 0, F.least(F.floor(top * STEPS / below), F.lit(STEPS - 1))).otherwise(F.lit(0)).cast("int")


def lower_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X binomial(n, p), summed in logarithms term by term; 1 where k >= n p, which no test needs exactly."""
    odds = F.lit(p / (1 - p))
    first = n * F.log1p(F.lit(-p))
    end = F.aggregate(
        F.when((k > 0) & (k < n * p), F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>")),
        F.struct(first.alias("term"), first.alias("sum")),
        lambda s, i: _add(s, s["term"] + F.log((n - i + 1) / i * odds)), lambda s: s["sum"])
    return F.when(k >= n * p, F.lit(1.0)).otherwise(F.exp(end))


def _add(s: Column, term: Column) -> Column:
    high, low = F.greatest(s["sum"], term), F.least(s["sum"], term)
    return F.struct(term.alias("term"), (high + F.log1p(F.exp(low - high))).alias("sum"))


def certified_cutoffs(counts: DataFrame, labels: DataFrame, risk: float = RISK, doubt: float = DOUBT, label: str = "quality") -> DataFrame:
    """``stratum`` and the least rejected step of each rule (null: the rule does not apply there)."""
    known = (labels.select(labels["doc_id"].cast("long").alias("id"), labels[label].cast("int").alias("label"))
             .where(F.col("label").isin(0, 1)).groupBy("id").agg(F.max("label").alias("label")))
    steps = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), _step(r).alias("step")) for r in RULES]))
    held = (counts.join(known, "id").select("stratum", "label", steps.alias("s")).groupBy("stratum", "s.rule", "s.step")
            .agg(F.sum("label").alias("good"), F.sum(1 - F.col("label")).alias("bad")))
    # every step of the grid, also those without documents
    all_steps = held.select("stratum", "rule").distinct().withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(STEPS - 1))))
    here = W.partitionBy("stratum", "rule")
    whole = held.groupBy("stratum", "rule").agg(F.sum("good").alias("n_good"), F.sum("bad").alias("n_bad"))
    down = here.orderBy(F.col("step").desc())
    table = (all_steps.join(held, ["stratum", "rule", "step"], "left").join(whole, ["stratum", "rule"])
             .withColumn("lost", F.sum(F.coalesce("good", F.lit(0))).over(down)).withColumn("caught", F.sum(F.coalesce("bad", F.lit(0))).over(down)))
    tests = table.select("stratum").distinct().agg(F.count("*").alias("strata"))
    tested = (table.join(tests)  # one row
              .withColumn("p", lower_tail(F.col("lost"), F.col("n_good"), risk / len(RULES)))
              .withColumn("open", F.min((F.col("p") <= F.lit(doubt) / (F.col("strata") * len(RULES))).cast("int")).over(down) == 1))
    gain = F.col("caught") / F.greatest("n_bad", F.lit(1)) - 10 * F.col("lost") / F.greatest("n_good", F.lit(1))
    best = (tested.where("open").withColumn("gain", gain).where("gain > 0").groupBy("stratum", "rule")
            .agg(F.max(F.struct("gain", "step"))["step"].alias("step")))
    return best.groupBy("stratum").agg(*[F.max(F.when(F.col("rule") == r, F.col("step"))).alias(f"from_{r}") for r in RULES])


def apply_rules(docs: DataFrame, labels: DataFrame, risk: float = RISK, doubt: float = DOUBT, **options) -> DataFrame:
    """Counts of every document with ``base_failed``, ``kept`` and, in ``failed_rules``, what rejected it.

    Edge cases: without words the base rule on length rejects; a null id
    takes no part in learning and is judged like any other; labels other than
    0 and 1 are ignored, several of one id count as their maximum; repeated
    rows count each; without labels only the base rules reject.
    """
    counts = C.written(text_counts(docs, **options), "text-counts")
    cutoffs = C.written(certified_cutoffs(counts, labels, risk, doubt), "cutoffs")
    failed = F.array_compact(F.array(*[F.when(_step(r) >= F.col(f"from_{r}"), F.lit(r)) for r in RULES]))
    return (counts.join(cutoffs, "stratum", "left").withColumn("base_failed", base_failed()).withColumn("failed_rules", failed)
            .withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0)))


def op4_quality_rules(spark, sf_dir: str) -> DataFrame:
    """Contract of the registered query: base counts and verdict of every document."""
    out = apply_rules(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return out.select(F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


OP4_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce('=' || lang, 'null') AS stratum, coalesce(text, '') AS text,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM documents
), g AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, array_to_string(ws[i:i + 2], ' ')) AS n
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM d WHERE len(ws) >= 3)
), r AS (
  SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, i + unnest([0, 1, 2]) AS pos FROM g WHERE n > 1) GROUP BY doc_id
), m AS (
  SELECT d.doc_id, stratum, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(length(text) - length(replace(text, '!', '')) AS BIGINT) AS n_bangs,
         CAST(length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) AS BIGINT) AS n_capitals,
         CAST(len(ls) AS BIGINT) AS n_lines, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words
  FROM d LEFT JOIN r USING (doc_id)
), s AS (
  SELECT doc_id, stratum, t.rule, CASE WHEN t.below > 0 THEN least(CAST(floor(t.top * 50 / t.below) AS INTEGER), 49) ELSE 0 END AS step
  FROM (SELECT doc_id, stratum, unnest([{'rule': 'symbols', 'top': n_symbols, 'below': word_chars}, {'rule': 'bangs', 'top': n_bangs, 'below': word_chars},
        {'rule': 'capitals', 'top': n_capitals, 'below': word_chars}, {'rule': 'repeats', 'top': n_repeat_words, 'below': n_words},
        {'rule': 'copied_lines', 'top': n_dup_lines, 'below': n_lines}]) AS t FROM m)
), l AS (SELECT doc_id, max(quality) AS q FROM labels WHERE quality IN (0, 1) GROUP BY doc_id
), c AS (
  SELECT stratum, rule, k AS step, count(*) FILTER (q = 1) AS n_good, count(*) FILTER (q = 0) AS n_bad,
         count(*) FILTER (q = 1 AND step >= k) AS lost, count(*) FILTER (q = 0 AND step >= k) AS caught
  FROM s JOIN l USING (doc_id), range(1, 50) AS x(k) GROUP BY stratum, rule, k
), p AS (
  SELECT *, CASE WHEN lost >= n_good * 0.01 THEN 1 ELSE list_sum(list_transform(range(0, lost + 1), lambda i:
    exp(lgamma(n_good + 1) - CASE WHEN i = 0 THEN 0 ELSE lgamma(i + 1) END - lgamma(n_good - i + 1) + i * ln(0.01) + (n_good - i) * ln(0.99)))) END AS p,
    (SELECT count(DISTINCT stratum) FROM c) AS strata FROM c
), o AS (
  SELECT *, min(CAST(p <= 0.05 / (strata * 5) AS INTEGER)) OVER (PARTITION BY stratum, rule ORDER BY step DESC) AS open,
         caught / greatest(n_bad, 1) - 10 * lost / greatest(n_good, 1) AS gain FROM p
), b AS (SELECT stratum, rule, arg_max(step, gain * 1000 + step / 100000) AS cutoff FROM o WHERE open = 1 AND gain > 0 GROUP BY stratum, rule
), f AS (SELECT DISTINCT doc_id FROM s JOIN b USING (stratum, rule) WHERE step >= cutoff)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND doc_id NOT IN (SELECT doc_id FROM f) AS kept
FROM m
"""
