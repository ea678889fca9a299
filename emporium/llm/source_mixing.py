"""Mix sources to target weights by weighted fair queueing.

Each source queues its documents in shuffled order, once for each pass over
it. A copy's virtual finish time is the source's words up to its end over the
source's target, so at virtual time v every source has sent v times its
target. The budget is used up at virtual time 1, as the targets add up to it,
so the cut is computed for each source by itself, at its own target, and the
copy in service there is cut with it. Only :func:`mixed_documents` sorts
copies by finish time.

Running sums never pass through one task: documents fall into hash ranges of
their shuffle key, sums of whole ranges give each range its start, and only
inside a range is there a running sum.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import common as C

WEIGHTS = (5, 2, 1)
SHARE = 1.5
PASSES = 2
#: Documents of one source in one running sum, about.
RANGE_DOCUMENTS = 1 << 14
WORD = r"[^\x20\x09-\x0D]+"


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, passes: float = PASSES) -> DataFrame:
    """Target words of each source from a table ``source``, ``source_size``.

    Sources in code point order, null last, take the weights in turn. A target
    stops at ``passes`` times the source; what it would get beyond is shared
    among the others by weight until none is above. In order of room a weight
    that is: the first source whose equal share fits its room sets the level.
    """
    order = W.orderBy(F.col("source").asc_nulls_last())
    by_room = W.orderBy("room_a_weight", F.col("source").asc_nulls_last())
    rank = F.row_number().over(order) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
    s = (sizes.withColumn("weight", weight).withColumn("room", F.col("source_size") * F.lit(float(passes)))
         .withColumn("room_a_weight", F.col("room") / F.col("weight")))
    before = by_room.rowsBetween(W.unboundedPreceding, -1)
    rest = by_room.rowsBetween(W.currentRow, W.unboundedFollowing)
    whole = W.partitionBy(F.lit(1))
    s = s.withColumn("level", (F.sum("source_size").over(whole) * F.lit(float(share)) - F.coalesce(F.sum("room").over(before), F.lit(0.0)))
                     / F.sum("weight").over(rest))
    s = s.withColumn("level", F.min(F.when(F.col("level") <= F.col("room_a_weight"), F.struct("room_a_weight", "level"))).over(whole)["level"])
    return s.select("source", "source_size", F.least(F.col("room"), F.coalesce(F.col("level") * F.col("weight"), F.col("room"))).alias("target"))


def _clip(x: Column) -> Column:
    return F.least(F.greatest(x, F.lit(0)), F.col("size"))


def mix_sources(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, passes: int = PASSES, seed: str = "mix",
                id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", carry=(),
                range_documents: int = RANGE_DOCUMENTS) -> DataFrame:
    """How many words of each document the mix takes.

    Returns per input row ``id``, ``source``, ``size`` (words), ``source_size``,
    ``target``, ``before`` (words of its source ahead of it), ``taken`` and
    ``copies``: of each pass that takes any, or holds the row whole at no
    cost, its ``pass``, ``taken`` and virtual ``finish``. ``carry`` names
    input columns to pass on in a struct ``carried``.

    Edge cases: a null text has size 0 and is taken 0; a null source is a
    source of its own; equal rows queue one after the other, in any order; a
    null id queues by the hash of null; an empty table gives an empty result.
    """
    d = docs.select(docs[id_col].cast("long").alias("id"), docs[source_col].cast("string").alias("source"),
                    F.coalesce(F.regexp_count(docs[text_col], F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
                    *([F.struct(*[docs[c].alias(c) for c in carry]).alias("carried")] if carry else []))
    d = d.withColumn("key", F.md5(F.concat(F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(":" + seed))))
    # null sources take part in joins and windows under a text of their own
    d = d.withColumn("queue", F.when(F.col("source").isNull(), "n").otherwise(F.concat(F.lit("s"), "source")))
    if not carry:  # words are counted once; with carried columns the rows may be as wide as the texts, and are read again instead
        d = C.written(d, "sizes")
    slim = d.select("queue", "source", "size", "key")
    digits = max(2, math.ceil(math.log(max(slim.count(), 1) / range_documents + 1, 16)))
    part = F.substring("key", 1, digits).alias("part")
    ranges = slim.groupBy("queue", "source", part).agg(F.sum("size").alias("part_size"))
    targets = source_targets(ranges.groupBy("source").agg(F.sum("part_size").alias("source_size")), weights, share, passes)
    targets = targets.withColumn("queue", F.when(F.col("source").isNull(), "n").otherwise(F.concat(F.lit("s"), "source"))).drop("source")
    ahead = F.coalesce(F.sum("part_size").over(W.partitionBy("queue").orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = ranges.select("queue", "part", ahead.alias("part_start")).join(targets, "queue")
    inside = W.partitionBy("queue", "part").orderBy("key", "id", "size").rowsBetween(W.unboundedPreceding, -1)
    out = (d.withColumn("part", part).join(starts, ["queue", "part"])
           .withColumn("before", F.col("part_start") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
           .withColumn("goal", F.floor(F.col("target") + 0.5).cast("long")))
    each = [(k, F.col("before") + F.col("source_size") * k) for k in range(passes)]
    taken = sum((_clip(F.col("goal") - ahead) for _, ahead in each), F.lit(0)).cast("long")
    copies = F.array(*[F.struct(F.lit(k).alias("pass"), _clip(F.col("goal") - ahead).cast("long").alias("taken"),
                                ((ahead + F.col("size")) / F.greatest(F.col("target"), F.lit(1e-9))).alias("finish")) for k, ahead in each])
    return out.select("id", "source", "size", "source_size", "target", "before", taken.alias("taken"), copies.alias("copies"),
                      *(["carried"] if carry else []))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mixed stream: whole documents, as often as they are taken, range-sorted by virtual finish time.

    Returns the columns of ``docs``. The copy in service when the budget ends
    stays if at least half of it fits, so no text is cut and each source is
    within half a document of its target. Documents without words stay once.
    """
    mixed = mix_sources(docs, carry=docs.columns, **options)
    copies = mixed.select("carried", "size", F.explode("copies").alias("copy"))
    stays = F.when(F.col("size") == 0, F.col("copy.pass") == 0).otherwise((F.col("copy.taken") > 0) & (F.col("copy.taken") * 2 >= F.col("size")))
    return copies.where(stays).orderBy("copy.finish").select(*[F.col("carried")[c].alias(c) for c in docs.columns])


def op5_source_mixing(spark, sf_dir: str) -> DataFrame:
    """Contract of the registered query: words taken of each document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mix_sources(docs).select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


OP5_SQL = r"""
WITH d AS (
  SELECT doc_id, source, md5(CAST(doc_id AS VARCHAR) || ':mix') AS key,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents
), q AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY key, doc_id, size
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM d
), s AS (SELECT source, CAST(sum(size) AS DOUBLE) AS total FROM d GROUP BY source
), w AS (
  SELECT *, CAST([5, 2, 1][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INTEGER)] AS DOUBLE) AS weight FROM s
), l AS (
  SELECT *, 2 * total AS room, 2 * total / weight AS per,
         (1.5 * sum(total) OVER () - coalesce(sum(2 * total) OVER (ORDER BY 2 * total / weight, source NULLS LAST
                                                                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (ORDER BY 2 * total / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM w
), t AS (
  SELECT source, CAST(total AS BIGINT) AS source_size,
         least(room, coalesce((SELECT level FROM l WHERE level <= per ORDER BY per LIMIT 1) * weight, room)) AS target FROM l
)
SELECT doc_id, size, source_size, target,
       CAST(least(greatest(floor(target + 0.5) - before, 0), size)
            + least(greatest(floor(target + 0.5) - source_size - before, 0), size) AS BIGINT) AS taken
FROM q JOIN t ON q.source IS NOT DISTINCT FROM t.source
"""
