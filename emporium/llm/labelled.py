"""Learning rows of the classifiers: a bounded sample of labelled documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 5


def held_out(doc_id: Column, folds: int = FOLDS, rest: int = 0) -> Column:
    """True where crc32 of the id as text leaves ``rest``; a null id counts as held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == rest, F.lit(True))


def sample_labelled(docs: DataFrame, labels: DataFrame, label: str, per_class: int) -> DataFrame:
    """``id``, ``text`` and ``label`` (0/1) of at most ``per_class`` documents of each label outside the held-out fold.

    The sample is the first ids in hash order, so it does not depend on file
    layout and a rerun takes the same. Of rows that share an id the one with
    the least text hash is taken, so the sample's size is bounded. Several
    labels of one id count as their maximum.
    """
    known = (labels.select(labels["doc_id"].cast("long").alias("id"), labels[label].cast("int").alias("label"))
             .where(F.col("label").isin(0, 1) & F.col("id").isNotNull() & ~held_out(F.col("id")))
             .groupBy("id").agg(F.max("label").alias("label")))
    order = (F.xxhash64("id"), F.col("id"))
    chosen = [known.where(F.col("label") == k).orderBy(*order).limit(per_class) for k in (0, 1)]
    d = docs.select(docs["doc_id"].cast("long").alias("id"), F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"))
    found = d.join(F.broadcast(chosen[0].unionByName(chosen[1])), "id")  # at most 2 * per_class rows
    least = F.min(F.struct(F.xxhash64("text").alias("place"), "text")).alias("least")
    return found.groupBy("id", "label").agg(least).select("id", "least.text", "label")
