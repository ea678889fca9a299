"""Connected components of an edge table, by hooking and contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``label``, the smallest node it can reach, for every node of ``edges`` (columns ``a``, ``b``).

    Each round every node hooks onto its smallest neighbour, chains are
    shortened, and the edges are renamed to the hooks; what lies inside one
    group falls away. A round at least halves the groups that still touch
    others. Every round's tables are written, so lineage stays short, and
    nothing but emptiness is ever asked by the driver.
    """
    edges = C.written(edges.select("a", "b").where("a <> b").distinct(), "edges")
    labels = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("to")).select("node", F.least("node", "to").alias("to"))
        hook = C.written(hook, "hooks")
        up = hook.select(F.col("node").alias("to"), F.col("to").alias("next"))
        for _ in range(2):  # a hook's hook: chains get four times shorter
            hook = hook.join(up, "to", "left").select("node", F.coalesce("next", "to").alias("to"))
        hook = C.written(hook, "hooks")
        one = hook.select(F.col("node").alias("a"), F.col("to").alias("x"))
        two = hook.select(F.col("node").alias("b"), F.col("to").alias("y"))
        edges = C.written(edges.join(one, "a").join(two, "b").where("x <> y")
                          .select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct(), "edges")
        if labels is None:
            labels = hook.select("node", F.col("to").alias("label"))
        else:
            later = hook.select(F.col("node").alias("label"), F.col("to").alias("next"))
            labels = C.written(labels.join(later, "label", "left").select("node", F.coalesce("next", "label").alias("label")), "labels")
    return labels if labels is not None else edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
