import pytest

from emporium.operators.union import NoRelationsFound, union_relations, union_sources


def test_union_sources_discovers_matching_schemas(spark, scratch):
    root = f"{scratch}/lake"
    spark.createDataFrame([(1, "a")], "id long, v string").write.parquet(f"{root}/shop_eu/orders")
    spark.createDataFrame([(2, "b", 7)], "id long, v string, extra int").write.parquet(f"{root}/shop_us/orders")
    spark.createDataFrame([(3, "c")], "id long, v string").write.parquet(f"{root}/other/orders")
    out = union_sources(spark, root, "shop_*", "orders")
    got = sorted((r.id, r.v, r.extra, r._source_schema) for r in out.collect())
    assert got == [(1, "a", None, "shop_eu"), (2, "b", 7, "shop_us")]
    with pytest.raises(NoRelationsFound):
        union_sources(spark, root, "nothing_*", "orders")


def test_union_relations_optional_dedupe(spark):
    a = spark.createDataFrame([(1, "old", 1)], "id long, v string, seq int")
    b = spark.createDataFrame([(1, "new", 2), (2, "x", 1)], "id long, v string, seq int")
    out = union_relations({"a": a, "b": b}, dedupe_key="id", order_col="seq")
    assert sorted((r.id, r.v) for r in out.collect()) == [(1, "new"), (2, "x")]
    assert union_relations({"a": a, "b": b}).count() == 3
