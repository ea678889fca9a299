from emporium.operators.quality import Check, quality_report, snapshot_invariants, spine_gaps
from emporium.functions.macros import date_spine


def test_quality_report_counts(spark):
    df = spark.createDataFrame([(1, "usd", -1, "a"), (1, "XYZ", 5, None), (2, None, 0, "b")],
                               "id long, cur string, amt long, s string")
    parent = spark.createDataFrame([(1,)], "id long")
    checks = [Check("t", "id", "unique"), Check("t", "s", "not_null"), Check("t", "amt", "not_negative"),
              Check("t", "cur", "valid_currency_code"), Check("t", "s", "accepted_values", ("a",)),
              Check("t", None, "row_count_between", (1, 2)),
              Check("t", "id", "referential_integrity", ("p", "id"))]
    got = {(r.column_name, r.test): r.failures for r in
           quality_report({"t": df, "p": parent}, checks).collect()}
    assert got == {("id", "unique"): 1, ("s", "not_null"): 1, ("amt", "not_negative"): 1,
                   ("cur", "valid_currency_code"): 1, ("s", "accepted_values"): 1,
                   (None, "row_count_between"): 1, ("id", "referential_integrity"): 1}


def test_spine_has_no_gaps(spark):
    r = spine_gaps(date_spine(spark, "2023-01-01", "2025-12-31")).first()
    assert (r.missing_days, r.duplicate_days) == (0, 0)


def test_snapshot_invariants_flag_bad_rows(spark):
    import datetime as dt
    T = dt.datetime
    h = spark.createDataFrame([(1, T(2024, 1, 1), None), (1, T(2024, 2, 1), None),
                               (2, T(2024, 3, 1), T(2024, 2, 1))],
                              "k long, valid_from timestamp_ntz, valid_to timestamp_ntz")
    got = {(r.key, r.violation) for r in snapshot_invariants(h, "k").collect()}
    assert got == {("1", "multiple_current"), ("2", "valid_from_not_before_valid_to")}


def test_failing_rows(spark):
    from emporium.operators.quality import failing_rows

    df = spark.createDataFrame([(1, -5), (1, 3), (2, None)], "id long, amt long")
    assert [r.amt for r in failing_rows(df, Check("t", "amt", "not_negative")).collect()] == [-5]
    assert [(r.id, r["count"]) for r in failing_rows(df, Check("t", "id", "unique")).collect()] == [(1, 2)]
    assert failing_rows(df, Check("t", "amt", "not_null")).count() == 1


def test_declared_checks_are_all_there():
    """Per type as the schema files declare them, plus the attached referential check and the duration bound."""
    from collections import Counter

    from emporium.plans.checks import ALL_CHECKS

    assert Counter(c.test for c in ALL_CHECKS) == {
        "not_null": 126, "unique": 29, "not_negative": 28, "accepted_values": 14, "valid_currency_code": 3,
        "row_count_between": 1, "referential_integrity": 1, "expression": 1}


def test_planted_traps_are_found(spark):
    from conftest import SF_SMALL
    from emporium.queries import QUERIES

    assert QUERIES["assert_no_orphaned_order_items"](spark, SF_SMALL).count() > 0
    assert {r.violation for r in QUERIES["snapshot_invariants"](spark, "/root/testdata/sf0.01").select("violation").distinct().collect()} == {
        "multiple_current", "valid_from_not_before_valid_to"}


def test_report_computes_each_model_once(spark):
    """No check plans a join, an order or a grouping of a model again: the report reads landed tables."""
    from conftest import SF_SMALL
    from emporium.queries import QUERIES

    plan = QUERIES["quality_report"](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "Join LeftOuter" not in plan
    assert plan.count("Join LeftAnti") == 1  # the referential check


def test_landed_models_have_the_planned_rows(spark, scratch):
    from conftest import SF_SMALL
    from emporium.queries import MODEL_NAMES, landed_models, warehouse

    landed, planned = landed_models(spark, SF_SMALL, f"{scratch}/landed"), warehouse(spark, SF_SMALL)
    for name, model in MODEL_NAMES.items():
        got = landed[name]
        want = getattr(planned, model).select(*got.columns)
        assert want.exceptAll(got).isEmpty() and got.exceptAll(want).isEmpty(), name
    for name in ("inventory", "order_items", "sessions", "page_views", "shopify_refunds", "stripe_refunds"):
        assert planned.stg[name].exceptAll(landed[f"stg_{name}"]).isEmpty(), name
        assert landed[f"stg_{name}"].exceptAll(planned.stg[name]).isEmpty(), name


def test_run_audit_leaves_no_tables(spark):
    from conftest import SF_SMALL
    from emporium.operators.fs import child_names
    from emporium.queries import QUERIES
    from emporium.session import shared_dir

    before = set(child_names(spark, shared_dir(spark, "tables")))
    assert QUERIES["run_audit"](spark, SF_SMALL).first().test_count == 203
    assert set(child_names(spark, shared_dir(spark, "tables"))) == before
