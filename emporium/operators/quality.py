"""Data-quality checks (Q1-Q7, Q10-Q12, Q14) evaluated in bulk.

All row-level rules of one model (not_null, accepted_values, not_negative,
valid_currency_code, expression rules, row count) share one scan, a
``unique`` rule is a count of its key (see ``_model_sql``);
``referential_integrity`` is a left anti join. The report is generated as
one SQL statement over temporary views of the models. A model is read for
its row rules and for each key: one that costs more than a scan is better
landed first. Failing rows
themselves are fetched with ``failing_rows`` only when a count is non-zero.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Currencies accepted by the valid_currency_code test.
VALID_CURRENCIES = ["usd", "eur", "gbp", "cad", "aud", "jpy", "chf", "cny", "inr", "brl"]


@dataclass(frozen=True)
class Check:
    model: str
    column: str | None
    test: str                      # not_null | unique | accepted_values | not_negative |
    #                                valid_currency_code | row_count_between | expression |
    #                                referential_integrity
    values: tuple = field(default_factory=tuple)  # accepted values / (lo, hi) / (to_model, to_field)
    expr: str | None = None        # failing-row predicate for ``expression``


def _fails(c: Check) -> Column:
    return F.expr(_fail_sql(c))


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _lit(v) -> str:
    if isinstance(v, str):
        return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return repr(v)


def _fail_sql(c: Check) -> str:
    """SQL predicate that is true for a failing row (null = pass, as in WHERE)."""
    col = _q(c.column) if c.column else None
    if c.test == "not_null":
        return f"{col} IS NULL"
    if c.test == "accepted_values":
        return f"{col} NOT IN ({', '.join(_lit(v) for v in c.values)})"
    if c.test == "not_negative":
        return f"{col} < 0"
    if c.test == "valid_currency_code":
        return f"lower({col}) NOT IN ({', '.join(_lit(v) for v in VALID_CURRENCIES)})"
    if c.test == "expression":
        return f"({c.expr})"
    raise ValueError(c.test)


ROW_RULES = {"not_null", "accepted_values", "not_negative", "valid_currency_code", "expression"}


def _result(model: str, column: str | None, test: str, failures_sql: str) -> str:
    col = "CAST(NULL AS STRING)" if column is None else f"CAST({_lit(column)} AS STRING)"
    return (f"named_struct('model', {_lit(model)}, 'column_name', {col}, 'test', {_lit(test)}, "
            f"'failures', CAST({failures_sql} AS BIGINT))")


def _model_sql(model: str, view: str, checks: list[Check], views: dict[str, str]) -> list[str]:
    """SQL blocks (model, column_name, test, failures) for the checks of one model.

    All row rules are sums of one scan, so a map task sends one row. A unique
    rule reads its key alone and shuffles that: keys in their own type, and
    equal reads of equal keys by several models are one exchange.
    """
    out = []
    row = [c for c in checks if c.test in ROW_RULES or c.test == "row_count_between"]
    if row:
        vals, results = [], []
        for i, c in enumerate(row):
            n = f"coalesce(__r{i}, 0)"
            if c.test == "row_count_between":
                lo, hi = c.values
                vals.append(f"count(1) AS __r{i}")
                n = f"CASE WHEN {n} BETWEEN {lo} AND {hi} THEN 0 ELSE 1 END"
            else:
                vals.append(f"sum(CASE WHEN {_fail_sql(c)} THEN 1L ELSE 0L END) AS __r{i}")
            results.append(_result(c.model, c.column, c.test, n))
        out.append(f"SELECT x.* FROM (SELECT explode(array({', '.join(results)})) AS x FROM (SELECT {', '.join(vals)} FROM {view}))")
    for c in checks:
        if c.test == "unique":
            col = _q(c.column)
            out.append(f"SELECT x.* FROM (SELECT {_result(model, c.column, 'unique', 'count(1)')} AS x FROM "
                       f"(SELECT {col} FROM {view} WHERE {col} IS NOT NULL GROUP BY {col} HAVING count(1) > 1))")
    for c in checks:
        if c.test == "referential_integrity":
            to_model, to_field = c.values
            col = _q(c.column)
            out.append(
                f"SELECT {_lit(model)} AS model, CAST({_lit(c.column)} AS STRING) AS column_name, "
                f"'referential_integrity' AS test, count(1) AS failures "
                f"FROM (SELECT {col} AS k FROM {view} WHERE {col} IS NOT NULL) m "
                f"LEFT ANTI JOIN (SELECT {_q(to_field)} AS k FROM {views[to_model]}) p ON m.k = p.k")
    return out


def quality_report(models: dict[str, DataFrame], checks: list[Check]) -> DataFrame:
    """All checks of all models: one row per check with its failure count and status.

    The models are exposed as temporary views and the whole report is one
    SQL statement, analysed once (building it column by column through the
    Python API costs tens of thousands of driver round trips). The views are
    dropped once the statement is analysed; the plan keeps what it needs.
    """
    needed: list[str] = []
    for c in checks:
        for m in [c.model] + ([c.values[0]] if c.test == "referential_integrity" else []):
            if m not in needed:
                needed.append(m)
    spark = models[needed[0]].sparkSession
    tag = uuid.uuid4().hex[:12]
    views = {m: f"__quality_{tag}_{i}" for i, m in enumerate(needed)}
    for m, v in views.items():
        # a projection of its own: dropping a view also drops what is cached for its plan,
        # and the frames that callers hand in may be cached
        models[m].select("*", F.lit(tag).alias("__view")).createOrReplaceTempView(v)
    by_model: dict[str, list[Check]] = {}
    for c in checks:
        by_model.setdefault(c.model, []).append(c)
    blocks = [b for m, cs in by_model.items() for b in _model_sql(m, views[m], cs, views)]
    try:
        out = spark.sql(
            "SELECT model, column_name, test, failures, "
            "CASE WHEN failures > 0 THEN 'fail' ELSE 'pass' END AS status FROM ("
            + " UNION ALL ".join(f"SELECT * FROM ({b})" for b in blocks) + ")")
        out.columns  # analyse while the views exist
    finally:
        for v in views.values():
            spark.catalog.dropTempView(v)
    return out


def check_counts(df: DataFrame, model: str, checks: list[Check],
                 models: dict[str, DataFrame] | None = None) -> DataFrame:
    """(model, column_name, test, failures, status) for the checks of one model."""
    frames = dict(models or {})
    frames[model] = df
    return quality_report(frames, [c for c in checks if c.model == model])


def failing_rows(df: DataFrame, check: Check) -> DataFrame:
    """Rows (or duplicated values) that fail one check."""
    if check.test == "unique":
        return (df.where(F.col(check.column).isNotNull()).groupBy(check.column).count()
                .where(F.col("count") > 1))
    return df.where(_fails(check))


# --------------------------------------------------------------- invariants
def snapshot_invariants(history: DataFrame, key: str) -> DataFrame:
    """Q10: keys with more than one open row, and closed rows whose validity
    does not move forward. One row per violation."""
    multi_open = (history.where(F.col("valid_to").isNull()).groupBy(key).count()
                  .where(F.col("count") > 1)
                  .select(F.col(key).cast("string").alias("key"), F.lit("multiple_current").alias("violation")))
    bad_range = (history.where(F.col("valid_to").isNotNull() & (F.col("valid_from") >= F.col("valid_to")))
                 .select(F.col(key).cast("string").alias("key"), F.lit("valid_from_not_before_valid_to").alias("violation")))
    return multi_open.unionByName(bad_range)


def spine_gaps(dates: DataFrame, col: str = "date_day") -> DataFrame:
    """Q12: missing days between the first and last day, without a window:
    expected span minus distinct days (plus duplicates), in one aggregate."""
    return dates.agg(
        (F.datediff(F.max(col), F.min(col)) + 1 - F.countDistinct(col)).cast("bigint").alias("missing_days"),
        (F.count(col) - F.countDistinct(col)).alias("duplicate_days"))
