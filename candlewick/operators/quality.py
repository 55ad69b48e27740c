"""Declarative data tests and source freshness (Q-1..Q-5).

A test's result is the number of rows its failing-rows query returns (the model
build tool's convention): ``not_null`` counts null rows, ``unique`` counts
duplicated values, ``accepted_values`` counts distinct values outside the list
(nulls pass).  All ``not_null`` / ``accepted_values`` tests of one table are
evaluated in ONE aggregate pass; each ``unique`` test is one hash aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RESULT_COLUMNS = ["model", "column_name", "test", "failures", "status"]


# --- failing-rows operators (Q-1..Q-3) -------------------------------------------

def not_null(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col).isNull())


def unique(df: DataFrame, col: str) -> DataFrame:
    return (df.filter(F.col(col).isNotNull()).groupBy(col)
              .agg(F.count(F.lit(1)).alias("n_records")).filter(F.col("n_records") > 1))


def accepted_values(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    c = F.col(col)
    return (df.filter(c.isNotNull() & ~c.isin(*values)).groupBy(col)
              .agg(F.count(F.lit(1)).alias("n_records")))


# --- suites (Q-5) ------------------------------------------------------------------

@dataclass
class TableTests:
    model: str
    not_null: list[str] = field(default_factory=list)
    unique: list[str] = field(default_factory=list)
    accepted_values: dict[str, list] = field(default_factory=dict)


def _bad_value(col: str, values: Sequence) -> Column:
    c = F.col(col)
    return F.when(c.isNotNull() & ~c.isin(*values), c)


def table_results(df: DataFrame, tests: TableTests) -> DataFrame:
    """Results of every test of one table: (model, column_name, test, failures, status)."""
    parts = []
    single = []
    for c in tests.not_null:
        single.append((c, "not_null", F.sum(F.col(c).isNull().cast("bigint"))))
    for c, vals in tests.accepted_values.items():
        single.append((c, "accepted_values", F.count_distinct(_bad_value(c, vals)).cast("bigint")))
    if single:
        row = df.agg(*[e.alias(f"_t{i}") for i, (_, _, e) in enumerate(single)])
        stack = ", ".join(f"'{c}', '{t}', coalesce(_t{i}, 0L)" for i, (c, t, _) in enumerate(single))
        parts.append(row.selectExpr(f"stack({len(single)}, {stack}) as (column_name, test, failures)"))
    for c in tests.unique:
        parts.append(unique(df, c).agg(F.count(F.lit(1)).cast("bigint").alias("failures"))
                     .select(F.lit(c).alias("column_name"), F.lit("unique").alias("test"), "failures"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(F.lit(tests.model).alias("model"), "column_name", "test",
                      F.col("failures").cast("bigint").alias("failures"),
                      F.when(F.col("failures") > 0, "fail").otherwise("pass").alias("status"))


def run_suite(models: dict[str, DataFrame], suite: Sequence[TableTests]) -> DataFrame:
    """All tests of all models as one result DataFrame (run after the models)."""
    out = None
    for t in suite:
        r = table_results(models[t.model], t)
        out = r if out is None else out.unionByName(r)
    return out


def assert_suite(results: DataFrame) -> None:
    """A failing test fails the run (the result table is tiny: one row per test)."""
    failed = results.filter(F.col("status") == "fail").collect()
    if failed:
        names = ", ".join(f"{r['model']}.{r['column_name']}:{r['test']}({r['failures']})" for r in failed)
        raise AssertionError(f"data tests failed: {names}")


# The reference project's tests (fixed values: model, columns, test kinds).
REFERENCE_SUITE = [
    TableTests("stg_trades", not_null=["coin_symbol", "trade_timestamp", "price", "is_buyer_maker"],
               accepted_values={"is_buyer_maker": [True, False]}),
    TableTests("stg_market_meta", not_null=["coin_id", "symbol", "market_cap_rank"], unique=["coin_id"]),
    TableTests("int_trades_enriched", not_null=["coin_symbol", "trade_value_usd"]),
    TableTests("int_price_changes", not_null=["coin_symbol", "trade_timestamp"]),
    TableTests("int_hourly_aggregates", not_null=["hour_ts", "coin_symbol", "vwap"]),
]


# --- freshness (Q-4) ---------------------------------------------------------------

def freshness(df: DataFrame, source: str, loaded_at: str, now, warn_after: str = "1 day",
              error_after: str = "6 days") -> DataFrame:
    """One row: ``source, max_loaded_at, snapshotted_at, age_seconds, status``
    where status is ``error`` past ``error_after``, ``warn`` past ``warn_after``,
    else ``pass``.  ``now`` is a literal (reproducible) or a column."""
    now_c = now if isinstance(now, Column) else F.lit(now).cast("timestamp_ntz")
    mx = df.agg(F.max(F.col(loaded_at).cast("timestamp_ntz")).alias("max_loaded_at"))
    age = F.timestamp_diff("SECOND", F.col("max_loaded_at"), now_c)
    over = lambda iv: F.col("max_loaded_at") + F.expr(f"INTERVAL {iv}") < now_c
    return mx.select(
        F.lit(source).alias("source"), "max_loaded_at", now_c.alias("snapshotted_at"),
        age.cast("bigint").alias("age_seconds"),
        F.when(F.col("max_loaded_at").isNull(), "error")
         .when(over(error_after), "error").when(over(warn_after), "warn")
         .otherwise("pass").alias("status"))
