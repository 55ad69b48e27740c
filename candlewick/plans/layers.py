"""Layered model build (S-5, K-7, K-9, P-11): raw tables -> staging /
intermediate views -> mart tables, in dependency order and at once where possible, and the run with data tests.

A model is a DataFrame function of its upstream models.  Its layer decides where
it lands: ``view`` models become temp views named ``<schema>__<model>`` (Spark temp
views cannot be schema-qualified); ``table`` models are written as Parquet tables
``<schema>.<model>`` under the build's root (schemas are named after it) and later models read the
written table (a mart read by two downstream marts is computed once, and the
lineage is cut there).
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from dataclasses import dataclass, field, replace

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.functions.exprs import millis_to_ts
from candlewick.operators import agg, clean, enrich, marts, quality, sinks, windows
from candlewick.schemas import RAW_MARKET_META_COLUMNS, RAW_TRADES_COLUMNS
from candlewick.session import staged


@dataclass
class Model:
    name: str
    build: Callable[[dict[str, DataFrame]], DataFrame]
    deps: Sequence[str]
    schema: str = "staging"
    materialized: str = "view"          # "view" | "table"
    cluster_by: Sequence[str] = field(default_factory=tuple)


def reference_models(as_of_date) -> list[Model]:
    """The reference project's eight models (names, layers, dependencies)."""
    return [
        Model("stg_trades", lambda m: clean.stg_trades(m["raw.trades"]), ["raw.trades"]),
        Model("stg_market_meta", lambda m: clean.stg_market_meta(m["raw.market_meta"]), ["raw.market_meta"]),
        Model("int_trades_enriched", lambda m: enrich.trades_with_meta(m["stg_trades"], m["stg_market_meta"]),
              ["stg_trades", "stg_market_meta"]),
        Model("int_price_changes", lambda m: windows.price_changes(m["stg_trades"]), ["stg_trades"]),
        Model("int_hourly_aggregates", lambda m: agg.hourly(m["stg_trades"]), ["stg_trades"]),
        Model("mart_coin_daily_ohlcv", lambda m: marts.coin_daily_ohlcv(m["stg_trades"], m["stg_market_meta"]),
              ["stg_trades", "stg_market_meta"], "marts", "table", ("coin_symbol", "trade_date")),
        Model("mart_top_movers", lambda m: marts.top_movers(m["mart_coin_daily_ohlcv"], as_of_date),
              ["mart_coin_daily_ohlcv"], "marts", "table"),
        Model("mart_market_overview",
              lambda m: marts.market_overview(m["mart_coin_daily_ohlcv"], m["stg_market_meta"], as_of_date),
              ["mart_coin_daily_ohlcv", "stg_market_meta"], "marts", "table"),
    ]


def schema_name(layer: str, root: str) -> str:
    """A layer's schema of one build: named after the build's folder, so that another build's
    tables are never replaced under a DataFrame that still reads them."""
    return f"{layer}_{re.sub(r'[^a-z0-9]+', '_', root.lower().rstrip('/').rsplit('/', 1)[-1])}"


def ensure_schema(spark: SparkSession, layer: str, root: str) -> str:
    name = schema_name(layer, root)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{root}/{layer}.db'")
    return name


def materialize(spark: SparkSession, model: Model, df: DataFrame, root: str) -> DataFrame:
    """K-9: route a model to its schema and materialisation."""
    if model.materialized == "view":
        df.createOrReplaceTempView(f"{schema_name(model.schema, root)}__{model.name}")
        return df
    name = f"{ensure_schema(spark, model.schema, root)}.{model.name}"
    out = df
    if model.cluster_by:
        out = df.repartitionByRange(*model.cluster_by).sortWithinPartitions(*model.cluster_by)
    out.write.mode("overwrite").format("parquet").saveAsTable(name)
    return spark.table(name)


def load_raw(spark: SparkSession, trades: DataFrame, market_meta: DataFrame, root: str) -> dict[str, DataFrame]:
    """K-7 + P-11: pinned columns, facts appended to an emptied table, the
    dimension fully overwritten."""
    raw = ensure_schema(spark, "raw", root)
    sinks.load_table(clean.pin_columns(trades, RAW_TRADES_COLUMNS), f"{raw}.trades", mode="overwrite")
    sinks.load_table(clean.pin_columns(market_meta, RAW_MARKET_META_COLUMNS), f"{raw}.market_meta",
                     mode="overwrite")
    return {"raw.trades": spark.table(f"{raw}.trades"), "raw.market_meta": spark.table(f"{raw}.market_meta")}


def load_market_meta(spark: SparkSession, lake: DataFrame, root: str) -> DataFrame:
    """The metadata load chain: lake snapshots -> latest per coin (C-2) -> pinned columns, epoch
    millis to timestamps -> full overwrite of the raw table; the table read back."""
    latest = clean.latest_by(lake, ["coin_id"], ["ingestion_ts", "offset"], ties="one")
    rows = latest.withColumns({"ingestion_ts": millis_to_ts("ingestion_ts").cast("timestamp_ntz"),
                               "market_cap": F.col("market_cap").cast("decimal(20,0)")})
    name = f"{ensure_schema(spark, 'raw', root)}.market_meta"
    sinks.load_table(clean.pin_columns(rows, RAW_MARKET_META_COLUMNS), name, mode="overwrite")
    return spark.table(name)


def dependency_order(models: Sequence[Model], sources: Iterable[str]) -> list[list[Model]]:
    """The models in generations: those of one need only sources and models of earlier ones.  An unknown
    dependency, a name that is given twice and a cycle are errors that name their models."""
    names = [m.name for m in models]
    twice = sorted({n for n in names if names.count(n) > 1} | (set(names) & set(sources)))
    if twice:
        raise ValueError(f"models given twice: {twice}")
    known = set(names) | set(sources)
    for m in models:
        missing = sorted(set(m.deps) - known)
        if missing:
            raise KeyError(f"model {m.name} needs {missing}")
    done, left, out = set(sources), list(models), []
    while left:
        ready = [m for m in left if set(m.deps) <= done]
        if not ready:
            raise ValueError("models in a cycle: " + ", ".join(_cycle(left)))
        out.append(ready)
        done |= {m.name for m in ready}
        left = [m for m in left if m.name not in done]
    return out


def _cycle(left: Sequence[Model]) -> list[str]:
    """One cycle among models of which each needs another, as a walk that ends where it began."""
    needs = {m.name: m.deps for m in left}
    walk = [left[0].name]
    while walk[-1] not in walk[:-1]:
        walk.append(next(d for d in needs[walk[-1]] if d in needs))
    return walk[walk.index(walk[-1]):]


def build(spark: SparkSession, sources: dict[str, DataFrame], models: Sequence[Model], root: str,
          threads: int = 16) -> dict[str, DataFrame]:
    """Build ``models``, given in any order, each as soon as all it needs is built.

    Independent models are built at once, by at most ``threads`` driver threads (the reference's profile has 16), each
    in a scheduler pool of its own: with ``spark.scheduler.mode=FAIR`` their jobs share the executors evenly.
    The first failure is raised when the models under way have ended; those that need the failed one aren't begun.
    """
    dependency_order(models, sources)
    built: dict[str, DataFrame] = dict(sources)
    for schema in {m.schema for m in models if m.materialized != "view"}:
        ensure_schema(spark, schema, root)

    def one(m: Model, inputs: dict[str, DataFrame]) -> DataFrame:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"model-{m.name}")
        return materialize(spark, m, m.build(inputs), root)

    waiting, running, fault = {m.name: m for m in models}, {}, None
    with ThreadPoolExecutor(max_workers=threads, thread_name_prefix="model") as pool:
        while (waiting and fault is None) or running:
            if fault is None:
                for m in [m for m in waiting.values() if set(m.deps) <= built.keys()]:
                    running[pool.submit(inheritable_thread_target(spark)(one), m, dict(built))] = waiting.pop(m.name)
            for job in wait(running, return_when=FIRST_COMPLETED).done:
                m = running.pop(job)
                if job.exception() is not None:
                    fault = fault or job.exception()
                else:
                    built[m.name] = job.result()
    if fault is not None:
        raise fault
    return {name: built[name] for name in [*sources, *(m.name for m in models)]}


def pipeline_run(spark: SparkSession, trades: DataFrame, market_meta: DataFrame, as_of_date, root: str,
                 suite=quality.REFERENCE_SUITE, on_failure: str = "raise") -> dict[str, DataFrame]:
    """Load the raw tables, build the models, run the data tests.

    The tested models are written once and tested from their files.  Returns the built models, with the
    test results as ``"test_results"``: one row per test, and ``run_status`` (``failed`` if any test failed).
    ``on_failure="raise"``: a failing test ends the run with an error that names it; ``"report"``: the run ends
    marked as failed.
    """
    if on_failure not in ("raise", "report"):
        raise ValueError("on_failure must be 'raise' or 'report'")
    raw = load_raw(spark, trades, market_meta, root)
    tested = {t.model for t in suite}
    models = [replace(m, materialized="table") if m.name in tested else m for m in reference_models(as_of_date)]
    built = build(spark, raw, models, root)
    results = staged(quality.run_suite(built, suite), "test-results")
    if on_failure == "raise":
        quality.assert_suite(results)
    failed = results.filter("status = 'fail'").agg(F.count(F.lit(1))).scalar()
    return {**built, "test_results": results.withColumn("run_status", F.when(failed > 0, "failed").otherwise("passed"))}
