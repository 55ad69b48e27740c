"""Latency metrics (A-6, A-7, T-4, M-1..M-4).

Percentiles are exact and follow the reference's rule: p50 is the median (mean
of the two middle values for even n), p95 / p99 are the sorted value at zero-based
index ``min(floor(n * p), n - 1)``; an empty input gives nulls (N/A).  They are
computed from per-value counts (a partial hash aggregate) and running sums over
distinct values, per (group, value range) -- so no raw rows are gathered in one
task, a hot group is spread over its value ranges, and nothing is collected to
the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from candlewick.functions.exprs import epoch_millis
from candlewick.session import staged

SUMMARY_COLUMNS = ["n", "p50", "p95", "p99"]
#: Value ranges per group that are summed in parallel.
RANGES = 256


def row_stats(df: DataFrame, name: str = "rows") -> tuple[DataFrame, Observation]:
    """A-6 without a second pass: attach an ``Observation`` counting rows; read
    ``obs.get`` after the DataFrame's action has run."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def _at(idx: Column) -> Column:
    return F.min(F.when((F.col("_lo") <= idx) & (idx <= F.col("_hi")), F.col("_v")))


def _null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    r = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys],
                     *[c for c in right.columns if c not in keys])
    cond = [left[k].eqNullSafe(r[f"_r_{k}"]) for k in keys]
    return left.join(r, cond, how).drop(*[f"_r_{k}" for k in keys])


def _bucket_of(edges, v: str = "_v"):
    """Index of the value range holding ``v``: the number of distinct edges below
    it (plain array expressions, no lambda, so a scalar subquery may feed it)."""
    pos = F.array_position(F.sort_array(F.array_union(edges, F.array(F.col(v)))), F.col(v))
    return F.coalesce(pos - 1, F.lit(0))


def _ranked_values(counts: DataFrame, g: list[str], buckets: int) -> DataFrame:
    """Per distinct value: its first / last zero-based index ``_lo`` / ``_hi`` in
    the sorted multiset of its group, and the group size ``_n``.

    Each group's distinct values are cut into ``buckets`` contiguous value ranges
    at approximate-quantile edges (a scalar subquery without groups, one row of
    edges per group otherwise).  Running sums run per (group, range) in parallel
    and are offset by the totals of the lower ranges of the same group (at most
    ``buckets`` rows per group).  So no step sorts more than one range of one
    group in one task, however hot the group.
    """
    if buckets <= 1:
        # Plain running sums per group: for inputs bounded by construction
        # (e.g. the newest n records per group).
        w = Window.partitionBy(*g).orderBy("_v")
        return (counts.withColumn("_hi", F.sum("_c").over(w) - 1)
                      .withColumn("_lo", F.col("_hi") - F.col("_c") + 1)
                      .withColumn("_n", F.sum("_c").over(Window.partitionBy(*g))))
    fracs = [i / buckets for i in range(1, buckets)]
    pct = F.percentile_approx("_v", fracs)
    if g:
        edges = counts.groupBy(*g).agg(pct.alias("_edges"))
        cb = (_null_safe_join(counts, edges, g)
              .withColumn("_b", _bucket_of(F.col("_edges"))).drop("_edges"))
    else:
        cb = counts.withColumn("_b", _bucket_of(counts.agg(pct).scalar()))
    totals = cb.groupBy(*g, "_b").agg(F.sum("_c").alias("_bc"))        # <= buckets rows per group
    wb = Window.partitionBy(*g).orderBy("_b")
    offsets = (totals.withColumn("_off", F.coalesce(F.sum("_bc").over(wb.rowsBetween(Window.unboundedPreceding, -1)),
                                                     F.lit(0)))
                     .withColumn("_n", F.sum("_bc").over(Window.partitionBy(*g))).drop("_bc"))
    w = Window.partitionBy(*g, "_b").orderBy("_v")
    # Without groups the offsets table has at most ``buckets`` rows by construction.
    offsets = offsets if g else F.broadcast(offsets)
    return (_null_safe_join(cb, offsets, g + ["_b"])
            .withColumn("_hi", F.col("_off") + F.sum("_c").over(w) - 1)
            .withColumn("_lo", F.col("_hi") - F.col("_c") + 1))


def latency_summary(df: DataFrame, value_col: str, group: Sequence[str] | None = None) -> DataFrame:
    """A-7: ``[group..., n, p50, p95, p99]`` over non-null ``value_col``."""
    return _summary(df, value_col, list(group or []), RANGES)


def _summary(df: DataFrame, value_col: str, g: list[str], buckets: int) -> DataFrame:
    """``buckets`` 1 is for inputs of a bounded number of rows per group only."""
    counts = (df.filter(F.col(value_col).isNotNull())
                .groupBy(*g, F.col(value_col).alias("_v")).agg(F.count(F.lit(1)).alias("_c")))
    if buckets > 1:  # the edges and the ranges both read the counts
        counts = staged(counts, "value-counts")
    ranked = _ranked_values(counts, g, buckets)
    n = F.first("_n")
    i95 = F.least(F.floor(F.col("_n") * F.lit(0.95)), F.col("_n") - 1)
    i99 = F.least(F.floor(F.col("_n") * F.lit(0.99)), F.col("_n") - 1)
    mid_lo = F.floor((F.col("_n") - 1) / 2)
    mid_hi = F.floor(F.col("_n") / 2)
    out = ranked.groupBy(*g).agg(
        n.cast("bigint").alias("n"),
        ((_at(mid_lo) + _at(mid_hi)) / 2).cast("double").alias("p50"),
        _at(i95).cast("double").alias("p95"),
        _at(i99).cast("double").alias("p99"))
    if g:
        return out
    # Global summary: always one row, nulls when the input is empty.
    empty = df.sparkSession.range(1).select(F.lit(0).cast("bigint").alias("n"),
                                            *[F.lit(None).cast("double").alias(c) for c in ("p50", "p95", "p99")])
    return out.unionByName(empty).agg(F.max("n").alias("n"), F.max("p50").alias("p50"),
                                      F.max("p95").alias("p95"), F.max("p99").alias("p99"))


def last_n(df: DataFrame, order: Sequence[str], n: int, per: Sequence[str] | None = None) -> DataFrame:
    """T-4: newest ``n`` rows by ``order`` (descending), overall or per group.

    Overall: sort + limit (each task keeps its top n).  Per group:
    ``row_number() <= n`` (partial ``WindowGroupLimit`` before the shuffle)."""
    o = [F.col(c).desc_nulls_last() for c in order]
    if not per:
        return df.orderBy(*o).limit(n)
    w = Window.partitionBy(*per).orderBy(*o)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def ingest_latency(log: DataFrame, n: int = 100, per: Sequence[str] = ("partition",),
                   order: str = "offset", trade_time: str = "trade_time",
                   ingestion_ts: str = "ingestion_ts") -> DataFrame:
    """M-1: per log partition, the newest ``n`` records; latency
    ``ingestion_ts - trade_time`` (ms) of those with both times non-zero; A-7."""
    recent = last_n(log, [order], n, per)
    tt, it = F.col(trade_time), F.col(ingestion_ts)
    ok = tt.isNotNull() & it.isNotNull() & (tt != 0) & (it != 0)
    lat = recent.filter(ok).select(*per, (it - tt).alias("latency_ms"))
    return _summary(lat, "latency_ms", list(per), buckets=1)   # <= n rows per group


def commit_gaps(times: DataFrame, time_col: str = "modificationTime",
                group: Sequence[str] | None = None) -> DataFrame:
    """M-2: per group, ``n_commits``, first / last time, ``span_ms`` (newest minus
    oldest) and ``last_gap_ms`` (newest minus the one before; 0 when the two
    newest are equal, null with a single commit).  One aggregate pass after the
    newest time per group is known (a scalar subquery, or a join on the group)."""
    g = list(group or [])
    t = F.col(time_col).cast("timestamp_ntz")
    rows = times.filter(F.col(time_col).isNotNull()).select(*g, t.alias("_t"))
    newest = rows.groupBy(*g).agg(F.max("_t").alias("_t1"))
    if g:
        rows = _null_safe_join(rows, newest, g)
    else:
        rows = rows.withColumn("_t1", newest.select("_t1").scalar())
    at_newest = F.col("_t") == F.col("_t1")
    agg = rows.groupBy(*g).agg(
        F.count(F.lit(1)).cast("bigint").alias("n_commits"),
        F.min("_t").alias("first_commit"), F.max("_t").alias("last_commit"),
        F.sum(at_newest.cast("bigint")).alias("_k1"),
        F.max(F.when(~at_newest, F.col("_t"))).alias("_t2"))
    ms = epoch_millis
    return agg.select(
        *g, "n_commits", "first_commit", "last_commit",
        (ms(F.col("last_commit")) - ms(F.col("first_commit"))).alias("span_ms"),
        F.when(F.col("_k1") >= 2, F.lit(0).cast("bigint"))
         .when(F.col("_t2").isNotNull(), ms(F.col("last_commit")) - ms(F.col("_t2"))).alias("last_gap_ms"))


def file_times(spark, path: str) -> DataFrame:
    """Modification times of the files under ``path`` (file contents are not read)."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
                 .select("path", "modificationTime", "length"))


def history_latency(history: DataFrame, predicate: Column, n: int, now,
                    lookback: str = "1 day") -> DataFrame:
    """M-3: successful jobs matching ``predicate`` that started within ``lookback``
    of ``now``; the newest ``n`` by start time; their durations (ms) -> A-7."""
    now_c = now if isinstance(now, Column) else F.lit(now).cast("timestamp_ntz")
    st, et = F.col("start_time"), F.col("end_time")
    sel = history.filter(predicate & (F.col("execution_status") == "SUCCESS")
                         & (st >= now_c - F.expr(f"INTERVAL {lookback}")))
    recent = last_n(sel, ["start_time"], n)
    dur = recent.select((epoch_millis(et) - epoch_millis(st)).alias("duration_ms"))
    return _summary(dur.filter(F.col("duration_ms").isNotNull()), "duration_ms", [], buckets=1)  # <= n rows


def report(rows: Sequence[tuple[str, DataFrame, str]]) -> DataFrame:
    """M-4: one table ``stage, p50, p95, p99, notes`` from one-row summaries."""
    out = None
    for stage, summary, notes in rows:
        r = summary.select(F.lit(stage).alias("stage"), "p50", "p95", "p99", F.lit(notes).alias("notes"))
        out = r if out is None else out.unionByName(r)
    return out
