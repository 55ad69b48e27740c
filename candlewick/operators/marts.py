"""Marts: daily OHLCV per coin, top movers, market overview (A-2 + A-3 + J-2,
J-3, J-4, J-5, F-5, T-1..T-3)."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.functions.exprs import safe_ratio
from candlewick.operators.agg import daily_trade_stats, day_change_pct, total_market_cap
from candlewick.operators.enrich import meta_for_join
from candlewick.operators.ranking import rank_both_ends
from candlewick.session import staged

OHLCV_COLUMNS = ["trade_date", "coin_symbol", "coin_name", "market_cap_rank", "total_volume",
                 "total_volume_usd", "vwap", "high_price", "low_price", "trade_count",
                 "open_price", "close_price", "day_change_pct"]


def _date(d) -> _dt.date:
    return d if isinstance(d, _dt.date) else _dt.date.fromisoformat(str(d))


def _meta_groups(meta: DataFrame, on_collision: str) -> DataFrame:
    """Metadata reduced to the columns the daily mart groups by, with the number
    of metadata rows behind each group (the reference's fan-out multiplicity)."""
    m = meta_for_join(meta, on_collision).filter(F.col("_msym").isNotNull())
    return (m.groupBy("_msym", F.col("name").alias("coin_name"), "market_cap_rank")
             .agg(F.count(F.lit(1)).alias("_mult")))


def coin_daily_ohlcv(stg: DataFrame, meta: DataFrame, with_open_close: bool = True,
                     on_collision: str = "fanout", tiebreak: Sequence[str] | None = None) -> DataFrame:
    """Daily OHLCV per coin (flagship).

    Same rows as "enrich every trade, group by (date, coin, name, rank), join the
    open / close CTE", planned as: one hash aggregate of trades per (date, coin)
    (partial aggregation map-side), then a join of that small result with the
    metadata groups.  A symbol owned by ``m`` identical (name, rank) metadata rows
    scales sums and counts by ``m``, exactly as the fan-out join would.  Groups with
    a null date or coin are dropped, as the inner join on them does.
    """
    d = daily_trade_stats(stg, tiebreak=tiebreak)
    if with_open_close:
        d = d.filter(F.col("trade_date").isNotNull() & F.col("coin_symbol").isNotNull())
    g = _meta_groups(meta, on_collision)
    j = d.join(g, F.upper(d["coin_symbol"]) == g["_msym"], "left")
    mult = F.coalesce(F.col("_mult"), F.lit(1))
    out = j.select(
        "trade_date", "coin_symbol", "coin_name", "market_cap_rank",
        (F.col("_sum_q") * mult).alias("total_volume"),
        (F.col("_sum_pq") * mult).alias("total_volume_usd"),
        safe_ratio("_sum_pq", "_sum_q", 8).alias("vwap"),
        "high_price", "low_price",
        (F.col("_n_trades") * mult).alias("trade_count"),
        "open_price", "close_price",
    )
    if not with_open_close:
        return out.drop("open_price", "close_price")
    return out.withColumn("day_change_pct", day_change_pct())


def daily_aggregates(stg: DataFrame, meta: DataFrame, **kw) -> DataFrame:
    """The daily CTE alone (A-2): groups keep a null date / coin."""
    return coin_daily_ohlcv(stg, meta, with_open_close=False, **kw)


def top_movers(ohlcv: DataFrame, as_of_date, k: int = 20, rank_by: str = "day_change_pct",
               method: str = "distributed") -> DataFrame:
    """Today's coins vs yesterday's VWAP, ranked both ways by ``rank_by``; rows of
    rank <= k at either end (ties kept), ordered by day change descending."""
    day = _date(as_of_date)
    yesterday = (ohlcv.filter(F.col("trade_date") == F.lit(day - _dt.timedelta(days=1)))
                      .select("coin_symbol", F.col("vwap").alias("yesterday_vwap")))
    today = (ohlcv.filter(F.col("trade_date") == F.lit(day))
                  .select("coin_symbol", "coin_name", F.col("vwap").alias("today_vwap"),
                          "total_volume", "total_volume_usd", "trade_count", "market_cap_rank",
                          "day_change_pct"))
    j = today.join(yesterday, "coin_symbol", "left").select(
        "coin_symbol", "coin_name", "today_vwap", "yesterday_vwap", "total_volume",
        "total_volume_usd", "trade_count", "market_cap_rank", "day_change_pct",
        safe_ratio(F.col("today_vwap") - F.col("yesterday_vwap"), "yesterday_vwap", 4,
                   scale=100.0).alias("change_24h_pct"))
    if method == "distributed":  # ranked from four sides: read the joined day, don't redo it
        j = staged(j, "movers-day")
    ranked = rank_both_ends(j, rank_by, k, "gainer_rank", "loser_rank", method=method)
    return ranked.orderBy(F.col("day_change_pct").desc_nulls_first())


def market_overview(ohlcv: DataFrame, meta: DataFrame, as_of_date) -> DataFrame:
    """Today's coins with metadata, market dominance and distance from the
    all-time high.  The market total is a scalar subquery (no cross join)."""
    day = _date(as_of_date)
    total = total_market_cap(meta).scalar()
    o = ohlcv.filter(F.col("trade_date") == F.lit(day))
    m = meta.select(F.upper("symbol").alias("_msym"), "market_cap", "circulating_supply", "ath")
    j = o.join(m, F.upper(o["coin_symbol"]) == m["_msym"], "inner")
    dominance = safe_ratio(F.col("market_cap").cast("double"), total.cast("double"), 4, 100.0)
    return (j.select(
                "trade_date", "coin_symbol", "coin_name", "market_cap_rank",
                F.col("close_price").alias("current_price"), "market_cap",
                F.col("total_volume_usd").alias("volume_24h_usd"),
                F.col("day_change_pct").alias("price_change_24h_pct"),
                "circulating_supply", dominance.alias("market_dominance_pct"), "ath",
                safe_ratio(F.col("close_price") - F.col("ath"), "ath", 2, 100.0).alias("pct_from_ath"),
                total.alias("total_market_cap"))
             .orderBy(F.col("market_cap_rank").asc_nulls_last()))
