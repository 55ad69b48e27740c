"""Aggregations (A-1..A-5): hourly and daily bars, open / close, market total.

All are hash aggregates on built-in functions (``sum``, ``count``, ``max``, ``min``,
``min_by`` / ``max_by`` on fixed-width values), so each map task pre-aggregates its
rows and a hot coin costs one partial row per task in the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.functions.exprs import safe_ratio, trunc_ts



def _p() -> Column:
    return F.col("price")


def _q() -> Column:
    return F.col("quantity")


def _is_ntz(df: DataFrame, col: str) -> bool:
    return isinstance(df.schema[col].dataType, T.TimestampNTZType)


def vwap(digits: int = 8) -> Column:
    """Volume-weighted average price of a group: ``round(sum(p*q)/nullif(sum(q),0), 8)``."""
    return safe_ratio(F.sum(_p() * _q()), F.sum(_q()), digits)


def hourly(stg: DataFrame, ts_col: str = "trade_timestamp") -> DataFrame:
    """Hourly bars per coin (A-1)."""
    hour = trunc_ts("hour", ts_col, ntz=_is_ntz(stg, ts_col))
    return (stg.groupBy(hour.alias("hour_ts"), "coin_symbol")
               .agg(vwap().alias("vwap"),
                    F.sum(_q()).alias("total_volume"),
                    F.sum(_p() * _q()).alias("total_volume_usd"),
                    F.count(F.lit(1)).alias("trade_count"),
                    F.max(_p()).alias("high_price"),
                    F.min(_p()).alias("low_price")))


def daily(enriched: DataFrame) -> DataFrame:
    """Daily aggregate per ``(trade_date, coin_symbol, coin_name, market_cap_rank)``
    over enriched trades (A-2, literal form).  Null name / rank form their own group."""
    return (enriched.groupBy("trade_date", "coin_symbol", "coin_name", "market_cap_rank")
                    .agg(F.sum(_q()).alias("total_volume"),
                         F.sum("trade_value_usd").alias("total_volume_usd"),
                         vwap().alias("vwap"),
                         F.max(_p()).alias("high_price"),
                         F.min(_p()).alias("low_price"),
                         F.count(F.lit(1)).alias("trade_count")))


def _whole(df: DataFrame, col: str) -> Column | None:
    """``col`` as a 64-bit whole number in the same order; None for types that have no such number."""
    t, c = df.schema[col].dataType, F.col(col)
    if isinstance(t, T.TimestampType):
        return F.unix_micros(c)
    if isinstance(t, T.TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), c)
    if isinstance(t, T.DateType):
        return F.unix_date(c).cast("bigint")
    return c.cast("bigint") if isinstance(t, (T.IntegralType, T.BooleanType)) else None


def _time_order(df: DataFrame, ts_col: str, tiebreak: Sequence[str] | None) -> Column:
    """The order of ``min_by`` / ``max_by``: time, then ``tiebreak`` (its nulls first); null where the time is null.

    A time and one tiebreak of a whole-number type (time, date, integer, boolean) become one decimal, time * 2^65 +
    tiebreak + 2^63 + 1 (a null tiebreak: 0).  It has a fixed width, so the aggregate stays a hash aggregate; with a
    struct, for other tiebreaks, Spark sorts.
    """
    if not tiebreak:
        return F.col(ts_col)
    keys = [_whole(df, ts_col), _whole(df, tiebreak[0])] if len(tiebreak) == 1 else [None]
    if all(k is not None for k in keys):
        time, tie = (k.cast("decimal(20,0)") for k in keys)
        return time * F.lit(Decimal(2 ** 65)) + F.coalesce(tie + F.lit(Decimal(2 ** 63 + 1)), F.lit(Decimal(0)))
    return F.when(F.col(ts_col).isNotNull(), F.struct(F.col(ts_col), *[F.col(c) for c in tiebreak]))


def open_close(df: DataFrame, keys: Sequence[str] = ("trade_date", "coin_symbol"),
               ts_col: str = "trade_timestamp", tiebreak: Sequence[str] | None = None) -> DataFrame:
    """First and last price per group by trade time (A-3 / F-2 / C-6).

    ``min_by`` / ``max_by`` replace ``first_value`` windows + ``QUALIFY``: one hash
    aggregate instead of two sorts and a join.  Rows with a null time are skipped.
    A ``tiebreak`` orders equal times, see :func:`_time_order`.
    """
    order = _time_order(df, ts_col, tiebreak)
    return (df.filter(F.col(ts_col).isNotNull())
              .groupBy(*keys)
              .agg(F.min_by(_p(), order).alias("open_price"),
                   F.max_by(_p(), order).alias("close_price")))


def day_change_pct(open_col="open_price", close_col="close_price") -> Column:
    return safe_ratio(F.col(close_col) - F.col(open_col), open_col, 4, scale=100.0)


def daily_trade_stats(stg: DataFrame, ts_col: str = "trade_timestamp",
                      tiebreak: Sequence[str] | None = None) -> DataFrame:
    """Per ``(trade_date, coin_symbol)``: sums, count, high / low, open / close in
    ONE hash aggregate over staged trades -- the pre-aggregation that lets the
    daily mart join metadata after the data has shrunk to one row per coin-day."""
    order = _time_order(stg, ts_col, tiebreak)
    return (stg.groupBy("trade_date", "coin_symbol")
               .agg(F.sum(_q()).alias("_sum_q"),
                    F.sum(_p() * _q()).alias("_sum_pq"),
                    F.count(F.lit(1)).alias("_n_trades"),
                    F.max(_p()).alias("high_price"),
                    F.min(_p()).alias("low_price"),
                    F.min_by(_p(), order).alias("open_price"),
                    F.max_by(_p(), order).alias("close_price")))


def total_market_cap(meta: DataFrame, cap_col: str = "market_cap") -> DataFrame:
    """One-row global sum of positive market caps (A-4, P-17)."""
    c = F.col(cap_col)
    return (meta.filter(c > 0)
                .agg(F.sum(c).cast("decimal(38,0)").alias("total_market_cap")))
