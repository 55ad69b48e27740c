"""Tumbling-window OHLCV bars (W-1).  The same aggregate runs on a batch
DataFrame (the batch twin) and on a streaming one (with a watermark)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.functions.exprs import safe_ratio

BAR_COLUMNS = ["window_start", "window_end", "symbol", "open_price", "high_price", "low_price",
               "close_price", "volume", "quote_volume", "vwap", "trade_count"]


def ohlcv_bars(df: DataFrame, width: str = "1 minute", ts_col: str = "trade_timestamp",
               key: str = "symbol") -> DataFrame:
    """Open / high / low / close / volume / quote volume / VWAP / count per
    ``window(ts, width)`` and ``key``.  Every aggregate has a partial form, so a hot
    symbol is pre-aggregated per task (and per state-store partition in a stream)."""
    p, q, ts = F.col("price"), F.col("quantity"), F.col(ts_col)
    return (df.groupBy(F.window(ts, width).alias("_w"), F.col(key).alias("symbol"))
              .agg(F.min_by(p, ts).alias("open_price"),
                   F.max(p).alias("high_price"),
                   F.min(p).alias("low_price"),
                   F.max_by(p, ts).alias("close_price"),
                   F.sum(q).alias("volume"),
                   F.sum(p * q).alias("quote_volume"),
                   safe_ratio(F.sum(p * q), F.sum(q), 8).alias("vwap"),
                   F.count(F.lit(1)).alias("trade_count"))
              .select(F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"),
                      *BAR_COLUMNS[2:]))
