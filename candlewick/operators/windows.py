"""Tick-to-tick price changes (F-1).

``lag(price) over (partition by coin order by time)`` sorts each coin's whole history in one task; one coin can hold a
third of all trades, and all of them can fall into one hour.  The default plan is a distributed scan with carry:

1. rows are dealt into ranges of (coin, time, tiebreak, row), sized by the data and written once: a coin takes as many
   ranges as its rows need, whatever its times are;
2. per (coin, range) the last price (one row each);
3. ``lag`` of that over the coin's ranges: the price that a range takes over from the one before;
4. one marker row per (coin, range) that carries it, unioned in front of the trades;
5. ``lag`` within (coin, range); markers dropped.

``method="chunked"`` does the same with time buckets of a fixed width in place of ranges, without a written table: its
largest sort is one coin-bucket.  Same rows as the plain window (a null price is carried as null, like ``lag``)
where times are distinct or ``tiebreak`` orders equal ones; without it, any form may take equal times in any order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.session import staged


def _change_columns(df: DataFrame) -> DataFrame:
    prev, p = F.col("prev_price"), F.col("price")
    return df.select(
        "coin_symbol", "price", "prev_price", "trade_timestamp", "trade_date",
        F.when(prev.isNull() | (prev == 0), None)
         .otherwise(F.round(((p - prev) / prev * 100).cast("decimal(38,12)"), 6).cast("double"))
         .alias("price_change_pct"),
        F.when(prev.isNull(), None).otherwise(p - prev).alias("price_change_abs"),
    )


def _in_ranges(rows: DataFrame, order: Sequence[Column], parts: int | None) -> DataFrame:
    """``rows`` with ``_row`` (makes the order total) and ``_b``, the number of the row's range of (coin, order)."""
    numbered = rows.withColumn("_row", F.monotonically_increasing_id())
    by = [F.col("coin_symbol"), *order, F.col("_row")]
    dealt = numbered.repartitionByRange(parts, *by) if parts else numbered.repartitionByRange(*by)
    return staged(dealt.withColumn("_b", F.spark_partition_id()), "price-ranges")


def price_changes(stg: DataFrame, tiebreak: Sequence[str] | None = None,
                  method: str = "ranges", chunk: str = "hour", parts: int | None = None) -> DataFrame:
    """Tick-to-tick change per coin.  Time order is ascending with null times last
    (the warehouse's order); ``tiebreak`` columns order equal times.  ``parts``: number of ranges (default: the
    session's shuffle partitions, fewer where the data are small)."""
    tb = [F.col(c).asc_nulls_last() for c in (tiebreak or [])]
    coin_col, ts = "coin_symbol", F.col("trade_timestamp")
    if method == "plain":
        w = Window.partitionBy(coin_col).orderBy(ts.asc_nulls_last(), *tb)
        return _change_columns(stg.withColumn("prev_price", F.lag("price").over(w)))
    if method not in ("ranges", "chunked"):
        raise ValueError(f"unknown method {method!r}")

    keep = list(dict.fromkeys(["coin_symbol", "price", "trade_timestamp", "trade_date", *(tiebreak or [])]))
    base = stg.select(*keep)
    if method == "ranges":
        base = _in_ranges(base, [ts.asc_nulls_last(), *tb], parts)
        tb = [*tb, F.col("_row")]
    else:
        base = base.withColumn("_b", F.date_trunc(chunk, ts)).withColumn("_row", F.lit(None).cast("bigint"))
    # nulls last, as in the order above
    last_first = [x for c in ("trade_timestamp", *(tiebreak or [])) for x in (F.col(c).isNull(), F.col(c))]
    last = base.groupBy(coin_col, "_b").agg(F.max_by("price", F.struct(*last_first, F.col("_row"))).alias("_last"))
    wb = Window.partitionBy(coin_col).orderBy(F.col("_b").asc_nulls_last())
    carry = (last.withColumn("_has_prev", F.lag(F.lit(1)).over(wb).isNotNull())
                 .withColumn("price", F.lag("_last").over(wb))
                 .filter("_has_prev"))
    both = base.withColumn("_m", F.lit(1))
    markers = carry.select(*[F.col(c) if c in (coin_col, "price", "_b") else
                             F.lit(0).alias("_m") if c == "_m" else
                             F.lit(None).cast(both.schema[c].dataType).alias(c) for c in both.columns])
    w = Window.partitionBy(coin_col, "_b").orderBy(F.col("_m"), ts.asc_nulls_last(), *tb)
    out = (both.unionByName(markers).withColumn("prev_price", F.lag("price").over(w))
               .filter(F.col("_m") == 1))
    return _change_columns(out)
