"""Projection, validation and dedupe operators (P-8..P-14, C-1..C-4).

Dedupe by "latest per key" is written either as a hash aggregate (``max`` /
``max_by`` with map-side partial aggregation) or as a ranking window whose
``= 1`` filter Catalyst turns into a partial + final ``WindowGroupLimit``.  Both
reduce a hot key to one row per map task before the shuffle, so a key holding a
third of the rows does not land whole in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.functions.exprs import millis_to_ts, trade_date, trunc_ts

# The key columns of the two dedupe contracts.
TRADE_BUSINESS_KEY = ("symbol", "price", "quantity", "trade_time", "date")
TRADE_EXACT_KEY = ("symbol", "price", "quantity", "trade_time", "is_buyer_maker",
                   "ingestion_ts", "trade_timestamp", "date")
QUOTE_SUFFIXES = ("USDT", "USDC", "USD")


def _order_cols(order: Sequence[str | Column], descending: bool) -> list[Column]:
    out = []
    for o in order:
        c = F.col(o) if isinstance(o, str) else o
        out.append(c.desc_nulls_last() if descending else c.asc_nulls_last())
    return out


# --- P-8 .. P-11 -------------------------------------------------------------

def with_trade_times(df: DataFrame, millis_col: str = "trade_time",
                     ts_col: str = "trade_timestamp", date_col: str = "date") -> DataFrame:
    """Epoch-millis trade time -> ``trade_timestamp`` and ``date`` (P-8, P-9)."""
    return (df.withColumn(ts_col, millis_to_ts(millis_col))
              .withColumn(date_col, trade_date(ts_col)))


def split_valid(df: DataFrame, col: str = "symbol") -> tuple[DataFrame, DataFrame]:
    """``(good, bad)`` by ``col IS NOT NULL`` (P-10)."""
    c = F.col(col)
    return df.filter(c.isNotNull()), df.filter(c.isNull())


def pin_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Fixed column list and order at a table border (P-11)."""
    return df.select(*cols)


# --- C-1 / C-2 / C-3 ---------------------------------------------------------

def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
              ties: str = "keep", rank_col: str = "_rk") -> DataFrame:
    """Rows that are latest per ``keys`` by ``order`` (descending).

    ``ties="keep"``: ``rank() = 1`` (C-1: every row tied on the order survives);
    ``ties="one"``: ``row_number() = 1`` (C-2).  Null keys form their own group.
    Planned as sort + partial ``WindowGroupLimit`` before the exchange, then the
    final limit: the shuffle carries at most (ties of) one row per key per task.
    """
    if ties not in ("keep", "one"):
        raise ValueError("ties must be 'keep' or 'one'")
    w = Window.partitionBy(*keys).orderBy(*_order_cols(order, descending=True))
    fn = F.rank() if ties == "keep" else F.row_number()
    return df.withColumn(rank_col, fn.over(w)).filter(F.col(rank_col) == 1).drop(rank_col)


def _never_null(df: DataFrame, order: str) -> Column:
    """``order`` as a long (times: microseconds) with null as the smallest one, or, for other
    types, as a struct, which is never null and ranks a null inside it lowest."""
    kind, least = df.schema[order].dataType, F.lit(-(1 << 63)).cast("bigint")
    if isinstance(kind, T.TimestampType):
        return F.coalesce(F.unix_micros(order), least)
    if isinstance(kind, T.TimestampNTZType):
        epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        return F.coalesce(F.timestamp_diff("MICROSECOND", epoch, F.col(order)), least)
    if isinstance(kind, T.IntegralType):
        return F.coalesce(F.col(order).cast("bigint"), least)
    return F.struct(order)


def dedupe_trades_latest(df: DataFrame, keys: Sequence[str] = TRADE_BUSINESS_KEY,
                         order: str = "ingestion_ts", method: str = "aggregate") -> DataFrame:
    """Business-key dedupe keeping the latest ingestion (C-3).

    ``method="aggregate"``: ``groupBy(keys)`` with ``max(order)`` and ``max_by`` for
    the other columns -- a hash aggregate with map-side partial aggregation.  When
    more than one other column exists they travel as one struct so all values come
    from the same row.  A null ``order`` is older than any time (``max_by`` alone would
    skip such rows and lose their values).  Among rows tied on ``order`` any one stays,
    whole.  ``method="window"`` is the literal ``row_number() = 1`` form.
    """
    if method == "window":
        return latest_by(df, keys, [order], ties="one")
    rest = [c for c in df.columns if c not in keys and c != order]
    aggs = [F.max(order).alias(order)]
    rank = _never_null(df, order)
    if len(rest) == 1:
        aggs.append(F.max_by(rest[0], rank).alias(rest[0]))
    elif rest:
        aggs.append(F.max_by(F.struct(*rest), rank).alias("_rest"))
    out = df.groupBy(*keys).agg(*aggs)
    if len(rest) > 1:
        out = out.select(*keys, order, "_rest.*")
    return out.select(*df.columns)


def dedupe_exact(df: DataFrame, cols: Sequence[str] = TRADE_EXACT_KEY) -> DataFrame:
    """Whole-row dedupe on ``cols``, any survivor (C-4).  Hash aggregate with
    partial aggregation; use :func:`dedupe_stats` for the before / after counts."""
    return df.dropDuplicates(list(cols))


def dedupe_stats(df: DataFrame, cols: Sequence[str] = TRADE_EXACT_KEY) -> DataFrame:
    """One row ``rows_before, rows_after, duplicates_removed`` from one scan and
    one shuffle: per distinct row its multiplicity (partial-aggregated), then
    ``sum`` of multiplicities = rows before, number of groups = rows after."""
    groups = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_m"))
    return (groups.agg(F.sum("_m").cast("bigint").alias("rows_before"),
                       F.count(F.lit(1)).cast("bigint").alias("rows_after"))
                  .withColumn("rows_before", F.coalesce("rows_before", F.lit(0).cast("bigint")))
                  .withColumn("duplicates_removed", F.col("rows_before") - F.col("rows_after")))


# --- P-13 / P-14 -------------------------------------------------------------

def coin_symbol(symbol: Column, rule: str = "left3") -> Column:
    """Exchange symbol -> coin symbol.  ``left3`` is the reference rule (right only
    for three-letter bases); ``strip_quote`` removes a trailing quote currency."""
    if rule == "left3":
        return F.left(symbol, F.lit(3))
    if rule == "strip_quote":
        pattern = "(" + "|".join(QUOTE_SUFFIXES) + ")$"
        return F.regexp_replace(symbol, pattern, "")
    raise ValueError(f"unknown symbol rule {rule!r}")


def stg_trades(raw: DataFrame, symbol_rule: str = "left3", dedupe: bool = True,
               dedupe_method: str = "aggregate") -> DataFrame:
    """Staging view of trades: C-3 dedupe, then P-13 projection."""
    src = dedupe_trades_latest(raw, method=dedupe_method) if dedupe else raw
    ntz = isinstance(src.schema["trade_time"].dataType, T.TimestampNTZType)
    return src.select(
        coin_symbol(F.col("symbol"), symbol_rule).alias("coin_symbol"),
        F.col("price").cast("double").alias("price"),
        F.col("quantity").cast("double").alias("quantity"),
        F.col("trade_time").alias("trade_timestamp"),
        "is_buyer_maker",
        "ingestion_ts",
        F.col("date").alias("trade_date"),
        trunc_ts("day", "trade_time", ntz=ntz).alias("trade_date_trunc"),
    )


def latest_meta_snapshot(raw_meta: DataFrame, key: str = "coin_id",
                         order: Sequence[str] = ("ingestion_ts",)) -> DataFrame:
    """Latest snapshot per coin (C-2)."""
    return latest_by(raw_meta, [key], list(order), ties="one")


def stg_market_meta(raw_meta: DataFrame) -> DataFrame:
    """Staging view of coin metadata (P-14)."""
    return raw_meta.select(
        "coin_id",
        F.upper("symbol").alias("symbol"),
        "name", "current_price",
        F.col("market_cap").cast("decimal(20,0)").alias("market_cap"),
        "market_cap_rank", "total_volume", "price_change_24h", "price_change_pct_24h",
        "circulating_supply", "ath",
        F.col("ingestion_ts").alias("ingested_at"),
    )
