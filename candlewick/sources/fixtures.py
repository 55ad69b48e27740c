"""Adapters from the generated test tables to the reference's input shapes.

``/root/testdata`` holds TPC-H-like tables plus an ``events`` table; these functions
derive trade / metadata inputs from them with plain DataFrame expressions (all the
work stays distributed and grows with the tables).  The same derivations are written
as SQL in :mod:`candlewick.plans.oracle` for the DuckDB oracle.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.functions.exprs import epoch_millis

# Fixed values of the fixture mapping.
AS_OF_DATE = _dt.date(2024, 1, 30)          # last event day
META_SNAPSHOT_TS = "2024-01-30 00:00:00"   # ingestion time of the metadata snapshot
ATH = 509.0                                 # all-time high used for every coin
META_SNAPSHOT_MS = 1706572800000            # the snapshot time as epoch millis
META_RUN1_CUTOFF = "1998-01-01 00:00:00"   # log content seen by the first ingestion run
HISTORY_NOW = "2001-08-01 12:00:00"         # "now" for the job-history metrics
FRESHNESS_NOW = "2024-01-31 12:00:00"       # "now" for source freshness
END_MARKER_SYMBOL = "~END"                   # end-of-input record of staged streams


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def padded(key: str) -> Column:
    """A key's digits, at least three of them."""
    digits = F.col(key).cast("string")
    return F.when(F.length(digits) >= 3, digits).otherwise(F.lpad(digits, 3, "0"))


def _trade_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``RAW.TRADES`` shape from ``events`` (keeps ``event_id``), plus re-ingested
    copies of every tenth event (one hour later) so business-key dedupe has work."""
    copies = F.sequence(F.lit(0), (F.col("event_id") % 10 == 0).cast("int"))
    ev = read(spark, sf_dir, "events").withColumn("copy", F.explode(copies))
    return ev.select(
        F.concat(padded("user_id"), F.lit("USD")).alias("symbol"),
        (F.floor(F.col("value") * 64).cast("double") / 64).alias("price"),
        F.get_json_object("props", "$.k").cast("double").alias("quantity"),
        F.col("ts").alias("trade_time"),
        F.col("event_type").isin("purchase", "error").alias("is_buyer_maker"),
        (F.col("ts") + F.expr("make_dt_interval(0, copy, 0, 5)")).alias("ingestion_ts"),
        F.to_date("ts").alias("date"),
        "event_id", "copy")


def raw_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``RAW.TRADES`` shape: symbol, price, quantity, trade_time, is_buyer_maker,
    ingestion_ts (TIMESTAMP_NTZ), date."""
    return _trade_rows(spark, sf_dir).drop("event_id", "copy")


def lake_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lake ``trades`` shape (wire columns with epoch millis + ``trade_timestamp``,
    ``date``), including exact re-deliveries of every seventh event, as an
    at-least-once log produces."""
    again = F.sequence(F.lit(0), (F.col("event_id") % 7 == 0).cast("int"))
    rows = _trade_rows(spark, sf_dir).withColumn("delivery", F.explode(again))
    return rows.select(
        "symbol", "price", "quantity",
        epoch_millis("trade_time").alias("trade_time"),
        "is_buyer_maker",
        epoch_millis("ingestion_ts").alias("ingestion_ts"),
        F.col("trade_time").cast("timestamp").alias("trade_timestamp"),
        "date")


def trade_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wire shape (times as epoch millis) of the same trades, with their log position ``offset`` and
    record time ``timestamp``."""
    t = _trade_rows(spark, sf_dir)
    return t.select("symbol", "price", "quantity",
                    epoch_millis("trade_time").alias("trade_time"), "is_buyer_maker",
                    epoch_millis("ingestion_ts").alias("ingestion_ts"),
                    (F.col("event_id") * 8 + F.col("copy")).alias("offset"),
                    F.col("ingestion_ts").alias("timestamp"))


def trades_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw trades with null and tied ingestion times: the later copy of an event comes without a time
    (every 20th event), as an equal row (every 30th), or is the only one and has none (event_id % 10 = 3)."""
    t = _trade_rows(spark, sf_dir)
    none = ((F.col("event_id") % 20 == 0) & (F.col("copy") == 1)) | (F.col("event_id") % 10 == 3)
    tied = (F.col("event_id") % 30 == 0) & (F.col("copy") == 1)
    return (t.withColumn("ingestion_ts", F.when(none, None).when(
        tied, F.col("ingestion_ts") - F.expr("INTERVAL 1 HOUR")).otherwise(F.col("ingestion_ts")))
        .drop("event_id", "copy"))


def market_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``RAW.MARKET_META`` shape from ``customer``, a coin for each key.  Multiples of 15 have a symbol that no
    trade has, which leaves trade coins without metadata."""
    c = read(spark, sf_dir, "customer")
    odd = (F.col("c_custkey") % 2) == 1
    half = F.when(~odd, F.col("c_acctbal") / 100)
    return c.select(
        F.concat(F.lit("coin-"), F.col("c_custkey").cast("string")).alias("coin_id"),
        F.concat(F.when(F.col("c_custkey") % 15 == 0, "~").otherwise(""), padded("c_custkey")).alias("symbol"),
        F.col("c_name").alias("name"),
        (F.lit(10.0) + F.col("c_custkey")).alias("current_price"),
        (F.round(F.col("c_acctbal") * 100).cast("bigint") * F.lit(1000003)).cast("decimal(20,0)").alias("market_cap"),
        (F.col("c_custkey") + 1).alias("market_cap_rank"),
        F.col("c_acctbal").alias("total_volume"),
        half.alias("price_change_24h"),
        half.alias("price_change_pct_24h"),
        half.alias("circulating_supply"),
        F.lit(ATH).alias("ath"),
        F.lit(META_SNAPSHOT_TS).cast("timestamp_ntz").alias("ingestion_ts"),
    )


def meta_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coin metadata records from ``orders`` (many snapshots per coin), in the
    payload shape (``ingestion_ts`` epoch millis), plus log position ``offset`` and
    record time ``timestamp``."""
    o = read(spark, sf_dir, "orders")
    odd = (F.col("o_orderkey") % 2) == 1
    return o.select(
        F.col("o_orderkey").alias("offset"),
        F.col("o_orderdate").alias("timestamp"),
        F.concat(F.lit("coin-"), F.col("o_custkey").cast("string")).alias("coin_id"),
        F.concat(F.lit("s"), F.col("o_custkey").cast("string")).alias("symbol"),
        F.concat(F.lit("Coin "), F.col("o_custkey").cast("string")).alias("name"),
        F.col("o_totalprice").alias("current_price"),
        F.round(F.col("o_totalprice") * 100).cast("bigint").alias("market_cap"),
        F.col("o_custkey").alias("market_cap_rank"),
        (F.col("o_totalprice") / 4).alias("total_volume"),
        F.when(~odd, F.col("o_totalprice") / 1000).alias("price_change_24h"),
        F.when(~odd, F.col("o_totalprice") / 2000).alias("price_change_pct_24h"),
        F.when(~odd, F.col("o_totalprice") * 3).alias("circulating_supply"),
        F.lit(ATH).alias("ath"),
        epoch_millis("o_orderdate").alias("ingestion_ts"),
        F.col("o_orderstatus"),
    )


def meta_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyed JSON log of the metadata records (``key, value, offset, timestamp``).

    Orders with status ``'P'`` carry a damaged payload (the JSON text is cut in the
    middle), which the decoder must turn into an all-null record, not an error.
    """
    r = meta_records(spark, sf_dir)
    payload = F.to_json(F.struct(*[F.col(c) for c in [
        "coin_id", "symbol", "name", "current_price", "market_cap", "market_cap_rank",
        "total_volume", "price_change_24h", "price_change_pct_24h", "circulating_supply",
        "ath", "ingestion_ts"]]))
    damaged = F.col("o_orderstatus") == "P"
    text = F.when(damaged, F.substring(payload, 1, 20)).otherwise(payload)
    return r.select(
        F.col("symbol").cast("binary").alias("key"),
        text.cast("binary").alias("value"),
        "offset", "timestamp",
    )


def raw_meta_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lake's metadata as ingestion lands it: payload columns (``ingestion_ts`` epoch millis) plus
    ``offset``, many snapshots per coin."""
    return meta_records(spark, sf_dir).drop("timestamp", "o_orderstatus")


def trade_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trade topic as log rows: a framed ``value`` per trade (5-byte header, JSON body), plus damaged
    frames for the dead-letter path: for events with ``event_id % 50`` = 1 / 2 / 3 a frame cut to 4
    bytes, a frame with a wrong magic byte, and a frame cut inside the body."""
    from candlewick.operators.decode import to_log_rows

    log = to_log_rows(trade_records(spark, sf_dir), "symbol", framed=True, keep=["offset", "timestamp"])
    kind, v = (F.floor(F.col("offset") / 8) % 50).cast("int"), F.col("value")
    damaged = F.struct(
        (F.col("offset") + 1 + kind).alias("offset"),
        F.when(kind == 1, F.substring(v, 1, 4))
         .when(kind == 2, F.concat(F.lit(bytes([1])), F.substring(v, F.lit(2), F.length(v) - 1)))
         .otherwise(F.substring(v, 1, 9)).alias("value"))
    whole = F.struct("offset", "value")
    sent = F.when((F.col("offset") % 8 == 0) & kind.between(1, 3), F.array(whole, damaged)).otherwise(F.array(whole))
    return (log.select("key", "timestamp", F.explode(sent).alias("sent"))
            .select("sent.offset", "timestamp", "key", "sent.value"))


def exchange_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exchange JSON messages: one per (symbol, minute, side, 64 event ids),
    so a message holds at most 64 trades.  Minutes ending in 9 arrive on a ``status`` channel, and a zero
    size is sent as an empty string (unparsable)."""
    t = _trade_rows(spark, sf_dir).filter(F.col("copy") == 0)
    minute = F.date_trunc("minute", F.col("trade_time")).cast("timestamp_ntz")
    trade = F.struct(
        F.concat(F.left("symbol", F.lit(3)), F.lit("-USD")).alias("product_id"),
        F.col("price").cast("string").alias("price"),
        F.when(F.col("quantity") == 0, F.lit("")).otherwise(F.col("quantity").cast("string")).alias("size"),
        F.when(F.col("is_buyer_maker"), F.lit("SELL")).otherwise(F.lit("BUY")).alias("side"))
    msgs = t.groupBy("symbol", minute.alias("minute"), "is_buyer_maker", F.floor(F.col("event_id") / 64)).agg(
        F.array(F.struct(F.collect_list(trade).alias("trades"))).alias("events"))
    channel = F.when(F.minute("minute") % 10 == 9, F.lit("status")).otherwise(F.lit("market_trades"))
    return msgs.select(
        F.col("symbol").cast("binary").alias("key"),
        F.to_json(F.struct(channel.alias("channel"), "events")).cast("binary").alias("value"),
        epoch_millis("minute").alias("msg_time"))


def coin_rest_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coin records as the REST endpoint returns them (JSON text, missing numbers
    omitted), one per customer."""
    c = read(spark, sf_dir, "customer")
    k, bal = F.col("c_custkey"), F.col("c_acctbal")
    rec = F.struct(
        F.concat(F.lit("coin-"), k.cast("string")).alias("id"),
        F.concat(F.lit("c"), k.cast("string")).alias("symbol"),
        F.col("c_name").alias("name"),
        F.when(k % 7 != 0, bal).alias("current_price"),
        F.when(k % 11 != 0, F.floor(bal * 1000)).alias("market_cap"),
        F.when(k % 13 != 0, k + 1).alias("market_cap_rank"),
        F.when(k % 5 != 0, bal * 3).alias("total_volume"),
        F.when(k % 2 == 0, bal / 100).alias("price_change_24h"),
        F.when(k % 3 == 0, bal / 1000).alias("price_change_percentage_24h"),
        F.when(k % 4 != 0, bal * 10).alias("circulating_supply"),
        F.when(k % 9 != 0, bal * 2).alias("ath"))
    return c.select(F.to_json(rec).alias("json"))


def job_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Warehouse job-history rows from ``orders``: one job per order, started on
    its order date (plus ``o_orderkey % 86400`` seconds), running
    ``o_totalprice % 100000`` ms."""
    o = read(spark, sf_dir, "orders")
    start = F.timestamp_add("SECOND", F.col("o_orderkey") % 86400, F.col("o_orderdate"))
    dur = F.floor(F.col("o_totalprice")).cast("bigint") % 100000
    return o.select(
        F.col("o_orderkey").alias("query_id"),
        start.alias("start_time"),
        F.timestamp_add("MILLISECOND", dur, start).alias("end_time"),
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "COPY").otherwise("SELECT").alias("query_type"),
        F.when(F.col("o_orderstatus") == "O", "dbt_run").otherwise("adhoc").alias("query_tag"),
        F.lit("ANALYTICS").alias("database_name"),
        F.when(F.col("o_orderkey") % 9 == 0, "FAILED").otherwise("SUCCESS").alias("execution_status"))
