"""Decoding of log records and producer-side record shaping (P-1..P-7, K-5).

Everything is column expressions: JSON goes through ``from_json``, frame headers through binary
``substring``; Avro bodies go through ``from_avro`` / ``to_avro`` when that package is on the classpath.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.avro import functions as avro

from candlewick.functions.exprs import frame_fault, strip_frame
from candlewick.schemas import EXCHANGE_MESSAGE, MARKET_META, avro_schema_to_struct


def decode_market_meta(log: DataFrame, schema: T.StructType = MARKET_META,
                       value_col: str = "value") -> DataFrame:
    """JSON log value -> payload columns, keeping ``offset`` and the record time as
    ``kafka_ts`` (P-4).  A malformed value gives an all-null record (permissive);
    ``nullable=False`` in the schema is not enforced, so filter downstream."""
    return (log.select("offset", F.col("timestamp").alias("kafka_ts"),
                       F.from_json(F.col(value_col).cast("string"), schema,
                                   {"mode": "PERMISSIVE"}).alias("data"))
               .select("offset", "kafka_ts", "data.*"))


def flatten_market_trades(messages: DataFrame, value_col: str = "value",
                          channel: str = "market_trades") -> DataFrame:
    """Exchange JSON message -> one row per ``events[].trades[]`` element, only for
    ``channel`` (P-5).  Missing arrays yield no rows."""
    parsed = messages.select("*", F.from_json(F.col(value_col).cast("string"),
                                              EXCHANGE_MESSAGE).alias("_msg"))
    return (parsed.filter(F.col("_msg.channel") == channel)
                  .select("*", F.posexplode("_msg.events").alias("_ev_pos", "_ev"))
                  .select("*", F.posexplode("_ev.trades").alias("_t_pos", "_t"))
                  .drop("_msg", "_ev"))


# --- framed records (P-1..P-3, K-5) ----------------------------------------------

def decode_frames(df: DataFrame, schema_json: str, value_col: str = "value",
                  keep: list[str] | None = None, mode: str = "permissive",
                  error_col: str = "_error", body: str = "json") -> DataFrame:
    """Framed ``value`` (5-byte header, then the body) -> record columns (P-1..P-3).

    The header is checked and stripped by column expressions.  ``body``: ``json`` is parsed by
    ``from_json``; ``avro`` by ``from_avro``, for which Spark asks for its Avro package.  ``permissive``: an
    undecodable frame gives null fields and its cause in ``error_col`` (``too_short`` / ``bad_magic`` /
    ``parse_failure``); the raw bytes stay in ``value_col`` for the dead-letter sink.  ``failfast``: the
    job fails on a bad frame (the reference's default).
    """
    if mode not in ("permissive", "failfast"):
        raise ValueError("mode must be 'permissive' or 'failfast'")
    struct = avro_schema_to_struct(schema_json)
    fault, raw = frame_fault(value_col), strip_frame(value_col)
    raw = F.when(fault.isNull(), raw)
    if body == "avro":
        record = avro.from_avro(raw, schema_json, {"mode": "PERMISSIVE"})
        broken = record.isNull()
    elif body == "json":
        corrupt = T.StructType([*[T.StructField(f.name, f.dataType) for f in struct.fields],
                                T.StructField("_corrupt", T.StringType())])
        record = F.from_json(raw.cast("string"), corrupt,
                             {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
        broken = record.isNull() | record["_corrupt"].isNotNull()
    else:
        raise ValueError("body must be 'json' or 'avro'")
    out = df.select(*[k for k in (keep or []) if k != value_col], value_col, fault.alias("_fault"), record.alias("_r"),
                    broken.alias("_broken"))
    error = F.when(F.col("_fault").isNotNull(), F.col("_fault")).when(F.col("_broken"), "parse_failure")
    if mode == "failfast":
        error = F.when(error.isNotNull(), F.raise_error(F.concat(F.lit("malformed record: "), error))).cast("string")
    return out.select(*[c for c in out.columns if c not in ("_fault", "_r", "_broken")],
                      *[F.when(error.isNull(), F.col("_r")[f.name]).alias(f.name) for f in struct.fields],
                      error.alias(error_col))


def to_log_rows(df: DataFrame, key_col: str = "symbol", framed: bool = False, schema_id: int = 1,
                keep: list[str] | None = None, body: str = "json", schema_json: str | None = None) -> DataFrame:
    """Records -> keyed log rows ``key, value`` (K-5): the JSON text of the whole row (or its Avro body),
    ``framed`` with a magic byte and the schema id in front.  The key is the UTF-8 bytes of ``key_col``.
    Write the result with ``format("kafka")`` when that package is present, else to files."""
    keep = list(keep or [])
    record = F.struct(*[c for c in df.columns if c not in keep])
    if body == "avro":
        value = avro.to_avro(record, schema_json)
    elif body == "json":
        value = F.to_json(record).cast("binary")
    else:
        raise ValueError("body must be 'json' or 'avro'")
    if framed:
        value = F.concat(F.lit(bytes([0]) + schema_id.to_bytes(4, "big")), value)
    return df.select(*keep, F.col(key_col).cast("binary").alias("key"), value.alias("value"))


def split_decoded(decoded: DataFrame, error_col: str = "_error") -> tuple[DataFrame, DataFrame]:
    """(good, dead letters) of a permissive decode: dead letters keep the original
    bytes, ``reason='parse_failure'``, the specific cause and a ``dlq_ts``."""
    good = decoded.filter(F.col(error_col).isNull()).drop(error_col)
    bad = dead_letters(decoded.filter(F.col(error_col).isNotNull()), error_col)
    return good, bad


def dead_letters(bad: DataFrame, error_col: str = "_error", value_col: str = "value",
                 keep: list[str] | None = None, reason: str = "parse_failure") -> DataFrame:
    """Dead-letter row shape: original bytes (re-publishable), ``reason``, the
    specific ``detail`` and the time the record was routed."""
    keep = [c for c in (keep if keep is not None else ["key", "offset", "partition"])
            if c in bad.columns]
    return bad.select(*keep, F.col(value_col).alias("value"),
                      F.lit(reason).alias("reason"),
                      F.col(error_col).alias("detail"),
                      F.current_timestamp().alias("dlq_ts"))


# --- producer-side shaping, re-aimed as DataFrame operators (P-6, P-7) ----------

def normalise_trade(trades: DataFrame, event_time=None, reject: str = "row",
                    message_key: list[str] | None = None) -> DataFrame:
    """Flattened exchange trade -> trade event (P-6).

    ``symbol = product_id without '-'``, prices parsed with ``try_cast`` (a bad
    number gives null instead of an error), ``is_buyer_maker = side = 'SELL'``.
    ``event_time`` (epoch-millis column) stamps ``trade_time`` / ``ingestion_ts``;
    without it, processing time is used as the reference producer does.  Rows
    with a missing or unparsable field get ``_error`` set.

    ``reject="row"`` rejects only the bad trade.  ``reject="rest_of_message"``
    is the producer's behaviour: the first bad trade of a message (in array
    order) and every trade after it are rejected; ``message_key`` columns
    identify a message (a window over one message's trades, which is small).
    """
    t = F.col("_t")
    stamp = event_time if event_time is not None else F.unix_millis(F.current_timestamp())
    price = t["price"].try_cast("double")
    size = t["size"].try_cast("double")
    err = (F.when(t["product_id"].isNull(), F.lit("missing product_id"))
            .when(t["side"].isNull(), F.lit("missing side"))
            .when(price.isNull(), F.lit("bad price"))
            .when(size.isNull(), F.lit("bad size")))
    out = trades.select(
        *(message_key or []),
        *([c for c in ("_ev_pos", "_t_pos") if c in trades.columns and reject != "row"]),
        F.replace(t["product_id"], F.lit("-"), F.lit("")).alias("symbol"),
        price.alias("price"),
        size.alias("quantity"),
        stamp.cast("bigint").alias("trade_time"),
        (t["side"] == "SELL").alias("is_buyer_maker"),
        stamp.cast("bigint").alias("ingestion_ts"),
        err.alias("_error"),
    )
    if reject == "row":
        return out
    if reject != "rest_of_message" or not message_key:
        raise ValueError("reject must be 'row', or 'rest_of_message' with message_key")
    pos = F.struct("_ev_pos", "_t_pos")
    first_bad = F.min(F.when(F.col("_error").isNotNull(), pos)).over(Window.partitionBy(*message_key))
    rest = F.when(F.col("_error").isNull() & first_bad.isNotNull() & (pos > first_bad),
                  F.lit("after a bad trade in the message")).otherwise(F.col("_error"))
    return out.withColumn("_error", rest).drop("_ev_pos", "_t_pos")


def normalise_coin(records: DataFrame, ingestion_ts) -> DataFrame:
    """Coin REST record -> metadata record (P-7): upper-case symbol, zero for
    missing price / cap / rank / volume / ATH, nulls kept for the 24 h changes and
    supply, renamed keys, one ``ingestion_ts`` (epoch millis, literal or column)
    for the run."""
    def zero(c, t):
        return F.coalesce(F.col(c).cast(t), F.lit(0).cast(t))
    stamp = ingestion_ts if isinstance(ingestion_ts, Column) else F.lit(ingestion_ts)
    return records.select(
        F.col("id").alias("coin_id"),
        F.upper("symbol").alias("symbol"),
        "name",
        zero("current_price", "double").alias("current_price"),
        zero("market_cap", "bigint").alias("market_cap"),
        zero("market_cap_rank", "bigint").alias("market_cap_rank"),
        zero("total_volume", "double").alias("total_volume"),
        F.col("price_change_24h").cast("double").alias("price_change_24h"),
        F.col("price_change_percentage_24h").cast("double").alias("price_change_pct_24h"),
        F.col("circulating_supply").cast("double").alias("circulating_supply"),
        zero("ath", "double").alias("ath"),
        stamp.cast("bigint").alias("ingestion_ts"),
    )
