"""Schemas of the data model (wire records, lake tables, raw warehouse tables)."""

from __future__ import annotations

import json

from pyspark.sql import types as T

# Wire record of one trade (fixed values: field names, types and order).
TRADE_EVENT = T.StructType([
    T.StructField("symbol", T.StringType(), False),
    T.StructField("price", T.DoubleType(), False),
    T.StructField("quantity", T.DoubleType(), False),
    T.StructField("trade_time", T.LongType(), False),       # epoch millis
    T.StructField("is_buyer_maker", T.BooleanType(), False),
    T.StructField("ingestion_ts", T.LongType(), False),     # epoch millis
])

# Wire schema of the trade topic (fixed values: field names, types and order).
TRADE_EVENT_AVRO = json.dumps({
    "type": "record", "name": "TradeEvent", "namespace": "candlewick",
    "fields": [
        {"name": "symbol", "type": "string"},
        {"name": "price", "type": "double"},
        {"name": "quantity", "type": "double"},
        {"name": "trade_time", "type": "long"},
        {"name": "is_buyer_maker", "type": "boolean"},
        {"name": "ingestion_ts", "type": "long"},
    ],
})

# Coin record as returned by the market-data REST endpoint (numbers may be null).
COIN_REST = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("symbol", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("current_price", T.DoubleType()),
    T.StructField("market_cap", T.DoubleType()),
    T.StructField("market_cap_rank", T.DoubleType()),
    T.StructField("total_volume", T.DoubleType()),
    T.StructField("price_change_24h", T.DoubleType()),
    T.StructField("price_change_percentage_24h", T.DoubleType()),
    T.StructField("circulating_supply", T.DoubleType()),
    T.StructField("ath", T.DoubleType()),
])

# JSON payload of one coin metadata record (fixed values).  ``nullable=False`` is declarative only:
# ``from_json`` does not enforce it, so callers filter explicitly.
MARKET_META = T.StructType([
    T.StructField("coin_id", T.StringType(), False),
    T.StructField("symbol", T.StringType(), False),
    T.StructField("name", T.StringType(), True),
    T.StructField("current_price", T.DoubleType(), True),
    T.StructField("market_cap", T.LongType(), True),
    T.StructField("market_cap_rank", T.LongType(), True),
    T.StructField("total_volume", T.DoubleType(), True),
    T.StructField("price_change_24h", T.DoubleType(), True),
    T.StructField("price_change_pct_24h", T.DoubleType(), True),
    T.StructField("circulating_supply", T.DoubleType(), True),
    T.StructField("ath", T.DoubleType(), True),
    T.StructField("ingestion_ts", T.LongType(), False),     # epoch millis
])

# Exchange message: {channel, events: [{trades: [{product_id, price, size, side}]}]}
EXCHANGE_MESSAGE = T.StructType([
    T.StructField("channel", T.StringType()),
    T.StructField("events", T.ArrayType(T.StructType([
        T.StructField("trades", T.ArrayType(T.StructType([
            T.StructField("product_id", T.StringType()),
            T.StructField("price", T.StringType()),
            T.StructField("size", T.StringType()),
            T.StructField("side", T.StringType()),
        ]))),
    ]))),
])

# Fixed column lists at the warehouse border (order is part of the contract).
RAW_TRADES_COLUMNS = ["symbol", "price", "quantity", "trade_time", "is_buyer_maker",
                      "ingestion_ts", "date"]
RAW_MARKET_META_COLUMNS = ["coin_id", "symbol", "name", "current_price", "market_cap",
                           "market_cap_rank", "total_volume", "price_change_24h",
                           "price_change_pct_24h", "circulating_supply", "ath", "ingestion_ts"]

_AVRO_PRIMITIVES = {
    "string": T.StringType(), "double": T.DoubleType(), "float": T.FloatType(),
    "long": T.LongType(), "int": T.IntegerType(), "boolean": T.BooleanType(),
    "bytes": T.BinaryType(),
}


def avro_schema_to_struct(schema_json: str | dict) -> T.StructType:
    """Flat Avro record schema -> StructType (driver side, no network).

    Supports primitive fields and ``["null", primitive]`` unions (nullable).  A
    ``logicalType`` written beside the type (not inside it) is inert, as Avro
    specifies, so millis stay ``long``.
    """
    rec = json.loads(schema_json) if isinstance(schema_json, str) else schema_json
    if rec.get("type") != "record":
        raise ValueError("only flat record schemas are supported")
    fields = []
    for f in rec["fields"]:
        t = f["type"]
        nullable = False
        if isinstance(t, list):
            non_null = [x for x in t if x != "null"]
            if len(non_null) != 1:
                raise ValueError(f"unsupported union for field {f['name']}: {t}")
            nullable = "null" in t
            t = non_null[0]
        if isinstance(t, dict):
            t = t.get("type")
        if t not in _AVRO_PRIMITIVES:
            raise ValueError(f"unsupported Avro type for field {f['name']}: {t}")
        fields.append(T.StructField(f["name"], _AVRO_PRIMITIVES[t], nullable))
    return T.StructType(fields)


def struct_to_avro_schema(struct: T.StructType, name: str = "Record",
                          namespace: str = "candlewick") -> str:
    """Inverse of :func:`avro_schema_to_struct` for flat primitive structs."""
    back = {v.simpleString(): k for k, v in _AVRO_PRIMITIVES.items()}
    fields = []
    for f in struct.fields:
        t = back[f.dataType.simpleString()]
        fields.append({"name": f.name, "type": ["null", t] if f.nullable else t})
    return json.dumps({"type": "record", "name": name, "namespace": namespace, "fields": fields})
