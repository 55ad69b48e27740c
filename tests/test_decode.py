import json

import pytest
from pyspark.sql import functions as F

from candlewick.operators import decode
from candlewick.schemas import TRADE_EVENT_AVRO, avro_schema_to_struct, struct_to_avro_schema


def trades(spark):
    return spark.createDataFrame([("AAAUSD", 1.5, 2.0, 1000, False, 2000, 1), ("BBBUSD", 2.5, 3.0, 1001, True, 2001, 2)],
                                 "symbol string, price double, quantity double, trade_time long, "
                                 "is_buyer_maker boolean, ingestion_ts long, offset long")


def test_nullable_union_schema():
    sch = json.dumps({"type": "record", "name": "R", "fields": [
        {"name": "a", "type": ["null", "double"]}, {"name": "b", "type": "string"}]})
    st = avro_schema_to_struct(sch)
    assert [f.nullable for f in st.fields] == [True, False]
    assert avro_schema_to_struct(struct_to_avro_schema(st)) == \
        avro_schema_to_struct(struct_to_avro_schema(st))


def test_frames_roundtrip_and_dead_letters(spark):
    log = decode.to_log_rows(trades(spark), "symbol", framed=True, keep=["offset"])
    first = bytes(log.first().value)
    assert first[0] == 0 and first[1:5] == (1).to_bytes(4, "big") and json.loads(first[5:])["symbol"] == "AAAUSD"
    bad = spark.createDataFrame([(bytearray(b"\x00\x01"), 3), (bytearray(b"{\"a\":1}"), 4), (None, 5),
                                 (bytearray(first[:20]), 6), (bytearray(first[:5]), 7)], "value binary, offset long")
    dec = decode.decode_frames(log.select("value", "offset").unionByName(bad), TRADE_EVENT_AVRO, keep=["offset"])
    good, dlq = decode.split_decoded(dec)
    assert sorted((r.symbol, r.price, r.is_buyer_maker) for r in good.collect()) == \
        [("AAAUSD", 1.5, False), ("BBBUSD", 2.5, True)]
    d = {r.offset: r.detail for r in dlq.collect()}
    assert d == {3: "too_short", 4: "bad_magic", 5: "too_short", 6: "parse_failure", 7: "parse_failure"}
    assert set(dlq.columns) >= {"value", "reason", "detail", "dlq_ts"}
    assert good.count() + dlq.count() == dec.count() == 7


def test_failfast_raises(spark):
    bad = spark.createDataFrame([(bytearray(b"\x00\x01"),)], "value binary")
    with pytest.raises(Exception, match="malformed record"):
        decode.decode_frames(bad, TRADE_EVENT_AVRO, mode="failfast").collect()


def test_avro_bodies_say_what_they_need(spark):
    with pytest.raises(Exception, match="spark-avro"):
        decode.decode_frames(trades(spark).select(F.lit(b"").alias("value")), TRADE_EVENT_AVRO, body="avro")


def test_rejected_and_good_trades_add_up(spark):
    from candlewick.plans.queries import QUERIES, _normalised
    sf = "/root/testdata/sf0.001"
    n = _normalised(spark, sf).count()
    assert QUERIES["flatten_market_trades"](spark, sf).count() + QUERIES["rejected_trades"](spark, sf).count() == n


def test_json_decode_permissive(spark):
    log = spark.createDataFrame([(1, None, bytearray(b'{"coin_id":"c","symbol":"S","ingestion_ts":5}')),
                                 (2, None, bytearray(b'{"coin_id":"c",'))],
                                "offset long, timestamp timestamp, value binary")
    out = {r.offset: r.symbol for r in decode.decode_market_meta(log).collect()}
    assert out == {1: "S", 2: None}


def test_flatten_and_normalise(spark):
    msg = {"channel": "market_trades", "events": [{"trades": [
        {"product_id": "BTC-USD", "price": "10.5", "size": "2", "side": "SELL"},
        {"product_id": "ETH-USD", "price": "x", "size": "1", "side": "BUY"}]}, {"trades": []}, {}]}
    other = {"channel": "heartbeats", "events": [{"trades": [{"product_id": "A-B"}]}]}
    df = spark.createDataFrame([(json.dumps(msg),), (json.dumps(other),)], "value string")
    flat = decode.flatten_market_trades(df)
    out = decode.normalise_trade(flat, event_time=F.lit(123)).collect()
    assert len(out) == 2
    good = [r for r in out if r._error is None]
    assert [(r.symbol, r.price, r.quantity, r.is_buyer_maker, r.trade_time) for r in good] == \
        [("BTCUSD", 10.5, 2.0, True, 123)]
    assert [r._error for r in out if r._error] == ["bad price"]


def test_normalise_coin_defaults(spark):
    from candlewick.schemas import COIN_REST
    df = spark.createDataFrame([('{"id":"x","symbol":"btc","name":"B","price_change_24h":null}',)], "j string")
    recs = df.select(F.from_json("j", COIN_REST).alias("r")).select("r.*")
    r = decode.normalise_coin(recs, F.lit(99)).first()
    assert (r.symbol, r.current_price, r.market_cap, r.ath, r.price_change_24h, r.ingestion_ts) == \
        ("BTC", 0.0, 0, 0.0, None, 99)


def test_normalise_rest_of_message(spark):
    msg = {"channel": "market_trades", "events": [
        {"trades": [{"product_id": "A-USD", "price": "1", "size": "1", "side": "BUY"},
                    {"product_id": "B-USD", "price": "bad", "size": "1", "side": "BUY"},
                    {"product_id": "C-USD", "price": "3", "size": "1", "side": "BUY"}]},
        {"trades": [{"product_id": "D-USD", "price": "4", "size": "1", "side": "SELL"}]}]}
    ok = {"channel": "market_trades", "events": [{"trades": [
        {"product_id": "E-USD", "price": "5", "size": "1", "side": "SELL"}]}]}
    df = spark.createDataFrame([(1, json.dumps(msg)), (2, json.dumps(ok))], "mid long, value string")
    flat = decode.flatten_market_trades(df)
    rows = decode.normalise_trade(flat, F.lit(0), reject="rest_of_message", message_key=["mid"]).collect()
    good = sorted(r.symbol for r in rows if r._error is None)
    assert good == ["AUSD", "EUSD"]
    per_row = decode.normalise_trade(flat, F.lit(0)).filter("_error is null").count()
    assert per_row == 4


def test_file_times_and_commit_gaps(spark, tmp_root):
    from candlewick.operators import metrics
    for i in range(3):
        spark.range(1).write.mode("append").parquet(tmp_root)
    ft = metrics.file_times(spark, tmp_root).filter(F.col("path").endswith(".parquet"))
    g = metrics.commit_gaps(ft, "modificationTime").first()
    assert g.n_commits >= 3 and g.span_ms >= g.last_gap_ms >= 0
