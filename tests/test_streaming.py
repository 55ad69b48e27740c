from candlewick.streaming import ingest
from candlewick.streaming.bars import ohlcv_bars


def _write(spark, path, rows):
    # One file per call: files written by one job share a modification time, and the
    # file source orders a rate-limited replay by that time.
    spark.createDataFrame(rows, "symbol string, price double, quantity double, trade_time long, "
                                "is_buyer_maker boolean, ingestion_ts long") \
         .coalesce(1).write.mode("append").parquet(path)


def test_stream_bars_equal_batch_and_late_rows_dropped(spark, tmp_root):
    base = 1704067200000  # 2024-01-01 00:00 UTC
    rows = [("A", 1.0 + i, 1.0, base + i * 20_000, False, base) for i in range(12)]
    _write(spark, f"{tmp_root}/in", rows)
    _write(spark, f"{tmp_root}/in", [("~", 0.0, 0.0, base + 86_400_000, False, base)])
    # a late row (10 minutes behind the marker's watermark) in a later file
    ev = ingest.landed_trades(ingest.trade_stream(spark, f"{tmp_root}/in", max_per_trigger=1))
    q = ingest.append_sink(ingest.ohlcv_stream(ev), f"{tmp_root}/out", f"{tmp_root}/ck", partition_by=(),
                           trigger={"availableNow": True})
    ingest.run_bounded(q, 120)
    got = spark.read.parquet(f"{tmp_root}/out").filter("symbol != '~'")
    batch = ohlcv_bars(ingest.landed_trades(spark.read.parquet(f"{tmp_root}/in"))).filter("symbol != '~'")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, batch.collect()))
    assert got.count() == 4


def test_stream_dedupe_and_dlq(spark, tmp_root):
    from candlewick.operators.decode import to_log_rows, decode_frames
    from candlewick.schemas import TRADE_EVENT_AVRO
    base = 1704067200000
    src = spark.createDataFrame([("A", 1.0, 1.0, base, False, base)] * 2 + [("B", 2.0, 1.0, base + 5, True, base)],
                                "symbol string, price double, quantity double, trade_time long, "
                                "is_buyer_maker boolean, ingestion_ts long")
    log = to_log_rows(src, "symbol", framed=True)
    bad = spark.createDataFrame([(bytearray(b"k"), bytearray(b"\x07xx")),
                                 (bytearray(b"k"), bytearray(b"\x00\x00\x00\x00\x01{\"price\":1.0}"))],
                                "key binary, value binary")
    log.unionByName(bad).write.parquet(f"{tmp_root}/log")
    stream = spark.readStream.schema("key binary, value binary").parquet(f"{tmp_root}/log")
    dec = decode_frames(stream, TRADE_EVENT_AVRO, keep=["key"])
    q = ingest.with_dlq(dec, f"{tmp_root}/out", f"{tmp_root}/ck", partition_by=("date",), trigger={"availableNow": True})
    ingest.run_bounded(q, 120)
    from candlewick.streaming import split
    schema = "symbol string, price double"
    assert sorted(r.symbol for r in split.output(spark, f"{tmp_root}/out", "lake", schema).collect()) == ["A", "B"]
    assert [r.symbol for r in split.output(spark, f"{tmp_root}/out", "duplicate", schema).collect()] == ["A"]
    # every record is in one of the outputs, the one without a symbol too
    dead = split.output(spark, f"{tmp_root}/out", "dead", "key binary, value binary, detail string").collect()
    assert sorted(r.detail for r in dead) == ["missing_symbol", "too_short"] and all(bytes(r.key) == b"k" for r in dead)
    src.write.parquet(f"{tmp_root}/srcp")
    dd = ingest.dedupe(ingest.landed_trades(ingest.trade_stream(spark, f"{tmp_root}/srcp")))
    q = ingest.append_sink(dd, f"{tmp_root}/dd", f"{tmp_root}/ck2", partition_by=("date",),
                           trigger={"availableNow": True})
    ingest.run_bounded(q, 120)
    assert spark.read.parquet(f"{tmp_root}/dd").count() == 2


def test_a_day_is_written_by_more_than_one_task(spark, tmp_root):
    base = 1704067200000
    rows = spark.range(20_000).selectExpr("'A' AS symbol", "1.0D AS price", "1.0D AS quantity",
                                          f"{base} + id AS trade_time", "false AS is_buyer_maker", f"{base}L AS ingestion_ts")
    rows.repartition(4).write.parquet(f"{tmp_root}/in")
    landed = ingest.landed_trades(ingest.trade_stream(spark, f"{tmp_root}/in"))
    ingest.run_bounded(ingest.append_sink(landed, f"{tmp_root}/out", f"{tmp_root}/ck", ("date",),
                                          trigger={"availableNow": True}), 120)
    assert len(spark.read.parquet(f"{tmp_root}/out").inputFiles()) > 1
