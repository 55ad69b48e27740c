import datetime as dt

from pyspark.sql import functions as F

from candlewick.operators import clean


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_latest_by_keeps_ties_and_null_group(spark):
    df = spark.createDataFrame(
        [("A", 1, "a1"), ("A", 3, "a3"), ("A", 3, "a3b"), ("B", 2, "b2"), (None, 5, "n5"), (None, 5, "n5b")],
        "symbol string, offset long, v string")
    keep = clean.latest_by(df, ["symbol"], ["offset"], ties="keep")
    assert rows(keep, "v") == [("a3",), ("a3b",), ("b2",), ("n5",), ("n5b",)]
    one = clean.latest_by(df, ["symbol"], ["offset"], ties="one")
    assert one.count() == 3


def test_latest_by_plans_group_limit(spark):
    df = spark.range(100).select((F.col("id") % 7).alias("k"), F.col("id").alias("o"))
    plan = clean.latest_by(df, ["k"], ["o"], ties="one")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_dedupe_trades_latest_forms_agree(spark):
    t0 = dt.datetime(2024, 1, 1, 0, 0, 0)
    data = [("AAAUSD", 1.0, 2.0, t0, True, t0 + dt.timedelta(seconds=s), dt.date(2024, 1, 1))
            for s in (5, 3605)]
    data += [("BBBUSD", 2.0, 1.0, t0, False, t0, dt.date(2024, 1, 1)),
             (None, 2.0, 1.0, t0, False, t0, dt.date(2024, 1, 1))]
    df = spark.createDataFrame(data, "symbol string, price double, quantity double, trade_time timestamp_ntz, "
                                     "is_buyer_maker boolean, ingestion_ts timestamp_ntz, date date")
    a = clean.dedupe_trades_latest(df, method="aggregate")
    w = clean.dedupe_trades_latest(df, method="window")
    assert sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, w.collect()), key=str)
    assert a.filter("symbol = 'AAAUSD'").first()["ingestion_ts"] == t0 + dt.timedelta(seconds=3605)
    assert "HashAggregate" in a._jdf.queryExecution().executedPlan().toString()


def test_dedupe_latest_keeps_values_of_rows_without_a_time(spark):
    t0 = dt.datetime(2024, 1, 1)
    data = [("A", True, "x", None), ("B", False, "old", None), ("B", True, "new", t0), ("C", True, "y", t0), ("C", True, "y", t0)]
    for kind, vals in (("timestamp_ntz", lambda x: x), ("timestamp", lambda x: x), ("long", lambda x: x and 5),
                       ("string", lambda x: x and "z")):
        df = spark.createDataFrame([(k, m, v, vals(t)) for k, m, v, t in data],
                                   f"symbol string, is_buyer_maker boolean, note string, ingestion_ts {kind}")
        for cols in (df.columns, ["symbol", "is_buyer_maker", "ingestion_ts"]):
            a = clean.dedupe_trades_latest(df.select(*cols), keys=["symbol"])
            w = clean.dedupe_trades_latest(df.select(*cols), keys=["symbol"], method="window")
            assert sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, w.collect()), key=str)
            assert a.filter("symbol = 'A'").first().is_buyer_maker is True


def test_dedupe_exact_and_stats(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "x int, y string")
    assert clean.dedupe_exact(df, ["x", "y"]).count() == 2
    s = clean.dedupe_stats(df, ["x", "y"]).first()
    assert (s.rows_before, s.rows_after, s.duplicates_removed) == (3, 2, 1)


def test_symbol_rules(spark):
    df = spark.createDataFrame([("BTCUSD",), ("AVAXUSD",), ("OPUSD",), ("ETHUSDT",)], "s string")
    left3 = [r[0] for r in df.select(clean.coin_symbol(F.col("s"), "left3")).collect()]
    strip = [r[0] for r in df.select(clean.coin_symbol(F.col("s"), "strip_quote")).collect()]
    assert left3 == ["BTC", "AVA", "OPU", "ETH"]
    assert strip == ["BTC", "AVAX", "OP", "ETH"]


def test_split_valid_and_pin(spark):
    df = spark.createDataFrame([("a", 1), (None, 2)], "symbol string, v int")
    good, bad = clean.split_valid(df)
    assert good.count() == 1 and bad.count() == 1
    assert clean.pin_columns(df, ["v", "symbol"]).columns == ["v", "symbol"]


def test_stg_trades_shape(spark):
    from candlewick.sources import fixtures as fx
    stg = clean.stg_trades(fx.raw_trades(spark, "/root/testdata/sf0.001"))
    assert stg.columns == ["coin_symbol", "price", "quantity", "trade_timestamp", "is_buyer_maker",
                           "ingestion_ts", "trade_date", "trade_date_trunc"]
    assert stg.count() == 1000
