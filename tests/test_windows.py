import datetime as dt
import random

from candlewick.operators import windows


def _df(spark, rows):
    return spark.createDataFrame(rows, "coin_symbol string, price double, trade_timestamp timestamp_ntz, "
                                       "trade_date date")


def _random_trades(seed, n=300):
    rnd = random.Random(seed)
    t0 = dt.datetime(2024, 1, 1)
    out = []
    for i in range(n):
        ts = t0 + dt.timedelta(seconds=rnd.randint(0, 5 * 86400))
        price = None if rnd.random() < 0.05 else float(rnd.randint(0, 40))
        out.append((rnd.choice(["A", "B", "C"]), price, ts + dt.timedelta(microseconds=i), ts.date()))
    return out


def test_chunked_lag_equals_plain(spark):
    for seed in range(3):
        df = _df(spark, _random_trades(seed))
        for chunk in ("hour", "day", "minute"):
            a = windows.price_changes(df, method="chunked", chunk=chunk)
            b = windows.price_changes(df, method="plain")
            assert sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)


def test_null_price_at_bucket_end_is_carried_as_null(spark):
    t = dt.datetime(2024, 1, 1, 23, 59)
    df = _df(spark, [("A", 1.0, t, t.date()), ("A", None, t + dt.timedelta(seconds=30), t.date()),
                     ("A", 3.0, t + dt.timedelta(minutes=5), (t + dt.timedelta(minutes=5)).date())])
    out = {r.price: r.prev_price for r in windows.price_changes(df, chunk="day").collect()}
    assert out[3.0] is None  # previous trade's price was null


def test_pct_null_when_prev_zero(spark):
    t = dt.datetime(2024, 1, 1)
    df = _df(spark, [("A", 0.0, t, t.date()), ("A", 2.0, t + dt.timedelta(hours=2), t.date())])
    r = [x for x in windows.price_changes(df).collect() if x.price == 2.0][0]
    assert r.price_change_pct is None and r.price_change_abs == 2.0


def _tied_trades(seed, n=240):
    """Null and tied times, null prices, one coin with most trades in one hour."""
    rnd = random.Random(seed)
    t0 = dt.datetime(2024, 1, 1)
    out = []
    for i in range(n):
        ts = None if rnd.random() < 0.05 else t0 + dt.timedelta(seconds=rnd.randint(0, 60))
        out.append(("A" if rnd.random() < .8 else rnd.choice("BC"), None if rnd.random() < 0.05 else float(i), ts,
                    t0.date(), i))
    return out


def test_ranges_equal_plain_with_ties_and_null_times(spark):
    for seed, parts in ((1, 1), (2, 7), (3, 40)):
        df = spark.createDataFrame(_tied_trades(seed), "coin_symbol string, price double, trade_timestamp timestamp_ntz, "
                                                       "trade_date date, seq int").repartition(5)
        for method in ("ranges", "chunked"):
            a = windows.price_changes(df, ["seq"], method=method, parts=parts)
            b = windows.price_changes(df, ["seq"], method="plain")
            assert sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)


def test_a_hot_hour_spreads_over_all_ranges(spark):
    """One coin has all its trades at one time: no range holds more than its share."""
    from pyspark.sql import functions as F
    df = spark.range(40_000, numPartitions=4).select(
        F.lit("A").alias("coin_symbol"), F.col("id").cast("double").alias("price"),
        F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz").alias("trade_timestamp"), F.lit(dt.date(2024, 1, 1)).alias("trade_date"))
    sizes = [r["count"] for r in windows._in_ranges(df, [F.col("trade_timestamp").asc_nulls_last()], 8).groupBy("_b").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * 40_000 / 8
    got = windows.price_changes(df, parts=8)
    assert got.count() == 40_000 and got.filter("prev_price IS NULL").count() == 1
    assert got.select("prev_price").distinct().count() == 40_000
