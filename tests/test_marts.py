import datetime as dt
import random

from pyspark.sql import functions as F

from candlewick.operators import agg, enrich, marts, ranking

D1, D2 = dt.date(2024, 1, 29), dt.date(2024, 1, 30)


def _stg(spark, rows):
    return spark.createDataFrame(
        rows, "coin_symbol string, price double, quantity double, trade_timestamp timestamp_ntz, "
              "trade_date date, is_buyer_maker boolean, ingestion_ts timestamp_ntz")


def _meta(spark, rows):
    from decimal import Decimal
    rows = [r[:4] + (Decimal(r[4]),) + r[5:] for r in rows]
    return spark.createDataFrame(
        rows, "coin_id string, symbol string, name string, current_price double, market_cap decimal(20,0), "
              "market_cap_rank long, total_volume double, price_change_24h double, price_change_pct_24h double, "
              "circulating_supply double, ath double, ingested_at timestamp_ntz")


def literal_ohlcv(stg, meta):
    """The reference's form: enrich every trade, group by 4 columns, join open/close."""
    e = enrich.trades_with_meta(stg, meta)
    d = agg.daily(e)
    oc = agg.open_close(e)
    return (d.join(oc, ["trade_date", "coin_symbol"])
             .withColumn("day_change_pct", agg.day_change_pct()).select(*marts.OHLCV_COLUMNS))


def _trades(spark):
    t = dt.datetime(2024, 1, 30, 10, 0)
    rows = []
    for i, (c, p, q) in enumerate([("AAA", 1.0, 2.0), ("AAA", 2.0, 1.0), ("aaa", 3.0, 1.0), ("BBB", 4.0, 0.0),
                                   ("CCC", 5.0, 3.0), ("CCC", 6.0, 1.0), (None, 7.0, 1.0)]):
        rows.append((c, p, q, t + dt.timedelta(minutes=i), D2, False, t))
    rows.append(("AAA", 9.0, 1.0, t - dt.timedelta(days=1), D1, True, t))
    return _stg(spark, rows)


def test_ohlcv_equals_literal_form_with_fanout(spark):
    ts = dt.datetime(2024, 1, 30)
    meta = _meta(spark, [
        ("c1", "AAA", "Alpha", 1.0, 10, 1, 1.0, None, None, None, 5.0, ts),
        ("c2", "aaa", "Alpha", 1.0, 20, 1, 1.0, None, None, None, 5.0, ts),   # same (name, rank): doubles sums
        ("c3", "CCC", "Gamma", 1.0, 30, 3, 1.0, None, None, None, 5.0, ts),
        ("c4", "CCC", "Gamma2", 1.0, 40, 4, 1.0, None, None, None, 5.0, ts),  # other name: second group
        ("c5", None, "Null", 1.0, 50, 5, 1.0, None, None, None, 5.0, ts),
    ])
    stg = _trades(spark)
    got = sorted(map(tuple, marts.coin_daily_ohlcv(stg, meta).collect()), key=str)
    want = sorted(map(tuple, literal_ohlcv(stg, meta).collect()), key=str)
    assert got == want
    a = [r for r in got if r[1] == "AAA" and r[0] == D2][0]
    assert a[9] == 4  # two trades x two identical metadata rows


def test_daily_null_vwap_on_zero_volume(spark):
    meta = _meta(spark, [])
    out = marts.coin_daily_ohlcv(_trades(spark), meta).filter("coin_symbol = 'BBB'").first()
    assert out.vwap is None and out.trade_count == 1


def _random_values(n, seed):
    rnd = random.Random(seed)
    return [(i, rnd.choice([None, rnd.randint(-5, 5) / 2.0, rnd.randint(-50, 50) / 10.0])) for i in range(n)]


def test_rank_both_ends_matches_window(spark):
    for seed in range(4):
        df = spark.createDataFrame(_random_values(120, seed), "id long, v double")
        for k in (1, 3, 20):
            a = ranking.rank_both_ends(df, "v", k, "g", "l", method="distributed")
            b = ranking.rank_both_ends(df, "v", k, "g", "l", method="window")
            assert sorted(map(tuple, a.select("id", "v", "g", "l").collect()), key=str) == \
                   sorted(map(tuple, b.select("id", "v", "g", "l").collect()), key=str)


def test_top_movers_no_unbounded_single_partition(spark):
    from candlewick.plans.queries import QUERIES
    df = QUERIES["top_movers"](spark, "/root/testdata/sf0.001")
    assert df.count() == 14
    plan = df._jdf.queryExecution().executedPlan().toString()
    # the single-partition windows run over <= k distinct values: a top-k below each
    assert "WindowGroupLimit" in plan or "TakeOrderedAndProject" in plan


def test_market_overview_has_no_cross_join(spark):
    from candlewick.plans.queries import QUERIES
    df = QUERIES["market_overview"](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert df.count() == 13


def test_enrich_broadcasts_bounded_dimension(spark):
    from candlewick.plans.queries import QUERIES
    plan = QUERIES["trades_enriched"](spark, "/root/testdata/sf0.001")._jdf.queryExecution() \
        .executedPlan().toString()
    assert "BroadcastHashJoin" in plan


def test_largest_cap_collision_rule(spark):
    ts = dt.datetime(2024, 1, 30)
    meta = _meta(spark, [("small", "AAA", "Small", 1.0, 5, 9, 1.0, None, None, None, 5.0, ts),
                         ("big", "aaa", "Big", 1.0, 500, 1, 1.0, None, None, None, 5.0, ts)])
    stg = _trades(spark).filter("coin_symbol = 'AAA'")
    fan = enrich.trades_with_meta(stg, meta)
    one = enrich.trades_with_meta(stg, meta, on_collision="largest_cap")
    assert fan.count() == 2 * stg.count()
    assert {r.coin_id for r in one.collect()} == {"big"} and one.count() == stg.count()


def test_open_close_tiebreak(spark):
    t = dt.datetime(2024, 1, 30, 10)
    rows = [("AAA", 1.0, 1.0, t, D2, False, t), ("AAA", 2.0, 1.0, t, D2, False, t + dt.timedelta(seconds=1))]
    stg = _stg(spark, rows)
    r = agg.open_close(stg, tiebreak=["ingestion_ts"]).first()
    assert (r.open_price, r.close_price) == (1.0, 2.0)


def test_top_movers_rank_by(spark):
    from candlewick.plans.queries import ohlcv
    o = ohlcv(spark, "/root/testdata/sf0.001")
    by_day = marts.top_movers(o, D2, k=3)
    by_vwap = marts.top_movers(o, D2, k=3, rank_by="today_vwap")
    top = by_vwap.filter("gainer_rank = 1").first()
    assert top.today_vwap == o.filter(F.col("trade_date") == D2).agg(F.max("vwap")).first()[0]
    assert by_day.filter("gainer_rank <= 3").count() >= 3


def test_salted_enrichment_is_even_and_equal_to_the_join(spark):
    """Broadcast off, one symbol with a third of the trades, another third without a symbol: no task has over twice
    the median of rows, and the rows are those of the plain join (a symbol of two coins doubles its trades)."""
    stg = spark.range(30_000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'Hot' WHEN id % 3 = 1 THEN NULL ELSE concat('S', id % 400) END AS coin_symbol",
        "cast(id AS double) AS price", "1.0D AS quantity", "cast(timestamp_millis(id) AS timestamp_ntz) AS trade_timestamp",
        "DATE'2024-01-30' AS trade_date", "false AS is_buyer_maker", "cast(timestamp_millis(id) AS timestamp_ntz) AS ingestion_ts")
    t = dt.datetime(2024, 1, 30)
    meta = _meta(spark, [(f"c{i}", s, s, 1.0, 10 + i, i, 1.0, 0.0, 0.0, 1.0, 1.0, t)
                         for i, s in enumerate(["hot", "HOT", None, *[f"s{k}" for k in range(0, 400, 2)]])])
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        out = enrich.trades_with_meta(stg, meta, method="salted")
        # metadata matches double the hot rows: count trades, as they were dealt
        per_task = sorted(r["n"] for r in out.groupBy(F.spark_partition_id().alias("p")).agg(
            F.count_distinct("price").alias("n")).collect())
        assert len(per_task) == 8 and per_task[-1] <= 2 * per_task[len(per_task) // 2]
        plain = enrich.trades_with_meta(stg, meta)
        assert out.exceptAll(plain).isEmpty() and plain.exceptAll(out).isEmpty() and out.count() == 40_000
        assert [tuple(r) for r in enrich.heavy_symbols(stg, 8).collect()] == [("HOT", 64)]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_salted_enrichment_of_empty_tables(spark):
    t = dt.datetime(2024, 1, 30)
    stg, meta = _trades(spark), _meta(spark, [("c", "aaa", "A", 1.0, 1, 1, 1.0, 0.0, 0.0, 1.0, 1.0, t)])
    assert enrich.trades_with_meta(stg.limit(0), meta, method="salted").count() == 0
    assert enrich.trades_with_meta(stg, meta.limit(0), method="salted").count() == stg.count()


def test_tiebreak_keeps_hash_aggregation(spark):
    """Open / close with equal times, null times and null tiebreaks, as a window gives them; no sort in the plan."""
    rng = random.Random(3)
    t0 = dt.datetime(1969, 12, 31, 23, 59)
    rows = [(rng.choice("AB"), float(i), 1.0, rng.choice([None, *[t0 + dt.timedelta(minutes=m) for m in range(4)]]), D1,
             False, None if i == 7 else t0 + dt.timedelta(seconds=997 * i % 1009)) for i in range(400)]
    stg = _stg(spark, rows)
    for tie in ("ingestion_ts", "seq"):
        # whole numbers of the full 64-bit range
        df = stg.withColumn("seq", F.when(F.col("price") != 9, F.xxhash64("price")))
        got = agg.open_close(df, tiebreak=[tie])
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "SortAggregate" not in plan and "HashAggregate" in plan
        assert "SortAggregate" not in agg.daily_trade_stats(df, tiebreak=[tie])._jdf.queryExecution().executedPlan().toString()
        order = {(r.price): (r.trade_timestamp, r[tie] is not None, r[tie]) for r in df.collect() if r.trade_timestamp}
        sym = {r[1]: r[0] for r in rows}
        for r in got.collect():
            prices = sorted((p for p in order if sym[p] == r.coin_symbol), key=lambda p: tuple(
                x if x is not None else -1 for x in order[p]))
            assert (r.open_price, r.close_price) == (prices[0], prices[-1])
        daily = {r.coin_symbol: (r.open_price, r.close_price) for r in agg.daily_trade_stats(df, tiebreak=[tie]).collect()}
        assert daily == {r.coin_symbol: (r.open_price, r.close_price) for r in got.collect()}
    # other tiebreaks (two columns, doubles) are compared as structs
    two = agg.open_close(stg.filter("ingestion_ts IS NOT NULL"), tiebreak=["ingestion_ts", "quantity"])
    one = agg.open_close(stg.filter("ingestion_ts IS NOT NULL"), tiebreak=["ingestion_ts"])
    assert sorted(map(tuple, two.collect())) == sorted(map(tuple, one.collect()))
