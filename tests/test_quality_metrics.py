import datetime as dt
import random
import statistics

from candlewick.operators import metrics, quality


def ref_fmt(values):
    """The reference's percentile rule, in plain Python."""
    if not values:
        return None
    s = sorted(values)
    n = len(s)
    return (float(statistics.median(s)), float(s[min(int(n * 0.95), n - 1)]), float(s[min(int(n * 0.99), n - 1)]))


def test_latency_summary_matches_reference_rule(spark):
    rnd = random.Random(1)
    for n in (1, 2, 19, 20, 100, 333):
        vals = [rnd.randint(0, 50) for _ in range(n)]
        df = spark.createDataFrame([(v,) for v in vals], "x long")
        r = metrics.latency_summary(df, "x").first()
        assert (r.p50, r.p95, r.p99) == ref_fmt(vals) and r.n == n


def test_latency_summary_empty_and_grouped(spark):
    empty = spark.createDataFrame([], "x long")
    r = metrics.latency_summary(empty, "x").first()
    assert r.n == 0 and r.p50 is None
    df = spark.createDataFrame([("a", 1), ("a", 3), ("b", 5)], "g string, x long")
    got = {r.g: (r.p50, r.n) for r in metrics.latency_summary(df, "x", ["g"]).collect()}
    assert got == {"a": (2.0, 2), "b": (5.0, 1)}


def test_last_n_and_commit_gaps(spark):
    t = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(i % 2, t + dt.timedelta(seconds=i)) for i in range(10)], "p int, ts timestamp_ntz")
    assert metrics.last_n(df, ["ts"], 3).count() == 3
    assert metrics.last_n(df, ["ts"], 2, per=["p"]).count() == 4
    g = metrics.commit_gaps(df, "ts").first()
    assert (g.n_commits, g.span_ms, g.last_gap_ms) == (10, 9000, 1000)


def test_quality_suite_counts(spark):
    df = spark.createDataFrame([("a", True), ("a", None), (None, False)], "k string, b boolean")
    t = quality.TableTests("m", not_null=["k", "b"], unique=["k"], accepted_values={"b": [True, False]})
    got = {(r.column_name, r.test): (r.failures, r.status)
           for r in quality.run_suite({"m": df}, [t]).collect()}
    assert got == {("k", "not_null"): (1, "fail"), ("b", "not_null"): (1, "fail"),
                   ("b", "accepted_values"): (0, "pass"), ("k", "unique"): (1, "fail")}


def test_freshness_status(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1),)], "ts timestamp_ntz")
    st = lambda now: quality.freshness(df, "s", "ts", now).first().status
    assert st("2024-01-01 12:00:00") == "pass"
    assert st("2024-01-03 00:00:00") == "warn"
    assert st("2024-01-10 00:00:00") == "error"


def test_global_percentiles_bucketed_many_values(spark):
    rnd = random.Random(7)
    vals = [int(rnd.expovariate(1 / 300)) for _ in range(5000)]
    df = spark.createDataFrame([(v,) for v in vals], "x long")
    for b in (1, 4, 64):
        r = metrics._summary(df, "x", [], buckets=b).first()
        assert (r.p50, r.p95, r.p99) == ref_fmt(vals) and r.n == 5000


def test_grouped_percentiles_bucketed_with_null_group(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice(["a", "b", None]), int(rnd.expovariate(1 / 50))) for _ in range(3000)]
    df = spark.createDataFrame(rows, "g string, x long")
    for b in (1, 8, 64):
        got = {r.g: (r.p50, r.p95, r.p99) for r in metrics._summary(df, "x", ["g"], buckets=b).collect()}
        for key in ("a", "b", None):
            assert got[key] == ref_fmt([x for k, x in rows if k == key])


def test_a_failing_suite_fails_the_run(spark, tmp_root):
    import pytest

    from candlewick.plans import layers
    from candlewick.sources import fixtures as fx
    sf = "/root/testdata/sf0.001"
    with pytest.raises(AssertionError, match="int_hourly_aggregates.vwap:not_null"):
        layers.pipeline_run(spark, fx.raw_trades(spark, sf), fx.market_meta(spark, sf), fx.AS_OF_DATE, tmp_root)


def test_builds_do_not_share_tables(spark):
    from candlewick.plans import layers
    from candlewick.session import scratch_path
    from candlewick.sources import fixtures as fx
    sf = "/root/testdata/sf0.001"
    raw, meta = fx.raw_trades(spark, sf), fx.market_meta(spark, sf)
    first = layers.load_raw(spark, raw, meta, scratch_path(spark, "w"))["raw.trades"]
    n = first.count()
    layers.load_raw(spark, raw.limit(5), meta, scratch_path(spark, "w"))
    assert first.count() == n
