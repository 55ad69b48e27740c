"""One-pass stream split: each input row is in exactly one output, for any batching and after failures."""

import random
from collections import Counter

import pytest

from candlewick.streaming import ingest, split

BASE = 1704067200000  # 2024-01-01 00:00 UTC
MINUTE = 60_000
SCHEMA = "symbol string, price double, quantity double, trade_time long, is_buyer_maker boolean, ingestion_ts long"
NOW = {"availableNow": True}


def trade(minute, price=1.0, symbol="A"):
    return (symbol, price, 1.0, None if minute is None else BASE + int(minute * MINUTE), False, BASE)


def write_batches(spark, path, batches, at=1_700_000_000_000):
    """One file per micro-batch, replayed in this order."""
    from candlewick.operators.sinks import _fs
    Path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{path}/b{at}-{i}")
        fs, p = _fs(spark, f"{path}/b{at}-{i}")
        for st in fs.listStatus(p):
            fs.setTimes(Path(st.getPath().toString()), at + i * 60_000, -1)


def landed(spark, path, **kw):
    return ingest.landed_trades(ingest.trade_stream(spark, f"{path}/*", max_per_trigger=1, **kw))


def run(spark, root, src, ck="ck"):
    q = split.split_sink(landed(spark, src), root, f"{root}/{ck}", trigger=NOW)
    ingest.run_bounded(q, 240)


def outputs(spark, root, src):
    schema = landed(spark, src).schema
    return {name: Counter((r.symbol, r.price, r.trade_time) for r in split.output(spark, root, name, schema).collect())
            for name in ("lake", "duplicate", "late")}


def engine_lake(spark, root, src):
    q = ingest.append_sink(ingest.dedupe(landed(spark, src)), f"{root}/engine", f"{root}/ck-engine", ("date",), trigger=NOW)
    ingest.run_bounded(q, 240)
    return Counter((r.symbol, r.price, r.trade_time) for r in spark.read.parquet(f"{root}/engine").collect())


def total(batches):
    return Counter((r[0], r[1], r[3]) for rows in batches for r in rows)


def test_watermark_lag_and_equal_times_as_the_engine(spark, tmp_root):
    """Delay 10 minutes.  Batch 0 ends at minute 60; batch 1 has no late rows yet (lag); in batch 2 the watermark of
    batch 1 (minute 50) counts, and a row at the watermark is late."""
    batches = [[trade(0), trade(60, 2.0)],
               [trade(1, 3.0), trade(60, 2.0), trade(90, 4.0)],
               [trade(50, 5.0), trade(50.001, 6.0), trade(49, 7.0), trade(90, 4.0), trade(90, 4.0)],
               [trade(80, 8.0), trade(80.001, 9.0), trade(90, 4.0)]]
    write_batches(spark, f"{tmp_root}/in", batches)
    run(spark, tmp_root, f"{tmp_root}/in")
    got = outputs(spark, tmp_root, f"{tmp_root}/in")
    assert sorted(p for _, p, _ in got["late"]) == [5.0, 7.0, 8.0]
    assert got["duplicate"] == Counter({("A", 2.0, BASE + 60 * MINUTE): 1, ("A", 4.0, BASE + 90 * MINUTE): 3})
    assert got["lake"] + got["duplicate"] + got["late"] == total(batches)
    assert got["lake"] == engine_lake(spark, tmp_root, f"{tmp_root}/in")


@pytest.mark.parametrize("seed", [1, 2])
def test_random_batches_equal_the_engine_and_lose_nothing(spark, tmp_root, seed):
    rng = random.Random(seed)
    batches, now = [], 0
    for _ in range(6):
        now += rng.randrange(0, 25)
        batches.append([trade(max(0, now + rng.randrange(-30, 4)), float(rng.randrange(3)), rng.choice("AB"))
                        for _ in range(rng.randrange(1, 25))])
    write_batches(spark, f"{tmp_root}/in", batches)
    run(spark, tmp_root, f"{tmp_root}/in")
    got = outputs(spark, tmp_root, f"{tmp_root}/in")
    assert got["lake"] + got["duplicate"] + got["late"] == total(batches)
    assert got["lake"] == engine_lake(spark, tmp_root, f"{tmp_root}/in")
    assert got["late"] or got["duplicate"]


def test_a_failed_batch_is_repeated_without_loss_or_doubles(spark, tmp_root, monkeypatch):
    """Every step of a batch fails once; the query is started anew from its checkpoint each time."""
    batches = [[trade(0), trade(60, 2.0)], [trade(60, 2.0), trade(90, 4.0)], [trade(10, 5.0), trade(90, 4.0), trade(91, 6.0)]]
    write_batches(spark, f"{tmp_root}/in", batches)
    write, failed = split.BatchLog.write, set()

    def dies(log, spark_, root, number):
        if number < len(batches) and number not in failed:
            failed.add(number)
            raise RuntimeError("the writer died before its log")
        write(log, spark_, root, number)

    monkeypatch.setattr(split.BatchLog, "write", dies)
    for _ in range(len(batches)):
        with pytest.raises(Exception, match="the writer died"):
            run(spark, tmp_root, f"{tmp_root}/in")
    run(spark, tmp_root, f"{tmp_root}/in")
    got = outputs(spark, tmp_root, f"{tmp_root}/in")
    assert failed == {0, 1, 2}
    assert got["lake"] + got["duplicate"] + got["late"] == total(batches)
    assert got["late"] == Counter({("A", 5.0, BASE + 10 * MINUTE): 1})
    assert got["duplicate"] == Counter({("A", 2.0, BASE + 60 * MINUTE): 1, ("A", 4.0, BASE + 90 * MINUTE): 1})
    write_batches(spark, f"{tmp_root}/in", [[trade(92, 7.0), trade(91, 6.0)]], at=1_700_009_000_000)
    run(spark, tmp_root, f"{tmp_root}/in")  # a restart reads the new file alone
    assert outputs(spark, tmp_root, f"{tmp_root}/in")["lake"] == got["lake"] + Counter({("A", 7.0, BASE + 92 * MINUTE): 1})


def test_forgotten_keys_are_removed(spark, tmp_root):
    write_batches(spark, f"{tmp_root}/in", [[trade(60 * i, float(i))] for i in range(6)])
    run(spark, tmp_root, f"{tmp_root}/in")
    assert split.batches(spark, tmp_root, "lake") == list(range(6))
    assert len(split.batches(spark, tmp_root, "keys")) <= 3 and len(split.batches(spark, tmp_root, "log")) <= 2
    assert split.batches(spark, tmp_root, "tmp") == []


def test_rows_without_a_time_are_late_and_null_keys_are_equal(spark, tmp_root):
    batches = [[trade(None, 1.0), trade(1, None), trade(1, None)], [trade(None, 1.0), trade(1, None)]]
    write_batches(spark, f"{tmp_root}/in", batches)
    run(spark, tmp_root, f"{tmp_root}/in")
    got = outputs(spark, tmp_root, f"{tmp_root}/in")
    assert got["late"] == Counter({("A", 1.0, None): 2})
    assert got["lake"] == Counter({("A", None, BASE + MINUTE): 1}) and sum(got["duplicate"].values()) == 2


def test_the_source_is_read_once_per_batch(spark, tmp_root):
    from pyspark.sql import functions as F
    write_batches(spark, f"{tmp_root}/in", [[trade(0), trade(0), trade(1)], [trade(1), trade(2)]])
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            reads.add(b.num_rows)
            yield b

    stream = ingest.trade_stream(spark, f"{tmp_root}/in/*", max_per_trigger=1)
    stream = ingest.landed_trades(stream.mapInArrow(counted, stream.schema))
    q = split.split_sink(stream, tmp_root, f"{tmp_root}/ck", trigger=NOW, dead=F.col("symbol").isNull())
    ingest.run_bounded(q, 120)
    assert reads.value == 5
