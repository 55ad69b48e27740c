"""Corrected bars: late trades within the allowance change their bar in the table; failures leave no trace."""

import re

import pytest

from candlewick.operators import sinks
from candlewick.streaming import corrections, ingest
from candlewick.streaming.bars import ohlcv_bars
from tests.test_split import BASE, MINUTE, NOW, landed, trade, write_batches

BATCHES = [[trade(0, 5.0), trade(1, 6.0), trade(61, 7.0, "B")],
           [trade(1.5, 9.0), trade(62, 1.0)],                       # minute 1 gets a higher, later trade
           [trade(0.5, 2.0), trade(61, 3.0, "B"), trade(130, 4.0)]]  # minute 0 again, an hour late


def run(spark, root, src, delay="2 hours", unit="hour"):
    bars = ingest.ohlcv_stream(landed(spark, src), delay=delay)
    q = corrections.merge_sink(bars, root, f"{root}/ck", unit=unit, trigger=NOW)
    ingest.run_bounded(q, 240)
    return bars.schema


def table(spark, root, schema):
    return sorted(map(tuple, corrections.bars_table(spark, root, schema).collect()))


def batch_twin(spark, src):
    return sorted(map(tuple, ohlcv_bars(ingest.landed_trades(spark.read.parquet(f"{src}/*"))).collect()))


@pytest.mark.parametrize("unit", ["hour", "day"])
def test_late_trades_correct_their_bars(spark, tmp_root, unit):
    write_batches(spark, f"{tmp_root}/in", BATCHES)
    schema = run(spark, tmp_root, f"{tmp_root}/in", unit=unit)
    got = table(spark, tmp_root, schema)
    assert got == batch_twin(spark, f"{tmp_root}/in")
    first = got[0]
    assert (first[3], first[5], first[6], first[10]) == (5.0, 2.0, 2.0, 2)  # open, low, close, trades of minute 0
    assert not sinks.path_exists(spark, f"{tmp_root}/tmp/batch=0")


def test_trades_behind_the_allowance_change_nothing(spark, tmp_root):
    batches = [[trade(0, 5.0)], [trade(300, 6.0)], [trade(301, 6.0)], [trade(0, 50.0), trade(302, 6.0)]]
    write_batches(spark, f"{tmp_root}/in", batches)
    schema = run(spark, tmp_root, f"{tmp_root}/in", delay="10 minutes")
    got = table(spark, tmp_root, schema)
    assert len(got) == 4 and got[0][4] == 5.0 and got[0][10] == 1


@pytest.mark.parametrize("step", ["pending", "table"])
def test_a_failed_batch_is_repeated_without_loss_or_doubles(spark, tmp_root, monkeypatch, step):
    """Each batch dies once, while it writes the pending partitions or just after it took the old ones away."""
    write_batches(spark, f"{tmp_root}/in", BATCHES)
    real, failed = corrections.spread_partitions, set()

    def dies(df, parts):
        source = {"pending": "/tmp/batch=", "table": "/pending/batch="}[step]
        number = next((re.split("[-/]", f.split(source)[1])[0] for f in df.inputFiles() if source in f), None)
        if number is None or number in failed:
            return real(df, parts)
        failed.add(number)
        if step == "table":  # a dynamic overwrite that died after removing what it replaces
            for r in df.select(corrections.PART).distinct().collect():
                sinks._fs_delete(spark, f"{tmp_root}/bars/{corrections.PART}={r[0]}")
        raise RuntimeError("the writer died")

    monkeypatch.setattr(corrections, "spread_partitions", dies)
    for _ in BATCHES:
        with pytest.raises(Exception, match="the writer died"):
            run(spark, tmp_root, f"{tmp_root}/in")
    schema = run(spark, tmp_root, f"{tmp_root}/in")
    assert failed == {"0", "1", "2"}
    assert table(spark, tmp_root, schema) == batch_twin(spark, f"{tmp_root}/in")


def test_untouched_hours_keep_their_files(spark, tmp_root):
    write_batches(spark, f"{tmp_root}/in", [[trade(0), trade(61)]])
    schema = run(spark, tmp_root, f"{tmp_root}/in")
    before = {f for f in spark.read.parquet(f"{tmp_root}/bars").inputFiles()}
    write_batches(spark, f"{tmp_root}/in", [[trade(62, 3.0)]], at=1_700_009_000_000)
    run(spark, tmp_root, f"{tmp_root}/in")
    after = {f for f in spark.read.parquet(f"{tmp_root}/bars").inputFiles()}
    kept = before & after
    assert len(kept) == 1 and "part=2024-01-01-00" in next(iter(kept))
    assert len(table(spark, tmp_root, schema)) == 3 and BASE % MINUTE == 0


def test_merge_reads_the_touched_partitions_alone(spark, tmp_root):
    t = spark.range(48).selectExpr("id AS window_start", "'A' AS symbol", "concat('h', id) AS part")
    t.write.partitionBy("part").parquet(f"{tmp_root}/t")
    rows = spark.createDataFrame([(7, "A", "h7")], "window_start long, symbol string, part string")
    rows.write.parquet(f"{tmp_root}/r")
    rows = spark.read.parquet(f"{tmp_root}/r")
    out = corrections.merged(spark.read.parquet(f"{tmp_root}/t"), rows, ["window_start", "symbol"])
    scans = [x for x in out._jdf.queryExecution().executedPlan().toString().split("FileScan") if "/t]" in x]
    assert scans and all("PartitionFilters: [isnotnull(part" in x and "= h7)" in x for x in scans)
    assert [tuple(r) for r in out.collect()] == [(7, "A", "h7")]
