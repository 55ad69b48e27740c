"""A stream's partitions and reads are bounded by its micro-batches, whatever the session or the delay."""

import pytest

from candlewick.operators.sinks import _fs_delete
from candlewick.streaming import corrections, ingest, sizing, split
from test_split import BASE, MINUTE, NOW, landed, trade, write_batches

WIDE = 48


@pytest.fixture()
def wide(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(WIDE))
    yield spark
    spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.mark.parametrize("kind", ["bars", "dedupe", "corrected"])
def test_state_is_sized_by_the_batch(wide, tmp_root, kind):
    write_batches(wide, f"{tmp_root}/in", [[trade(0), trade(61)], [trade(62, 2.0), trade(62, 2.0)]])
    rows = landed(wide, f"{tmp_root}/in")
    if kind == "corrected":
        q = corrections.merge_sink(ingest.ohlcv_stream(rows), f"{tmp_root}/out", f"{tmp_root}/ck", trigger=NOW)
    else:
        df = ingest.ohlcv_stream(rows) if kind == "bars" else ingest.dedupe(rows)
        q = ingest.append_sink(df, f"{tmp_root}/out", f"{tmp_root}/ck", partition_by=(), trigger=NOW)
    ingest.run_bounded(q, 120)
    ops = [s for p in q.recentProgress for s in p.stateOperators]
    assert ops and {s.numShufflePartitions for s in ops} == {sizing.STATE_PARTITIONS}
    assert wide.conf.get("spark.sql.shuffle.partitions") == str(WIDE)


def test_settings_come_back_and_never_grow(spark):
    keys = ("spark.sql.shuffle.partitions", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(k) for k in keys]
    with pytest.raises(ValueError), sizing.batch_sized(spark):
        assert spark.conf.get(keys[0]) == before[0]  # the session's 8 are fewer already
        with sizing.batch_sized(spark, 3):
            assert spark.conf.get(keys[0]) == "3"
        raise ValueError
    assert [spark.conf.get(k) for k in keys] == before


def test_a_batch_reads_the_remembered_keys_of_its_own_times_alone(spark, tmp_root):
    """With a delay of a day all batches are remembered; the folder of the first is gone, and a batch that can
    have no key of it does not ask for it."""
    def run():
        q = split.split_sink(landed(spark, f"{tmp_root}/in"), tmp_root, f"{tmp_root}/ck", trigger=NOW, delay_seconds=86_400)
        ingest.run_bounded(q, 120)

    write_batches(spark, f"{tmp_root}/in", [[trade(0), trade(5)], [trade(60), trade(65, None)]])
    run()
    _fs_delete(spark, f"{tmp_root}/keys/batch=0")
    write_batches(spark, f"{tmp_root}/in", [[trade(65, None), trade(120), trade(60)]], at=1_700_009_000_000)
    run()
    schema = landed(spark, f"{tmp_root}/in").schema
    rows = {n: sorted(r.trade_time for r in split.output(spark, tmp_root, n, schema).collect()) for n in ("lake", "duplicate")}
    assert rows["duplicate"] == [BASE + 60 * MINUTE, BASE + 65 * MINUTE]
    assert rows["lake"] == [BASE + m * MINUTE for m in (0, 5, 60, 65, 120)]


def test_ranges_without_a_common_key_do_not_meet():
    assert split._meet({}, {"a": [1, 2]}) and split._meet({"a": [1, 2]}, {"a": [2, 9]})
    assert not split._meet({"a": [1, 2], "b": [5, 5]}, {"a": [1, 2], "b": [6, 7]})
