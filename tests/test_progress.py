"""The listener's table holds each batch of a stream once, and its summary is that of the durations."""

from candlewick.operators.metrics import commit_gaps
from candlewick.streaming import ingest, progress
from tests.test_split import NOW, landed, trade, write_batches


def test_batches_of_a_stream_are_logged(spark, tmp_root):
    write_batches(spark, f"{tmp_root}/in", [[trade(i)] * (i + 1) for i in range(5)])
    assert progress.progress_table(spark, f"{tmp_root}/none").count() == 0
    with progress.ProgressLog(spark, f"{tmp_root}/progress", every=2) as log:
        q = ingest.append_sink(landed(spark, f"{tmp_root}/in"), f"{tmp_root}/out", f"{tmp_root}/ck", ("date",),
                               trigger=NOW, query_name="append")
        ingest.run_bounded(q, 120)
        log.wait(q)
        table = progress.progress_table(spark, f"{tmp_root}/progress")
        rows = sorted(table.filter("rows > 0").collect(), key=lambda r: r.batch)
        assert [(r.batch, r.rows, r.name) for r in rows] == [(i, i + 1, "append") for i in range(5)]
        assert len({r.run for r in rows}) == 1 and all(r.duration_ms > 0 and r.trigger_time for r in rows)
        # a restart that finds a new file logs its batch under another run
        write_batches(spark, f"{tmp_root}/in", [[trade(9)]], at=1_700_009_000_000)
        q = ingest.append_sink(landed(spark, f"{tmp_root}/in"), f"{tmp_root}/out", f"{tmp_root}/ck", ("date",),
                               trigger=NOW, query_name="append")
        ingest.run_bounded(q, 120)
        log.wait(q)
    table = progress.progress_table(spark, f"{tmp_root}/progress").filter("rows > 0")
    assert table.count() == 6 and table.select("run").distinct().count() == 2
    summary = progress.batch_latency(table).collect()
    d = sorted(r.duration_ms for r in table.collect())
    assert len(summary) == 1 and (summary[0].n, summary[0].p50, summary[0].p99) == (6, (d[2] + d[3]) / 2, d[5])
    assert commit_gaps(table, "trigger_time").first().n_commits == 6
