"""Micro-batch latency from the stream itself (M-2): a listener that keeps each batch's progress in a table.

Every progress event of a query becomes a row (query, run, batch, trigger time, rows, duration).  Rows are written as
one JSON file per ``every`` batches and at the end of a query, straight through the file system: no Spark job runs in
the listener.  :func:`batch_latency` is A-7 over the durations.
"""

from __future__ import annotations

import json
import threading
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from candlewick.operators.metrics import latency_summary
from candlewick.operators.sinks import _fs, path_exists

PROGRESS = ("query string, name string, run string, batch bigint, trigger_time timestamp_ntz, rows bigint, "
            "duration_ms bigint")


class ProgressLog(StreamingQueryListener):
    """Writes the progress of the session's streaming queries to ``path``; use it as a context manager.

    A batch is logged once per run; a batch that is repeated after a restart has a row per run.  A driver that is lost
    loses at most the last ``every - 1`` batches' rows.
    """

    def __init__(self, spark: SparkSession, path: str, every: int = 20):
        self.spark, self.path, self.every = spark, path, every
        self._rows: dict[str, list[dict]] = {}
        self._ended: set[str] = set()
        self._lock = threading.Lock()

    def __enter__(self) -> ProgressLog:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *exc) -> None:
        self.spark.streams.removeListener(self)
        for run in list(self._rows):
            self._write(run)

    def wait(self, query, seconds: float = 60) -> None:
        """Until the events of the ended ``query`` have come (they come after it ends), or for ``seconds``."""
        until = time.monotonic() + seconds
        while str(query.runId) not in self._ended and time.monotonic() < until:
            time.sleep(0.05)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        run = str(p.runId)
        with self._lock:
            rows = self._rows.setdefault(run, [])
            rows.append({"query": str(p.id), "name": p.name, "run": run, "batch": p.batchId,
                         "trigger_time": p.timestamp.rstrip("Z"), "rows": p.numInputRows,
                         "duration_ms": int(p.durationMs.get("triggerExecution", p.batchDuration))})
            full = len(rows) >= self.every
        if full:
            self._write(run)

    def onQueryTerminated(self, event) -> None:
        self._write(str(event.runId))
        self._ended.add(str(event.runId))

    def _write(self, run: str) -> None:
        with self._lock:
            rows = self._rows.pop(run, [])
        if not rows:
            return
        fs, p = _fs(self.spark, f"{self.path}/{run}-{rows[0]['batch']:012d}.json")
        out = fs.create(p, True)
        try:
            out.write(bytearray("".join(json.dumps(r) + "\n" for r in rows), "utf-8"))
        finally:
            out.close()


def progress_table(spark: SparkSession, path: str) -> DataFrame:
    """The logged batches (none yet: no rows)."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], PROGRESS)
    return spark.read.schema(PROGRESS).json(path)


def batch_latency(progress: DataFrame, group: tuple[str, ...] = ("query",)) -> DataFrame:
    """M-2 / A-7: ``n, p50, p95, p99`` of the durations (ms) of the batches that had rows, per ``group``."""
    return latency_summary(progress.filter(F.col("rows") > 0), "duration_ms", list(group))
