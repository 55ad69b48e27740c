"""One-pass split of a stream (C-5, K-1, K-4, W-3): every row ends in exactly one output.

A file sink with the engine's dedupe drops duplicates and late rows without a trace, and a second query for the
side output reads, decodes and judges everything again, by a watermark of its own.  Here one ``foreachBatch`` writer
decides for all outputs at once.  Each micro-batch is read and decoded once, into a staged table; from there its rows
go to ``lake``, ``duplicate``, ``late`` or ``dead``, each under the batch's number.  A batch that is repeated after a
failure replaces what it wrote, so nothing is lost or doubled.

The rules are those of ``dropDuplicatesWithinWatermark`` behind ``withWatermark``: the watermark of batch n is the
newest event time of the batches before n less the delay (it never falls); rows at or behind the watermark of batch
n - 1 are late in batch n (one batch of lag); a key is remembered until the watermark reaches its first event time plus
the delay.  Remembered keys lie in one small table per batch, which is removed when all its keys are forgotten.  A batch
reads the tables that can hold a key of its own alone: the log has the ranges of their numbers and times, so that a
long delay does not make each batch read all that is remembered.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from candlewick.operators.clean import TRADE_EXACT_KEY
from candlewick.operators.sinks import _fs, _fs_delete, path_exists
from candlewick.streaming.sizing import STATE_PARTITIONS, batch_sized

OUTPUTS = ("lake", "duplicate", "late", "dead")


@dataclass
class BatchLog:
    """What a batch leaves for the next one."""

    newest: int | None = None           # newest event time of all batches so far, micros
    watermark: int | None = None        # of this batch, micros
    remembered: dict[str, int] = field(default_factory=dict)  # batch -> when the last of its keys is forgotten, micros
    ranges: dict[str, dict[str, list[int]]] = field(default_factory=dict)  # batch -> key column -> least and most

    @staticmethod
    def read(spark: SparkSession, root: str, batch: int) -> BatchLog:
        """The log of a batch; before the first one, an empty log."""
        fs, p = _fs(spark, f"{root}/log/batch={batch}")
        if batch < 0 or not fs.exists(p):
            return BatchLog()
        path = next(s.getPath() for s in fs.listStatus(p) if s.getPath().getName()[0] not in "._")
        file = fs.open(path)
        try:
            return BatchLog(**json.loads(bytes(file.readAllBytes())))
        finally:
            file.close()

    def write(self, spark: SparkSession, root: str, batch: int) -> None:
        _fs_delete(spark, f"{root}/log/batch={batch}")
        fs, p = _fs(spark, f"{root}/log/batch={batch}/log.json")
        file = fs.create(p, True)
        try:
            file.write(bytearray(json.dumps(self.__dict__), "utf-8"))
        finally:
            file.close()


def _together(spark: SparkSession, *steps: Callable | None) -> list:
    """Results of independent steps whose jobs run side by side: a micro-batch's jobs are small."""
    with ThreadPoolExecutor(len(steps)) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(s)) for s in steps if s]]


def _ordered(schema: T.StructType, keys: Sequence[str]) -> dict[str, Column]:
    """The keys that are whole numbers or times, as whole numbers."""
    kinds = {k: schema[k].dataType for k in keys}
    return ({k: F.col(k).cast("bigint") for k, t in kinds.items() if isinstance(t, T.IntegralType)}
            | {k: F.unix_micros(k) for k, t in kinds.items() if isinstance(t, T.TimestampType)})


def _meet(a: dict[str, list[int]], b: dict[str, list[int]]) -> bool:
    """Whether batches of these ranges can have a key in common (a column without a range can hold anything)."""
    return all(a[k][0] <= b[k][1] and b[k][0] <= a[k][1] for k in a.keys() & b.keys())


def output(spark: SparkSession, root: str, name: str, schema) -> DataFrame:
    """Rows of one output, of all batches (none yet: no rows)."""
    if not path_exists(spark, f"{root}/{name}"):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", f"{root}/{name}").parquet(f"{root}/{name}/batch=*")


def split_sink(df: DataFrame, root: str, checkpoint: str, keys: Sequence[str] = TRADE_EXACT_KEY,
               event_time: str = "trade_timestamp", delay_seconds: int = 600,
               partition_by: Sequence[str] = ("date",), dead: Column | None = None, dead_rows=None,
               good_rows=None, trigger: dict | None = None, partitions: int = STATE_PARTITIONS) -> StreamingQuery:
    """Write the stream ``df`` to ``root/lake``, ``root/duplicate`` and ``root/late``, and the rows for which ``dead``
    is true to ``root/dead``, each as ``batch=n`` folders.

    ``good_rows`` shapes the rows that are not dead (it must give ``event_time`` and ``keys``), ``dead_rows`` the dead
    ones.  Of rows with equal keys in a batch one goes to the lake.  Rows without an event time are late: they have no
    place in time.  Null keys are equal to each other.  ``partitions``: see :func:`candlewick.streaming.sizing.batch_sized`.
    """
    spark = df.sparkSession
    shape, fault = good_rows or (lambda x: x), dead if dead is not None else F.lit(False)

    def one(batch: DataFrame, number: int) -> None:
        before = BatchLog.read(spark, root, number - 1)
        mark = None if before.newest is None else before.newest - delay_seconds * 1_000_000
        if before.watermark is not None:
            mark = max(mark, before.watermark)
        scratch = f"{root}/tmp/batch={number}-{uuid.uuid4().hex[:8]}"
        try:
            _write_batch(batch, number, before, mark, scratch)
        finally:
            _fs_delete(spark, scratch)

    def _write_batch(batch: DataFrame, number: int, before: BatchLog, mark: int | None, scratch: str) -> None:
        # The one reading of the source: rows, their fault, and a number for each.
        marked = batch.withColumn("_dead", F.coalesce(fault, F.lit(False))).withColumn(
            "_row", F.monotonically_increasing_id())
        marked.write.parquet(f"{scratch}/rows")
        rows = spark.read.schema(marked.schema).parquet(f"{scratch}/rows")
        gone = rows.filter("_dead").drop("_dead", "_row")
        good = shape(rows.filter("NOT _dead").drop("_dead"))
        micros = F.unix_micros(event_time)
        behind = F.lit(False) if before.watermark is None else micros <= F.lit(before.watermark)
        late = F.col(event_time).isNull() | behind
        ordered = _ordered(good.schema, keys)
        seen, *_ = _together(
            spark,
            lambda: good.agg(F.max(micros), F.count(F.lit(1)), *[F.min(c) for c in ordered.values()],
                             *[F.max(c) for c in ordered.values()], *[F.count(c) for c in ordered.values()]).first(),
            lambda: good.filter(late).drop("_row").write.mode("overwrite").parquet(f"{root}/late/batch={number}"),
            (lambda: (dead_rows(gone) if dead_rows else gone).write.mode("overwrite").parquet(
                f"{root}/dead/batch={number}")) if dead is not None else None)
        newest, n, *ends = seen
        width = len(ordered)
        ranges = {k: [ends[i], ends[width + i]] for i, k in enumerate(ordered) if 0 < n == ends[2 * width + i]}

        # Rows that are first of their key: in this batch, and among the remembered ones.
        fresh = good.filter(~late)
        first = fresh.groupBy(*keys).agg(F.min(F.struct("_row", micros.alias("at"))).alias("first"))
        first = first.select(*keys, "first._row", (F.col("first.at") + delay_seconds * 1_000_000).alias("_until"))
        alive = [b for b, until in before.remembered.items() if before.watermark is None or until > before.watermark]
        near = [b for b in alive if _meet(before.ranges.get(b, {}), ranges)]
        if near:
            known = spark.read.schema(first.drop("_row").schema).parquet(*[f"{root}/keys/batch={b}" for b in near])
            if before.watermark is not None:
                known = known.filter(F.col("_until") > before.watermark)
            same = [first[k].eqNullSafe(known[k]) for k in keys]
            cond = same[0]
            for c in same[1:]:
                cond = cond & c
            first = first.join(known, cond, "left_anti")
        first.write.mode("overwrite").parquet(f"{root}/keys/batch={number}")
        first = spark.read.schema(first.schema).parquet(f"{root}/keys/batch={number}")
        taken = first.select("_row")
        w = fresh.join(taken, "_row", "left_semi").drop("_row").write.mode("overwrite")
        _together(
            spark,
            lambda: (w.partitionBy(*partition_by) if partition_by else w).parquet(f"{root}/lake/batch={number}"),
            lambda: fresh.join(taken, "_row", "left_anti").drop("_row").write.mode("overwrite").parquet(
                f"{root}/duplicate/batch={number}"))
        # No key of this batch is remembered for longer (a remembered row's own time is in its table).
        until = None if newest is None else newest + delay_seconds * 1_000_000
        log = BatchLog(max((x for x in (before.newest, newest) if x is not None), default=None), mark,
                       {b: before.remembered[b] for b in alive} | ({str(number): until} if until is not None else {}),
                       {b: before.ranges[b] for b in alive if b in before.ranges} | {str(number): ranges})
        log.write(spark, root, number)
        # A repeated batch asks for what was alive at its beginning: only what was dead by then is removed.
        for b in before.remembered.keys() - set(alive):
            _fs_delete(spark, f"{root}/keys/batch={b}")
        if number > 1:
            _fs_delete(spark, f"{root}/log/batch={number - 2}")

    with batch_sized(spark, partitions):
        return (df.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint)
                  .trigger(**(trigger or {"processingTime": "30 seconds"})).start())


def batches(spark: SparkSession, root: str, name: str) -> list[int]:
    """Numbers of the batches that wrote to an output."""
    fs, p = _fs(spark, f"{root}/{name}")
    return sorted(int(s.getPath().getName()[6:]) for s in fs.listStatus(p)) if fs.exists(p) else []
