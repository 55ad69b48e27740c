"""Streaming ingestion (S-1, P-8..P-10, C-5, K-1, K-4, W-1, W-2, W-3).

Builders return streaming DataFrames or started ``StreamingQuery`` objects; the
caller owns their lifetime (``run_bounded`` mirrors the reference's "run for at
most N seconds, then stop").  Offsets and sink progress live in the checkpoint,
so a restart resumes where the last committed batch ended, and a lost executor
only re-runs its tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from candlewick.operators.clean import TRADE_EXACT_KEY, split_valid, with_trade_times
from candlewick.schemas import TRADE_EVENT
from candlewick.streaming.bars import ohlcv_bars
from candlewick.streaming.sizing import STATE_PARTITIONS, batch_sized
from candlewick.streaming.split import split_sink


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


def trade_stream(spark: SparkSession, path_or_topic: str, fmt: str = "parquet",
                 schema: T.StructType | None = None, max_per_trigger: int | None = None,
                 **options) -> DataFrame:
    """S-1 / W-2: streaming scan of the trade log.

    ``fmt="kafka"``: ``subscribe=path_or_topic``, start at latest, tolerate lost
    offsets, ``maxOffsetsPerTrigger`` = ``max_per_trigger`` (records).  File
    formats: the wire schema is given (no inference) and ``max_per_trigger`` caps
    files per micro-batch.
    """
    r = spark.readStream.format(fmt)
    if fmt == "kafka":
        opts = {"subscribe": path_or_topic, "startingOffsets": "latest", "failOnDataLoss": "false"}
        if max_per_trigger:
            opts["maxOffsetsPerTrigger"] = str(max_per_trigger)
        opts.update(options)
        return r.options(**opts).load()
    r = r.schema(schema or _nullable(TRADE_EVENT))
    if max_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_per_trigger))
    return r.options(**options).load(path_or_topic)


def landed_trades(events: DataFrame) -> DataFrame:
    """Wire trades -> lake rows: ``trade_timestamp`` / ``date`` added (P-8, P-9)
    and only rows with a symbol kept (P-10; :func:`with_dlq` keeps the others as dead letters)."""
    good, _ = split_valid(with_trade_times(events))
    return good


def dedupe(df: DataFrame, keys: Sequence[str] = TRADE_EXACT_KEY, event_time: str = "trade_timestamp",
           delay: str = "10 minutes") -> DataFrame:
    """C-5: drop repeats of ``keys`` that arrive within ``delay`` of each other
    (state is evicted once the watermark passes, so it stays bounded).  Spark drops repeats and the rows
    behind the watermark; :func:`candlewick.streaming.split.split_sink` keeps both."""
    return df.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))


def append_sink(df: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str] = ("date", "symbol"),
                fmt: str = "parquet", trigger: dict | None = None, query_name: str | None = None,
                partitions: int = STATE_PARTITIONS, **options) -> StreamingQuery:
    """K-1 / W-3: append each micro-batch to a partitioned file table (the file
    sink's log makes it exactly-once), checkpointed.

    Each task writes what it has, so one day (a live stream is always one day) is written by all
    tasks of the batch.  With ``fmt="kafka"``, ``path`` is the topic of ``key, value`` rows.  ``partitions``: see
    :func:`candlewick.streaming.sizing.batch_sized`.
    """
    w = (df.writeStream.format(fmt).outputMode("append").options(**options)
           .option("checkpointLocation", checkpoint)
           .trigger(**(trigger or {"processingTime": "30 seconds"})))
    if partition_by:
        w = w.partitionBy(*partition_by)
    if query_name:
        w = w.queryName(query_name)
    with batch_sized(df.sparkSession, partitions):
        return w.option("topic", path).start() if fmt == "kafka" else w.start(path)


def with_dlq(decoded: DataFrame, root: str, checkpoint: str, partition_by: Sequence[str] = ("date", "symbol"),
             trigger: dict | None = None, error_col: str = "_error", delay_seconds: int = 600,
             keys: Sequence[str] = TRADE_EXACT_KEY) -> StreamingQuery:
    """K-4 + C-5 in one pass: a permissive decode split into ``root/lake``, ``root/duplicate``, ``root/late`` and
    ``root/dead`` (original bytes, reason, detail, time).  The source is read and decoded once per batch.  Every record
    goes to one of them: a record that decodes without a symbol is a dead letter as well."""
    from candlewick.operators.decode import dead_letters
    fault = F.coalesce(F.col(error_col), F.when(F.col("symbol").isNull(), F.lit("missing_symbol")))
    kept = [c for c in ("key", "offset", "partition") if c in decoded.columns]
    return split_sink(
        decoded.withColumn(error_col, fault), root, checkpoint, keys=keys, delay_seconds=delay_seconds,
        partition_by=partition_by, dead=F.col(error_col).isNotNull(), trigger=trigger,
        dead_rows=lambda bad: dead_letters(bad, error_col, keep=kept),
        good_rows=lambda good: landed_trades(good.drop(error_col, "value")))


def ohlcv_stream(events: DataFrame, width: str = "1 minute", delay: str = "2 minutes",
                 event_time: str = "trade_timestamp", key: str = "symbol") -> DataFrame:
    """W-1: watermarked tumbling-window OHLCV bars; in append mode a bar is emitted
    once the watermark passes its end, and its state is dropped."""
    return ohlcv_bars(events.withWatermark(event_time, delay), width, event_time, key)


def run_bounded(query: StreamingQuery, max_seconds: float | None) -> None:
    """Run until the trigger finishes (``availableNow``) or ``max_seconds`` pass,
    then stop (the reference's bounded run)."""
    try:
        query.awaitTermination(max_seconds) if max_seconds else query.awaitTermination()
    finally:
        if query.isActive:
            query.stop()
    if query.exception():
        raise query.exception()
