"""Corrected bars (W-1): a bar is in the table from its first trade on, and each later trade within the allowance
corrects it.

In append mode a bar comes out once, when the watermark has passed its end.  Here the stream runs in update mode: each
micro-batch gives the bars that its trades have changed, and a ``foreachBatch`` writer merges them into a table by
(window, symbol).  The table is partitioned by the hour (or day) of the window, so that a batch rewrites only the hours
that its trades fall into; the watermark bounds how far back these can be.

A batch is merged in two steps: the new contents of the touched partitions are written to ``root/pending/batch=n``
(done when its ``_SUCCESS`` is there), and the table's partitions are replaced from that.  A batch that is repeated
after a failure in the first step merges anew, as the table is untouched; after a failure in the second one, it
replaces the same partitions by the same rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from candlewick.operators.sinks import _fs_delete, path_exists, spread_partitions
from candlewick.streaming.sizing import STATE_PARTITIONS, batch_sized

PART = "part"
_FORMATS = {"hour": "yyyy-MM-dd-HH", "day": "yyyy-MM-dd"}


def _part(time_col: str, unit: str) -> Column:
    return F.date_format(time_col, _FORMATS[unit]).alias(PART)


def _with_part(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(PART, T.StringType())])


def bars_table(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """The bars as corrected so far (none yet: no rows)."""
    if not path_exists(spark, f"{root}/bars"):
        return spark.createDataFrame([], schema)
    return spark.read.schema(_with_part(schema)).parquet(f"{root}/bars").drop(PART)


def merged(table: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The new contents of the partitions that ``rows`` fall into; other partitions are neither listed nor read nor
    returned.  Null keys are equal to each other."""
    touched = [r[0] for r in rows.select(PART).distinct().collect()]  # hours of a batch: the watermark bounds them
    old = table.filter(F.col(PART).isin(*touched))
    same = old[keys[0]].eqNullSafe(rows[keys[0]])
    for k in keys[1:]:
        same = same & old[k].eqNullSafe(rows[k])
    return old.join(rows.select(*keys), same, "left_anti").unionByName(rows)


def merge_sink(bars: DataFrame, root: str, checkpoint: str, keys: Sequence[str] = ("window_start", "symbol"),
               unit: str = "hour", trigger: dict | None = None, partitions: int = STATE_PARTITIONS) -> StreamingQuery:
    """Run the aggregated stream ``bars`` in update mode and merge each micro-batch into the table at ``root``.

    The first of ``keys`` is the bar's time; ``unit`` (hour or day of it) is the table's partition.  ``root`` and
    ``checkpoint`` belong together: batch numbers are those of the checkpoint.  A batch without rows changes nothing.
    ``partitions``: see :func:`candlewick.streaming.sizing.batch_sized`.
    """
    spark, layout = bars.sparkSession, _with_part(bars.schema)

    def one(batch: DataFrame, number: int) -> None:
        pending, scratch = f"{root}/pending/batch={number}", f"{root}/tmp/batch={number}-{uuid.uuid4().hex[:8]}"
        try:
            # Written once, as each further use would run the stream's aggregate again; and always, as the state of
            # a repeated batch is committed by running it.
            batch.select("*", _part(keys[0], unit)).write.parquet(scratch)
            if not path_exists(spark, f"{pending}/_SUCCESS"):
                prepare(spark.read.schema(layout).parquet(scratch), pending)
        finally:
            _fs_delete(spark, scratch)
        if path_exists(spark, f"{pending}/_SUCCESS"):
            replace(pending)
        if number > 0:
            _fs_delete(spark, f"{root}/pending/batch={number - 1}")

    def prepare(rows: DataFrame, pending: str) -> None:
        if rows.isEmpty():
            return
        if path_exists(spark, f"{root}/bars"):
            rows = merged(spark.read.schema(layout).parquet(f"{root}/bars"), rows, keys)
        spread_partitions(rows, [PART]).write.mode("overwrite").partitionBy(PART).parquet(pending)

    def replace(pending: str) -> None:
        rows = spark.read.schema(layout).parquet(pending)
        (spread_partitions(rows, [PART]).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy(PART).parquet(f"{root}/bars"))

    with batch_sized(spark, partitions):
        return (bars.writeStream.outputMode("update").foreachBatch(one).option("checkpointLocation", checkpoint)
                    .trigger(**(trigger or {"processingTime": "30 seconds"})).start())
