"""Batch scans of lake tables and bounded logs (S-2, S-3, S-4)."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _as_date(d) -> _dt.date:
    return d if isinstance(d, _dt.date) else _dt.date.fromisoformat(str(d))


def table(spark: SparkSession, path: str, fmt: str = "parquet", **options) -> DataFrame:
    """Full scan of a lake table (S-4).  Column pruning / pushdown come from the
    caller's projections and filters."""
    return spark.read.format(fmt).options(**options).load(path)


def trades_for_day(spark: SparkSession, path: str, as_of_date, day_col: str = "date",
                   fmt: str = "parquet") -> DataFrame:
    """Scan of a date-partitioned trades table restricted to one day (S-3).

    The literal-date predicate on the partition column becomes a
    ``PartitionFilters`` entry: only that day's directories are listed and read.
    """
    return trades_for_days(spark, path, [as_of_date], day_col, fmt)


def trades_for_days(spark: SparkSession, path: str, days: Iterable, day_col: str = "date",
                    fmt: str = "parquet") -> DataFrame:
    lits = [F.lit(_as_date(d)) for d in days]
    return table(spark, path, fmt).filter(F.col(day_col).isin(*lits))


def log_batch(spark: SparkSession, path_or_topic: str, fmt: str = "parquet",
              **options) -> DataFrame:
    """Bounded scan of a keyed log (S-2): the whole log, as a batch, keeping
    ``offset`` and record ``timestamp``.

    With ``fmt="kafka"`` the options are passed through (``subscribe``,
    ``kafka.bootstrap.servers``; earliest -> latest).  Otherwise ``path_or_topic``
    is a table with ``key, value, offset, timestamp`` columns.
    """
    if fmt == "kafka":
        opts = {"subscribe": path_or_topic, "startingOffsets": "earliest",
                "endingOffsets": "latest", "failOnDataLoss": "false"}
        opts.update(options)
        return spark.read.format("kafka").options(**opts).load()
    return spark.read.format(fmt).options(**options).load(path_or_topic)
