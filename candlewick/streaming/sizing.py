"""A stream's settings are sized by its micro-batches, not by the tables that the session's batch jobs work on.

The session's number of shuffle partitions suits the largest table.  A stream that takes it over opens, commits and
reports as many state stores in every micro-batch, however small: partitions times batches then grow with the square
of the input.  A micro-batch has a bounded number of records, so a bounded number of partitions does.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

#: Partitions of a stream's state and shuffles, for micro-batches of up to some 500,000 records.
STATE_PARTITIONS = 16
#: What opening a file counts for, in bytes, when a micro-batch's files are dealt to tasks: its few MB go to all cores.
OPEN_COST = 1 << 16


@contextmanager
def batch_sized(spark: SparkSession, partitions: int = STATE_PARTITIONS) -> Iterator[None]:
    """A query that is started inside has at most ``partitions`` state and shuffle partitions (fewer if the session
    has).  A started query keeps its settings, and its checkpoint keeps the number: a restart takes the first run's."""
    n = min(partitions, int(spark.conf.get("spark.sql.shuffle.partitions")))
    new = {"spark.sql.shuffle.partitions": str(n), "spark.sql.files.openCostInBytes": str(OPEN_COST)}
    old = {k: spark.conf.get(k, None) for k in new}
    try:
        for k, v in new.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
