"""Small helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from candlewick.session import ensure_semantics, scratch_path

#: Rows of one Arrow batch: a few hundred whole texts, so a Python worker holds
#: megabytes, whatever the length of the table.
ARROW_ROWS = 512


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings the Arrow stages rely on (UTC, package on the executors,
    short batches)."""
    ensure_semantics(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return spark


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: later uses read
    the files instead of repeating the work, and a lost executor re-reads them."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def staged_with(df: DataFrame, name: str, **aggs: Column) -> tuple[DataFrame, dict]:
    """:func:`staged`, with aggregates observed during the same write."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    obs = Observation(name)
    df.observe(obs, *[c.alias(k) for k, c in aggs.items()]).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), dict(obs.get)


def held_out(doc_id: Column | str = "doc_id") -> Column:
    """True for rows that no model may learn from: crc32 of the id's decimal text is
    divisible by 5.  A null id counts as the empty text (crc32 0: held out)."""
    text = F.coalesce(F.col(doc_id).cast("string") if isinstance(doc_id, str)
                      else doc_id.cast("string"), F.lit(""))
    return F.pmod(F.crc32(text.cast("binary")), F.lit(5)) == 0


def smallest_hashes(h: Column, rows: int, n: int) -> Column:
    """True for about ``rows`` of ``n`` values of the 64-bit hash ``h``: the smallest part of its range, which no
    size of a table rounds to nothing."""
    return h <= F.lit((1 << 64) * min(rows, n) // n - (1 << 63) - 1)


class Numbers(dict):
    """Numbers words in the order in which they are first asked for."""

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        return number


def free_names(df: DataFrame, *names: str) -> list[str]:
    """``names``, each lengthened until no column of ``df`` has it (whatever the case of its letters)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out
