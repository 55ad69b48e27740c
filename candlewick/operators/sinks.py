"""Sinks (K-2, K-3, K-5..K-9, T-5): versioned snapshot tables, day-partition
replacement, upsert, warehouse-style loads and clustered mart layout.

Plain Parquet has no transaction log, so "overwrite the table I am reading" and
"merge into a table" write a NEW version directory ``v000001, v000002, ...``.
The job committer writes ``_SUCCESS`` last, so the current version is the
highest one that has it: readers list the base directory (no Spark job, no
pointer file) and never see a half-written version.  This is weaker than an ACID
table format: no isolation between concurrent writers, and old versions are
kept until removed.
"""

from __future__ import annotations

import datetime as _dt
import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from candlewick.operators.metrics import row_stats
from candlewick.session import staged

_VERSION = re.compile(r"^v(\d{6})$")


# --- snapshot tables (K-2, K-6) --------------------------------------------------

def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def _versions(spark: SparkSession, base: str) -> list[tuple[int, bool]]:
    """(version, committed) for every version directory under ``base``."""
    fs, p = _fs(spark, base)
    if not fs.exists(p):
        return []
    Path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    out = []
    for st in fs.listStatus(p):
        m = _VERSION.match(st.getPath().getName())
        if m and st.isDirectory():
            out.append((int(m.group(1)), bool(fs.exists(Path(st.getPath(), "_SUCCESS")))))
    return out


def current_version(spark: SparkSession, base: str) -> int | None:
    """Highest committed version under ``base`` (a listing, not a Spark job).
    A version whose writer died before committing has no ``_SUCCESS`` and is
    ignored."""
    done = [v for v, ok in _versions(spark, base) if ok]
    return max(done) if done else None


def snapshot_path(base: str, version: int) -> str:
    return f"{base}/v{version:06d}"


def read_snapshot(spark: SparkSession, base: str, fmt: str = "parquet") -> DataFrame:
    v = current_version(spark, base)
    if v is None:
        raise FileNotFoundError(f"no snapshot table at {base}")
    return spark.read.format(fmt).load(snapshot_path(base, v))


def spread_partitions(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Bring a partition value's rows together for writing, but split what is larger than
    ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` over as many tasks (and files) as it needs: a
    rebalance, which AQE sizes at run time.  A hot day has no fixed limit of tasks."""
    return df.hint("rebalance", *partition_by) if partition_by else df


def write_snapshot(df: DataFrame, base: str, partition_by: Sequence[str] = (),
                   fmt: str = "parquet", spread: bool = False) -> int:
    """Write ``df`` as the next version of the table at ``base``; it becomes
    current when the write commits."""
    spark = df.sparkSession
    # Past every existing directory, committed or not: a crashed writer's partial
    # version is never reused or read.
    v = max([v for v, _ in _versions(spark, base)] or [0]) + 1
    out = spread_partitions(df, partition_by) if spread else df
    w = out.write.mode("errorifexists").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(snapshot_path(base, v))
    return v


def rewrite_table(spark: SparkSession, base: str, transform, partition_by: Sequence[str] = ()) -> DataFrame:
    """K-2: read the current version, apply ``transform`` (e.g. exact dedupe) and
    write the result as a new version -- never overwriting the files being read."""
    out = transform(read_snapshot(spark, base))
    write_snapshot(out, base, partition_by, spread=True)
    return read_snapshot(spark, base)


def upsert(spark: SparkSession, base: str, source: DataFrame, keys: Sequence[str],
           check_unique: bool = True) -> DataFrame:
    """K-6: matched keys take the source row, unmatched source rows are inserted,
    other target rows stay; the first run creates the table.

    The source is evaluated once, into the shared scratch folder; the duplicate check and the
    merge read that.  ``target LEFT ANTI JOIN source ON keys`` + ``source``: one shuffle join (AQE may
    broadcast a small source).  Null keys never match (as in MERGE), so a null-key source row is
    inserted on every run.  Like MERGE, it is an error when a non-null source key matching the
    target occurs more than once.
    """
    if current_version(spark, base) is None:
        write_snapshot(source, base)
        return read_snapshot(spark, base)
    target, source = read_snapshot(spark, base), staged(source, "upsert-source")
    if check_unique:
        nn = F.lit(True)
        for k in keys:
            nn = nn & F.col(k).isNotNull()
        dup = (source.filter(nn).groupBy(*keys).count().filter(F.col("count") > 1)
                     .join(target.select(*keys), list(keys), "left_semi"))
        if not dup.isEmpty():
            raise ValueError("upsert: a source key matches the target more than once")
    merged = target.join(source.select(*keys), list(keys), "left_anti").unionByName(source)
    write_snapshot(merged, base)
    return read_snapshot(spark, base)


# --- bucket-wise upsert (K-6) ------------------------------------------------------

BUCKET = "_bucket"


def _bucket_of(keys: Sequence[str], buckets: int) -> Column:
    """The bucket that Spark's own bucketing deals a row to."""
    return F.pmod(F.hash(*keys), F.lit(buckets))


def upsert_bucketed(spark: SparkSession, name: str, source: DataFrame, keys: Sequence[str], buckets: int = 64,
                    check_unique: bool = True) -> DataFrame:
    """K-6 on a large catalog table: :func:`upsert`'s result, with only the touched buckets read and written.

    The table is bucketed by ``keys`` and partitioned by the same bucket number, so that a bucket is a folder.  Only
    the source is shuffled: the buckets that its keys fall into are joined with it by a bucketed scan (no exchange
    of the target) and replaced by dynamic partition overwrite (copy on write, moved in when the job commits);
    the other buckets' files stay as they are.  The first run creates the table with ``buckets`` buckets; size them
    so that a bucket is a few hundred megabytes.  Returns the table without its bucket column.
    """
    n = _buckets_of(spark, name, buckets)
    dealt = staged(source.withColumn(BUCKET, _bucket_of(keys, n)), "upsert-source")
    if not spark.catalog.tableExists(name):
        dealt.repartition(n, *keys).write.partitionBy(BUCKET).bucketBy(n, *keys).sortBy(*keys).saveAsTable(name)
        return spark.table(name).drop(BUCKET)
    touched = [r[0] for r in dealt.select(BUCKET).distinct().collect()]  # at most as many as buckets
    if touched:
        # A session of its own: insertInto takes the overwrite mode from the session alone.
        own = spark.newSession()
        for c in ("spark.sql.session.timeZone", "spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold"):
            own.conf.set(c, spark.conf.get(c))
        own.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
        rows = own.read.schema(dealt.schema).parquet(*dealt.inputFiles())
        merged_buckets(own, name, rows, keys, touched, check_unique).write.mode("overwrite").insertInto(name)
        spark.catalog.refreshTable(name)
    return spark.table(name).drop(BUCKET)


def _buckets_of(spark: SparkSession, name: str, default: int) -> int:
    """The number of buckets of the table; of a new one, ``default``."""
    if not spark.catalog.tableExists(name):
        return default
    rows = spark.sql(f"DESCRIBE EXTENDED {name}").filter("col_name = 'Num Buckets'").collect()
    if not rows:
        raise ValueError(f"{name} is not a bucketed table")
    return int(rows[0]["data_type"])


def merged_buckets(spark: SparkSession, name: str, source: DataFrame, keys: Sequence[str], touched: Sequence[int],
                   check_unique: bool = True) -> DataFrame:
    """The new rows of the ``touched`` buckets of the table, given the source rows with their bucket."""
    table = spark.table(name)
    target = table.filter(F.col(BUCKET).isin(*touched))
    if check_unique:
        whole = F.lit(True)
        for k in keys:
            whole = whole & F.col(k).isNotNull()
        twice = source.filter(whole).groupBy(*keys).count().filter("count > 1")
        if not target.select(*keys).join(twice, list(keys), "left_semi").isEmpty():
            raise ValueError("upsert: a source key matches the target more than once")
    n = _buckets_of(spark, name, 0)
    kept = target.join(source.select(*keys), list(keys), "left_anti")
    return kept.select(*table.columns).unionByName(source.repartition(n, *keys).select(*table.columns))


# --- day-partition replacement (K-3) --------------------------------------------

def _fs_delete(spark: SparkSession, path: str) -> None:  # noqa: D401
    fs, p = _fs(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def only_days(df: DataFrame, days: Sequence[_dt.date], day_col: str) -> DataFrame:
    """``df``, whose job fails on a row that is outside ``days`` (or has no day)."""
    inside = F.coalesce(F.col(day_col).isin(*[F.lit(d) for d in days]), F.lit(False))
    fault = F.raise_error(F.concat(F.lit("a row is outside the days to replace: "),
                                   F.coalesce(F.col(day_col).cast("string"), F.lit("null"))))
    return df.filter(F.when(inside, True).otherwise(fault.cast("boolean")))


def _days(days: Iterable) -> list[_dt.date]:
    return sorted({d if isinstance(d, _dt.date) else _dt.date.fromisoformat(str(d)) for d in days})


def _folders(df: DataFrame, parts: Sequence[str]) -> DataFrame:
    """``df`` is a partitioned file table: its partitions and their folders."""
    folder = F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "")
    return df.select(*parts, folder.alias("_folder")).distinct()


def _replace(new: DataFrame, path: str, parts: Sequence[str], days: DataFrame, day_col: str) -> None:
    """Overwrite the partitions that ``new`` has, then remove those of ``days`` that it has not."""
    spark = new.sparkSession
    (spread_partitions(new, parts).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*parts).parquet(path))
    if not path_exists(spark, path):
        return
    table = spark.read.parquet(path)
    # Days are partitions of the table, so there are few; with the join the scan lists theirs alone.
    there = _folders(table.join(F.broadcast(days), table[day_col].eqNullSafe(days["_day"]), "left_semi"), parts)
    have = new.select(*[F.col(p).alias(f"_{p}") for p in parts]).distinct()
    same = F.lit(True)
    for p in parts:
        # the table's type of a partition column is read off its folder names
        same = same & F.col(p).cast("string").eqNullSafe(F.col(f"_{p}").cast("string"))
    for row in there.join(have, same, "left_anti").select("_folder").toLocalIterator():
        # file paths of a scan are URIs: what folder names escape is escaped once more
        _fs_delete(spark, spark.sparkContext._jvm.java.net.URI.create(row[0]))


def replace_days(df: DataFrame, path: str, days: Iterable, day_col: str = "date",
                 partition_by: Sequence[str] | None = None) -> None:
    """K-3: make the table at ``path`` hold exactly ``df``'s rows for ``days``.

    ``partition_by`` is the table's layout, ``day_col`` at any place of it.  One dynamic partition-overwrite write
    replaces the partitions present in ``df``; partitions of ``days`` that ``df`` has no rows for (an empty
    day, a symbol that is gone from its day) are removed after it.  Re-runnable: the same input gives the same
    table.  A row outside ``days`` fails the write before it commits: the table stays as it was.
    """
    spark, days, parts = df.sparkSession, _days(days), list(partition_by or [day_col])
    if day_col not in parts:
        raise ValueError(f"the table is not partitioned by {day_col}")
    new = staged(only_days(df, days, day_col), "replace-days")
    _replace(new, path, parts, spark.createDataFrame([(d,) for d in days], "_day date"), day_col)


# --- days found by an ingestion high-water mark -------------------------------------

def _mark_path(path: str) -> str:
    return path.rstrip("/") + "_mark"


def high_water_mark(spark: SparkSession, path: str):
    """The newest ingestion time that :func:`sync_days` has taken over into the table at ``path`` (none yet: None)."""
    base = _mark_path(path)
    return None if current_version(spark, base) is None else read_snapshot(spark, base).first()["mark"]


def touched_days(source: DataFrame, mark, ingest_col: str, day_col: str) -> DataFrame:
    """``_day``: the days of the rows that came in since ``mark`` (rows of that very time again: they may be new)."""
    new = source if mark is None else source.filter(F.col(ingest_col) >= F.lit(mark))
    return new.select(F.col(day_col).alias("_day")).distinct()


def affected_rows(source: DataFrame, mark, ingest_col: str, day_col: str) -> DataFrame:
    """All rows of the days that rows came in for since ``mark``.  Where ``source`` is partitioned by the day, its
    partitions are pruned at run time by these days (the broadcast holds at most one row per day partition)."""
    if mark is None:
        return source
    days = touched_days(source, mark, ingest_col, day_col)
    return source.join(F.broadcast(days), source[day_col] == days["_day"], "left_semi")


def sync_days(source: DataFrame, path: str, ingest_col: str = "ingestion_ts", day_col: str = "date",
              partition_by: Sequence[str] | None = None, transform=None) -> DataFrame:
    """K-3 without a list of days: bring the table at ``path`` up to date with ``source``.

    The days that rows of ``source`` came in for since the table's high-water mark are read whole, shaped by
    ``transform`` (e.g. a dedupe) and replaced; the mark then becomes the newest ingestion time seen.  Late rows of
    an old day reload that day; a run without new rows replaces the days of the mark's own time by the same rows.
    The mark is written last: a run that dies before is repeated whole.  ``source`` must not change during the
    call (pass a snapshot), and needs a day in every row.
    """
    spark, parts = source.sparkSession, list(partition_by or [day_col])
    mark = high_water_mark(spark, path)
    rows = affected_rows(source, mark, ingest_col, day_col)
    obs = Observation("sync_days")
    seen = staged(rows.observe(obs, F.max(ingest_col).alias("mark")), "sync-rows")
    new = seen if transform is None else staged(transform(seen), "sync-days")
    # An old day that has no rows left after the transform is replaced by nothing.
    _replace(new, path, parts, seen.select(F.col(day_col).alias("_day")).distinct(), day_col)
    newest = obs.get["mark"]
    if newest is not None:
        write_snapshot(spark.createDataFrame([(max(newest, mark) if mark else newest,)],
                                             f"mark {seen.schema[ingest_col].dataType.simpleString()}").coalesce(1),
                       _mark_path(path))
    return spark.read.schema(_with_parts_last(new, parts)).parquet(path)


def _with_parts_last(df: DataFrame, parts: Sequence[str]):
    return df.select(*[c for c in df.columns if c not in parts], *parts).schema


def replace_days_in_table(df: DataFrame, name: str, days: Iterable, day_col: str = "date") -> None:
    """K-3 on a catalog table partitioned by ``day_col``: drop the partitions of ``days``, append ``df``.

    Delete-then-append is two steps, as in the reference: a run that dies in between is
    repeated.  The rows are checked against ``days`` before anything is dropped.
    """
    spark, days = df.sparkSession, _days(days)
    new = staged(only_days(df, days, day_col), "replace-days")
    for d in days:
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({day_col} = DATE '{d.isoformat()}')")
    spread_partitions(new.select(*spark.table(name).columns), [day_col]).write.mode("append").insertInto(name)


# --- warehouse-style loads (K-7, K-8, K-9) --------------------------------------

def load_table(df: DataFrame, name: str, mode: str = "append", fmt: str | None = None,
               options: dict | None = None, partition_by: Sequence[str] = ()) -> int:
    """K-7/K-8: write to a catalog table (or any writer format by ``fmt`` / ``options``, e.g. a JDBC or
    connector sink) and return the number of rows, observed during the write: nothing is persisted."""
    out, rows = row_stats(df, "load_table")
    w = spread_partitions(out, partition_by).write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt:
        w.format(fmt).options(**(options or {})).option("dbtable", name).save()
    else:
        w.saveAsTable(name)
    return int(rows.get["rows"])


#: Bits of a column's place in an interleaved key: 256 ranges of each column.
KEY_BITS = 8


def range_edges(df: DataFrame, col: str, ranges: int = 2 ** KEY_BITS) -> list:
    """Largest values of at most ``ranges`` ranges of the distinct values of ``col``, ascending, by the engine's own range
    partitioning: the number of edges is bounded, the values are not gathered."""
    dealt = df.select(col).filter(F.col(col).isNotNull()).distinct().repartitionByRange(ranges, col)
    tops = dealt.groupBy(F.spark_partition_id().alias("_p")).agg(F.max(col).alias("top"))
    return sorted(r["top"] for r in tops.select("top").collect())


def range_number(col: str, edges: Sequence, ranges: int = 2 ** KEY_BITS) -> Column:
    """The place of a value among ``edges``, stretched to 0 .. ranges - 1 (null: 0), by a binary search in expressions."""
    def search(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo * ranges // max(len(edges), 1))
        mid = (lo + hi) // 2
        return F.when(F.col(col) <= F.lit(edges[mid]), search(lo, mid)).otherwise(search(mid + 1, hi))
    # values above the last edge (none, if the edges are of the same rows) belong to the last range
    return F.when(F.col(col).isNull(), F.lit(0)).otherwise(search(0, max(len(edges) - 1, 0)))


def interleaved(numbers: Sequence[Column], bits: int = KEY_BITS) -> Column:
    """One number from the bits of ``numbers``, highest first, in turn: near in it is near in all of them."""
    n, key = len(numbers), F.lit(0).cast("bigint")
    for bit in range(bits):
        for i, number in enumerate(numbers):
            one = F.shiftright(number.cast("bigint"), bit).bitwiseAND(F.lit(1).cast("bigint"))
            key = key.bitwiseOR(F.shiftleft(one, bit * n + n - 1 - i))
    return key


def write_mart(df: DataFrame, path: str, cluster_by: Sequence[str],
               num_partitions: int | None = None, layout: str = "sorted") -> None:
    """T-5: clustered mart layout -- files hold disjoint key ranges (min/max stats then skip files).

    ``sorted``: range-partitioned and sorted on ``cluster_by``; filters on its first column skip files.
    ``interleaved``: range-partitioned on the interleaved bits of the columns' range numbers (a space-filling
    key), so that a filter on any one of up to seven columns skips most files.  ``df`` is written once before it, as
    the columns' ranges and the layout both read it.
    """
    if layout not in ("sorted", "interleaved"):
        raise ValueError(f"unknown layout {layout!r}")
    parts, columns = [F.col(c) for c in cluster_by], df.columns
    if layout == "interleaved":
        df = staged(df, "mart-rows")
        numbers = {f"_number{i}": range_number(c, range_edges(df, c)) for i, c in enumerate(cluster_by)}
        # a column each first, so that a search runs once for all bits
        df = df.withColumns(numbers).withColumn("_key", interleaved([F.col(n) for n in numbers]))
        parts = [F.col("_key"), *parts]
    out = (df.repartitionByRange(num_partitions, *parts) if num_partitions
           else df.repartitionByRange(*parts))
    out.sortWithinPartitions(*parts).select(*columns).write.mode("overwrite").parquet(path)


def file_ranges(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Per file its rows and, per column, ``<column>_min`` and ``<column>_max``: what a reader skips files by (worked
    out from the rows, by one aggregate)."""
    aggs = [f(c).alias(f"{c}_{name}") for c in columns for name, f in (("min", F.min), ("max", F.max))]
    return spark.read.parquet(path).groupBy(F.input_file_name().alias("file")).agg(
        F.count(F.lit(1)).alias("n_rows"), *aggs)
