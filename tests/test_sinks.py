import datetime as dt

import pytest
from pyspark.sql import functions as F

from candlewick.operators import sinks

D1, D2, D3 = dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 3)


def test_replace_days_idempotent_and_clears_empty_day(spark, tmp_root):
    base = spark.createDataFrame([(1, D1), (2, D2), (3, D3)], "v int, date date")
    base.write.partitionBy("date").parquet(tmp_root)
    new = spark.createDataFrame([(20, D2), (21, D2)], "v int, date date")
    for _ in range(2):
        sinks.replace_days(new, tmp_root, [D2, D3])
        got = sorted((r.v, r.date) for r in spark.read.parquet(tmp_root).collect())
        assert got == [(1, D1), (20, D2), (21, D2)]


def test_replace_days_refuses_rows_of_other_days(spark, tmp_root):
    spark.createDataFrame([(1, D1), (2, D2)], "v int, date date").write.partitionBy("date").parquet(tmp_root)
    for bad in ([(20, D2), (30, D3)], [(20, D2), (40, None)]):
        with pytest.raises(Exception, match="outside the days"):
            sinks.replace_days(spark.createDataFrame(bad, "v int, date date"), tmp_root, [D2])
        assert sorted(r.v for r in spark.read.parquet(tmp_root).collect()) == [1, 2]


def test_replace_days_in_a_catalog_table(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS t_days")
    sinks.load_table(spark.createDataFrame([(1, D1), (2, D2), (3, D3)], "v int, date date"), "t_days.x", mode="overwrite",
                     partition_by=["date"])
    for _ in range(2):
        sinks.replace_days_in_table(spark.createDataFrame([(20, D2), (21, D2)], "v int, date date"), "t_days.x", [D2, D3])
        assert sorted((r.v, r.date) for r in spark.table("t_days.x").collect()) == [(1, D1), (20, D2), (21, D2)]
    with pytest.raises(Exception, match="outside the days"):
        sinks.replace_days_in_table(spark.createDataFrame([(9, D1)], "v int, date date"), "t_days.x", [D2])
    assert spark.table("t_days.x").count() == 3


def test_a_hot_day_is_written_by_as_many_tasks_as_it_needs(spark, tmp_root):
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        df = spark.range(200_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("s"), F.lit(D1).alias("date"))
        sinks.write_snapshot(df.repartition(40), tmp_root, ["date"], spread=True)
        assert len(sinks.read_snapshot(spark, tmp_root).inputFiles()) > 1
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)


def test_upsert_semantics(spark, tmp_root):
    s1 = spark.createDataFrame([("A", 1), ("B", 2), (None, 3)], "symbol string, v int")
    out = sinks.upsert(spark, tmp_root, s1, ["symbol"])
    assert out.count() == 3
    s2 = spark.createDataFrame([("B", 20), ("C", 30), (None, 4)], "symbol string, v int")
    got = sorted(map(tuple, sinks.upsert(spark, tmp_root, s2, ["symbol"]).collect()), key=str)
    assert got == sorted([("A", 1), ("B", 20), ("C", 30), (None, 3), (None, 4)], key=str)
    dup = spark.createDataFrame([("A", 5), ("A", 6)], "symbol string, v int")
    with pytest.raises(ValueError):
        sinks.upsert(spark, tmp_root, dup, ["symbol"])


def test_rewrite_table_new_snapshot(spark, tmp_root):
    df = spark.createDataFrame([(1, D1), (1, D1), (2, D2)], "v int, date date")
    v = sinks.write_snapshot(df, tmp_root, ["date"])
    out = sinks.rewrite_table(spark, tmp_root, lambda d: d.dropDuplicates(), ["date"])
    assert out.count() == 2 and sinks.current_version(spark, tmp_root) == v + 1


def test_write_mart_clusters(spark, tmp_root):
    df = spark.range(100).select((F.col("id") % 5).cast("string").alias("c"), F.col("id"))
    sinks.write_mart(df, tmp_root, ["c", "id"], num_partitions=4)
    got = spark.read.parquet(tmp_root)
    assert got.count() == 100
    ranges = sorted((r.lo, r.hi) for r in got.groupBy(F.input_file_name().alias("f")).agg(
        F.min(F.struct("c", "id")).alias("lo"), F.max(F.struct("c", "id")).alias("hi")).collect())
    assert len(ranges) > 1 and all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))


def test_load_table(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS t_raw")
    n = sinks.load_table(spark.range(7), "t_raw.x", mode="overwrite")
    assert n == 7 and spark.table("t_raw.x").count() == 7
    assert sinks.load_table(spark.range(3), "t_raw.x") == 3 and spark.table("t_raw.x").count() == 10


def test_upsert_idempotent_without_null_keys(spark, tmp_root):
    s = spark.createDataFrame([("A", 1), ("B", 2)], "symbol string, v int")
    sinks.upsert(spark, tmp_root, s, ["symbol"])
    once = sorted(map(tuple, sinks.read_snapshot(spark, tmp_root).collect()))
    twice = sorted(map(tuple, sinks.upsert(spark, tmp_root, s, ["symbol"]).collect()))
    assert once == twice == [("A", 1), ("B", 2)]


def test_trades_for_day_prunes_partitions(spark, tmp_root):
    from candlewick.sources.tables import trades_for_day
    spark.createDataFrame([(1, D1), (2, D2)], "v int, date date").write.partitionBy("date").parquet(tmp_root)
    df = trades_for_day(spark, tmp_root, D2)
    assert [r.v for r in df.collect()] == [2]
    import re
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*date", plan), plan


def test_uncommitted_version_is_skipped(spark, tmp_root):
    import os
    from candlewick.session import local_fs_path
    sinks.write_snapshot(spark.createDataFrame([(1,)], "v int"), tmp_root)
    os.makedirs(local_fs_path(f"{tmp_root}/v000002"))          # a writer died here
    assert sinks.current_version(spark, tmp_root) == 1
    v = sinks.write_snapshot(spark.createDataFrame([(3,)], "v int"), tmp_root)
    assert v == 3 and [r.v for r in sinks.read_snapshot(spark, tmp_root).collect()] == [3]


ROWS = "v int, date date, symbol string"


def rows_of(spark, path):
    return sorted((r.v, r.date, r.symbol) for r in spark.read.schema(ROWS).parquet(path).collect())


@pytest.mark.parametrize("parts", [["date", "symbol"], ["symbol", "date"]])
def test_replace_days_removes_a_symbol_that_is_gone(spark, tmp_root, parts):
    """A day reloaded with symbol A alone: the old B, the null and the odd symbol of that day go, other days stay."""
    old = [(1, D1, "A"), (2, D1, "B"), (3, D2, "A"), (4, D2, "B"), (5, D2, None), (6, D2, "x/y=z %"), (7, D3, "B")]
    spark.createDataFrame(old, ROWS).write.partitionBy(*parts).parquet(tmp_root)
    new = spark.createDataFrame([(30, D2, "A"), (31, D2, "A")], ROWS)
    for _ in range(2):
        sinks.replace_days(new, tmp_root, [D2, D3], partition_by=parts)
        assert rows_of(spark, tmp_root) == [(1, D1, "A"), (2, D1, "B"), (30, D2, "A"), (31, D2, "A")]
    sinks.replace_days(new.limit(0), tmp_root, [D2], partition_by=parts)
    assert rows_of(spark, tmp_root) == [(1, D1, "A"), (2, D1, "B")]


def test_replace_days_of_a_new_table(spark, tmp_root):
    sinks.replace_days(spark.createDataFrame([(1, D1, "A")], ROWS), f"{tmp_root}/t", [D1, D2], partition_by=["date", "symbol"])
    assert rows_of(spark, f"{tmp_root}/t") == [(1, D1, "A")]


@pytest.mark.parametrize("parts", [["date"], ["date", "symbol"], ["symbol", "date"]])
def test_sync_days_reloads_old_days_without_a_list(spark, tmp_root, parts):
    """Late rows of an old day, a symbol that the transform takes away, an untouched day, a run without news."""
    schema = ROWS + ", at timestamp_ntz"
    when = lambda h: dt.datetime(2024, 1, 5, h)
    first = [(1, D1, "A", when(1)), (2, D1, "B", when(1)), (3, D2, "A", when(1)), (4, D3, "C", when(2))]
    later = first + [(10, D1, "A", when(3)), (0, D1, "B", when(4))]
    last = later + [(11, D1, "A", when(4))]
    lake, table = f"{tmp_root}/lake", f"{tmp_root}/table"

    def newest(rows):
        """The newest row of a symbol and day; v = 0 takes the symbol away."""
        from pyspark.sql import Window
        w = Window.partitionBy("date", "symbol").orderBy(F.desc("at"), F.desc("v"))
        return rows.withColumn("n", F.row_number().over(w)).filter("n = 1 AND v > 0").drop("n")

    for source, want, mark in ((first, [1, 2, 3, 4], 2), (later, [3, 4, 10], 4), (later, [3, 4, 10], 4), (last, [3, 4, 11], 4)):
        spark.createDataFrame(source, schema).write.mode("overwrite").partitionBy("date").parquet(lake)
        got = sinks.sync_days(spark.read.schema(schema).parquet(lake), table, "at", "date", parts, newest)
        assert sorted(r.v for r in got.collect()) == want
        assert sinks.high_water_mark(spark, table) == when(mark)
        untouched = [f for f in spark.read.parquet(table).inputFiles() if "2024-01-02" in f]
        assert len(untouched) == 1
        kept = untouched if source is first else kept
        assert untouched == kept  # the day without news was not written again


def test_affected_rows_prune_partitions_at_run_time(spark, tmp_root):
    rows = spark.range(2000).selectExpr("id AS v", "date_add(DATE '2024-01-01', CAST(id % 20 AS INT)) AS date",
                                        "timestamp_seconds(id) AS at")
    rows.write.partitionBy("date").parquet(tmp_root)
    source = spark.read.parquet(tmp_root)
    mark = source.filter("v = 1995").first()["at"]
    got = sinks.affected_rows(source, mark, "at", "date")
    assert got.count() == 500 and got.select("date").distinct().count() == 5
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan, plan


def test_upsert_bucketed_touches_only_the_buckets_of_its_keys(spark, tmp_root):
    """Same rows as the plain upsert; one key of 2,000 rewrites one bucket; the target has no exchange."""
    spark.sql("CREATE DATABASE IF NOT EXISTS t_buckets")
    spark.sql("DROP TABLE IF EXISTS t_buckets.x")
    name, keys = "t_buckets.x", ["symbol"]
    base = spark.range(2000).selectExpr("concat('s', id) AS symbol", "CAST(id AS INT) AS v").unionByName(
        spark.createDataFrame([(None, -1)], "symbol string, v int"))
    sinks.upsert(spark, tmp_root, base, keys)
    assert sinks.upsert_bucketed(spark, name, base, keys, buckets=16).count() == 2001
    files = set(spark.table(name).inputFiles())
    news = spark.createDataFrame([("s7", 70)], "symbol string, v int")
    sinks.upsert_bucketed(spark, name, news, keys)
    after = set(spark.table(name).inputFiles())
    gone, came = files - after, after - files
    assert len({f.split("_bucket=")[1].split("/")[0] for f in gone | came}) == 1 and len(gone) == 1
    sinks.upsert(spark, tmp_root, news, keys)
    news = spark.createDataFrame([("s8", 80), ("new", 1), (None, 2), ("s9", 90), ("odd", 1), ("odd", 2)], "symbol string, v int")
    got = sinks.upsert_bucketed(spark, name, news, keys)
    want = sinks.upsert(spark, tmp_root, news, keys)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    with pytest.raises(ValueError):
        sinks.upsert_bucketed(spark, name, spark.createDataFrame([("s1", 5), ("s1", 6)], "symbol string, v int"), keys)
    sinks.upsert_bucketed(spark, name, news.limit(0), keys)
    assert sorted(map(str, spark.table(name).drop("_bucket").collect())) == sorted(map(str, want.collect()))


def test_merged_buckets_do_not_exchange_the_target(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS t_buckets")
    spark.sql("DROP TABLE IF EXISTS t_buckets.y")
    base = spark.range(500).selectExpr("concat('s', id) AS symbol", "CAST(id AS INT) AS v")
    sinks.upsert_bucketed(spark, "t_buckets.y", base, ["symbol"], buckets=16)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        source = base.limit(5).withColumn("_bucket", sinks._bucket_of(["symbol"], 16))
        merged = sinks.merged_buckets(spark, "t_buckets.y", source, ["symbol"], [1, 2, 3], False)
        plan = merged._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    scan = next(i for i, x in enumerate(plan.splitlines()) if "FileScan" in x and "y[" in x and "SelectedBucketsCount" in x)
    left = plan.splitlines()[:scan]
    join = max(i for i, x in enumerate(left) if "Join" in x)
    assert not any("Exchange" in x for x in left[join:]), plan
    assert "PartitionFilters: [_bucket" in plan or "_bucket#" in plan.splitlines()[scan]


def _share_of_files(spark, path, column, values):
    """Average share of the files that a reader cannot skip for a filter on one value."""
    files = sinks.file_ranges(spark, path, [column]).collect()
    hit = sum(f[f"{column}_min"] <= v <= f[f"{column}_max"] for v in values for f in files)
    return hit / (len(files) * len(values)), len(files)


def test_interleaved_layout_skips_files_on_each_column(spark, tmp_root):
    """40 coins (one has a third of the rows) x 64 days: a filter on either column reads a small part of the files."""
    df = spark.range(24_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("c07")).otherwise(F.format_string("c%02d", F.col("id") * 7 % 40)).alias("coin"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.hash("id") % 64 + 64).cast("int") % 64).alias("day"), F.col("id"))
    coins = [f"c{i:02d}" for i in range(40)]
    days = [r[0] for r in df.select("day").distinct().collect()]
    sinks.write_mart(df, f"{tmp_root}/z", ["coin", "day"], num_partitions=64, layout="interleaved")
    sinks.write_mart(df, f"{tmp_root}/s", ["coin", "day"], num_partitions=64)
    got = spark.read.parquet(f"{tmp_root}/z")
    assert got.exceptAll(df).isEmpty() and got.count() == 24_000
    day, n = _share_of_files(spark, f"{tmp_root}/z", "day", days)
    coin, _ = _share_of_files(spark, f"{tmp_root}/z", "coin", coins)
    sorted_day, _ = _share_of_files(spark, f"{tmp_root}/s", "day", days)
    assert n >= 48 and day < 0.3 and coin < 0.3 and sorted_day > 0.6, (n, day, coin, sorted_day)


def test_range_numbers_and_interleaved_bits(spark, tmp_root):
    df = spark.createDataFrame([(None,), (1,), (5,), (5,), (9,), (100,)], "v int")
    edges = sinks.range_edges(df, "v", 4)
    assert edges[-1] == 100 and edges == sorted(set(edges)) and len(edges) <= 4
    got = {r.v: r.n for r in df.select("v", sinks.range_number("v", edges, 4).alias("n")).collect()}
    assert got[None] == 0 and got[1] <= got[5] <= got[9] <= got[100] <= 3 and got[100] > got[1]
    assert df.limit(0).select(sinks.range_number("v", []).alias("n")).collect() == []
    pair = spark.createDataFrame([(0b101, 0b011)], "a int, b int")
    assert pair.select(sinks.interleaved([F.col("a"), F.col("b")], 3)).first()[0] == 0b100111
    sinks.write_mart(df.limit(0), f"{tmp_root}/none", ["v"], layout="interleaved")
    assert spark.read.schema("v int").parquet(f"{tmp_root}/none").count() == 0
