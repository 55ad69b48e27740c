"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame over
the whole test tables.  Keys match :data:`candlewick.plans.oracle.ORACLE_SQL`."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.operators import agg, clean, decode, enrich, marts, windows
from candlewick.session import ensure_semantics
from candlewick.sources import fixtures as fx
from candlewick.streaming.bars import ohlcv_bars

AS_OF = fx.AS_OF_DATE
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        def wrapped(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_semantics(spark)
            return fn(spark, sf_dir)
        wrapped.__name__ = fn.__name__
        wrapped.__doc__ = fn.__doc__
        QUERIES[name] = wrapped
        return wrapped
    return deco


# --- shared inputs -------------------------------------------------------------

def stg_trades(spark, sf_dir) -> DataFrame:
    return clean.stg_trades(fx.raw_trades(spark, sf_dir))


def stg_market_meta(spark, sf_dir) -> DataFrame:
    return clean.stg_market_meta(clean.latest_meta_snapshot(fx.market_meta(spark, sf_dir)))


def ohlcv(spark, sf_dir) -> DataFrame:
    return marts.coin_daily_ohlcv(stg_trades(spark, sf_dir), stg_market_meta(spark, sf_dir))


# --- staging / cleaning ----------------------------------------------------------

@register("stg_trades")
def q_stg_trades(spark, sf_dir):
    """C-3 business-key dedupe (latest ingestion) + P-13 projection."""
    return stg_trades(spark, sf_dir)


@register("stg_market_meta")
def q_stg_market_meta(spark, sf_dir):
    """C-2 latest snapshot per coin + P-14 projection."""
    return stg_market_meta(spark, sf_dir)


@register("stg_trades_strip_quote")
def q_stg_trades_strip_quote(spark, sf_dir):
    """P-13 with the quote currency stripped, whatever the length of the base."""
    return clean.stg_trades(fx.raw_trades(spark, sf_dir), symbol_rule="strip_quote")


@register("stg_trades_gaps")
def q_stg_trades_gaps(spark, sf_dir):
    """C-3 over trades with null and tied ingestion times."""
    return clean.stg_trades(fx.trades_with_gaps(spark, sf_dir))


@register("dedupe_exact")
def q_dedupe_exact(spark, sf_dir):
    """C-4 whole-row dedupe of the landed trades table."""
    return clean.dedupe_exact(fx.lake_trades(spark, sf_dir))


@register("dedupe_exact_stats")
def q_dedupe_exact_stats(spark, sf_dir):
    """C-4 before / after / removed counts, one row."""
    return clean.dedupe_stats(fx.lake_trades(spark, sf_dir))


@register("latest_by_offset")
def q_latest_by_offset(spark, sf_dir):
    """S-2 + P-4 + C-1: decode the metadata log, keep the highest offset per symbol
    (ties kept; undecodable records form the null-symbol group)."""
    decoded = decode.decode_market_meta(fx.meta_log(spark, sf_dir))
    return clean.latest_by(decoded, ["symbol"], ["offset"], ties="keep").drop("offset", "kafka_ts")


@register("latest_snapshot")
def q_latest_snapshot(spark, sf_dir):
    """C-2 with a tiebreak: latest ingestion per coin, highest offset among equal times."""
    r = fx.meta_records(spark, sf_dir).drop("timestamp", "o_orderstatus")
    out = clean.latest_by(r, ["coin_id"], ["ingestion_ts", "offset"], ties="one")
    return out


# --- enrichment / aggregates / windows -----------------------------------------

@register("trades_enriched")
def q_trades_enriched(spark, sf_dir):
    """J-1 left join with metadata + P-15 trade value."""
    return enrich.trades_with_meta(stg_trades(spark, sf_dir), stg_market_meta(spark, sf_dir))


@register("trades_enriched_salted")
def q_trades_enriched_salted(spark, sf_dir):
    """J-1 for metadata too large to broadcast: heavy symbols measured, salted and their metadata replicated."""
    return enrich.trades_with_meta(clean.stg_trades(fx.raw_trades(spark, sf_dir)), stg_market_meta(spark, sf_dir),
                                   method="salted")


@register("open_close_tiebreak")
def q_open_close_tiebreak(spark, sf_dir):
    """A-3 with many equal times: trades ordered by their hour, ties by their exact time (one hash aggregate)."""
    stg = stg_trades(spark, sf_dir).withColumn("hour_ts", F.date_trunc("hour", "trade_timestamp").cast("timestamp_ntz"))
    return agg.open_close(stg, ts_col="hour_ts", tiebreak=["trade_timestamp"])


@register("price_changes")
def q_price_changes(spark, sf_dir):
    """F-1 tick-to-tick change (lag in ranges, with carry)."""
    return windows.price_changes(stg_trades(spark, sf_dir))


@register("hourly_aggregates")
def q_hourly(spark, sf_dir):
    """A-1 hourly bars per coin."""
    return agg.hourly(stg_trades(spark, sf_dir))


@register("daily_aggregates")
def q_daily(spark, sf_dir):
    """A-2 daily aggregate per (date, coin, name, rank)."""
    return marts.daily_aggregates(stg_trades(spark, sf_dir), stg_market_meta(spark, sf_dir))


@register("open_close")
def q_open_close(spark, sf_dir):
    """A-3 open / close per (date, coin) by min_by / max_by."""
    return agg.open_close(stg_trades(spark, sf_dir))


@register("coin_daily_ohlcv")
def q_coin_daily_ohlcv(spark, sf_dir):
    """Flagship: daily OHLCV mart."""
    return ohlcv(spark, sf_dir)


@register("top_movers")
def q_top_movers(spark, sf_dir):
    """J-3 + F-5 + T-1 + T-2 for the as-of day."""
    return marts.top_movers(ohlcv(spark, sf_dir), AS_OF)


@register("market_overview")
def q_market_overview(spark, sf_dir):
    """J-4 + A-4 + P-17 + T-3 for the as-of day."""
    return marts.market_overview(ohlcv(spark, sf_dir), stg_market_meta(spark, sf_dir), AS_OF)


@register("ohlcv_1m")
def q_ohlcv_1m(spark, sf_dir):
    """W-1 batch twin: 1-minute bars per symbol over the landed trades."""
    bars = ohlcv_bars(fx.lake_trades(spark, sf_dir))
    return bars.withColumn("window_start", F.col("window_start").cast("timestamp_ntz")) \
               .withColumn("window_end", F.col("window_end").cast("timestamp_ntz"))


# --- decode / log shaping ---------------------------------------------------------

@register("json_decode")
def q_json_decode(spark, sf_dir):
    """S-2 + P-4: the whole metadata log decoded (damaged records -> null fields)."""
    return decode.decode_market_meta(fx.meta_log(spark, sf_dir))


def _normalised(spark, sf_dir) -> DataFrame:
    flat = decode.flatten_market_trades(fx.exchange_messages(spark, sf_dir))
    return decode.normalise_trade(flat, event_time=F.col("msg_time"))


@register("flatten_market_trades")
def q_flatten(spark, sf_dir):
    """P-5 + P-6: exchange messages -> one normalised trade per array element; other channels
    skipped, rejected trades in ``rejected_trades``."""
    return _normalised(spark, sf_dir).filter(F.col("_error").isNull()).drop("_error")


@register("rejected_trades")
def q_rejected_trades(spark, sf_dir):
    """P-6 + K-4: the exchange trades that normalisation rejects, as dead letters with their cause."""
    bad = _normalised(spark, sf_dir).filter(F.col("_error").isNotNull())
    letters = decode.dead_letters(bad.withColumn("value", F.to_json(F.struct(
        *[c for c in bad.columns if c != "_error"])).cast("binary")), reason="rejected")
    return letters.select(F.get_json_object(F.col("value").cast("string"), "$.symbol").alias("symbol"),
                          F.get_json_object(F.col("value").cast("string"), "$.trade_time").cast("bigint").alias("trade_time"),
                          "reason", "detail")


@register("normalise_coin")
def q_normalise_coin(spark, sf_dir):
    """P-7: REST coin records -> metadata records (zero defaults, nulls kept)."""
    from candlewick.schemas import COIN_REST
    recs = fx.coin_rest_records(spark, sf_dir).select(F.from_json("json", COIN_REST).alias("r")).select("r.*")
    return decode.normalise_coin(recs, F.lit(fx.META_SNAPSHOT_MS))


@register("framed_roundtrip")
def q_framed_roundtrip(spark, sf_dir):
    """K-5 frames + P-1..P-3 decode: the good records of the framed trade log."""
    from candlewick.schemas import TRADE_EVENT_AVRO
    dec = decode.decode_frames(fx.trade_log(spark, sf_dir), TRADE_EVENT_AVRO, keep=["offset"])
    good, _ = decode.split_decoded(dec)
    return good.drop("value")


@register("publish_records")
def q_publish_records(spark, sf_dir):
    """K-5: every trade as a keyed JSON record, as the producer publishes it."""
    recs = fx.trade_records(spark, sf_dir).drop("timestamp")
    out = decode.to_log_rows(recs, "symbol", keep=["offset"])
    return out.select("offset", F.col("key").cast("string").alias("key"),
                      *[F.get_json_object(F.col("value").cast("string"), f"$.{c}").alias(c)
                        for c in ("symbol", "trade_time", "is_buyer_maker")])


@register("log_batch_scan")
def q_log_batch_scan(spark, sf_dir):
    """S-2 + K-5: the metadata log landed as files, scanned as a bounded log: records, bytes and
    offsets per key."""
    from candlewick.session import staged
    from candlewick.sources.tables import log_batch
    path = staged(fx.meta_log(spark, sf_dir), "meta-log").inputFiles()[0].rsplit("/", 1)[0]
    log = log_batch(spark, path)
    return log.groupBy(F.col("key").cast("string").alias("key")).agg(
        F.count(F.lit(1)).alias("records"), F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset"))


@register("dlq_split")
def q_dlq_split(spark, sf_dir):
    """P-3 + P-10 + K-4: the dead-letter rows of the framed trade log."""
    from candlewick.schemas import TRADE_EVENT_AVRO
    dec = decode.decode_frames(fx.trade_log(spark, sf_dir), TRADE_EVENT_AVRO, keep=["offset"])
    _, bad = decode.split_decoded(dec)
    return bad.select("offset", "reason", "detail")


# --- sinks -----------------------------------------------------------------------

@register("upsert_market_meta")
def q_upsert(spark, sf_dir):
    """S-2 + P-4 + C-1 + K-6: two ingestion runs (log up to 1998, whole log) merged
    into the metadata table on ``symbol``."""
    from candlewick.operators import sinks
    from candlewick.session import scratch_path
    decoded = decode.decode_market_meta(fx.meta_log(spark, sf_dir))

    def run(log):
        return clean.latest_by(log, ["symbol"], ["offset"], ties="keep").drop("offset", "kafka_ts")

    base = scratch_path(spark, "market_meta")
    sinks.upsert(spark, base, run(decoded.filter(F.col("kafka_ts") < F.lit(fx.META_RUN1_CUTOFF).cast("timestamp_ntz"))),
                 ["symbol"])
    return sinks.upsert(spark, base, run(decoded), ["symbol"])


@register("upsert_buckets")
def q_upsert_buckets(spark, sf_dir):
    """K-6 bucket by bucket: the two ingestion runs of ``upsert_market_meta`` merged into a bucketed table."""
    from candlewick.operators import sinks
    from candlewick.plans.layers import ensure_schema
    from candlewick.session import scratch_path
    decoded = decode.decode_market_meta(fx.meta_log(spark, sf_dir))
    name = f"{ensure_schema(spark, 'lake', scratch_path(spark, 'upsert'))}.market_meta"
    first = decoded.filter(F.col("kafka_ts") < F.lit(fx.META_RUN1_CUTOFF).cast("timestamp_ntz"))
    for log in (first, decoded):
        run = clean.latest_by(log, ["symbol"], ["offset"], ties="keep").drop("offset", "kafka_ts")
        out = sinks.upsert_bucketed(spark, name, run, ["symbol"], buckets=8)
    return out


@register("replace_day_symbols")
def q_replace_day_symbols(spark, sf_dir):
    """K-3 on a lake partitioned by day and symbol (here: its first digit, the lane): the as-of day comes again,
    deduped, without the symbols of one lane, whose old rows must go."""
    from candlewick.operators import sinks
    from candlewick.session import scratch_path
    raw = fx.raw_trades(spark, sf_dir).withColumn("lane", F.left("symbol", F.lit(1)))
    path = scratch_path(spark, "lanes")
    sinks.spread_partitions(raw, ["date", "lane"]).write.partitionBy("date", "lane").parquet(path)
    reload = clean.dedupe_trades_latest(raw.filter((F.col("date") == F.lit(AS_OF)) & (F.col("lane") != "1")))
    sinks.replace_days(reload, path, [AS_OF], partition_by=["date", "lane"])
    return spark.read.schema(raw.schema).parquet(path)


@register("sync_days")
def q_sync_days(spark, sf_dir):
    """K-3 without a list of days: the deduped trades table brought up to date twice from the lake, first with what
    had come in ten days before the as-of day, then with all, by the table's ingestion mark."""
    import datetime as _dt
    from candlewick.operators import sinks
    from candlewick.session import scratch_path
    raw = fx.raw_trades(spark, sf_dir).withColumn("lane", F.left("symbol", F.lit(1)))
    root = scratch_path(spark, "sync")
    early = F.col("ingestion_ts") < F.lit(_dt.datetime.combine(AS_OF, _dt.time()) - _dt.timedelta(days=10)).cast("timestamp_ntz")
    for i, rows in enumerate((raw.filter(early), raw)):
        sinks.spread_partitions(rows, ["date"]).write.partitionBy("date").parquet(f"{root}/lake{i}")
        lake = spark.read.parquet(f"{root}/lake{i}").select(*raw.columns)
        out = sinks.sync_days(lake, f"{root}/table", partition_by=["date", "lane"], transform=clean.dedupe_trades_latest)
    return out.withColumn("lane", F.col("lane").cast("string"))


@register("replace_day")
def q_replace_day(spark, sf_dir):
    """K-3: lake of raw trades partitioned by date; the as-of day is reloaded
    (deduped) and the previous day, with no new rows, is cleared."""
    import datetime as _dt
    from candlewick.operators import sinks
    from candlewick.session import scratch_path
    raw = fx.raw_trades(spark, sf_dir)
    path = scratch_path(spark, "raw_trades")
    sinks.spread_partitions(raw, ["date"]).write.partitionBy("date").parquet(path)
    reload = clean.dedupe_trades_latest(raw.filter(F.col("date") == F.lit(AS_OF)))
    sinks.replace_days(reload, path, [AS_OF, AS_OF - _dt.timedelta(days=1)])
    return spark.read.parquet(path)


@register("rewrite_deduped")
def q_rewrite_deduped(spark, sf_dir):
    """K-2 + C-4: exact-dedupe rewrite of the landed trades into a new snapshot."""
    from candlewick.operators import sinks
    from candlewick.session import scratch_path
    base = scratch_path(spark, "trades_lake")
    sinks.write_snapshot(fx.lake_trades(spark, sf_dir), base, partition_by=["date"])
    return sinks.rewrite_table(spark, base, clean.dedupe_exact, partition_by=["date"])


# --- quality ------------------------------------------------------------------------

def _models(spark, sf_dir) -> dict[str, DataFrame]:
    from candlewick.session import staged  # tests read the models' files, as after a build
    stg, meta = staged(stg_trades(spark, sf_dir), "stg-trades"), staged(stg_market_meta(spark, sf_dir), "stg-meta")
    return {"stg_trades": stg, "stg_market_meta": meta,
            "int_trades_enriched": enrich.trades_with_meta(stg, meta),
            "int_price_changes": windows.price_changes(stg),
            "int_hourly_aggregates": agg.hourly(stg)}


@register("quality_report")
def q_quality_report(spark, sf_dir):
    """Q-1..Q-3 + Q-5: the reference's 16 data tests over the staged models."""
    from candlewick.operators import quality
    return quality.run_suite(_models(spark, sf_dir), quality.REFERENCE_SUITE)


@register("freshness")
def q_freshness(spark, sf_dir):
    """Q-4: freshness of both raw sources at a fixed ``now``."""
    from candlewick.operators import quality
    now = fx.FRESHNESS_NOW
    return (quality.freshness(fx.raw_trades(spark, sf_dir), "raw.trades", "ingestion_ts", now)
            .unionByName(quality.freshness(fx.market_meta(spark, sf_dir), "raw.market_meta",
                                           "ingestion_ts", now)))


# --- metrics ------------------------------------------------------------------------

def _trade_log_records(spark, sf_dir) -> DataFrame:
    return fx.trade_records(spark, sf_dir).withColumn("partition", F.left("symbol", F.lit(3)).cast("int") % 10)


def _commit_times(spark, sf_dir) -> DataFrame:
    return fx.raw_trades(spark, sf_dir).groupBy("date").agg(F.max("ingestion_ts").alias("commit_time"))


def _history(spark, sf_dir, kind: str) -> DataFrame:
    from candlewick.operators import metrics
    h = fx.job_history(spark, sf_dir)
    if kind == "copy":
        pred, n = (F.col("query_type") == "COPY") & (F.col("database_name") == "ANALYTICS"), 20
    else:
        pred, n = F.col("query_tag").like("%dbt%") & (F.col("database_name") == "ANALYTICS"), 50
    return metrics.history_latency(h, pred, n, fx.HISTORY_NOW)


@register("latency_summary")
def q_latency_summary(spark, sf_dir):
    """A-7 over the ingest latency of every decoded trade record."""
    from candlewick.operators import metrics
    recs = _trade_log_records(spark, sf_dir)
    return metrics.latency_summary(recs.select((F.col("ingestion_ts") - F.col("trade_time")).alias("latency_ms")),
                                   "latency_ms")


@register("last_n_latency")
def q_last_n_latency(spark, sf_dir):
    """M-1 + T-4: per log partition, the newest 100 records' ingest latency."""
    from candlewick.operators import metrics
    return metrics.ingest_latency(_trade_log_records(spark, sf_dir), n=100)


@register("commit_gaps")
def q_commit_gaps(spark, sf_dir):
    """M-2 over the commit time of each trade day (its last ingestion)."""
    from candlewick.operators import metrics
    return metrics.commit_gaps(_commit_times(spark, sf_dir), "commit_time")


@register("history_latency")
def q_history_latency(spark, sf_dir):
    """M-3: newest 20 successful COPY jobs of the last day -> A-7."""
    return _history(spark, sf_dir, "copy")


@register("latency_report")
def q_latency_report(spark, sf_dir):
    """M-4: the per-stage latency table."""
    from candlewick.operators import metrics
    from candlewick.session import staged
    recs = _trade_log_records(spark, sf_dir)
    lat = metrics.latency_summary(recs.select((F.col("ingestion_ts") - F.col("trade_time")).alias("x")), "x")
    gaps = staged(metrics.commit_gaps(staged(_commit_times(spark, sf_dir), "commits"), "commit_time"), "gaps")
    one = lambda c: gaps.select(F.col(c).cast("double").alias("p50"),
                                F.lit(None).cast("double").alias("p95"), F.lit(None).cast("double").alias("p99"))
    return metrics.report([
        ("producer_to_log", lat, "all records"),
        ("micro_batch", one("last_gap_ms"), "gap between the last two commits"),
        ("lake_write", one("span_ms"), "newest minus oldest commit"),
        ("warehouse_copy", _history(spark, sf_dir, "copy"), "newest 20 COPY jobs"),
        ("model_run", _history(spark, sf_dir, "dbt"), "newest 50 model jobs"),
    ])


# --- layered build ----------------------------------------------------------------

@register("layered_marts")
def q_layered_marts(spark, sf_dir):
    """K-7 + K-9 + P-11 + S-5: raw tables -> views -> mart tables; the market
    overview mart read back from its table."""
    from candlewick.plans import layers
    from candlewick.session import scratch_path
    root = scratch_path(spark, "warehouse")
    raw = layers.load_raw(spark, fx.raw_trades(spark, sf_dir), fx.market_meta(spark, sf_dir), root)
    built = layers.build(spark, raw, layers.reference_models(AS_OF), root)
    return built["mart_market_overview"]


@register("pipeline_run")
def q_pipeline_run(spark, sf_dir):
    """Models, then tests: raw tables loaded, models built, the whole suite run on the written models; all test
    results, and whether the run passed (``on_failure="raise"`` ends it with an error instead)."""
    from candlewick.plans import layers
    from candlewick.session import scratch_path
    # The generated days have hours without volume, whose VWAP is null by definition: the run is marked as failed.
    return layers.pipeline_run(spark, fx.raw_trades(spark, sf_dir), fx.market_meta(spark, sf_dir), AS_OF,
                               scratch_path(spark, "run"), on_failure="report")["test_results"]


# --- streaming ------------------------------------------------------------------------

#: Records of a micro-batch (the reference's limit): a file source takes one file of at most this many.
BATCH_RECORDS = 500_000
#: Bytes of a row group in these files: the tasks that read a file share it by row groups.
ROW_GROUP = 1 << 19


def _stage_stream_input(spark, sf_dir, extra: DataFrame | None = None) -> tuple[str, str]:
    """Land the wire-shape trades (exact re-deliveries included) as files for a file stream source, in order of
    event time: file times are set in that order, since the source replays by them.  The files are ranges
    of event time sized by the data (BATCH_RECORDS, at least four).  ``extra`` rows come in files after them."""
    from candlewick.operators.sinks import _fs
    from candlewick.schemas import TRADE_EVENT
    from candlewick.session import scratch_path
    root = scratch_path(spark, "stream")
    cols = TRADE_EVENT.fieldNames()
    parts = {"a": (fx.lake_trades(spark, sf_dir).select(*cols), 4)}
    if extra is not None:
        parts["b"] = (extra.select(*cols), 1)
    Path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    at = 1_700_000_000_000
    for part, (rows, least) in parts.items():
        files = max(least, 2 * rows.count() // BATCH_RECORDS)  # ranges are equal to within a sample's error
        rows.repartitionByRange(files, "trade_time").write.option("parquet.block.size", ROW_GROUP).parquet(f"{root}/in/{part}")
        fs, p = _fs(spark, f"{root}/in/{part}")
        for name in sorted(st.getPath().toString() for st in fs.listStatus(p)):
            at += 60_000
            fs.setTimes(Path(name), at, -1)
    return root, f"{root}/in/*"


def _replayed(spark, start) -> None:
    """Start a query and run it to its end; the jobs of its micro-batches are sized by them, too."""
    from candlewick.streaming import ingest, sizing
    with sizing.batch_sized(spark):
        ingest.run_bounded(start(), None)


def _end_marker(spark, sf_dir) -> DataFrame:
    """One end-of-input record, a day past the last trade, so that the watermark closes every real
    window (a running stream gets that from later trades)."""
    last = fx.lake_trades(spark, sf_dir).agg((F.max("trade_time") + 86_400_000).alias("trade_time"))
    return last.select(F.lit(fx.END_MARKER_SYMBOL).alias("symbol"), F.lit(0.0).alias("price"),
                       F.lit(0.0).alias("quantity"), "trade_time", F.lit(False).alias("is_buyer_maker"),
                       F.col("trade_time").alias("ingestion_ts"))


def _late_rows(spark, sf_dir) -> DataFrame:
    """Trades of the first day that arrive again after everything else, with another quantity."""
    t = fx.trade_records(spark, sf_dir)
    first = t.agg(F.min("trade_time")).scalar()
    return t.filter(F.col("trade_time") < first + 86_400_000).withColumn("quantity", F.col("quantity") + 1000)


@register("trade_stream_append")
def q_trade_stream_append(spark, sf_dir):
    """S-1 + W-2 + P-8..P-10 + C-5 + K-1: trade stream, one file per micro-batch -> dedupe within
    watermark -> date-partitioned append sink (availableNow), read back.

    The sink's default layout is the reference's ``(date, symbol)``; here the lake
    is partitioned by ``date`` only: ``(date, symbol)`` writes one file per coin per
    micro-batch (28k directories at sf0.1), which at cluster scale is a small-file
    explosion, while ``date`` keeps pruning for the day-scoped loads."""
    from candlewick.streaming import ingest
    root, src = _stage_stream_input(spark, sf_dir)
    landed = ingest.dedupe(ingest.landed_trades(ingest.trade_stream(spark, src, max_per_trigger=1)))
    _replayed(spark, lambda: ingest.append_sink(landed, f"{root}/lake", f"{root}/ckpt", partition_by=("date",),
                                                trigger={"availableNow": True}))
    return spark.read.parquet(f"{root}/lake")


def _split_stream(spark, sf_dir) -> tuple[str, DataFrame]:
    """The trades as a stream, a file per micro-batch, late rows after them, split by one writer: (root, stream)."""
    from candlewick.streaming import ingest, split
    root, src = _stage_stream_input(spark, sf_dir, _late_rows(spark, sf_dir))
    landed = ingest.landed_trades(ingest.trade_stream(spark, src, max_per_trigger=1))
    _replayed(spark, lambda: split.split_sink(landed, root, f"{root}/ckpt", trigger={"availableNow": True}))
    return root, landed


@register("trade_stream_split")
def q_trade_stream_split(spark, sf_dir):
    """C-5 + K-1 + W-3: every row of the trade stream with the one output it went to: lake, duplicate or late."""
    from candlewick.streaming import split
    root, landed = _split_stream(spark, sf_dir)
    out = [split.output(spark, root, name, landed.schema).select(*landed.columns, F.lit(name).alias("sink"))
           for name in ("lake", "duplicate", "late")]
    return out[0].unionByName(out[1]).unionByName(out[2])


@register("trade_stream_late")
def q_trade_stream_late(spark, sf_dir):
    """C-5 + W-2: rows that come behind the watermark, from their output."""
    from candlewick.streaming import split
    root, landed = _split_stream(spark, sf_dir)
    return split.output(spark, root, "late", landed.schema).select(*landed.columns)


@register("ingest_stream")
def q_ingest_stream(spark, sf_dir):
    """The ingest as one path: framed bytes -> decode -> good rows to the lake, their repeats and late ones beside it,
    bad ones to the dead letters, all by one writer; how many records went where, by day or by cause."""
    from candlewick.operators.sinks import _fs
    from candlewick.schemas import TRADE_EVENT_AVRO
    from candlewick.session import scratch_path
    from candlewick.streaming import ingest, split
    root = scratch_path(spark, "ingest")
    log = fx.trade_log(spark, sf_dir)
    files = max(4, 2 * log.count() // BATCH_RECORDS)
    (log.repartitionByRange(files, "timestamp", "offset").select("key", "value")
        .write.option("parquet.block.size", ROW_GROUP).parquet(f"{root}/log"))
    fs, p = _fs(spark, f"{root}/log")
    Path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for i, name in enumerate(sorted(st.getPath().toString() for st in fs.listStatus(p))):
        fs.setTimes(Path(name), 1_700_000_000_000 + 60_000 * i, -1)
    stream = ingest.trade_stream(spark, f"{root}/log", schema=spark.read.parquet(f"{root}/log").schema, max_per_trigger=1)
    decoded = decode.decode_frames(stream, TRADE_EVENT_AVRO, keep=["key"])
    # Copies ingested hours later are records of their own: nothing is late within a day.
    _replayed(spark, lambda: ingest.with_dlq(decoded, f"{root}/out", f"{root}/ckpt", partition_by=("date",),
                                             trigger={"availableNow": True}, delay_seconds=86_400))
    day = F.date_format("date", "yyyy-MM-dd").alias("what")
    n = F.count(F.lit(1)).alias("records")
    out = [split.output(spark, f"{root}/out", name, "symbol string, date date").groupBy(day).agg(n)
           .withColumn("sink", F.lit(name)) for name in ("lake", "duplicate", "late")]
    dead = split.output(spark, f"{root}/out", "dead", "detail string").groupBy(F.col("detail").alias("what")).agg(n)
    return out[0].unionByName(out[1]).unionByName(out[2]).unionByName(dead.withColumn("sink", F.lit("dlq")))


@register("ohlcv_1m_stream")
def q_ohlcv_1m_stream(spark, sf_dir):
    """W-1 on a stream: watermarked 1-minute bars in append mode, read back."""
    from candlewick.streaming import ingest
    root, src = _stage_stream_input(spark, sf_dir, _end_marker(spark, sf_dir))
    events = ingest.landed_trades(ingest.trade_stream(spark, src, max_per_trigger=1))
    bars = ingest.ohlcv_stream(events)
    _replayed(spark, lambda: ingest.append_sink(bars, f"{root}/bars", f"{root}/ckpt", partition_by=(),
                                                trigger={"availableNow": True}))
    out = spark.read.parquet(f"{root}/bars").filter(F.col("symbol") != fx.END_MARKER_SYMBOL)
    return (out.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))
               .withColumn("window_end", F.col("window_end").cast("timestamp_ntz")))


def _corrections(spark, sf_dir) -> DataFrame:
    """Trades of the last day that come again after everything else, with another quantity."""
    t = fx.trade_records(spark, sf_dir)
    last = t.agg(F.max("trade_time")).scalar()
    return t.filter(F.col("trade_time") > last - 86_400_000).withColumn("quantity", F.col("quantity") + 1000)


@register("ohlcv_1m_corrected")
def q_ohlcv_1m_corrected(spark, sf_dir):
    """W-1 in update mode: bars are in the table from their first trade on, and trades that come late within the
    allowance (here two days) correct them there."""
    from candlewick.streaming import corrections, ingest
    root, src = _stage_stream_input(spark, sf_dir, _corrections(spark, sf_dir))
    bars = ingest.ohlcv_stream(ingest.landed_trades(ingest.trade_stream(spark, src, max_per_trigger=1)), delay="2 days")
    # A replayed file holds many days: the table is partitioned by the day here, by the hour for a live stream.
    _replayed(spark, lambda: corrections.merge_sink(bars, f"{root}/corrected", f"{root}/ckpt", unit="day",
                                                    trigger={"availableNow": True}))
    out = corrections.bars_table(spark, f"{root}/corrected", bars.schema)
    return (out.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))
               .withColumn("window_end", F.col("window_end").cast("timestamp_ntz")))


@register("stream_latency")
def q_stream_latency(spark, sf_dir):
    """M-2 + A-7 from the stream's own progress: the append stream's micro-batches, logged by a listener; the rows they
    took, and whether there were several and their percentiles are in order (the times themselves vary)."""
    from candlewick.streaming import ingest, progress
    root, src = _stage_stream_input(spark, sf_dir)
    with progress.ProgressLog(spark, f"{root}/progress") as log:
        landed = ingest.landed_trades(ingest.trade_stream(spark, src, max_per_trigger=1))
        q = ingest.append_sink(landed, f"{root}/lake", f"{root}/ckpt", partition_by=("date",), trigger={"availableNow": True})
        ingest.run_bounded(q, None)
        log.wait(q)
    batches = progress.progress_table(spark, f"{root}/progress")
    times = progress.batch_latency(batches, ())
    return times.select(batches.agg(F.sum("rows").alias("r")).scalar().alias("records"), (F.col("n") >= 4).alias("several"),
                        ((F.col("p50") > 0) & (F.col("p50") <= F.col("p95")) & (F.col("p95") <= F.col("p99"))).alias("in_order"))


@register("load_day")
def q_load_day(spark, sf_dir):
    """S-3 + P-8 + P-11 + K-7/K-8: the as-of day of the date-partitioned lake
    (partition pruning: only that day's files are listed and read), times
    converted from epoch millis, columns pinned, appended to ``raw.trades``."""
    from candlewick.functions.exprs import millis_to_ts
    from candlewick.operators import sinks
    from candlewick.plans.layers import ensure_schema
    from candlewick.schemas import RAW_TRADES_COLUMNS
    from candlewick.session import scratch_path
    from candlewick.sources.tables import trades_for_day
    root = scratch_path(spark, "load_day")
    lake = f"{root}/lake"
    sinks.spread_partitions(fx.lake_trades(spark, sf_dir), ["date"]).write.partitionBy("date").parquet(lake)
    day = (trades_for_day(spark, lake, AS_OF)
           .withColumn("trade_time", millis_to_ts("trade_time"))
           .withColumn("ingestion_ts", millis_to_ts("ingestion_ts")))
    name = f"{ensure_schema(spark, 'raw_load', root)}.trades"
    sinks.load_table(clean.pin_columns(day, RAW_TRADES_COLUMNS), name, mode="append")
    return spark.table(name)


@register("reload_days")
def q_reload_days(spark, sf_dir):
    """K-3 + K-7 in a catalog table: all days loaded, then the as-of day and the one before are
    deleted and the deduped as-of day is appended."""
    import datetime as _dt
    from candlewick.operators import sinks
    from candlewick.plans.layers import ensure_schema
    from candlewick.session import scratch_path
    raw = fx.raw_trades(spark, sf_dir)
    name = f"{ensure_schema(spark, 'raw_days', scratch_path(spark, 'reload'))}.trades"
    sinks.load_table(raw, name, mode="append", partition_by=["date"])
    reload = clean.dedupe_trades_latest(raw.filter(F.col("date") == F.lit(AS_OF)))
    sinks.replace_days_in_table(reload, name, [AS_OF, AS_OF - _dt.timedelta(days=1)])
    return spark.table(name)


@register("load_market_meta")
def q_load_market_meta(spark, sf_dir):
    """C-2 + P-8 + P-11 + K-7: lake metadata -> latest snapshot per coin -> raw table, overwritten."""
    from candlewick.plans import layers
    from candlewick.session import scratch_path
    return layers.load_market_meta(spark, fx.raw_meta_snapshots(spark, sf_dir), scratch_path(spark, "meta_load"))


@register("mart_layout")
def q_mart_layout(spark, sf_dir):
    """T-5: the daily mart written clustered by coin and day: per coin, in how many files it is (its
    key range is in one, or continues into the next) and how many rows it has."""
    from candlewick.operators import sinks
    from candlewick.session import scratch_path
    path = scratch_path(spark, "mart")
    sinks.write_mart(ohlcv(spark, sf_dir), path, ["coin_symbol", "trade_date"])
    files = spark.read.parquet(path).groupBy("coin_symbol", F.input_file_name().alias("file")).agg(
        F.count(F.lit(1)).alias("n"))
    return files.groupBy("coin_symbol").agg(F.sum("n").alias("n_rows"), (F.count(F.lit(1)) <= 2).alias("together"))


@register("mart_layout_interleaved")
def q_mart_layout_interleaved(spark, sf_dir):
    """T-5 on both keys: the daily mart in 64 files by the interleaved bits of coin and day; per column, the rows, and
    whether a filter on one of its ranges alone skips more than half of the files."""
    from candlewick.operators import sinks
    from candlewick.session import scratch_path
    path, keys = scratch_path(spark, "mart"), ["coin_symbol", "trade_date"]
    sinks.write_mart(ohlcv(spark, sf_dir), path, keys, num_partitions=64, layout="interleaved")
    mart, files = spark.read.parquet(path), sinks.file_ranges(spark, path, keys)
    out = None
    for c in keys:
        edges = sinks.range_edges(mart, c)
        low, high = (sinks.range_number(f"{c}_{end}", edges) for end in ("min", "max"))
        share = F.avg((high - low + 1) / F.lit(2 ** sinks.KEY_BITS))
        one = files.agg(F.sum("n_rows").alias("n_rows"), (share < 0.5).alias("skips_most")).withColumn("key", F.lit(c))
        out = one if out is None else out.unionByName(one)
    return out
