"""Trade enrichment with coin metadata (J-1)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.operators.clean import latest_by

ENRICHED_COLUMNS = [
    "coin_symbol", "price", "quantity", "trade_timestamp", "trade_date", "is_buyer_maker",
    "ingestion_ts", "trade_value_usd", "coin_id", "coin_name", "market_cap", "market_cap_rank",
    "circulating_supply", "latest_price", "price_change_pct_24h", "meta_ingested_at",
]


def meta_for_join(meta: DataFrame, on_collision: str = "fanout") -> DataFrame:
    """Metadata keyed by upper-cased symbol.

    ``fanout`` (reference): every metadata row of a symbol matches, so a symbol
    owned by two coins duplicates trades.  ``largest_cap``: one row per symbol,
    the coin with the largest market cap.
    """
    m = meta.withColumn("_msym", F.upper("symbol"))
    if on_collision == "largest_cap":
        m = latest_by(m, ["_msym"], ["market_cap", "coin_id"], ties="one")
    elif on_collision != "fanout":
        raise ValueError(f"unknown on_collision {on_collision!r}")
    return m


#: Salts of a symbol that holds all trades, per shuffle partition: enough that their random places are even.
SPREAD = 16
#: Most symbols that are measured as heavy (bounds the sketch and what is broadcast).
MOST_HEAVY = 10_000


def heavy_symbols(trades: DataFrame, tasks: int) -> DataFrame:
    """``_heavy``, ``_salts``: the symbols that hold more than half a task's share of the trades, and into how many parts
    each is cut.  One pass over the symbols alone, by a frequent-items sketch (it lists every symbol above its
    error, which is far below that share), whose size and result do not grow with the data: at most two symbols
    per task can be so heavy."""
    k = min(2 * tasks, MOST_HEAVY)
    seen = trades.select(F.upper("coin_symbol").alias("s")).filter("s IS NOT NULL").agg(
        F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(s, {k}, {8 * k})").alias("top")).first()
    share = [(t["item"], t["count"] / seen["n"]) for t in seen["top"] or []]
    heavy = [(s, max(2, round(x * SPREAD * tasks))) for s, x in share if x > 1 / k]
    return trades.sparkSession.createDataFrame(heavy, "_heavy string, _salts int")


def salted(trades: DataFrame, meta: DataFrame, tasks: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``_salt``, such that a trade meets each metadata row of its symbol once, and the trades of a heavy
    symbol are spread: they are dealt to the symbol's salts by a hash of their own values (so a repeated task deals
    alike; trades equal in all of them stay together), and its metadata rows are replicated to all of them: at most
    ``SPREAD`` times the tasks for all symbols together.  Trades without a symbol match nothing, and are spread too."""
    tasks = tasks or int(trades.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    heavy = F.broadcast(heavy_symbols(trades, tasks))  # at most two rows per task
    sym = F.upper(F.col("coin_symbol"))
    salts = F.when(sym.isNull(), F.lit(SPREAD * tasks)).otherwise(F.coalesce("_salts", F.lit(1)))
    own = F.xxhash64("trade_timestamp", "price", "quantity", "is_buyer_maker", "ingestion_ts")
    left = (trades.join(heavy, sym == F.col("_heavy"), "left")
                  .withColumn("_salt", F.pmod(own, salts).cast("int")).drop("_heavy", "_salts"))
    right = (meta.join(heavy, meta["_msym"] == F.col("_heavy"), "left")
                 .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)))
                 .drop("_heavy", "_salts"))
    return left, right


def _same_symbol(trades: DataFrame, m: DataFrame) -> Column:
    return F.upper(trades["coin_symbol"]) == m["_msym"]


def trades_with_meta(trades: DataFrame, meta: DataFrame, on_collision: str = "fanout", method: str = "join",
                     tasks: int | None = None) -> DataFrame:
    """Left equi-join of staged trades with staged metadata on
    ``upper(coin_symbol) = upper(symbol)`` plus ``trade_value_usd = price * quantity``.

    No hint: by the sizes known at run time, Spark broadcasts a small metadata side
    (the trades are then not shuffled) or joins by sort-merge with skewed symbols split.

    ``method="salted"`` is for metadata too large to broadcast: a sort-merge join on (symbol, salt), see
    :func:`salted`.  It is even whatever the engine's thresholds for skewed partitions are, for one more pass over the
    symbols.  ``tasks``: the shuffle partitions to be even over (default: the session's).
    """
    if method not in ("join", "salted"):
        raise ValueError(f"unknown method {method!r}")
    m = meta_for_join(meta, on_collision).select(
        "_msym", "coin_id", F.col("name").alias("coin_name"), "market_cap", "market_cap_rank",
        "circulating_supply", F.col("current_price").alias("latest_price"),
        "price_change_pct_24h", F.col("ingested_at").alias("meta_ingested_at"))
    if method == "salted":
        trades, m = salted(trades, m, tasks)
        j = trades.join(m.hint("merge"), _same_symbol(trades, m) & (trades["_salt"] == m["_salt"]), "left")
    else:
        j = trades.join(m, _same_symbol(trades, m), "left")
    return j.select(
        "coin_symbol", "price", "quantity", "trade_timestamp", "trade_date", "is_buyer_maker",
        "ingestion_ts", (F.col("price") * F.col("quantity")).alias("trade_value_usd"),
        "coin_id", "coin_name", "market_cap", "market_cap_rank", "circulating_supply",
        "latest_price", "price_change_pct_24h", "meta_ingested_at")
