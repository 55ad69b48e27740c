"""Global rank at both ends without a single-partition sort of the input (F-5, T-1).

``rank() over (order by v desc) <= k or rank() over (order by v asc) <= k`` over
a whole table puts every row in one task.  Ranks are a function of the value:
``desc_rank(v) = 1 + #(rows > v)``, ``asc_rank(v) = 1 + #(rows < v)``.  So:

1. distinct values with their row counts (hash aggregate);
2. the ``k`` largest / smallest distinct values (``row_number <= k``: Catalyst's
   partial ``WindowGroupLimit`` leaves at most ``k`` rows per task);
3. running sums over those <= k rows give the rank on that side; the other side's
   rank is ``N + 2 - rank - ties(v)`` with ``N`` a scalar subquery;
4. the <= 2k ranked values are broadcast (bound proven by ``k``) and joined back.

Null is treated as the largest value (first when descending, last when
ascending), as the reference warehouse does.  The set of rows returned is
exactly the rows of rank <= k at either end, ties included, however many.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _side(vals: DataFrame, v: str, k: int, descending: bool, total) -> DataFrame:
    o = F.col(v).desc_nulls_first() if descending else F.col(v).asc_nulls_last()
    w = Window.orderBy(o)
    top = (vals.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= k)
               .drop("_rn"))
    run = F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1))
    this = (F.coalesce(run, F.lit(0)) + 1).cast("bigint")
    other = (total + 2 - F.col("_this") - F.col("_n")).cast("bigint")
    ranked = top.withColumn("_this", this).filter(F.col("_this") <= k)
    if descending:
        return ranked.select(v, F.col("_this").alias("_desc"), other.alias("_asc"))
    return ranked.select(v, other.alias("_desc"), F.col("_this").alias("_asc"))


def rank_both_ends(df: DataFrame, value_col: str, k: int,
                   desc_rank: str = "desc_rank", asc_rank: str = "asc_rank",
                   method: str = "distributed") -> DataFrame:
    """Rows whose descending or ascending ``rank()`` of ``value_col`` is <= ``k``,
    with both ranks as BIGINT columns."""
    if method == "window":
        gd = F.rank().over(Window.orderBy(F.col(value_col).desc_nulls_first()))
        ga = F.rank().over(Window.orderBy(F.col(value_col).asc_nulls_last()))
        out = df.withColumn(desc_rank, gd.cast("bigint")).withColumn(asc_rank, ga.cast("bigint"))
        return out.filter((F.col(desc_rank) <= k) | (F.col(asc_rank) <= k))
    v = "_v"
    keyed = df.withColumn(v, F.col(value_col))
    vals = keyed.groupBy(v).agg(F.count(F.lit(1)).alias("_n"))
    total = df.agg(F.count(F.lit(1))).scalar()
    ranks = (_side(vals, v, k, True, total).unionByName(_side(vals, v, k, False, total))
             .dropDuplicates([v]))
    ranks = F.broadcast(ranks.withColumnRenamed(v, "_rv"))   # <= 2k rows
    out = keyed.join(ranks, keyed[v].eqNullSafe(ranks["_rv"]), "inner")
    return (out.withColumnRenamed("_desc", desc_rank).withColumnRenamed("_asc", asc_rank)
               .drop(v, "_rv"))
