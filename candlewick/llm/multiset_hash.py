"""Homomorphic multiset fingerprints of documents, in DataFrame functions only.

A document is a multiset of paragraphs (its non-empty lines).  Every paragraph hashes to one wide vector,
and the document's vector is their sum, lane by lane, modulo powers of two:

* 16 *equality* lanes modulo 2**32: the SHA-512 of the paragraph, cut into 16 numbers;
* levels of 128 *likeness* lanes modulo 2**16: each sentence of the paragraph adds a number, hashed from it,
  to one lane of one level, both chosen by its hash; half of all sentences belong to level 0, a quarter to
  level 1, and so on (levels after the last one in use are left out).

So the order of paragraphs does not matter, a paragraph is inserted by adding its vector and deleted by
subtracting it, and two documents are equal as multisets when all lanes are.  A change of few
sentences touches few likeness lanes.  The levels from l on, added up, hold a sample of 1 / 2**l of the
sentences; the likeness is the share of used lanes that agree in the largest sample that uses at most half of
the lanes, so that it is graded at any length.

Everything is one projection of a row (higher-order functions): no shuffle, no group.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.llm.common import staged

EQUAL_LANES, EQUAL_BITS = 16, 32
ROWS, PER_ROW, LIKE_BITS = 16, 8, 16
LANES = ROWS * PER_ROW
#: Lanes in use beyond which a sample is too large to compare.
SATURATED = LANES // 2
SENTENCE_END = r"(?<=[.!?:;])\s+"


def _cut(x: Column, at: int, bits: int) -> Column:
    return F.shiftrightunsigned(x, at).bitwiseAND(F.lit((1 << bits) - 1).cast("bigint"))


def paragraphs(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda p: p != "")


def equality_vector(parts: Column) -> Column:
    """Sum of the paragraphs' SHA-512 numbers, array<bigint> of EQUAL_LANES."""
    zero = F.array_repeat(F.lit(0).cast("bigint"), EQUAL_LANES)
    lanes = F.sequence(F.lit(0), F.lit(EQUAL_LANES - 1))
    number = lambda h, i: F.conv(F.substr(h, i * 8 + 1, F.lit(8)), 16, 10).cast("bigint")
    full = F.lit((1 << EQUAL_BITS) - 1).cast("bigint")
    return F.aggregate(F.transform(parts, lambda p: F.sha2(p.cast("binary"), 512)), zero,
                       lambda acc, h: F.zip_with(acc, lanes, lambda a, i: (a + number(h, i)).bitwiseAND(full)))


def _level(h: Column) -> Column:
    """Trailing zeros of the hash's bits from 31 on."""
    x = F.shiftrightunsigned(h, 31).bitwiseOR(F.lit(1 << 33))
    return F.bit_count(x.bitwiseAND(-x) - 1)


def _once(x: Column, f: Callable[[Column], Column]) -> Column:
    """f(x), with x worked out once."""
    return F.transform(F.array(x), f)[0]


def _trimmed(like: Column) -> Column:
    """Without the levels after the last one in use; at least one."""
    last = F.array_max(F.transform(like, lambda v, i: F.when(v != 0, i)))
    return F.slice(like, 1, (F.floor(F.coalesce(last, F.lit(0)) / LANES).cast("int") + 1) * LANES)


def sentences(parts: Column) -> Column:
    return F.flatten(F.transform(parts, lambda p: F.split(p, SENTENCE_END)))


def likeness_vector(said: Column) -> Column:
    """Sum of the sentences' numbers in their lanes, array<int> of LANES for each level."""
    hashes = F.transform(said, lambda s: F.xxhash64(s))
    zero = F.array_repeat(F.array_repeat(F.lit(0).cast("bigint"), PER_ROW), ROWS)
    value = lambda h: _cut(h, 16, LIKE_BITS - 1) * 2 + 1  # noqa: E731  never 0
    full = F.lit((1 << LIKE_BITS) - 1).cast("bigint")

    def add(acc: Column, h: Column) -> Column:
        return F.transform(acc, lambda row, i: F.when(
            _cut(h, 0, 4) == i, F.transform(row, lambda v, j: F.when(
                _cut(h, 4, 3) == j, (v + value(h)).bitwiseAND(full)).otherwise(v))).otherwise(row))

    def levels(all_: Column) -> Column:
        top = F.coalesce(F.array_max(F.transform(all_, _level)), F.lit(0))
        return F.flatten(F.transform(F.sequence(F.lit(0), top), lambda n: F.flatten(
            F.aggregate(F.filter(all_, lambda h: _level(h) == n), zero, add))))

    return _once(F.transform(_once(hashes, levels), lambda v: v.cast("int")), _trimmed)


def vector(text: Column) -> Column:
    """struct<equal:array<bigint>, like:array<int>> of a text (null: empty, all lanes 0)."""
    parts = paragraphs(text)
    return F.struct(equality_vector(parts).alias("equal"), likeness_vector(sentences(parts)).alias("like"))


def combined(a: Column, b: Column, sign: int = 1) -> Column:
    """Vector of the paragraphs of ``a`` and ``b`` together; sign -1: of ``a`` without those of ``b``."""
    return F.struct(
        F.zip_with(a["equal"], b["equal"], lambda x, y: F.pmod(x + sign * y, F.lit(1 << EQUAL_BITS))).alias("equal"),
        _once(F.zip_with(a["like"], b["like"], lambda x, y: F.pmod(
            F.coalesce(x, F.lit(0)) + sign * F.coalesce(y, F.lit(0)), F.lit(1 << LIKE_BITS))), _trimmed).alias("like"))


def _added(acc: Column, like: Column, n: Column) -> Column:
    """``acc`` and level ``n`` of ``like`` (none: zeros), lane by lane."""
    return F.zip_with(acc, F.slice(like, n * LANES + 1, LANES), lambda x, y: (x + F.coalesce(y, F.lit(0))).bitwiseAND(
        F.lit((1 << LIKE_BITS) - 1)))


def _downwards(size: Column) -> Column:
    """Numbers of the levels of a vector of ``size`` likeness lanes, the last one first."""
    return F.sequence(F.floor(size / LANES).cast("int") - 1, F.lit(0), F.lit(-1))


def fingerprint(v: Column) -> Column:
    """The vector as lower-case hex digits: its equality lanes, then its likeness lanes, level by level."""
    hexed = lambda lanes, n: F.array_join(
        F.transform(lanes, lambda x: F.lpad(F.lower(F.hex(x)), n, "0")), "")
    return F.concat(hexed(v["equal"], EQUAL_BITS // 4), hexed(v["like"], LIKE_BITS // 4))


def with_end_replaced(v: Column, head: Column, old: Column, new: Column) -> Column:
    """Vector of ``head + new``, from the vector ``v`` of ``head + old``: what the old end adds is deleted and
    what the new one adds is inserted.  Paragraphs that end in ``head`` are not hashed again, nor are the
    sentences that end in it."""
    open_ = F.substring_index(head, "\n", -1)

    def end(tail: Column) -> Column:
        parts = paragraphs(F.concat(open_, tail))
        kept = F.size(F.split(open_, SENTENCE_END))  # the last one may go on
        later = _once(sentences(parts), lambda said: F.slice(said, kept, F.greatest(F.size(said) - kept + 1, F.lit(0))))
        return F.struct(equality_vector(parts).alias("equal"), likeness_vector(later).alias("like"))

    return combined(combined(v, end(old), -1), end(new))


def likeness(a: Column, b: Column) -> Column:
    """1 for equal vectors, else the share of likeness lanes in use that agree (below 1), of the levels from
    the first on with which no more than SATURATED lanes are in use."""
    zero = F.array_repeat(F.lit(0), LANES)
    start = F.struct(zero.alias("x"), zero.alias("y"), F.lit(0.0).alias("near"))

    def step(acc: Column, n: Column) -> Column:
        x, y = _added(acc["x"], a["like"], n), _added(acc["y"], b["like"], n)
        return F.transform(F.array(F.struct(x.alias("x"), y.alias("y"))), lambda s: F.struct(
            s["x"].alias("x"), s["y"].alias("y"), shared(s["x"], s["y"], acc["near"]).alias("near")))[0]

    def shared(x: Column, y: Column, before: Column) -> Column:
        # 1: a lane that differs, 2: one that agrees, 0: not in use
        marks = F.zip_with(x, y, lambda p, q: F.when(p != q, 1).when(p != 0, 2).otherwise(0))
        return F.transform(F.array(F.filter(marks, lambda m: m > 0)), lambda used: F.when(
            (F.size(used) <= SATURATED) & (F.size(used) > 0),
            F.size(F.filter(used, lambda m: m == 2)) / F.size(used)).otherwise(before))[0]

    near = F.aggregate(_downwards(F.greatest(F.size(a["like"]), F.size(b["like"]))), start, step)["near"]
    return F.when(a["equal"] == b["equal"], 1.0).otherwise(F.least(near, F.lit(0.999)))


def neighbours(ids: DataFrame) -> DataFrame:
    """``ids(k, ...)`` of distinct k with ``next``: the next smaller k, after the last the largest.

    Ids are dealt into ranges; within a range it is a window, and the ranges' largest ids (one row
    each) lead from range to range: no task sees all ids.
    """
    spark = ids.sparkSession
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = staged(ids.repartitionByRange(parts, F.col("k").desc())
                   .withColumn("part", F.spark_partition_id()), "ids-in-ranges")
    tops = dealt.groupBy("part").agg(F.max("k").alias("top"))
    whole = Window.orderBy("part")
    tops = tops.select("part", F.lead("top").over(whole).alias("after"),
                       F.first("top").over(whole.rowsBetween(Window.unboundedPreceding, 0)).alias("first"))
    inside = Window.partitionBy("part").orderBy(F.col("k").desc())
    return (dealt.withColumn("next", F.lead("k").over(inside)).join(F.broadcast(tops), "part")
            .withColumn("next", F.coalesce("next", "after", "first")).drop("part", "after", "first"))


def edited_documents(docs: DataFrame) -> DataFrame:
    """Each document's fingerprint, that of its edited text, and their likenesses.

    The edited text has the last third (floor) of the code points replaced by the first as many (or
    all) of the next document, by descending doc_id.  Columns: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next.  Defined cases: a null text is empty; an empty text has the zero
    vector; a null doc_id comes after all others; repeated rows are answered each, share one
    place in the order, and as someone's next document the one with the smallest prefix is taken;
    a single document is its own next; an empty table gives no rows; other columns are ignored.
    """
    least = F.lit(-(1 << 63)).cast("bigint")
    own = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), least).alias("k"),
                      F.col("doc_id").cast("bigint").alias("doc_id"),
                      F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    third = F.floor(F.length("text") / 3).cast("int")
    ids = neighbours(own.groupBy("k").agg(F.max(third).alias("need")))
    full = own.withColumn("v", vector(F.col("text")))
    asked = ids.select(F.col("next").alias("k"), F.col("k").alias("asker"), "need")
    sent = (full.join(asked, "k").select(
        "asker", F.struct(F.substring("text", F.lit(1), F.col("need")).alias("prefix"),
                          F.sha2(F.col("text").cast("binary"), 256).alias("sha"), "v", "doc_id").alias("n"))
        .groupBy(F.col("asker").alias("k")).agg(F.min("n").alias("n")))
    both = (full.join(sent, "k").withColumn("third", third)
            .withColumn("head", F.substring("text", F.lit(1), F.length("text") - F.col("third")))
            .withColumn("new", F.substring("n.prefix", F.lit(1), F.col("third"))))
    both = both.withColumn("e", with_end_replaced(
        F.col("v"), F.col("head"), F.substring("text", F.length("head") + 1, F.col("third")), F.col("new")))
    return both.select(
        "doc_id", F.length("text").cast("bigint").alias("n_chars"),
        F.sha2(F.concat("head", "new").cast("binary"), 256).alias("edited_sha256"),
        fingerprint(F.col("v")).alias("fingerprint"), fingerprint(F.col("e")).alias("edited_fingerprint"),
        likeness(F.col("v"), F.col("e")).alias("near_edited"), likeness(F.col("v"), F.col("n.v")).alias("near_next"))
