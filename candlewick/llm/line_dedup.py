"""Lines that many documents share, dropped from all documents but one.

Plan: texts -> one row for each line that is long enough (two 64-bit hashes of the normalised line, position; no
text) -> distinct (line, document) pairs -> documents per line -> the shared lines join the line rows -> dropped
positions of each text -> the texts, reassembled by position.

The pairs are shuffled by line *and* document, and counted per line after a partial aggregation, so that a line
of every document is no task's burden.  The join is cut the same way: a line with over a HOT-th of all line rows
goes into a broadcast table, which by that definition has at most HOT rows, and the others meet by their hash.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.llm.common import free_names, staged, staged_with

LEAST_CHARS = 20
LEAST_DOCS = 3
#: A line is hot with more than this fraction (one of HOT) of all line rows.
HOT = 1000
SPACE = b" \t\n\x0b\x0c\r"
LINES = "id bigint, t1 bigint, t2 bigint, pos int, h1 bigint, h2 bigint"


def line_key(line: bytes) -> bytes:
    """A line without ASCII white space at its ends, A-Z in lower case."""
    return line.strip(SPACE).lower()


def _line_batches(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        row, pos, digest = [], [], []
        for r, data in enumerate(b.column(3).cast(pa.binary()).to_pylist()):
            for at, line in enumerate((data or b"").split(b"\n")):
                key = line_key(line)
                if len(key) >= least and (len(key) >= 4 * least or len(key.decode("utf-8", "replace")) >= least):
                    row.append(r)
                    pos.append(at)
                    digest.append(xxhash.xxh3_128_digest(key))
        h = np.frombuffer(b"".join(digest), "<i8").reshape(-1, 2)
        own = [c.take(pa.array(row, pa.int64())) for c in b.columns[:3]]
        yield pa.RecordBatch.from_arrays(
            [*own, pa.array(pos, pa.int32()), pa.array(h[:, 0].copy()), pa.array(h[:, 1].copy())],
            names=["id", "t1", "t2", "pos", "h1", "h2"])


def _text_key(text: Column) -> list[Column]:
    return [F.xxhash64(text), F.xxhash64(F.lit(1), text)]


def line_rows(docs: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """``(id, t1, t2, pos, h1, h2)``: a row for every line whose key has ``least_chars`` code points; t1 and t2 are
    hashes of the whole text, h1 and h2 of the key."""
    text = F.col("text").cast("string")
    return (docs.select(F.col("doc_id").cast("bigint").alias("id"), *_text_key(text), text)
            .mapInArrow(partial(_line_batches, least=least_chars), LINES))


def shared_lines(lines: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """``(h1, h2, n_docs, n_rows, last)`` of the lines of at least ``least_docs`` documents; ``last`` is the largest
    document id that holds it."""
    pairs = lines.groupBy("h1", "h2", "id").agg(F.count(F.lit(1)).alias("n"))
    return (pairs.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("n").alias("n_rows"),
                                          F.max("id").alias("last"))
            .filter(F.col("n_docs") >= least_docs))


def dropped_positions(lines: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """``(id, t1, t2, dropped)``: the positions of the lines that each text loses."""
    lines, seen = staged_with(lines, "line-rows", n=F.count(F.lit(1)))
    shared = staged(shared_lines(lines, least_docs), "shared-lines")
    hot = F.col("n_rows") * HOT > (seen.get("n") or 0)
    key = ["h1", "h2"]
    by_hash = lines.join(F.broadcast(shared.filter(hot).select(*key, F.lit(True).alias("is_hot"))), key, "left_anti")
    gone = (by_hash.join(shared.filter(~hot).select(*key, "last"), key)
            .unionByName(lines.join(F.broadcast(shared.filter(hot).select(*key, "last")), key)))
    return (gone.filter("id IS NULL OR id < last").groupBy("id", "t1", "t2")
            .agg(F.collect_set("pos").alias("dropped")))


def _kept(text: Column, dropped: Column) -> Column:
    """The lines of ``text`` at other positions than ``dropped``, in order."""
    def joined(lines: Column) -> Column:
        left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), dropped)
        return F.array_join(F.transform(left, lambda i: F.get(lines, i)), "\n")
    return F.transform(F.array(F.split(text, "\n")), joined)[0]


def drop_shared_lines(docs: DataFrame, least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS) -> DataFrame:
    """``docs`` with ``text`` without the lines that it shares, and ``n_lines`` (before) and ``n_dropped``.

    A line is split off at \\n; its key is the line without ASCII white space at both ends, A-Z in lower case.
    Keys of at least ``least_chars`` code points found in at least ``least_docs`` documents lose all their lines but
    those of the largest doc_id that holds them.  Defined cases: null and empty texts are one empty line and come
    out empty; rows without a doc_id are one document, smaller than all others; rows that repeat a doc_id are one
    document, each answered for its own text; a text whose lines all go is empty; an empty table gives no rows;
    ``n_chars``, if there is one, is renewed; columns named n_lines or n_dropped are replaced, all others stay.
    """
    kept = docs.drop("n_lines", "n_dropped")
    k, t1, t2, cut = free_names(kept, "__id", "__t1", "__t2", "__dropped")
    text = F.col("text").cast("string")
    gone = dropped_positions(line_rows(docs, least_chars), least_docs)
    gone = gone.select(F.col("id").alias(k), F.col("t1").alias(t1), F.col("t2").alias(t2), F.col("dropped").alias(cut))
    h1, h2 = _text_key(text)
    same = F.col("doc_id").cast("bigint").eqNullSafe(gone[k]) & (h1 == gone[t1]) & (h2 == gone[t2])
    whole = F.coalesce(text, F.lit(""))
    out = kept.join(gone, same, "left").withColumns({
        "n_lines": F.size(F.split(whole, "\n")).cast("bigint"),
        "n_dropped": F.coalesce(F.size(cut), F.lit(0)).cast("bigint"),
        "text": F.when(F.col(cut).isNull(), whole).otherwise(_kept(whole, F.col(cut)))}).drop(k, t1, t2, cut)
    if "n_chars" in out.columns:
        kind = T.LongType() if not isinstance(docs.schema["n_chars"].dataType, T.NumericType) else docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.length("text").cast(kind))
    return out
