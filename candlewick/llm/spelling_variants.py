"""Spelling variants of a corpus' words, through an index of variable-length grams.

Plan: texts -> word counts (added up inside each task first) -> gram dictionary -> inverted lists -> candidate
pairs -> verified pairs -> each word's form -> roots.

* Dictionary: all grams of two letters; a gram of q letters is lengthened only if it is frequent, that is, if more
  than one of FREQUENT of all gram places hold it.  So there are at most FREQUENT frequent grams of a
  length, counted level by level; they are all that a task needs to know to decompose a word.
* Decomposition: at each place the longest dictionary gram, none inside the one before, none longer than half of
  the word.
* Lists to merge: one edit affects a gram only if it falls inside it.  A word's shortest lists are taken until
  there are more of them than one edit can affect; that is so as soon as two of them do not overlap, and
  these two are merged: a near word holds one of the two grams unchanged, at the same place or one
  further.  The first and the last gram of a word never overlap, so there are always two, for every word.
* A word is listed under all its dictionary grams with their place and its length.  Merging is an equi-join on (gram,
  place, length); the lists of frequent grams are cut into parts.  Candidates are verified by their edit distance.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import partial
from hashlib import sha256
from zlib import crc32

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.llm.common import staged, staged_with

LEAST_CHARS = 5
LEAST_COUNT = 3
#: A word's run is misspelt (one letter deleted) where this divides the hash of document and run.
DAMAGE = 97
LONGEST_GRAM = 6
FREQUENT = 4096
#: A list is cut so that no part holds more than one of PARTS of all gram places.
PARTS = 200
#: Places at either end of a word that its lists are taken from.
ENDS = 24
#: Words over this length are looked up by their digest until they are verified.
LONG = 64
#: Entries of a task's counter, and code points of the texts it stands for.
KEPT, HELD = 200_000, 1 << 27
SALTS = 8

_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))


def runs(text: str) -> list[bytes]:
    """Maximal runs of A-Z, a-z, U+00C0 to U+00FF, A-Z in lower case, in Latin-1 (a byte is a code point)."""
    return text.encode("latin-1", "replace").translate(_LETTERS).split()


def damaged(words: list[bytes], prefix: bytes) -> list[tuple[bytes, int]]:
    """(word, place of the letter to delete) for the distinct words whose hash DAMAGE divides."""
    start, out = crc32(prefix), []
    for w in set(words):
        if len(w) > LEAST_CHARS:
            h = crc32(w if w.isascii() else w.decode("latin-1").encode(), start)
            if not h % DAMAGE:
                out.append((w, h % len(w)))
        elif len(w) == LEAST_CHARS and not crc32(w if w.isascii() else w.decode("latin-1").encode(), start) % DAMAGE:
            out.append((w, 0))
    return out


def _counter_batch(counts: Counter) -> pa.RecordBatch:
    kept = [(w, n) for w, n in counts.items() if len(w) >= LEAST_CHARS and n]
    return pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w, _ in kept], pa.string()),
                                       pa.array([n for _, n in kept], pa.int64())], names=["word", "n"])


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts, held = Counter(), 0
    for b in batches:
        for key, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            if not text:
                continue
            words = runs(text)
            counts.update(words)
            held += len(text)
            odd = dict(damaged(words, f"{'' if key is None else key}:".encode()))
            if odd:
                for w, n in Counter(filter(odd.__contains__, words)).items():
                    counts[w] -= n
                    counts[w[:odd[w]] + w[odd[w] + 1:]] += n
            if len(counts) > KEPT or held > HELD:
                yield _counter_batch(counts)
                counts, held = Counter(), 0
    yield _counter_batch(counts)


def word_counts(docs: DataFrame, least_count: int = LEAST_COUNT) -> DataFrame:
    """``(word, n)``: the words of at least LEAST_CHARS code points that occur ``least_count`` times."""
    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return (rows.mapInArrow(_count_batches, "word string, n bigint")
            .groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count))


# --- gram dictionary -------------------------------------------------------------------

def places(length: int, ends: int) -> list[int]:
    """Places of a word of ``length`` letters where its grams may start: all, or ``ends`` at either end."""
    if length <= 2 * ends:
        return list(range(length - 1))
    return [*range(ends), *range(length - ends, length - 1)]


def _gram_batches(batches: Iterator[pa.RecordBatch], q: int, shorter) -> Iterator[pa.RecordBatch]:
    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
                                          names=["gram", "n"])
    counts, before = Counter(), shorter.value
    for b in batches:
        for w in b.column(0).to_pylist():
            counts.update([w[p:p + q] for p in places(len(w), ENDS)
                           if p + q <= len(w) and (q == 2 or w[p:p + q - 1] in before)])
        if len(counts) > KEPT:
            yield batch()
            counts = Counter()
    yield batch()


def frequent_grams(words: DataFrame, frequent: int = FREQUENT, longest: int = LONGEST_GRAM) -> tuple[dict[str, int], int]:
    """(frequent grams with their counts, all gram places): at most ``frequent`` grams of each length below
    ``longest``, whatever the number of words."""
    spark, out, total = words.sparkSession, {}, None
    for q in range(2, longest):
        before = spark.sparkContext.broadcast(frozenset(g for g in out if len(g) == q - 1))
        grams = (words.select("word").mapInArrow(partial(_gram_batches, q=q, shorter=before), "gram string, n bigint")
                 .groupBy("gram").agg(F.sum("n").alias("n")))
        if total is None:
            grams, seen = staged_with(grams, "grams", total=F.sum("n"))
            total = seen.get("total") or 0
        new = {r.gram: r.n for r in grams.filter(F.col("n") * frequent > total).collect()}
        if not new:
            break
        out.update(new)
    return out, total or 0


class Dictionary:
    """Variable-length grams: every gram of two letters, and every frequent gram with one more letter."""

    def __init__(self, frequent: dict[str, int], total: int, longest: int = LONGEST_GRAM):
        self.frequent, self.total, self.longest = frequent, max(total, 1), longest

    def gram_end(self, word: str, p: int, most: int) -> int:
        """End of the longest dictionary gram at ``p`` of at most ``most`` letters."""
        e = p + 2
        while e - p < most and e < len(word) and word[p:e] in self.frequent:
            e += 1
        return e

    def decompose(self, word: str) -> list[tuple[int, int]]:
        """(start, end) of the word's variable grams."""
        most, end, out = min(self.longest, len(word) // 2), 0, []
        for p in places(len(word), ENDS):
            e = self.gram_end(word, p, most)
            if e > end:
                out.append((p, e))
                end = e
        return out

    def size(self, gram: str) -> tuple[int, int]:
        """Order of lists by their length: unknown (not frequent) ones first, longer grams before shorter ones."""
        return self.frequent.get(gram, 0), -len(gram)

    def merged(self, word: str) -> list[tuple[int, int]]:
        """The lists to merge: of the shortest, the first two grams that one edit cannot both affect."""
        taken: list[tuple[int, int]] = []
        for p, e in sorted(self.decompose(word), key=lambda g: (self.size(word[g[0]:g[1]]), g)):
            for p0, e0 in taken:
                if e0 <= p or e <= p0:
                    return [(p0, e0), (p, e)]
            taken.append((p, e))
        raise ValueError(f"all grams of {word!r} overlap")

    def parts(self, gram: str) -> int:
        return 1 + self.frequent.get(gram, 0) * PARTS // self.total

    def listed(self, word: str) -> Iterator[str]:
        """Keys of the lists that hold the word."""
        n, own = len(word), crc32(word.encode())
        for p in places(n, ENDS + 1):
            e = p + 2
            while True:
                g = word[p:e]
                k = self.parts(g)
                yield f"{g} {p} {n} {own % k}"
                if e - p >= self.longest or e >= n or g not in self.frequent:
                    break
                e += 1

    def wanted(self, word: str) -> Iterator[str]:
        """Keys of the lists with the near words of equal length, or one letter longer."""
        n = len(word)
        for p, e in self.merged(word):
            g = word[p:e]
            for salt in range(self.parts(g)):
                yield f"{g} {p} {n} {salt}"
                yield f"{g} {p} {n + 1} {salt}"
                yield f"{g} {p + 1} {n + 1} {salt}"


def reference(word: str) -> str:
    """The word, or the digest of a long one (no word holds a #)."""
    return word if len(word) <= LONG else "#" + sha256(word.encode()).hexdigest()


def _list_batches(batches: Iterator[pa.RecordBatch], sent, wanted: bool) -> Iterator[pa.RecordBatch]:
    dictionary = Dictionary(*sent.value)
    keys_of = dictionary.wanted if wanted else dictionary.listed
    for b in batches:
        key, size = [], []
        words = b.column(0).to_pylist()
        for w in words:
            got = [xxhash.xxh64_intdigest(k) for k in keys_of(w)]
            key += got
            size.append(len(got))
        row = pa.array(np.repeat(np.arange(len(words)), size))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.array(key, np.uint64).view(np.int64)), pa.array([reference(w) for w in words], pa.string()).take(row),
             pa.array([len(w) for w in words], pa.int32()).take(row), b.column(1).take(row)],
            names=["key", "word", "size", "n"])


def _lists(words: DataFrame, sent, wanted: bool) -> DataFrame:
    return words.select("word", "n").mapInArrow(partial(_list_batches, sent=sent, wanted=wanted),
                                                "key bigint, word string, size int, n bigint")


def near_pairs(words: DataFrame) -> DataFrame:
    """``(a, na, b, nb)``: every two words of ``words(word, n)`` (distinct, at least 4 letters) that differ by exactly
    one inserted, deleted or replaced code point, once (a is the shorter one, or the smaller of two as long)."""
    sent = words.sparkSession.sparkContext.broadcast(frequent_grams(words))
    ask = _lists(words, sent, True).toDF("key", "a", "size_a", "na")
    have = _lists(words, sent, False).toDF("key", "b", "size_b", "nb")
    is_long = lambda *c: F.concat(*c).contains("#")
    one = lambda a, b: F.levenshtein(a, b, 1) == 1
    once = (F.col("size_a") < F.col("size_b")) | (F.col("a") < F.col("b")) | is_long("a", "b")
    found = ask.join(have, "key").filter((F.col("a") != F.col("b")) & once & (is_long("a", "b") | one("a", "b")))
    found = staged(found.select("a", "na", "b", "nb").distinct(), "near-words")
    long = words.filter(F.length("word") > LONG).select(
        F.concat(F.lit("#"), F.sha2(F.col("word").cast("binary"), 256)).alias("ref"), "word")
    far = found.filter(is_long("a", "b"))
    for c in ("a", "b"):
        far = (far.join(long.select(F.col("ref").alias(c), F.col("word").alias("whole")), c, "left")
               .withColumn(c, F.coalesce("whole", c)).drop("whole"))
    far = far.filter(one("a", "b") & ((F.length("a") < F.length("b")) | (F.col("a") < F.col("b"))))
    return found.filter(~is_long("a", "b")).unionByName(far.select("a", "na", "b", "nb"))


def _roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` of ``forms(word, form)``: pointers are doubled until none moves; a root that many words
    reach meets them in SALTS parts."""
    cur, left = staged(forms.select("word", F.col("form").alias("root")), "roots"), 1
    while left:
        salt = F.pmod(F.xxhash64("word"), F.lit(SALTS))
        ahead = cur.select(F.col("word").alias("root"), F.col("root").alias("further"),
                           F.explode(F.expr(f"sequence(0L, {SALTS - 1}L)")).alias("salt"))
        step = cur.withColumn("salt", salt).join(ahead, ["root", "salt"], "left")
        cur, seen = staged_with(step.select("word", F.coalesce("further", "root").alias("root"), "further"), "roots",
                                moved=F.count("further"))
        cur, left = cur.select("word", "root"), seen.get("moved")
    return cur


def spelling_variants(docs: DataFrame, least_count: int = LEAST_COUNT) -> DataFrame:
    """Words of ``docs(doc_id, text)`` with the form they are a variant of: ``word, form, root, n, n_near, form_n``.

    Words are lower-case runs of letters (see :func:`runs`) of at least LEAST_CHARS code points and ``least_count``
    occurrences; a run is misspelt where :func:`damaged` says so.  Words are near if one inserted, deleted or replaced
    code point leads from one to the other.  A word's form is its near word of largest n (ties: smallest in code-point
    order) if that n is at least twice its own, else null; its root is where forms lead to.  Defined cases: null and
    empty texts have no words; a null doc_id is the empty text in the hash; repeated rows count each; words of any
    length are compared whole; an empty table gives no rows; other columns are ignored.
    """
    words = staged(word_counts(docs, least_count), "words")
    pairs = staged(near_pairs(words), "near-pairs")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("nb").alias("m")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("na").alias("m")))
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"),
                                    F.min(F.struct((-F.col("m")).alias("m"), "near")).alias("best"))
    is_form: Column = -F.col("best.m") >= 2 * F.col("n")
    named = staged(words.join(best, "word", "left").select(
        "word", F.when(is_form, F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(is_form, -F.col("best.m")).alias("form_n")), "word-forms")
    roots = _roots(named.filter("form IS NOT NULL"))
    return named.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
