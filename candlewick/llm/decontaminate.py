"""Benchmark decontamination: rare word n-grams as seeds, Smith-Waterman as the judge.

The benchmark is the query set.  It is handled in blocks of a bounded number of words, each of
which is small enough to broadcast; a larger benchmark means more blocks, never a larger one.
For each block the corpus is read twice, in Arrow batches and without a shuffle of texts:

1. count every n-gram and every word of the block in all documents (a sum each, partial in each task);
2. take as seeds the rarest share of each item's grams, and its rarest words, find them in the documents and
   align the item with the words around the seeds.

Rarity is relative to the item, so an item that was copied a million times keeps its seeds.  Seeds are word pairs: an
alignment of at least half a perfect copy's score has at most a third of the words replaced or dropped, which
leaves n / 3 - 1 pairs of n words intact; all but a quarter of the pairs are seeds, so from ten words on one of them
is.  Words pushed in between can break every pair and still leave that score; the single words find those.
A pair of item and document is dropped only by a bound of its whole score: the words it shares.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.llm.common import free_names, staged

SEED_WORDS = 2
#: Share of an item's grams, rarest first (ties included), that are seeds.
SEED_SHARE = 0.75
#: Share of an item's words, rarest first, that are seeds of their own (two of them must meet), and the words
#: an item needs for that: a word or two of a short one say nothing.
WORD_SHARE, WORD_SEEDS_FROM = 0.25, 10
MATCH, MISMATCH, GAP = 2, -1, -1
#: Alignment score over that of a perfect copy, from which a document holds the item.
MIN_SCORE = 0.5
#: Words of benchmark text handled (collected, broadcast) at once.
BLOCK_WORDS = 1 << 20

WORD = re.compile(r"\w+")
PAIRS = "doc_id bigint, item_id bigint, score double, seeds bigint, key bigint"


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def align(item: np.ndarray, window: np.ndarray) -> int:
    """Best Smith-Waterman score of two arrays of word numbers (linear gaps), one row of the
    matrix at a time."""
    if not len(window):
        return 0
    ramp = -GAP * np.arange(len(window) + 1)
    row, best = np.zeros(len(window) + 1, np.int64), 0
    for word in item:
        new = np.maximum(row + GAP, 0)
        np.maximum(new[1:], row[:-1] + np.where(window == word, MATCH, MISMATCH), out=new[1:])
        row = np.maximum.accumulate(new + ramp) - ramp
        best = max(best, int(row.max()))
    return best


class Block:
    """Items of a benchmark block, with their n-grams and words as sorted integer keys.

    Word numbers start at 1; 0 is a word the block does not have, and no gram holds it.  An item
    of fewer than ``n`` words is one gram of all its words.
    """

    def __init__(self, items: list[tuple[int, str]], n: int = SEED_WORDS):
        self.vocab: dict[str, int] = {}
        self.pieces: list[tuple[int, np.ndarray]] = []
        self.length: Counter = Counter()
        for item, text in items:
            ids = np.array([self.vocab.setdefault(w, len(self.vocab) + 1) for w in words_of(text)], np.int64)
            if len(ids) and self.pieces and self.pieces[-1][0] == item:  # items come sorted: their texts in a row
                self.pieces[-1] = item, np.concatenate([self.pieces[-1][1], ids])
            elif len(ids):
                self.pieces.append((item, ids))
            self.length[item] += len(ids)
        self.base = len(self.vocab) + 1
        #: all pieces' words in a row, where each piece starts, and a mark for each word
        self.sizes = np.array([len(ids) for _, ids in self.pieces], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.flat = np.concatenate([ids for _, ids in self.pieces] or [np.zeros(0, np.int64)])
        self.seen = np.zeros(self.base, bool)
        if self.base ** n >= 1 << 63:
            raise ValueError(f"grams of {n} words of a block of {self.base} do not fit: take fewer, or smaller blocks")
        self.n = n
        grams: dict[int, list[tuple[int, int, int]]] = {}
        for p, (_, ids) in enumerate(self.pieces):
            for k in {1, n} if len(ids) >= max(n, WORD_SEEDS_FROM) else {min(n, len(ids))}:
                key = self.keys(ids, k)
                grams.setdefault(k, []).extend((x, p, i) for i, x in enumerate(key.tolist()))
        #: by gram length: sorted keys, and the (key number, piece, position) of each occurrence
        self.grams: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for k, rows in grams.items():
            at = np.array(sorted(rows), np.int64).reshape(-1, 3)
            keys, number = np.unique(at[:, 0], return_inverse=True)
            self.grams[k] = keys, np.column_stack([number, at[:, 1:]])

    def keys(self, ids: np.ndarray, k: int) -> np.ndarray:
        """Keys of all k-grams of ``ids`` (0 where a word is unknown)."""
        m = max(0, len(ids) - k + 1)
        key, known = np.zeros(m, np.int64), np.ones(m, bool)
        for j in range(k):
            part = ids[j:j + m]
            key = key * self.base + part
            known &= part > 0
        return np.where(known, key, 0)

    def find(self, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(position, key number) of every k-gram of ``ids`` that the block has."""
        keys = self.grams[k][0]
        own = self.keys(ids, k)
        at = np.flatnonzero(own)
        num = np.searchsorted(keys, own[at])
        hit = keys[np.minimum(num, len(keys) - 1)] == own[at]
        return at[hit], num[hit]

    def rare(self, counts: dict[int, np.ndarray], share: float, word_share: float = WORD_SHARE) -> None:
        """Keep as seeds the grams of each item whose corpus count is within its rarest share (ties
        included), and its rarest words (at least two; of ties, the first)."""
        self.seeds = {}
        for k, (keys, at) in self.grams.items():
            n = counts[k][at[:, 0]]
            keep = np.zeros(len(at), bool)
            order = np.lexsort([at[:, 2], n, at[:, 1]])
            for own in np.split(order, np.flatnonzero(np.diff(at[order, 1])) + 1):
                if k < min(self.n, len(self.pieces[at[own[0], 1]][1])):
                    keep[own[:max(2, int(word_share * len(own)))]] = True
                else:
                    most = n[own[max(0, int(np.ceil(share * len(own))) - 1)]]
                    keep[own] = n[own] <= most
            at = at[keep]
            start = np.searchsorted(at[:, 0], np.arange(len(keys) + 1))
            self.seeds[k] = at, start

    def hits(self, pos: np.ndarray, num: np.ndarray, k: int) -> np.ndarray:
        """(position, piece, place in the piece, k) for every seed that the k-grams ``num`` at ``pos`` are, as rows."""
        at, start = self.seeds[k]
        many = start[num + 1] - start[num]
        row = np.repeat(start[num] - (np.cumsum(many) - many), many) + np.arange(many.sum())
        return np.column_stack([np.repeat(pos, many), at[row, 1:], np.full(len(row), k)])

    def candidates(self, ids: np.ndarray, found: np.ndarray, min_score: float) -> Iterator[tuple[int, np.ndarray]]:
        """(piece, its rows of ``found``) of one document, for the pieces whose score may reach ``min_score``: all of
        the words that a piece and its alignment share are words of the document."""
        found = found[np.lexsort([found[:, 2], found[:, 3], found[:, 0] - found[:, 2], found[:, 1]])]
        edges = np.flatnonzero(np.diff(found[:, 1], prepend=-1, append=-1))
        piece, size = found[edges[:-1], 1], self.sizes
        self.seen[ids] = True
        self.seen[0] = False
        own, many = size[piece], size[piece]
        first = np.cumsum(many) - many
        flat = np.repeat(self.starts[piece] - first, many) + np.arange(many.sum())
        shared = np.add.reduceat(self.seen[self.flat[flat]], first, dtype=np.int64)
        self.seen[ids] = False
        for x in np.flatnonzero(shared >= min_score * own).tolist():
            yield int(piece[x]), found[edges[x]:edges[x + 1]]

    def matches(self, ids: np.ndarray, found: np.ndarray, min_score: float) -> list[tuple[int, int, int]]:
        """(item, score, seeds) of one document's words with the seeds ``found`` in it, for the items whose score may
        reach ``min_score`` of a perfect copy's."""
        out = []
        for piece, rows in self.candidates(ids, found, min_score):
            item, own = self.pieces[piece]
            gram = min(self.n, len(own))
            slack = len(own) // 2 + 4
            spans: list[list] = []
            for begin, k, i in zip((rows[:, 0] - rows[:, 2]).tolist(), rows[:, 3].tolist(), rows[:, 2].tolist()):
                lo, hi = max(0, begin - slack), min(len(ids), begin + len(own) + slack)
                if spans and lo <= spans[-1][1]:
                    spans[-1][1] = max(hi, spans[-1][1])
                    spans[-1][2].add((k, i))
                else:
                    spans.append([lo, hi, {(k, i)}])
            # a gram, or two different words
            spans = [x for x in spans if len(x[2]) > 1 or next(iter(x[2]))[0] == gram]
            best = max((self.aligned(own, ids[lo:hi], min_score) for lo, hi, _ in spans), default=0)
            if best:
                out.append((item, best, int((rows[:, 3] == gram).sum())))
        return out

    def aligned(self, own: np.ndarray, window: np.ndarray, min_score: float) -> int:
        """Alignment score, or 0 where the words they share bound it below ``min_score``."""
        n = len(self.vocab) + 1
        if len(own) > 64 and n < 1 << 20:
            seen = np.zeros(n, bool)
            seen[window] = True
            shared = int(seen[own].sum())
        else:
            there = set(window.tolist())
            shared = sum(x in there for x in own.tolist())
        return align(own, window) if shared >= min_score * len(own) else 0

    def doc_words(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Word numbers of all texts, one unknown word after each, and the texts' bounds."""
        get, ids, ends = self.vocab.get, [], []
        for t in texts:
            if t:
                ids += [get(w, 0) for w in WORD.findall(t.lower())]
            ids += (0,) * self.n
            ends.append(len(ids))
        return np.array(ids, np.int64), np.array([0, *ends])


def _count_batches(batches: Iterator[pa.RecordBatch], block) -> Iterator[pa.RecordBatch]:
    own = block.value
    counts = {k: np.zeros(len(keys), np.int64) for k, (keys, _) in own.grams.items()}
    for b in batches:
        ids, _ = own.doc_words(b.column(0).to_pylist())
        for k, n in counts.items():
            n += np.bincount(own.find(ids, k)[1], minlength=len(n))
    for k, n in counts.items():
        num = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(num), k, np.int32)), pa.array(num), pa.array(n[num])], names=["k", "gram", "n"])


def _match_batches(batches: Iterator[pa.RecordBatch], block, min_score: float) -> Iterator[pa.RecordBatch]:
    own = block.value
    for b in batches:
        ids, cuts = own.doc_words(b.column(1).to_pylist())
        # where seeds are: (position, gram number) by gram length, in the texts' order
        places = {k: own.find(ids, k) for k in own.seeds}
        at = {}
        for k, (pos, num) in places.items():
            start = own.seeds[k][1]
            hit = start[num + 1] > start[num]
            pos, num = pos[hit], num[hit]
            at[k] = pos, num, np.searchsorted(pos, cuts)
        some = sum(np.diff(edge) for _, _, edge in at.values())
        out = []
        for d in np.flatnonzero(some).tolist():
            found = np.concatenate([own.hits(pos[edge[d]:edge[d + 1]] - cuts[d], num[edge[d]:edge[d + 1]], k)
                                    for k, (pos, num, edge) in at.items()])
            for item, score, seeds in own.matches(ids[cuts[d]:cuts[d + 1] - own.n], found, min_score):
                score /= MATCH * own.length[item]
                if score >= min_score:
                    out.append((b.column(0)[d].as_py(), item, score, seeds, b.column(2)[d].as_py()))
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()))],
                names=["doc_id", "item_id", "score", "seeds", "key"])


def contaminated_pairs(docs: DataFrame, benchmark: DataFrame, seed_words: int = SEED_WORDS,
                       seed_share: float = SEED_SHARE, min_score: float = MIN_SCORE,
                       block_words: int = BLOCK_WORDS) -> DataFrame:
    """``(doc_id, item_id, score, seeds)``: documents that hold a benchmark item, whole or edited.

    ``score`` is the best local alignment of the item's words (lower case, runs of word characters)
    over the score of a perfect copy; pairs of at least ``min_score`` are returned; an item of any
    length is aligned whole.  Defined cases: null and
    wordless texts and items without an id match nothing; items with equal text match alike;
    rows of the benchmark that repeat count once, an item_id with several texts is their
    concatenation in text order; repeated documents are answered each; an empty table on
    either side gives no pairs; other columns are ignored.
    """
    return _keyed_pairs(docs, benchmark, seed_words, seed_share, min_score, block_words).drop("key")


def _row_key(docs: DataFrame) -> Column:
    """Rows of equal key have equal doc_id and text, so equal matches."""
    return F.xxhash64(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))


def _keyed_pairs(docs: DataFrame, benchmark: DataFrame, seed_words: int, seed_share: float, min_score: float,
                 block_words: int) -> DataFrame:
    """:func:`contaminated_pairs` with the key of the row."""
    spark = docs.sparkSession
    items = (benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), "text")
             .filter("item_id IS NOT NULL AND text IS NOT NULL").distinct())
    size = F.size(F.split("text", r"\W+"))
    total = items.agg(F.sum(size)).first()[0] or 0
    blocks = max(1, -(-total // block_words))
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string"),
                        _row_key(docs).alias("key"))
    found = []
    for i in range(blocks):
        own = items.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == i).sort("item_id", "text")
        block = Block([tuple(r) for r in own.collect()], seed_words)
        if not block.grams:
            continue
        sent = spark.sparkContext.broadcast(block)
        counts = {k: np.zeros(len(keys), np.int64) for k, (keys, _) in block.grams.items()}
        sums = (texts.select("text").mapInArrow(partial(_count_batches, block=sent), "k int, gram bigint, n bigint")
                .groupBy("k", "gram").agg(F.sum("n").alias("n")))
        for r in sums.collect():  # at most one row for each gram of the block
            counts[r.k][r.gram] = r.n
        block.rare(counts, seed_share)
        sent = spark.sparkContext.broadcast(block)
        found.append(texts.mapInArrow(partial(_match_batches, block=sent, min_score=min_score), PAIRS))
        if blocks > 1:
            found[-1] = staged(found[-1], "decontaminate-block")
    if not found:
        return spark.createDataFrame([], PAIRS)
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, seed_words: int = SEED_WORDS,
                      seed_share: float = SEED_SHARE, min_score: float = MIN_SCORE,
                      block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` without the rows whose text holds a benchmark item (with or without a doc_id)."""
    bad, = free_names(docs, "__bad")
    keys = staged(_keyed_pairs(docs, benchmark, seed_words, seed_share, min_score, block_words)
                  .select(F.col("key").alias(bad)).distinct(), "contaminated")
    return docs.join(keys, _row_key(docs) == keys[bad], "left_anti")
