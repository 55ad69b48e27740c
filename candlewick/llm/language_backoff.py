"""Language identification: words first, then ever shorter character n-grams.

A text's words (runs of letters and their marks, lower case) are scored one by one.  A word the model knows counts by its
log frequency in each language.  An unseen word falls back to its character n-grams, with a mark at
both ends: the longest n of which any gram is known decides, by the mean log frequency of its known
grams.  The model is a bounded table: word and gram counts of a bounded sample of labelled rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlewick.llm.common import Numbers, held_out, staged

#: Bounds of the model: labelled rows in expectation, and the most frequent words and grams of
#: each language (rarer words are unseen words: their grams speak for them).
SAMPLE_ROWS = 20_000
KEPT_WORDS, KEPT_GRAMS = 20_000, 20_000
LONGEST = 5
#: Words whose scores a task keeps (results do not depend on it).
CACHE = 400_000
#: Log frequency of what a language has not shown, below its rarest kept entry.
UNSEEN_GAP = 1.0
#: Mean log-odds per word are multiplied by at most this many words' evidence.
EVIDENCE = 20.0

#: A word is a run of letters with the marks that they carry (in the engine's own expressions: a letter).
LETTER = r"\p{L}"
LETTERS = regex.compile(r"\p{L}[\p{L}\p{M}]*")
UNDETERMINED = "und"


def words_of(text: str) -> list[str]:
    return LETTERS.findall(text.lower())


def grams_of(word: str, n: int) -> list[str]:
    marked = f"\x02{word}\x03"
    return [marked[i:i + n] for i in range(len(marked) - n + 1)]


@dataclass(frozen=True)
class Model:
    """Log frequencies: ``words[w]`` and ``grams[n][g]`` are one number per language."""

    langs: tuple[str, ...]
    words: dict[str, np.ndarray]
    grams: dict[int, dict[str, np.ndarray]]

    def score_word(self, word: str) -> np.ndarray:
        known = self.words.get(word)
        if known is not None:
            return known
        for n in range(min(LONGEST, len(word) + 2), 0, -1):
            table = self.grams[n]
            hits = [v for v in map(table.get, grams_of(word, n)) if v is not None]
            if hits:
                return np.mean(hits, axis=0)
        return np.zeros(len(self.langs))


def _table(rows, langs: tuple[str, ...]) -> dict[str, np.ndarray]:
    """{entry: log frequency by language}; absent: below the language's rarest entry, or, of a
    language without entries, below every other language's."""
    total, least, counts = np.zeros(len(langs)), np.full(len(langs), np.inf), {}
    number = {x: i for i, x in enumerate(langs)}
    for r in rows:
        i = number[r.lang]
        counts.setdefault(r.entry, {})[i] = r.n
        total[i] += r.n
        least[i] = min(least[i], r.n)
    some = total > 0
    floor = np.log(np.where(some, least, 1) / np.maximum(total, 1)) - UNSEEN_GAP
    if not some.all():  # a language without entries of this length is below all others
        floor[~some] = floor[some].min(initial=0.0) - UNSEEN_GAP
    out = {}
    for entry, by in counts.items():
        v = floor.copy()
        for i, n in by.items():
            v[i] = math.log(n / total[i])
        out[entry] = v
    return out


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(kind, lang, entry, n): words (kind 0) and grams (kind = length) of a batch's texts."""
    for b in batches:
        counts: dict[tuple[int, str, str], int] = {}
        for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            for w in words_of(text or ""):
                counts[0, lang, w] = counts.get((0, lang, w), 0) + 1
        for (_, lang, w), c in list(counts.items()):
            for n in range(1, LONGEST + 1):
                for g in grams_of(w, n):
                    counts[n, lang, g] = counts.get((n, lang, g), 0) + c
        if counts:
            kind, lang, entry = zip(*counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(kind, pa.int32()), pa.array(lang), pa.array(entry), pa.array(counts.values(), pa.int64())],
                names=["kind", "lang", "entry", "n"])


def fit(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, kept_words: int = KEPT_WORDS,
        kept_grams: int = KEPT_GRAMS) -> Model:
    """Model from texts and non-null languages of documents that are not held out.

    Only texts with a letter count.  About ``sample_rows`` of them are used, the same number in expectation from each
    language (those with the smallest hash of doc_id and text), and of each language's words and grams the most
    frequent (ties by the entry itself).  A language has no part in the model if none of its texts has a letter.
    Without any usable row, the model knows no language.
    """
    known = (docs.filter(F.col("lang").isNotNull() & ~held_out("doc_id") & F.col("text").cast("string").rlike(LETTER))
             .select("lang", F.col("text").cast("string").alias("text"), F.xxhash64("doc_id", "text").alias("h")))
    sizes = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.min("h").alias("least")).collect()
    share, limit = sample_rows / max(len(sizes), 1), F.lit((1 << 63) - 1)
    for r in sizes:
        if r.n > share:  # a part of the hash's range, with the smallest hash in it at any size
            limit = F.when(F.col("lang") == r.lang,
                           F.lit(max(r.least, int((1 << 64) * share / r.n) - (1 << 63)))).otherwise(limit)
    rows = known.filter(F.col("h") <= limit).select("lang", "text")
    counts = (rows.mapInArrow(_count_batches, "kind int, lang string, entry string, n bigint")
              .groupBy("kind", "lang", "entry").agg(F.sum("n").alias("n")))
    counts = staged(counts, "language-counts")
    langs = tuple(sorted(r.lang for r in counts.filter("kind = 0").select("lang").distinct().collect()))
    tables: dict[int, list] = {kind: [] for kind in range(LONGEST + 1)}
    rank = F.row_number().over(Window.partitionBy("kind", "lang").orderBy(F.col("n").desc(), "entry"))
    kept = F.when(F.col("kind") == 0, kept_words).otherwise(kept_grams)
    best = (counts.withColumn("rank", rank).filter(F.col("rank") <= max(kept_words, kept_grams))
            .filter(F.col("rank") <= kept).select("kind", "lang", "entry", "n"))
    for r in best.collect():  # one bounded list for each kind and language
        tables[r.kind].append(r)
    tables = {kind: _table(rows, langs) for kind, rows in tables.items()}
    return Model(langs, tables.pop(0), tables)


class Scorer:
    """The model as index tables, which score many words together; keeps the words met, by number."""

    def __init__(self, model: Model):
        self.model, self.size = model, len(model.langs)
        self.tables = {n: self._indexed(t) for n, t in {0: model.words, **model.grams}.items()}
        self.clear()

    def _indexed(self, table: dict[str, np.ndarray]) -> tuple[dict[str, int], np.ndarray]:
        return {x: i for i, x in enumerate(table)}, np.array(list(table.values())).reshape(len(table), self.size)

    def clear(self) -> None:
        self.number, self.known = Numbers(), np.zeros((0, self.size))

    def score_words(self, words: list[str]) -> np.ndarray:
        """:meth:`Model.score_word` of each word, as rows."""
        out, todo = np.zeros((len(words), self.size)), np.arange(len(words))
        for n in (0, *range(LONGEST, 0, -1)):
            table, rows = self.tables[n]
            get, ids, per = table.get, [], []
            for i in todo.tolist():
                own = grams_of(words[i], n) if n else [words[i]]
                ids += [get(x, -1) for x in own]
                per.append(len(own))
            ids, own = np.array(ids, np.int64), np.repeat(np.arange(len(todo)), per)
            hit = ids >= 0
            ids, own = ids[hit], own[hit]
            count = np.bincount(own, minlength=len(todo))
            done = count > 0
            for lang in range(self.size):
                total = np.bincount(own, rows[ids, lang], minlength=len(todo))
                out[todo[done], lang] = total[done] / count[done]
            todo = todo[~done]
            if not todo.size:
                break
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """(languages, scores) of texts."""
        if len(self.number) > CACHE:
            self.clear()
        number, ids, per = self.number.__getitem__, [], []
        for t in texts:
            words = words_of(t) if t and self.size else []
            ids += map(number, words)
            per.append(len(words))
        new = list(islice(self.number, len(self.known), None))
        if new:
            self.known = np.concatenate([self.known, self.score_words(new)])
        ids, per = np.array(ids, np.int64), np.array(per)
        doc = np.repeat(np.arange(len(texts)), per)
        if not self.size:
            return [UNDETERMINED] * len(texts), [0.0] * len(texts)
        mean = np.stack([np.bincount(doc, self.known[ids, i], minlength=len(texts)) for i in range(self.size)], 1)
        mean = mean / np.maximum(per, 1)[:, None]
        odds = np.exp((mean - mean.max(1, keepdims=True)) * np.minimum(per, EVIDENCE)[:, None])
        best = mean.argmax(1)
        score = np.where(per > 0, odds[np.arange(len(texts)), best] / odds.sum(1), 0.0)
        return [self.model.langs[i] if n else UNDETERMINED for i, n in zip(best.tolist(), per.tolist())], score.tolist()


def _predict_batches(batches: Iterator[pa.RecordBatch], sent) -> Iterator[pa.RecordBatch]:
    scorer = Scorer(sent.value)
    for b in batches:
        lang, score = scorer.predict(b.column(b.num_columns - 1).to_pylist())
        yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                                         names=[*b.schema.names[:-1], "lang_pred", "score"])


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)`` for every row of ``docs(doc_id, text, ...)``.

    The score is the softmax of the mean word scores, with the evidence of at most EVIDENCE words.  Ties
    go to the first language by name.  Null texts and texts without a letter are ``und`` with score 0,
    as is everything under a model without languages; repeated rows are answered each; a null doc_id
    counts as held out; an empty table gives no rows; other columns are ignored.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), held_out("doc_id").alias("held_out"),
                        F.col("text").cast("string").alias("text"))
            .mapInArrow(lambda x: _predict_batches(x, sent),
                        "doc_id bigint, held_out boolean, lang_pred string, score double"))
