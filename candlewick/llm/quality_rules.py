"""Quality score as a sparse rule ensemble over text statistics.

1. Statistics of the whole text are plain Spark columns.
2. A small random forest is fitted on a bounded sample of labelled rows; every path from a root to
   a node is a conjunctive rule (``symbol_share > 0.01 AND distinct_words <= 0.4``).
3. Logistic regression with an L1 penalty over the rules' 0/1 values leaves few non-zero weights.  Spark
   counts the sample's distinct rule patterns; the weights are fitted to those counts.
4. The surviving rules are compiled to one column expression, so scoring is a projection of
   the table: no join, no shuffle, no Python.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.llm.common import held_out, smallest_hashes, staged_with

THRESHOLD = 0.3
#: Labelled rows the model is fitted on (chosen by a hash of doc_id), in expectation.
SAMPLE_ROWS = 20_000
TREES, DEPTH, LASSO, STEPS = 12, 4, 0.0005, 3000
#: Tasks of a fitting job: the sample is bounded, so many tasks only add waiting.
FIT_TASKS = 4

#: Ornament, not the signs that addresses, numbers and code are written with.
SYMBOLS = "%$&#*!|~^\\<>{}[]"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
DIGITS = "0123456789"
STATS = ["chars", "words", "mean_word", "symbol_share", "upper_share", "digit_share",
         "stop_share", "comma_share", "distinct_words", "distinct_lines", "repeated_words"]

STAT = "__s_"
STAT_COLUMNS = [STAT + s for s in STATS]

#: (statistic, greater than?, threshold), all of which must hold.
Rule = tuple[tuple[str, bool, float], ...]


def _share(text: Column, chars: str, n: Column) -> Column:
    return (F.length(text) - F.length(F.translate(text, chars, ""))) / n


def with_statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds a double column ``__s_NAME`` for each of STATS, of the whole text (null: empty).

    They are columns and not a struct: Spark inlines a struct's fields wherever they are read, and every
    rule would compute its statistics anew.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    df = docs.withColumn("__text", text)
    t = F.col("__text")
    df = (df.withColumn("__words", F.filter(F.split(t, r"\s+"), lambda w: w != ""))
          .withColumn("__lines", F.split(t, "\n")))
    n, words = F.greatest(F.length(t), F.lit(1)), F.greatest(F.size("__words"), F.lit(1))
    stats = {
        "chars": F.length(t), "words": F.size("__words"), "mean_word": F.length(t) / words,
        "symbol_share": _share(t, SYMBOLS, n), "upper_share": _share(t, UPPER, n),
        "digit_share": _share(t, DIGITS, n), "stop_share": _share(t, ".?;:", words),
        "comma_share": _share(t, ",", words),
        "distinct_words": F.size(F.array_distinct("__words")) / words,
        "distinct_lines": F.size(F.array_distinct("__lines")) / F.size("__lines"),
        "repeated_words": F.size(F.filter("__words", lambda w, i: (i > 0) & (
            w == F.get(F.col("__words"), i - 1)))) / words,
    }
    df = df.withColumns({STAT + s: stats[s].cast("double") for s in STATS})
    return df.drop("__text", "__words", "__lines")


def tree_rules(root) -> list[Rule]:
    """Conjunctions on the way to every node below ``root`` (a fitted tree's JVM node)."""
    rules, todo = [], [(root, ())]
    while todo:
        node, path = todo.pop()
        if path:
            rules.append(simplified(path))
        if node.getClass().getSimpleName() == "InternalNode":
            cut = node.split()
            name, at = STATS[cut.featureIndex()], cut.threshold()
            todo += [(node.leftChild(), (*path, (name, False, at))),
                     (node.rightChild(), (*path, (name, True, at)))]
    return rules


def simplified(path: Rule) -> Rule:
    """One bound for each statistic and side: the tightest."""
    best: dict[tuple[str, bool], float] = {}
    for name, above, at in path:
        old = best.get((name, above), at)
        best[name, above] = max(old, at) if above else min(old, at)
    return tuple((n, a, v) for (n, a), v in sorted(best.items()))


def rule_column(rule: Rule) -> Column:
    out = None
    for name, above, at in rule:
        x = F.col(STAT + name)
        part = x > F.lit(at) if above else x <= F.lit(at)
        out = part if out is None else out & part
    return out


@dataclass(frozen=True)
class RuleModel:
    """Weighted rules; ``score`` is the compiled column."""

    rules: tuple[tuple[Rule, float], ...]
    intercept: float

    def score(self) -> Column:
        total = F.lit(self.intercept)
        for rule, weight in self.rules:
            total = total + F.when(rule_column(rule), F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, seed: int = 7) -> RuleModel:
    """Fit on labelled rows whose doc_id is not held out.

    At most about ``sample_rows`` labelled rows are used: those with the smallest hash of
    doc_id, independent of order and partitioning.  Labels other than 0 and 1 and null ids are
    ignored; an id with both labels counts for each.  Without labels of both kinds, the score is the
    one label's (or, with none, 0.5) for every text.
    """
    known = (labels.filter("quality IN (0, 1) AND doc_id IS NOT NULL").filter(~held_out("doc_id"))
             .select(F.col("doc_id").cast("bigint").alias("__id"), F.col("quality").cast("double").alias("label"))
             .distinct())
    n = known.count()
    if n > sample_rows:
        known = known.filter(smallest_hashes(F.xxhash64("__id"), sample_rows, n))
    # The sample's ids are bounded by sample_rows: sent to the texts, which are not shuffled.
    rows = docs.select(F.col("doc_id").cast("bigint").alias("__id"), "text").join(F.broadcast(known), "__id")
    rows = with_statistics(rows).select("label", *STAT_COLUMNS)
    rows, seen = staged_with(rows, "quality-sample", n=F.count(F.lit(1)), pos=F.sum("label"))
    n, pos = seen.get("n") or 0, seen.get("pos") or 0.0
    if not n or pos in (0, n):
        return RuleModel((), 0.0 if not n else (20.0 if pos else -20.0))
    vec = rows.select("label", array_to_vector(F.array(*STAT_COLUMNS)).alias("x")).coalesce(FIT_TASKS)
    forest = RandomForestClassifier(featuresCol="x", labelCol="label", numTrees=TREES, maxDepth=DEPTH,
                                    maxBins=128, featureSubsetStrategy="0.5", subsamplingRate=0.7,
                                    seed=seed).fit(vec)
    rules = sorted({r for t in forest.trees for r in tree_rules(t._call_java("rootNode"))})
    if not rules:
        return RuleModel((), 20.0 if pos * 2 > n else -20.0)
    hits = F.concat(*[rule_column(r).cast("int").cast("string") for r in rules])
    counts = rows.groupBy(hits.alias("hits"), "label").agg(F.count(F.lit(1)).alias("n")).collect()
    weights, intercept = lasso(np.array([[int(c) for c in r.hits] for r in counts], float),
                               np.array([r.label for r in counts]), np.array([r.n for r in counts], float))
    return RuleModel(tuple((r, float(w)) for r, w in zip(rules, weights) if w), float(intercept))


def lasso(x: np.ndarray, y: np.ndarray, n: np.ndarray, penalty: float = LASSO,
          steps: int = STEPS) -> tuple[np.ndarray, float]:
    """L1-penalised logistic regression of ``y`` (0/1) on ``x``, rows counted ``n`` times, by accelerated
    proximal gradient; the intercept is not penalised.  The rows are the distinct rule patterns of the
    sample, of which there are few."""
    x = np.column_stack([x, np.ones(len(x))])
    n = n / n.sum()
    rate = 4 / np.linalg.eigvalsh((x * n[:, None]).T @ x)[-1]
    shrink = np.append(np.full(x.shape[1] - 1, rate * penalty), 0.0)
    w = z = np.zeros(x.shape[1])
    t = 1.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ z, -500, 500)))
        new = z - rate * (x.T @ (n * (p - y)))
        new = np.sign(new) * np.maximum(np.abs(new) - shrink, 0.0)
        t, old = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        z, w = new + (old - 1) / t * (new - w), new
    return w[:-1], w[-1]


def classify(docs: DataFrame, model: RuleModel, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher: better text) and ``predicted`` (1 if at least the
    threshold).  Null and empty texts are scored by their statistics; rows, order of columns and
    other columns stay (columns named score or predicted are replaced)."""
    return (with_statistics(docs).withColumn("score", model.score()).drop(*STAT_COLUMNS)
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))


def keep_good(docs: DataFrame, model: RuleModel, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that the model does not reject, unchanged.

    The decision passes through an outer ``explode``: a plain filter would be pushed below the
    statistics, and every rule would compute its statistics anew.
    """
    kept = F.explode_outer(F.array(model.score() >= threshold))
    return with_statistics(docs).withColumn("__kept", kept).filter("__kept").drop(*STAT_COLUMNS, "__kept")
