"""Rule ensemble: statistics by brute force, held-out accuracy, defined cases."""

import zlib

import pytest
from pyspark.sql import functions as F

from candlewick.llm import quality_rules as Q
from candlewick.llm.common import held_out, prepare, smallest_hashes

DIR = "/root/testdata/sf0.01"


def slow_statistics(t):
    t = t or ""
    w, lines = t.split(), t.split("\n")
    n, k = max(1, len(t)), max(1, len(w))
    share = lambda chars, by: sum(c in chars for c in t) / by
    return [len(t), len(w), len(t) / k, share(Q.SYMBOLS, n), share(Q.UPPER, n), share(Q.DIGITS, n),
            share(".?;:", k), share(",", k), len(set(w)) / k, len(set(lines)) / len(lines),
            sum(a == b for a, b in zip(w, w[1:])) / k]


def test_statistics_match_brute_force(spark):
    texts = ["A b, b B!! c.\n\nA b", "", None, "  x\ty ", "%%% $$$", "one\none\none", "é É 1"]
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id int, text string, score string")
    for r in Q.with_statistics(df).collect():
        assert [r[c] for c in Q.STAT_COLUMNS] == pytest.approx(slow_statistics(r.text)), r.text


def test_held_out_is_crc32_of_the_id(spark):
    got = spark.range(200).withColumn("h", held_out("id")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 5 == 0) for r in got)


@pytest.fixture(scope="module")
def fitted(spark):
    prepare(spark)
    docs, labels = (spark.read.parquet(f"{DIR}/{t}.parquet") for t in ("documents", "labels"))
    return docs, labels, Q.fit(docs, labels)


def test_held_out_accuracy_and_sparse_rules(fitted):
    docs, labels, model = fitted
    assert 0 < len(model.rules) <= 60
    rows = Q.classify(docs, model).join(labels, "doc_id").filter(held_out("doc_id")).collect()
    right = sum(r.predicted == r.quality for r in rows)
    assert len(rows) > 50 and right / len(rows) >= 0.95


def test_lasso_is_at_its_optimum():
    import numpy as np
    rng = np.random.default_rng(1)
    x, n = rng.integers(0, 2, (80, 12)).astype(float), rng.integers(1, 9, 80).astype(float)
    y = (x[:, 0] + x[:, 1] * x[:, 2] + rng.random(80) > 1.2).astype(float)
    w, b = Q.lasso(x, y, n, 0.01)
    gap = (n / n.sum()) * (1 / (1 + np.exp(-(x @ w + b))) - y)
    grad = x.T @ gap
    assert abs(gap.sum()) < 1e-5 and 0 < (w != 0).sum() < 12
    assert np.allclose(grad[w != 0], -0.01 * np.sign(w[w != 0]), atol=1e-5) and (abs(grad[w == 0]) <= 0.01 + 1e-5).all()


def test_compiled_score_is_the_rules_sum(spark, fitted):
    docs, _, model = fitted
    import math
    for r in Q.with_statistics(docs).withColumn("s", model.score()).limit(80).collect():
        stat = {n: r[Q.STAT + n] for n in Q.STATS}
        z = model.intercept + sum(w for rule, w in model.rules
                                  if all((stat[n] > v) if a else (stat[n] <= v) for n, a, v in rule))
        assert r.s == pytest.approx(1 / (1 + math.exp(-z)))


def test_odd_rows_are_scored_and_kept_as_they_are(spark, fitted):
    model = fitted[2]
    df = spark.createDataFrame([(1, "", "a"), (1, "", "a"), (None, None, None), (2, "word " * 50_000, "b")],
                               "doc_id bigint, text string, score string")
    got = Q.classify(df, model)
    assert got.columns == ["doc_id", "text", "score", "predicted"] and got.count() == 4
    assert got.filter("score BETWEEN 0 AND 1 AND predicted IN (0, 1)").count() == 4
    assert Q.keep_good(df, model).columns == df.columns
    assert Q.classify(df.limit(0), model).collect() == []


def test_labels_of_one_kind_or_none(spark):
    prepare(spark)
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(20)], "doc_id bigint, text string")
    for labels, score in (([], 0.5), ([(i, 1) for i in range(20)] + [(None, 0), (3, 7)], 1.0),
                          ([(i, 0) for i in range(20)], 0.0)):
        model = Q.fit(docs, spark.createDataFrame(labels, "doc_id bigint, quality int"))
        got = Q.classify(docs, model).agg(F.min("score"), F.max("score")).first()
        assert got[0] == got[1] == pytest.approx(score, abs=1e-6)


@pytest.mark.parametrize("n", [30_000, 10**9, 10**12])
def test_the_samples_share_of_the_hash_range_holds_at_any_size(spark, n):
    prepare(spark)
    share = 20_000 / n
    hashes = [(int((1 << 64) * share * x) - (1 << 63),) for x in (0.0, 0.5, 0.99, 1.01, 1.4)]
    got = spark.createDataFrame(hashes, "h bigint").select(smallest_hashes(F.col("h"), 20_000, n).alias("x")).collect()
    assert [r.x for r in got] == [True, True, True, False, False]
