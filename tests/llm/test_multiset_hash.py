"""Multiset vectors: the group laws, likeness, and the edited texts by brute force."""

import hashlib
import random

from pyspark.sql import functions as F

from candlewick.llm import multiset_hash as M
from candlewick.llm.common import prepare

SCHEMA = "doc_id bigint, text string, fingerprint string"


def vectors(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    return df.withColumn("v", M.vector(F.col("text")))


def slow_equality(text):
    lanes = [0] * 16
    for p in filter(None, (text or "").split("\n")):
        h = hashlib.sha512(p.encode()).hexdigest()
        lanes = [(a + int(h[8 * i:8 * i + 8], 16)) % 2 ** 32 for i, a in enumerate(lanes)]
    return lanes


def test_order_repeats_insertion_and_deletion(spark):
    texts = ["a. b\nc d. e\nc d. e", "c d. e\n\na. b\nc d. e\n", "a. b\nc d. e", "c d. e", "", None, "\n\n", "é\n" * 300]
    df = vectors(spark, texts)
    v = {r.i: r.v for r in df.collect()}
    for i, t in enumerate(texts):
        assert v[i]["equal"] == slow_equality(t)
    assert v[0] == v[1] != v[2] and v[4] == v[5] == v[6] and set(v[4]["equal"] + v[4]["like"]) == {0}
    a, b = df.filter("i = 2").select(F.col("v").alias("x")), df.filter("i = 3").select(F.col("v").alias("y"))
    both = a.join(b, F.lit(True)).select(M.combined(F.col("x"), F.col("y")).alias("s"), "x", "y")
    r = both.select("s", M.combined(F.col("s"), F.col("y"), -1).alias("back"), "x").first()
    assert r.s == v[0] and r.back == r.x


def slow_edited(rows):
    ids = sorted({d if d is not None else -2 ** 63 for d, _ in rows}, reverse=True)
    out = []
    for d, t in rows:
        k = d if d is not None else -2 ** 63
        nxt = ids[(ids.index(k) + 1) % len(ids)]
        m = len(t or "") // 3
        n = min((x or "") for e, x in rows if (e if e is not None else -2 ** 63) == nxt)
        out.append((d, len(t or ""), hashlib.sha256(((t or "")[:len(t or "") - m] + n[:m]).encode()).hexdigest()))
    return sorted(out, key=str)


def test_edited_texts_match_brute_force(spark):
    prepare(spark)
    rng = random.Random(4)
    rows = [(rng.randrange(10 ** 6), "".join(rng.choices("ab. é\n😀", k=rng.randint(0, 90)))) for _ in range(300)]
    rows += [(5, None), (6, ""), (None, "no id. at all"), rows[0], (7, "long. " * 30_000)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA).repartition(7)
    got = M.edited_documents(df).collect()
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in got), key=str) == slow_edited(rows)
    for r in got:
        assert all(len(x) > 128 and (len(x) - 128) % (128 * 4) == 0 for x in (r.fingerprint, r.edited_fingerprint))
        assert (r.near_edited == 1) == (r.fingerprint[:128] == r.edited_fingerprint[:128])
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert M.edited_documents(df.limit(0)).collect() == []
    one = M.edited_documents(df.filter("doc_id = 7")).first()
    assert one.near_next == 1.0


def test_edited_texts_are_nearer_than_next_ones(spark):
    prepare(spark)
    df = M.edited_documents(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "Cartesian", "NestedLoop"))
    rows = df.collect()
    assert sum(r.near_edited > r.near_next for r in rows) / len(rows) > 0.9
    by = {}
    for r in rows:
        by.setdefault(r.fingerprint, set()).add(r.n_chars)
    assert all(len(x) == 1 for x in by.values())


def test_likeness_is_graded_at_every_length(spark):
    """A third of the sentences replaced, and none kept."""
    prepare(spark)
    rows, sentence = [], lambda *x: " ".join(map(str, x)) + "."
    for n in (21, 180, 500, 1600, 20_000):
        own = [sentence("one", n, i) for i in range(n)]
        rows.append((n, " ".join(own), " ".join(own[:n - n // 3] + [sentence("two", n, i) for i in range(n // 3)]),
                     " ".join(sentence("three", n, i) for i in range(n))))
    df = spark.createDataFrame(rows, "n int, a string, b string, c string")
    df = df.select("n", *[M.vector(F.col(x)).alias(x) for x in "abc"])
    got = df.select("n", M.likeness(F.col("a"), F.col("b")).alias("near"), M.likeness(F.col("a"), F.col("c")).alias("far"),
                    (M.combined(M.combined(F.col("a"), F.col("b")), F.col("b"), -1) == F.col("a")).alias("back")).collect()
    assert len(got) == 5 and all(0.25 < r.near < 0.75 and r.far < 0.1 and r.back for r in got), got


def lanes_of(fingerprint):
    like = [int(fingerprint[i:i + 4], 16) for i in range(128, len(fingerprint), 4)]
    return fingerprint[:128], [like[i:i + 128] for i in range(0, len(like), 128)]


def slow_likeness(a, b):
    """From the returned fingerprints alone."""
    (ea, la), (eb, lb) = lanes_of(a), lanes_of(b)
    if ea == eb:
        return 1.0
    for start in range(max(len(la), len(lb))):
        x, y = ([sum(v) % 2 ** 16 for v in zip(*levels[start:])] or [0] * 128 for levels in (la, lb))
        used = [(p, q) for p, q in zip(x, y) if p or q]
        if 0 < len(used) <= M.SATURATED:
            return min(0.999, sum(p == q for p, q in used) / len(used))
    return 0.0


def test_likeness_is_that_of_the_returned_fingerprints(spark):
    prepare(spark)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = sorted(M.edited_documents(docs).collect(), key=lambda r: -r.doc_id)
    for i, r in enumerate(rows):
        assert r.near_edited == slow_likeness(r.fingerprint, r.edited_fingerprint)
        assert r.near_next == slow_likeness(r.fingerprint, rows[(i + 1) % len(rows)].fingerprint)


def test_an_end_is_replaced_without_hashing_the_head_again(spark):
    rng = random.Random(9)
    pick = lambda n: "".join(rng.choices(["a", "b. ", ".", " ", "\n", "c! d", "? ", "\t", "é😀"], k=rng.randint(0, n)))
    rows = [(pick(12), pick(6), pick(6)) for _ in range(1500)]
    rows += [("a. ", " b", "c"), ("a. ", "", "\n"), ("", "", ""), ("\n", "a", ""), ("a.", " ", "b"), ("a. b", "", ". ")]
    df = spark.createDataFrame(rows, "head string, old string, new string")
    got = df.select("*", M.with_end_replaced(M.vector(F.concat("head", "old")), F.col("head"), F.col("old"), F.col("new")).alias("e"),
                    M.vector(F.concat("head", "new")).alias("v")).collect()
    assert [r for r in got if r.e != r.v] == []
