"""SimHash near-duplicates against brute force over all pairs."""

import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from candlewick.llm import simhash_bktree as S
from candlewick.llm.common import prepare
from candlewick.llm.components import star_components

SCHEMA = "doc_id bigint, text string, fp string"


def slow_fingerprint(text, k=4):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return 0
    sh = [" ".join(w[i:i + k]) for i in range(max(1, len(w) - k + 1))]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def slow_components(fps, bits):
    """{row: smallest reachable id} over [(id, fp)]."""
    lab = list(range(len(fps)))

    def top(x):
        while lab[x] != x:
            x = lab[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i][1] ^ fps[j][1]).bit_count() <= bits:
                lab[top(i)] = top(j)
    least = {}
    for i, (d, _) in enumerate(fps):
        if d is not None:
            least[top(i)] = min(d, least.get(top(i), d))
    return [least.get(top(i)) for i in range(len(fps))]


def texts():
    rng = random.Random(5)
    words = [f"W{i}" for i in range(40)]
    base = [" ".join(rng.choices(words, k=rng.randint(1, 60))) for _ in range(25)]
    out = list(base)
    for t in base[:12]:
        w = t.split()
        for _ in range(6):
            x = list(w)
            x[rng.randrange(len(x))] = rng.choice(words)
            out.append("  ".join(x) + "\n")
    out += [base[0]] * 4 + ["", None, " \t\x0b\n", "É é", "a b", "word " * 30_000]
    return out


def test_fingerprint_is_the_contracts():
    for t in texts():
        assert S.fingerprint(None if t is None else t.encode()) == slow_fingerprint(t), t


def test_components_match_all_pairs(spark):
    prepare(spark)
    rows = [(i * 3 % 101 + 1000 * (i // 101), t, "clash") for i, t in enumerate(texts())]
    rows += [rows[0], (None, rows[1][1], "x"), (None, "only here, and nowhere else", "x")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = sorted(map(tuple, S.near_duplicates(df).collect()), key=str)
    fps = [(d, slow_fingerprint(t)) for d, t, _ in rows]
    signed = np.array([f for _, f in fps], np.uint64).view(np.int64).tolist()
    want = sorted(((d, s, c) for (d, _), s, c in zip(fps, signed, slow_components(fps, 4))), key=str)
    assert got == want


def test_links_connect_all_in_small_trees_and_large(spark):
    prepare(spark)
    rng = random.Random(1)
    base = [rng.getrandbits(64) for _ in range(60)]
    fps = {b for b in base}
    for b in base[:10]:  # dense balls, and chains that leave them
        x = b
        for _ in range(40):
            x ^= 1 << rng.randrange(64)
            fps.add(x)
            fps.add(b ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
    fps = sorted(fps)
    signed = np.array(fps, np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(x,) for x in signed], "fp bigint")
    want = slow_components(list(enumerate(fps)), 4)
    for size in (4, 50, 1 << 14):
        star = {r.u: r.v for r in star_components(S.links(df, 4, size)).collect()}
        lab = [star.get(x, x) for x in signed]
        assert len(set(zip(lab, want))) == len(set(want)) == len(set(lab)), size


def test_one_document_of_each_group_stays(spark):
    prepare(spark)
    rows = [(1, "a b c d e", "x"), (2, "a b c d e", "y"), (2, "a b c d e", "y"), (9, "", "z"),
            (8, None, "z"), (5, "something else is written here", "q"), (5, "something else is written here", "q"),
            (None, "a b c d e", None)]
    got = S.drop_near_duplicates(spark.createDataFrame(rows, SCHEMA))
    assert got.columns == ["doc_id", "text", "fp"]
    assert sorted(map(str, (r.doc_id for r in got.collect()))) == ["1", "5", "8", "None"]


def test_empty_table(spark):
    prepare(spark)
    none = spark.createDataFrame([], SCHEMA)
    assert S.near_duplicates(none).collect() == []
    assert S.drop_near_duplicates(none).collect() == []


def test_components_of_hub_chain_and_loops(spark):
    prepare(spark)
    e = [(0, i) for i in range(1, 300)] + [(i, i + 1) for i in range(1000, 1100)] + [(7, 7), (None, 3)]
    got = {r.u: r.v for r in star_components(spark.createDataFrame(e, "u bigint, v bigint")).collect()}
    assert got == {**{i: 0 for i in range(1, 300)}, **{i: 1000 for i in range(1001, 1101)}}


def test_query_columns(spark):
    from candlewick.llm.queries import QUERIES
    df = QUERIES["op1_simhash_bktree"](spark, "/root/testdata/sf0.001")
    assert df.dtypes == [("doc_id", "bigint"), ("fingerprint", "string"), ("component_id", "bigint")]
    assert df.filter(~F.col("fingerprint").rlike("^[0-9a-f]{16}$")).count() == 0


def test_the_survivor_is_the_row_that_names_its_component(spark):
    """Rows that share a doc_id and differ in text: only the one that no other document repeats stays."""
    prepare(spark)
    one, two = "alpha beta gamma delta epsilon", "something else is written over here"
    three = "the third text has words of its own"
    rows = [(1, one, "x"), (5, one, "a"), (5, two, "b"), (7, two, "c"), (9, three, "d"), (9, three, "d"), (None, one, "n")]
    for _ in range(2):
        got = S.drop_near_duplicates(spark.createDataFrame(rows, SCHEMA.replace("fp", "__text")).repartition(4)).collect()
        assert sorted(((r.doc_id, r.text) for r in got), key=str) == sorted([(1, one), (5, two), (9, three), (None, one)], key=str)
        rows.reverse()


def test_a_large_component_is_named_without_a_join_on_its_label(spark, monkeypatch):
    prepare(spark)
    rows = [(i * 3 % 101 + 1000 * (i // 101), t, "clash") for i, t in enumerate(texts())]
    df = spark.createDataFrame(rows, SCHEMA)
    want = sorted(map(tuple, S.near_duplicates(df).collect()))
    for large in (1, 20, 10 ** 9):  # none, some and all labels are large
        monkeypatch.setattr(S, "LARGE_LABELS", large)
        assert sorted(map(tuple, S.near_duplicates(df).collect())) == want
