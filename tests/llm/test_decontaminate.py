"""Seeds and alignment against a brute-force alignment of every document with every item."""

import random

import numpy as np
import pytest

from candlewick.llm import decontaminate as D
from candlewick.llm.common import prepare

DOCS, ITEMS = "doc_id bigint, text string, item_id string", "item_id bigint, text string, doc_id string"


def slow_align(a, b):
    h = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            h[i][j] = max(0, h[i - 1][j - 1] + (2 if x == y else -1), h[i - 1][j] - 1, h[i][j - 1] - 1)
    return max(map(max, h))


@pytest.mark.parametrize("seed", range(20))
def test_alignment_matches_the_full_matrix(seed):
    rng = random.Random(seed)
    a, b = ([rng.randrange(1, 6) for _ in range(rng.randint(0, 25))] for _ in range(2))
    assert D.align(np.array(a, np.int64), np.array(b, np.int64)) == slow_align(a, b)


@pytest.fixture(scope="module")
def case(spark):
    prepare(spark)
    rng = random.Random(3)
    vocab = [f"w{i}" for i in range(400)] + ["the", "of", "and"] * 60
    item = {i: rng.choices(vocab, k=rng.randint(14, 50)) for i in range(12)}
    item[20] = ["tiny"]
    item[21] = ["two", "words"]
    item[22] = rng.choices(vocab, k=1300)
    docs, planted = {}, set()
    for d in range(60):
        docs[d] = rng.choices(vocab, k=rng.randint(0, 300))
    for d, (i, edits) in enumerate([(0, 0), (0, 0.1), (1, 0), (1, 0.2), (2, 0.15), (3, 0.1), (22, 0), (22, 0.1)]):
        own = [w if rng.random() >= edits else rng.choice(["new", "", "x y"]) for w in item[i]]
        at = rng.randint(0, len(docs[d]))
        docs[d][at:at] = own
        planted.add((d, i))
    docs[30] += ["tiny"]
    docs[31] += ["Two,", "WORDS"]
    docs[32] += ["words", "two"]
    planted |= {(30, 20), (31, 21)}
    item[23] = list(item[0])
    planted |= {(0, 23), (1, 23)}
    return docs, item, planted


def frames(spark, docs, item):
    d = [(k, " ".join(v), "clash") for k, v in docs.items()] + [(90, None, "x"), (91, "", "x"), (None, "nothing", "x")]
    i = [(k, " ".join(v), "clash") for k, v in item.items()] + [(50, None, "x"), (51, " . ", "x"), (None, "the of", "x")]
    return spark.createDataFrame(d, DOCS).repartition(4), spark.createDataFrame(i + i[:2], ITEMS)


@pytest.mark.parametrize("block_words", [1 << 20, 300])
def test_pairs_match_brute_force(spark, case, block_words):
    docs, item, planted = case
    got = {(r.doc_id, r.item_id): r.score for r in
           D.contaminated_pairs(*frames(spark, docs, item), block_words=block_words).collect()}
    assert set(got) == planted
    number: dict[str, int] = {}
    num = lambda ws: [number.setdefault(w, len(number)) for w in D.words_of(" ".join(ws))]
    for (d, i), score in got.items():
        assert score == pytest.approx(D.align(np.array(num(item[i])), np.array(num(docs[d]))) / (2 * len(item[i])), abs=1e-9)
    for d in range(8, 60):
        for i in range(12):
            assert slow_align(num(item[i]), num(docs[d])) / (2 * len(item[i])) < D.MIN_SCORE or (d, i) in planted


def test_an_item_in_most_documents_keeps_its_seeds(spark):
    prepare(spark)
    docs = spark.createDataFrame([(i, f"a{i} one two three four five six z{i}", "") for i in range(80)], DOCS)
    items = spark.createDataFrame([(7, "one two three four five six", "")], ITEMS)
    got = D.contaminated_pairs(docs, items)
    assert got.count() == 80 and got.filter("score = 1.0").count() == 80


def test_dropping_and_empty_tables(spark, case):
    docs, item, planted = case
    d, i = frames(spark, docs, item)
    kept = D.drop_contaminated(d, i)
    assert kept.columns == d.columns
    want = sorted((set(docs) | {90, 91, None}) - {x for x, _ in planted}, key=str)
    assert sorted((r.doc_id for r in kept.collect()), key=str) == want
    assert D.contaminated_pairs(d, i.limit(0)).collect() == []
    assert D.contaminated_pairs(d.limit(0), i).collect() == []
    assert D.drop_contaminated(d, i.limit(0)).count() == d.count()


def edited(words, how, rng):
    """A third of the words replaced at random, every third one, or a word pushed in after every word but the last."""
    if how == "random":
        return [w if rng.random() >= 1 / 3 else f"new{rng.randrange(9)}" for w in words]
    if how == "regular":
        return [w if i % 3 != 2 else f"new{rng.randrange(9)}" for i, w in enumerate(words)]
    return [x for i, w in enumerate(words) for x in ((w, f"new{rng.randrange(9)}") if i + 1 < len(words) else (w,))]


@pytest.mark.parametrize("how", ["random", "regular", "pushed"])
def test_recall_of_heavy_edits_against_full_alignment(spark, how):
    """All pairs that the whole alignment of item and document puts at MIN_SCORE or more; long items too."""
    prepare(spark)
    rng = random.Random(how)
    vocab = [f"w{i}" for i in range(900)] + ["the", "of", "and"] * 90
    item = {i: rng.choices(vocab, k=n) for i, n in enumerate([12, 15, 20, 30, 45, 60, 60, 90, 150, 600, 2000] * 2)}
    docs = {}
    for i, words in item.items():
        docs[i] = rng.choices(vocab, k=rng.randrange(60)) + edited(words, how, rng) + rng.choices(vocab, k=rng.randrange(60))
    got = {(r.doc_id, r.item_id): r.score for r in D.contaminated_pairs(*frames(spark, docs, item)).collect()}
    number: dict[str, int] = {}
    num = lambda ws: np.array([number.setdefault(w, len(number)) for w in ws])
    full = {(i, i): D.align(num(item[i]), num(docs[i])) / (2 * len(item[i])) for i in item}
    want = {p for p, s in full.items() if s >= D.MIN_SCORE}
    assert len(want) > (8 if how == "random" else 20)
    assert len(want & set(got)) >= 0.95 * len(want)
    assert all(got[p] == pytest.approx(full[p], abs=1e-9) for p in want & set(got))
    assert set(got) <= want


def test_rows_without_an_id_are_dropped_too(spark):
    prepare(spark)
    text = "one two three four five six seven eight nine ten eleven twelve"
    docs = spark.createDataFrame([(None, text, "a"), (None, "clean", "b"), (1, text, "c"), (1, "clean too", "d"), (2, None, "e")], DOCS)
    items = spark.createDataFrame([(7, text, "")], ITEMS)
    assert sorted(r[2] for r in D.drop_contaminated(docs, items).collect()) == ["b", "d", "e"]


def test_grams_that_do_not_fit_are_an_error():
    with pytest.raises(ValueError, match="do not fit"):
        D.Block([(1, " ".join(f"w{i}" for i in range(3000)))], 6)
