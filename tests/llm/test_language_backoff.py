"""Word-first backoff: the model's rules by hand, brute force of scores, held-out accuracy."""

import numpy as np
import pytest

from candlewick.llm import language_backoff as L
from candlewick.llm.common import prepare

DIR = "/root/testdata/sf0.01"


def model():
    v = lambda *x: np.log(np.array(x))
    grams = {n: {} for n in range(1, L.LONGEST + 1)}
    grams[3] = {"\x02qu": v(.9, .1), "qui": v(.5, .5)}
    grams[1] = {"z": v(.2, .8)}
    return L.Model(("aa", "bb"), {"the": v(.7, .3)}, grams)


def test_words_first_then_shorter_grams():
    m = model()
    assert np.allclose(np.exp(m.score_word("the")), [.7, .3])
    assert np.allclose(m.score_word("quiet"), np.mean([np.log([.9, .1]), np.log([.5, .5])], axis=0))
    assert np.allclose(np.exp(m.score_word("jazz")), [.2, .8])
    assert list(m.score_word("xx")) == [0, 0]


@pytest.fixture(scope="module")
def fitted(spark):
    prepare(spark)
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    return docs, L.fit(docs, sample_rows=400, kept_words=3000, kept_grams=3000)


def test_scores_match_brute_force_and_hold_out(fitted):
    docs, m = fitted
    rows = {r.doc_id: r for r in docs.collect()}
    right = total = 0
    for r in L.predict(docs, m).collect():
        words = L.words_of(rows[r.doc_id].text)
        mean = np.mean([m.score_word(w) for w in words], axis=0)
        p = np.exp((mean - mean.max()) * min(len(words), L.EVIDENCE))
        assert r.lang_pred == m.langs[int(np.argmax(mean))] and r.score == pytest.approx(p.max() / p.sum())
        if r.held_out:
            total += 1
            right += r.lang_pred == rows[r.doc_id].lang
    assert total > 100 and right / total >= 0.98


def test_model_is_bounded_and_counts_are_exact(spark):
    prepare(spark)
    docs = spark.createDataFrame([(1, "to be or not to be", "en"), (2, "être ou ne pas être", "fr"), (3, None, "de"),
                                  (4, "no language", None), (6, "to", "en")], "doc_id bigint, text string, lang string")
    from candlewick.llm.common import held_out
    used = {r.doc_id for r in docs.filter(~held_out("doc_id")).collect()}
    m = L.fit(docs, kept_words=3)
    assert set(m.langs) <= {"en", "fr"} and len(m.words) <= 6
    if {1, 6} <= used:
        assert m.words["to"][m.langs.index("en")] > m.words["be"][m.langs.index("en")]


def test_defined_cases(spark, fitted):
    _, m = fitted
    df = spark.createDataFrame([(1, None, "x"), (1, "", "x"), (None, "123 ... !", "x"), (2, "the " * 60_000, "x"),
                                (2, "the " * 60_000, "x")], "doc_id bigint, text string, lang_pred string")
    got = L.predict(df, m).collect()
    assert sorted(r.lang_pred for r in got) == ["en", "en", "und", "und", "und"]
    assert all(0 <= r.score <= 1 for r in got) and L.predict(df.limit(0), m).collect() == []
    none = L.fit(df.selectExpr("doc_id", "text", "CAST(NULL AS string) AS lang"))
    assert {r.lang_pred for r in L.predict(df, none).collect()} == {"und"}


DOCS = "doc_id bigint, text string, lang string"


def test_every_language_is_sampled_at_any_size(spark):
    """A share far below one row in 2**20, as of a language of 1e9 documents."""
    prepare(spark)
    rows = [(i, "the cat sat on the mat", "en") for i in range(200)] + [(i, "le chat est sur la table", "fr") for i in range(200)]
    m = L.fit(spark.createDataFrame(rows, DOCS), sample_rows=1e-4)
    assert m.langs == ("en", "fr") and {"cat", "chat"} <= set(m.words)


def test_a_language_without_letters_wins_nothing(spark):
    prepare(spark)
    rows = [(i, "the cat sat on the mat", "en") for i in range(20)] + [(i, "le chat est sur la table", "fr") for i in range(20)]
    rows += [(i, t, "zz") for i, t in enumerate(["123 456", "", "... !", "_ 7"] * 5)]
    docs = spark.createDataFrame(rows, DOCS)
    m = L.fit(docs)
    assert m.langs == ("en", "fr")
    texts = spark.createDataFrame([(1, "the mat", "x"), (2, "la table", "x"), (3, "unknown", "x")], DOCS)
    assert [r.lang_pred for r in L.predict(texts, m).orderBy("doc_id").collect()][:2] == ["en", "fr"]
    assert all(r.lang_pred != "zz" for r in L.predict(docs, m).collect())
    alone = spark.createDataFrame([r for r in rows if r[2] == "zz"], DOCS)
    assert L.fit(alone).langs == ()


def test_a_language_without_long_grams_is_below_all_others(spark):
    prepare(spark)
    rows = [(i, "elephants wander everywhere", "en") for i in range(20)] + [(i, "a b c d", "xx") for i in range(20)]
    m = L.fit(spark.createDataFrame(rows, DOCS))
    for table in m.grams[5], m.grams[4]:
        assert table and all(v[1] < v[0] for v in table.values())
    assert L.Scorer(m).predict(["elephantine wanderers"])[0] == ["en"]


def test_letters_keep_their_marks_and_numbers_are_none(spark, fitted):
    assert L.words_of("नमस्ते दुनिया, x²½①३ Straße") == ["नमस्ते", "दुनिया", "x", "straße"]
    _, m = fitted
    texts = [(1, "²³ ½ ① ३", "x"), (2, "́́", "x")]
    assert [r.lang_pred for r in L.predict(spark.createDataFrame(texts, DOCS), m).collect()] == ["und", "und"]
    rows = [(i, "²³ ½ ①", "zz") for i in range(20)] + [(i, "नमस्ते दुनिया", "hi") for i in range(20)]
    m = L.fit(spark.createDataFrame(rows, DOCS))
    assert m.langs == ("hi",) and set(m.words) == {"नमस्ते", "दुनिया"}
