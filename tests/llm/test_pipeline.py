"""The pipeline on sf0.001: every stage against a brute-force decision on its own input."""

import pytest

from candlewick.llm import decontaminate as D
from candlewick.llm import pii_bootstrap as P
from candlewick.llm import quality_rules as Q
from candlewick.llm.common import prepare, read_table, staged

pipeline = pytest.importorskip("corpus_pipeline")
DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    prepare(spark)
    docs, out = read_table(spark, DIR, "documents"), []
    for name, f in pipeline.STAGES:
        got = staged(f(spark, docs, DIR), "stage")
        out.append((name, docs, got))
        docs = got
    return out


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages_and_columns(spark, stages):
    assert [n for n, _, _ in stages] == ["quality classifier", "SimHash near-dedup", "benchmark decontamination",
                                         "PII", "SentencePiece encoding and decoding"]
    first = read_table(spark, DIR, "documents").columns
    for _, _, got in stages[:-1]:
        assert got.columns == first
    assert stages[-1][2].columns == [*first, "samples", "round_trip"]


def test_quality_rejects_what_the_model_rejects(spark, stages):
    _, docs, got = stages[0]
    model = Q.fit(docs, read_table(spark, DIR, "labels"))
    keep = {r.doc_id for r in Q.classify(docs, model).collect() if r.score >= Q.THRESHOLD}
    assert set(by_id(got)) == keep


def test_one_of_each_near_duplicate_group(stages):
    from tests.llm.test_simhash_bktree import slow_components, slow_fingerprint
    _, docs, got = stages[1]
    rows = [(d, slow_fingerprint(r.text)) for d, r in by_id(docs).items()]
    assert set(by_id(got)) == set(slow_components(rows, 4))


def test_leaks_go_and_the_rest_stays(spark, stages):
    from tests.llm.test_decontaminate import slow_align
    _, docs, got = stages[2]
    items = [D.words_of(r.text) for r in read_table(spark, DIR, "benchmark").collect()]
    text = {d: D.words_of(r.text) for d, r in by_id(docs).items()}
    held = {d for d, t in text.items() for i in items if " ".join(i) in " ".join(t)}
    gone = set(text) - set(by_id(got))
    assert held <= gone
    for d in gone - held:
        assert max(slow_align(i, text[d]) / (2 * len(i)) for i in items) >= D.MIN_SCORE


def test_personal_data_is_gone_and_clean_texts_are_unchanged(stages):
    from tests.llm.test_pii_bootstrap import slow_spans
    _, docs, got = stages[3]
    before, after = by_id(docs), by_id(got)
    assert set(before) == set(after)
    for d, r in after.items():
        assert slow_spans(r.text) == [] and r.n_chars == len(r.text)
        if not slow_spans(before[d].text) and "[ID]" not in r.text:
            assert r.text == before[d].text
        assert (r.text != before[d].text) == any(f"[{k.upper()}]" in r.text for k in (*P.KINDS, P.FOUND))


def test_segmentations_decode(stages):
    _, docs, got = stages[4]
    assert set(by_id(docs)) == set(by_id(got)) and got.filter("NOT round_trip").count() == 0


def test_run_is_the_stages_in_order(spark, stages):
    import __spark_entry__ as E
    got = E.queries()["pipeline"](spark, DIR)
    assert {(r.doc_id, r.text) for r in got.collect()} == {(r.doc_id, r.text) for r in stages[-1][2].collect()}
