"""Gumbel top-k sampling against enumerated lattices; round trips over odd texts."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from candlewick.llm import gumbel_segmentation as G
from candlewick.llm.common import prepare

TEXTS = ["Hello  world\nfoo", "", None, " lead", "trail ", "\n\n", "a\tb", "é\x00z", "日本😀", "▁x a▁b", "   ",
         "x" * 3000, "the cat " * 400, "ﬁ Å y", "\U0010ffff", "123.45, ok!"]


@pytest.fixture(scope="module")
def lattices():
    return G.Lattices(G.load_vocabulary(), 0.3)


def enumerated(vocab, text, smoothing):
    """{ids: log probability} of all segmentations of a short text without line breaks."""
    text, out = " " + text, {}

    def go(i, ids, w):
        if i == len(text):
            out[tuple(ids)] = w
        for j in range(i + 1, len(text) + 1):
            if text[i:j] in vocab.ids:
                go(j, ids + [vocab.ids[text[i:j]]], w + smoothing * vocab.weight[text[i:j]])
        if text[i:i + 1] and text[i] not in vocab.ids:
            raw = text[i].encode()
            go(i + 1, ids + [vocab.byte_ids[b] for b in raw], w + smoothing * vocab.byte_weight * len(raw))

    go(0, [], 0.0)
    total = math.log(sum(map(math.exp, out.values())))
    return {k: v - total for k, v in out.items()}


def test_round_trip_and_distinct_samples(lattices):
    got = G.sample_texts(lattices, TEXTS, np.arange(len(TEXTS)), 4)
    for t, own in zip(TEXTS, got):
        seen = {tuple(s["ids"].tolist()) for s in own}
        assert 1 <= len(own) == len(seen) <= 4
        assert all(a["perturbed"] >= b["perturbed"] for a, b in zip(own, own[1:]))
        for s in own:
            assert G.decode_ids(lattices.vocab, s["ids"].tolist()) == (t or "")
    assert [len(got[1]), len(got[2])] == [1, 1] and got[1][0]["log_inclusion"] == 0.0


@pytest.mark.parametrize("text", ["then", "at é", "ab▁"])
def test_samples_follow_the_enumerated_distribution(lattices, text):
    want = enumerated(lattices.vocab, text, 0.3)
    n = 6000
    got = G.sample_texts(lattices, [text] * n, np.arange(n), 2)
    first, second = Counter(), Counter()
    for own in got:
        for s in own:
            assert s["log_prob"] == pytest.approx(want[tuple(s["ids"].tolist())], abs=1e-5)
        first[tuple(own[0]["ids"].tolist())] += 1
        second[tuple(own[1]["ids"].tolist())] += 1
    p = {k: math.exp(v) for k, v in want.items()}
    for k, x in p.items():
        both = sum(p[a] * x / (1 - p[a]) for a in p if a != k)  # drawn second, without replacement
        for share, count in ((x, first[k]), (both, second[k])):
            assert abs(count / n - share) <= 5 * math.sqrt(share * (1 - share) / n) + 1e-3


def test_all_segmentations_of_a_short_text_are_certain(lattices):
    want = enumerated(lattices.vocab, "ab", 0.3)
    own = G.sample_texts(lattices, ["ab"], np.array([5]), 50)[0]
    assert {tuple(s["ids"].tolist()) for s in own} == set(want)
    assert all(s["log_inclusion"] == 0.0 for s in own)


def test_inclusion_probability_of_the_threshold(lattices):
    """Horvitz-Thompson: sums of 1 / inclusion over samples estimate the number of segmentations."""
    flat = G.Lattices(lattices.vocab, 0.05)
    want = enumerated(lattices.vocab, "then", 0.05)
    got = G.sample_texts(flat, ["then"] * 4000, np.arange(4000), 3)
    est = np.mean([sum(math.exp(-s["log_inclusion"]) for s in own) for own in got])
    assert est == pytest.approx(len(want), rel=0.15)


def test_batches_and_kept_words_do_not_change_samples(lattices, monkeypatch):
    texts = [t for t in TEXTS if t] * 2
    keys = np.arange(len(texts))
    want = G.sample_texts(lattices, texts, keys, 3)
    monkeypatch.setattr(G, "KEPT_BYTES", 3)
    for i in reversed(range(len(texts))):
        own = G.sample_texts(lattices, [texts[i]], keys[i:i + 1], 3)[0]
        assert [s["ids"].tolist() for s in own] == [s["ids"].tolist() for s in want[i]]


def test_operator_and_decode(spark):
    prepare(spark)
    rows = [(i, t, "clash", 1) for i, t in enumerate(TEXTS)] + [(0, TEXTS[0], "x", 2), (None, "no key", "x", 3)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, samples string, ids int").repartition(3)
    got = G.sample_segmentations(df, 3)
    assert got.columns == ["doc_id", "text", "ids", "samples", "round_trip"]
    assert got.count() == len(rows) and got.filter("NOT round_trip").count() == 0
    one = got.select("text", F.explode("samples.ids").alias("ids"))
    back = G.decode(one).collect()
    assert back and all(r.decoded == (r.text or "") for r in back)
    same = [r.samples for r in got.filter("doc_id = 0").collect()]
    assert len(same) == 2 and same[0] == same[1]
    assert G.sample_segmentations(df.limit(0)).collect() == []


def test_units_split_texts_as_stated():
    texts = [" Hello  world\nfoo", "   ", " a \n\n  b  ", " x", " \n"]
    code = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    first = np.cumsum([0, *map(len, texts)])[:-1]
    begin = G.unit_starts(code, first).tolist()
    whole = "".join(texts)
    got = [whole[a:b] for a, b in zip(begin, begin[1:] + [len(whole)])]
    assert got == [" Hello", "  world", "\n", "foo", "   ", " a", " ", "\n", "\n", "  b", "  ", " x", " ", "\n"]


def test_equal_words_alone_have_equal_hashes():
    texts = ["ab", "abc", "ba", "ab", "b", "abab", "\n", " ab", "ab"]
    code = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    size = np.array([*map(len, texts)])
    h = G.word_hashes(code, np.cumsum(size) - size, size)
    assert [(x == y) for x in h for y in h] == [(x == y) for x in texts for y in texts]


def test_kept_lattices_are_bounded_by_bytes(lattices, monkeypatch):
    """Long words fill the room sooner; samples stay the same."""
    rng = np.random.default_rng(1)
    texts = ["".join(map(chr, rng.integers(97, 123, 400))) for _ in range(300)]
    keys = np.arange(300)
    want = G.sample_texts(lattices, texts, keys, 2)
    monkeypatch.setattr(G, "KEPT_BYTES", 2 << 20)
    monkeypatch.setattr(G, "RUN_SIGNS", 4000)
    small, most = G.Lattices(lattices.vocab, 0.3), 0
    for i in range(0, 300, 10):
        got = G.sample_texts(small, texts[i:i + 10], keys[i:i + 10], 2)
        assert [[s["ids"].tolist() for s in x] for x in got] == [[s["ids"].tolist() for s in x] for x in want[i:i + 10]]
        most = max(most, small.bytes_kept())
    assert most < (2 << 20) + (2 << 20)


def test_models_of_one_size_do_not_share_lattices(lattices):
    """Two vocabularies of as many pieces, one after the other in a worker."""
    import pyarrow as pa
    vocab = lattices.vocab
    a, b = vocab.ids["the"], vocab.ids["and"]
    swapped = {**vocab.ids, "the": b, "and": a}
    data = list(vocab.data)
    data[a], data[b] = data[b], data[a]
    other = G.Vocabulary(swapped, vocab.weight, vocab.byte_ids, vocab.byte_weight, tuple(data))
    assert other.digest != vocab.digest
    batch = pa.RecordBatch.from_arrays([pa.array(["the and the"] * 9), pa.array(range(9), pa.int64())], names=["__text", "__key"])

    class Sent:
        def __init__(self, value):
            self.value = value

    for v in (vocab, other, vocab):
        out, = G._sample_batches(iter([batch]), Sent(v), 2, 0.3)
        assert all(out.column("round_trip").to_pylist())
