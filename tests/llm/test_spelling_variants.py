"""Spelling variants: damage by hand, the gram index against all pairs, and the awkward cases."""

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from candlewick.llm import spelling_variants as S
from candlewick.llm.common import prepare

UPPER = {i: i + 32 for i in range(65, 91)}


def near(a, b):
    """One inserted, deleted or replaced code point, straight from the definition."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def counted(rows):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = run.translate(UPPER)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 97 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            counts[w] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def brute(rows):
    n = counted(rows)
    close = defaultdict(list)
    for a in n:
        for b in n:
            if abs(len(a) - len(b)) < 2 and near(a, b):
                close[a].append(b)
    form = {}
    for w, ws in close.items():
        best = min(ws, key=lambda x: (-n[x], x))
        if n[best] >= 2 * n[w]:
            form[w] = best
    out = Counter()
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out[w, form.get(w), root, n[w], len(close[w]), n[form[w]] if w in form else None] += 1
    return out


def run(spark, rows, schema="doc_id bigint, text string"):
    got = S.spelling_variants(prepare(spark).createDataFrame(rows, schema))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return Counter(tuple(r) for r in got.collect())


def test_runs_and_damage():
    text = "AbÉé naïveāx foo-BAR× 1x😀".encode("utf-16", "surrogatepass").decode("utf-16")
    assert [w.decode("latin-1") for w in S.runs(text)] == ["abÉé", "naïve", "x", "foo", "bar×", "x"]
    words = [f"word{chr(97 + i % 26)}{chr(97 + i // 26)}é".encode("latin-1") for i in range(600)]
    got = dict(S.damaged(words, b"17:"))
    for w in words:
        h = zlib.crc32(b"17:" + w.decode("latin-1").encode())
        assert got.get(w) == (h % len(w) if h % 97 == 0 else None)


@pytest.mark.parametrize("frequent", [1, 8, 64, 10 ** 6])
def test_lists_hold_every_near_word(frequent):
    """Whatever the dictionary: two lists that do not overlap, and each near word in one of them."""
    rng = random.Random(frequent)
    words = {"".join(rng.choice("abcé") for _ in range(rng.randrange(5, 12))) for _ in range(700)}
    words |= {"".join(rng.choice("ab") for _ in range(n)) for n in (23, 24, 47, 48, 49, 50, 60) for _ in range(15)}
    for w in list(words):
        at = rng.randrange(len(w))
        words |= {w[:at] + w[at + 1:], w[:at] + "b" + w[at:], w[:at] + "c" + w[at + 1:]}
    words = sorted(w for w in words if len(w) >= 5)
    grams = Counter(w[p:p + q] for w in words for q in range(2, S.LONGEST_GRAM) for p in S.places(len(w), S.ENDS) if p + q <= len(w))
    total = sum(n for g, n in grams.items() if len(g) == 2)
    d = S.Dictionary({g: n for g, n in grams.items() if n * frequent > total}, total)
    lists = defaultdict(set)
    for w in words:
        for k in d.listed(w):
            lists[k].add(w)
    found = set()
    for w in words:
        (a, b), (c, e) = d.merged(w)
        assert b <= c or e <= a
        assert {(a, b), (c, e)} <= set(d.decompose(w))
        for k in d.wanted(w):
            found |= {frozenset((w, x)) for x in lists[k] if x != w and near(w, x)}
    want = {frozenset((a, b)) for a in words for b in words if a < b and near(a, b)}
    assert found == want


def test_random_texts_match_all_pairs(spark):
    rng = random.Random(5)
    base = ["".join(rng.choice("abcdé") for _ in range(rng.randrange(5, 9))) for _ in range(40)]
    rows = []
    for i in range(150):
        words = []
        for _ in range(60):
            w = rng.choice(base)
            if rng.random() < .3:
                at = rng.randrange(len(w))
                w = rng.choice([w[:at] + w[at + 1:], w[:at] + "a" + w[at:], w[:at] + "b" + w[at + 1:]])
            words.append(w.upper() if w.isascii() and rng.random() < .2 else w)
        rows.append((i, " ".join(words)))
    rows += [(200 + i, "zzxxx zzxxy zzxxy zzxyy zzxyy zzxyy zzxyy zzxyy") for i in range(9)]  # a chain of forms
    got = run(spark, rows)
    assert got == brute(rows)
    assert any(form and root != form for _, form, root, *_ in got)


def test_very_long_words(spark):
    long = "abcdefghij" * 3000
    rows = [(i, f"{long} {long} {long[:-1]} {long[:500]}x{long[500:]} {'ab' * 32} {'ab' * 32}c") for i in range(1, 6)]
    rows += [(9, f"{long} " * 20)]
    assert run(spark, rows) == brute(rows)


def test_defined_cases(spark):
    rows = [(None, "words Words WORDS wordz"), (1, None), (2, ""), (3, "wordz wordz words"), (3, "wordz wordz words"),
            (4, "123 ... 中文"), (5, "tie1 tied tieda tieda tieda tiedb tiedb tiedb tiedc tiedc tiedc")]
    rows += [(6, "tieds " * 7)]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == Counter()
    docs = spark.createDataFrame([(1, "words words words", "x", 2)], "doc_id int, text string, word string, n int")
    assert [tuple(r) for r in S.spelling_variants(docs).collect()] == [("words", None, "words", 3, 0, None)]
