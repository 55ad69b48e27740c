"""Shared lines: whole texts by hand, a brute-force version, and the awkward cases."""

import random
from collections import Counter, defaultdict

import pytest

from candlewick.llm import line_dedup as L
from candlewick.llm.common import prepare

SPACE = " \t\n\x0b\x0c\r"
UPPER = {i: i + 32 for i in range(65, 91)}


def brute(rows, least=20, docs=3):
    """{(id, text): kept text}, straight from the definition."""
    key = lambda line: line.strip(SPACE).translate(UPPER)
    held = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= least:
                held[key(line)].add(i)
    last = {k: max((i for i in ids if i is not None), default=None) for k, ids in held.items() if len(ids) >= docs}
    out = {}
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if key(x) not in last or i == last[key(x)]]
        out[i, text] = ("\n".join(kept), len(lines), len(lines) - len(kept))
    return out


def run(spark, rows, schema="doc_id bigint, text string"):
    got = L.drop_shared_lines(prepare(spark).createDataFrame([(i, t) for i, t in rows], schema))
    assert got.columns == ["doc_id", "text", "n_lines", "n_dropped"]
    return Counter((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in got.collect())


def expected(rows):
    want = brute(rows)
    return Counter((i, *want[i, t]) for i, t in rows)


def test_random_texts_match_brute_force(spark):
    rng = random.Random(3)
    pool = [f"{'Shared line of many words ' * (i % 2)}number {i}, ÄÖ{'x' * (i % 25)}" for i in range(40)]
    rows = []
    for i in range(120):
        lines = [rng.choice(pool) for _ in range(rng.randrange(12))]
        lines = [rng.choice(["", " ", "\t"]) + (x.upper() if rng.random() < .3 and x.isascii() else x) + rng.choice(["", "\r", "  "])
                 for x in lines]
        rows.append((i, "\n".join(lines)))
    assert run(spark, rows) == expected(rows)


def test_defined_cases(spark):
    a, b = "one line that is shared by all", "another shared line, longer than twenty"
    rows = [(1, None), (2, ""), (3, f"{a}\n\n{a}"), (4, f"{a}\n{b}"), (5, f"{b}\n{a}\n  {a.upper()}\t"), (6, b),
            (None, f"{a}\nmine"), (None, a), (4, "other text\n" + b), (4, "other text\n" + b), (7, "\n\n"),
            (8, "Äa" * 10), (9, "Äa" * 10), (10, "äa" * 10), (11, "short shared line 9"), (12, "short shared line 9"),
            (13, "short shared line 9")]
    assert run(spark, rows) == expected(rows)
    assert run(spark, []) == Counter()


def test_ids_without_a_number_are_one_document(spark):
    line = "a line of twenty signs or more"
    assert run(spark, [(None, line)] * 5) == Counter({(None, line, 1, 0): 5})
    rows = [(None, line)] * 5 + [(1, line), (2, line)]
    assert run(spark, rows) == Counter({(None, "", 1, 1): 5, (1, "", 1, 1): 1, (2, line, 1, 0): 1})


def test_very_long_text(spark):
    lines = [f"line number {i} of a very long document" for i in range(50_000)]
    rows = [(1, "\n".join(lines)), (2, "\n".join(lines[::2])), (3, "\n".join(lines[::4]))]
    assert run(spark, rows) == expected(rows)


@pytest.mark.parametrize("hot", [1, 10 ** 9])
def test_hot_lines_give_the_same(spark, monkeypatch, hot):
    monkeypatch.setattr(L, "HOT", hot)
    line = "the line that every document has"
    rows = [(i, f"{line}\nown line of document number {i}\n{line}") for i in range(60)]
    assert run(spark, rows) == expected(rows)


def test_clashing_columns_stay(spark):
    line = "a line of twenty signs or more"
    rows = [(i, line, 1, "x", "y", i, 30) for i in range(3)]
    docs = prepare(spark).createDataFrame(rows, "doc_id bigint, text string, __id int, __dropped string, H1 string, "
                                                "n_lines int, n_chars int")
    got = L.drop_shared_lines(docs)
    assert sorted(got.columns) == sorted(docs.columns + ["n_dropped"])
    assert {(r.doc_id, r.text, r["__id"], r["__dropped"], r.H1, r.n_chars) for r in got.collect()} == {
        (0, "", 1, "x", "y", 0), (1, "", 1, "x", "y", 0), (2, line, 1, "x", "y", 30)}
