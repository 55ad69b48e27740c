"""Merkle manifest: the persistent tree, blocks of many sizes and awkward rows against a plain tree."""

import zlib
from collections import Counter
from hashlib import sha256

import pytest

from candlewick.llm import merkle_manifest as M
from candlewick.llm.common import prepare

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def digest(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row, more=0):
    i, text, lang, source, n = row
    values = (i, source, lang, n if n is None else n + more, text)
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def plain_levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([digest(*out[-1][i:i + 2]) for i in range(0, len(out[-1]), 2)])
    return out


def plain_steps(levels, at):
    """(sibling or None, sibling is left) from the leaf's level up."""
    out = []
    for row in levels[:-1]:
        other = at ^ 1
        out.append((row[other] if other < len(row) else None, other < at))
        at //= 2
    return out


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in order:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    trees = {g: plain_levels([leaf(r) for r in groups[g]]) for g in order}
    top = plain_levels([trees[g][-1][0] for g in order])
    out = Counter()
    for k, g in enumerate(order):
        for at, r in enumerate(groups[g]):
            steps = plain_steps(trees[g], at) + plain_steps(top, k)
            odd = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            h = leaf(r, 1 if odd else 0)
            for other, is_left in steps:
                h = digest(h) if other is None else digest(other, h) if is_left else digest(h, other)
            proof = digest(*[s for s, _ in steps if s is not None])
            out[r[0], leaf(r), trees[g][-1][0], top[-1][0], proof, h, h == top[-1][0]] += 1
    return out


def run(spark, rows, most=M.LEVELS):
    got = M.manifest(prepare(spark).createDataFrame(rows, SCHEMA), most)
    return Counter(tuple(r) for r in got.collect())


def test_versions_share_untouched_nodes():
    leaves = [digest(str(i)) for i in range(11)]
    tree = M.PersistentTree(leaves, 4)
    before, size = list(tree.digest), len(tree.digest)
    version = tree.with_leaf(tree.root, 6, digest("new"))
    assert tree.digest[:size] == before                      # nothing changed in place
    assert len(tree.digest) == size + 1 + 4                  # the leaf and its ancestors alone
    assert tree.digest[version] == plain_levels(leaves[:6] + [digest("new")] + leaves[7:])[-1][0]
    other = tree.with_leaf(version, 0, digest("more"))       # a version of a version
    assert tree.digest[other] == plain_levels([digest("more")] + leaves[1:6] + [digest("new")] + leaves[7:])[-1][0]
    assert tree.digest[tree.root] == plain_levels(leaves)[-1][0]
    assert M.fold(digest("new"), tree.path(tree.root, 6)) == tree.digest[version]


@pytest.mark.parametrize("n", [1, 2, 3, 5, 8, 13, 16])
def test_paths_fold_to_the_root(n):
    leaves = [digest(str(i)) for i in range(n)]
    tree = M.PersistentTree(leaves, (n - 1).bit_length())
    assert tree.digest[tree.root] == plain_levels(leaves)[-1][0]
    for i, d in enumerate(leaves):
        assert M.fold(d, tree.path(tree.root, i)) == tree.digest[tree.root]


def rows_of(sizes):
    out, i = [], 0
    for lang, n in sizes:
        for _ in range(n):
            out.append((i, f"text {i}\n" * (i % 4), lang, None if i % 5 == 0 else f"s{i % 3}", None if i % 11 == 0 else i))
            i += 3
    return out


def test_small_blocks_match_the_plain_tree(spark):
    """Blocks of four: several levels of blocks, partial and lone ones."""
    rows = rows_of([("en", 69), ("de", 16), (None, 17), ("é", 1), ("z", 5), ("", 4)])
    assert run(spark, rows, 2) == brute(rows)


def test_large_group_matches_the_plain_tree(spark):
    rows = rows_of([("en", 2500), ("fr", 1024), ("xx", 1025)])
    assert run(spark, rows) == brute(rows)


def test_awkward_rows(spark):
    rows = [(None, None, None, None, None), (None, "a", None, None, 1), (7, "", "en", "", 0), (7, "", "en", "", 0),
            (7, "other", "en", "s", (1 << 63) - 1), (-3, "ü€", "en", None, None), (20, "x", "en", "s", (1 << 63) - 1)]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == Counter()
    assert run(spark, rows[:1]) == brute(rows[:1])


def test_null_counts_stay_when_tampered(spark):
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 7 == 0]
    rows = [(i, "t", "en", "s", None) for i in ids]
    assert all(verified for *_, verified in run(spark, rows))
    rows = [(i, "t", "en", "s", 1) for i in ids]
    assert not any(verified for *_, verified in run(spark, rows))


def test_other_columns_are_ignored(spark):
    docs = prepare(spark).createDataFrame(rows_of([("en", 9)]), SCHEMA)
    more = docs.selectExpr("*", "'x' AS g", "1 AS pos", "2 AS n", "'y' AS digest", "'z' AS root")
    assert sorted(M.manifest(more).collect()) == sorted(M.manifest(docs).collect())
