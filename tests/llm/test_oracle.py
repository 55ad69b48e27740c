"""Registered queries of the training-data operators against their SQL, and their contracts' columns."""

from collections import Counter

import pytest

from candlewick.llm.queries import ORACLE_SQL, QUERIES

DIR = "/root/testdata/sf0.001"
COLUMNS = {
    "op3": ["page_id", "url", "text", "n_chars"],
    "op4": ["doc_id", "held_out", "score", "predicted"],
    "op5": ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
    "op8": ["doc_id", "held_out", "lang_pred", "score"],
    "op11": ["word", "form", "root", "n", "n_near", "form_n"],
    "op12": ["doc_id", "n_lines", "n_dropped", "kept_sha256"],
    "op13": ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"],
}


@pytest.mark.parametrize("key", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, key):
    import duckdb
    con = duckdb.connect()
    for t in ("pages", "conversations", "documents"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DIR}/{t}.parquet')")
    df = QUERIES[key](spark, DIR)
    rel = con.sql(ORACLE_SQL[key])
    cols = sorted(df.columns)
    assert cols == sorted(rel.columns)
    own = Counter(tuple(r[c] for c in cols) for r in df.collect())
    at = [rel.columns.index(c) for c in cols]
    assert own == Counter(tuple(r[i] for i in at) for r in rel.fetchall())


@pytest.mark.parametrize("op", sorted(COLUMNS))
def test_contract_columns(spark, op):
    key, = (k for k in QUERIES if k.startswith(op + "_"))
    assert QUERIES[key](spark, DIR).columns == COLUMNS[op]


def test_one_query_for_each_operator():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))
