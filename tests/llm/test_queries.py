import os

import pytest

from vellumflow.llm import queries

FOLDER = "/root/testdata/sf0.001"
ROWS = ("op9_exact_top_k", "op11_vector_codes", "op12_filter_audit")


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables")
@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_query(spark, name):
    duckdb = pytest.importorskip("duckdb")
    got = queries.queries()[name](spark, FOLDER).toPandas()
    c = duckdb.connect()
    for t in ("documents", "embeddings", "labels"):
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    if name not in ROWS:
        assert len(got) == c.sql("SELECT count(*) FROM documents").fetchall()[0][0] and got["doc_id"].is_unique
    if name in queries.oracle_sql():
        want = c.sql(queries.oracle_sql()[name]).df()
        cols = sorted(got.columns)
        assert cols == sorted(want.columns)
        both = [sorted(map(tuple, x[cols].astype(str).to_numpy().tolist())) for x in (got, want)]
        assert both[0] == both[1]


def test_names():
    assert {n.split("_")[0] for n in queries.queries()} == {f"op{k}" for k in range(1, 14)}
    assert set(queries.oracle_sql()) <= set(queries.queries())
