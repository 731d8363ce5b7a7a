import os

import pytest

from vellumflow import catalogue

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents pages conversations benchmark labels embeddings".split()


def rows(frame):
    cols = sorted(frame.columns)
    return sorted(tuple(str(float(x)) if isinstance(x, float) else str(x) for x in r) for r in frame[cols].astype(object).where(frame[cols].notna(), None).itertuples(index=False))


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables")
@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_query_against_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    got = catalogue.queries()[name](spark, FOLDER).toPandas()
    assert len(got.columns) and len(got) >= 0
    if name in catalogue.oracle_sql():
        c = duckdb.connect()
        for t in TABLES:
            c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
        want = c.sql(catalogue.oracle_sql()[name]).df()
        assert sorted(got.columns) == sorted(want.columns) and rows(got) == rows(want)


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_aps_records_keep_long_values(spark, tmp_path):
    made = spark.createDataFrame([(1, "x" * 3000, "m", 2)], "c_custkey long, c_name string, c_mktsegment string, c_nationkey long")
    made.write.parquet(f"{tmp_path}/customer.parquet")
    got = {r["field"]: r["value"] for r in catalogue.queries()["aps_records"](spark, str(tmp_path)).collect()}
    assert got["TTL"] == "x" * 3000 + " m more"
