"""The registered corpus queries: SQL oracles where there are any, and one row per row of the table for all."""

from collections import Counter

import duckdb
import pytest

from flighttables.llm import queries

SF = "/root/testdata/sf0.001"


def test_registry():
    assert {int(k[2:].split("_")[0]) for k in queries.QUERIES} == set(range(1, 14))
    assert set(queries.ORACLE_SQL) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.sql(queries.ORACLE_SQL[name])
    got = queries.QUERIES[name](spark, SF).select(*want.columns)
    assert Counter(map(tuple, got.collect())) == Counter(want.fetchall())


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLE_SQL)))
def test_a_row_for_every_row(spark, name):
    table = "pages" if name.startswith("op3") else "documents"
    key = "page_id" if table == "pages" else "doc_id"
    got = [r[key] for r in queries.QUERIES[name](spark, SF).select(key).collect()]
    assert sorted(got) == sorted(r[key] for r in spark.read.parquet(f"{SF}/{table}.parquet").select(key).collect())
