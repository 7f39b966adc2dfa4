"""The training-data queries against their DuckDB SQL, and their registration."""

import os

import pytest

from tarmac.llm.queries import ORACLE_SQL, QUERIES

SF = os.environ.get("TARMAC_ORACLE_SF", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_matches_oracle(spark, name):
    from tarmac.testing.compare import compare
    r = compare(spark, name, SF)
    assert r["columns_match"] and r["hash_match"] and r["spark_rows"] == r["oracle_rows"], r


def test_registered():
    from __spark_entry__ import oracle_sql, queries
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(queries()) and set(ORACLE_SQL) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL) - {"op12_spelling"}))
def test_query_has_a_row_for_each_document(spark, name):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = QUERIES[name](spark, SF)
    assert got.select("doc_id").exceptAll(docs.select("doc_id")).isEmpty() and got.count() == docs.count()
