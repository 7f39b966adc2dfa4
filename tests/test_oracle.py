"""Every relational key of queries() against its DuckDB oracle (the driver's check).

The training-data queries, where installed, have their tests in tests/llm.
"""

import os
import re

import pytest

SF = os.environ.get("TARMAC_ORACLE_SF", "/root/testdata/sf0.01")

from __spark_entry__ import oracle_sql, queries  # noqa: E402


@pytest.fixture(scope="module")
def con():
    from tarmac.testing.compare import duck
    return duck(SF)


def own(names):
    return {n for n in names if not re.match(r"op\d+_|pipeline$", n)}


@pytest.mark.parametrize("name", sorted(own(oracle_sql())))
def test_matches_oracle(spark, con, name):
    from tarmac.testing.compare import compare
    r = compare(spark, name, SF, con)
    assert r["columns_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["hash_match"], r


def test_every_key_is_registered():
    assert set(oracle_sql()) <= set(queries())
    rows_only = own(set(queries()) - set(oracle_sql()))
    assert rows_only == {"delay_model_metrics", "delay_feature_importance", "fare_model_metrics",
                         "delay_model_v2_metrics", "delay_feature_importance_v2",
                         "model_comparison"}


def test_entry_smoke(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert df.columns == ["airport", "departure_count", "arrival_count", "total_traffic"]
    rows = df.collect()
    assert len(rows) == 25
    totals = [r.total_traffic for r in rows]
    assert totals == sorted(totals, reverse=True)
