"""Plan properties: pruned scans, pushed filters, no shuffle join of the fact table."""

import re

import pytest

from tarmac.operators import delays, features as ft, traffic

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def flights(spark, tmp_path_factory):
    from tarmac.sources import testviews as tv
    path = str(tmp_path_factory.mktemp("fl") / "flights")
    tv.flights(spark, SF).write.parquet(path)
    return spark.read.parquet(path)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_is_pruned_and_filtered(flights):
    plan = _plan(delays.top_dep_delays(flights, 0))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert sorted(f.split(":")[0] for f in schema.split(",")) == ["DEP_DELAY", "ORIGIN"]
    assert "IsNotNull(DEP_DELAY)" in plan


def test_traffic_scans_once(flights):
    plan = _plan(traffic.airport_traffic(flights))
    assert plan.count("FileScan parquet") == 1
    assert "Join" not in plan


def test_history_joins_do_not_shuffle_the_facts(spark, flights):
    base = ft.delay_base(flights)
    model = ft.fit_history(base)
    df = model.transform(base)
    df.write.format("noop").mode("overwrite").save()
    final = _plan(df)
    # the two averages by origin come from one lookup; each lookup reads its own folder
    assert final.count("BroadcastHashJoin") == 6
    assert len(re.findall(r"PartitionFilters: \[[^\]]*gid", final)) >= 6
    assert "SortMergeJoin" not in final
