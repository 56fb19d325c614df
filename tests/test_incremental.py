"""Full load == initial load + incremental delta (one code path)."""
import pytest

from dwspark.plans.incremental import IncrementalLoad, queries
from dwspark.plans.marts import Marts


def _sorted(df):
    return sorted(tuple(r) for r in df.collect())


def test_initial_plus_delta_equals_full(spark, sf_small):
    inc = IncrementalLoad(spark, sf_small)
    full = Marts(spark, sf_small)
    assert _sorted(inc.fact_sales_initial_plus_delta()) == _sorted(full.fact_sales)
    both = inc.initial.fact_deliveries.unionByName(inc.fact_deliveries_incremental())
    assert _sorted(both) == _sorted(full.fact_deliveries)
    both = inc.initial.fact_purchases.unionByName(inc.fact_purchases_incremental())
    assert _sorted(both) == _sorted(full.fact_purchases)


def test_replaying_a_delta_changes_nothing(spark, sf_small):
    inc = IncrementalLoad(spark, sf_small)
    assert inc.fact_sales_replayed().count() == Marts(spark, sf_small).fact_sales.count()


def test_watermarks_cover_every_source(spark, sf_small):
    wm = {(r.stream, r.source_system): r.watermark for r in IncrementalLoad(spark, sf_small).watermarks.collect()}
    assert set(wm) == {("sales", "WHOLESALE"), ("sales", "RETAIL"), ("purchases", "RETAIL")}
    assert all(v > 0 for v in wm.values())


@pytest.mark.parametrize("name", ["delta_sales", "delta_purchases", "fact_sales_incremental", "fact_purchases_incremental",
                                  "fact_deliveries_incremental", "touched_customers"])
def test_deltas_read_lines_once_and_bounded(spark, sf_small, name):
    plan = queries()[name](spark, sf_small)._jdf.queryExecution().executedPlan().toString()
    scans = [x for x in plan.split("\n") if "FileScan" in x]
    assert sum("lineitem.parquet" in x for x in scans) == 1
    assert all("GreaterThan(l_orderkey" in x for x in scans if "lineitem.parquet" in x)
    assert any("GreaterThan(o_orderkey" in x for x in scans if "orders.parquet" in x)
