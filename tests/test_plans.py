"""Plan checks: no Python UDFs or cartesian products, filters and column
pruning reach the parquet scan, bounded dimensions are broadcast."""
import pytest

from dwspark.plans import registry as E
from dwspark.operators.filters import MartFilters
from dwspark.plans import dashboards as D
from dwspark.plans.marts import Marts

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(n for n in E.queries() if not n.startswith("stream_")))
def test_no_udf_no_cartesian(spark, name):
    p = _plan(E.queries()[name](spark, SF))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in p, f"{name} uses {bad}"


@pytest.mark.parametrize("card", D.DELIVERIES, ids=lambda c: c.__name__)
def test_period_filter_of_deliveries_reaches_the_orders_scan(spark, card):
    p = _plan(card(Marts(spark, SF), MartFilters(date_from="1996-01-01", date_to="1996-12-31")))
    scans = [line for line in p.split("\n") if "orders.parquet" in line and "o_orderdate" in line]
    assert scans and all("GreaterThanOrEqual(o_orderdate" in line for line in scans)
    reads_keys = card.__name__ in ("deliveries_top10_employees",) or "carrier" in card.__name__
    assert reads_keys or "s_suppkey#" not in "".join(x for x in p.split("\n") if "FileScan" in x and "s_name" in x)


def test_period_filter_and_pruning_reach_the_scan(spark):
    m = Marts(spark, SF)
    df = D.deliveries_count(m, MartFilters(date_from="1996-01-01", date_to="1996-12-31"))
    p = _plan(df)
    assert "PushedFilters: [IsNotNull(o_orderdate)" in p or "GreaterThanOrEqual(o_orderdate" in p
    li_scan = [line for line in p.split("\n") if "lineitem" in line and "ReadSchema" in line]
    assert li_scan and all("l_returnflag" not in line for line in li_scan)


def test_calendar_and_bounded_dims_are_broadcast(spark):
    p = _plan(D.deliveries_carrier_summary(Marts(spark, SF)))
    assert "BroadcastHashJoin" in p


def _scans(df, table):
    """Scans of a table in the physical plan before any exchange is reused."""
    return sum(f"/{table}.parquet" in line for line in _plan(df).split("\n"))


def test_each_fact_reads_its_lines_once(spark):
    m = Marts(spark, SF)
    assert _scans(m.fact_purchases, "lineitem") == 1
    assert _scans(m.fact_deliveries, "lineitem") == 1
    assert _scans(m.fact_sales_core, "lineitem") == 1
    assert _scans(m.dim_employee, "lineitem") == 0
    assert _scans(D.sales_total(m), "customer") == 0


def test_quality_jobs_read_the_stored_layer(spark):
    from dwspark.plans import quality_queries as QQ
    assert _scans(QQ.dq_foreign_keys(spark, SF), "lineitem") == 0
