"""The stored warehouse (full load) serves the same answers as the
computed marts, and period filters prune the year partitions."""
from dwspark.oracle.compare import canonical
from dwspark.plans import dashboards as D
from dwspark.plans.marts import Marts
from dwspark.plans.registry import SAMPLE_FILTERS
from dwspark.plans.warehouse import StoredMarts, full_load


def test_stored_marts_answer_like_computed(spark, sf_small):
    st, m = StoredMarts(spark, full_load(spark, sf_small)), Marts(spark, sf_small)
    for name in ["fact_sales", "fact_purchases", "fact_deliveries", "dim_address", "dim_employee"]:
        a, b = getattr(st, name).drop(*(["year"] if name.startswith("fact") else [])), getattr(m, name)
        assert canonical(a.collect(), a.columns) == canonical(b.collect(), b.columns), name
    for fn in D.ALL + [D.sales_cube_category_quarter, D.sales_by_currency]:
        for f in (None, SAMPLE_FILTERS):
            a = fn(st) if f is None else fn(st, f)
            b = fn(m) if f is None else fn(m, f)
            assert canonical(a.collect(), a.columns) == canonical(b.collect(), b.columns), fn.__name__
    plan = D.sales_total(st, SAMPLE_FILTERS)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
