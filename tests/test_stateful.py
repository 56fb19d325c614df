"""The stateful load: what it writes, what its delta reads, and that it is real."""
from collections import Counter

import pytest
from pyspark.sql import functions as F

from dwspark.plans.stateful import VERSIONED, StatefulLoad


@pytest.fixture(scope="module")
def load(spark, sf_small):
    return StatefulLoad(spark, sf_small)


def test_every_kind_of_change_occurs_and_history_is_sound(load):
    for entity, (_, keys) in VERSIONED.items():
        kinds = Counter(r.change for r in load.dim_incremental(entity).collect())
        assert kinds["update"] and kinds["unchanged"], entity
        h = load.history(entity)
        per = h.groupBy(*keys).agg(F.sum(F.col("is_current").cast("int")).alias("c"), F.count("*").alias("n"))
        assert per.filter("c <> 1 OR n > 2").count() == 0
    assert Counter(r.change for r in load.dim_incremental("customer").collect())["insert"]


def test_the_delta_is_bounded_in_both_scans_and_its_lines_are_read_once(load, spark, sf_small):
    from dwspark.plans.corporate import Corporate
    from dwspark.plans.stateful import BoundedSources
    plan = Corporate(BoundedSources(spark, sf_small, load.bounds)).sales_items._jdf.queryExecution().executedPlan().toString()
    scans = [x for x in plan.split("\n") if "FileScan" in x or "PushedFilters" in x]
    assert sum("lineitem" in x for x in scans) == 1
    assert "GreaterThan(l_orderkey" in plan and "GreaterThan(o_orderkey" in plan


def test_initial_and_delta_are_all_sales_once(load, spark, sf_small):
    from dwspark.plans.marts import Marts
    want = Marts(spark, sf_small).fact_sales_core.groupBy("source_system", "sale_id").agg(F.count("*"))
    got = load.sales.groupBy("source_system", "sale_id").agg(F.count("*"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_versions_join_headers_and_lines_before_these_meet(load, spark):
    """Customers and employees join a row per sale, products the lines as the source has them: no joined item is dealt anew."""
    src = load.earlier.src
    plan = load._versioned(load.earlier, src.header_attributes(src.orders), load.initial)._jdf.queryExecution().optimizedPlan().toString()
    joins = [x for x in plan.split("\n") if "Join " in x]
    assert "Join Inner" in joins[0] and "l_orderkey" in joins[0] and sum("Join LeftOuter" in x for x in joins[1:]) >= 3


def test_sales_without_an_employee_do_not_meet_in_one_task(spark):
    from dwspark.plans.stateful import _with_version
    rows = spark.createDataFrame([("RETAIL", None, 1), ("WHOLESALE", "7", 2), ("WHOLESALE", "8", 3)], "source_system string, employee_id string, n int")
    current = spark.createDataFrame([("WHOLESALE", "7", 70)], "source_system string, employee_id string, employee_version_key long")
    got = _with_version(rows, current, "employee")
    assert sorted((r.n, r.employee_version_key) for r in got.collect()) == [(1, -1), (2, 70), (3, -1)]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan.split("\n")[0] and "isnotnull(employee_id" in plan


def test_fresh_items_joins_only_where_the_target_holds_ids_of_the_batch(spark):
    from dwspark.operators.sinks import fresh_items
    shape = "source_system string, sale_id string, n long"
    held = spark.createDataFrame([("A", "1", 1), ("A", "9", 9), ("B", "5", 5)], shape)
    batch = spark.createDataFrame([("A", "9", 9), ("A", "10", 10), ("A", "10", 10), ("B", "6", 6)], shape)
    assert sorted(r.n for r in fresh_items(held, batch, ["source_system", "sale_id"], "n").collect()) == [6, 10, 10]
    later = batch.filter("n <> 9")                                 # 9 is held, but not by the source whose ids begin at 6
    assert fresh_items(held, later, ["source_system", "sale_id"], "n") is later
    assert fresh_items(held, later.filter("false"), ["source_system", "sale_id"], "n").count() == 0
