"""The warehouse over several loads: chained in sessions of their own, after crashes, and what a load touches."""
import os
import time

import pytest

from dwspark.operators import staging
from dwspark.plans import load_queries as L
from dwspark.plans.loads import ENTITIES, FACTS, VERSIONED, Warehouse
from dwspark.plans.marts import Marts
from dwspark.sources.bounds import EarlierSources


def _rows(df, *dropped):
    df = df.drop(*dropped)
    return sorted(map(str, map(tuple, df.select(sorted(df.columns)).collect())))


def _files(store, prefix):
    at = store.log.read()
    return {p: {f: os.stat(f"{store.base}/{d}/{f}").st_mtime_ns for f in os.listdir(f"{store.base}/{d}") if f.endswith(".parquet")}
            for p, d in at.parts.items() if p.startswith(prefix)}


@pytest.fixture(scope="module")
def chained(spark, sf_small, tmp_path_factory):
    """Three loads, each in a session of its own that knows nothing but the path, with what they left on disk."""
    base, seen = str(tmp_path_factory.mktemp("warehouse")), []
    for load, day in enumerate(L.DAYS):
        other = spark.newSession()
        other.conf.set("spark.sql.shuffle.partitions", "4")
        store = Warehouse(other, base, rows_per_bucket=8)
        store.run(L.sources_at(other, sf_small, load), day)
        seen.append((_files(store, ""), dict(store.log.read().settings)))
    return base, seen


def test_loads_in_separate_sessions_equal_the_full_load(spark, sf_small, chained):
    store, full = Warehouse(spark, chained[0]), Marts(spark, sf_small)
    by_load = ["employee_key", "carrier_key", "address_key", "customer_version_key", "product_version_key", "employee_version_key"]
    for fact in FACTS:
        got, want = store.table(fact), getattr(full, fact)
        same = [c for c in got.columns if c in want.columns and c not in by_load]
        assert len(same) >= 8 and _rows(got.select(same)) == _rows(want.select(same)), fact


def test_a_small_load_writes_the_buckets_of_its_keys_only(spark, sf_small, tmp_path):
    store = Warehouse(spark, str(tmp_path), rows_per_bucket=4)
    cut = 750
    store.run(lambda b: EarlierSources(spark, sf_small, b, cut), L.DAYS[0])
    first, history = _files(store, ""), sum(store.table(e).count() for e in VERSIONED)
    store.run(lambda b: EarlierSources(spark, sf_small, b, cut + 6, 0), L.DAYS[1])
    second, at = _files(store, ""), store.log.read()
    assert at.settings["buckets"]["customer"] >= 32
    for entity in ("customer", "product", "address"):
        parts = [p for p in first if p.startswith(f"{entity}/")]
        kept = [p for p in parts if first[p] == second[p]]
        assert len(parts) // 2 < len(kept) < len(parts), entity
    for stream in ("sales", "purchases", *FACTS):                          # facts are only added to
        assert all(second[p] == first[p] for p in first if p.startswith(f"{stream}/"))
    assert sum(store.table(e).count() for e in VERSIONED) > history
    per = store.table("customer").groupBy("source_system", "customer_id").agg({"version_key": "count", "is_current": "max"}).collect()
    assert len(per) == store.table("customer").filter("is_current").count()


def test_a_load_without_anything_new_changes_nothing(spark, sf_small, chained):
    store = Warehouse(spark, chained[0])
    before = {t: _rows(store.table(t)) for t in ["sales", "purchases", *FACTS, *ENTITIES]}
    at = store.log.read()
    store.run(L.sources_at(spark, sf_small, 2), "2001-06-01")
    assert store.log.read().settings["watermarks"] == at.settings["watermarks"]
    assert {t: _rows(store.table(t)) for t in before} == before


def test_a_mart_step_that_failed_is_caught_up(spark, sf_small, tmp_path, monkeypatch):
    store = Warehouse(spark, str(tmp_path))
    store.run(L.sources_at(spark, sf_small, 0), L.DAYS[0])

    def crash(*_):
        raise RuntimeError("lost")
    with monkeypatch.context() as m:
        m.setattr(Warehouse, "_fact_deliveries", crash)
        with pytest.raises(RuntimeError):
            store.run(L.sources_at(spark, sf_small, 1), L.DAYS[1])
    stored, sold = (store.table(t).select("source_system", "sale_id").distinct().count() for t in ("fact_sales", "sales"))
    assert stored < sold                                                    # the corporate layer is one load ahead
    store.load_marts()
    assert store.table("fact_sales").count() == store.table("sales").count()
    # by content, not by what a version says it has done
    at = store.log.read()
    store.log.publish(at, at.parts, {**at.settings, "in_marts": []})
    before = {f: _rows(store.table(f)) for f in FACTS}
    store.load_marts()
    assert {f: _rows(store.table(f)) for f in FACTS} == before


def test_a_corporate_load_that_failed_leaves_the_last_version(spark, sf_small, tmp_path, monkeypatch):
    store = Warehouse(spark, str(tmp_path))
    store.run(L.sources_at(spark, sf_small, 0), L.DAYS[0])
    before = {t: _rows(store.table(t)) for t in ["sales", *ENTITIES]}

    def crash(*_):
        raise RuntimeError("lost")
    with monkeypatch.context() as m:
        m.setattr(Warehouse, "_watermarks", crash)
        with pytest.raises(RuntimeError):
            store.load_corporate(L.sources_at(spark, sf_small, 1), L.DAYS[1])
    assert {t: _rows(store.table(t)) for t in before} == before
    assert os.listdir(tmp_path / "staging") == []                          # the run that ended cleared its folder
    store.run(L.sources_at(spark, sf_small, 1), L.DAYS[1])
    assert store.table("fact_sales").count() == store.table("sales").count() > len(before["sales"])


def test_delta_scans_are_bounded_and_read_lines_once(spark, sf_small):
    from dwspark.plans.corporate import Corporate
    plan = Corporate(L.sources_at(spark, sf_small, 2)({"WHOLESALE": 500, "RETAIL": 700})).sales_items._jdf.queryExecution().executedPlan().toString()
    scans = [x for x in plan.split("\n") if "FileScan" in x]
    assert sum("lineitem" in x for x in scans) == 1
    assert "GreaterThan(l_orderkey,500)" in plan and "GreaterThan(o_orderkey,500)" in plan


def test_staging_is_cleared_at_the_end_and_after_a_crash(spark, tmp_path):
    root = str(tmp_path / "staging")
    with staging.StagingRun(spark, root) as run:
        df = run.stage(spark.range(3), "x")
        assert df.count() == 3 and len(os.listdir(root)) == 1
    assert os.listdir(root) == []
    dead, alive = staging.StagingRun(spark, root), staging.StagingRun(spark, root)
    for r in (dead, alive):
        r.__enter__()
        r.stage(spark.range(3), "x")
    old = time.time() - 2 * staging.LEASE_SECONDS
    os.utime(f"{dead.folder}/_lease", (old, old))
    with staging.StagingRun(spark, root) as run:
        assert sorted(os.listdir(root)) == sorted(os.path.basename(r.folder) for r in (alive, run))
    assert os.listdir(root) == [os.path.basename(alive.folder)]


def test_three_loads_of_empty_sources(spark, tmp_path, sf_small):
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem"):
        spark.read.parquet(f"{sf_small}/{t}.parquet").limit(0).write.parquet(str(tmp_path / "in" / f"{t}.parquet"))
    store = Warehouse(spark, str(tmp_path / "out"))
    for load, day in enumerate(L.DAYS[:2]):
        store.run(L.sources_at(spark, str(tmp_path / "in"), load), day)
    assert all(store.table(t).count() == 0 for t in ["sales", "purchases", *FACTS, *ENTITIES])
    assert store.log.read().settings["watermarks"] == {"sales": {"WHOLESALE": 0, "RETAIL": 0}, "purchases": {"RETAIL": 0}}
    store.run(L.sources_at(spark, sf_small, 0), L.DAYS[2])                  # and then there is something
    assert store.table("fact_sales").count() == store.table("sales").count() > 0


def test_stored_items_are_not_staged_again_for_the_facts_and_tables_are_small(spark, sf_small, tmp_path, monkeypatch):
    import pyarrow.parquet as pq
    staged, stage = [], staging.StagingRun.stage
    monkeypatch.setattr(staging.StagingRun, "stage", lambda self, df, name: staged.append(name) or stage(self, df, name))
    store = Warehouse(spark, str(tmp_path))
    store.run(L.sources_at(spark, sf_small, 0), L.DAYS[0])
    assert {"headers", "lines", "purchases"} <= set(staged) and not [n for n in staged if n.startswith("fresh")]
    for part, folder in store.log.read().parts.items():
        file = next(f for f in os.listdir(f"{tmp_path}/{folder}") if f.endswith(".parquet"))
        assert pq.ParquetFile(f"{tmp_path}/{folder}/{file}").metadata.row_group(0).column(0).compression == "ZSTD", part
