import datetime as dt
import re
from decimal import Decimal

from pyspark.sql import functions as F

from dwspark.operators import scd
from dwspark.plans import history

STATE_SCHEMA = ("id string, price decimal(15,2), name string, entity_key bigint, version_key bigint, "
                "valid_from date, valid_to date, is_current boolean")
D = dt.date


def _state(spark, rows):
    return spark.createDataFrame(rows, STATE_SCHEMA)


def _rows(df):
    return sorted((r.id, r.price, r.name, r.valid_from, r.valid_to, r.is_current) for r in df.collect())


def test_scd2_merge_cases(spark):
    state = _state(spark, [
        ("k1", Decimal("18.00"), "a", 1, 11, D(2020, 1, 1), None, True),
        ("k2", None, "b", 2, 21, D(2020, 1, 1), None, True),
        ("k3", Decimal("5.00"), "c", 3, 31, D(2020, 1, 1), None, True),
        ("k4", Decimal("1.00"), "d", 4, 41, D(2019, 1, 1), D(2019, 12, 31), False),
        ("k4", Decimal("2.00"), "d", 4, 42, D(2020, 1, 1), None, True),
    ])
    batch = spark.createDataFrame([("k1", 18.0, "a"), ("k2", None, "b"), ("k3", 6.0, "c"), ("k5", 1.5, "e")],
                                  "id string, price double, name string")
    out = scd.scd2_merge(state, batch, ["id"], ["price", "name"], "2020-02-01")
    assert _rows(out) == sorted([
        ("k1", Decimal("18.00"), "a", D(2020, 1, 1), None, True),          # 18 vs 18.00: no change
        ("k2", None, "b", D(2020, 1, 1), None, True),                      # NULL vs NULL: no change
        ("k3", Decimal("5.00"), "c", D(2020, 1, 1), D(2020, 1, 31), False),  # closed yesterday
        ("k3", Decimal("6.00"), "c", D(2020, 2, 1), None, True),           # new version
        ("k4", Decimal("1.00"), "d", D(2019, 1, 1), D(2019, 12, 31), False),  # history untouched
        ("k4", Decimal("2.00"), "d", D(2020, 1, 1), None, True),           # absent from batch
        ("k5", Decimal("1.50"), "e", D(2020, 2, 1), None, True),           # new key
    ])
    k3 = out.filter("id = 'k3'").select("entity_key").distinct().count()
    assert k3 == 1, "entity key is stable across versions"


def test_scd2_same_day_change_replaces_in_place(spark):
    state = _state(spark, [
        ("k3", Decimal("5.00"), "c", 3, 31, D(2020, 1, 1), D(2020, 1, 31), False),
        ("k3", Decimal("6.00"), "c", 3, 32, D(2020, 2, 1), None, True),
    ])
    batch = spark.createDataFrame([("k3", 7.0, "c")], "id string, price double, name string")
    out = scd.scd2_merge(state, batch, ["id"], ["price", "name"], "2020-02-01")
    assert _rows(out) == [("k3", Decimal("5.00"), "c", D(2020, 1, 1), D(2020, 1, 31), False),
                          ("k3", Decimal("7.00"), "c", D(2020, 2, 1), None, True)]


def test_scd1_update_to_null_sticks(spark):
    state = spark.createDataFrame([("k1", "x"), ("k2", "y"), ("k3", "z")], "id string, v string")
    batch = spark.createDataFrame([("k1", None), ("k2", "y"), ("k4", "w")], "id string, v string")
    out = sorted(tuple(r) for r in scd.scd1_upsert(state, batch, ["id"], ["v"]).collect())
    assert out == [("k1", None, "update"), ("k2", "y", "unchanged"), ("k3", "z", "unchanged"),
                   ("k4", "w", "insert")]


def test_change_log_equals_day_by_day_merges(spark, sf_small):
    """Merging the first days one by one (U7) == the one-pass history
    of the same days. Eight days keep the driver-side test loop short."""
    day = F.col("ts").cast("date")
    log = history.change_log(spark, sf_small)
    days = sorted(r[0] for r in log.select(day.alias("d")).distinct().collect())[:8]
    log = log.filter(day <= F.lit(days[-1])).cache()
    whole = scd.scd2_from_change_log(log, ["user_id"], ["status"], day, ["ts", "event_id"])
    state = None
    for d in days:  # test-only driver loop over the fixture's days
        today = log.filter(day == F.lit(d))
        if state is None:
            state = scd.scd2_from_change_log(today, ["user_id"], ["status"], day, ["ts", "event_id"])
        else:
            batch = scd.last_per_key_day(today, ["user_id"], ["status"], day, ["ts", "event_id"]).drop("valid_from")
            state = scd.scd2_merge(state, batch, ["user_id"], ["status"], F.lit(d))
        state = state.checkpoint()   # cut lineage between days
    key = ["user_id", "status", "valid_from", "valid_to", "is_current", "version_key", "entity_key"]
    assert sorted(tuple(r) for r in state.select(key).collect()) == \
        sorted(tuple(r) for r in whole.select(key).collect())


def test_apply_log_with_late_data_equals_whole_log(spark, sf_small):
    """Late, back-dated events (whole days and same-day stragglers) fold in exactly."""
    log = history.change_log(spark, sf_small)
    day = F.col("ts").cast("date")
    late_rows = F.dayofmonth(day).isin(3, 11, 12, 25) | (F.col("event_id") % 3 == 0)
    early, late = log.filter(~late_rows), log.filter(late_rows)   # whole late days + same-day stragglers
    state = scd.scd2_from_change_log(early, ["user_id"], ["status"], day, ["ts", "event_id"])
    daily = scd.daily_points(early, ["user_id"], ["status"], day, ["ts", "event_id"])
    got, _ = scd.scd2_apply_log(state, daily, late, ["user_id"], ["status"], day, ["ts", "event_id"])
    whole = scd.scd2_from_change_log(log, ["user_id"], ["status"], day, ["ts", "event_id"])
    cols = ["user_id", "status", "valid_from", "valid_to", "is_current", "version_key"]
    assert sorted(tuple(r) for r in got.select(cols).collect()) == \
        sorted(tuple(r) for r in whole.select(cols).collect())


def test_asof_join_matches_brute_force(spark, sf_small):
    ev = history.purchase_events(spark, sf_small)
    ver = history.versions(spark, sf_small)
    got = scd.asof_version_join(ev, ver, ["user_id"], "event_date")
    brute = ev.join(ver, (ev.user_id == ver.user_id) & (ver.valid_from <= ev.event_date)
                    & (ver.valid_to.isNull() | (ev.event_date <= ver.valid_to))).select(ev.event_id, ver.version_key)
    assert sorted(tuple(r) for r in got.select("event_id", "version_key").collect()) == \
        sorted(tuple(r) for r in brute.collect())
    assert got.count() == ev.count()   # every purchase meets exactly one version


def test_asof_join_is_one_sort_of_events_and_versions(spark, sf_small):
    ev, ver = history.purchase_events(spark, sf_small), history.versions(spark, sf_small)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    count = lambda text, op: len(re.findall(rf"[+:]- {op}", text))
    got, alone = plan(scd.asof_version_join(ev, ver, ["user_id"], "event_date")), plan(ver)
    assert "Join" not in got
    for op in ("FileScan", "Scan parquet", "Window", "Exchange hashpartitioning"):
        assert count(got, op) <= count(alone, op) + 1


def test_asof_join_at_gaps_ends_and_nulls(spark):
    versions = [("a", "old", D(1970, 1, 5), D(1999, 12, 31)), ("a", "gap before", D(2000, 3, 1), D(2000, 3, 31)),
                ("a", "open", D(2000, 4, 1), None), ("b", "late", D(2050, 6, 1), None), (None, "null key", D(2000, 1, 1), None),
                ("c", "no start", None, None), ("c", "turned", D(2001, 1, 2), D(2001, 1, 1))]
    events = [(1, "a", D(1970, 1, 4)), (2, "a", D(1970, 1, 5)), (3, "a", D(1999, 12, 31)), (4, "a", D(2000, 2, 15)), (5, "a", D(2000, 3, 31)),
              (6, "a", D(2000, 4, 1)), (7, "a", D(2060, 1, 1)), (8, "b", D(2040, 1, 1)), (9, "b", D(2050, 6, 1)), (10, None, D(2005, 1, 1)),
              (11, "a", None), (12, "c", D(2001, 1, 1)), (13, "z", D(2001, 1, 1)), (6, "a", D(2000, 4, 1))]
    v = spark.createDataFrame(versions, "k string, name string, valid_from date, valid_to date")
    e = spark.createDataFrame(events, "id int, k string, day date")
    expected = [(2, "old"), (3, "old"), (5, "gap before"), (6, "open"), (6, "open"), (7, "open"), (9, "late")]
    for bucket in ("week", "month", "year"):
        got = scd.asof_version_join(e, v, ["k"], "day", bucket)
        assert got.columns == ["id", "k", "day", "name", "valid_from", "valid_to"]
        assert sorted((r.id, r.name) for r in got.collect()) == expected
    assert scd.asof_version_join(e, v.limit(0), ["k"], "day").collect() == []
    assert scd.asof_version_join(e.limit(0), v, ["k"], "day").collect() == []


def test_scd2_invariants_on_history(spark, sf_small):
    from dwspark.operators.quality import dq_scd2
    rep = dq_scd2(history.versions(spark, sf_small), "h", ["user_id"])
    assert all(r.violations == 0 for r in rep.collect())
