"""Edge cases on small inline fixtures: lookups with the -1 member, one-per-
key picks, geography defaults, optional filters, quality checks."""
import datetime as dt
from types import SimpleNamespace

from pyspark.sql import functions as F

from dwspark.functions import rules as R
from dwspark.operators import quality as Q
from dwspark.operators.aggregates import quarter_crosstab, top_k
from dwspark.operators.filters import MartFilters
from dwspark.operators.lookup import attach_key, first_wins, resolve_lookup
from dwspark.operators.sinks import append_new
from dwspark.plans.corporate import Corporate
from dwspark.plans.incremental import watermark_by_source


def test_attach_key_defaults_to_unknown_member(spark):
    fact = spark.createDataFrame([("A", "1"), ("A", "99"), ("A", None)], "src string, emp string")
    dim = spark.createDataFrame([("A", "1", 10)], "s string, id string, k bigint")
    out = attach_key(fact, dim, [("src", "s"), ("emp", "id")], "k", "emp_key", default=-1)
    got = {r.emp: r.emp_key for r in out.collect()}
    assert got == {"1": 10, "99": -1, None: -1}


def test_first_wins_takes_smallest_order(spark):
    df = spark.createDataFrame([("BR", "SP", "Sao Paulo", 3), ("BR", "SP", "SAO PAULO", 1), ("BR", "RJ", "Rio", 2)],
                               "country string, code string, name string, o int")
    got = {(r.country, r.code): r.name for r in first_wins(df, ["country", "code"], ["name"], F.col("o")).collect()}
    assert got == {("BR", "SP"): "SAO PAULO", ("BR", "RJ"): "Rio"}


def test_resolve_lookup_adds_only_new_names(spark):
    existing = resolve_lookup(None, spark.createDataFrame([("a",), ("b",)], "name string"))
    names = spark.createDataFrame([("b",), ("c",), (None,), ("c",)], "name string")
    out = resolve_lookup(existing, names)
    assert sorted(r.name for r in out.collect()) == ["a", "b", "c"]
    keys = {r.name: r.key for r in out.collect()}
    assert keys["b"] == {r.name: r.key for r in existing.collect()}["b"]   # existing keys are kept


def _corp_with(spark, phones=None, addresses=None):
    src = SimpleNamespace(
        retail_phones=phones if phones is not None else spark.createDataFrame(
            [], "person_id bigint, phone_id bigint, area_code int, number string, type_code int, preferred boolean"),
        retail_addresses=addresses)
    return Corporate(src)


def test_preferred_phone_zero_one_two(spark):
    phones = spark.createDataFrame([
        (1, 11, 21, "a", 1, False),                      # no preferred phone
        (2, 21, 22, "b", 2, True),                       # one
        (3, 32, 23, "c", 3, True), (3, 31, 24, "d", 1, True),   # two: smallest id wins
    ], "person_id bigint, phone_id bigint, area_code int, number string, type_code int, preferred boolean")
    got = {r.person_id: (r.area_code, r.number) for r in _corp_with(spark, phones).preferred_phone.collect()}
    assert got == {2: (22, "b"), 3: (24, "d")}


def test_person_address_one_per_person(spark):
    addrs = spark.createDataFrame([(10, 1), (11, 1), (20, 2)], "address_id bigint, person_id bigint")
    got = {r.person_id: r.address_id for r in _corp_with(spark, addresses=addrs).person_address.collect()}
    assert got == {1: 11, 2: 20}                         # person 3 (no address) simply has no row


def test_free_text_geography_defaults(spark):
    df = spark.createDataFrame([(None, None, None), ("", "", ""), ("UK", "A very long region", "London")],
                               "country string, region string, city string")
    out = df.select(R.or_default(F.col("country"), R.NOT_INFORMED).alias("country"),
                    F.substring(R.or_default(F.col("region"), R.STATE_CODE_DEFAULT), 1, 10).alias("code"),
                    R.or_default(F.col("city"), R.NOT_INFORMED).alias("city")).collect()
    assert [tuple(r) for r in out] == [("Não informado", "NA", "Não informado"),
                                       ("Não informado", "NA", "Não informado"),
                                       ("UK", "A very lon", "London")]


def test_filters_unset_set_and_empty(spark):
    df = spark.createDataFrame([(dt.date(2020, 1, 1), "A"), (dt.date(2020, 6, 30), "B"), (dt.date(2021, 1, 1), "A")],
                               "d date, src string")
    assert MartFilters().period(df, "d").count() == 3
    f = MartFilters(date_from="2020-01-01", date_to="2020-06-30")     # inclusive bounds
    assert f.period(df, "d").count() == 2
    assert MartFilters(source_system="C").equals(df, "source_system", "src").count() == 0
    assert MartFilters(date_from="2020-01-01").period(df, "d", allowed=()).count() == 3   # not allowed -> ignored


def test_top_k_tie_break_and_crosstab(spark):
    df = spark.createDataFrame([("b", 5), ("a", 5), ("c", 1)], "name string, v int")
    assert [r.name for r in top_k(df, "v", "name", 2).collect()] == ["a", "b"]
    q = spark.createDataFrame([("x", 1, 10), ("x", 3, 5), ("y", 2, 7)], "cat string, quarter int, v int")
    got = {r.cat: (r.T1, r.T2, r.T3, r.T4, r.total) for r in quarter_crosstab(q, "cat", "quarter", "v", "cat").collect()}
    assert got == {"x": (10, None, 5, None, 15), "y": (None, 7, None, None, 7)}


def test_quality_checks_catch_violations(spark):
    dim = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k bigint, name string")
    fact = spark.createDataFrame([(1, None), (3, 2), (3, 5)], "k bigint, q int")
    assert Q.dq_unique(dim, "d", ["k"]).first().violations == 2
    assert Q.dq_foreign_key(fact, "f", "k", dim, "k").first().violations == 2
    multi = {r.check_name: r.violations for r in Q.dq_foreign_keys(fact, "f", [("k", dim, "k")]).collect()}
    assert multi == {"fk(k)": 2}
    assert Q.dq_not_null(fact, "f", ["q"]).first().violations == 1
    assert Q.dq_check(fact, "f", {"q>2": F.col("q") > 2}).first().violations == 1    # NULL passes
    dates = spark.createDataFrame([(dt.date(1995, 12, 31),), (dt.date(1996, 1, 1),), (None,)], "d date")
    assert Q.dq_out_of_calendar(dates, "t", "d", "1996-01-01", "2035-12-31").first().violations == 1


def test_watermark_zero_for_source_without_rows_and_bad_ids(spark):
    h = spark.createDataFrame([("A", "10"), ("A", "x"), ("A", "7")], "source_system string, id string")
    got = {r.source_system: r.watermark for r in watermark_by_source(h, ["A", "B"], "id").collect()}
    assert got == {"A": 10, "B": 0}


def test_append_new_is_replay_safe(spark):
    target = spark.createDataFrame([("A", "1", 1), ("A", "1", 2)], "s string, id string, line int")
    batch = spark.createDataFrame([("A", "1", 1), ("A", "2", 1)], "s string, id string, line int")
    once = append_new(target, batch, ["s", "id"])
    twice = append_new(once, batch, ["s", "id"])
    assert once.count() == twice.count() == 3


def test_attach_time_key_null_date_gives_null_key(spark):
    from dwspark.operators.lookup import attach_time_key
    df = spark.createDataFrame([(dt.date(1996, 7, 4),), (None,)], "d date")
    assert [r.k for r in attach_time_key(df, "d", "k").collect()] == [19960704, None]


def test_snapshot_write_and_staging_read_back(spark):
    from dwspark.operators.sinks import full_refresh, stage
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    p1, p2 = full_refresh(df, "t"), full_refresh(df, "t")
    assert p1 != p2                                   # every refresh is a new snapshot
    assert sorted(tuple(r) for r in spark.read.parquet(p1).collect()) == [(1, "a"), (2, "b")]
    assert stage(df, "delta").count() == 2


def test_cards_sort_and_put_nulls_where_they_say(spark, sf_small):
    """Order by a measure, by a hidden key, nulls first."""
    from dwspark.plans import dashboards as D
    from dwspark.plans.marts import Marts
    m = Marts(spark, sf_small)
    months = [r.month for r in D.sales_by_month(m).collect()]
    assert months == sorted(months) and len(months) == 12
    totals = [r.total_value for r in D.sales_by_category(m).collect()]
    assert totals == sorted(totals, reverse=True)
    carriers = Marts(spark, sf_small)
    carriers.__dict__["fact_deliveries"] = m.fact_deliveries.withColumn(
        "freight", F.when(F.col("carrier_key") != F.lit(-1), F.col("freight")))
    freights = [r.avg_freight for r in D.deliveries_freight_by_carrier(carriers).collect()]
    assert freights[0] is None and freights[1:] == sorted(freights[1:], reverse=True)


def test_a_fact_outside_the_calendar_counts_but_has_no_month(spark, sf_small):
    from dwspark.plans import dashboards as D
    from dwspark.plans.marts import Marts
    m = Marts(spark, sf_small)
    fact = m.fact_sales_core
    first = fact.limit(1).withColumn("sale_date", F.to_date(F.lit("1901-01-01"))).withColumn("time_key", F.lit(19010101))
    m.__dict__["fact_sales_core"] = fact.unionByName(first)
    by_month = {r.month: r.total_value for r in D.sales_by_month(m).collect()}
    assert None in by_month and sum(by_month.values()) == D.sales_total(m).first().total_value


def test_ratio_is_exact_beyond_doubles(spark):
    from decimal import Decimal

    from dwspark.operators.aggregates import ratio
    df = spark.createDataFrame([(Decimal("90071992547409930.05"), 2), (Decimal("1.00"), 0), (Decimal("-0.01"), 4)], "n decimal(28,2), d long")
    got = [r.q for r in df.select(ratio(F.col("n"), F.col("d"), 2).alias("q")).collect()]
    assert got[0] == Decimal("45035996273704965.03") and got[1] is None and got[2] == 0
