from dwspark.plans import catalog as C
from dwspark.plans.marts import Marts
from dwspark.plans.registry import MART_TABLES


def _schemas(spark, sf):
    m = Marts(spark, sf)
    return {t: getattr(m, t).columns for t in MART_TABLES}


def test_specs_match_produced_schemas(spark, sf_small):
    assert C.catalog_drift(spark, _schemas(spark, sf_small)).count() == 0


def test_every_produced_field_has_lineage(spark, sf_small):
    assert C.lineage_coverage(spark, _schemas(spark, sf_small)).count() == 0


def test_lineage_report_impact_and_rules(spark):
    rep = C.lineage_report(spark)
    assert rep.filter("description IS NULL").count() == 0          # every rule is described
    imp = {(r.source_table, r.source_field): r.dw_fields for r in C.lineage_impact(spark).collect()}
    assert "fact_sales.item_total" in imp[("lineitem", "l_discount")]
    conf = {(r.dw_table, r.dw_field) for r in C.conformed_fields(spark).collect()}
    assert ("fact_sales", "item_total") in conf and ("fact_deliveries", "freight") not in conf
    usage = {r.rule: r.fields for r in C.rule_usage(spark).collect()}
    assert usage["key of the business key"] >= 10 and set(usage) == set(C.rule_descriptions())
