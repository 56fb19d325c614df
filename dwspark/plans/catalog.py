"""Field-level lineage catalog (L1-L6), built from column specs kept next to
the code, and checked against the
schemas the mart jobs actually produce (L6), so it cannot drift.

The catalog is small metadata, so these are library functions with tests
(no registered query: they do not read the warehouse's data).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import calendar, keys, rules
from ..operators import lookup
from ..sources import binding
from .marts import Marts

# The rules that the specs name are the functions that carry them out; a rule's description is the first
# sentence of its function's docstring, so it can't say anything but what the code does.
_RULE_CODE = {
    "time key": calendar.time_key, "key of the business key": keys.surrogate_key, "minus one without an id": keys.key_or_unknown,
    "source": binding.source_of, "income band": rules.income_band, "age band": rules.age_band_from_year,
    "label of a code": rules.decode, "money": rules.money, "days between": rules.days_between,
    "joined name": rules.full_name, "phone": rules.phone_text, "default": rules.or_default,
    "one per group": lookup.first_wins, "value of an order": Marts.order_values.func, "currency": rules.currency_of,
    "as it is": rules.as_it_is,
}


def rule_descriptions() -> dict[str, str]:
    return {name: " ".join((f.__doc__ or name).split(". ")[0].split()) for name, f in _RULE_CODE.items()}


W, R, B = ("WHOLESALE",), ("RETAIL",), ("WHOLESALE", "RETAIL")

# table -> column -> (role, rule, systems, source fields "table.column")
SPECS: dict[str, dict[str, tuple]] = {
    "fact_sales": {
        "source_system": ("Attribute", "source", B, ["orders.o_custkey"]),
        "sale_id": ("Attribute", "as it is", B, ["orders.o_orderkey"]),
        "item_id": ("Attribute", "as it is", R, ["lineitem.l_orderkey", "lineitem.l_linenumber"]),
        "time_key": ("FK", "time key", B, ["orders.o_orderdate"]),
        "sale_date": ("Attribute", "as it is", B, ["orders.o_orderdate"]),
        "customer_key": ("FK", "key of the business key", B, ["orders.o_custkey"]),
        "product_key": ("FK", "key of the business key", B, ["lineitem.l_partkey"]),
        "address_key": ("FK", "key of the business key", B, ["orders.o_custkey"]),
        "employee_key": ("FK", "minus one without an id", W, ["orders.o_orderkey"]),
        "carrier_key": ("FK", "minus one without an id", W, ["orders.o_orderpriority", "orders.o_orderstatus"]),
        "sale_type": ("Attribute", "label of a code", R, ["orders.o_orderkey"]),
        "quantity": ("Attribute", "as it is", B, ["lineitem.l_quantity"]),
        "unit_price": ("Attribute", "as it is", B, ["lineitem.l_extendedprice"]),
        "discount_amount": ("Attribute", "money", W, ["lineitem.l_discount", "lineitem.l_quantity",
                                                           "lineitem.l_extendedprice"]),
        "item_total": ("Attribute", "money", B, ["lineitem.l_quantity", "lineitem.l_extendedprice",
                                                      "lineitem.l_discount"]),
    },
    "fact_purchases": {
        "source_system": ("Attribute", "source", R, ["orders.o_custkey"]),
        "purchase_id": ("Attribute", "as it is", R, ["lineitem.l_orderkey", "lineitem.l_suppkey"]),
        "item_id": ("Attribute", "as it is", R, ["lineitem.l_linenumber"]),
        "time_key": ("FK", "time key", R, ["orders.o_orderdate"]),
        "purchase_date": ("Attribute", "as it is", R, ["orders.o_orderdate"]),
        "supplier_key": ("FK", "key of the business key", R, ["lineitem.l_suppkey"]),
        "product_key": ("FK", "key of the business key", R, ["lineitem.l_partkey"]),
        "address_key": ("FK", "key of the business key", R, ["lineitem.l_suppkey"]),
        "quantity": ("Attribute", "as it is", R, ["lineitem.l_quantity"]),
        "unit_price": ("Attribute", "as it is", R, ["lineitem.l_extendedprice"]),
        "item_total": ("Attribute", "money", R, ["lineitem.l_quantity", "lineitem.l_extendedprice"]),
        "lead_time_days": ("Attribute", "days between", R, ["lineitem.l_shipdate", "orders.o_orderdate"]),
    },
    "fact_deliveries": {
        "source_system": ("Attribute", "source", W, ["orders.o_custkey"]),
        "sale_id": ("Attribute", "as it is", W, ["orders.o_orderkey"]),
        "order_time_key": ("FK", "time key", W, ["orders.o_orderdate"]),
        "ship_time_key": ("FK", "time key", W, ["lineitem.l_shipdate"]),
        "order_date": ("Attribute", "as it is", W, ["orders.o_orderdate"]),
        "shipped_date": ("Attribute", "as it is", W, ["lineitem.l_shipdate", "orders.o_orderstatus"]),
        "customer_key": ("FK", "key of the business key", W, ["orders.o_custkey"]),
        "employee_key": ("FK", "minus one without an id", W, ["orders.o_orderkey"]),
        "carrier_key": ("FK", "minus one without an id", W, ["orders.o_orderpriority"]),
        "address_key": ("FK", "key of the business key", W, ["orders.o_custkey"]),
        "order_value": ("Attribute", "value of an order", W, ["lineitem.l_quantity", "lineitem.l_extendedprice",
                                                        "lineitem.l_discount"]),
        "freight": ("Attribute", "as it is", W, ["orders.o_totalprice"]),
        "promised_days": ("Attribute", "days between", W, ["orders.o_orderdate"]),
        "days_to_ship": ("Attribute", "days between", W, ["orders.o_orderdate", "lineitem.l_shipdate"]),
        "delay_days": ("Attribute", "days between", W, ["orders.o_orderdate", "lineitem.l_shipdate"]),
    },
    "dim_customer": {
        "customer_key": ("PK", "key of the business key", B, ["customer.c_custkey"]),
        "source_system": ("Attribute", "source", B, ["customer.c_custkey"]),
        "customer_id": ("Attribute", "as it is", B, ["customer.c_custkey"]),
        "person_type": ("Attribute", "source", B, ["customer.c_custkey"]),
        "customer_name": ("Attribute", "as it is", B, ["customer.c_name"]),
        "sex": ("Attribute", "label of a code", R, ["customer.c_custkey"]),
        "income_band": ("Attribute", "income band", R, ["customer.c_acctbal"]),
        "marital_status": ("Attribute", "as it is", R, ["customer.c_mktsegment"]),
        "age_band": ("Attribute", "age band", R, ["customer.c_custkey"]),
        "birth_year": ("Attribute", "as it is", R, ["customer.c_custkey"]),
        "profession": ("Attribute", "as it is", R, ["customer.c_mktsegment"]),
        "area_code": ("Attribute", "as it is", R, ["customer.c_custkey"]),
        "phone_type": ("Attribute", "label of a code", R, ["customer.c_custkey"]),
    },
    "dim_product": {
        "product_key": ("PK", "key of the business key", B, ["part.p_partkey"]),
        "source_system": ("Attribute", "source", B, ["part.p_partkey"]),
        "product_id": ("Attribute", "as it is", B, ["part.p_partkey"]),
        "product_name": ("Attribute", "as it is", B, ["part.p_name"]),
        "category": ("Attribute", "as it is", B, ["part.p_type"]),
        "price": ("Attribute", "as it is", B, ["part.p_retailprice"]),
        "currency": ("Attribute", "currency", B, ["part.p_partkey"]),
    },
    "dim_address": {
        "address_key": ("PK", "key of the business key", B, ["customer.c_custkey"]),
        "source_system": ("Attribute", "source", B, ["customer.c_custkey"]),
        "address_id": ("Attribute", "as it is", B, ["customer.c_custkey", "supplier.s_suppkey"]),
        "address_type": ("Attribute", "label of a code", B, ["customer.c_custkey"]),
        "street": ("Attribute", "as it is", B, ["customer.c_custkey", "supplier.s_suppkey"]),
        "postal_code": ("Attribute", "as it is", B, ["customer.c_custkey", "supplier.s_suppkey"]),
        "district": ("Attribute", "as it is", R, ["customer.c_custkey", "supplier.s_suppkey"]),
        "city_region": ("Attribute", "one per group", B, ["nation.n_name", "region.r_name"]),
        "city": ("Attribute", "default", B, ["customer.c_custkey", "supplier.s_suppkey"]),
        "state": ("Attribute", "one per group", B, ["nation.n_name"]),
        "state_code": ("Attribute", "default", B, ["nation.n_name"]),
        "country": ("Attribute", "default", B, ["region.r_name"]),
    },
    "dim_employee": {
        "employee_key": ("PK", "key of the business key", W, ["supplier.s_suppkey"]),
        "source_system": ("Attribute", "source", W, ["supplier.s_suppkey"]),
        "employee_id": ("Attribute", "as it is", W, ["supplier.s_suppkey"]),
        "employee_name": ("Attribute", "joined name", W, ["supplier.s_name", "supplier.s_suppkey"]),
        "title": ("Attribute", "as it is", W, ["supplier.s_suppkey"]),
        "hire_date": ("Attribute", "as it is", W, ["supplier.s_suppkey"]),
        "city": ("Attribute", "default", W, ["supplier.s_suppkey"]),
        "country": ("Attribute", "default", W, ["region.r_name"]),
    },
    "dim_carrier": {
        "carrier_key": ("PK", "key of the business key", W, ["orders.o_orderpriority"]),
        "source_system": ("Attribute", "source", W, ["orders.o_custkey"]),
        "carrier_id": ("Attribute", "as it is", W, ["orders.o_orderpriority"]),
        "carrier_name": ("Attribute", "as it is", W, ["orders.o_orderpriority"]),
        "phone": ("Attribute", "as it is", W, ["orders.o_orderpriority"]),
    },
    "dim_supplier": {
        "supplier_key": ("PK", "key of the business key", R, ["supplier.s_suppkey"]),
        "source_system": ("Attribute", "source", R, ["supplier.s_suppkey"]),
        "supplier_id": ("Attribute", "as it is", R, ["supplier.s_suppkey"]),
        "supplier_name": ("Attribute", "as it is", R, ["supplier.s_name"]),
        "phone": ("Attribute", "phone", R, ["supplier.s_suppkey"]),
    },
}


def dw_fields_from_schemas(spark: SparkSession, schemas: dict[str, list[str]]) -> DataFrame:
    """The DW field list as the jobs really produce it (table, field)."""
    rows = [(t, c) for t, cols in schemas.items() for c in cols]
    return spark.createDataFrame(rows, "dw_table string, dw_field string")


def lineage_table(spark: SparkSession) -> DataFrame:
    """One row per (DW field, source field, source system) from the specs."""
    rows = [(t, c, role, rule, sys_, src.split(".")[0], src.split(".")[1])
            for t, cols in SPECS.items() for c, (role, rule, systems, srcs) in cols.items()
            for sys_ in systems for src in srcs]
    return spark.createDataFrame(rows, "dw_table string, dw_field string, role string, rule string, "
                                       "source_system string, source_table string, source_field string")


def rules_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(rule_descriptions().items()), "rule string, description string")


def lineage_report(spark: SparkSession) -> DataFrame:
    """L1: DW field <- source field, with the rule that maps it."""
    return lineage_table(spark).join(rules_table(spark), "rule", "left")


def lineage_coverage(spark: SparkSession, schemas: dict[str, list[str]]) -> DataFrame:
    """L2: produced DW fields (not PKs) with no lineage row."""
    lin = lineage_table(spark)
    pks = lin.filter(F.col("role") == "PK").select("dw_table", "dw_field")
    return (dw_fields_from_schemas(spark, schemas)
            .join(lin.select("dw_table", "dw_field").distinct(), ["dw_table", "dw_field"], "left_anti")
            .join(pks, ["dw_table", "dw_field"], "left_anti"))


def lineage_impact(spark: SparkSession) -> DataFrame:
    """L3: for each source field, the DW fields it feeds."""
    lin = lineage_table(spark)
    return (lin.groupBy("source_table", "source_field")
               .agg(F.sort_array(F.collect_set(F.concat_ws(".", "dw_table", "dw_field"))).alias("dw_fields")))


def conformed_fields(spark: SparkSession) -> DataFrame:
    """L4: DW fields fed by more than one source system."""
    lin = lineage_table(spark)
    return (lin.groupBy("dw_table", "dw_field").agg(F.countDistinct("source_system").alias("systems"))
               .filter(F.col("systems") > 1))


def rule_usage(spark: SparkSession) -> DataFrame:
    """How many DW fields each rule produces."""
    lin = lineage_table(spark).select("dw_table", "dw_field", "rule").distinct()
    return rules_table(spark).join(lin.groupBy("rule").agg(F.count(F.lit(1)).alias("fields")), "rule", "left") \
                             .fillna(0, ["fields"])


def catalog_drift(spark: SparkSession, schemas: dict[str, list[str]]) -> DataFrame:
    """Spec fields the jobs no longer produce, and produced fields with
    no spec, for all tables that the jobs produce."""
    spec = spark.createDataFrame([(t, c) for t, cols in SPECS.items() for c in cols],
                                 "dw_table string, dw_field string")
    actual = dw_fields_from_schemas(spark, schemas)
    missing = spec.join(actual, ["dw_table", "dw_field"], "left_anti").withColumn("issue", F.lit("spec_only"))
    extra = actual.join(spec, ["dw_table", "dw_field"], "left_anti").withColumn("issue", F.lit("schema_only"))
    return missing.unionByName(extra)
