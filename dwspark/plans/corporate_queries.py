"""Registered queries over the corporate layer's operators: geography
resolution, lookups, one-per-key picks, conformed entities, header/item
joins, banding rules and the reconciliation counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import surrogate_key_sql as K
from ..operators.lookup import resolve_lookup
from ..oracle.binding import with_binding
from ..sources.readers import sf_table
from .marts import Marts, staged_marts


def _m(spark: SparkSession, sf_dir: str) -> Marts:
    return Marts(spark, sf_dir)


def geo_countries(spark, sf_dir) -> DataFrame:
    return _m(spark, sf_dir).corp.countries


def geo_states(spark, sf_dir) -> DataFrame:
    return _m(spark, sf_dir).corp.states


def geo_cities(spark, sf_dir) -> DataFrame:
    return _m(spark, sf_dir).corp.cities


def conformed_addresses(spark, sf_dir) -> DataFrame:
    return _m(spark, sf_dir).corp.address_inputs.drop("geo_order")


def conformed_customers(spark, sf_dir) -> DataFrame:
    return _m(spark, sf_dir).corp.customers


def conformed_products(spark, sf_dir) -> DataFrame:
    return _m(spark, sf_dir).corp.products


def conformed_employees(spark, sf_dir) -> DataFrame:
    return _m(spark, sf_dir).corp.employees


def preferred_phone(spark, sf_dir) -> DataFrame:
    return _m(spark, sf_dir).corp.preferred_phone


def person_address(spark, sf_dir) -> DataFrame:
    return _m(spark, sf_dir).corp.person_address


def suppliers_by_role(spark, sf_dir) -> DataFrame:
    return _m(spark, sf_dir).corp.suppliers


def sale_headers(spark, sf_dir) -> DataFrame:
    h = _m(spark, sf_dir).corp.sale_headers
    return h.select("source_system", "sale_id", "customer_id", "order_date", "sale_type_code", "employee_id",
                    "carrier_id", "due_date", "shipped_date", "freight")


def purchase_headers(spark, sf_dir) -> DataFrame:
    return _m(spark, sf_dir).corp.purchase_headers


def category_lookup(spark, sf_dir) -> DataFrame:
    """U1 get-or-create: categories already known (those of the first half
    of the part keys) plus the ones met in the whole part list."""
    part = sf_table(spark, sf_dir, "part", ["p_partkey", "p_type"])
    half = part.select((F.max("p_partkey") / 2).cast("bigint")).scalar()
    existing = resolve_lookup(None, part.filter(F.col("p_partkey") <= half).select(F.col("p_type").alias("name")))
    return resolve_lookup(existing, part.select(F.col("p_type").alias("name")))


def income_band_counts(spark, sf_dir) -> DataFrame:
    d = _m(spark, sf_dir).dim_customer
    return d.filter(F.col("income_band").isNotNull()).groupBy("income_band").agg(F.count(F.lit(1)).alias("customers"))


def age_band_counts(spark, sf_dir) -> DataFrame:
    d = _m(spark, sf_dir).dim_customer
    return d.filter(F.col("age_band").isNotNull()).groupBy("age_band").agg(F.count(F.lit(1)).alias("customers"))


def reconciliation_counts(spark, sf_dir) -> DataFrame:
    """A4: the before/after check -- row counts of the loaded layers in one
    row. Each count is its own aggregate; the one-row results are put side
    by side through scalar subqueries (no join)."""
    m = staged_marts(spark, sf_dir)
    c = m.corp
    parts = {
        "corporate_sales": c.sale_headers, "corporate_sale_items": c.sales_lines,
        "corporate_purchases": c.purchase_headers, "corporate_purchase_items": c.purchase_lines,
        "fact_sales": m.fact_sales, "fact_purchases": m.fact_purchases,
        "fact_deliveries": m.fact_deliveries, "dim_customer": m.dim_customer,
    }
    one = spark.range(1)
    return one.select(*[df.select(F.count(F.lit(1))).scalar().alias(name) for name, df in parts.items()])


def queries() -> dict:
    fns = [geo_countries, geo_states, geo_cities, conformed_addresses, conformed_customers, conformed_products,
           conformed_employees, preferred_phone, person_address, suppliers_by_role, sale_headers,
           purchase_headers, category_lookup, income_band_counts, age_band_counts, reconciliation_counts]
    return {f.__name__: f for f in fns}


def oracle_sql() -> dict:
    b = with_binding
    return {
        "geo_countries": b(f"SELECT DISTINCT {K('country')} AS country_key, country AS name FROM address_inputs"),
        "geo_states": b(f"""SELECT {K('country', 'state_code')} AS state_key, {K('country')} AS country_key,
                                   country, state_code, state_name FROM geo_states"""),
        "geo_cities": b(f"""SELECT {K('country', 'state_code', 'city')} AS city_key, {K('country', 'state_code')} AS state_key,
                                   city AS city_name, city_region FROM geo_cities"""),
        "conformed_addresses": b("""SELECT source_system, address_id, address_type, street, postal_code, district,
                                           country, state_name, state_code, city, city_region FROM address_inputs"""),
        "conformed_customers": b("SELECT * FROM customers"),
        "conformed_products": b("""SELECT source_system, product_id, product_name AS name, category, price,
                                          currency FROM dim_product"""),
        "conformed_employees": b("""SELECT 'WHOLESALE' AS source_system, employee_id,
                                           concat_ws(' ', first_name, last_name) AS name, hire_date, title,
                                           'EMP-' || employee_id AS address_id FROM ws_employees"""),
        "preferred_phone": b("""SELECT ph.person_id, ph.area_code, ph.type_code, r.number FROM rt_phones r
                                JOIN pref_phone ph ON ph.person_id = r.person_id AND r.preferred
                                QUALIFY row_number() OVER (PARTITION BY r.person_id ORDER BY r.phone_id) = 1"""),
        "person_address": b("SELECT person_id, max(address_id) AS address_id FROM rt_addresses GROUP BY person_id"),
        "suppliers_by_role": b("""SELECT 'RETAIL' AS source_system, CAST(supplier_id AS VARCHAR) AS supplier_id, name,
                                         '(' || CAST(area_code AS VARCHAR) || ') ' || number AS phone,
                                         'SUP-' || CAST(supplier_id AS VARCHAR) AS address_id FROM rt_suppliers_used"""),
        "sale_headers": b("""SELECT h.source_system, h.sale_id, h.customer_id, h.order_date, h.sale_type_code,
                                    h.employee_id, h.carrier_id, h.due_date,
                                    CASE WHEN h.source_system = 'WHOLESALE' AND h.o_orderstatus <> 'O' THEN m.last END AS shipped_date,
                                    h.freight
                             FROM headers h JOIN (SELECT l_orderkey, max(ship_date) AS last FROM lines_b GROUP BY l_orderkey) m
                                  ON m.l_orderkey = h.o_orderkey"""),
        "purchase_headers": b("""SELECT l_orderkey, l_suppkey, entry_date,
                                        CAST(entry_date - order_date AS INTEGER) AS lead_time_days FROM purchase_headers"""),
        "category_lookup": b(f"SELECT DISTINCT {K('p_type')} AS key, p_type AS name FROM part WHERE p_type IS NOT NULL"),
        "income_band_counts": b("""SELECT income_band, count(*) AS customers FROM dim_customer
                                   WHERE income_band IS NOT NULL GROUP BY income_band"""),
        "age_band_counts": b("""SELECT age_band, count(*) AS customers FROM dim_customer
                                WHERE age_band IS NOT NULL GROUP BY age_band"""),
        "reconciliation_counts": b("""SELECT
              (SELECT count(*) FROM headers h WHERE EXISTS (SELECT 1 FROM lines_b l WHERE l.l_orderkey = h.o_orderkey)) AS corporate_sales,
              (SELECT count(*) FROM sales_lines) AS corporate_sale_items,
              (SELECT count(*) FROM purchase_headers) AS corporate_purchases,
              (SELECT count(*) FROM purchase_lines) AS corporate_purchase_items,
              (SELECT count(*) FROM fact_sales) AS fact_sales,
              (SELECT count(*) FROM fact_purchases) AS fact_purchases,
              (SELECT count(*) FROM fact_deliveries) AS fact_deliveries,
              (SELECT count(*) FROM dim_customer) AS dim_customer"""),
    }
