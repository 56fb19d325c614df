"""The 32 dashboard questions of the three marts (sales, purchases,
deliveries), each a function ``(marts, filters) -> DataFrame``.

Plan shape used throughout, for scale:
* period bounds filter the fact's own date column (pushed to the scan);
* the calendar (fixed size) is broadcast, other dimensions as Spark's size check decides;
* facts are pre-aggregated to the dimension key *before* joining a
  possibly large dimension, then re-aggregated by the dimension's name --
  the join sees one row per key instead of one per item, and a hot key
  is combined map-side instead of skewing a join partition;
* name filters (carrier, supplier) become a semi join against the
  filtered dimension.
Money is decimal end to end, ratios too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rules as R
from ..operators.aggregates import quarter_crosstab, ratio, top_k
from ..operators.filters import NO_FILTERS, PERIOD, MartFilters
from .marts import Marts

MONEY_SUM = "decimal(38,2)"
P = PERIOD
P_SOURCE = PERIOD + ("source_system",)
P_CARRIER = PERIOD + ("carrier",)
P_SUPPLIER = PERIOD + ("supplier",)


def _with_calendar(fact: DataFrame, m: Marts, key: str, cols: tuple[str, ...]) -> DataFrame:
    """The fact with calendar columns. A row dated outside the calendar stays, with nulls: it counts in
    every total, and the calendar check reports it. Cards that need no calendar column skip the join. The
    calendar has one row per day of a fixed span, so it may be broadcast."""
    if not cols:
        return fact
    return fact.join(F.broadcast(m.dim_time.select(F.col("time_key").alias(key), *cols)), key, "left")


def _money_sum(col: str, alias: str):
    return F.sum(col).cast(MONEY_SUM).alias(alias)


# -- sales ------------------------------------------------------------------
def _sales(m: Marts, f: MartFilters, allowed, *cal_cols: str) -> DataFrame:
    # the lean fact when the marts object has one (computed marts); stored marts serve the table
    fs = getattr(m, "fact_sales_core", None)
    fs = f.period(m.fact_sales if fs is None else fs, "sale_date", allowed)
    if "source_system" in allowed:
        fs = f.equals(fs, "source_system", "source_system")
    return _with_calendar(fs, m, "time_key", cal_cols)


def sales_total(m: Marts, f: MartFilters = NO_FILTERS) -> DataFrame:
    return _sales(m, f, P_SOURCE).agg(_money_sum("item_total", "total_value"))


def sales_items_sold(m: Marts, f: MartFilters = NO_FILTERS) -> DataFrame:
    return _sales(m, f, P_SOURCE).agg(F.sum("quantity").cast("bigint").alias("items"))


def _sale_ref():
    return F.concat(F.col("source_system"), F.lit("-"), F.col("sale_id"))


def sales_count(m: Marts, f: MartFilters = NO_FILTERS) -> DataFrame:
    return _sales(m, f, P_SOURCE).agg(F.countDistinct(_sale_ref()).alias("sales"))


def sales_avg_ticket(m: Marts, f: MartFilters = NO_FILTERS) -> DataFrame:
    return _sales(m, f, P_SOURCE).agg(
        ratio(F.sum("item_total"), F.countDistinct(_sale_ref()), 2).alias("avg_ticket"))


def sales_by_source(m: Marts, f: MartFilters = NO_FILTERS) -> DataFrame:
    return _sales(m, f, P).groupBy("source_system").agg(_money_sum("item_total", "total_value"))


def sales_top10_products(m: Marts, f: MartFilters = NO_FILTERS) -> DataFrame:
    per_key = _sales(m, f, P_SOURCE).groupBy("product_key").agg(F.sum("item_total").alias("v"))
    by_name = (per_key.join(m.dim_product.select("product_key", "product_name"), "product_key")
               .groupBy("product_name").agg(F.sum("v").cast(MONEY_SUM).alias("total_value")))
    return top_k(by_name, "total_value", "product_name", 10)


def sales_by_month(m: Marts, f: MartFilters = NO_FILTERS) -> DataFrame:
    g = _sales(m, f, P_SOURCE, "month").groupBy("month").agg(_money_sum("item_total", "total_value"))
    return g.select("month", R.month_label(F.col("month")).alias("month_name"), "total_value").orderBy("month")


def sales_top10_customers(m: Marts, f: MartFilters = NO_FILTERS) -> DataFrame:
    per_key = _sales(m, f, P_SOURCE).groupBy("customer_key").agg(F.sum("item_total").alias("v"))
    by_name = (per_key.join(m.dim_customer.select("customer_key", "customer_name"), "customer_key")
               .groupBy("customer_name").agg(F.sum("v").cast(MONEY_SUM).alias("total_value")))
    return top_k(by_name, "total_value", "customer_name", 10)


def sales_by_category(m: Marts, f: MartFilters = NO_FILTERS) -> DataFrame:
    per_key = _sales(m, f, P_SOURCE).groupBy("product_key").agg(F.sum("item_total").alias("v"))
    dim = m.dim_product.filter(F.col("category").isNotNull()).select("product_key", "category")
    return (per_key.join(dim, "product_key").groupBy("category")
            .agg(F.sum("v").cast(MONEY_SUM).alias("total_value")).orderBy(F.col("total_value").desc()))


def sales_ticket_by_income_band(m: Marts, f: MartFilters = NO_FILTERS) -> DataFrame:
    # A sale has exactly one customer, so distinct sales per band is the sum
    # of distinct sales per customer: pre-aggregate per customer key.
    per_key = (_sales(m, f, P).groupBy("customer_key")
               .agg(F.sum("item_total").alias("v"), F.countDistinct(_sale_ref()).alias("n")))
    dim = m.dim_customer.filter(F.col("income_band").isNotNull()).select("customer_key", "income_band")
    return (per_key.join(dim, "customer_key").groupBy("income_band")
            .agg(ratio(F.sum("v"), F.sum("n"), 2).alias("avg_ticket"))
            .orderBy(F.col("avg_ticket").desc()))


def sales_category_by_quarter(m: Marts, f: MartFilters = NO_FILTERS) -> DataFrame:
    per_key = (_sales(m, f, P_SOURCE, "quarter").groupBy("product_key", "quarter")
               .agg(F.sum("item_total").alias("v")))
    dim = m.dim_product.filter(F.col("category").isNotNull()).select("product_key", "category")
    x = quarter_crosstab(per_key.join(dim, "product_key"), "category", "quarter", "v", "category")
    return x.select("category", *[F.col(c).cast(MONEY_SUM).alias(c) for c in ("T1", "T2", "T3", "T4", "total")]) \
            .orderBy(F.col("total").desc())


def sales_by_currency(m: Marts, f: MartFilters = NO_FILTERS) -> DataFrame:
    """C11: the cards add BRL and USD on purpose; this is the same total
    split by the product's currency."""
    per_key = _sales(m, f, P_SOURCE).groupBy("product_key").agg(F.sum("item_total").alias("v"))
    return (per_key.join(m.dim_product.select("product_key", "currency"), "product_key")
            .groupBy("currency").agg(F.sum("v").cast(MONEY_SUM).alias("total_value")))


def sales_cube_category_quarter(m: Marts, f: MartFilters = NO_FILTERS) -> DataFrame:
    """A3: the crosstab's question as a real cube -- every (category,
    quarter) cell plus category totals, quarter totals and the grand total."""
    per_key = (_sales(m, f, P_SOURCE, "quarter").groupBy("product_key", "quarter")
               .agg(F.sum("item_total").alias("v")))
    dim = m.dim_product.filter(F.col("category").isNotNull()).select("product_key", "category")
    return (per_key.join(dim, "product_key").cube("category", "quarter")
            .agg(F.sum("v").cast(MONEY_SUM).alias("total_value"), F.grouping_id().alias("grouping_level")))


# -- purchases ----------------------------------------------------------------
def _purchases(m: Marts, f: MartFilters, allowed, *cal_cols: str) -> DataFrame:
    fp = f.period(m.fact_purchases, "purchase_date", allowed)
    if "supplier" in allowed and f.supplier is not None:
        chosen = m.dim_supplier.filter(F.col("supplier_name") == f.supplier).select("supplier_key")
        fp = fp.join(chosen, "supplier_key", "left_semi")
    return _with_calendar(fp, m, "time_key", cal_cols)


def purchases_total(m: Marts, f: MartFilters = NO_FILTERS) -> DataFrame:
    return _purchases(m, f, P_SUPPLIER).agg(_money_sum("item_total", "total_value"))


def purchases_items(m: Marts, f: MartFilters = NO_FILTERS) -> DataFrame:
    return _purchases(m, f, P_SUPPLIER).agg(F.sum("quantity").cast("bigint").alias("items"))


def purchases_avg_lead_time(m: Marts, f: MartFilters = NO_FILTERS) -> DataFrame:
    fp = _purchases(m, f, P_SUPPLIER).filter(F.col("lead_time_days").isNotNull())
    return fp.agg(ratio(F.sum("lead_time_days"), F.count("lead_time_days"), 1).alias("avg_lead_time"))


def purchases_count(m: Marts, f: MartFilters = NO_FILTERS) -> DataFrame:
    return _purchases(m, f, P_SUPPLIER).agg(F.countDistinct("purchase_id").alias("purchases"))


def _by_supplier(m: Marts, per_key: DataFrame) -> DataFrame:
    return per_key.join(m.dim_supplier.select("supplier_key", "supplier_name"), "supplier_key")


def purchases_top10_suppliers(m: Marts, f: MartFilters = NO_FILTERS) -> DataFrame:
    per_key = _purchases(m, f, P).groupBy("supplier_key").agg(F.sum("item_total").alias("v"))
    by_name = _by_supplier(m, per_key).groupBy("supplier_name").agg(F.sum("v").cast(MONEY_SUM).alias("total_value"))
    return top_k(by_name, "total_value", "supplier_name", 10)


def purchases_lead_time_by_supplier(m: Marts, f: MartFilters = NO_FILTERS) -> DataFrame:
    fp = _purchases(m, f, P).filter(F.col("lead_time_days").isNotNull())
    per_key = fp.groupBy("supplier_key").agg(F.sum("lead_time_days").alias("s"), F.count("lead_time_days").alias("n"))
    return (_by_supplier(m, per_key).groupBy("supplier_name")
            .agg(ratio(F.sum("s"), F.sum("n"), 1).alias("avg_lead_time"))
            .orderBy(F.col("avg_lead_time").desc()))


def purchases_by_month(m: Marts, f: MartFilters = NO_FILTERS) -> DataFrame:
    g = _purchases(m, f, P_SUPPLIER, "month").groupBy("month").agg(_money_sum("item_total", "total_value"))
    return g.select("month", R.month_label(F.col("month")).alias("month_name"), "total_value").orderBy("month")


def purchases_top10_products(m: Marts, f: MartFilters = NO_FILTERS) -> DataFrame:
    per_key = _purchases(m, f, P_SUPPLIER).groupBy("product_key").agg(F.sum("quantity").alias("q"))
    by_name = (per_key.join(m.dim_product.select("product_key", "product_name"), "product_key")
               .groupBy("product_name").agg(F.sum("q").cast("bigint").alias("quantity")))
    return top_k(by_name, "quantity", "product_name", 10)


def purchases_supplier_summary(m: Marts, f: MartFilters = NO_FILTERS) -> DataFrame:
    # A purchase has one supplier: distinct purchases add up across keys.
    per_key = (_purchases(m, f, P).groupBy("supplier_key")
               .agg(F.countDistinct("purchase_id").alias("n"), F.sum("item_total").alias("v"),
                    F.sum("lead_time_days").alias("ls"), F.count("lead_time_days").alias("ln")))
    return (_by_supplier(m, per_key).groupBy("supplier_name")
            .agg(F.sum("n").cast("bigint").alias("purchases"), F.sum("v").cast(MONEY_SUM).alias("total_value"),
                 ratio(F.sum("ls"), F.sum("ln"), 1).alias("avg_lead_time"))
            .orderBy(F.col("total_value").desc()))


def purchases_category_by_quarter(m: Marts, f: MartFilters = NO_FILTERS) -> DataFrame:
    per_key = (_purchases(m, f, P, "quarter").groupBy("product_key", "quarter")
               .agg(F.sum("item_total").alias("v")))
    dim = m.dim_product.filter(F.col("category").isNotNull()).select("product_key", "category")
    x = quarter_crosstab(per_key.join(dim, "product_key"), "category", "quarter", "v", "category")
    return x.select("category", *[F.col(c).cast(MONEY_SUM).alias(c) for c in ("T1", "T2", "T3", "T4", "total")]) \
            .orderBy(F.col("total").desc())


# -- deliveries -------------------------------------------------------------------
def _deliveries(m: Marts, f: MartFilters, allowed, *cal_cols: str, lookups: bool = False) -> DataFrame:
    """``lookups``: the card reads employee or carrier keys."""
    by_carrier = "carrier" in allowed and f.carrier is not None
    lean = not (lookups or by_carrier) and isinstance(m, Marts) and "fact_deliveries" not in m.__dict__
    fd = f.period(m.fact_deliveries_core if lean else m.fact_deliveries, "order_date", allowed)
    if by_carrier:
        chosen = m.dim_carrier.filter(F.col("carrier_name") == f.carrier).select("carrier_key")
        fd = fd.join(chosen, "carrier_key", "left_semi")
    return _with_calendar(fd, m, "order_time_key", cal_cols)


def _carriers(m: Marts) -> DataFrame:
    return m.dim_carrier.select("carrier_key", "carrier_name")


def deliveries_count(m: Marts, f: MartFilters = NO_FILTERS) -> DataFrame:
    return _deliveries(m, f, P_CARRIER).agg(F.count(F.lit(1)).alias("orders"))


def deliveries_freight_total(m: Marts, f: MartFilters = NO_FILTERS) -> DataFrame:
    return _deliveries(m, f, P_CARRIER).agg(_money_sum("freight", "freight_total"))


def deliveries_avg_days_to_ship(m: Marts, f: MartFilters = NO_FILTERS) -> DataFrame:
    d = _deliveries(m, f, P_CARRIER).filter(F.col("days_to_ship").isNotNull())
    return d.agg(ratio(F.sum("days_to_ship"), F.count("days_to_ship"), 1).alias("avg_days"))


def deliveries_avg_delay(m: Marts, f: MartFilters = NO_FILTERS) -> DataFrame:
    d = _deliveries(m, f, P_CARRIER).filter(F.col("delay_days").isNotNull())
    return d.agg(ratio(F.sum("delay_days"), F.count("delay_days"), 1).alias("avg_delay"))


def deliveries_on_time_pct(m: Marts, f: MartFilters = NO_FILTERS) -> DataFrame:
    d = _deliveries(m, f, P_CARRIER).filter(F.col("delay_days").isNotNull())
    on_time = F.sum(F.when(F.col("delay_days") <= 0, 1).otherwise(0))
    return d.agg(ratio(on_time * F.lit(100), F.count("delay_days"), 2).alias("on_time_pct"))


def _per_carrier(m: Marts, d: DataFrame, *aggs) -> DataFrame:
    return d.groupBy("carrier_key").agg(*aggs).join(_carriers(m), "carrier_key")


def deliveries_delay_by_carrier(m: Marts, f: MartFilters = NO_FILTERS) -> DataFrame:
    d = _deliveries(m, f, P, lookups=True).filter(F.col("delay_days").isNotNull())
    g = _per_carrier(m, d, F.sum("delay_days").alias("s"), F.count("delay_days").alias("n"))
    return (g.groupBy("carrier_name").agg(ratio(F.sum("s"), F.sum("n"), 1).alias("avg_delay"))
            .orderBy(F.col("avg_delay").desc()))


def deliveries_freight_by_carrier(m: Marts, f: MartFilters = NO_FILTERS) -> DataFrame:
    d = _deliveries(m, f, P, lookups=True)
    g = _per_carrier(m, d, F.sum("freight").alias("s"), F.count("freight").alias("n"))
    return (g.groupBy("carrier_name").agg(ratio(F.sum("s"), F.sum("n"), 2).alias("avg_freight"))
            .orderBy(F.col("avg_freight").desc_nulls_first()))


def deliveries_by_month(m: Marts, f: MartFilters = NO_FILTERS) -> DataFrame:
    g = _deliveries(m, f, P_CARRIER, "month").groupBy("month").agg(F.count(F.lit(1)).alias("orders"))
    return g.select("month", R.month_label(F.col("month")).alias("month_name"), "orders").orderBy("month")


def deliveries_top10_employees(m: Marts, f: MartFilters = NO_FILTERS) -> DataFrame:
    d = _deliveries(m, f, P_CARRIER, lookups=True)
    per_key = d.groupBy("employee_key").agg(F.sum("order_value").alias("v"))
    emp = m.dim_employee.select("employee_key", "employee_name")
    by_name = (per_key.join(emp, "employee_key", "left")
               .filter(F.col("employee_name") != R.UNKNOWN_NAME)
               .groupBy("employee_name").agg(F.sum("v").cast(MONEY_SUM).alias("total_value")))
    return top_k(by_name, "total_value", "employee_name", 10)


def deliveries_carrier_summary(m: Marts, f: MartFilters = NO_FILTERS) -> DataFrame:
    d = _deliveries(m, f, P, lookups=True)
    g = _per_carrier(m, d, F.count(F.lit(1)).alias("c"), F.sum("order_value").alias("v"),
                     F.sum("freight").alias("fs"), F.count("freight").alias("fn"),
                     F.sum("days_to_ship").alias("ss"), F.count("days_to_ship").alias("sn"),
                     F.sum("delay_days").alias("ds"), F.count("delay_days").alias("dn"))
    return (g.groupBy("carrier_name")
            .agg(F.sum("c").cast("bigint").alias("orders"), F.sum("v").cast(MONEY_SUM).alias("total_value"),
                 ratio(F.sum("fs"), F.sum("fn"), 2).alias("avg_freight"),
                 ratio(F.sum("ss"), F.sum("sn"), 1).alias("avg_days_to_ship"),
                 ratio(F.sum("ds"), F.sum("dn"), 1).alias("avg_delay"))
            .orderBy(F.col("orders").desc()))


def deliveries_carrier_by_quarter(m: Marts, f: MartFilters = NO_FILTERS) -> DataFrame:
    d = _deliveries(m, f, P, "quarter", lookups=True)
    per_key = d.groupBy("carrier_key", "quarter").agg(F.sum("freight").alias("v"))
    x = quarter_crosstab(per_key.join(_carriers(m), "carrier_key"), "carrier_name", "quarter", "v", "carrier_name")
    return x.select("carrier_name", *[F.col(c).cast(MONEY_SUM).alias(c) for c in ("T1", "T2", "T3", "T4", "total")]) \
            .orderBy(F.col("total").desc_nulls_first())


SALES = [sales_total, sales_items_sold, sales_count, sales_avg_ticket, sales_by_source,
         sales_top10_products, sales_by_month, sales_top10_customers, sales_by_category,
         sales_ticket_by_income_band, sales_category_by_quarter]
PURCHASES = [purchases_total, purchases_items, purchases_avg_lead_time, purchases_count,
             purchases_top10_suppliers, purchases_lead_time_by_supplier, purchases_by_month,
             purchases_top10_products, purchases_supplier_summary, purchases_category_by_quarter]
DELIVERIES = [deliveries_count, deliveries_freight_total, deliveries_avg_days_to_ship, deliveries_avg_delay,
              deliveries_on_time_pct, deliveries_delay_by_carrier, deliveries_freight_by_carrier,
              deliveries_by_month, deliveries_top10_employees, deliveries_carrier_summary,
              deliveries_carrier_by_quarter]
ALL = SALES + PURCHASES + DELIVERIES
