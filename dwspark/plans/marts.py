"""Star-schema marts: type-1 dimensions and three facts.

Dimension keys are deterministic functions of the business key
(``functions.keys``), so facts get most keys by projection instead of a
join. Only employees and carriers are joined, because their lookup must
fall back to the -1 member (J8).
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions.calendar import calendar_dim, time_key
from ..functions.keys import surrogate_key, with_unknown_member
from ..operators.sinks import stage
from ..sources.binding import SRC_RETAIL, SRC_WHOLESALE, SourceTables
from .corporate import Corporate

DEFAULT_AS_OF = "2001-01-01"   # age bands are computed as of this date (C12)


def staged_marts(spark: SparkSession, sf_dir: str) -> Marts:
    """Marts whose corporate layer is written once and read by every fact and
    dimension: for jobs that go over many of them."""
    m = Marts(spark, sf_dir)
    for name in ("purchase_lines", "sales_lines", "address_inputs"):
        m.corp.__dict__[name] = stage(getattr(m.corp, name), name)
    m.corp.__dict__["sales_items"] = m.corp.sales_lines
    return m


class Marts:
    def __init__(self, spark: SparkSession, sf_dir: str, as_of: str = DEFAULT_AS_OF, order_filter=None,
                 corp=None, src=None):
        """``corp`` replaces the computed corporate layer with stored tables
        (``warehouse.StoredCorporate``): marts are built from the corporate
        layer only (F7); ``src`` replaces the sources, e.g. by bounded ones."""
        self.spark = spark
        self.sf_dir = sf_dir
        self.as_of = as_of
        self.src = src if src is not None else SourceTables(spark, sf_dir, order_filter)
        self.corp = corp if corp is not None else Corporate(self.src)

    # -- dimensions ------------------------------------------------------------
    @cached_property
    def dim_time(self) -> DataFrame:
        return calendar_dim(self.spark)

    @cached_property
    def dim_customer(self) -> DataFrame:
        c = self.corp.customers
        return c.select(
            surrogate_key(F.col("source_system"), F.col("customer_id")).alias("customer_key"),
            "source_system", "customer_id", "person_type", F.col("name").alias("customer_name"),
            "sex", "income_band", "marital_status",
            R.age_band_from_year(F.col("birth_year"), F.to_date(F.lit(self.as_of))).alias("age_band"),
            "birth_year", "profession", "area_code", "phone_type")

    @cached_property
    def dim_product(self) -> DataFrame:
        p = self.corp.products
        return p.select(surrogate_key(F.col("source_system"), F.col("product_id")).alias("product_key"),
                        "source_system", "product_id", F.col("name").alias("product_name"), "category",
                        "price", "currency")

    @cached_property
    def dim_address(self) -> DataFrame:
        """Geography flattened into one row per address (J6: inner joins)."""
        a, ci, st = self.corp.addresses, self.corp.cities, self.corp.states
        return (a.join(ci, "city_key").join(st, "state_key")
                 .select(surrogate_key(F.col("source_system"), F.col("address_id")).alias("address_key"),
                         "source_system", "address_id", "address_type", "street", "postal_code", "district",
                         "city_region", F.col("city_name").alias("city"), F.col("state_name").alias("state"),
                         "state_code", "country"))

    @cached_property
    def dim_employee(self) -> DataFrame:
        """Employees flattened with their address (J5: left joins) + -1."""
        e = self.corp.employees
        # an address keeps its own city and country, so no other address needs to be read
        addr = self.corp.employee_addresses.select(F.col("source_system").alias("a_src"), F.col("address_id").alias("a_id"),
                                                   "city", "country")
        d = (e.join(addr, (e.source_system == addr.a_src) & (e.address_id == addr.a_id), "left")
              .select(surrogate_key(F.col("source_system"), F.col("employee_id")).alias("employee_key"),
                      "source_system", "employee_id", F.col("name").alias("employee_name"), "title",
                      "hire_date", "city", "country"))
        return with_unknown_member(d, "employee_key", {"source_system": R.UNKNOWN_SOURCE,
                                                       "employee_name": R.UNKNOWN_NAME,
                                                       "title": R.UNKNOWN_NAME})

    @cached_property
    def dim_carrier(self) -> DataFrame:
        c = self.corp.carriers
        d = c.select(surrogate_key(F.col("source_system"), F.col("carrier_id")).alias("carrier_key"),
                     "source_system", "carrier_id", F.col("name").alias("carrier_name"), "phone")
        return with_unknown_member(d, "carrier_key", {"source_system": R.UNKNOWN_SOURCE,
                                                      "carrier_name": R.UNKNOWN_NAME})

    @cached_property
    def dim_supplier(self) -> DataFrame:
        s = self.corp.suppliers
        return s.select(surrogate_key(F.col("source_system"), F.col("supplier_id")).alias("supplier_key"),
                        "source_system", "supplier_id", F.col("name").alias("supplier_name"), "phone")

    # -- lookups that default to -1 -------------------
    @cached_property
    def employee_keys(self) -> DataFrame:
        """(source, employee id) -> key, straight from the corporate rows:
        the lookup needs no flattened geography."""
        e = self.corp.employees
        return e.select("source_system", "employee_id",
                        surrogate_key(F.col("source_system"), F.col("employee_id")).alias("employee_key"))

    @cached_property
    def carrier_keys(self) -> DataFrame:
        c = self.corp.carriers
        return c.select("source_system", "carrier_id",
                        surrogate_key(F.col("source_system"), F.col("carrier_id")).alias("carrier_key"))

    def _lookup(self, df: DataFrame, keys: DataFrame, key: str, id_col: str, out: str) -> DataFrame:
        """Left join to a dimension's keys; misses and NULL ids fall back to
        the -1 member (J8). Spark broadcasts the keys if their size allows."""
        d = (keys.select(F.col("source_system").alias("__src"), F.col(id_col).alias("__id"),
                         F.col(key).alias("__key"))
                 .dropDuplicates(["__src", "__id"]))
        j = df.join(d, (df["source_system"] == d["__src"]) & (df[id_col] == d["__id"]), "left")
        return (j.withColumn(out, F.coalesce(F.col("__key"), F.lit(R.UNKNOWN_KEY).cast("bigint")))
                 .drop("__src", "__id", "__key"))

    # -- facts -------------------------------------------------------------------
    @cached_property
    def fact_sales_core(self) -> DataFrame:
        """``fact_sales`` without the employee/carrier lookups: the sales
        cards never read those keys, nor the address, and a left join cannot be pruned away."""
        li = self.corp.sales_items
        return li.select(
            "source_system", "sale_id", "item_id",
            time_key(F.col("order_date")).alias("time_key"),
            F.col("order_date").alias("sale_date"),
            surrogate_key(F.col("source_system"), F.col("customer_id")).alias("customer_key"),
            surrogate_key(F.col("source_system"), F.col("product_id")).alias("product_key"),
            "quantity", "unit_price", "discount_amount", "item_total")

    @cached_property
    def fact_sales(self) -> DataFrame:
        """One row per sold item of both sources (F1)."""
        li = self.corp.sales_lines
        li = self._lookup(li, self.employee_keys, "employee_key", "employee_id", "employee_key")
        li = self._lookup(li, self.carrier_keys, "carrier_key", "carrier_id", "carrier_key")
        return li.select(
            "source_system", "sale_id", "item_id",
            time_key(F.col("order_date")).alias("time_key"),
            F.col("order_date").alias("sale_date"),
            surrogate_key(F.col("source_system"), F.col("customer_id")).alias("customer_key"),
            surrogate_key(F.col("source_system"), F.col("product_id")).alias("product_key"),
            surrogate_key(F.col("source_system"), F.col("address_id")).alias("address_key"),
            "employee_key", "carrier_key",
            R.sale_type(F.col("sale_type_code")).alias("sale_type"),
            "quantity", "unit_price", "discount_amount", "item_total")

    @cached_property
    def fact_purchases(self) -> DataFrame:
        """One row per purchased item, retail only."""
        li = self.corp.purchase_lines
        # the purchase's entry date is its last ship date: a window over lines that the
        # header join has dealt by order already, not a second scan
        last = F.max("ship_date").over(Window.partitionBy("l_orderkey", "l_suppkey"))
        j = (li.withColumn("entry_date", F.when(F.col("o_orderstatus") != "O", last))
             .withColumn("lead_time_days", R.days_between(F.col("entry_date"), F.col("order_date"))))
        sup = F.col("l_suppkey").cast("string")
        return j.select(
            F.lit(SRC_RETAIL).alias("source_system"), "purchase_id",
            F.lit(None).cast("string").alias("item_id"),
            time_key(F.col("order_date")).alias("time_key"),
            F.col("order_date").alias("purchase_date"),
            surrogate_key(F.lit(SRC_RETAIL), sup).alias("supplier_key"),
            surrogate_key(F.lit(SRC_RETAIL), F.col("product_id")).alias("product_key"),
            surrogate_key(F.lit(SRC_RETAIL), F.concat(F.lit("SUP-"), sup)).alias("address_key"),
            "quantity", "unit_price", "item_total", "lead_time_days")

    @cached_property
    def order_values(self) -> DataFrame:
        """A1: items pre-aggregated to the order (wholesale money rule). An order's header columns are the same in all its
        items; as part of the group key they let a filter on them pass below the aggregate, to the scan."""
        li = self.corp.sales_items.filter(F.col("source_system") == SRC_WHOLESALE)
        return li.groupBy("o_orderkey", "source_system", "sale_id", "order_date", "o_orderstatus", "customer_id", "employee_id",
                          "carrier_id", "due_date", "freight").agg(
            F.sum("item_total").alias("order_value"), F.max("ship_date").alias("last_ship_date"))

    @cached_property
    def fact_deliveries_core(self) -> DataFrame:
        """``fact_deliveries`` without the employee and carrier lookups, for the cards that read neither."""
        return self._deliveries(self.order_values)

    @cached_property
    def fact_deliveries(self) -> DataFrame:
        """One row per wholesale order with items."""
        # lines are read once: value, ship date and header of an order in one aggregate
        h = self._lookup(self.order_values, self.employee_keys, "employee_key", "employee_id", "employee_key")
        h = self._lookup(h, self.carrier_keys, "carrier_key", "carrier_id", "carrier_key")
        return self._deliveries(h, "employee_key", "carrier_key")

    @staticmethod
    def _deliveries(orders: DataFrame, *looked_up: str) -> DataFrame:
        h = orders.withColumn("shipped_date", F.when(F.col("o_orderstatus") != "O", F.col("last_ship_date")))
        return h.select(
            "source_system", "sale_id",
            time_key(F.col("order_date")).alias("order_time_key"),
            F.when(F.col("shipped_date").isNotNull(), time_key(F.col("shipped_date"))).alias("ship_time_key"),
            F.col("order_date"), F.col("shipped_date"),
            surrogate_key(F.col("source_system"), F.col("customer_id")).alias("customer_key"),
            *looked_up,
            surrogate_key(F.col("source_system"), F.col("customer_id")).alias("address_key"),
            F.coalesce(F.col("order_value"), F.lit(0)).cast("decimal(25,2)").alias("order_value"),
            "freight",
            R.days_between(F.col("due_date"), F.col("order_date")).alias("promised_days"),
            R.days_between(F.col("shipped_date"), F.col("order_date")).alias("days_to_ship"),
            R.days_between(F.col("shipped_date"), F.col("due_date")).alias("delay_days"))
