"""Binding of the supplied TPC-H-like tables to the two source systems.

This is the only module that knows TPC-H column names. It plays the part
of the two OLTP databases: customers with even keys belong to the
wholesale source (companies, free-text geography, employees, carriers,
freight), customers with odd keys to the retail source (persons with
income, birth year, phones, normalized geography, purchases).

Every view is a lazy, column-pruned DataFrame over the given tables, so
its size grows with the data. The oracle module mirrors each view in
DuckDB SQL (``dwspark.oracle.binding``).
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.rules import MONEY, RATE
from .readers import sf_table

# FIXED VALUES: source-system tags of the two simulated sources.
SRC_WHOLESALE = "WHOLESALE"
SRC_RETAIL = "RETAIL"
# Binding parameters (see README, "Test-data binding").
DUE_DAYS = 28                # promised date = order date + 28 days
FREIGHT_RATE = "0.01"        # freight = 1 % of the order's total price
INCOME_FACTOR = "2.5"        # income = account balance * 2.5
BIRTH_YEAR_BASE, BIRTH_YEAR_SPAN = 1920, 66
CITY_BUCKETS = 7
PURCHASE_RETURN_FLAG = "R"   # retail purchases = lines flagged 'R'


def source_of(custkey: Column) -> Column:
    """The source system that a row comes from."""
    return F.when(custkey % 2 == 0, F.lit(SRC_WHOLESALE)).otherwise(F.lit(SRC_RETAIL))


def _city(k: Column) -> Column:
    return F.concat(F.lit("CITY_"), (k % CITY_BUCKETS).cast("string"))


class SourceTables:
    """Source-system views over one ``sf_dir``."""

    def __init__(self, spark: SparkSession, sf_dir: str, order_filter=None):
        """``order_filter`` restricts which orders (sale/purchase headers)
        are extracted -- the only difference between a full and an
        incremental load (rule: one code path for both)."""
        self.spark = spark
        self.sf_dir = sf_dir
        self.order_filter = order_filter

    def t(self, name: str, *cols: str) -> DataFrame:
        return sf_table(self.spark, self.sf_dir, name, list(cols) or None)

    # -- geography helpers -------------------------------------------------
    @cached_property
    def nation_region(self) -> DataFrame:
        n = self.t("nation", "n_nationkey", "n_name", "n_regionkey")
        r = self.t("region", "r_regionkey", "r_name")
        return n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", "n_name", "r_name")

    # -- wholesale source (companies) -------------------------------------
    @cached_property
    def wholesale_customers(self) -> DataFrame:
        c = self.t("customer", "c_custkey", "c_name", "c_nationkey").filter(F.col("c_custkey") % 2 == 0)
        k = F.col("c_custkey")
        return (c.join(self.nation_region, c.c_nationkey == F.col("n_nationkey"), "left")
                 .select(k.cast("string").alias("customer_id"),
                         F.col("c_name").alias("company_name"),
                         F.lit(None).cast("string").alias("contact_title"),
                         F.concat(F.lit("ADDR-"), k.cast("string")).alias("address"),
                         _city(k).alias("city"),
                         F.when(k % 3 == 0, F.lit(None)).otherwise(F.col("n_name")).alias("region"),
                         F.lpad((k % 100000).cast("string"), 5, "0").alias("postal_code"),
                         F.col("r_name").alias("country")))

    @cached_property
    def wholesale_employees(self) -> DataFrame:
        """Every supplier row plays an employee."""
        s = self.t("supplier", "s_suppkey", "s_name", "s_nationkey")
        k = F.col("s_suppkey")
        return (s.join(self.nation_region, s.s_nationkey == F.col("n_nationkey"), "left")
                 .select(k.cast("string").alias("employee_id"),
                         F.col("s_name").alias("first_name"),
                         F.concat(F.lit("No"), k.cast("string")).alias("last_name"),
                         F.concat(F.lit("TITLE_"), (k % 3).cast("string")).alias("title"),
                         F.date_add(F.to_date(F.lit("1990-01-01")), (k * 97).cast("int")).alias("hire_date"),
                         F.concat(F.lit("ADDR-S"), k.cast("string")).alias("address"),
                         _city(k).alias("city"),
                         F.col("n_name").alias("region"),
                         F.lpad((k * 7919 % 100000).cast("string"), 5, "0").alias("postal_code"),
                         F.col("r_name").alias("country")))

    @cached_property
    def last_employee(self) -> Column:
        """The largest employee id, a scalar subquery: orders are spread over all of them."""
        return self.t("supplier", "s_suppkey").select(F.max("s_suppkey")).scalar()

    @cached_property
    def wholesale_carriers(self) -> DataFrame:
        """Carriers = distinct order priorities: the id before the first dash, the name behind it."""
        o = self.t("orders", "o_orderpriority")
        return (o.select(F.substring_index("o_orderpriority", "-", 1).alias("carrier_id"),
                         F.regexp_extract("o_orderpriority", "(?s)^[^-]*-(.*)$", 1).alias("company_name"))
                 .distinct()
                 .withColumn("phone", F.concat(F.lit("(555) 000-000"), F.col("carrier_id"))))

    # -- retail source (persons) ------------------------------------------
    @cached_property
    def retail_persons(self) -> DataFrame:
        c = self.t("customer", "c_custkey", "c_name", "c_acctbal", "c_mktsegment").filter(F.col("c_custkey") % 2 == 1)
        k = F.col("c_custkey")
        return c.select(
            k.alias("person_id"),
            F.col("c_name").alias("name"),
            F.when(k % 4 == 1, F.lit("F")).otherwise(F.lit("M")).alias("sex"),
            (F.col("c_acctbal").cast(MONEY) * F.lit(INCOME_FACTOR).cast("decimal(3,1)")).cast(MONEY).alias("income"),
            F.col("c_mktsegment").alias("marital_status"),
            (F.lit(BIRTH_YEAR_BASE) + k % BIRTH_YEAR_SPAN).cast("int").alias("birth_year"),
            F.col("c_mktsegment").alias("profession"))

    @cached_property
    def retail_phones(self) -> DataFrame:
        """1-3 phones per person; odd sequence numbers are preferred."""
        c = self.t("customer", "c_custkey").filter(F.col("c_custkey") % 2 == 1)
        k = F.col("c_custkey")
        seq = F.col("seq")
        return (c.select(k, F.explode(F.sequence(F.lit(1), (F.lit(1) + k % 3).cast("int"))).alias("seq"))
                 .select(k.alias("person_id"),
                         (k * 10 + seq).alias("phone_id"),
                         (F.lit(11) + (k + seq) % 89).cast("int").alias("area_code"),
                         F.lpad((k * 10 + seq).cast("string"), 8, "0").alias("number"),
                         ((k + seq - 1) % 4).cast("int").alias("type_code"),
                         (seq % 2 == 1).alias("preferred")))

    @cached_property
    def retail_addresses(self) -> DataFrame:
        """One address per person, address id = person id (as in the seed)."""
        c = self.t("customer", "c_custkey", "c_nationkey").filter(F.col("c_custkey") % 2 == 1)
        k = F.col("c_custkey")
        return (c.join(self.nation_region, c.c_nationkey == F.col("n_nationkey"), "left")
                 .select(k.alias("address_id"), k.alias("person_id"),
                         (F.lit(1) + k % 2).cast("int").alias("address_type_code"),
                         F.concat(F.lit("ADDR-"), k.cast("string")).alias("street"),
                         F.lpad((k % 100000).cast("string"), 5, "0").alias("postal_code"),
                         F.concat(F.lit("DISTRICT_"), (k % 11).cast("string")).alias("district"),
                         F.col("r_name").alias("city_region"),
                         _city(k).alias("city"),
                         F.col("n_name").alias("state_name"),
                         F.upper(F.substring("n_name", 1, 2)).alias("state_code"),
                         F.lit(True).alias("preferred")))

    @cached_property
    def retail_suppliers(self) -> DataFrame:
        """Supplier master (the counterpart of a purchase)."""
        s = self.t("supplier", "s_suppkey", "s_name", "s_nationkey")
        k = F.col("s_suppkey")
        return (s.join(self.nation_region, s.s_nationkey == F.col("n_nationkey"), "left")
                 .select(k.alias("supplier_id"), F.col("s_name").alias("name"),
                         (F.lit(11) + k % 89).cast("int").alias("area_code"),
                         F.lpad((k * 7).cast("string"), 8, "0").alias("number"),
                         F.concat(F.lit("ADDR-S"), k.cast("string")).alias("street"),
                         F.lpad((k * 7919 % 100000).cast("string"), 5, "0").alias("postal_code"),
                         F.concat(F.lit("DISTRICT_"), (k % 11).cast("string")).alias("district"),
                         F.col("r_name").alias("city_region"),
                         _city(k).alias("city"),
                         F.col("n_name").alias("state_name"),
                         F.upper(F.substring("n_name", 1, 2)).alias("state_code")))

    # -- products (both sources own the same part list) ---------------------
    @cached_property
    def products(self) -> DataFrame:
        p = self.t("part", "p_partkey", "p_name", "p_type", "p_retailprice")
        return p.select(F.col("p_partkey").cast("string").alias("product_id"),
                        F.col("p_name").alias("name"),
                        F.col("p_type").alias("category"),
                        F.col("p_retailprice").cast(MONEY).alias("price"))

    # -- transactions -----------------------------------------------------
    @cached_property
    def orders(self) -> DataFrame:
        o = self.t("orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                          "o_orderdate", "o_orderpriority")
        o = o.select(
            "o_orderkey", "o_custkey", "o_orderstatus",
            source_of(F.col("o_custkey")).alias("source_system"),
            F.col("o_orderdate").cast("date").alias("order_date"),
            F.col("o_totalprice"), F.col("o_orderpriority"))
        return self.order_filter(o) if self.order_filter is not None else o

    @cached_property
    def lines(self) -> DataFrame:
        li = self.t("lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                           "l_quantity", "l_extendedprice", "l_discount", "l_returnflag", "l_shipdate")
        return li.select(
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag",
            F.col("l_quantity").cast("int").alias("quantity"),
            F.col("l_extendedprice").cast(MONEY).alias("unit_price"),
            F.col("l_discount").cast(RATE).alias("discount_rate"),
            F.col("l_shipdate").cast("date").alias("ship_date"))

    def header_attributes(self, o: DataFrame) -> DataFrame:
        """Sale-header columns of both sources from an orders frame."""
        ws = F.col("source_system") == SRC_WHOLESALE
        k = F.col("o_orderkey")
        return o.select(
            "o_orderkey", "source_system", "order_date", "o_orderstatus",
            k.cast("string").alias("sale_id"),
            F.col("o_custkey").cast("string").alias("customer_id"),
            F.when(~ws, k % 4).cast("int").alias("sale_type_code"),
            F.when(ws, F.nullif(k % (self.last_employee + 1), F.lit(0)).cast("string")).alias("employee_id"),
            F.when(ws & (F.col("o_orderstatus") != "P"),
                   F.substring_index("o_orderpriority", "-", 1)).alias("carrier_id"),
            F.when(ws, F.date_add("order_date", DUE_DAYS)).alias("due_date"),
            F.when(ws, F.round(F.col("o_totalprice").cast(MONEY) * F.lit(FREIGHT_RATE).cast("decimal(3,2)"), 2)
                   .cast(MONEY)).alias("freight"))
