"""Delta queries behind an id watermark (E2), on the same code path as
the full load: the delta is nothing but bounded sources. Scenario of the
registered queries: the initial load took the orders up to half of the
largest order key, and the delta is everything above its watermarks. Loads
that keep state are in ``loads``.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.sinks import items_of_new, stage
from ..oracle.binding import with_binding
from ..sources.binding import SRC_RETAIL, SRC_WHOLESALE
from ..sources.bounds import BoundedSources
from ..sources.readers import sf_table
from .marts import Marts


def watermark_by_source(headers: DataFrame, sources: list[str], id_col: str) -> DataFrame:
    """``coalesce(max(cast(id as bigint)), 0)`` per source; a source with
    nothing loaded yet gets 0 (its placeholder row joins the aggregate by
    union, not by a join). Ids that are not numbers are ignored
    (``try_cast``, N13) instead of failing the batch."""
    spark = headers.sparkSession
    ids = headers.select("source_system", F.col(id_col).cast("string").alias("__id"))
    every = spark.createDataFrame([(s, None) for s in sources], "source_system string, __id string")
    return (ids.filter(F.col("source_system").isin(sources)).unionByName(every)
               .groupBy("source_system")
               .agg(F.coalesce(F.max(F.col("__id").try_cast("bigint")), F.lit(0).cast("bigint")).alias("watermark")))


class IncrementalLoad:
    """The delta behind an initial load. The watermarks are a few numbers, so they are read first and reach the
    scans of orders and lines as literals (``BoundedSources``)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def cut(self) -> int:
        orders = sf_table(self.spark, self.sf_dir, "orders", ["o_orderkey"])
        return (orders.agg(F.max("o_orderkey")).first()[0] or 0) // 2

    @cached_property
    def initial(self) -> Marts:
        return Marts(self.spark, self.sf_dir, src=BoundedSources(self.spark, self.sf_dir, upto=self.cut))

    @cached_property
    def sales_watermarks(self) -> DataFrame:
        """Of the orders that were loaded: those with items, whose keys alone are read."""
        src = self.initial.src
        loaded = (src.orders.select("source_system", F.col("o_orderkey").alias("sale_id"))
                  .join(src.lines.select(F.col("l_orderkey").alias("sale_id")), "sale_id", "left_semi"))
        return stage(watermark_by_source(loaded, [SRC_WHOLESALE, SRC_RETAIL], "sale_id"), "sales-watermarks")

    @cached_property
    def purchase_watermarks(self) -> DataFrame:
        loaded = self.initial.corp.purchase_lines.select(
            F.lit(SRC_RETAIL).alias("source_system"), F.col("l_orderkey").alias("purchase_order"))
        return stage(watermark_by_source(loaded, [SRC_RETAIL], "purchase_order"), "purchase-watermarks")

    @cached_property
    def watermarks(self) -> DataFrame:
        return (self.sales_watermarks.withColumn("stream", F.lit("sales"))
                .unionByName(self.purchase_watermarks.withColumn("stream", F.lit("purchases")))
                .select("stream", "source_system", "watermark"))

    def _beyond(self, watermarks: DataFrame) -> Marts:
        bounds = {r.source_system: r.watermark for r in watermarks.collect()}       # a row per source system
        return Marts(self.spark, self.sf_dir, src=BoundedSources(self.spark, self.sf_dir, bounds))

    @cached_property
    def sales_delta(self) -> Marts:
        return self._beyond(self.sales_watermarks)

    @cached_property
    def purchases_delta(self) -> Marts:
        return self._beyond(self.purchase_watermarks)

    # -- staging (delta extracts) -------------------------------------------------
    def delta_sales(self) -> DataFrame:
        li = self.sales_delta.corp.sales_items
        return li.select("source_system", "sale_id", "customer_id", "order_date", "employee_id", "carrier_id",
                         "product_id", "quantity", "unit_price", "discount_rate")

    def delta_purchases(self) -> DataFrame:
        li = self.purchases_delta.corp.purchase_lines
        return li.select("purchase_id", F.col("l_suppkey").cast("string").alias("supplier_id"), "order_date",
                         "product_id", "quantity", "unit_price")

    # -- touched keys (X1/X2) ---------------------------------------------------------
    def touched_customers(self) -> DataFrame:
        return self.delta_sales().select("source_system", "customer_id").distinct()

    def touched_products(self) -> DataFrame:
        s = self.delta_sales().select("source_system", "product_id")
        p = self.delta_purchases().select(F.lit(SRC_RETAIL).alias("source_system"), "product_id")
        return s.union(p).distinct()

    def touched_dim_keys(self) -> DataFrame:
        c = self.touched_customers().select(F.lit("customer").alias("dimension"), "source_system",
                                            F.col("customer_id").alias("natural_id"))
        p = self.touched_products().select(F.lit("product").alias("dimension"), "source_system",
                                           F.col("product_id").alias("natural_id"))
        s = self.delta_purchases().select(F.lit("supplier").alias("dimension"),
                                          F.lit(SRC_RETAIL).alias("source_system"),
                                          F.col("supplier_id").alias("natural_id"))
        return c.union(p).union(s).distinct()

    # -- facts -------------------------------------------------------------------------
    def fact_sales_incremental(self) -> DataFrame:
        return self.sales_delta.fact_sales

    def fact_purchases_incremental(self) -> DataFrame:
        return self.purchases_delta.fact_purchases

    def fact_deliveries_incremental(self) -> DataFrame:
        return self.sales_delta.fact_deliveries

    def fact_sales_initial_plus_delta(self) -> DataFrame:
        return self.initial.fact_sales.unionByName(self.fact_sales_incremental())

    def fact_sales_replayed(self) -> DataFrame:
        """Applying the same delta a second time adds nothing."""
        once = self.fact_sales_initial_plus_delta()
        return once.unionByName(items_of_new(once, self.fact_sales_incremental(), ["source_system", "sale_id"]))


def _q(method: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        inc = IncrementalLoad(spark, sf_dir)
        out = getattr(inc, method)
        return out() if callable(out) else out
    run.__name__ = method
    return run


def queries() -> dict:
    names = ["watermarks", "delta_sales", "delta_purchases", "touched_customers", "touched_products",
             "touched_dim_keys", "fact_sales_incremental",
             "fact_purchases_incremental", "fact_deliveries_incremental", "fact_sales_initial_plus_delta",
             "fact_sales_replayed"]
    out = {n: _q(n) for n in names}
    out["watermark_by_source"] = out.pop("watermarks")
    return out


# -- oracle: the same scenario restated in SQL -------------------------------------------
_WM = """
    cut AS (SELECT max(o_orderkey) // 2 AS v FROM orders),
    wm_sales AS (SELECT s.source_system, coalesce(max(sl.o_orderkey), 0) AS watermark
                 FROM (VALUES ('WHOLESALE'), ('RETAIL')) s(source_system)
                 LEFT JOIN sales_lines sl ON sl.source_system = s.source_system AND sl.o_orderkey <= (SELECT v FROM cut)
                 GROUP BY s.source_system),
    wm_purch AS (SELECT 'RETAIL' AS source_system, coalesce(max(l_orderkey), 0) AS watermark
                 FROM purchase_lines WHERE l_orderkey <= (SELECT v FROM cut)),
    d_sales AS (SELECT sl.* FROM sales_lines sl JOIN wm_sales w ON w.source_system = sl.source_system
                WHERE sl.o_orderkey > w.watermark),
    d_purch AS (SELECT pl.* FROM purchase_lines pl WHERE pl.l_orderkey > (SELECT watermark FROM wm_purch))"""


def _sql(body: str) -> str:
    full = with_binding("SELECT 1")
    head = full[: full.rfind("\nSELECT 1")]
    return f"{head},{_WM}\n{body.strip()}"


def oracle_sql() -> dict:
    return {
        "watermark_by_source": _sql("""SELECT 'sales' AS stream, source_system, watermark FROM wm_sales
                                      UNION ALL SELECT 'purchases', source_system, watermark FROM wm_purch"""),
        "delta_sales": _sql("""SELECT source_system, sale_id, customer_id, order_date, employee_id, carrier_id,
                                      CAST(l_partkey AS VARCHAR) AS product_id, quantity, unit_price, discount_rate
                               FROM d_sales"""),
        "delta_purchases": _sql("""SELECT purchase_id, CAST(l_suppkey AS VARCHAR) AS supplier_id, order_date,
                                          CAST(l_partkey AS VARCHAR) AS product_id, quantity, unit_price FROM d_purch"""),
        "touched_customers": _sql("SELECT DISTINCT source_system, customer_id FROM d_sales"),
        "touched_products": _sql("""SELECT source_system, CAST(l_partkey AS VARCHAR) AS product_id FROM d_sales
                                    UNION SELECT 'RETAIL', CAST(l_partkey AS VARCHAR) FROM d_purch"""),
        "touched_dim_keys": _sql("""SELECT 'customer' AS dimension, source_system, customer_id AS natural_id FROM d_sales
                                    UNION SELECT 'product', source_system, CAST(l_partkey AS VARCHAR) FROM d_sales
                                    UNION SELECT 'product', 'RETAIL', CAST(l_partkey AS VARCHAR) FROM d_purch
                                    UNION SELECT 'supplier', 'RETAIL', CAST(l_suppkey AS VARCHAR) FROM d_purch"""),
        "fact_sales_incremental": _sql("""SELECT f.* FROM fact_sales f JOIN wm_sales w ON w.source_system = f.source_system
                                          WHERE CAST(f.sale_id AS BIGINT) > w.watermark"""),
        "fact_purchases_incremental": _sql("""SELECT f.* FROM fact_purchases f
              WHERE CAST(split_part(f.purchase_id, '-', 1) AS BIGINT) > (SELECT watermark FROM wm_purch)"""),
        "fact_deliveries_incremental": _sql("""SELECT f.* FROM fact_deliveries f JOIN wm_sales w
              ON w.source_system = f.source_system WHERE CAST(f.sale_id AS BIGINT) > w.watermark"""),
        "fact_sales_initial_plus_delta": _sql("SELECT * FROM fact_sales"),
        "fact_sales_replayed": _sql("SELECT * FROM fact_sales"),
    }
