"""Registered queries over a warehouse that three loads have made: the sources at
three times, each load a run of its own that opens what the last one published."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources.bounds import EarlierSources
from ..sources.readers import sf_table
from .loads import ENTITIES, FACTS, VERSIONED, Sources, Warehouse

DAYS = ["2001-03-01", "2001-04-01", "2001-05-01"]
AGES = [1, 2, 0]                      # of the sources at each load

_made: dict[tuple, str] = {}


def sources_at(spark: SparkSession, sf_dir: str, load: int) -> Sources:
    """The sources at load 0, 1 or 2: up to a half and three quarters of the order keys, then all."""
    top = sf_table(spark, sf_dir, "orders", ["o_orderkey"]).agg(F.max("o_orderkey")).first()[0] or 0
    upto = [top // 2, top * 3 // 4, None][load]
    return lambda bounds: EarlierSources(spark, sf_dir, bounds, upto, AGES[load])


def three_loads(spark: SparkSession, sf_dir: str, without_marts: tuple[int, ...] = ()) -> Warehouse:
    """The warehouse after three loads, made once per application. The mart step of the loads named is left out."""
    key = (spark.sparkContext.applicationId, sf_dir, without_marts)
    if key not in _made:
        base = scratch_path(spark, "warehouse")
        for load, day in enumerate(DAYS):
            store = Warehouse(spark, base)                     # each load opens the store anew
            store.load_corporate(sources_at(spark, sf_dir, load), day)
            if load not in without_marts:
                store.load_marts()
        _made[key] = base
    return Warehouse(spark, _made[key])


def _table(name: str, *dropped: str, without_marts: tuple[int, ...] = ()):
    return lambda spark, sf_dir: three_loads(spark, sf_dir, without_marts).table(name).drop(*dropped)


def warehouse_after_three_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that each load brought to each table; versions by the day they start."""
    store = three_loads(spark, sf_dir)
    last = store.log.read()
    found = []
    for name in ["sales", "purchases", *FACTS]:
        for part in [p for p in last.parts if p.startswith(f"{name}/")]:
            load = int(part.split("/")[1].split("-")[0])
            found.append(store.table(name, last, [part]).agg(F.count("*").alias("rows"))
                         .select(F.lit(name).alias("table_name"), F.lit(load).alias("load"), "rows"))
    load = F.coalesce(*[F.when(F.col("valid_from") == d, F.lit(i)) for i, d in enumerate(DAYS, 1)])
    for name in VERSIONED:
        found.append(store.table(name, last).groupBy(load.alias("load")).agg(F.count("*").alias("rows"))
                     .select(F.lit(name).alias("table_name"), "load", "rows"))
    return reduce(DataFrame.unionByName, found)


def purchases_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headers of the stored purchases, with the load that brought them."""
    store = three_loads(spark, sf_dir)
    last = store.log.read()
    loads = [store.table("purchases", last, [f"purchases/{n}"]).withColumn("load", F.lit(n)) for n in range(1, len(DAYS) + 1)]
    return (reduce(DataFrame.unionByName, loads).groupBy("source_system", "purchase_id", "supplier_id", "order_date", "load")
            .agg(F.count("*").alias("items"), F.sum("item_total").cast("decimal(38,2)").alias("value")))


def load_watermarks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S4 after three loads, against the stored rows: one row a stream and source."""
    store = three_loads(spark, sf_dir)
    marks = [(s, k, v) for s, x in store.log.read().settings["watermarks"].items() for k, v in x.items()]
    kept = spark.createDataFrame(marks, "stream string, source_system string, watermark long")
    stored = (store.table("sales").groupBy("source_system").agg(F.max("sale_no").alias("stored")).withColumn("stream", F.lit("sales"))
              .unionByName(store.table("purchases").groupBy("source_system").agg(F.max("purchase_no").alias("stored"))
                           .withColumn("stream", F.lit("purchases"))))
    return kept.join(stored, ["stream", "source_system"], "left")


def queries() -> dict:
    return ({"warehouse_after_three_loads": warehouse_after_three_loads, "load_watermarks": load_watermarks,
             "purchases_append": purchases_append, "fact_sales_after_three_loads": _table("fact_sales"),
             "fact_sales_after_catch_up": _table("fact_sales", without_marts=(0, 1)),
             "fact_purchases_appended": _table("fact_purchases"), "fact_deliveries_appended": _table("fact_deliveries")}
            | {f"{e}_after_three_loads": _table(e) for e in ENTITIES})


def oracle_sql() -> dict:
    from ..oracle import loads
    return loads.oracle_sql()
