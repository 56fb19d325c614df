"""Full load to stored tables, and marts served from them.

``full_load`` computes every dimension and fact once and writes each as a
parquet snapshot under the shared folder (facts partitioned by year, so a
period filter prunes whole directories). ``StoredMarts`` exposes the same
attributes as ``Marts`` but reads those tables, so every dashboard query
runs unchanged on top of them. The written tables also cut lineage: a
lost executor recomputes from them, not from the sources.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import calendar_dim
from ..session import scratch_path
from .corporate import Corporate
from .marts import Marts

# corporate tables written by the full load (what the marts read)
CORPORATE = ["address_inputs", "countries", "states", "cities", "addresses", "customers", "employees",
             "carriers", "suppliers", "products", "person_address", "sales_lines", "sale_headers", "purchase_lines",
             "purchase_headers"]
DIMENSIONS = ["dim_customer", "dim_product", "dim_address", "dim_employee", "dim_carrier", "dim_supplier"]
FACTS = {"fact_sales": "sale_date", "fact_purchases": "purchase_date", "fact_deliveries": "order_date"}


# dependency waves of the corporate layer: a table only reads tables of
# earlier waves (stored copies)
CORPORATE_WAVES = [
    ["purchase_lines", "person_address"],
    ["sales_lines"],
    ["address_inputs", "purchase_headers", "sale_headers", "customers", "employees", "carriers", "products",
     "suppliers"],
    ["countries", "states", "cities", "addresses"],
]


def _parallel(jobs: list, workers: int) -> None:
    """Run independent write jobs concurrently from driver threads: their
    stages share the executors (as independent DAG tasks did)."""
    with ThreadPoolExecutor(max_workers=workers) as pool:
        for f in [pool.submit(j) for j in jobs]:
            f.result()


def full_load(spark: SparkSession, sf_dir: str, out: str | None = None, workers: int = 4) -> str:
    """Write the corporate layer, then every mart from the stored
    corporate tables; returns the snapshot folder.

    Tables that feed others (purchase lines -> suppliers and addresses;
    the conformed address set -> states, cities, addresses) are written in
    an earlier wave and read back, so each table is computed exactly once
    and every written layer cuts the lineage of the next."""
    out = out or scratch_path(spark, "warehouse")
    corp = Corporate(Marts(spark, sf_dir).src)

    def writer(name: str):
        def job() -> None:
            getattr(corp, name).write.mode("errorifexists").parquet(f"{out}/corporate/{name}")
        return job

    for wave in CORPORATE_WAVES:
        _parallel([writer(n) for n in wave], workers)
        for n in wave:   # later waves read the stored copy
            corp.__dict__[n] = spark.read.parquet(f"{out}/corporate/{n}")

    m = Marts(spark, sf_dir, corp=StoredCorporate(spark, f"{out}/corporate"))

    def dim_job(name: str):
        return lambda: getattr(m, name).write.mode("errorifexists").parquet(f"{out}/{name}")

    def fact_job(name: str, date_col: str):
        def job() -> None:
            df = getattr(m, name).withColumn("year", F.year(date_col))
            # rebalance (not repartition) by year: rows of a year are clustered
            # so each task writes few files, and AQE splits a big year into
            # advisory-sized tasks instead of one task per year
            (df.hint("rebalance", "year").write.mode("errorifexists").partitionBy("year")
               .parquet(f"{out}/{name}"))
        return job

    _parallel([dim_job(n) for n in DIMENSIONS] + [fact_job(n, c) for n, c in FACTS.items()], workers)
    return out


class StoredCorporate:
    """Read side of the written corporate layer, shaped like ``Corporate``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def __getattr__(self, name: str) -> DataFrame:
        if name == "sales_items":
            return self.sales_lines            # the stored lines carry the address; pruning skips it
        if name == "employee_addresses":
            return self.address_inputs.filter(F.col("address_id").startswith("EMP-"))
        if name in CORPORATE:
            return self.spark.read.parquet(f"{self.path}/{name}")
        raise AttributeError(name)


class StoredMarts:
    """Read side of a written warehouse, shaped like ``Marts``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _t(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}")

    @cached_property
    def dim_time(self) -> DataFrame:
        return calendar_dim(self.spark)

    def __getattr__(self, name: str) -> DataFrame:
        if name in DIMENSIONS or name in FACTS:
            return self._t(name)      # facts keep their ``year`` partition column
        raise AttributeError(name)
