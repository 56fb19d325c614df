"""Registered queries that run single rules over the given tables: age bands
from dates (N3), calendar names and years (N7, N10), and change detection that
tells neither types nor nulls apart (U8, N18)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions.calendar import time_key
from ..operators.scd import scd1_upsert
from ..oracle.binding import with_binding
from ..sources.readers import sf_table
from .marts import Marts

AS_OF = "2040-01-01"


def employee_bands_from_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """N3 over a date: whole years since the hire date, in the age bands."""
    e = Marts(spark, sf_dir).corp.employees
    band = R.age_band_from_date(F.col("hire_date"), F.to_date(F.lit(AS_OF)))
    return e.select(band.alias("band")).groupBy("band").agg(F.count("*").alias("employees"))


def orders_by_calendar_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by year, name of the month and of the weekday."""
    m = Marts(spark, sf_dir)
    names = F.broadcast(m.dim_time.select("time_key", "month_name", "weekday", "is_weekend"))       # one row per day
    return (m.src.orders.select(time_key(F.col("order_date")).alias("time_key"), F.year("order_date").alias("year"))
            .join(names, "time_key", "left")
            .groupBy("year", "month_name", "weekday", "is_weekend").agg(F.count("*").alias("orders")))


def price_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices against the same prices as wider decimals from text. Each 9th is a cent higher, each
    10th is null in both; only the former are changes."""
    p = sf_table(spark, sf_dir, "part", ["p_partkey", "p_retailprice"])
    k = F.col("p_partkey")
    price = F.when(k % 10 != 0, F.col("p_retailprice").cast(R.MONEY))
    state = p.select(k.alias("id"), price.alias("price"))
    cent = F.when(k % 9 == 0, F.lit("0.01")).otherwise(F.lit("0")).cast("decimal(6,4)")
    batch = p.select(k.alias("id"), (price.cast("string").cast("decimal(20,4)") + cent).alias("price"))
    return scd1_upsert(state, batch, ["id"], ["price"]).groupBy("change").agg(F.count("*").alias("parts"), F.sum("price").alias("total"))


def queries() -> dict:
    return {f.__name__: f for f in (employee_bands_from_date, orders_by_calendar_names, price_changes)}


def oracle_sql() -> dict:
    years = f"floor((DATE '{AS_OF}' - hire_date) / 365)"
    return {
        "employee_bands_from_date": with_binding(f"""
            SELECT CASE WHEN y <= 25 THEN '18-25' WHEN y <= 35 THEN '26-35' WHEN y <= 45 THEN '36-45' WHEN y <= 60 THEN '46-60'
                        WHEN y > 60 THEN '60+' END AS band, count(*) AS employees
            FROM (SELECT {years} AS y FROM ws_employees) GROUP BY 1"""),
        "orders_by_calendar_names": """
            SELECT CAST(year(d) AS INTEGER) AS year, monthname(d) AS month_name, dayname(d) AS weekday,
                   isodow(d) IN (6, 7) AS is_weekend, count(*) AS orders
            FROM (SELECT CAST(o_orderdate AS DATE) AS d FROM orders) GROUP BY ALL""",
        "price_changes": """
            SELECT CASE WHEN p_partkey % 9 = 0 AND p_partkey % 10 <> 0 THEN 'update' ELSE 'unchanged' END AS change,
                   count(*) AS parts, sum(CASE WHEN p_partkey % 10 <> 0 THEN CAST(p_retailprice AS DECIMAL(15,2))
                                               + CASE WHEN p_partkey % 9 = 0 THEN 0.01 ELSE 0 END END) AS total
            FROM part GROUP BY 1""",
    }
