"""Calendar (time) dimension generated inside Spark.

One row per day; the key is the smart integer yyyymmdd, so any date maps
to its key by arithmetic and the dimension's size is fixed by its span
(16,071 days for 1992-2035), which is what makes broadcasting it safe.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# One span for facts, cards and the out-of-calendar check. A date outside it stays in the facts
# (its calendar columns are null in the cards) and is reported by the check.
CALENDAR_START = "1992-01-01"
CALENDAR_END = "2035-12-31"


def time_key(d: Column) -> Column:
    """The date as a number, yyyymmdd."""
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def calendar_dim(spark: SparkSession, start: str = CALENDAR_START,
                 end: str = CALENDAR_END) -> DataFrame:
    days = spark.range(1).select(
        F.explode(F.sequence(F.to_date(F.lit(start)), F.to_date(F.lit(end)),
                             F.expr("INTERVAL 1 DAY"))).alias("date"))
    return days.select(
        time_key(F.col("date")).alias("time_key"),
        "date",
        F.dayofmonth("date").alias("day"),
        F.month("date").alias("month"),
        F.date_format("date", "MMMM").alias("month_name"),
        F.quarter("date").alias("quarter"),
        F.year("date").alias("year"),
        F.date_format("date", "EEEE").alias("weekday"),
        F.expr("extract(DAYOFWEEK_ISO FROM date) IN (6, 7)").alias("is_weekend"),
    )
