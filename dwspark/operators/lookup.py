"""Set-based lookup resolution (the reference's get-or-create and dict maps).

* ``resolve_lookup``   -- get-or-create by name: names absent from the
  existing table get a key and are appended (U1).
* ``first_wins``       -- one row per key, the value of the smallest order
  column wins (deterministic replacement for first-writer-wins, U2/U3).
* ``attach_key``       -- left join to a dimension on its natural key,
  with an optional default for misses (J7/J8).
* ``attach_time_key``  -- date -> calendar key; NULL date -> NULL (J16).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import time_key
from ..functions.keys import surrogate_key


def resolve_lookup(existing: DataFrame | None, names: DataFrame, name_col: str = "name",
                   key_col: str = "key") -> DataFrame:
    """Return ``existing`` plus one new row per unseen non-NULL name."""
    wanted = names.select(F.col(name_col).alias("name")).filter(F.col("name").isNotNull()).distinct()
    if existing is None:
        new = wanted
        return new.select(surrogate_key(F.col("name")).alias(key_col), F.col("name").alias(name_col))
    new = wanted.join(existing.select(F.col(name_col).alias("name")), "name", "left_anti")
    added = new.select(surrogate_key(F.col("name")).alias(key_col), F.col("name").alias(name_col))
    return existing.select(key_col, name_col).unionByName(added)


def first_wins(df: DataFrame, keys: list[str], values: list[str], order: Column) -> DataFrame:
    """One row per ``keys``; every value column taken from the row with the
    smallest ``order`` (ties are the caller's problem: make ``order`` unique).
    ``min_by`` is a partial aggregate, so a hot key is combined map-side."""
    ordered = df.withColumn("__order", order)
    aggs = [F.min_by(F.col(v), F.col("__order")).alias(v) for v in values]
    return ordered.groupBy(*keys).agg(*aggs)


def attach_key(fact: DataFrame, dim: DataFrame, on: list[tuple[str, str]], key_col: str,
               out_col: str, default: int | None = None) -> DataFrame:
    """Left join ``fact`` to ``dim`` on (fact column, dim column) pairs and
    add ``out_col`` = the dimension key (``default`` where nothing matched).
    Whether the dimension is broadcast is left to Spark's size check."""
    d = dim.select(*[F.col(dc).alias(f"__k{i}") for i, (_, dc) in enumerate(on)],
                   F.col(key_col).alias("__key"))
    cond = [fact[fc] == d[f"__k{i}"] for i, (fc, _) in enumerate(on)]
    j = fact.join(d, cond, "left")
    key = F.col("__key") if default is None else F.coalesce(F.col("__key"), F.lit(default).cast("bigint"))
    return j.withColumn(out_col, key).drop("__key", *[f"__k{i}" for i in range(len(on))])


def attach_time_key(df: DataFrame, date_col: str, out_col: str) -> DataFrame:
    """Calendar key of a date; a NULL date gives a NULL key. Dates outside
    the calendar are reported by ``quality.dq_out_of_calendar``."""
    return df.withColumn(out_col, F.when(F.col(date_col).isNotNull(), time_key(F.col(date_col))))
