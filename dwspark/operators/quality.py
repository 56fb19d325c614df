"""Data-quality checks as ordinary Spark jobs (the reference's declared
constraints, DQ1-DQ7). Each returns a small report DataFrame; none
collects data to the driver.

Shape of every report: one row per (table, check/column) with the number
of violating rows, so reports of different tables union cleanly.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _report(table: str, check: str, violations: Column) -> list[Column]:
    return [F.lit(table).alias("table_name"), F.lit(check).alias("check_name"),
            F.coalesce(violations, F.lit(0)).cast("bigint").alias("violations")]


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def dq_unique(df: DataFrame, table: str, key: list[str], check: str | None = None) -> DataFrame:
    """DQ1: rows whose key occurs more than once (partial counts per key,
    then a sum -- a hot key is combined map-side)."""
    per_key = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(*_report(table, check or f"unique({','.join(key)})",
                                F.sum(F.when(F.col("n") > 1, F.col("n")))))


def dq_foreign_key(fact: DataFrame, fact_table: str, fk: str, dim: DataFrame, dim_key: str) -> DataFrame:
    """DQ2/J14: fact rows whose key has no dimension row. The fact is first
    reduced to (key, rows) so the anti join moves one row per key."""
    per_key = fact.groupBy(F.col(fk).alias("__k")).agg(F.count(F.lit(1)).alias("n"))
    orphans = per_key.join(dim.select(F.col(dim_key).alias("__k")).distinct(), "__k", "left_anti")
    return orphans.agg(*_report(fact_table, f"fk({fk})", F.sum("n")))


def dq_foreign_keys(fact: DataFrame, fact_table: str, fks: list[tuple[str, DataFrame, str]]) -> DataFrame:
    """DQ2 for all foreign keys of one fact in one pass over the fact: the
    (fk name, key) pairs are counted once, then anti-joined with the union
    of the dimensions' keys tagged with the same fk name."""
    pairs = F.explode(F.array(*[F.struct(F.lit(fk).alias("fk"), F.col(fk).cast("bigint").alias("k"))
                                for fk, _, _ in fks])).alias("p")
    counted = (fact.select(pairs).select("p.fk", "p.k").groupBy("fk", "k")
                   .agg(F.count(F.lit(1)).alias("n")))
    dims = reduce(lambda a, b: a.unionByName(b),
                  [d.select(F.lit(fk).alias("fk"), F.col(dk).cast("bigint").alias("k")).distinct()
                   for fk, d, dk in fks])
    orphans = counted.join(dims, ["fk", "k"], "left_anti").groupBy("fk").agg(F.sum("n").alias("n"))
    every = fact.sparkSession.createDataFrame([(fk,) for fk, _, _ in fks], "fk string")
    return (every.join(orphans, "fk", "left")
                 .select(F.lit(fact_table).alias("table_name"),
                         F.concat(F.lit("fk("), F.col("fk"), F.lit(")")).alias("check_name"),
                         F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("violations")))


def dq_not_null(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """DQ3: NULL count of every NOT NULL column, in one pass."""
    counts = df.agg(*[F.sum(F.when(F.col(c).isNull(), 1).otherwise(0)).alias(c) for c in columns])
    stack = ", ".join(f"'{c}', `{c}`" for c in columns)
    return counts.select(F.lit(table).alias("table_name"),
                         F.expr(f"stack({len(columns)}, {stack}) AS (col, v)")) \
                 .select("table_name", F.concat(F.lit("not_null("), F.col("col"), F.lit(")")).alias("check_name"),
                         F.coalesce(F.col("v"), F.lit(0)).cast("bigint").alias("violations"))


def dq_check(df: DataFrame, table: str, checks: dict[str, Column]) -> DataFrame:
    """DQ4: CHECK predicates; a row violates when the predicate is FALSE
    (NULL passes, as in SQL)."""
    aggs = [F.sum(F.when(~pred, 1).otherwise(0)).alias(name) for name, pred in checks.items()]
    counts = df.agg(*aggs)
    return _union([counts.select(*_report(table, name, F.col(name))) for name in checks])


def dq_length(df: DataFrame, table: str, limits: dict[str, int]) -> DataFrame:
    """DQ5: values longer than the column's declared length."""
    counts = df.agg(*[F.sum(F.when(F.length(c) > n, 1).otherwise(0)).alias(c) for c, n in limits.items()])
    return _union([counts.select(*_report(table, f"length({c})<={n}", F.col(c))) for c, n in limits.items()])


def dq_out_of_calendar(df: DataFrame, table: str, date_col: str, start: str, end: str) -> DataFrame:
    """DQ6: non-NULL dates the calendar does not cover (the reference raises
    on them; here they are counted, and ``out_of_calendar_rows`` returns
    them for quarantine)."""
    d = F.col(date_col)
    bad = d.isNotNull() & ((d < F.to_date(F.lit(start))) | (d > F.to_date(F.lit(end))))
    return df.agg(*_report(table, f"in_calendar({date_col})", F.sum(F.when(bad, 1).otherwise(0))))


def out_of_calendar_rows(df: DataFrame, date_col: str, start: str, end: str) -> DataFrame:
    d = F.col(date_col)
    return df.filter(d.isNotNull() & ((d < F.to_date(F.lit(start))) | (d > F.to_date(F.lit(end)))))


def dq_scd2(state: DataFrame, table: str, keys: list[str]) -> DataFrame:
    """DQ7: type-2 invariants -- exactly one current version per key, no
    overlapping versions, no interval ending before it starts, the current
    version is the open one. The window runs per key over its versions,
    which are bounded by the days spanned."""
    w = Window.partitionBy(*keys).orderBy("valid_from")
    s = state.withColumn("__prev_to", F.lag("valid_to").over(w)) \
             .withColumn("__prev_open", F.lag(F.col("valid_to").isNull()).over(w))
    per_key = state.groupBy(*keys).agg(F.sum(F.col("is_current").cast("int")).alias("c"))
    cur = per_key.agg(*_report(table, "one_current_per_key", F.sum(F.when(F.col("c") != 1, 1).otherwise(0))))
    checks = s.agg(
        F.sum(F.when(F.col("__prev_open") | (F.col("__prev_to") >= F.col("valid_from")), 1).otherwise(0)).alias("o"),
        F.sum(F.when(F.col("valid_to") < F.col("valid_from"), 1).otherwise(0)).alias("i"),
        F.sum(F.when(F.col("is_current") != F.col("valid_to").isNull(), 1).otherwise(0)).alias("f"))
    return _union([cur,
                   checks.select(*_report(table, "no_overlap", F.col("o"))),
                   checks.select(*_report(table, "valid_to>=valid_from", F.col("i"))),
                   checks.select(*_report(table, "current_is_open", F.col("f")))])
