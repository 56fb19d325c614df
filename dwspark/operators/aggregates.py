"""Report-shaped aggregations: top-k, quarter crosstab, cube."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def top_k(df: DataFrame, measure: str, tie_break: str, k: int = 10) -> DataFrame:
    """ORDER BY measure DESC LIMIT k, with a name tie-break so the cut is
    deterministic (C9). Spark plans this as TakeOrderedAndProject: each
    partition keeps its k best, only k rows per partition move."""
    return df.orderBy(F.col(measure).desc(), F.col(tie_break).asc()).limit(k)


def quarter_crosstab(df: DataFrame, row: str, quarter: str, measure: str,
                     label: str, total: str = "total") -> DataFrame:
    """One row per ``row`` value with T1..T4 and a total, in one hash
    aggregate (conditional aggregation; no pivot value discovery job)."""
    aggs = [F.sum(F.when(F.col(quarter) == q, F.col(measure))).alias(f"T{q}") for q in (1, 2, 3, 4)]
    return df.groupBy(F.col(row).alias(label)).agg(*aggs, F.sum(measure).alias(total))


def cube_totals(df: DataFrame, dims: list[str], measure: str, out: str) -> DataFrame:
    """GROUPING SETS over all subsets of ``dims`` with ``grouping_id``."""
    return df.cube(*dims).agg(F.sum(measure).alias(out), F.grouping_id().alias("grouping_id"))


def ratio(num: Column, den: Column, scale: int) -> Column:
    """num / den rounded half up to ``scale`` digits, exact in decimals; null for a den of 0.

    The division's own digits (at least six behind the point) are more than the digits kept; an exact half
    of the last digit kept needs one more only, so rounding twice changes nothing for the scales used here."""
    n, d = num.cast("decimal(28,2)"), F.nullif(den.cast("decimal(18,0)"), F.lit(0).cast("decimal(18,0)"))
    return F.round(n / d, scale)
