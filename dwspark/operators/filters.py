"""Optional dashboard filters.

A filter that is not set disappears, exactly like an optional clause of a
parameterized SQL card; date bounds are inclusive. Each query names the
filters it accepts -- a comparison *by* carrier ignores the carrier filter.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PERIOD = ("date_from", "date_to")


@dataclass(frozen=True)
class MartFilters:
    date_from: date | str | None = None
    date_to: date | str | None = None
    source_system: str | None = None
    carrier: str | None = None
    supplier: str | None = None

    def is_set(self, name: str) -> bool:
        return getattr(self, name) is not None

    def period(self, df: DataFrame, date_col: str, allowed=PERIOD) -> DataFrame:
        """Date bounds go straight onto the fact's date column so they are
        pushed to the scan before any join; on a year-partitioned fact the
        implied year bounds prune whole partitions."""
        partitioned = "year" in df.columns    # stored facts are partitioned by year
        if "date_from" in allowed and self.date_from is not None:
            lo = F.to_date(F.lit(str(self.date_from)))
            df = df.filter(F.col(date_col) >= lo)
            if partitioned:   # implied bound on the partition column: whole years are pruned
                df = df.filter(F.col("year") >= F.year(lo))
        if "date_to" in allowed and self.date_to is not None:
            hi = F.to_date(F.lit(str(self.date_to)))
            df = df.filter(F.col(date_col) <= hi)
            if partitioned:
                df = df.filter(F.col("year") <= F.year(hi))
        return df

    def equals(self, df: DataFrame, name: str, col: str) -> DataFrame:
        value = getattr(self, name)
        return df if value is None else df.filter(F.col(col) == F.lit(value))


NO_FILTERS = MartFilters()
