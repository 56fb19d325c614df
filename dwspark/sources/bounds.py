"""The sources with transactions beyond some ids only, as literals that reach
both scans; and the sources as they were earlier, for loads that follow one another."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.rules import MONEY
from .binding import SourceTables


class BoundedSources(SourceTables):
    """Orders and lines with a key beyond the bound of their source, and up to ``upto``."""

    def __init__(self, spark: SparkSession, sf_dir: str, bounds: dict[str, int] | None = None, upto: int | None = None):
        self.bounds, self.upto = bounds or {}, upto
        super().__init__(spark, sf_dir, order_filter=self._beyond)

    def _within(self, key: Column) -> Column:
        """One condition on the key alone, for the scan."""
        found = F.lit(True)
        if self.bounds:
            found = key > min(self.bounds.values())
        return found if self.upto is None else found & (key <= self.upto)

    def _beyond(self, orders: DataFrame) -> DataFrame:
        key = F.col("o_orderkey")
        orders = orders.filter(self._within(key))
        if not self.bounds:
            return orders
        by_source = F.lit(False)
        for source, bound in self.bounds.items():
            by_source = by_source | ((F.col("source_system") == source) & (key > bound))
        return orders.filter(by_source)

    @cached_property
    def lines(self) -> DataFrame:
        return SourceTables.lines.func(self).filter(self._within(F.col("l_orderkey")))


# Parameters of the scenario: which rows an earlier state lacked or had otherwise.
NEW_EVERY, OLD_NAME, OLD_TITLE, OLD_PRICE, OLD_PHONE, OLD_POST = 13, 5, 3, 7, 4, 6
OLDER = " (before)"


class EarlierSources(BoundedSources):
    """The sources at an earlier time, derived from the supplied ones: rows whose key is a
    multiple of NEW_EVERY did not exist yet, and each so many had another value. ``age`` 1 is
    the time of the first load; at age 2 half as many rows were missing or different; at 0 none."""

    def __init__(self, spark: SparkSession, sf_dir: str, bounds: dict[str, int] | None = None, upto: int | None = None, age: int = 1):
        self.age = age
        super().__init__(spark, sf_dir, bounds, upto)

    def _older(self, df: DataFrame, key: str, every: int, changes: dict) -> DataFrame:
        if not self.age:
            return df
        n = F.col(key).try_cast("bigint")
        return (df.filter(n % (NEW_EVERY * self.age) != 0)
                .withColumns({c: F.when(n % (every * self.age) == 0, old).otherwise(F.col(c)) for c, old in changes.items()}))

    @cached_property
    def wholesale_customers(self) -> DataFrame:
        return self._older(SourceTables.wholesale_customers.func(self), "customer_id", OLD_NAME, {"company_name": _was("company_name")})

    @cached_property
    def retail_persons(self) -> DataFrame:
        return self._older(SourceTables.retail_persons.func(self), "person_id", OLD_NAME, {"profession": _was("profession")})

    @cached_property
    def wholesale_employees(self) -> DataFrame:
        return self._older(SourceTables.wholesale_employees.func(self), "employee_id", OLD_TITLE, {"title": _was("title")})

    @cached_property
    def products(self) -> DataFrame:
        return self._older(SourceTables.products.func(self), "product_id", OLD_PRICE, {"price": (F.col("price") + 1).cast(MONEY)})

    @cached_property
    def retail_suppliers(self) -> DataFrame:
        return self._older(SourceTables.retail_suppliers.func(self), "supplier_id", OLD_PHONE, {"number": F.lit("0")})

    @cached_property
    def retail_addresses(self) -> DataFrame:
        return self._older(SourceTables.retail_addresses.func(self), "person_id", OLD_POST, {"postal_code": F.lit("0")})

    @cached_property
    def wholesale_carriers(self) -> DataFrame:
        """Those of the orders of the time; at age 1 with another phone each."""
        found = self.t("orders", "o_orderkey", "o_orderpriority")
        if self.upto is not None:
            found = found.filter(F.col("o_orderkey") <= self.upto)
        found = found.select(F.substring_index("o_orderpriority", "-", 1).alias("carrier_id")).distinct()
        now = SourceTables.wholesale_carriers.func(self).join(found, "carrier_id", "left_semi")
        return now.withColumn("phone", _was("phone")) if self.age == 1 else now


def _was(c: str) -> Column:
    return F.concat(F.col(c), F.lit(OLDER))
