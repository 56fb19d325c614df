"""A stateful load: an initial load writes the corporate layer, an incremental
load reads it back, takes what the sources hold beyond it, and writes the next
state (E1, E2).

The incremental step: watermarks from the stored transactions; a delta bounded
by them in both scans and staged once; the keys that the delta touches, for all
six entities; a keyed re-read of these; a type-2 merge of customers, employees and
products, a type-1 upsert of addresses, carriers and suppliers; transactions
appended with the versions that are current at load; and facts made of the
corporate rows that the fact does not hold yet, so rows whose mart step failed
are taken by the next run.

The supplied tables are one state of the sources. The state before it, which
the initial load sees, is derived from them (``EarlierSources``): some rows did not
exist yet and some had other values.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import time_key
from ..functions.keys import surrogate_key
from ..functions.rules import UNKNOWN_KEY
from ..operators import scd
from ..operators.sinks import fresh_items, stage
from ..sources.binding import SRC_RETAIL, SRC_WHOLESALE
from ..sources.bounds import BoundedSources, EarlierSources
from ..sources.readers import sf_table
from .corporate import Corporate

# Parameters of the scenario: the days of the two loads.
INITIAL_DAY, DELTA_DAY = "2001-03-01", "2001-04-01"
SALE = ["source_system", "sale_id"]


VERSIONED = {  # entity -> (corporate table, keys)
    "customer": ("customers", ["source_system", "customer_id"]),
    "employee": ("employees", ["source_system", "employee_id"]),
    "product": ("products", ["source_system", "product_id"]),
}
REPLACED = {
    "address": ("addresses", ["source_system", "address_id"]),
    "carrier": ("carriers", ["source_system", "carrier_id"]),
    "supplier": ("suppliers", ["source_system", "supplier_id"]),
}


def _merge(state: DataFrame | None, batch: DataFrame, keys: list[str], day: str) -> DataFrame:
    attrs = [c for c in batch.columns if c not in keys]
    if state is None:
        state = scd.versions_from_daily(batch.withColumn("valid_from", F.to_date(F.lit(day))).filter("false"), keys, attrs)
    return scd.scd2_merge(state, batch, keys, attrs, day)


def touched_keys(now: Corporate, entity: str) -> DataFrame:
    """Keys that the delta, the transactions of ``now``, mentions (P6, P7: not null, distinct)."""
    sales = now.sales_items
    bought = now.purchase_lines.select(F.lit(SRC_RETAIL).alias("source_system"), "product_id",
                                       F.col("l_suppkey").cast("string").alias("supplier_id"))
    if entity == "product":
        found = sales.select("source_system", "product_id").union(bought.select("source_system", "product_id"))
    elif entity == "supplier":
        found = bought.select("source_system", "supplier_id")
    elif entity == "address":                         # of touched customers, employees and suppliers
        own = (now.customers.join(touched_keys(now, "customer"), ["source_system", "customer_id"], "left_semi")
               .select("source_system", "address_id"))
        staff = touched_keys(now, "employee").select("source_system", F.concat(F.lit("EMP-"), "employee_id"))
        shops = touched_keys(now, "supplier").select("source_system", F.concat(F.lit("SUP-"), "supplier_id"))
        found = own.union(staff).union(shops)
    else:
        found = sales.select("source_system", f"{entity}_id")
    return found.dropna().distinct()


def _with_version(rows: DataFrame, current: DataFrame, entity: str) -> DataFrame:
    """The version current at load, -1 if the entity is unknown. The rows without an id, such as
    all retail sales for employees, don't take part in the join: they would all meet in one task."""
    name, keys = f"{entity}_version_key", VERSIONED[entity][1]
    unknown, no_id = F.lit(UNKNOWN_KEY).cast("bigint"), F.col(keys[1]).isNull()
    met = rows.filter(~no_id).join(current, keys, "left").withColumn(name, F.coalesce(name, unknown))
    return met.unionByName(rows.filter(no_id).withColumn(name, unknown))


def versioned_items(now: Corporate, headers: DataFrame, current: dict[str, DataFrame]) -> DataFrame:
    """Sale items with the versions current at load; ``current``: (keys, version key) by entity.

    Customers and employees join the headers, a row per sale, and products the lines as the source has them; headers and lines
    meet last. So no joined row is dealt anew, and the items of a sale lie together, which keeps what is written small.
    A key has one current version, as in every type-2 state."""
    for entity in ("employee", "customer"):
        headers = _with_version(headers, current[entity], entity)
    keys = current["product"].groupBy(F.col("product_id").alias("__product")).agg(
        *[F.max(F.when(F.col("source_system") == s, F.col("product_version_key"))).alias(f"__{s}") for s in (SRC_WHOLESALE, SRC_RETAIL)])
    lines = now.src.lines
    lines = lines.join(keys, lines["l_partkey"].cast("string") == keys["__product"], "left")
    of_source = F.when(F.col("source_system") == SRC_WHOLESALE, F.col(f"__{SRC_WHOLESALE}")).otherwise(F.col(f"__{SRC_RETAIL}"))
    return (now._sale_items(headers, lines)
            .withColumn("product_version_key", F.coalesce(of_source, F.lit(UNKNOWN_KEY).cast("bigint")))
            .drop("__product", f"__{SRC_WHOLESALE}", f"__{SRC_RETAIL}"))


def current_versions(state: DataFrame, entity: str) -> DataFrame:
    return state.filter("is_current").select(*VERSIONED[entity][1], F.col("version_key").alias(f"{entity}_version_key"))


#: What ``touched_keys`` reads of sale items.
TOUCHED = ["source_system", "customer_id", "employee_id", "carrier_id", "product_id"]


class StatefulLoad:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        orders = sf_table(spark, sf_dir, "orders", ["o_orderkey"])
        self.cut = (orders.agg(F.max("o_orderkey")).first()[0] or 0) // 2      # up to here the initial load

    # -- initial load -----------------------------------------------------------
    @cached_property
    def earlier(self) -> Corporate:
        return Corporate(EarlierSources(self.spark, self.sf_dir, upto=self.cut))

    def initial(self, entity: str) -> DataFrame:
        """The stored state of an entity after the initial load."""
        name = f"_initial_{entity}"
        if name not in self.__dict__:
            if entity in VERSIONED:
                table, keys = VERSIONED[entity]
                df = _merge(None, getattr(self.earlier, table), keys, INITIAL_DAY)
            else:
                df = getattr(self.earlier, REPLACED[entity][0])
            self.__dict__[name] = stage(df, f"initial-{entity}")
        return self.__dict__[name]

    @cached_property
    def initial_sales(self) -> DataFrame:
        src = self.earlier.src
        return stage(self._versioned(self.earlier, src.header_attributes(src.orders), self.initial), "initial-sales")

    @cached_property
    def initial_purchases(self) -> DataFrame:
        return stage(self.earlier.purchase_lines, "initial-purchases")

    # -- delta ----------------------------------------------------------------------
    @cached_property
    def bounds(self) -> dict[str, int]:
        """The largest stored sale id of each source, 0 where nothing is stored: one row per source."""
        stored = self.initial_sales.groupBy("source_system").agg(F.max(F.col("sale_id").try_cast("bigint")).alias("top"))
        return {SRC_WHOLESALE: 0, SRC_RETAIL: 0} | {r.source_system: r.top or 0 for r in stored.collect()}

    @cached_property
    def now(self) -> Corporate:
        """The sources now; the delta of the transactions is staged once and read by all that follows."""
        corp = Corporate(BoundedSources(self.spark, self.sf_dir, self.bounds))
        self.headers = stage(corp.src.header_attributes(corp.src.orders), "delta-headers")
        corp.src.__dict__["lines"] = stage(corp.src.lines, "delta-lines")
        corp.__dict__["sales_items"] = stage(corp._sale_items(self.headers).select(*TOUCHED, "o_orderkey"), "delta-sales")
        corp.__dict__["purchase_lines"] = stage(corp.purchase_lines, "delta-purchases")
        return corp

    def touched(self, entity: str) -> DataFrame:
        return touched_keys(self.now, entity)

    def reread(self, entity: str) -> DataFrame:
        """The touched rows of an entity as the source has them now."""
        table, keys = (VERSIONED | REPLACED)[entity]
        return getattr(self.now, table).join(self.touched(entity), keys, "left_semi")

    # -- next state --------------------------------------------------------------------
    def history(self, entity: str) -> DataFrame:
        """Type-2 state after the incremental load."""
        name = f"_history_{entity}"
        if name not in self.__dict__:
            keys = VERSIONED[entity][1]
            self.__dict__[name] = stage(_merge(self.initial(entity), self.reread(entity), keys, DELTA_DAY), f"history-{entity}")
        return self.__dict__[name]

    def upserted(self, entity: str) -> DataFrame:
        """Type-1 state after the incremental load, with what happened to each row."""
        keys = REPLACED[entity][1]
        state = self.initial(entity)
        return scd.scd1_upsert(state, self.reread(entity), keys, [c for c in state.columns if c not in keys])

    @staticmethod
    def _versioned(corp: Corporate, headers: DataFrame, state) -> DataFrame:
        items = versioned_items(corp, headers, {e: current_versions(state(e), e) for e in VERSIONED})
        return items.drop("l_orderkey", "l_partkey", "l_suppkey", "l_returnflag", "discount_rate")      # the source's names of what items hold

    @cached_property
    def fresh_sales(self) -> DataFrame:
        """Items of the delta's sales that are not stored yet."""
        now = self.now
        return fresh_items(self.initial_sales, self._versioned(now, self.headers, self.history), SALE, "o_orderkey", now.sales_items)

    @cached_property
    def sales(self) -> DataFrame:
        """Stored sale items after the append: the items of sales that are not stored yet are added.
        A sale comes with all its items, which the sources don't number uniquely."""
        return (self.initial_sales.withColumn("load", F.lit("initial"))
                .unionByName(self.fresh_sales.withColumn("load", F.lit("delta"))))

    def corporate_append(self) -> DataFrame:
        """Headers of the stored sales with the load that brought them."""
        return (self.sales.groupBy("source_system", "sale_id", "customer_id", "customer_version_key", "load")
                .agg(F.count("*").alias("items"), F.sum("item_total").cast("decimal(38,2)").alias("value")))

    def fact_sales_versioned(self) -> DataFrame:
        """The mart's fact: the initial load's rows, and the items of every stored sale it does not hold yet (C16). It was made
        of all that the initial load stored, so of the stored sales only those appended since are looked up in it."""
        loaded = self.initial_sales
        rows = loaded.unionByName(fresh_items(loaded, self.fresh_sales, SALE, "o_orderkey", self.now.sales_items))
        return rows.select("source_system", "sale_id", F.col("l_linenumber").alias("line"),
                           time_key(F.col("order_date")).alias("time_key"),
                           surrogate_key("source_system", "customer_id").alias("customer_key"), "customer_version_key",
                           "product_version_key", "employee_version_key", "quantity", "item_total")

    def dim_incremental(self, entity: str) -> DataFrame:
        """A dimension's current rows after the load, and whether the load changed them."""
        if entity in REPLACED:
            return self.upserted(entity)
        table, keys = VERSIONED[entity]
        before = self.initial(entity).filter("is_current").select(*keys, F.col("version_key").alias("was"))
        now = self.history(entity).filter("is_current").drop("valid_to", "is_current", "entity_key")
        change = (F.when(F.col("was").isNull(), "insert").when(F.col("was") != F.col("version_key"), "update").otherwise("unchanged"))
        return now.join(before, keys, "left").withColumn("change", change).drop("was", "version_key")


def _q(make):
    return lambda spark, sf_dir: make(StatefulLoad(spark, sf_dir))


def queries() -> dict:
    return ({f"{e}_history": _q(lambda x, e=e: x.history(e)) for e in VERSIONED}
            | {f"dim_{e}_incremental": _q(lambda x, e=e: x.dim_incremental(e)) for e in [*VERSIONED, *REPLACED]}
            | {"corporate_append": _q(StatefulLoad.corporate_append), "fact_sales_versioned": _q(StatefulLoad.fact_sales_versioned)})


def oracle_sql() -> dict:
    from ..oracle import stateful
    return stateful.oracle_sql()
