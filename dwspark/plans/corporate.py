"""Corporate (normalized, history-preserving) layer built from both sources.

Each property is a lazy DataFrame. Row loops of the reference become:
conformed projections + ``unionByName`` (P1), set-based geography
resolution with deterministic first-wins (U1-U5), one-per-key picks as
partial aggregates (P3/P4), and header x item joins (J2, U13).
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions.keys import surrogate_key
from ..operators.lookup import first_wins
from ..sources.binding import (PURCHASE_RETURN_FLAG, SRC_RETAIL, SRC_WHOLESALE,
                               SourceTables)

# Order in which the reference would meet each address during a full load;
# used to make "first writer wins" deterministic (rule C5).
_RANK_RETAIL, _RANK_WHOLESALE, _RANK_EMPLOYEE, _RANK_SUPPLIER = 0, 1, 2, 3


def _order(rank: int, source_id) -> F.Column:
    """Source first, then numeric ids by number; ids that are no numbers come before them, by text."""
    text = source_id.cast("string")
    return F.struct(F.lit(rank).alias("rank"), text.try_cast("bigint").alias("number"), text.alias("text"))


class Corporate:
    def __init__(self, src: SourceTables):
        self.src = src

    # -- geography ---------------------------------------------------------
    @staticmethod
    def _free_text(df: DataFrame, id_col, addr_type, rank: int, num) -> DataFrame:
        """Conformed addresses of the wholesale source, whose geography is free text."""
        region = F.col("region")
        return df.select(
            F.lit(SRC_WHOLESALE).alias("source_system"),
            id_col.alias("address_id"),
            F.lit(addr_type).cast("string").alias("address_type"),
            F.col("address").alias("street"), F.col("postal_code"),
            F.lit(None).cast("string").alias("district"),
            R.or_default(F.col("country"), R.NOT_INFORMED).alias("country"),
            R.or_default(region, R.NOT_INFORMED).alias("state_name"),
            F.substring(R.or_default(region, R.STATE_CODE_DEFAULT), 1, 10).alias("state_code"),
            R.or_default(F.col("city"), R.NOT_INFORMED).alias("city"),
            region.alias("city_region"),
            _order(rank, num).alias("geo_order"))

    @cached_property
    def employee_addresses(self) -> DataFrame:
        return self._free_text(self.src.wholesale_employees, F.concat(F.lit("EMP-"), F.col("employee_id")),
                               R.ADDRESS_TYPE_BUSINESS, _RANK_EMPLOYEE, F.col("employee_id"))

    @cached_property
    def address_inputs(self) -> DataFrame:
        """Every address of every source in one conformed shape."""
        s = self.src
        retail = s.retail_addresses.select(
            F.lit(SRC_RETAIL).alias("source_system"),
            F.col("address_id").cast("string").alias("address_id"),
            R.address_type(F.col("address_type_code")).alias("address_type"),
            F.col("street"), F.col("postal_code"), F.col("district"),
            F.lit(R.RETAIL_COUNTRY).alias("country"),
            F.col("state_name"), F.col("state_code"),
            F.col("city"), F.col("city_region"),
            _order(_RANK_RETAIL, F.col("address_id")).alias("geo_order"))

        wholesale = self._free_text(s.wholesale_customers, F.col("customer_id"), None, _RANK_WHOLESALE,
                                    F.col("customer_id"))
        employees = self.employee_addresses
        suppliers = self.supplier_master.select(
            F.lit(SRC_RETAIL).alias("source_system"),
            F.concat(F.lit("SUP-"), F.col("supplier_id").cast("string")).alias("address_id"),
            F.lit(R.ADDRESS_TYPE_BUSINESS).alias("address_type"),
            F.col("street"), F.col("postal_code"), F.col("district"),
            F.lit(R.RETAIL_COUNTRY).alias("country"),
            F.col("state_name"), F.col("state_code"), F.col("city"), F.col("city_region"),
            _order(_RANK_SUPPLIER, F.col("supplier_id")).alias("geo_order"))
        return retail.unionByName(wholesale).unionByName(employees).unionByName(suppliers)

    @cached_property
    def countries(self) -> DataFrame:
        return (self.address_inputs.select(F.col("country").alias("name")).distinct()
                .select(surrogate_key(F.col("name")).alias("country_key"), "name"))

    @cached_property
    def states(self) -> DataFrame:
        """One state per (country, code); the first name met wins."""
        st = first_wins(self.address_inputs, ["country", "state_code"], ["state_name"], F.col("geo_order"))
        return st.select(surrogate_key(F.col("country"), F.col("state_code")).alias("state_key"),
                         surrogate_key(F.col("country")).alias("country_key"),
                         "country", "state_code", "state_name")

    @cached_property
    def cities(self) -> DataFrame:
        """One city per (state, name); the first region met wins."""
        ct = first_wins(self.address_inputs, ["country", "state_code", "city"], ["city_region"],
                        F.col("geo_order"))
        return ct.select(surrogate_key(F.col("country"), F.col("state_code"), F.col("city")).alias("city_key"),
                         surrogate_key(F.col("country"), F.col("state_code")).alias("state_key"),
                         F.col("city").alias("city_name"), "city_region")

    @cached_property
    def addresses(self) -> DataFrame:
        """corporate addresses (SCD1): city resolved by key, no join needed."""
        a = self.address_inputs
        return a.select("source_system", "address_id", "address_type", "street", "postal_code", "district",
                        surrogate_key(F.col("country"), F.col("state_code"), F.col("city")).alias("city_key"))

    # -- people --------------------------------------------------------------
    @cached_property
    def preferred_phone(self) -> DataFrame:
        """Preferred phones only, one per person (smallest phone id)."""
        ph = self.src.retail_phones.filter(F.col("preferred"))
        return (ph.groupBy("person_id")
                  .agg(F.min_by(F.struct("area_code", "type_code", "number"), F.col("phone_id")).alias("p"))
                  .select("person_id", F.col("p.area_code").alias("area_code"),
                          F.col("p.type_code").alias("type_code"), F.col("p.number").alias("number")))

    @cached_property
    def person_address(self) -> DataFrame:
        """One address per person (largest address id, as dict last-wins)."""
        return self.src.retail_addresses.groupBy("person_id").agg(F.max("address_id").alias("address_id"))

    @cached_property
    def customers(self) -> DataFrame:
        """Conformed customers of both sources (the SCD2 attribute set)."""
        s = self.src
        p = s.retail_persons
        retail = (p.join(self.preferred_phone, "person_id", "left")
                   .join(self.person_address, "person_id", "left")
                   .select(F.lit(SRC_RETAIL).alias("source_system"),
                           F.col("person_id").cast("string").alias("customer_id"),
                           F.lit(R.PERSON_TYPE_PERSON).alias("person_type"),
                           F.col("name"), F.col("sex"),
                           R.income_band(F.col("income")).alias("income_band"),
                           F.col("marital_status"), F.col("birth_year"), F.col("profession"),
                           F.col("address_id").cast("string").alias("address_id"),
                           F.col("area_code").cast("string").alias("area_code"),
                           R.phone_type(F.col("type_code")).alias("phone_type")))
        c = s.wholesale_customers
        wholesale = c.select(F.lit(SRC_WHOLESALE).alias("source_system"),
                             F.col("customer_id"),
                             F.lit(R.PERSON_TYPE_COMPANY).alias("person_type"),
                             F.col("company_name").alias("name"),
                             F.lit(None).cast("string").alias("sex"),
                             F.lit(None).cast("string").alias("income_band"),
                             F.lit(None).cast("string").alias("marital_status"),
                             F.lit(None).cast("int").alias("birth_year"),
                             F.lit(None).cast("string").alias("profession"),
                             F.col("customer_id").alias("address_id"),
                             F.lit(None).cast("string").alias("area_code"),
                             F.lit(None).cast("string").alias("phone_type"))
        return retail.unionByName(wholesale)

    @cached_property
    def employees(self) -> DataFrame:
        e = self.src.wholesale_employees
        return e.select(F.lit(SRC_WHOLESALE).alias("source_system"), "employee_id",
                        R.full_name(F.col("first_name"), F.col("last_name")).alias("name"),
                        "hire_date", "title",
                        F.concat(F.lit("EMP-"), F.col("employee_id")).alias("address_id"))

    @cached_property
    def carriers(self) -> DataFrame:
        c = self.src.wholesale_carriers
        return c.select(F.lit(SRC_WHOLESALE).alias("source_system"), "carrier_id",
                        F.col("company_name").alias("name"), "phone")

    @cached_property
    def supplier_master(self) -> DataFrame:
        """Suppliers by role (J13): only those that appear in a purchase."""
        used = self.purchase_lines.select(F.col("l_suppkey").alias("supplier_id"))
        return self.src.retail_suppliers.join(used, "supplier_id", "left_semi")

    @cached_property
    def suppliers(self) -> DataFrame:
        s = self.supplier_master
        return s.select(F.lit(SRC_RETAIL).alias("source_system"),
                        F.col("supplier_id").cast("string").alias("supplier_id"), "name",
                        R.phone_text(F.col("area_code"), F.col("number")).alias("phone"),
                        F.concat(F.lit("SUP-"), F.col("supplier_id").cast("string")).alias("address_id"))

    @cached_property
    def products(self) -> DataFrame:
        p = self.src.products
        return (p.select(F.lit(SRC_RETAIL).alias("source_system"), "product_id", "name", "category", "price",
                         F.lit(R.CURRENCY_RETAIL).alias("currency"))
                 .unionByName(p.select(F.lit(SRC_WHOLESALE).alias("source_system"), "product_id", "name",
                                       "category", "price", F.lit(R.CURRENCY_WHOLESALE).alias("currency"))))

    # -- transactions ----------------------------------------------------------
    @cached_property
    def headers_with_address(self) -> DataFrame:
        """Sale headers with their delivery address (C4): a retail sale is
        delivered to its customer's address -- the person's one address
        (P4, one row per person, so the join cannot fan out); a wholesale
        customer's address id is the customer id itself."""
        h = self.src.header_attributes(self.src.orders)
        wholesale = h.filter(F.col("source_system") == SRC_WHOLESALE).withColumn("address_id", F.col("customer_id"))
        pa = self.person_address.select(F.col("person_id").cast("string").alias("customer_id"),
                                        F.col("address_id").cast("string").alias("address_id"))
        retail = h.filter(F.col("source_system") == SRC_RETAIL).join(pa, "customer_id", "left")
        return retail.unionByName(wholesale)      # only retail orders meet the persons

    @cached_property
    def sales_lines(self) -> DataFrame:
        """J2 with the delivery address, as stored and as ``fact_sales`` reads it."""
        return self._sale_items(self.headers_with_address)

    @cached_property
    def sales_items(self) -> DataFrame:
        """J2 without the address: no person is looked up for cards that never read it."""
        return self._sale_items(self.src.header_attributes(self.src.orders))

    def _sale_items(self, h: DataFrame, lines: DataFrame | None = None) -> DataFrame:
        """Header x item, inner -- headers without items never load.
        Discount is a money amount per item, rounded per item (C1, C6)."""
        li = self.src.lines if lines is None else lines
        ws = F.col("source_system") == SRC_WHOLESALE
        j = li.join(h, li.l_orderkey == h.o_orderkey, "inner")
        disc = F.when(ws, R.money(F.col("quantity") * F.col("unit_price") * F.col("discount_rate"))) \
                .otherwise(F.lit(0).cast(R.MONEY))
        return (j.withColumn("discount_amount", disc)
                 .withColumn("item_total", R.money(F.col("quantity") * F.col("unit_price") - F.col("discount_amount")))
                 .withColumn("item_id", F.when(~ws, F.concat_ws("-", F.col("l_orderkey").cast("string"),
                                                               F.col("l_linenumber").cast("string"))))
                 .withColumn("product_id", F.col("l_partkey").cast("string")))

    @cached_property
    def sale_headers(self) -> DataFrame:
        """One row per loaded sale; shipped date = last line's ship date of a
        wholesale order unless still open. Aggregating lines first keeps a
        huge order a partial aggregate instead of a skewed join."""
        per_order = (self.src.lines.groupBy("l_orderkey")
                     .agg(F.max("ship_date").alias("last_ship_date")))
        h = self.src.header_attributes(self.src.orders)
        j = h.join(per_order, h.o_orderkey == per_order.l_orderkey, "inner")
        shipped = F.when((F.col("source_system") == SRC_WHOLESALE) & (F.col("o_orderstatus") != "O"),
                         F.col("last_ship_date"))
        return j.withColumn("shipped_date", shipped).drop("l_orderkey", "last_ship_date")

    @cached_property
    def purchase_lines(self) -> DataFrame:
        """Retail purchases: returned-flag lines of retail orders; a purchase
        header is (order, supplier)."""
        o = self.src.orders.filter(F.col("source_system") == SRC_RETAIL)
        li = self.src.lines.filter(F.col("l_returnflag") == PURCHASE_RETURN_FLAG)
        j = li.join(o.select("o_orderkey", "order_date", "o_orderstatus"),
                    li.l_orderkey == o.o_orderkey, "inner")
        return (j.withColumn("purchase_id", F.concat_ws("-", F.col("l_orderkey").cast("string"),
                                                       F.col("l_suppkey").cast("string")))
                 .withColumn("product_id", F.col("l_partkey").cast("string"))
                 .withColumn("item_total", R.money(F.col("quantity") * F.col("unit_price"))))

    @cached_property
    def purchase_headers(self) -> DataFrame:
        """One row per purchase; entry date = last ship date unless open;
        lead time = entry - order days (NULL while open)."""
        g = (self.purchase_lines.groupBy("l_orderkey", "l_suppkey", "order_date", "o_orderstatus")
             .agg(F.max("ship_date").alias("last_ship_date")))
        entry = F.when(F.col("o_orderstatus") != "O", F.col("last_ship_date"))
        return (g.withColumn("entry_date", entry)
                 .withColumn("lead_time_days", R.days_between(F.col("entry_date"), F.col("order_date")))
                 .select("l_orderkey", "l_suppkey", "entry_date", "lead_time_days"))
