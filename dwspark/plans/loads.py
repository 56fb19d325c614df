"""A warehouse that lives on: any number of loads, each of which opens what the
one before published (E1, E2).

All tables are folders of one store of published versions. A load

1. takes the watermarks of its two streams (sales by source, purchases) from the last version,
   and the transactions beyond them, bounded in both scans and staged once in a folder of the run;
2. re-reads the entities that these mention, and merges them into the stored state: type-2 customers, employees
   and products, type-1 addresses, carriers and suppliers. State is kept in buckets by key; a load
   reads and writes the buckets of its keys only;
3. appends sale and purchase items with the versions current at load, as new folders;
4. publishes all of it as the next version, in one step;
5. brings the marts up to what is *stored*: the items of stored sales and purchases that the facts don't
   hold, and publishes again. If that step fails or is left out, the next run does it.

The first load finds no state and takes everything; there is no other difference.
A run that fails before a publication leaves the last version as it was.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.calendar import time_key
from ..functions.keys import surrogate_key
from ..functions.rules import UNKNOWN_KEY, days_between, sale_type
from ..operators import scd
from ..operators.sinks import CODEC, fresh_items
from ..operators.staging import StagingRun
from ..operators.versions import Manifest, VersionLog
from ..sources.binding import SRC_RETAIL, SRC_WHOLESALE, SourceTables
from .corporate import Corporate
from .stateful import REPLACED, TOUCHED, VERSIONED, _merge, _with_version, current_versions, touched_keys, versioned_items

ROWS_PER_BUCKET, MOST_BUCKETS = 1_000_000, 4096
ENTITIES = VERSIONED | REPLACED
SALES = ["source_system", "sale_id", "o_orderkey AS sale_no", "order_date", "o_orderstatus", "customer_id", "sale_type_code", "employee_id",
         "carrier_id", "address_id", "due_date", "freight", "l_linenumber AS line", "item_id", "product_id", "quantity", "unit_price",
         "discount_amount", "item_total", "ship_date"]
PURCHASES = [f"'{SRC_RETAIL}' AS source_system", "purchase_id", "l_orderkey AS purchase_no", "CAST(l_suppkey AS STRING) AS supplier_id",
             "order_date", "o_orderstatus", "product_id", "quantity", "unit_price", "item_total", "ship_date"]
STREAMS = {"sales": "sale_no", "purchases": "purchase_no"}
FACTS = {"fact_sales": "sales", "fact_deliveries": "sales", "fact_purchases": "purchases"}
IDENTITY = {"sales": ["source_system", "sale_id"], "purchases": ["source_system", "purchase_id"]}

#: Sources beyond the bounds of a stream: {source system: largest id loaded}, empty for all.
Sources = Callable[[dict[str, int]], SourceTables]


def _together(jobs: list[Callable]) -> list:
    """Run independent jobs at once; raises what the first of them raises."""
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        return [f.result() for f in [pool.submit(j) for j in jobs]]


def _bucket(keys: list[str], n: int) -> F.Column:
    return F.pmod(F.xxhash64(*keys), F.lit(n)).cast("int")


class Warehouse:
    """The store under ``base``."""

    def __init__(self, spark: SparkSession, base: str, rows_per_bucket: int = ROWS_PER_BUCKET):
        self.spark, self.base, self.rows_per_bucket = spark, base.rstrip("/"), rows_per_bucket
        self.log = VersionLog(spark, self.base)

    # -- reading ----------------------------------------------------------------------
    def table(self, name: str, at: Manifest | None = None, parts: list[str] | None = None) -> DataFrame:
        """A stored table, or some parts of it, as of the last version or of ``at``."""
        at = at or self.log.read()
        if parts is None:
            parts = [p for p in at.parts if p.startswith(f"{name}/")]
        schema = StructType.fromJson(at.settings["schemas"][name])
        if not parts:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.base}/{at.parts[p]}" for p in parts])

    # -- one run ------------------------------------------------------------------------
    def run(self, sources: Sources, day: str) -> Manifest:
        """A whole load: corporate layer, then marts."""
        self.load_corporate(sources, day)
        return self.load_marts()

    def load_corporate(self, sources: Sources, day: str) -> Manifest:
        last = self.log.read()
        next_one = _Next(self, last)
        with StagingRun(self.spark, f"{self.base}/staging") as run:
            marks = last.settings.get("watermarks", {})
            now = Corporate(sources(marks.get("sales", {})))
            bought = Corporate(sources(marks.get("purchases", {}))).purchase_lines
            headers, lines, paid = _together([lambda: run.stage(now.headers_with_address, "headers"), lambda: run.stage(now.src.lines, "lines"),
                                              lambda: run.stage(bought, "purchases")])
            now.src.__dict__["lines"] = lines
            now.__dict__ |= {"headers_with_address": headers, "purchase_lines": paid}
            if last.version:                                    # what names the touched entities; the first load takes all
                now.__dict__["sales_items"] = run.stage(now._sale_items(headers).select(*TOUCHED), "sales")

            # entities do not depend on each other, so their jobs share the executors
            states = _together([lambda e=e: self._merge(next_one, e, now, run, day) for e in ENTITIES])
            current = {e: current_versions(s, e) for e, s in zip(ENTITIES, states, strict=True) if e in VERSIONED}

            sales = versioned_items(now, headers, current).selectExpr(*SALES, *[f"{e}_version_key" for e in VERSIONED])
            purchases = _with_version(paid.selectExpr(*PURCHASES), current["product"], "product")
            load = last.settings.get("loads", 0) + 1
            _together([lambda: next_one.append("sales", load, sales), lambda: next_one.append("purchases", load, purchases)])
            next_one.settings |= {"loads": load, "watermarks": self._watermarks(next_one, marks, load)}
            next_one.settings["days"] = [*last.settings.get("days", []), day]
            return next_one.publish()

    def _merge(self, next_one: _Next, entity: str, now: Corporate, run: StagingRun, day: str) -> DataFrame:
        """Merge an entity's rows, all or those of the touched keys, into the buckets of these keys; returns the new state of the buckets."""
        (table, keys), last = ENTITIES[entity], next_one.last
        rows, old = getattr(now, table), None
        sizes = next_one.settings["buckets"]
        if not last.version:
            rows = run.stage(rows, entity)
            sizes[entity] = min(MOST_BUCKETS, 1 << (rows.count() // self.rows_per_bucket).bit_length())
        else:
            touched = run.stage(touched_keys(now, entity).withColumn("bucket", _bucket(keys, sizes[entity])), f"touched-{entity}")
            rows = run.stage(rows.join(touched, keys, "left_semi"), entity)
            found = [r.bucket for r in touched.select("bucket").distinct().collect()]           # as many values as buckets at most
            old = self.table(entity, last, [p for b in found if (p := f"{entity}/{b}") in last.parts])
        if entity in VERSIONED:
            new = _merge(old, rows, keys, day)
        elif old is None:
            new = rows
        else:
            new = scd.scd1_upsert(old, rows, keys, [c for c in rows.columns if c not in keys]).drop("change")
        return next_one.replace(entity, new, _bucket(keys, sizes[entity]))

    def _watermarks(self, next_one: _Next, marks: dict, load: int) -> dict:
        """The largest id loaded, by stream and source; what a load adds can only raise it."""
        out = {}
        for stream, number in STREAMS.items():
            sources = [SRC_WHOLESALE, SRC_RETAIL] if stream == "sales" else [SRC_RETAIL]
            rows = next_one.written(stream, [f"{stream}/{load}"]).groupBy("source_system").agg(F.max(number).alias("top"))
            top = {r.source_system: r.top for r in rows.collect()}                                      # a row per source
            out[stream] = {s: max(marks.get(stream, {}).get(s, 0), top.get(s) or 0) for s in sources}
        return out

    # -- marts ------------------------------------------------------------------------------
    def load_marts(self) -> Manifest:
        """Bring the facts up to the stored corporate rows (C16). Items come from the stored parts that no mart step has
        finished; of these, what a fact holds already is left out, by content, in the id range of the items alone."""
        last = self.log.read()
        next_one = _Next(self, last)
        done = set(last.settings.get("in_marts", []))
        pending = {s: [p for p in last.parts if p.startswith(f"{s}/") and p not in done] for s in STREAMS}
        if not any(pending.values()):
            return last
        load = last.settings["loads"]

        def bring(fact: str, stream: str) -> None:
            items = self.table(stream, last, pending[stream])           # stored already: nothing to stage
            if fact == "fact_deliveries":
                items = items.filter(F.col("source_system") == SRC_WHOLESALE)
            next_one.append(fact, f"{load}-{last.version}", getattr(self, f"_{fact}")(self._not_held(last, fact, items, stream), last))
        _together([lambda f=f, s=s: bring(f, s) for f, s in FACTS.items() if pending[s]])
        next_one.settings["in_marts"] = sorted(done.union(*pending.values()))
        return next_one.publish()

    def _not_held(self, at: Manifest, fact: str, items: DataFrame, stream: str) -> DataFrame:
        if fact not in at.settings["schemas"]:
            return items
        return fresh_items(self.table(fact, at), items, IDENTITY[stream], STREAMS[stream])

    def _carrier_key(self, items: DataFrame, at: Manifest) -> DataFrame:
        known = self.table("carrier", at).select("source_system", "carrier_id", F.lit(True).alias("known"))
        key = F.when(F.col("known"), surrogate_key("source_system", "carrier_id")).otherwise(F.lit(UNKNOWN_KEY).cast("bigint"))
        return items.join(known, ["source_system", "carrier_id"], "left").withColumn("carrier_key", key)

    @staticmethod
    def _employee_key() -> F.Column:
        return (F.when(F.col("employee_version_key") == UNKNOWN_KEY, F.lit(UNKNOWN_KEY).cast("bigint"))
                .otherwise(surrogate_key("source_system", "employee_id")).alias("employee_key"))

    def _fact_sales(self, items: DataFrame, at: Manifest) -> DataFrame:
        return self._carrier_key(items, at).select(
            "source_system", "sale_id", "sale_no", "line", "item_id", time_key(F.col("order_date")).alias("time_key"),
            F.col("order_date").alias("sale_date"), surrogate_key("source_system", "customer_id").alias("customer_key"),
            surrogate_key("source_system", "product_id").alias("product_key"),
            surrogate_key("source_system", "address_id").alias("address_key"), self._employee_key(), "carrier_key",
            "customer_version_key", "product_version_key", "employee_version_key", sale_type(F.col("sale_type_code")).alias("sale_type"),
            "quantity", "unit_price", "discount_amount", "item_total")

    def _fact_deliveries(self, items: DataFrame, at: Manifest) -> DataFrame:
        """A sale's items are loaded together, so an order is whole here."""
        header = ["source_system", "sale_id", "sale_no", "order_date", "o_orderstatus", "customer_id", "employee_id", "carrier_id",
                  "due_date", "freight", "customer_version_key", "employee_version_key"]
        orders = items.groupBy(*header).agg(F.sum("item_total").alias("value"), F.max("ship_date").alias("shipped"))
        orders = orders.withColumn("shipped_date", F.when(F.col("o_orderstatus") != "O", F.col("shipped")))
        return self._carrier_key(orders, at).select(
            "source_system", "sale_id", "sale_no", time_key(F.col("order_date")).alias("order_time_key"),
            F.when(F.col("shipped_date").isNotNull(), time_key(F.col("shipped_date"))).alias("ship_time_key"), "order_date", "shipped_date",
            surrogate_key("source_system", "customer_id").alias("customer_key"), self._employee_key(), "carrier_key",
            "customer_version_key", "employee_version_key", F.col("value").cast("decimal(25,2)").alias("order_value"), "freight",
            days_between(F.col("due_date"), F.col("order_date")).alias("promised_days"),
            days_between(F.col("shipped_date"), F.col("order_date")).alias("days_to_ship"),
            days_between(F.col("shipped_date"), F.col("due_date")).alias("delay_days"))

    def _fact_purchases(self, items: DataFrame, at: Manifest) -> DataFrame:
        entry = (items.groupBy("purchase_id").agg(F.max("ship_date").alias("last_ship")))
        lead = days_between(F.when(F.col("o_orderstatus") != "O", F.col("last_ship")), F.col("order_date"))
        return items.join(entry, "purchase_id").select(
            "source_system", "purchase_id", "purchase_no", time_key(F.col("order_date")).alias("time_key"),
            F.col("order_date").alias("purchase_date"), surrogate_key("source_system", "supplier_id").alias("supplier_key"),
            surrogate_key("source_system", "product_id").alias("product_key"),
            surrogate_key(F.col("source_system"), F.concat(F.lit("SUP-"), "supplier_id")).alias("address_key"), "product_version_key",
            "quantity", "unit_price", "item_total", lead.alias("lead_time_days"))


class _Next:
    """The version that a run is making: folders written so far, published in one step."""

    def __init__(self, store: Warehouse, last: Manifest):
        self.store, self.last = store, last
        self.parts = dict(last.parts)
        self.settings = {**last.settings, **{k: dict(last.settings.get(k, {})) for k in ("schemas", "buckets")}}

    def _keep_schema(self, name: str, schema: StructType) -> None:
        plain = StructType.fromJson(schema.jsonValue())
        for f in plain.fields:
            f.nullable = True
        self.settings["schemas"][name] = plain.jsonValue()

    def append(self, name: str, part: object, rows: DataFrame) -> None:
        folder = self.store.log.new_folder()
        rows.write.option("compression", CODEC).parquet(f"{self.store.base}/{folder}")
        self._keep_schema(name, rows.schema)
        self.parts[f"{name}/{part}"] = folder

    def replace(self, name: str, rows: DataFrame, bucket: F.Column) -> DataFrame:
        """Write buckets anew; the others keep their folders."""
        folder = self.store.log.new_folder()
        path = f"{self.store.base}/{folder}"
        rows.withColumn("bucket", bucket).hint("rebalance", "bucket").write.option("compression", CODEC).partitionBy("bucket").parquet(path)
        self._keep_schema(name, rows.schema)
        names = [s.getPath().getName() for s in self.store.log.fs.listStatus(self.store.log._path(path))]
        parts = {f"{name}/{n.split('=')[1]}": f"{folder}/{n}" for n in names if n.startswith("bucket=")}
        self.parts.update(parts)
        return self.written(name, list(parts))

    def written(self, name: str, parts: list[str]) -> DataFrame:
        return self.store.table(name, Manifest(0, self.parts, self.settings), parts)

    def publish(self) -> Manifest:
        return self.store.log.publish(self.last, self.parts, self.settings)
