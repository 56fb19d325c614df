"""Incremental loads as Structured Streaming micro-batches (M1-M3).

A file-source stream with ``trigger(availableNow=True)`` hands each new file to
``foreachBatch`` once. What a batch does is decided by content, never by its
batch id: ids restart with a lost checkpoint, contents don't. New events are
those whose key the sink does not hold, and folding an event into the history
twice changes nothing; so a replay, a lost checkpoint or a batch of old and new
files all end in the same tables.

A table is a store of published versions (``operators.versions``): a batch writes
new folders and publishes them in one step. Small parts are merged in tiers, so a row is rewritten
a few times in its life and a large part never.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import time_key
from ..operators import scd
from ..operators.sinks import new_rows
from ..operators.versions import Manifest, VersionLog
from ..session import scratch_path

EVENT_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
FACT_SCHEMA = "event_id bigint, user_id bigint, time_key int, event_type string, value double, event_date date"
PARTS_PER_TIER = 8           # parts of one tier that are merged into one of the next
LAST_TIER = 4               # whose parts are large and stay as they are
ROWS_PER_BUCKET = 1_000_000
MOST_BUCKETS = 1 << 14      # so that a manifest stays small; beyond it buckets hold more rows


def read_event_stream(spark: SparkSession, source_dir: str, glob: str = "events*.parquet",
                      files_per_batch: int | None = None) -> DataFrame:
    r = spark.readStream.schema(EVENT_SCHEMA).option("pathGlobFilter", glob)
    if files_per_batch:
        r = r.option("maxFilesPerTrigger", files_per_batch)
    return r.parquet(source_dir)


def event_fact_rows(events: DataFrame) -> DataFrame:
    """The event fact: one row per event, keyed like the other facts."""
    d = F.col("ts").cast("date")
    return events.select("event_id", "user_id", d.alias("event_date"), time_key(d).alias("time_key"),
                         "event_type", "value")


class ManifestTable(VersionLog):
    """A table of immutable folders: see ``operators.versions``."""

    def load(self, schema: str, paths: list[str]) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.base}/{p}" for p in paths])


# -- M1: append ------------------------------------------------------------------
def _load_fact(table: ManifestTable, manifest: Manifest) -> DataFrame:
    """The fact's rows; each part is partitioned by event date."""
    parts = [table.spark.read.option("basePath", f"{table.base}/{p}").schema(FACT_SCHEMA).parquet(f"{table.base}/{p}")
             for p in manifest.parts.values()]
    out = table.spark.createDataFrame([], FACT_SCHEMA)
    for p in parts:
        out = out.unionByName(p)
    return out


def event_fact(spark: SparkSession, sink: str) -> DataFrame:
    """What has been published of the event fact."""
    table = ManifestTable(spark, sink)
    return _load_fact(table, table.read())


def append_events(spark: SparkSession, sink: str, batch: DataFrame) -> None:
    """Append the events of ``batch`` that the sink does not hold, each once.

    An event's date never changes, so the anti join only reads the sink's
    partitions of the batch's dates (a semi join that Spark turns into a
    partition filter)."""
    table = ManifestTable(spark, sink)
    last = table.read()
    rows = event_fact_rows(batch).persist()
    try:
        held = _load_fact(table, last).select("event_date", "event_id")
        held = held.join(rows.select("event_date").distinct(), "event_date", "left_semi")
        fresh = new_rows(held, rows, ["event_date", "event_id"])
        folder = table.new_folder()
        fresh.write.partitionBy("event_date").parquet(f"{table.base}/{folder}")
    finally:
        rows.unpersist()
    table.publish(last, _merged(table, {**last.parts, f"0/{uuid.uuid4().hex}": folder}))


def _merged(table: ManifestTable, parts: dict[str, str]) -> dict[str, str]:
    """A part's name begins with its tier; as many as PARTS_PER_TIER of one tier become one of the next."""
    for tier in range(LAST_TIER):
        same = [p for p in parts if p.startswith(f"{tier}/")]
        if len(same) < PARTS_PER_TIER:
            continue
        whole = table.new_folder()
        (_load_fact(table, Manifest(0, {p: parts[p] for p in same})).hint("rebalance", "event_date")
         .write.partitionBy("event_date").parquet(f"{table.base}/{whole}"))
        parts = {p: f for p, f in parts.items() if p not in same} | {f"{tier + 1}/{uuid.uuid4().hex}": whole}
    return parts


def stream_events_to_fact(spark: SparkSession, source_dir: str, sink: str | None = None,
                          files_per_batch: int | None = None, checkpoint: str | None = None,
                          glob: str = "events*.parquet") -> str:
    """M1 + M3: append every new event to the event fact exactly once."""
    sink = sink or scratch_path(spark, "fact_events")
    q = (read_event_stream(spark, source_dir, glob, files_per_batch).writeStream
         .foreachBatch(lambda batch, _: append_events(spark, sink, batch))
         .option("checkpointLocation", checkpoint or sink + "_checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    return sink


# -- M2: type-2 history ------------------------------------------------------------
KEYS, ATTRS, ORDER = ["user_id"], ["status"], ["ts", "event_id"]
VERSIONS_SCHEMA = ("user_id bigint, status string, entity_key bigint, version_key bigint, valid_from date, "
                   "valid_to date, is_current boolean")
DAILY_SCHEMA = "user_id bigint, valid_from date, status string, __order struct<ts:timestamp_ntz,event_id:bigint>"


def _bucket(n: int) -> F.Column:
    return F.pmod(F.xxhash64(*[F.col(k) for k in KEYS]), F.lit(n)).cast("int")


def fold_events(spark: SparkSession, base: str, batch: DataFrame, rows_per_bucket: int = ROWS_PER_BUCKET) -> None:
    """Fold a batch of events, late ones too, into the history.

    The state is kept in buckets by key; a batch reads and rewrites the
    buckets of its own keys only. Their number follows the state: it doubles
    when a bucket has grown beyond ``rows_per_bucket`` daily points, so a batch's cost stays in
    proportion to its keys however large the state is."""
    table = ManifestTable(spark, base)
    last = table.read()
    n = last.settings.get("buckets", 1)
    split = last.settings.get("largest", 0) > rows_per_bucket and n < MOST_BUCKETS
    n = 2 * n if split else n
    log = batch.select("user_id", "ts", "event_id", F.col("event_type").alias("status")).persist()
    try:
        touched = [r[0] for r in log.select(_bucket(n).alias("b")).distinct().collect()]     # n values at most
        if not touched:
            return
        old = list(last.parts.values()) if split else [last.parts[k] for b in touched if (k := str(b)) in last.parts]
        day = F.col("ts").cast("date")
        versions = table.load(VERSIONS_SCHEMA, [p.replace("/daily/", "/versions/") for p in old])
        daily = table.load(DAILY_SCHEMA, old)
        versions, daily = scd.scd2_apply_log(versions, daily, log, KEYS, ATTRS, day, ORDER)
        folder = table.new_folder()
        for name, rows in (("versions", versions), ("daily", daily)):
            rows.withColumn("bucket", _bucket(n)).write.partitionBy("bucket").parquet(f"{table.base}/{folder}/{name}")
    finally:
        log.unpersist()
    written = {r.bucket: r.n for r in spark.read.parquet(f"{table.base}/{folder}/daily")
               .groupBy("bucket").agg(F.count("*").alias("n")).collect()}
    parts = {} if split else dict(last.parts)
    parts |= {str(b): f"{folder}/daily/bucket={b}" for b in written}
    largest = max([*written.values(), 0 if split else last.settings.get("largest", 0)])
    table.publish(last, parts, {"buckets": n, "largest": largest})


def stream_scd2_history(spark: SparkSession, source_dir: str, base: str | None = None,
                        files_per_batch: int | None = None, checkpoint: str | None = None,
                        rows_per_bucket: int = ROWS_PER_BUCKET, glob: str = "events*.parquet") -> str:
    """M2: type-2 history of each user's status maintained per micro-batch."""
    base = base or scratch_path(spark, "status_history")
    q = (read_event_stream(spark, source_dir, glob, files_per_batch).writeStream
         .foreachBatch(lambda batch, _: fold_events(spark, base, batch, rows_per_bucket))
         .option("checkpointLocation", checkpoint or base + "_checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    return base


def current_snapshot(spark: SparkSession, base: str) -> DataFrame:
    """The published type-2 state."""
    table = ManifestTable(spark, base)
    paths = [p.replace("/daily/", "/versions/") for p in table.read().parts.values()]
    return table.load(VERSIONS_SCHEMA, paths)
