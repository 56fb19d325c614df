"""Sinks: snapshot writes, replay-safe appends, staging.

Plain parquet has no MERGE, so every layer write is a complete snapshot in
a *new* directory under the shared folder (``session.shared_dir``) and
readers switch to it afterwards; a path that is being read is never
overwritten. Writing a table is also how lineage is cut (no
localCheckpoint): downstream jobs read the written files, so a lost
executor only recomputes from that table, not from the sources.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path

CODEC = "zstd"      # of all tables written: half the bytes of Spark's default


def full_refresh(df: DataFrame, name: str, partition_by: list[str] | None = None) -> str:
    """Write ``df`` as a fresh snapshot; return its path."""
    path = scratch_path(df.sparkSession, name)
    w = df.write.mode("errorifexists").option("compression", CODEC)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def append_new(target: DataFrame, batch: DataFrame, key: list[str]) -> DataFrame:
    """The target plus the batch rows whose business key is not in
    the target yet, one row per key -- replaying a batch adds nothing, nor
    does a row that a batch holds twice. The anti join only ships the
    target's key columns."""
    return target.unionByName(new_rows(target, batch, key))


def new_rows(target: DataFrame, batch: DataFrame, key: list[str]) -> DataFrame:
    """Only the rows ``append_new`` would add (what gets written with
    ``mode('append')``)."""
    return batch.dropDuplicates(key).join(target.select(*key).distinct(), key, "left_anti")


def items_of_new(target: DataFrame, batch: DataFrame, header: list[str]) -> DataFrame:
    """All items of the headers that the target does not hold yet. Items have
    no key of their own: a header's items are loaded together or not at all."""
    return batch.join(target.select(*header).distinct(), header, "left_anti")


def fresh_items(target: DataFrame, batch: DataFrame, header: list[str], number: str, ids: DataFrame | None = None) -> DataFrame:
    """``items_of_new``, reading of the target only the range of ids (``number``) that each source of the
    batch spans; where the target holds nothing there, the batch is new as it is and nothing is joined.
    ``ids``: rows with the source systems and numbers of the batch, if they are cheaper to read."""
    spans = (batch if ids is None else ids).groupBy("source_system").agg(F.min(number).alias("lo"), F.max(number).alias("hi")).collect()
    within = F.lit(False)
    for r in spans:                                                     # a row per source
        within = within | (F.col("source_system").eqNullSafe(F.lit(r.source_system)) & F.col(number).between(r.lo, r.hi))
    held = target.filter(within)
    return items_of_new(held, batch, header) if held.limit(1).count() else batch


def stage(df: DataFrame, name: str) -> DataFrame:
    """Materialize a delta once (staging) and read it back, so the many
    downstream jobs of a batch do not re-extract from the sources."""
    path = full_refresh(df, f"staging-{name}")
    return df.sparkSession.read.parquet(path)
