"""Staging of one run (S7, S8): a folder of its own, cleared when the run ends
and, after a crash, by the next run that starts."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession

from .sinks import CODEC

LEASE_SECONDS = 24 * 3600.0        # a run that has staged nothing for so long is dead


class StagingRun:
    """``with StagingRun(spark, root) as run: run.stage(df, name)``.

    The folder holds a lease file that each staging renews. A start removes the
    folders whose lease has run out; folders of runs at work stay."""

    def __init__(self, spark: SparkSession, root: str, lease_seconds: float | None = None):
        self.spark, self.root = spark, root.rstrip("/")
        self.lease_seconds = LEASE_SECONDS if lease_seconds is None else lease_seconds
        self.folder = f"{self.root}/run-{uuid.uuid4().hex[:12]}"
        self.jvm = spark.sparkContext._jvm
        self.fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, p: str):
        return self.jvm.org.apache.hadoop.fs.Path(p)

    def _renew(self) -> None:
        self.fs.create(self._path(f"{self.folder}/_lease"), True).close()

    def _clear_dead(self) -> None:
        root = self._path(self.root)
        if not self.fs.exists(root):
            return
        for s in self.fs.listStatus(root):
            lease = self._path(f"{self.root}/{s.getPath().getName()}/_lease")
            told = self.fs.getFileStatus(lease) if self.fs.exists(lease) else s
            if s.getPath().getName().startswith("run-") and time.time() - told.getModificationTime() / 1000 >= self.lease_seconds:
                self.fs.delete(s.getPath(), True)

    def __enter__(self) -> StagingRun:
        self._clear_dead()
        self._renew()
        return self

    def __exit__(self, *_) -> None:
        self.fs.delete(self._path(self.folder), True)

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` once and read it back; gone when the run ends."""
        self._renew()
        path = f"{self.folder}/{name}"
        df.write.option("compression", CODEC).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)
