"""Source readers.

The reference reads two OLTP databases. Here a source table is either a
parquet path (what the supplied test data is) or a JDBC table; both come
back as a column-pruned DataFrame so Catalyst pushes projection (and any
later filter) into the scan.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class TableSpec:
    """Where a source table lives.

    ``path``  -> parquet.
    ``jdbc``  -> options passed as-is to ``spark.read.format('jdbc')``
    (url, dbtable/query, partitionColumn, lowerBound, upperBound,
    numPartitions, fetchsize ...). A partitioned JDBC read is the scale
    path: numPartitions parallel range queries instead of one cursor.
    """
    path: str | None = None
    jdbc: dict = field(default_factory=dict)


def read_table(spark: SparkSession, spec: TableSpec | str, columns: list[str] | None = None) -> DataFrame:
    if isinstance(spec, str):
        spec = TableSpec(path=spec)
    if spec.path is not None:
        df = spark.read.parquet(spec.path)
    else:
        reader = spark.read.format("jdbc")
        for k, v in spec.jdbc.items():
            reader = reader.option(k, v)
        df = reader.load()
    return df.select(*columns) if columns else df


def sf_table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """One of the supplied tables: ``{sf_dir}/{name}.parquet``."""
    return read_table(spark, f"{sf_dir.rstrip('/')}/{name}.parquet", columns)
