"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path

# FIXED VALUES: the white space that ends a word, and the letters that are lower-cased.
SPACE = r"\x20\x09-\x0D"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


_shipped: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str, files: int | None = None) -> DataFrame:
    """Write ``df`` to a new table in the shared folder and read it back.

    This cuts the lineage: a lost executor costs the tasks that ran on it, not
    the whole history, and values such as row numbers are fixed for good.
    ``files``: that many at most, for tables of few and short rows, of which
    each shuffle partition would make a file of its own.
    """
    path = scratch_path(df.sparkSession, name)
    if files:
        df = df.coalesce(files)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once for a Spark application:
    they import it by name, also where it is not installed on the nodes."""
    context = spark.sparkContext
    if _shipped.get("app") != context.applicationId:
        top = Path(__file__).resolve().parents[1]
        archive = Path(tempfile.mkdtemp(prefix="package-")) / f"{top.name}.zip"
        with zipfile.ZipFile(archive, "w") as z:
            for f in sorted(top.rglob("*.py")):
                z.write(f, f.relative_to(top.parent))
        context.addPyFile(str(archive))
        _shipped["app"] = context.applicationId


def words(text: Column) -> Column:
    """Words of a text: runs of anything but ASCII white space."""
    return F.filter(F.split(text, f"[{SPACE}]+"), lambda w: w != "")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{SPACE}]+")), F.lit(0)).cast("long")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def utf8_bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def row_identity(*cols: Column) -> Column:
    """128 bits that stand for the values of a row, nulls told apart from
    empty values. Rows that agree in ``cols`` share it."""
    marked = [x for c in cols for x in (c.isNull(), c)]
    return F.concat(F.lpad(F.hex(F.xxhash64(*marked)), 16, "0"), F.lpad(F.hex(F.xxhash64(F.lit(7), *marked)), 16, "0"))


def running_sum(df: DataFrame, group: list[str], cell: list[str], order: Iterable, value: str, out: str) -> DataFrame:
    """``out``: the sum of ``value`` over the rows before this one in its
    ``group``, by (``cell``, ``order``).

    Cells are summed first; only the cells of a group are put in one sequence,
    and rows are put in sequence within their own cell. So a group of any size
    is spread over as many tasks as it has cells. ``group`` and ``cell`` must
    not hold nulls; ``df`` is read twice and should be stored.
    """
    before = Window.partitionBy(*[F.col(c) for c in group]).orderBy(*cell).rowsBetween(Window.unboundedPreceding, -1)
    within = Window.partitionBy(*group, *cell).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (df.groupBy(*group, *cell).agg(F.sum(value).alias("_sum"))
               .select(*group, *cell, F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset")))
    return (df.withColumn("_within", F.coalesce(F.sum(value).over(within), F.lit(0)))
            .join(offsets, [*group, *cell])
            .withColumn(out, F.col("_offset") + F.col("_within")).drop("_offset", "_within"))


def n_cells(rows: int, groups: int = 1, per_cell: int = 20_000, most: int = 65_536) -> int:
    """Cells per group so that a cell holds about ``per_cell`` rows even if one
    group holds all; 256 at least, so that a large group is spread at any size."""
    return max(256, min(most, rows // per_cell))


def n_files(rows: int, per_file: int) -> int:
    """Files for a table of ``rows`` short rows at most; so many at least that all cores of a small cluster write."""
    return max(24, -(-rows // per_file))
