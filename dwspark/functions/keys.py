"""Deterministic surrogate keys and the not-applicable member.

Identity columns depend on insertion order and cannot be reproduced by a
distributed job (or an oracle), so keys are a 60-bit prefix of the md5 of
the business key's parts, escaped and joined by '|'. Because the key is a pure function of the
business key, a fact can carry a dimension key as a projection instead of
a join; the foreign-key check (quality.dq_foreign_key) reports orphans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .rules import UNKNOWN_KEY


def surrogate_key(*parts: Column | str) -> Column:
    """A number that follows from the parts of the business key alone."""
    cols = [F.col(p) if isinstance(p, str) else p for p in parts]
    # parts are escaped, so different parts never join to the same text; null differs from empty
    plain = [F.replace(F.replace(c.cast("string"), F.lit("\\"), F.lit("\\\\")), F.lit("|"), F.lit("\\|")) for c in cols]
    text = F.concat_ws("|", *[F.coalesce(c, F.lit("\\N")) for c in plain])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def surrogate_key_sql(*parts: str) -> str:
    """The same key in DuckDB SQL (used by the oracle)."""
    inner = ", ".join(rf"coalesce(replace(replace(CAST({p} AS VARCHAR), '\', '\\'), '|', '\|'), '\N')" for p in parts)
    return f"CAST('0x' || substr(md5(concat_ws('|', {inner})), 1, 15) AS BIGINT)"


def key_or_unknown(natural_id: Column, key: Column) -> Column:
    """-1 when the natural id is missing."""
    return F.when(natural_id.isNull(), F.lit(UNKNOWN_KEY).cast("bigint")).otherwise(key)


def with_unknown_member(dim: DataFrame, key_col: str, values: dict) -> DataFrame:
    """Append the -1 'not applicable' row; other columns NULL unless given."""
    spark = dim.sparkSession
    row = {f.name: None for f in dim.schema.fields}
    row.update(values)
    row[key_col] = UNKNOWN_KEY
    sentinel = spark.createDataFrame([tuple(row[f.name] for f in dim.schema.fields)], dim.schema)
    return dim.unionByName(sentinel)
