"""Order-insensitive comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import math
import os
from decimal import Decimal

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck_connection(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, Decimal):
        return round(float(v), 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def canonical(records, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in records]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def compare(sdf, con, sql: str) -> tuple[bool, str]:
    scols = sdf.columns
    srows = [tuple(r) for r in sdf.collect()]
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    if sorted(scols) != sorted(dcols):
        return False, f"columns differ: spark={scols} duck={dcols}"
    if len(srows) != len(drows):
        return False, f"row counts differ: spark={len(srows)} duck={len(drows)}"
    a, b = canonical(srows, scols), canonical(drows, dcols)
    if a != b:
        sb = set(b)
        return False, f"values differ, e.g. spark-only {[x for x in a if x not in sb][:2]}"
    return True, f"{len(srows)} rows"
