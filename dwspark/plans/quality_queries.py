"""Registered data-quality reports over the marts and the event history.
The constraint lists below restate the reference's DDL (NOT NULL, UNIQUE,
FOREIGN KEY, VARCHAR lengths) for our tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import CALENDAR_END, CALENDAR_START
from ..operators import quality as Q
from ..oracle.binding import with_binding
from . import history
from .marts import Marts, staged_marts

UNIQUE = {  # table -> business key (the surrogate key is checked as well)
    "dim_customer": (["source_system", "customer_id"], "customer_key"),
    "dim_product": (["source_system", "product_id"], "product_key"),
    "dim_address": (["source_system", "address_id"], "address_key"),
    "dim_employee": (["source_system", "employee_id"], "employee_key"),
    "dim_carrier": (["source_system", "carrier_id"], "carrier_key"),
    "dim_supplier": (["source_system", "supplier_id"], "supplier_key"),
    "fact_deliveries": (["source_system", "sale_id"], None),
}
FOREIGN_KEYS = [  # fact, fk column, dimension, dimension key
    ("fact_sales", "customer_key", "dim_customer", "customer_key"),
    ("fact_sales", "product_key", "dim_product", "product_key"),
    ("fact_sales", "address_key", "dim_address", "address_key"),
    ("fact_sales", "employee_key", "dim_employee", "employee_key"),
    ("fact_sales", "carrier_key", "dim_carrier", "carrier_key"),
    ("fact_purchases", "supplier_key", "dim_supplier", "supplier_key"),
    ("fact_purchases", "product_key", "dim_product", "product_key"),
    ("fact_purchases", "address_key", "dim_address", "address_key"),
    ("fact_deliveries", "customer_key", "dim_customer", "customer_key"),
    ("fact_deliveries", "employee_key", "dim_employee", "employee_key"),
    ("fact_deliveries", "carrier_key", "dim_carrier", "carrier_key"),
    ("fact_deliveries", "address_key", "dim_address", "address_key"),
]
NOT_NULL = {
    "fact_sales": ["source_system", "sale_id", "time_key", "customer_key", "product_key", "address_key",
                   "employee_key", "carrier_key", "quantity", "unit_price", "discount_amount", "item_total"],
    "fact_purchases": ["source_system", "purchase_id", "time_key", "supplier_key", "product_key", "address_key",
                       "quantity", "unit_price", "item_total"],
    "fact_deliveries": ["source_system", "sale_id", "order_time_key", "customer_key", "employee_key",
                        "carrier_key", "order_value"],
}
LENGTHS = {
    "dim_customer": {"customer_name": 255, "sex": 20, "income_band": 50, "marital_status": 45, "age_band": 20,
                     "profession": 255, "area_code": 10, "phone_type": 50},
    "dim_address": {"street": 255, "postal_code": 20, "state": 100, "state_code": 10, "country": 100},
    "dim_product": {"product_name": 255, "category": 255, "currency": 3},
}
CHECKS_SQL = {  # check name -> (table, SQL predicate); the Spark side parses the same text
    "quantity>0": ("fact_sales", "quantity > 0"),
    "unit_price>=0": ("fact_sales", "unit_price >= 0"),
    "discount_amount>=0": ("fact_sales", "discount_amount >= 0"),
    "item_total=qty*price-discount": ("fact_sales", "item_total = quantity * unit_price - discount_amount"),
    "purchase_quantity>0": ("fact_purchases", "quantity > 0"),
    "freight>=0": ("fact_deliveries", "freight >= 0"),
    "promised_days>=0": ("fact_deliveries", "promised_days >= 0"),
}
CALENDAR_DATES = [("fact_sales", "sale_date"), ("fact_purchases", "purchase_date"),
                  ("fact_deliveries", "order_date"), ("fact_deliveries", "shipped_date")]


def _u(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def dq_unique_keys(spark: SparkSession, sf_dir: str, m=None) -> DataFrame:
    m = m or staged_marts(spark, sf_dir)
    parts = []
    for t, (bk, sk) in UNIQUE.items():
        df = getattr(m, t)
        parts.append(Q.dq_unique(df, t, bk))
        if sk:
            parts.append(Q.dq_unique(df, t, [sk]))
    return _u(parts)


def dq_foreign_keys(spark: SparkSession, sf_dir: str, m=None) -> DataFrame:
    """``m``: any marts object (computed ``Marts`` by default, or the stored
    warehouse's ``StoredMarts``)."""
    m = m or staged_marts(spark, sf_dir)
    facts: dict[str, list] = {}
    for f, fk, d, dk in FOREIGN_KEYS:
        facts.setdefault(f, []).append((fk, getattr(m, d), dk))
    return _u([Q.dq_foreign_keys(getattr(m, f), f, fks) for f, fks in facts.items()])


def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = staged_marts(spark, sf_dir)
    return _u([Q.dq_not_null(getattr(m, t), t, cols) for t, cols in NOT_NULL.items()])


def dq_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = Marts(spark, sf_dir)
    return _u([Q.dq_length(getattr(m, t), t, lim) for t, lim in LENGTHS.items()])


def dq_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = staged_marts(spark, sf_dir)
    by_table: dict[str, dict] = {}
    for name, (t, pred) in CHECKS_SQL.items():
        by_table.setdefault(t, {})[name] = F.expr(pred)
    return _u([Q.dq_check(getattr(m, t), t, checks) for t, checks in by_table.items()])


def dq_out_of_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = staged_marts(spark, sf_dir)
    return _u([Q.dq_out_of_calendar(getattr(m, t), t, c, CALENDAR_START, CALENDAR_END)
               for t, c in CALENDAR_DATES])


def out_of_calendar_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sales that the calendar does not cover: they count in totals, but in no month or quarter."""
    fs = Marts(spark, sf_dir).fact_sales
    bad = Q.out_of_calendar_rows(fs, "sale_date", CALENDAR_START, CALENDAR_END)
    return bad.groupBy("source_system", "sale_id", "sale_date").agg(F.count(F.lit(1)).alias("items"))


def dq_scd2_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.dq_scd2(history.versions(spark, sf_dir), "event_status_history", history.KEYS)


def queries() -> dict:
    fns = [dq_unique_keys, dq_foreign_keys, dq_not_null, dq_lengths, dq_checks, dq_out_of_calendar,
           out_of_calendar_sales, dq_scd2_history]
    return {f.__name__: f for f in fns}


# -- oracle -------------------------------------------------------------------------
def _rep(table: str, check: str, expr: str, frm: str) -> str:
    return (f"SELECT '{table}' AS table_name, '{check}' AS check_name, "
            f"CAST(coalesce({expr}, 0) AS BIGINT) AS violations FROM {frm}")


def oracle_sql() -> dict:
    uniq = []
    for t, (bk, sk) in UNIQUE.items():
        for key in [bk] + ([[sk]] if sk else []):
            k = ", ".join(key)
            uniq.append(_rep(t, f"unique({','.join(key)})", "sum(CASE WHEN n > 1 THEN n END)",
                             f"(SELECT {k}, count(*) AS n FROM {t} GROUP BY {k})"))
    fks = [_rep(f, f"fk({fk})", "count(*)", f"{f} x WHERE NOT EXISTS (SELECT 1 FROM {d} y WHERE y.{dk} = x.{fk})")
           for f, fk, d, dk in FOREIGN_KEYS]
    nn = [_rep(t, f"not_null({c})", f"sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END)", t)
          for t, cols in NOT_NULL.items() for c in cols]
    ln = [_rep(t, f"length({c})<={n}", f"sum(CASE WHEN length({c}) > {n} THEN 1 ELSE 0 END)", t)
          for t, lim in LENGTHS.items() for c, n in lim.items()]
    ck = [_rep(t, name, f"sum(CASE WHEN NOT ({pred}) THEN 1 ELSE 0 END)", t)
          for name, (t, pred) in CHECKS_SQL.items()]
    cal = [_rep(t, f"in_calendar({c})",
                f"sum(CASE WHEN {c} IS NOT NULL AND ({c} < DATE '{CALENDAR_START}' OR {c} > DATE '{CALENDAR_END}') "
                f"THEN 1 ELSE 0 END)", t) for t, c in CALENDAR_DATES]
    v = history._versions_sql()
    scd = f"""WITH {v},
        s AS (SELECT *, lag(valid_to) OVER (PARTITION BY user_id ORDER BY valid_from) AS prev_to,
                        lag(valid_to IS NULL) OVER (PARTITION BY user_id ORDER BY valid_from) AS prev_open FROM versions)
        {_rep('event_status_history', 'one_current_per_key', 'sum(CASE WHEN c <> 1 THEN 1 ELSE 0 END)',
              '(SELECT user_id, sum(CAST(is_current AS INTEGER)) AS c FROM versions GROUP BY user_id)')}
        UNION ALL {_rep('event_status_history', 'no_overlap',
                        'sum(CASE WHEN prev_open OR prev_to >= valid_from THEN 1 ELSE 0 END)', 's')}
        UNION ALL {_rep('event_status_history', 'valid_to>=valid_from',
                        'sum(CASE WHEN valid_to < valid_from THEN 1 ELSE 0 END)', 's')}
        UNION ALL {_rep('event_status_history', 'current_is_open',
                        'sum(CASE WHEN is_current <> (valid_to IS NULL) THEN 1 ELSE 0 END)', 's')}"""
    return {
        "dq_unique_keys": with_binding(" UNION ALL ".join(uniq)),
        "dq_foreign_keys": with_binding(" UNION ALL ".join(fks)),
        "dq_not_null": with_binding(" UNION ALL ".join(nn)),
        "dq_lengths": with_binding(" UNION ALL ".join(ln)),
        "dq_checks": with_binding(" UNION ALL ".join(ck)),
        "dq_out_of_calendar": with_binding(" UNION ALL ".join(cal)),
        "out_of_calendar_sales": with_binding(f"""SELECT source_system, sale_id, sale_date, count(*) AS items
            FROM fact_sales WHERE sale_date < DATE '{CALENDAR_START}' OR sale_date > DATE '{CALENDAR_END}'
            GROUP BY source_system, sale_id, sale_date"""),
        "dq_scd2_history": scd,
    }
