"""Registry of every query: name -> (spark, sf_dir) -> DataFrame, and the
matching DuckDB oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators.filters import NO_FILTERS, MartFilters
from ..oracle.dashboards import dashboard_sql
from . import dashboards as D
from .marts import Marts

# Filter values of the "__filtered" variants (P8), one per mart.
FILTER_FROM, FILTER_TO = "1996-01-01", "1997-12-31"
FILTER_SOURCE = "RETAIL"
FILTER_CARRIER = "URGENT"
FILTER_SUPPLIER = "Supplier#000000073"
SAMPLE_FILTERS = MartFilters(date_from=FILTER_FROM, date_to=FILTER_TO, source_system=FILTER_SOURCE,
                             carrier=FILTER_CARRIER, supplier=FILTER_SUPPLIER)

# Which optional filters each card accepts (P9): comparisons *by* X ignore X.
_PERIOD_ONLY = {"sales_by_source", "sales_ticket_by_income_band",
                "purchases_top10_suppliers", "purchases_lead_time_by_supplier",
                "purchases_supplier_summary", "purchases_category_by_quarter",
                "deliveries_delay_by_carrier", "deliveries_freight_by_carrier",
                "deliveries_carrier_summary", "deliveries_carrier_by_quarter"}

DASHBOARD_FNS = {fn.__name__: fn for fn in D.ALL + [D.sales_cube_category_quarter, D.sales_by_currency]}


def _where(name: str) -> str:
    w = f"day BETWEEN DATE '{FILTER_FROM}' AND DATE '{FILTER_TO}'"
    if name in _PERIOD_ONLY:
        return w
    if name.startswith("sales"):
        return w + f" AND source_system = '{FILTER_SOURCE}'"
    if name.startswith("purchases"):
        return w + f" AND supplier_name = '{FILTER_SUPPLIER}'"
    return w + f" AND carrier_name = '{FILTER_CARRIER}'"


def _dashboard(fn, filters: MartFilters) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(Marts(spark, sf_dir), filters)
    run.__name__ = fn.__name__
    return run


def _mart_table(attr: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return getattr(Marts(spark, sf_dir), attr)
    run.__name__ = attr
    return run


MART_TABLES = ["fact_sales", "fact_purchases", "fact_deliveries", "dim_customer", "dim_product",
               "dim_address", "dim_employee", "dim_carrier", "dim_supplier"]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    q: dict[str, Callable] = {}
    for name in MART_TABLES:
        q[name] = _mart_table(name)
    for name, fn in DASHBOARD_FNS.items():
        q[name] = _dashboard(fn, NO_FILTERS)
        q[f"{name}__filtered"] = _dashboard(fn, SAMPLE_FILTERS)
    from . import extra
    q.update(extra.queries())
    return q


def oracle_sql() -> dict[str, str]:
    from ..oracle.binding import with_binding
    sql: dict[str, str] = {}
    for name in MART_TABLES:
        sql[name] = with_binding(f"SELECT * FROM {name}")
    base = dashboard_sql()
    for name in DASHBOARD_FNS:
        sql[name] = base[name]
        sql[f"{name}__filtered"] = dashboard_sql(_where(name))[name]
    from . import extra
    sql.update(extra.oracle_sql())
    return sql
