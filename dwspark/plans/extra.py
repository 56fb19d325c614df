"""Registered queries beyond the marts and dashboards: history (SCD and
as-of), corporate-layer operators, incremental loads, quality checks."""

from __future__ import annotations

from . import history


def _modules():
    from . import corporate_queries, incremental, load_queries, quality_queries, rule_queries, stateful, stream_queries
    return [history, corporate_queries, incremental, quality_queries, rule_queries, stateful, load_queries, stream_queries]


def queries() -> dict:
    out: dict = {}
    for m in _modules():
        out.update(m.queries())
    return out


def oracle_sql() -> dict:
    out: dict = {}
    for m in _modules():
        out.update(m.oracle_sql())
    return out
