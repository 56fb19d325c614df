"""Registered streaming queries: available-now streams over the ``events`` of
``sf_dir``, dealt by time into several files and so into several batches;
each returns what the stream has published."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.sinks import full_refresh
from ..oracle.binding import _tk
from ..sources.readers import sf_table
from ..streaming import microbatch as MB
from . import history

FILES = 4


def _arrivals(spark: SparkSession, sf_dir: str) -> str:
    """The events as files that arrive one after another: all events, by time."""
    events = sf_table(spark, sf_dir, "events")
    return full_refresh(events.repartitionByRange(FILES, "ts"), "arriving-events")


def stream_events_to_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    sink = MB.stream_events_to_fact(spark, _arrivals(spark, sf_dir), files_per_batch=1, glob="*.parquet")
    return MB.event_fact(spark, sink).select("event_id", "user_id", "event_date", "time_key", "event_type", "value")


def stream_scd2_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = MB.stream_scd2_history(spark, _arrivals(spark, sf_dir), files_per_batch=1, glob="*.parquet")
    return MB.current_snapshot(spark, base)


def queries() -> dict:
    return {"stream_events_to_fact": stream_events_to_fact, "stream_scd2_history": stream_scd2_history}


def oracle_sql() -> dict:
    d = "CAST(ts AS DATE)"
    return {
        "stream_events_to_fact": f"""SELECT event_id, user_id, {d} AS event_date, {_tk(d)} AS time_key,
                                            event_type, value FROM events""",
        "stream_scd2_history": f"WITH {history._versions_sql()} SELECT * FROM versions",
    }
