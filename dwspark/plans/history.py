"""Attribute history (SCD1 / SCD2 / as-of join) over the ``events`` table.

The supplied data has no slowly changing master data of its own, so the
history of one attribute per user is taken from ``events``: key
``user_id``, day ``cast(ts as date)``, attribute ``status`` = the event
type of the user's last event that day by (ts, event_id). Purchase events
are the facts that look their version up as of their own date.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import surrogate_key_sql as K
from ..operators import scd
from ..sources.readers import sf_table

KEYS, ATTRS, ORDER = ["user_id"], ["status"], ["ts", "event_id"]


def change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = sf_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type"])
    return ev.select("user_id", "ts", "event_id", F.col("event_type").alias("status"))


def _day() -> F.Column:
    return F.col("ts").cast("date")


def versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd.scd2_from_change_log(change_log(spark, sf_dir), KEYS, ATTRS, _day(), ORDER)


def current_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd.scd2_current(versions(spark, sf_dir))


def purchase_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = sf_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "value"])
    return (ev.filter(F.col("event_type") == "purchase")
              .select("event_id", "user_id", F.col("ts").cast("date").alias("event_date"), "value"))


def asof_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd.asof_version_join(purchase_events(spark, sf_dir), versions(spark, sf_dir), KEYS, "event_date")


def attach_current_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J11 (the default rule, C7): a fact gets the version that is current
    when it is loaded, whatever its own date -- an equi-join on the key with
    the current versions (exactly one per key)."""
    cur = scd.scd2_current(versions(spark, sf_dir)).select("user_id", "status", "version_key")
    return purchase_events(spark, sf_dir).join(cur, "user_id", "inner")


def asof_status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return asof_join(spark, sf_dir).groupBy("status").agg(F.count(F.lit(1)).alias("events"))


def last_day(log: DataFrame) -> F.Column:
    """The last day of the log, a scalar subquery."""
    return log.select(F.max(_day())).scalar()


def merge_last_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History of all days but the last, merged with the last day's batch: it covers every event."""
    log = change_log(spark, sf_dir)
    day = last_day(log)
    state = scd.scd2_from_change_log(log.filter(_day() < day), KEYS, ATTRS, _day(), ORDER)
    batch = scd.last_per_key_day(log.filter(_day() == day), KEYS, ATTRS, _day(), ORDER).drop("valid_from")
    return scd.scd2_merge(state, batch, KEYS, ATTRS, day)


def scd1_last_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Type-1 state (last status before the last day) upserted with the last day."""
    log = change_log(spark, sf_dir)
    day = last_day(log)
    pick = F.max_by(F.col("status"), F.struct(*ORDER)).alias("status")
    state = log.filter(_day() < day).groupBy("user_id").agg(pick)
    batch = log.filter(_day() == day).groupBy("user_id").agg(pick)
    return scd.scd1_upsert(state, batch, KEYS, ATTRS)


# -- oracle ---------------------------------------------------------------------
def _versions_sql(where: str = "") -> str:
    return f"""
    daily AS (SELECT user_id, CAST(ts AS DATE) AS valid_from, event_type AS status FROM events {where}
              QUALIFY row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) = 1),
    marked AS (SELECT *, lag(status) OVER (PARTITION BY user_id ORDER BY valid_from) AS prev,
                      row_number() OVER (PARTITION BY user_id ORDER BY valid_from) AS rn FROM daily),
    ch AS (SELECT user_id, status, valid_from FROM marked WHERE rn = 1 OR prev IS DISTINCT FROM status),
    versions AS (SELECT user_id, status, {K('user_id')} AS entity_key, {K('user_id', 'valid_from')} AS version_key,
                        valid_from,
                        lead(valid_from) OVER (PARTITION BY user_id ORDER BY valid_from) - 1 AS valid_to,
                        lead(valid_from) OVER (PARTITION BY user_id ORDER BY valid_from) IS NULL AS is_current
                 FROM ch)"""


ASOF_SQL = f"""WITH {_versions_sql()},
    pe AS (SELECT event_id, user_id, CAST(ts AS DATE) AS event_date, value FROM events WHERE event_type = 'purchase'),
    j AS (SELECT pe.*, v.status, v.entity_key, v.version_key, v.valid_from, v.valid_to, v.is_current
          FROM pe JOIN versions v ON v.user_id = pe.user_id AND v.valid_from <= pe.event_date
                                 AND (v.valid_to IS NULL OR pe.event_date <= v.valid_to))"""


def oracle_sql() -> dict[str, str]:
    last = "(SELECT max(CAST(ts AS DATE)) FROM events)"
    return {
        "scd2_from_change_log": f"WITH {_versions_sql()} SELECT * FROM versions",
        "scd2_current": f"WITH {_versions_sql()} SELECT * FROM versions WHERE is_current",
        "asof_version_join": f"{ASOF_SQL} SELECT * FROM j",
        "attach_current_version": f"""{ASOF_SQL} SELECT pe.user_id, pe.event_id, pe.event_date, pe.value, v.status,
                                             v.version_key FROM pe JOIN versions v ON v.user_id = pe.user_id
                                             WHERE v.is_current""",
        "asof_status_counts": f"{ASOF_SQL} SELECT status, count(*) AS events FROM j GROUP BY status",
        # merging the last day into the history of the days before must equal the history of all days
        "scd2_merge": f"WITH {_versions_sql()} SELECT * FROM versions",
        "scd1_upsert": f"""WITH
            s AS (SELECT user_id, arg_max(event_type, (ts, event_id)) AS status FROM events
                  WHERE CAST(ts AS DATE) < {last} GROUP BY user_id),
            b AS (SELECT user_id, arg_max(event_type, (ts, event_id)) AS status FROM events
                  WHERE CAST(ts AS DATE) = {last} GROUP BY user_id)
            SELECT coalesce(b.user_id, s.user_id) AS user_id,
                   CASE WHEN b.user_id IS NOT NULL THEN b.status ELSE s.status END AS status,
                   CASE WHEN s.user_id IS NULL THEN 'insert'
                        WHEN b.user_id IS NOT NULL AND b.status IS DISTINCT FROM s.status THEN 'update'
                        ELSE 'unchanged' END AS change
            FROM s FULL OUTER JOIN b ON s.user_id = b.user_id""",
    }


def queries() -> dict:
    return {
        "scd2_from_change_log": versions,
        "scd2_current": current_versions,
        "asof_version_join": asof_join,
        "attach_current_version": attach_current_version,
        "asof_status_counts": asof_status_counts,
        "scd2_merge": merge_last_day,
        "scd1_upsert": scd1_last_day,
    }
