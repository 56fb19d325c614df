"""Slowly changing dimensions without MERGE: every function returns the
complete next state as a DataFrame (written by the caller as a new
snapshot; a path being read is never overwritten).

State layout of a type-2 table::

    <keys...>, <attrs...>, entity_key, version_key, valid_from, valid_to, is_current

* ``entity_key``  stable across versions (surrogate of the business key);
* ``version_key`` one per version (surrogate of business key + valid_from);
* ``valid_to``    inclusive last day, NULL while current.

Change detection is null-safe (``<=>``) after casting the batch to the
state's types, so NULL -> NULL and 18 -> 18.00 are not changes (U8).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import CALENDAR_END, CALENDAR_START
from ..functions.keys import surrogate_key

SCD2_COLS = ["entity_key", "version_key", "valid_from", "valid_to", "is_current"]


def _differs(attrs: list[str], left: str, right: str) -> Column:
    """True when any attribute differs, NULLs compared as values."""
    conds = [~F.col(f"{left}.{a}").eqNullSafe(F.col(f"{right}.{a}")) for a in attrs]
    return reduce(lambda a, b: a | b, conds) if conds else F.lit(False)


def _conform(batch: DataFrame, state: DataFrame, cols: list[str]) -> DataFrame:
    """Cast the batch's columns to the state's types."""
    types = {f.name: f.dataType for f in state.schema.fields}
    return batch.select(*[F.col(c).cast(types[c]).alias(c) if c in types else F.col(c) for c in cols])


def scd2_current(state: DataFrame) -> DataFrame:
    """P5: the current version of every key."""
    return state.filter(F.col("is_current"))


def daily_points(log: DataFrame, keys: list[str], attrs: list[str], day: Column,
                 order: list[str]) -> DataFrame:
    """The last change of each key on each day (C17), keeping the order
    value that made it last so later slices can be folded in exactly.
    ``max_by`` is a partial aggregate: a key with a huge log is combined
    map-side."""
    pick = F.max_by(F.struct(*attrs, F.struct(*order).alias("__order")), F.struct(*order))
    return (log.withColumn("__day", day).groupBy(*keys, "__day").agg(pick.alias("__a"))
               .select(*keys, F.col("__day").alias("valid_from"),
                       *[F.col(f"__a.{a}").alias(a) for a in attrs], F.col("__a.__order").alias("__order")))


def last_per_key_day(log: DataFrame, keys: list[str], attrs: list[str], day: Column,
                     order: list[str]) -> DataFrame:
    """One row per key and day: the day's last attribute values."""
    return daily_points(log, keys, attrs, day, order).drop("__order")


def versions_from_daily(daily: DataFrame, keys: list[str], attrs: list[str]) -> DataFrame:
    """Type-2 versions from per-day points: a version starts on a key's
    first day and wherever the values differ from the previous day's; it
    ends the day before the next version starts.

    A key has at most one point per day, so the window holds at most (days
    in the log's span) rows per key -- bounded by the calendar no matter
    how skewed the log is."""
    w = Window.partitionBy(*keys).orderBy("valid_from")
    prev = [F.lag(F.col(a)).over(w).alias(f"__p_{a}") for a in attrs]
    first = F.row_number().over(w) == 1
    marked = daily.select(*keys, "valid_from", *attrs, first.alias("__first"), *prev)
    changed = reduce(lambda a, b: a | b, [~F.col(a).eqNullSafe(F.col(f"__p_{a}")) for a in attrs])
    versions = marked.filter(F.col("__first") | changed).select(*keys, *attrs, "valid_from")
    nxt = F.lead("valid_from").over(w)
    return (versions.withColumn("valid_to", F.date_sub(nxt, 1))
                    .withColumn("is_current", nxt.isNull())
                    .withColumn("entity_key", surrogate_key(*keys))
                    .withColumn("version_key", surrogate_key(*keys, "valid_from"))
                    .select(*keys, *attrs, *SCD2_COLS))


def scd2_from_change_log(log: DataFrame, keys: list[str], attrs: list[str], day: Column,
                         order: list[str]) -> DataFrame:
    """The whole type-2 history from a change log in one pass."""
    return versions_from_daily(daily_points(log, keys, attrs, day, order), keys, attrs)


def scd2_merge(state: DataFrame, batch: DataFrame, keys: list[str], attrs: list[str],
               effective_date: str | Column) -> DataFrame:
    """Apply one batch (one row per key) effective on ``effective_date``.

    new key            -> first version, current
    changed attributes -> current version closed (valid_to = date - 1) and
                          a new current version opened with the same
                          entity_key; a change on the version's own first
                          day replaces it in place (C17)
    unchanged / absent -> untouched
    Closed history is never touched: at scale, partition the state by
    ``is_current`` so only the current partition is rewritten.
    """
    eff = F.to_date(F.lit(effective_date)) if isinstance(effective_date, str) else effective_date
    history = state.filter(~F.col("is_current"))
    cur = state.filter(F.col("is_current")).alias("s")
    b = _conform(batch, state, keys + attrs).alias("b")
    cond = [F.col(f"s.{k}") == F.col(f"b.{k}") for k in keys]
    j = cur.join(b, cond, "full_outer")
    in_s = F.col("s.entity_key").isNotNull()
    in_b = reduce(lambda x, y: x & y, [F.col(f"b.{k}").isNotNull() for k in keys])
    changed = in_s & in_b & _differs(attrs, "s", "b")
    same_day = F.col("s.valid_from") == eff

    state_cols = [F.col(f"s.{c}").alias(c) for c in keys + attrs + SCD2_COLS]
    kept = j.filter(in_s & ~changed).select(*state_cols)
    closed = (j.filter(changed & ~same_day).select(*state_cols)
                .withColumn("valid_to", F.date_sub(eff, 1)).withColumn("is_current", F.lit(False)))
    # a changed key keeps its entity key; a new key gets one from its business key
    entity = F.coalesce(F.col("s.entity_key"), surrogate_key(*[F.col(f"b.{k}") for k in keys]))
    opened = (j.filter((in_b & ~in_s) | changed)
                .select(*[F.col(f"b.{c}").alias(c) for c in keys + attrs], entity.alias("entity_key"))
                .withColumn("valid_from", eff)
                .withColumn("valid_to", F.lit(None).cast("date"))
                .withColumn("is_current", F.lit(True))
                .withColumn("version_key", surrogate_key(*keys, "valid_from")))
    cols = keys + attrs + SCD2_COLS
    return (history.select(*cols).unionByName(kept.select(*cols))
                   .unionByName(closed.select(*cols)).unionByName(opened.select(*cols)))


def scd1_upsert(state: DataFrame, batch: DataFrame, keys: list[str], attrs: list[str]) -> DataFrame:
    """Overwrite in place. The whole batch row wins when its key is
    present (an update *to* NULL sticks); ``change`` says what happened."""
    s = state.select(*keys, *attrs).alias("s")
    b = _conform(batch, state, keys + attrs).alias("b")
    cond = [F.col(f"s.{k}") == F.col(f"b.{k}") for k in keys]
    j = s.join(b, cond, "full_outer")
    in_b = reduce(lambda x, y: x & y, [F.col(f"b.{k}").isNotNull() for k in keys])
    in_s = reduce(lambda x, y: x & y, [F.col(f"s.{k}").isNotNull() for k in keys])
    change = (F.when(in_b & ~in_s, F.lit("insert"))
               .when(in_b & _differs(attrs, "s", "b"), F.lit("update"))
               .otherwise(F.lit("unchanged")))
    out = [F.when(in_b, F.col(f"b.{c}")).otherwise(F.col(f"s.{c}")).alias(c) for c in keys + attrs]
    return j.select(*out, change.alias("change"))


def asof_version_join(events: DataFrame, versions: DataFrame, keys: list[str], event_date: str,
                      bucket: str = "month", span: tuple[str, str] = (CALENDAR_START, CALENDAR_END)) -> DataFrame:
    """Each event gets the version valid on its date
    (``valid_from <= d`` and (``valid_to`` is NULL or ``d <= valid_to``)).

    Events and versions are united, sorted once by (key, ``bucket``) and day, and the
    last version is carried forward. A version stands in each bucket (week, month or year) that it
    overlaps, so a bucket needs nothing of the one before it and a hot key is
    split by time; its copies number versions + buckets spanned. Dates outside ``span``
    belong to its first or last bucket: the span bounds the copies of open and old
    versions, and no result depends on it. Versions of a key must be disjoint, as type-2
    versions are. An event without a date, before its key's first version, in a gap or
    of a key without versions has no version and is left out, as is a null key."""
    vcols = [c for c in versions.columns if c not in keys]
    first, last = (F.lit(d).cast("date") for d in span)
    at = lambda d: F.trunc(F.least(F.greatest(d, first), last), bucket)
    known = [F.col(k).isNotNull() for k in keys]
    vf, vt = F.col("valid_from").cast("date"), F.col("valid_to").cast("date")

    v = (versions.filter(reduce(lambda x, y: x & y, known, vf.isNotNull() & (vt.isNull() | (vf <= vt))))
         .select(*keys, F.explode(F.sequence(at(vf), at(F.coalesce(vt, last)), F.expr(f"INTERVAL 1 {bucket}"))).alias("__bucket"),
                 vf.alias("__day"), F.lit(0).alias("__kind"), F.struct(*vcols).alias("__version")))
    e = (events.filter(reduce(lambda x, y: x & y, known, F.col(event_date).isNotNull()))
         .select(*keys, at(F.col(event_date).cast("date")).alias("__bucket"), F.col(event_date).cast("date").alias("__day"),
                 F.lit(1).alias("__kind"), F.struct(*events.columns).alias("__event")))
    carried = (Window.partitionBy(*keys, "__bucket").orderBy("__day", "__kind")
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    met = (v.unionByName(e, allowMissingColumns=True)
           .withColumn("__version", F.last("__version", ignorenulls=True).over(carried))
           .filter((F.col("__kind") == 1) & F.col("__version").isNotNull()))
    until = F.col("__version.valid_to").cast("date")
    return (met.filter(until.isNull() | (F.col("__day") <= until))
            .select(*[F.col("__event")[c].alias(c) for c in events.columns], *[F.col("__version")[c].alias(c) for c in vcols]))


def scd2_apply_log(versions: DataFrame, daily: DataFrame, log: DataFrame, keys: list[str],
                   attrs: list[str], day: Column, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """Fold a new slice of change log -- possibly late or back-dated -- into
    a type-2 state kept as (versions, daily points). Only keys present in
    the slice are touched: their daily points are merged with the slice's
    (the later event of a day wins, by the log's order), and their
    versions are derived again; every other key passes through. The result
    equals ``scd2_from_change_log`` over the whole log.
    Returns (new versions, new daily points)."""
    fresh = daily_points(log, keys, attrs, day, order)
    touched = fresh.select(*keys).distinct()
    both = daily.join(touched, keys, "left_semi").unionByName(fresh)
    pick = F.max_by(F.struct(*attrs, F.col("__order")), F.col("__order"))
    merged = (both.groupBy(*keys, "valid_from").agg(pick.alias("__a"))
                  .select(*keys, "valid_from", *[F.col(f"__a.{a}").alias(a) for a in attrs],
                          F.col("__a.__order").alias("__order")))
    new_daily = daily.join(touched, keys, "left_anti").unionByName(merged)
    rebuilt = versions_from_daily(merged, keys, attrs)
    new_versions = versions.join(touched, keys, "left_anti").select(*rebuilt.columns).unionByName(rebuilt)
    return new_versions, new_daily
