"""Ledger rollups (O-26..O-30) and the current-period totals (O-16/17, O-28/29).

Every rollup is a hash aggregate: partial sums are combined map-side before
the shuffle, so a heavy user or day costs one pre-aggregated row per task, not
one task holding all of its rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenmeter.functions.literals import ts_ntz
from tokenmeter.params import Clock, DEFAULT_GROUP

LEDGER_READ = ["user_id", "recorded_at", "prompt_tokens", "completion_tokens", "total_tokens"]


def _sums() -> list[Column]:
    return [
        F.sum("prompt_tokens").alias("prompt_tokens"),
        F.sum("completion_tokens").alias("completion_tokens"),
        F.sum("total_tokens").alias("total_tokens"),
        F.count(F.lit(1)).alias("request_count"),
    ]


def ledger_scan(ledger: DataFrame) -> DataFrame:
    """O-01: the ledger projected to the columns the quota queries read."""
    return ledger.select(*LEDGER_READ)


def usage_daily(ledger: DataFrame) -> DataFrame:
    """O-26: sums and request count per (user, UTC date).  A NULL
    ``recorded_at`` forms its own NULL-date group."""
    return ledger.groupBy("user_id", F.to_date("recorded_at").alias("usage_date")).agg(*_sums())


def month_start_of(ts: Column) -> Column:
    """``DATE_TRUNC('month', ts)`` typed like the input (NTZ stays NTZ)."""
    return F.to_timestamp_ntz(F.trunc(F.to_date(ts), "month"))


def usage_monthly(ledger: DataFrame) -> DataFrame:
    """O-27: sums per (user, calendar month)."""
    return ledger.groupBy("user_id", month_start_of(F.col("recorded_at")).alias("usage_month")).agg(*_sums())


def _month_to_date(clock: Clock) -> Column:
    rec = F.col("recorded_at")
    return (rec >= ts_ntz(clock.month_start)) & (rec <= ts_ntz(clock.as_of))


def _today(clock: Clock) -> Column:
    rec = F.col("recorded_at")
    return (rec >= ts_ntz(clock.day_start)) & (rec <= ts_ntz(clock.as_of))


def tokens_today(ledger: DataFrame, clock: Clock) -> DataFrame:
    """O-16 + O-28: per-user total of the as-of day (rows after as_of excluded, D1)."""
    return ledger.filter(_today(clock)).groupBy("user_id").agg(F.sum("total_tokens").alias("tokens_today"))


def tokens_month_to_date(ledger: DataFrame, clock: Clock) -> DataFrame:
    """O-17 + O-29: per-user total from the first of the month to as_of."""
    return ledger.filter(_month_to_date(clock)).groupBy("user_id").agg(F.sum("total_tokens").alias("tokens_this_month"))


def period_totals(ledger: DataFrame, clock: Clock) -> DataFrame:
    """Today and month-to-date in ONE scan and one aggregate.

    The views compute the two with two filtered sub-aggregates, i.e. two scans
    of the ledger and two shuffles; Catalyst does not merge them.  The day is
    inside the month, so a conditional sum over the month's rows gives both.
    The month range is pushed to the Parquet scan (and prunes ``usage_date``
    partitions of a stored ledger).
    """
    rec = F.col("recorded_at")
    return (
        ledger.filter(_month_to_date(clock))
        .groupBy("user_id")
        .agg(
            F.sum(F.when(rec >= ts_ntz(clock.day_start), F.col("total_tokens"))).alias("tokens_today"),
            F.sum("total_tokens").alias("tokens_this_month"),
        )
    )


def usage_history_by_group(ledger: DataFrame, groups: DataFrame, default_group: str = DEFAULT_GROUP) -> DataFrame:
    """O-30: daily usage per tier.  Users without a tier row count under the
    default tier.  Aggregates per (user, day) first, so the join with the
    user dimension sees at most one row per user-day, never raw ledger rows."""
    daily = usage_daily(ledger)
    tiers = groups.select("user_id", "group_name")
    joined = daily.join(tiers, "user_id", "left").withColumn(
        "group_name", F.coalesce(F.col("group_name"), F.lit(default_group))
    )
    return joined.groupBy("group_name", "usage_date").agg(
        F.sum("prompt_tokens").alias("prompt_tokens"),
        F.sum("completion_tokens").alias("completion_tokens"),
        F.sum("total_tokens").alias("total_tokens"),
        F.sum("request_count").alias("request_count"),
        F.count(F.lit(1)).alias("active_users"),
    )
