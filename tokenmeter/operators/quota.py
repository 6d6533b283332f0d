"""Quota status: the summary views (O-20, O-21, O-31, O-32), the per-user
status function over a set of ids (O-19, O-22, O-23, O-33) and the tier
integrity report (O-25).

Join strategy: the tier table holds a handful of rows; it is left to AQE's
size-checked broadcast (``autoBroadcastJoinThreshold``), which falls back to a
shuffle join if a tier table is ever large.  User-keyed relations (tier
assignments, per-user totals, requested ids) are all aggregated or distinct
on ``user_id``, so they meet in co-partitioned joins on that key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tokenmeter.functions.quota import is_over, view_percent
from tokenmeter.operators.rollups import period_totals
from tokenmeter.params import (
    FALLBACK_DAILY_LIMIT,
    FALLBACK_MONTHLY_LIMIT,
    NEAR_LIMIT_PERCENT,
    Clock,
    QuotaSettings,
)

SUMMARY_COLUMNS = [
    "user_id",
    "group_name",
    "daily_token_limit",
    "monthly_token_limit",
    "tokens_today",
    "tokens_this_month",
    "daily_percent_used",
    "monthly_percent_used",
]


def _limits(limits: DataFrame) -> DataFrame:
    return limits.select("group_name", "daily_token_limit", "monthly_token_limit")


def usage_summary(ledger: DataFrame, groups: DataFrame, limits: DataFrame, clock: Clock) -> DataFrame:
    """O-32: one row per user that has a tier row whose tier exists."""
    return summary_of(period_totals(ledger, clock), groups, limits)


def summary_of(totals: DataFrame, groups: DataFrame, limits: DataFrame) -> DataFrame:
    """O-32 over given period totals (user_id, tokens_today, tokens_this_month),
    e.g. those a ``UsageStore`` maintains."""
    tiered = groups.select("user_id", "group_name").join(_limits(limits), "group_name")
    s = tiered.join(totals, "user_id", "left")
    today = F.coalesce(F.col("tokens_today"), F.lit(0).cast("long"))
    month = F.coalesce(F.col("tokens_this_month"), F.lit(0).cast("long"))
    return s.select(
        "user_id",
        "group_name",
        "daily_token_limit",
        "monthly_token_limit",
        today.alias("tokens_today"),
        month.alias("tokens_this_month"),
        view_percent(today, F.col("daily_token_limit")).alias("daily_percent_used"),
        view_percent(month, F.col("monthly_token_limit")).alias("monthly_percent_used"),
    )


def near_limit(summary: DataFrame) -> DataFrame:
    """O-18: strictly above the fixed 80 % on either window."""
    return summary.filter(
        (F.col("daily_percent_used") > NEAR_LIMIT_PERCENT) | (F.col("monthly_percent_used") > NEAR_LIMIT_PERCENT)
    )


def near_order() -> list[Column]:
    return [F.col("monthly_percent_used").desc(), F.col("daily_percent_used").desc(), F.col("user_id")]


def users_near_limit(ledger: DataFrame, groups: DataFrame, limits: DataFrame, clock: Clock) -> DataFrame:
    """O-18 + O-31: near-limit users, monthly percent then daily percent
    descending; ``user_id`` breaks ties so the order is total.  The sort is a
    range-partitioned distributed sort."""
    return near_limit(usage_summary(ledger, groups, limits, clock)).orderBy(*near_order())


def ranked_near_limit(near: DataFrame) -> DataFrame:
    """O-31 as a column: ``position`` 1, 2, ... in the view's order.  Numbers
    are dealt per range partition on top of the partitions' counts, so the
    rows are never gathered into one task."""
    from tokenmeter.sources.store import write_version

    spark = near.sparkSession
    parts = near.orderBy(*near_order()).withColumns({"__part": F.spark_partition_id(), "__row": F.monotonically_increasing_id()})
    rows = spark.read.schema(parts.schema).parquet(write_version(parts, spark, "near-limit"))
    sizes = rows.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))  # one row per range
    ahead = sizes.withColumn("__ahead", F.sum("__n").over(Window.orderBy("__part")) - F.col("__n"))
    own = F.row_number().over(Window.partitionBy("__part").orderBy("__row"))
    return rows.withColumn("__own", own).join(ahead, "__part").withColumn("position", F.col("__ahead") + F.col("__own")).select(*near.columns, "position")


def user_status(ledger: DataFrame, groups: DataFrame, limits: DataFrame, clock: Clock,
                settings: QuotaSettings = QuotaSettings(), users: DataFrame | list[str] | None = None) -> DataFrame:
    """One row per user that has a tier row or usage this month: tier, limits
    and period totals.  With ``users`` (a relation or a list of ids) only their
    ledger and tier rows are read: the ids filter below the aggregate."""
    if isinstance(users, list):
        ledger, groups = ledger.filter(F.col("user_id").isin(users)), groups.filter(F.col("user_id").isin(users))
    elif users is not None:
        ledger, groups = ledger.join(users, "user_id", "left_semi"), groups.join(users, "user_id", "left_semi")
    return status_of(period_totals(ledger, clock), groups, limits, settings)


def status_of(totals: DataFrame, groups: DataFrame, limits: DataFrame, settings: QuotaSettings = QuotaSettings()) -> DataFrame:
    """The rows of ``user_status`` over given period totals."""
    both = groups.select("user_id", "group_name").join(totals, "user_id", "full_outer")
    tier = F.coalesce(F.col("group_name"), F.lit(settings.default_group))
    return both.withColumn("group_name", tier).join(_limits(limits), "group_name", "left").select(
        "user_id", "group_name", F.coalesce("daily_token_limit", F.lit(FALLBACK_DAILY_LIMIT).cast("long")).alias("daily_limit"),
        F.coalesce("monthly_token_limit", F.lit(FALLBACK_MONTHLY_LIMIT).cast("long")).alias("monthly_limit"), "tokens_today", "tokens_this_month",
    )


def with_status(
    rows: DataFrame,
    ledger: DataFrame,
    groups: DataFrame,
    limits: DataFrame,
    clock: Clock,
    settings: QuotaSettings = QuotaSettings(),
    known: Column | None = None,
    users: DataFrame | list[str] | None = None,
) -> DataFrame:
    """O-33's status columns added to every row of ``rows`` (keyed by
    ``user_id``; any number of rows per user), by ONE join on ``user_id`` with
    the per-user status table.  The table's key is renewed by an expression, so
    the planner shuffles it for this join alone: then both sides are plain
    shuffles and AQE can split a user with a third of the rows.

    Unknown users and users without a tier row get the default tier (D2); a
    tier missing from ``usage_limits`` gets the fallback limits 1M / 10M.
    Rows where ``known`` is false get NULL status columns."""
    table = user_status(ledger, groups, limits, clock, settings, users)
    table = table.withColumn("user_id", F.concat(F.col("user_id"), F.lit("")))
    s = rows.join(table, "user_id", "left")
    default = _limits(limits).filter(F.col("group_name") == settings.default_group)

    def limit(column: str, source: str, fallback: int) -> Column:
        # A user without any row: the default tier's limit, one scalar.
        of_default = default.agg(F.max(source)).scalar()
        return F.coalesce(F.col(column), of_default, F.lit(fallback).cast("long"))

    daily = limit("daily_limit", "daily_token_limit", FALLBACK_DAILY_LIMIT)
    monthly = limit("monthly_limit", "monthly_token_limit", FALLBACK_MONTHLY_LIMIT)
    today = F.coalesce(F.col("tokens_today"), F.lit(0).cast("long"))
    month = F.coalesce(F.col("tokens_this_month"), F.lit(0).cast("long"))
    figures = s.select(*rows.columns, F.coalesce("group_name", F.lit(settings.default_group)).alias("group_name"), daily.alias("daily_limit"),
                       monthly.alias("monthly_limit"), today.alias("tokens_today"), month.alias("tokens_this_month"))
    status = {c: F.col(c) for c in ("group_name", "daily_limit", "monthly_limit", "tokens_today", "tokens_this_month")}
    status["is_over_daily"] = is_over(F.col("tokens_today"), F.col("daily_limit"))
    status["is_over_monthly"] = is_over(F.col("tokens_this_month"), F.col("monthly_limit"))
    if known is not None:
        status = {k: F.when(known, v) for k, v in status.items()}
    return figures.select(*rows.columns, *[v.alias(k) for k, v in status.items()])


STATUS_COLUMNS = ["user_id", "group_name", "daily_limit", "monthly_limit", "tokens_today", "tokens_this_month",
                  "is_over_daily", "is_over_monthly"]


def user_usage_status(
    ids: DataFrame | list[str],
    ledger: DataFrame,
    groups: DataFrame,
    limits: DataFrame,
    clock: Clock,
    settings: QuotaSettings = QuotaSettings(),
) -> DataFrame:
    """O-33 over a set of user ids: every distinct requested id gets a row.
    Only the requested users' rows are aggregated: a list of ids reaches the
    scan as a filter, a relation of ids is semi-joined first."""
    if isinstance(ids, list):
        wanted = ledger.sparkSession.createDataFrame([(u,) for u in dict.fromkeys(ids)], "user_id string")
        return with_status(wanted, ledger, groups, limits, clock, settings, users=list(dict.fromkeys(ids))).select(*STATUS_COLUMNS)
    wanted = ids.select("user_id").distinct()
    return with_status(wanted, ledger, groups, limits, clock, settings, users=wanted).select(*STATUS_COLUMNS)


def orphan_groups(groups: DataFrame, limits: DataFrame) -> DataFrame:
    """O-25: tier assignments whose tier has no quota row (the foreign key of
    the reference, re-aimed as a report)."""
    return groups.select("user_id", "group_name").join(_limits(limits).select("group_name"), "group_name", "left_anti")
