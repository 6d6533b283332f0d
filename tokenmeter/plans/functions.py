"""The reference's functions, callable from SQL: table functions over the named
views, with one row of arguments or, by LATERAL, per row of any relation.

``get_user_usage_status`` is decorrelated by the optimizer into joins on the user
id: a relation of ids costs one aggregate of the month's ledger, not one a row.
``record_usage`` makes the ledger row of a response, for INSERT INTO;
``kept_usage_records`` and ``cleanup_old_usage_records`` are the purge's result
and its count."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tokenmeter.operators.rollups import period_totals
from tokenmeter.params import DEFAULT_GROUP, DEFAULT_REQUEST_TYPE, DEFAULT_RETENTION_DAYS, FALLBACK_DAILY_LIMIT, FALLBACK_MONTHLY_LIMIT, UNLIMITED, Clock
from tokenmeter.plans.views import register_views

NAMES = ["get_user_usage_status", "record_usage", "kept_usage_records", "cleanup_old_usage_records"]


def register_functions(spark: SparkSession, ledger: DataFrame, groups: DataFrame, limits: DataFrame, clock: Clock,
                       totals: DataFrame | None = None, default_group: str = DEFAULT_GROUP) -> list[str]:
    """Views and functions as of ``clock``; ``totals`` (user_id, tokens_today,
    tokens_this_month) may come from maintained sums."""
    register_views(spark, ledger, groups, limits, clock)
    totals = period_totals(ledger, clock) if totals is None else totals
    groups.select("user_id", "group_name").join(totals, "user_id", "full_outer").createOrReplaceTempView("user_standing")
    daily, monthly = f"coalesce(l.daily_token_limit, {FALLBACK_DAILY_LIMIT})", f"coalesce(l.monthly_token_limit, {FALLBACK_MONTHLY_LIMIT})"
    now = f"TIMESTAMP_NTZ '{clock.as_of.isoformat(sep=' ')}'"
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION get_user_usage_status(p_user_id STRING)
        RETURNS TABLE (group_name STRING, daily_limit BIGINT, monthly_limit BIGINT, tokens_today BIGINT, tokens_this_month BIGINT,
                       is_over_daily BOOLEAN, is_over_monthly BOOLEAN)
        RETURN
        SELECT u.group_name, {daily}, {monthly}, u.tokens_today, u.tokens_this_month,
               {daily} <> {UNLIMITED} AND u.tokens_today >= {daily}, {monthly} <> {UNLIMITED} AND u.tokens_this_month >= {monthly}
        FROM (SELECT coalesce(max(s.group_name), '{default_group}') AS group_name, coalesce(max(s.tokens_today), 0) AS tokens_today,
                     coalesce(max(s.tokens_this_month), 0) AS tokens_this_month
              FROM user_standing s WHERE s.user_id = p_user_id) u
        LEFT JOIN usage_limits l ON u.group_name = l.group_name""")
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION record_usage(p_user_id STRING, p_prompt_tokens INT, p_completion_tokens INT,
            p_model_id STRING DEFAULT NULL, p_pipeline_id STRING DEFAULT NULL, p_chat_id STRING DEFAULT NULL)
        RETURNS TABLE (user_id STRING, recorded_at TIMESTAMP_NTZ, prompt_tokens INT, completion_tokens INT, total_tokens INT,
                       model_id STRING, pipeline_id STRING, chat_id STRING, request_type STRING)
        RETURN
        SELECT p_user_id, {now}, p_prompt_tokens, p_completion_tokens, try_add(p_prompt_tokens, p_completion_tokens),
               p_model_id, p_pipeline_id, p_chat_id, '{DEFAULT_REQUEST_TYPE}'
        WHERE p_user_id IS NOT NULL AND try_add(p_prompt_tokens, p_completion_tokens) IS NOT NULL""")
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ledger.schema.fields)
    gone = f"coalesce(recorded_at < {now} - make_dt_interval(days_to_keep), false)"
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION kept_usage_records(days_to_keep INT DEFAULT {DEFAULT_RETENTION_DAYS})
        RETURNS TABLE ({columns}) RETURN SELECT {", ".join(ledger.columns)} FROM usage_records WHERE NOT {gone}""")
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION cleanup_old_usage_records(days_to_keep INT DEFAULT {DEFAULT_RETENTION_DAYS})
        RETURNS TABLE (deleted_count BIGINT) RETURN SELECT count(*) FROM usage_records WHERE {gone}""")
    return NAMES
