"""Spark schemas of the three stored relations and the usage payload."""

from __future__ import annotations

from pyspark.sql import types as T

# Ledger of token usage, one row per recorded response (append only).
LEDGER = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("user_id", T.StringType(), False),
        T.StructField("recorded_at", T.TimestampNTZType(), True),
        T.StructField("prompt_tokens", T.IntegerType(), False),
        T.StructField("completion_tokens", T.IntegerType(), False),
        T.StructField("total_tokens", T.IntegerType(), False),
        T.StructField("model_id", T.StringType(), True),
        T.StructField("pipeline_id", T.StringType(), True),
        T.StructField("chat_id", T.StringType(), True),
        T.StructField("request_type", T.StringType(), True),
    ]
)

# Quota per tier.
LIMITS = T.StructType(
    [
        T.StructField("group_name", T.StringType(), False),
        T.StructField("daily_token_limit", T.LongType(), False),
        T.StructField("monthly_token_limit", T.LongType(), False),
        T.StructField("rate_limit_rpm", T.IntegerType(), True),
        T.StructField("created_at", T.TimestampNTZType(), True),
        T.StructField("updated_at", T.TimestampNTZType(), True),
        T.StructField("description", T.StringType(), True),
    ]
)

# User -> tier, one row per user.
GROUPS = T.StructType(
    [
        T.StructField("user_id", T.StringType(), False),
        T.StructField("group_name", T.StringType(), False),
        T.StructField("assigned_at", T.TimestampNTZType(), True),
        T.StructField("assigned_by", T.StringType(), True),
        T.StructField("notes", T.StringType(), True),
    ]
)

# Declared column lengths of the stored relations (VARCHAR(n)).
VARCHAR_LIMITS = {
    "user_id": 255,
    "model_id": 255,
    "pipeline_id": 255,
    "chat_id": 255,
    "request_type": 50,
    "group_name": 50,
}
