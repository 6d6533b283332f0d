"""Usage extraction from chat bodies (O-10..O-15) and the ledger append
(O-05).  All narrow projections and filters: no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenmeter.functions import payload as P
from tokenmeter.params import DEFAULT_REQUEST_TYPE

EXTRACT_COLUMNS = ["conv_id", "user_id", "usage_blocked", "has_usage", "prompt_tokens", "completion_tokens",
                   "model_id", "chat_id"]


def usage_extract(bodies: DataFrame, key: str = "conv_id", user_col: str = "user_id", payload: str = "payload",
                  session_first: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """Per body: the resolved user (O-14: the id the inlet tagged, else the
    session user; empty counts as missing), whether it was blocked (O-13),
    the located usage (O-10) and its token counts with fallbacks (O-11; null
    where the chosen value is not a 32-bit integer).  ``session_first`` is for
    bodies that have yet to pass the inlet, which tags the session user over
    any tag.  ``keep`` passes slim input columns through.  The body is parsed
    once and does not travel on."""
    parsed = bodies.select(F.col(key).alias("conv_id"), F.col(user_col).alias("__user"), *keep, P.parsed_once(F.col(payload)).alias("__body"))
    b = F.col("__body")
    u = P.located_usage(b)
    tag, user = F.nullif(P.as_text(P.field(b, "_usage_user_id")), F.lit("")), F.nullif(F.col("__user"), F.lit(""))
    located = parsed.select(
        "conv_id",
        (F.coalesce(user, tag) if session_first else F.coalesce(tag, user)).alias("user_id"),
        P.truthy(P.field(b, "_usage_blocked")).alias("usage_blocked"),
        F.explode(F.array(u)).alias("__usage"),
        P.as_text(P.field(b, "model")).alias("model_id"),
        P.as_text(P.field(b, "chat_id")).alias("chat_id"),
        *keep,
    )
    has, usage = P.truthy(F.col("__usage")), F.col("__usage")
    return located.select(
        "conv_id", "user_id", "usage_blocked", has.alias("has_usage"),
        F.when(has, P.prompt_count(usage)).otherwise(F.lit(0)).alias("prompt_tokens"),
        F.when(has, P.completion_count(usage)).otherwise(F.lit(0)).alias("completion_tokens"),
        "model_id", "chat_id", *keep,
    )


def recordable(extracted: DataFrame) -> Column:
    """O-12..O-14: not blocked, a user, a usage object, counts that fit the
    ledger, one of them positive.  A negative count is kept when the other one
    is positive (S14)."""
    return (
        ~F.col("usage_blocked")
        & F.col("user_id").isNotNull()
        & F.col("has_usage")
        & F.col("prompt_tokens").isNotNull()
        & F.col("completion_tokens").isNotNull()
        & ((F.col("prompt_tokens") > 0) | (F.col("completion_tokens") > 0))
    )


def usage_recordable(extracted: DataFrame) -> DataFrame:
    return extracted.filter(recordable(extracted)).select("conv_id", "user_id", "prompt_tokens", "completion_tokens")


def record_usage(extracted: DataFrame, recorded_at: Column, id_col: str = "conv_id", pipeline_id: Column | None = None) -> DataFrame:
    """O-05 + O-15: ledger rows for the recordable responses.

    total = prompt + completion; a payload's own total is ignored (S13).  An
    INT overflow makes the reference's insert fail and the error is swallowed,
    so the row is dropped: ``try_add`` then a non-null filter.  Only ids,
    counts, time, model and chat are carried -- never content.  ``id`` is the
    source request key (stable under task retries, unlike a generated id).
    """
    rows = extracted.filter(recordable(extracted))
    total = F.try_add(F.col("prompt_tokens"), F.col("completion_tokens"))
    return rows.select(
        F.col(id_col).cast("long").alias("id"),
        "user_id",
        recorded_at.alias("recorded_at"),
        F.col("prompt_tokens").cast("int").alias("prompt_tokens"),
        F.col("completion_tokens").cast("int").alias("completion_tokens"),
        total.cast("int").alias("total_tokens"),
        "model_id",
        (pipeline_id if pipeline_id is not None else F.lit(None)).cast("string").alias("pipeline_id"),
        "chat_id",
        F.lit(DEFAULT_REQUEST_TYPE).alias("request_type"),
    ).filter(F.col("total_tokens").isNotNull())
