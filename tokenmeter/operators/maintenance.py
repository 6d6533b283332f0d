"""Ledger and dimension maintenance (O-04, O-06, O-07, O-08) and the ledger
integrity report (O-34).  Each returns the new relation; persisting it is the
caller's (``sources.store``): a new table version, never the path being read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenmeter.functions.literals import ts_ntz
from tokenmeter.params import DEFAULT_GROUP, DEFAULT_TIERS, Clock
from tokenmeter.sources.schemas import GROUPS, LIMITS, VARCHAR_LIMITS


def default_tiers(spark: SparkSession) -> DataFrame:
    rows = [(g, d, m, None, None, None, desc) for g, d, m, desc in DEFAULT_TIERS]
    return spark.createDataFrame(rows, LIMITS)


def seed_limits(existing: DataFrame, seed: DataFrame, now: Column | None = None) -> DataFrame:
    """O-04 insert-if-absent: existing tiers keep all their columns (G24); seed
    tiers not present are added, with the table's defaults (creation and update
    time).  A repeated key within the seed keeps its first occurrence (S23): the
    seed is a small literal list, ranked by its given order."""
    values = [c for c in seed.columns if c != "group_name"]
    first = seed.withColumn("__pos", F.monotonically_increasing_id()).groupBy("group_name").agg(
        F.min_by(F.struct(*values), F.col("__pos")).alias("v")
    ).select("group_name", "v.*")
    new = first.join(existing.select("group_name"), "group_name", "left_anti")
    if now is not None:
        new = new.withColumns({c: F.coalesce(F.col(c), now) for c in ("created_at", "updated_at")})
    return existing.unionByName(new, allowMissingColumns=True)


def new_users(known: DataFrame, ledger_rows: DataFrame, default_group: str = DEFAULT_GROUP,
              assigned_at: Column | None = None) -> DataFrame:
    """Tier rows (all columns of GROUPS) for the users of ``ledger_rows`` that
    ``known`` (user_id) does not have.  Distinct users first (partial
    aggregate), then an anti-join on user_id."""
    users = ledger_rows.select("user_id").filter(F.col("user_id").isNotNull()).distinct()
    at = assigned_at if assigned_at is not None else F.lit(None)
    values = {"group_name": F.lit(default_group), "assigned_at": at}
    columns = [values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in GROUPS.fields if f.name != "user_id"]
    return users.join(known.select("user_id"), "user_id", "left_anti").select("user_id", *columns)


def register_first_seen(groups: DataFrame, ledger_rows: DataFrame, default_group: str = DEFAULT_GROUP,
                        assigned_at: Column | None = None) -> DataFrame:
    """O-06: every user of ``ledger_rows`` without a tier row gets one in the
    default tier, assigned now; existing rows are untouched in all columns."""
    return groups.unionByName(new_users(groups, ledger_rows, default_group, assigned_at), allowMissingColumns=True)


def upsert_groups(groups: DataFrame, batch: DataFrame, clock: Clock) -> DataFrame:
    """O-07: ``INSERT ... ON CONFLICT (user_id) DO UPDATE SET group_name,
    assigned_at``.  On conflict only the tier and the time change;
    ``assigned_by`` and ``notes`` keep their old values (G23).  D5: a user
    repeated within the batch fails the job, as the reference's statement
    does, instead of picking a winner."""
    b = batch.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("__n"),
        F.any_value("group_name").alias("__g"),
        F.any_value("assigned_by").alias("__by"),
        F.any_value("notes").alias("__notes"),
    )
    b = b.withColumn("__check", F.assert_true(F.col("__n") == 1, F.lit("upsert batch repeats a user_id")))
    j = groups.join(b, "user_id", "full_outer")
    now = ts_ntz(clock.as_of)
    in_batch = F.col("__n").isNotNull()
    existed = F.col("group_name").isNotNull()
    return j.select(
        "user_id",
        F.when(in_batch, F.col("__g")).otherwise(F.col("group_name")).alias("group_name"),
        F.when(in_batch, now).otherwise(F.col("assigned_at")).alias("assigned_at"),
        F.when(existed, F.col("assigned_by")).otherwise(F.col("__by")).alias("assigned_by"),
        F.when(existed, F.col("notes")).otherwise(F.col("__notes")).alias("notes"),
        F.col("__check").isNull().alias("__ok"),
    ).filter(F.col("__ok") | F.col("__ok").isNull()).drop("__ok")


def expired(clock: Clock, days: int):
    """Strictly older than ``now - days`` (G11 keeps the cutoff itself).
    NULL ``recorded_at`` is never expired (S10)."""
    return F.coalesce(F.col("recorded_at") < ts_ntz(clock.cutoff(days)), F.lit(False))


def retention_kept(ledger: DataFrame, clock: Clock, days: int) -> DataFrame:
    """O-08: rows that survive the purge."""
    return ledger.filter(~expired(clock, days))


def retention_deleted_count(ledger: DataFrame, clock: Clock, days: int) -> DataFrame:
    """O-08: the purge's return value (rows deleted), one row."""
    return ledger.agg(F.count(F.when(expired(clock, days), F.lit(1))).alias("deleted_count"))


def ledger_violations(ledger: DataFrame) -> DataFrame:
    """O-34: rows the reference's table would reject or that break its
    invariants: NOT NULL columns, VARCHAR lengths, total = prompt + completion.
    One row per (ledger row, violation)."""
    checks = [
        (F.col("user_id").isNull(), "user_id is null"),
        (F.col("prompt_tokens").isNull(), "prompt_tokens is null"),
        (F.col("completion_tokens").isNull(), "completion_tokens is null"),
        (F.col("total_tokens").isNull(), "total_tokens is null"),
        (
            F.col("total_tokens") != F.try_add(F.col("prompt_tokens"), F.col("completion_tokens")),
            "total_tokens <> prompt_tokens + completion_tokens",
        ),
    ]
    for c, n in VARCHAR_LIMITS.items():
        if c in ledger.columns:
            checks.append((F.length(F.col(c)) > n, f"{c} longer than {n}"))
    labels = F.array(*[F.when(cond, F.lit(name)) for cond, name in checks])
    return ledger.select("id", "user_id", F.explode(F.array_compact(labels)).alias("violation"))
