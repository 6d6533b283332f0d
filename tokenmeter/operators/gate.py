"""The admission gate: per-request decisions against a status snapshot
(O-35..O-37) and the replay of a whole request log with feedback (O-44).

Decision precedence (S17): over a limit and blocking on and not an admin ->
'blocked'; else over and admin -> 'bypass'; else over -> 'advisory'; not over
-> 'allowed'.  Requests without a user id pass unchecked ('unidentified', S15).
The admin test is the exact, case-sensitive role 'admin' (S16).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tokenmeter.functions.quota import is_over, under
from tokenmeter.operators.prefix import Hierarchy, running_sums
from tokenmeter.operators.quota import with_status
from tokenmeter.params import (
    FALLBACK_DAILY_LIMIT,
    FALLBACK_MONTHLY_LIMIT,
    RESET_DAILY,
    RESET_MONTHLY,
    Clock,
    QuotaSettings,
)

DECISION_COLUMNS = [
    "id", "user_id", "role", "group_name", "daily_limit", "monthly_limit", "tokens_today", "tokens_this_month",
    "is_admin", "is_over_daily", "is_over_monthly", "outcome", "allowed", "limit_type", "used_tokens",
    "limit_tokens", "reset_info",
]


def has_user(col: str = "user_id") -> Column:
    return F.col(col).isNotNull() & (F.col(col) != "")


def is_admin(settings: QuotaSettings, role: Column | None = None) -> Column:
    role = F.coalesce(role if role is not None else F.col("role"), F.lit("user"))
    return F.lit(settings.admin_bypass) & (role == "admin")


def outcome_of(over: Column, admin: Column, settings: QuotaSettings) -> Column:
    return (
        F.when(~over, F.lit("allowed"))
        .when(F.lit(settings.enable_blocking) & ~admin, F.lit("blocked"))
        .when(admin, F.lit("bypass"))
        .otherwise(F.lit("advisory"))
    )


def gate_decisions(
    requests: DataFrame,
    ledger: DataFrame,
    groups: DataFrame,
    limits: DataFrame,
    clock: Clock,
    settings: QuotaSettings = QuotaSettings(),
) -> DataFrame:
    """O-35..O-37: each request checked against its user's status at ``as_of``
    -- requests that arrive together, before any of them is recorded (the
    reference records at response time, so concurrent requests all see the
    same status).  The status lookups join the requests directly; rows
    without a user get NULL status."""
    j = with_status(requests, ledger, groups, limits, clock, settings, known=has_user())
    admin = is_admin(settings)
    over = F.coalesce(F.col("is_over_daily"), F.lit(False)) | F.coalesce(F.col("is_over_monthly"), F.lit(False))
    daily_hit = F.coalesce(F.col("is_over_daily"), F.lit(False))
    outcome = F.when(~has_user(), F.lit("unidentified")).otherwise(outcome_of(over, admin, settings))
    return j.select(
        "id",
        "user_id",
        F.coalesce(F.col("role"), F.lit("user")).alias("role"),
        "group_name",
        "daily_limit",
        "monthly_limit",
        "tokens_today",
        "tokens_this_month",
        (admin & has_user()).alias("is_admin"),
        "is_over_daily",
        "is_over_monthly",
        outcome.alias("outcome"),
        (outcome != "blocked").alias("allowed"),
        F.when(over, F.when(daily_hit, F.lit("daily")).otherwise(F.lit("monthly"))).alias("limit_type"),
        F.when(over, F.when(daily_hit, F.col("tokens_today")).otherwise(F.col("tokens_this_month"))).alias("used_tokens"),
        F.when(over, F.when(daily_hit, F.col("daily_limit")).otherwise(F.col("monthly_limit"))).alias("limit_tokens"),
        F.when(over, F.when(daily_hit, F.lit(RESET_DAILY)).otherwise(F.lit(RESET_MONTHLY))).alias("reset_info"),
    )


# --------------------------------------------------------------------------
# O-44 gate replay


def calendar_keys(ts: str, bucket_seconds: int) -> list[Column]:
    """UTC month (date), day (days since epoch) and intra-day bucket."""
    t = F.col(ts)
    secs = F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t)
    return [
        F.trunc(F.to_date(t), "month").alias("__month"),
        F.unix_date(F.to_date(t)).alias("__day"),
        F.floor(secs / F.lit(bucket_seconds)).cast("int").alias("__bucket"),
    ]


def _tier_enricher(groups: DataFrame, limits: DataFrame, settings: QuotaSettings, carry: DataFrame | None = None):
    """Per-bucket lookups: the user's tier limits and, for a replay that
    continues earlier traffic, the carried usage of the bucket's month/day."""
    lim = limits.select("group_name", "daily_token_limit", "monthly_token_limit")
    zero = F.lit(0).cast("long")

    def enrich(per_bucket: DataFrame) -> DataFrame:
        t = per_bucket.join(groups.select("user_id", "group_name"), "user_id", "left").withColumn(
            "group_name", F.coalesce(F.col("group_name"), F.lit(settings.default_group))
        )
        t = t.join(lim, "group_name", "left")
        t = t.withColumn(
            "__dl", F.coalesce(F.col("daily_token_limit"), F.lit(FALLBACK_DAILY_LIMIT).cast("long"))
        ).withColumn(
            "__ml", F.coalesce(F.col("monthly_token_limit"), F.lit(FALLBACK_MONTHLY_LIMIT).cast("long"))
        ).drop("daily_token_limit", "monthly_token_limit")
        if carry is None:
            return t.select("*", zero.alias("__cm"), zero.alias("__cd"))
        days = carry.select("user_id", F.unix_date("day").alias("__day"), F.col("used").alias("__cd"))
        months = carry.groupBy("user_id", F.trunc("day", "month").alias("__month")).agg(F.sum("used").alias("__cm"))
        t = t.join(days, ["user_id", "__day"], "left").join(months, ["user_id", "__month"], "left")
        return t.withColumns({"__cm": F.coalesce("__cm", zero), "__cd": F.coalesce("__cd", zero)})

    return enrich


REPLAY_COLUMNS = [
    "id", "user_id", "requested_at", "role", "group_name", "total_tokens", "admitted", "outcome", "limit_type",
    "tokens_today_before", "tokens_month_before",
]

CALENDAR = Hierarchy(("user_id", "__month"), "__day", "__bucket", ("requested_at", "id"))


def _label(today: Column, month: Column, dl: Column, ml: Column) -> Column:
    """Which limit a request faced; daily wins when both are over (S2)."""
    return F.when(~under(today, dl), F.lit("daily")).when(~under(month, ml), F.lit("monthly"))


#: Buckets that a limit is crossed in are looked up by broadcast up to this
#: counted number, else by a shuffle join.
BROADCAST_BUCKETS = 100_000


def gate_replay(
    requests: DataFrame,
    groups: DataFrame,
    limits: DataFrame,
    settings: QuotaSettings = QuotaSettings(),
    bucket_seconds: int = 60,
    carry: DataFrame | None = None,
) -> DataFrame:
    """O-44: which requests of a time-ordered log would have been admitted,
    given that blocked requests record nothing.

    The hooks run one request at a time.  Once a counter has reached its limit,
    every later request of that day (or month) that a limit holds is blocked, as
    long as nothing takes the counter below the limit again: only requests that
    no limit holds still count, so they must not be negative.  Until then
    admitted usage equals all usage.  Hence, per (user, day) and ordered by
    (time, id):

      1. ``ud``  = usage of earlier requests that day;  pass_d = its highest
         value so far is under dl
      2. ``um``  = earlier month usage of requests passing step 1;
         admitted = pass_d and its highest value so far is under ml
      3. counters shown to the request (and its label) = earlier *admitted*
         usage that day / month.

    Without negative counts the highest value so far is the value itself.  Each
    step needs the step's usage in all earlier buckets (W seconds of one user),
    so the steps run on the bucket table: a bucket wholly below a limit counts
    all its usage, one wholly above it only that of requests no limit holds.
    Only the buckets in which a limit is crossed, at most one a day and one a
    month for each user, are looked at request by request (and, for their
    highest value, buckets with negative counts).  At the end the requests meet
    the bucket table once: that is the only time the whole log is shuffled.  The
    bucket table is written to ``spark.checkpoint.dir`` after steps 1 and 2; after
    step 3 only the sums of the crossed buckets are, so the plan that is returned
    reads the log once.

    User-months in which some requests are held by a limit and others, held by
    none, have negative counts go through ``replay_composed``.  Tiers are constant (looked
    up once per user).  Requests without a user id or a time are not part of a
    replay.

    ``carry`` (user_id, day, used) continues earlier traffic: each user's
    usage admitted before this log, per day.  The day's and the month's sum are
    offsets on the running sums, looked up per bucket.
    """
    from tokenmeter.sources.store import cut_lineage

    keys = CALENDAR.keys
    tok = F.coalesce(F.col("total_tokens"), F.lit(0)).cast("long")
    zero = F.lit(0).cast("long")
    reqs = requests.filter(has_user() & F.col("requested_at").isNotNull()).select(
        "id", "user_id", "requested_at", F.coalesce(F.col("role"), F.lit("user")).alias("role"), "total_tokens",
        *calendar_keys("requested_at", bucket_seconds),
    )
    admin = is_admin(settings)
    free = ~F.lit(settings.enable_blocking) | admin  # no limit holds these
    in_bucket = Window.partitionBy(*keys).orderBy(*CALENDAR.order)
    within, upto_here = in_bucket.rowsBetween(Window.unboundedPreceding, -1), in_bucket.rowsBetween(Window.unboundedPreceding, 0)
    month = Window.partitionBy(*CALENDAR.partition)
    in_month = month.orderBy(CALENDAR.coarse, CALENDAR.fine).rowsBetween(Window.unboundedPreceding, -1)
    in_day = Window.partitionBy(*CALENDAR.partition, CALENDAR.coarse).orderBy(CALENDAR.fine).rowsBetween(Window.unboundedPreceding, -1)

    def earlier(b: DataFrame, value: str, day: str, so_far: str) -> DataFrame:
        """Sums of ``value`` over the earlier buckets of the day and month, with
        what is carried into them."""
        days = month.orderBy(CALENDAR.coarse).rangeBetween(Window.unboundedPreceding, -1)
        upto, before = F.coalesce(F.sum(value).over(in_month), zero), F.coalesce(F.sum(value).over(days), zero)
        return b.withColumns({day: upto - before + F.col("__cd"), so_far: upto + F.col("__cm")})

    def highest(value: Column) -> Column:
        return F.max(value).over(upto_here) if negative else value

    def by_request(b: DataFrame) -> DataFrame:
        """The requests of the buckets ``b``, with the bucket's columns and the
        step sums within it."""
        r = reqs.join(b, keys).withColumn("__a", F.coalesce(F.sum(tok).over(within), zero))
        r = r.withColumn("__pass", free | under(F.greatest("__top_d", highest(F.col("__a")) + F.col("__ud")), F.col("__dl")))
        r = r.withColumn("__b", F.coalesce(F.sum(F.when(F.col("__pass"), tok)).over(within), zero))
        if "__um" not in b.columns:
            return r
        return r.withColumn("admitted", F.col("__pass") & (free | under(F.greatest("__top_m", highest(F.col("__b")) + F.col("__um")), F.col("__ml"))))

    def few(b: DataFrame, n: int) -> DataFrame:
        return F.broadcast(b) if n <= BROADCAST_BUCKETS else b

    def crossed(b: DataFrame, where: Column, n: int, flag: str) -> DataFrame:
        """``b`` with ``__part`` and ``__part_peak``: the tokens that pass
        ``flag`` in the ``n`` buckets ``where`` a limit is crossed, and the
        highest value of their running sum."""
        if not n:
            return b.withColumns({"__part": zero, "__part_peak": zero})
        r = by_request(few(b.filter(where), n))
        after = F.col("__b") + F.when(F.col("__pass"), tok).otherwise(zero)
        sums = r.groupBy(*keys).agg(F.sum(F.when(F.col(flag), tok).otherwise(zero)).alias("__part"), F.max(after).alias("__part_peak"))
        return b.join(cut_lineage(sums) if "__um" in b.columns else sums, keys, "left").withColumns({c: F.coalesce(c, zero) for c in ("__part", "__part_peak")})

    held = F.when(~free, F.lit(1))
    buckets = reqs.groupBy(*keys).agg(
        F.sum(tok).alias("__all"), F.sum(F.when(free, tok).otherwise(zero)).alias("__free"), F.min("total_tokens").alias("__min_tok"),
        F.min(F.when(free, F.col("total_tokens"))).alias("__min_free"), F.count(held).alias("__held"))
    b = _tier_enricher(groups, limits, settings, carry)(buckets)
    # No count at all in a month (all NULL) is not a negative one.
    composed = F.coalesce(F.min("__min_free").over(month) < 0, F.lit(False)) & (F.sum("__held").over(month) > 0)
    b = b.withColumns({"__composed": composed, "__peaky": ~composed & F.coalesce(F.col("__min_tok") < 0, F.lit(False))})
    b = cut_lineage(earlier(b.drop("__min_tok", "__min_free", "__held"), "__all", "__ud", "__unused").drop("__unused"))
    plain_day = ~F.col("__composed") & under(F.col("__ud"), F.col("__dl")) & ~under(F.col("__ud") + F.col("__all"), F.col("__dl"))
    n_composed, n_peaky, n_day = b.agg(*[F.count(F.when(c, 1)) for c in (F.col("__composed"), F.col("__peaky"), plain_day)]).first()
    negative = n_peaky > 0

    top_d, peak = F.col("__ud"), F.col("__all")
    if negative:
        sums = reqs.join(few(b.filter("__peaky").select(*keys), n_peaky), keys).withColumn("__a", F.sum(tok).over(upto_here))
        b = b.join(sums.groupBy(*keys).agg(F.max("__a").alias("__peak")), keys, "left").withColumn("__peak", F.coalesce("__peak", "__all"))
        top_d, peak = F.greatest("__cd", "__ud", F.max(F.col("__ud") + F.col("__peak")).over(in_day)), F.col("__peak")
    b = b.withColumns({"__top_d": top_d, "__peak": peak})
    day_all = under(F.greatest("__top_d", F.col("__ud") + F.col("__peak")), F.col("__dl"))
    day_none = ~under(F.col("__top_d"), F.col("__dl"))
    day_mixed = ~F.col("__composed") & ~day_all & ~day_none
    if negative:
        b = cut_lineage(b)
        n_day = b.filter(day_mixed).count()
    b = crossed(b, day_mixed, n_day, "__pass")
    two = lambda all_, part, none: F.when(day_all, all_).when(day_none, none).otherwise(part)
    b = b.withColumns({"__two": two(F.col("__all"), F.col("__part"), F.col("__free")), "__peak_two": two(F.col("__peak"), F.col("__part_peak"), F.col("__free"))})
    b = earlier(b.drop("__part", "__part_peak"), "__two", "__unused", "__um").drop("__unused")
    top_m = F.greatest("__cm", "__um", F.max(F.col("__um") + F.col("__peak_two")).over(in_month)) if negative else F.col("__um")
    b = cut_lineage(b.withColumn("__top_m", top_m))
    month_all = under(F.greatest("__top_m", F.col("__um") + F.col("__peak_two")), F.col("__ml"))
    month_none = ~under(F.col("__top_m"), F.col("__ml"))
    mixed = day_mixed | (~F.col("__composed") & ~month_all & ~month_none)
    b = crossed(b, mixed, b.filter(mixed).count(), "admitted").drop("__part_peak")
    b = b.withColumn("__three", F.when(mixed, F.col("__part")).when(day_all & month_all, F.col("__all")).otherwise(F.col("__free"))).drop("__part")
    b = earlier(b, "__three", "__today", "__this_month")

    s = by_request(b.filter(~F.col("__composed")) if n_composed else b)
    s = s.withColumn("__c", F.coalesce(F.sum(F.when(F.col("admitted"), tok)).over(within), zero))
    today, so_far = F.col("__c") + F.col("__today"), F.col("__c") + F.col("__this_month")
    label = _label(today, so_far, F.col("__dl"), F.col("__ml"))
    closed = s.select(
        "id", "user_id", "requested_at", "role", "group_name", "total_tokens", "admitted",
        F.when(~F.col("admitted"), F.lit("blocked"))
        .when(label.isNull(), F.lit("allowed"))
        .when(admin, F.lit("bypass"))
        .otherwise(F.lit("advisory"))
        .alias("outcome"),
        label.alias("limit_type"),
        today.alias("tokens_today_before"),
        so_far.alias("tokens_month_before"),
    )
    if not n_composed:
        return closed
    return closed.unionByName(replay_composed(reqs.join(b.filter("__composed").select(*keys, "group_name", "__dl", "__ml", "__cm", "__cd"), keys), settings))


def replay_composed(rows: DataFrame, settings: QuotaSettings) -> DataFrame:
    """Replay of any counts as a prefix scan over functions (``functions.scan``):
    each bucket is a function of the room left under the limits, a day the
    composition of its buckets, a month an evaluation of its days in turn; the
    usage found when a day and then a bucket begins goes down the same way, and
    each bucket is stepped through on its own.  No group holds a user-month.
    ``rows`` carry the calendar keys, the tier limits (``__dl``, ``__ml``)
    and the carried usage of their month and day (``__cm``, ``__cd``)."""
    from tokenmeter.functions import scan
    from tokenmeter.functions.sequential import REPLAY_SCHEMA, replay_fn
    from tokenmeter.sources.store import cut_lineage

    figures = {"daily_limit": "__dl", "monthly_limit": "__ml", "carry_day": "__cd", "carry_month": "__cm"}
    admin = is_admin(settings)
    rows = rows.select(
        "id", "user_id", "requested_at", "role", "group_name", "total_tokens", admin.alias("is_admin"),
        (~F.lit(settings.enable_blocking) | admin).alias("free"), F.coalesce("total_tokens", F.lit(0)).cast("long").alias("tok"),
        F.col("__month").alias("month_key"), F.col("__day").cast("int").alias("day_key"), F.col("__bucket").alias("bucket_key"),
        *[F.col(source).alias(name) for name, source in figures.items()],
    )
    bucket, day = ["user_id", "month_key", "day_key", "bucket_key"], ["user_id", "day_key"]
    numbers = ", ".join(f"{n} long" for n in figures)
    made = rows.select(*bucket, "requested_at", "id", "tok", "free").groupBy(*bucket).applyInArrow(
        scan.bucket_function, "user_id string, month_key date, day_key int, bucket_key int, cut array<long>, fall array<long>")
    per_day = rows.groupBy("user_id", "month_key", "day_key").agg(*[F.any_value(n).alias(n) for n in figures])
    functions = cut_lineage(made.join(per_day, ["user_id", "month_key", "day_key"]))
    days = functions.groupBy("user_id", "month_key", "day_key").applyInArrow(
        scan.day_function, f"user_id string, month_key date, day_key int, cut array<long>, fall array<long>, {numbers}")
    begins = days.groupBy("user_id", "month_key").applyInArrow(scan.month_days, "user_id string, day_key int, day_used long, month_used long")
    starts = functions.join(begins, day).groupBy(*day).applyInArrow(
        scan.day_buckets, "user_id string, day_key int, bucket_key int, carry_day_used long, carry_month_used long")
    stepped = rows.drop("free", "tok", "carry_day", "carry_month").join(starts, ["user_id", "day_key", "bucket_key"])
    return stepped.groupBy("user_id", "day_key", "bucket_key").applyInPandas(replay_fn(settings.enable_blocking), REPLAY_SCHEMA)


def gate_replay_by_tier(replay: DataFrame) -> DataFrame:
    """Replay outcome per tier."""
    blocked = F.col("outcome") == "blocked"
    tok = F.col("total_tokens").cast("long")
    return replay.groupBy("group_name").agg(
        F.count(F.lit(1)).alias("requests"),
        F.sum(F.col("admitted").cast("long")).alias("admitted_requests"),
        F.sum(blocked.cast("long")).alias("blocked_requests"),
        F.sum((blocked & (F.col("limit_type") == "daily")).cast("long")).alias("blocked_daily"),
        F.sum((blocked & (F.col("limit_type") == "monthly")).cast("long")).alias("blocked_monthly"),
        F.sum((F.col("outcome") == "bypass").cast("long")).alias("bypassed_requests"),
        F.sum(F.when(F.col("admitted"), tok).otherwise(F.lit(0).cast("long"))).alias("admitted_tokens"),
        F.sum(F.when(blocked, tok).otherwise(F.lit(0).cast("long"))).alias("blocked_tokens"),
    )


def status_after_each(ledger: DataFrame, groups: DataFrame, limits: DataFrame, settings: QuotaSettings,
                      bucket_seconds: int = 60) -> DataFrame:
    """Status right after each ledger row was recorded (today / month usage
    including the row; the reference re-reads the status after recording)."""
    rows = ledger.filter(has_user() & F.col("recorded_at").isNotNull()).select(
        "id", "user_id", "recorded_at", "total_tokens", *calendar_keys("recorded_at", bucket_seconds)
    )
    h = Hierarchy(("user_id", "__month"), "__day", "__bucket", ("recorded_at", "id"))
    tok = F.coalesce(F.col("total_tokens"), F.lit(0)).cast("long")
    s = running_sums(rows, h, {"u": tok}, inclusive=True, enrich=_tier_enricher(groups, limits, settings))
    return s.select(
        "id", "user_id", "recorded_at", "group_name",
        F.col("__dl").alias("daily_limit"), F.col("__ml").alias("monthly_limit"),
        F.col("u__d1").alias("tokens_today"), F.col("u__d0").alias("tokens_this_month"),
        is_over(F.col("u__d1"), F.col("__dl")).alias("is_over_daily"),
        is_over(F.col("u__d0"), F.col("__ml")).alias("is_over_monthly"),
    )
