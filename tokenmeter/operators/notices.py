"""Texts the hooks show: status line (O-38/O-39), block notice (O-40),
post-response warning (O-41) and the annotated / replaced chat body
(O-42/O-43)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenmeter.functions import text
from tokenmeter.functions.quota import hook_percent
from tokenmeter.params import QuotaSettings


def _figures(status: DataFrame | None = None) -> dict[str, Column]:
    dp = hook_percent(F.col("tokens_today"), F.col("daily_limit"))
    mp = hook_percent(F.col("tokens_this_month"), F.col("monthly_limit"))
    return dict(
        today=text.k_format(F.col("tokens_today")),
        daily_limit=text.limit_text(F.col("daily_limit")),
        month=text.k_format(F.col("tokens_this_month")),
        monthly_limit=text.limit_text(F.col("monthly_limit")),
        daily_pct=text.whole_percent(dp),
        monthly_pct=text.whole_percent(mp),
        _dp=dp,
        _mp=mp,
    )


def _warned(dp: Column, mp: Column, settings: QuotaSettings) -> Column:
    w = F.lit(settings.warn_at_percent)
    return F.coalesce(dp >= w, F.lit(False)) | F.coalesce(mp >= w, F.lit(False))


def status_lines(status: DataFrame, settings: QuotaSettings = QuotaSettings()) -> DataFrame:
    """O-38/O-39 for each status row: one per request, as the hook shows it (or
    per user).  Percents are the hook's
    floating percents (0 when unlimited).  D4: a zero limit makes the percent
    NULL and so the line NULL (the reference fails open there)."""
    f = _figures()
    dp, mp = f.pop("_dp"), f.pop("_mp")
    warn = _warned(dp, mp, settings)
    line = text.render(
        text.STATUS_LINE, icon=F.when(warn, F.lit(text.ICON_WARNING)).otherwise(F.lit(text.ICON_OK)), **f
    )
    if not settings.show_usage_status:
        line = F.lit(None).cast("string")
    return status.select(
        *(["id"] if "id" in status.columns else []),
        "user_id",
        "group_name",
        dp.alias("daily_percent"),
        mp.alias("monthly_percent"),
        warn.alias("is_warning"),
        line.alias("status_line"),
    )


def block_notices(decisions: DataFrame) -> DataFrame:
    """O-40: the message that replaces a blocked body, and its status headline."""
    blocked = decisions.filter(F.col("outcome") == "blocked")
    notice = text.render(
        text.BLOCK_NOTICE,
        limit_type=F.col("limit_type"),
        group_name=F.col("group_name"),
        used=text.thousands(F.col("used_tokens")),
        limit=text.thousands(F.col("limit_tokens")),
        reset_info=F.col("reset_info"),
    )
    headline = text.render(text.BLOCK_HEADLINE, limit_type_title=F.initcap(F.col("limit_type")))
    return blocked.select("id", "user_id", "limit_type", notice.alias("notice"), headline.alias("headline"))


def warning_text(settings: QuotaSettings = QuotaSettings()) -> tuple[Column, Column]:
    """(kind, text) of the post-response warning for a status row: 'reached'
    if over a limit, else 'approaching' if a hook percent >= warn_at_percent,
    else none.  The reached text names 'daily' first (S2) and always says the
    next request will be blocked (S20)."""
    f = _figures()
    dp, mp = f.pop("_dp"), f.pop("_mp")
    over = F.col("is_over_daily") | F.col("is_over_monthly")
    which = F.when(F.col("is_over_daily"), F.lit("daily")).otherwise(F.lit("monthly"))
    kind = F.when(over, F.lit("reached")).when(_warned(dp, mp, settings), F.lit("approaching"))
    reached = text.render(text.WARNING_REACHED, which=which, group_name=F.col("group_name"), **f)
    approaching = text.render(text.WARNING_APPROACHING, **f)
    body = F.when(kind == "reached", reached).when(kind == "approaching", approaching)
    return kind, body


def post_response_warnings(status_after: DataFrame, settings: QuotaSettings = QuotaSettings()) -> DataFrame:
    """O-41 over statuses taken right after each recording."""
    kind, body = warning_text(settings)
    return status_after.select(
        "id", "user_id", "tokens_today", "tokens_this_month", kind.alias("warning_kind"), body.alias("warning")
    ).filter(F.col("warning_kind").isNotNull())


def annotated_messages(
    bodies: DataFrame,
    ledger: DataFrame,
    groups: DataFrame,
    limits: DataFrame,
    clock,
    settings: QuotaSettings = QuotaSettings(),
) -> DataFrame:
    """O-42/O-43 for a batch of concurrent chat bodies at ``clock.as_of``: body
    in, body out (``messages`` as JSON texts, ``body`` as one).

    Inlet: every body of a session user is checked against the user's status
    before the batch (requests in flight together see the same status).  A
    blocked body's messages are replaced by one assistant message with the
    block notice, it is flagged, and not recorded; any other is tagged with the
    user.  Outlet, in source-key order: a body that came flagged passes as it
    is; else the tag is taken off, the usage is recorded, the status is re-read
    (prior usage + this batch's recordings up to and including this one) and
    the warning, if any, is appended to the last assistant message when its
    content is text (S19: a non-text last assistant message is left unchanged
    and no earlier one is used).  All other keys of bodies and messages stay.

    Only slim rows (key, user, counts) pass the status join and the running
    sums; bodies without a user stay out of the sums.  The bodies meet their
    decisions once, on the key."""
    from tokenmeter.functions import payload as P
    from tokenmeter.functions.quota import is_over
    from tokenmeter.operators.extract import recordable, usage_extract
    from tokenmeter.operators.gate import is_admin, outcome_of
    from tokenmeter.operators.prefix import layered_sums
    from tokenmeter.operators.quota import with_status
    from tokenmeter.params import RESET_DAILY, RESET_MONTHLY

    role = F.col("role") if "role" in bodies.columns else F.lit("user")
    session = F.coalesce(F.col("user_id") != "", F.lit(False))
    slim = usage_extract(bodies.select("*", role.alias("__role"), session.alias("__session")), session_first=True, keep=("__role", "__session"))
    j = with_status(slim.filter(F.col("user_id").isNotNull()), ledger, groups, limits, clock, settings)
    j = j.withColumnsRenamed({"tokens_today": "__base_today", "tokens_this_month": "__base_month", "is_over_daily": "__od0", "is_over_monthly": "__om0"})
    outcome = outcome_of(F.col("__od0") | F.col("__om0"), is_admin(settings, F.col("__role")), settings)
    j = j.withColumn("__blocked", F.col("__session") & (outcome == "blocked"))
    rec = F.when(~F.col("__blocked") & recordable(j), F.try_add(F.col("prompt_tokens"), F.col("completion_tokens")))
    j = j.select("*", rec.cast("long").alias("__rec"))
    after = layered_sums(j, ["user_id"], "conv_id", F.coalesce(F.col("__rec"), F.lit(0).cast("long")), "__recorded")
    after = after.withColumns({"tokens_today": F.col("__base_today") + F.col("__recorded"), "tokens_this_month": F.col("__base_month") + F.col("__recorded")})
    after = after.withColumns({"is_over_daily": is_over(F.col("tokens_today"), F.col("daily_limit")),
                               "is_over_monthly": is_over(F.col("tokens_this_month"), F.col("monthly_limit"))})
    kind, warning = warning_text(settings)
    over = F.col("__od0")
    notice = text.render(
        text.BLOCK_NOTICE,
        limit_type=F.when(over, F.lit("daily")).otherwise(F.lit("monthly")),
        group_name=F.col("group_name"),
        used=text.thousands(F.when(over, F.col("__base_today")).otherwise(F.col("__base_month"))),
        limit=text.thousands(F.when(over, F.col("daily_limit")).otherwise(F.col("monthly_limit"))),
        reset_info=F.when(over, F.lit(RESET_DAILY)).otherwise(F.lit(RESET_MONTHLY)),
    )
    recorded = F.col("__rec").isNotNull()
    decided = after.select("conv_id", F.col("user_id").alias("__who"), F.col("__blocked"), F.when(recorded, kind).alias("warning_kind"),
                           F.when(recorded, warning).alias("__warning"), F.when(F.col("__blocked"), notice).alias("__notice"))
    decided = decided.withColumnRenamed("conv_id", "__key")

    whole = bodies.select("conv_id", F.nullif(F.col("user_id"), F.lit("")).alias("__user"), P.parsed_once(F.col("payload")).alias("__body"))
    joined = whole.join(decided, F.col("conv_id") == F.col("__key"), "left").withColumn("__blocked", F.coalesce("__blocked", F.lit(False)))
    body = F.col("__body")
    msgs = F.coalesce(P.messages(body), F.array().cast("array<variant>"))
    last = F.array_max(F.transform(msgs, lambda m, i: F.when(P.is_assistant(m), i).otherwise(-1)))

    def warned(m: Column) -> Column:
        content = F.concat(P.as_text(P.field(m, "content")), F.col("__warning")).cast("variant")
        return F.to_json(F.transform_values(F.try_variant_get(m, "$", "map<string,variant>"), lambda k, v: F.when(k == "content", content).otherwise(v)))

    kept = F.transform(msgs, lambda m, i: F.when((i == last) & F.col("__warning").isNotNull() & P.is_text(P.field(m, "content")), warned(m)).otherwise(F.to_json(m)))
    replaced = F.array(F.to_json(F.struct(F.col("__notice").alias("content"), F.lit("assistant").alias("role"))))
    out = joined.withColumn("messages", F.when(F.col("__blocked"), replaced).otherwise(kept))

    # The body again: its messages, what the hooks set, and all its other keys.
    flag, tag = P.field(body, "_usage_blocked"), P.field(body, "_usage_user_id")
    json_text = lambda c: F.to_json(c.cast("variant"))
    flagged = F.when(F.col("__blocked"), F.lit("true")).otherwise(F.to_json(flag))
    came_flagged = P.truthy(flag)
    tagged = F.when(F.col("__blocked"), F.to_json(tag)).when(came_flagged, F.coalesce(F.when(F.col("__user").isNotNull(), json_text(F.col("__user"))), F.to_json(tag)))
    hooks = F.create_map(F.lit("_usage_blocked"), flagged, F.lit("_usage_user_id"), tagged)
    own = F.map_filter(F.try_variant_get(body, "$", "map<string,variant>"), lambda k, _: ~k.isin("messages", "_usage_blocked", "_usage_user_id"))
    rest = F.transform(F.map_entries(own), lambda e: F.concat(json_text(e["key"]), F.lit(":"), F.to_json(e["value"])))
    set_ = F.transform(F.map_entries(F.map_filter(hooks, lambda _, v: v.isNotNull())), lambda e: F.concat(F.lit('"'), e["key"], F.lit('":'), e["value"]))
    list_ = F.concat(F.lit('"messages":['), F.array_join("messages", ","), F.lit("]"))
    text_ = F.concat(F.lit("{"), F.array_join(F.concat(F.array(list_), set_, F.coalesce(rest, F.array().cast("array<string>"))), ","), F.lit("}"))
    return out.select(
        "conv_id",
        F.col("__who").alias("user_id"),
        F.col("__blocked").alias("usage_blocked"),
        "warning_kind",
        "messages",
        text_.alias("body"),
    )
