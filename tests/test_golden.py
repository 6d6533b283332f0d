"""Golden edge rows G1..G25 (FIXTURES.md section 4)."""

import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tokenmeter.functions import text
from tokenmeter.functions.literals import ts_ntz
from tokenmeter.operators import extract, gate, maintenance, notices, quota, rollups
from tokenmeter.params import Clock, QuotaSettings
from tokenmeter.sources.schemas import GROUPS, LIMITS

AS_OF = dt.datetime(2024, 1, 20, 23, 59, 59, 999999)
CLOCK = Clock(AS_OF)
T0 = dt.datetime(2024, 1, 20, 10, 0, 0)
LEDGER_DDL = "id long, user_id string, recorded_at timestamp_ntz, prompt_tokens int, completion_tokens int, total_tokens int"


def ledger(spark, rows):
    return spark.createDataFrame(rows, LEDGER_DDL)


def limits(spark, rows=(("freemium", 1000, 10000), ("pro", 5000, 100000), ("enterprise", -1, -1))):
    return spark.createDataFrame([(g, d, m, None, None, None, None) for g, d, m in rows], LIMITS)


def groups(spark, rows):
    return spark.createDataFrame([(u, g, None, None, None) for u, g in rows], GROUPS)


def ids(spark, *users):
    return spark.createDataFrame([(u,) for u in users], "user_id string")


def status_of(spark, led, grp, lim, *users):
    rows = quota.user_usage_status(ids(spark, *users), led, grp, lim, CLOCK).collect()
    return {r["user_id"]: r for r in rows}


def test_g1_used_equals_limit_is_over(spark):
    led = ledger(spark, [(1, "a", T0, 600, 400, 1000)])
    st = status_of(spark, led, groups(spark, [("a", "freemium")]), limits(spark), "a")["a"]
    assert st["tokens_today"] == 1000 and st["is_over_daily"] is True


def test_g2_one_below_limit_not_over_but_warned(spark):
    led = ledger(spark, [(1, "a", T0, 599, 400, 999)])
    grp, lim = groups(spark, [("a", "freemium")]), limits(spark)
    st = quota.user_usage_status(ids(spark, "a"), led, grp, lim, CLOCK)
    assert st.collect()[0]["is_over_daily"] is False
    line = notices.status_lines(st).collect()[0]
    assert line["is_warning"] is True and line["status_line"].startswith(text.ICON_WARNING)


def _decide(spark, led, grp, lim, role="user", settings=QuotaSettings()):
    req = spark.createDataFrame([(7, "a", role)], "id long, user_id string, role string")
    return gate.gate_decisions(req, led, grp, lim, CLOCK, settings).collect()[0]


def test_g3_both_over_daily_wins(spark):
    led = ledger(spark, [(1, "a", T0, 10000, 0, 10000)])
    d = _decide(spark, led, groups(spark, [("a", "freemium")]), limits(spark))
    assert (d["outcome"], d["limit_type"], d["reset_info"]) == ("blocked", "daily", "midnight UTC")
    n = notices.block_notices(gate.gate_decisions(
        spark.createDataFrame([(7, "a", "user")], "id long, user_id string, role string"),
        led, groups(spark, [("a", "freemium")]), limits(spark), CLOCK)).collect()[0]
    assert n["headline"] == "❌ Daily limit reached"
    assert "- **Used:** 10,000 tokens\n- **Limit:** 1,000 tokens\n- **Resets:** midnight UTC" in n["notice"]


def test_g4_monthly_only(spark):
    led = ledger(spark, [(1, "a", dt.datetime(2024, 1, 5), 10000, 0, 10000)])
    d = _decide(spark, led, groups(spark, [("a", "freemium")]), limits(spark))
    assert (d["limit_type"], d["reset_info"]) == ("monthly", "the 1st of next month")


def test_g5_unlimited_percents(spark):
    grp, lim = groups(spark, [("e", "enterprise")]), limits(spark)
    led = ledger(spark, [(1, "x", T0, 1, 1, 2)])
    s = quota.usage_summary(led, grp, lim, CLOCK).collect()[0]
    assert s["daily_percent_used"] == Decimal("100.00") and s["monthly_percent_used"] == Decimal("100.00")
    assert quota.users_near_limit(led, grp, lim, CLOCK).count() == 1
    st = quota.user_usage_status(ids(spark, "e"), led, grp, lim, CLOCK)
    r = st.collect()[0]
    assert r["is_over_daily"] is False and r["is_over_monthly"] is False
    line = notices.status_lines(st).collect()[0]
    assert line["daily_percent"] == 0.0 and "∞ today (0%)" in line["status_line"]


def test_g6_exactly_80_percent(spark):
    led = ledger(spark, [(1, "a", T0, 800, 0, 800)])
    grp, lim = groups(spark, [("a", "freemium")]), limits(spark)
    s = quota.usage_summary(led, grp, lim, CLOCK).collect()[0]
    assert s["daily_percent_used"] == Decimal("80.00")
    assert quota.users_near_limit(led, grp, lim, CLOCK).count() == 0
    st = quota.user_usage_status(ids(spark, "a"), led, grp, lim, CLOCK)
    assert notices.status_lines(st).collect()[0]["is_warning"] is True


def test_g7_rounding_half_up(spark):
    led = ledger(spark, [(1, "a", T0, 1, 0, 1)])
    lim = limits(spark, [("freemium", 800, 10000)])
    s = quota.usage_summary(led, groups(spark, [("a", "freemium")]), lim, CLOCK).collect()[0]
    assert s["daily_percent_used"] == Decimal("0.13")


def test_g8_unknown_user(spark):
    led = ledger(spark, [(1, "a", T0, 1, 0, 1)])
    grp, lim = groups(spark, [("a", "pro")]), limits(spark)
    st = status_of(spark, led, grp, lim, "nobody")["nobody"]
    assert (st["group_name"], st["daily_limit"], st["monthly_limit"]) == ("freemium", 1000, 10000)
    assert (st["tokens_today"], st["tokens_this_month"], st["is_over_daily"]) == (0, 0, False)
    assert quota.usage_summary(led, grp, lim, CLOCK).filter("user_id = 'nobody'").count() == 0


def test_g9_tier_missing_from_limits(spark):
    led = ledger(spark, [(1, "a", T0, 1, 0, 1)])
    grp, lim = groups(spark, [("a", "gold")]), limits(spark)
    st = status_of(spark, led, grp, lim, "a")["a"]
    assert (st["group_name"], st["daily_limit"], st["monthly_limit"]) == ("gold", 1000000, 10000000)
    assert quota.usage_summary(led, grp, lim, CLOCK).count() == 0
    assert [r["user_id"] for r in quota.orphan_groups(grp, lim).collect()] == ["a"]


def test_g10_null_recorded_at(spark):
    led = ledger(spark, [(1, "a", None, 5, 5, 10), (2, "a", T0, 1, 1, 2)])
    daily = {r["usage_date"]: r["total_tokens"] for r in rollups.usage_daily(led).collect()}
    assert daily[None] == 10 and daily[dt.date(2024, 1, 20)] == 2
    st = status_of(spark, led, groups(spark, [("a", "freemium")]), limits(spark), "a")["a"]
    assert (st["tokens_today"], st["tokens_this_month"]) == (2, 2)
    assert maintenance.retention_kept(led, CLOCK, 0).count() == 1  # the NULL row stays


def test_g11_cutoff_kept(spark):
    cutoff = CLOCK.cutoff(3)
    led = ledger(spark, [(1, "a", cutoff, 1, 1, 2), (2, "a", cutoff - dt.timedelta(microseconds=1), 1, 1, 2)])
    assert [r["id"] for r in maintenance.retention_kept(led, CLOCK, 3).collect()] == [1]
    assert maintenance.retention_deleted_count(led, CLOCK, 3).collect()[0]["deleted_count"] == 1


def _extract(spark, body, user="u1"):
    df = spark.createDataFrame([(1, user, json.dumps(body))], "conv_id long, user_id string, payload string")
    ex = extract.usage_extract(df)
    return ex.collect()[0], extract.record_usage(ex, ts_ntz(AS_OF)).collect()


def test_g12_null_message_usage_overrides_body(spark):
    body = {"usage": {"prompt_tokens": 5, "completion_tokens": 6},
            "messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a", "usage": None}]}
    _, rec = _extract(spark, body)
    assert rec == []


def test_g13_search_skips_messages_without_usage(spark):
    body = {"messages": [{"role": "assistant", "content": "a", "usage": {"prompt_tokens": 3, "completion_tokens": 4}},
                         {"role": "user", "content": "q"}, {"role": "assistant", "content": "b"}]}
    ex, rec = _extract(spark, body)
    assert (ex["prompt_tokens"], ex["completion_tokens"]) == (3, 4) and len(rec) == 1


def test_g14_eval_count_fallback(spark):
    ex, _ = _extract(spark, {"usage": {"prompt_tokens": 0, "prompt_eval_count": 7, "eval_count": 2}})
    assert (ex["prompt_tokens"], ex["completion_tokens"]) == (7, 2)


def test_g15_payload_total_ignored(spark):
    _, rec = _extract(spark, {"usage": {"prompt_tokens": 1, "completion_tokens": 2, "total_tokens": 99}})
    assert rec[0]["total_tokens"] == 3


def test_g16_negative_count_recorded(spark):
    _, rec = _extract(spark, {"usage": {"prompt_tokens": -5, "completion_tokens": 10}})
    assert rec[0]["total_tokens"] == 5


def test_g17_overflow_dropped(spark):
    _, rec = _extract(spark, {"usage": {"prompt_tokens": 2147483647, "completion_tokens": 1}})
    assert rec == []


@pytest.mark.parametrize("value", [3000000000, "12", 1.5, [1], 10**30])
def test_count_that_is_no_int_drops_the_row(spark, value):
    ex, rec = _extract(spark, {"usage": {"prompt_tokens": value, "completion_tokens": 5}})
    assert ex["prompt_tokens"] is None and rec == []


@pytest.mark.parametrize("value,blocked", [("false", True), ("0", True), ("", False), (0, False), (0.0, False), (None, False), ([], False), ({}, False), ({"a": 1}, True), (False, False), (2, True)])
def test_blocked_flag_by_json_type(spark, value, blocked):
    assert _extract(spark, {"_usage_blocked": value, "usage": {"prompt_tokens": 1}})[0]["usage_blocked"] is blocked


def test_empty_usage_is_no_usage(spark):
    ex, rec = _extract(spark, {"usage": {}})
    assert ex["has_usage"] is False and rec == []


def test_tag_wins_over_the_session(spark):
    assert _extract(spark, {"_usage_user_id": "t", "usage": {"prompt_tokens": 1}})[0]["user_id"] == "t"
    assert _extract(spark, {"_usage_user_id": "", "usage": {"prompt_tokens": 1}})[0]["user_id"] == "u1"


def test_seed_and_registration_keep_all_columns(spark):
    existing = spark.createDataFrame([("freemium", 7, 70, 5, T0, T0, "mine")], LIMITS)
    out = {r["group_name"]: r for r in maintenance.seed_limits(existing, maintenance.default_tiers(spark), ts_ntz(AS_OF)).collect()}
    assert tuple(out["freemium"]) == ("freemium", 7, 70, 5, T0, T0, "mine")
    assert out["pro"]["created_at"] == AS_OF and out["pro"]["description"].startswith("Pro tier")
    grp = spark.createDataFrame([("a", "pro", T0, "alice", "n1")], GROUPS)
    led = ledger(spark, [(1, "a", T0, 1, 1, 2), (2, "b", T0, 1, 1, 2)])
    got = {r["user_id"]: tuple(r) for r in maintenance.register_first_seen(grp, led, assigned_at=ts_ntz(AS_OF)).collect()}
    assert got == {"a": ("a", "pro", T0, "alice", "n1"), "b": ("b", "freemium", AS_OF, None, None)}


def test_body_is_parsed_once(spark):
    df = spark.createDataFrame([(1, "u", "{}")], "conv_id long, user_id string, payload string")
    plan = extract.usage_recordable(extract.usage_extract(df))._jdf.queryExecution().executedPlan().toString()
    assert plan.lower().count("parse_json") + plan.count("parseJson") <= 1, plan


def test_g18_blocked_body_not_recorded(spark):
    ex, rec = _extract(spark, {"_usage_blocked": True, "usage": {"prompt_tokens": 1, "completion_tokens": 1}})
    assert ex["usage_blocked"] is True and rec == []


def test_g19_admin_bypass_case_sensitive(spark):
    led = ledger(spark, [(1, "a", T0, 10000, 0, 10000)])
    grp, lim = groups(spark, [("a", "freemium")]), limits(spark)
    d = _decide(spark, led, grp, lim, role="admin")
    assert (d["outcome"], d["allowed"]) == ("bypass", True)
    assert _decide(spark, led, grp, lim, role="Admin")["outcome"] == "blocked"


def test_g20_advisory_mode(spark):
    led = ledger(spark, [(1, "a", T0, 10000, 0, 10000)])
    grp, lim = groups(spark, [("a", "freemium")]), limits(spark)
    off = QuotaSettings(enable_blocking=False)
    assert _decide(spark, led, grp, lim, settings=off)["outcome"] == "advisory"
    assert _decide(spark, led, grp, lim, role="admin", settings=off)["outcome"] == "bypass"


def test_g21_k_format(spark):
    df = spark.createDataFrame([(n,) for n in (999, 1000, 1150, 1250, 2500000)], "n long")
    got = [r[0] for r in df.select(text.k_format(F.col("n"))).collect()]
    assert got == ["999", "1.0K", "1.1K", "1.2K", "2500.0K"]
    assert got == [f"{n/1000:.1f}K" if n >= 1000 else str(n) for n in (999, 1000, 1150, 1250, 2500000)]


def test_g22_list_content_unchanged(spark):
    led = ledger(spark, [(1, "u1", T0, 990, 0, 990)])
    body = {"usage": {"prompt_tokens": 5, "completion_tokens": 5},
            "messages": [{"role": "assistant", "content": "first"}, {"role": "user", "content": "q"},
                         {"role": "assistant", "content": [{"type": "text", "text": "x"}]}]}
    df = spark.createDataFrame([(1, "u1", json.dumps(body))], "conv_id long, user_id string, payload string")
    out = notices.annotated_messages(df, led, groups(spark, [("u1", "freemium")]), limits(spark), CLOCK).collect()[0]
    assert out["warning_kind"] == "reached"
    got = [json.loads(m) for m in out["messages"]]
    assert got == body["messages"] and json.loads(out["body"]) == body


def test_annotation_appends_to_text(spark):
    led = ledger(spark, [(1, "u1", T0, 700, 0, 700)])
    body = {"usage": {"prompt_tokens": 50, "completion_tokens": 50},
            "messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "answer", "id": "x7", "files": [1, {"a": None}]}],
            "extra": {"k": [1.5, "é"]}}
    df = spark.createDataFrame([(1, "u1", json.dumps(body))], "conv_id long, user_id string, payload string")
    out = notices.annotated_messages(df, led, groups(spark, [("u1", "freemium")]), limits(spark), CLOCK).collect()[0]
    assert out["warning_kind"] == "approaching"
    expected = ("answer\n\n---\n⚠️ **Approaching Usage Limit**\n\n- Today: 800/1.0K (80%)\n"
                "- This month: 800/10.0K (8%)")
    assert json.loads(out["messages"][1]) == {"role": "assistant", "content": expected, "id": "x7", "files": [1, {"a": None}]}
    assert json.loads(out["body"])["extra"] == {"k": [1.5, "é"]}


def test_blocked_body_replaced(spark):
    led = ledger(spark, [(1, "u1", T0, 1000, 0, 1000)])
    body = {"messages": [{"role": "user", "content": "q"}]}
    df = spark.createDataFrame([(1, "u1", json.dumps(body))], "conv_id long, user_id string, payload string")
    out = notices.annotated_messages(df, led, groups(spark, [("u1", "freemium")]), limits(spark), CLOCK).collect()[0]
    assert out["usage_blocked"] is True and len(out["messages"]) == 1
    message = json.loads(out["messages"][0])
    assert message["role"] == "assistant" and json.loads(out["body"]) == {"messages": [message], "_usage_blocked": True}
    assert "You've reached your daily token limit for the **freemium** tier." in message["content"]


def test_g23_upsert_keeps_assigned_by(spark):
    grp = spark.createDataFrame([("a", "freemium", None, "alice", "n1")], GROUPS)
    batch = spark.createDataFrame([("a", "pro", "bob", "n2"), ("b", "pro", "bob", "n3")],
                                  "user_id string, group_name string, assigned_by string, notes string")
    out = {r["user_id"]: r for r in maintenance.upsert_groups(grp, batch, CLOCK).collect()}
    assert (out["a"]["group_name"], out["a"]["assigned_by"], out["a"]["notes"]) == ("pro", "alice", "n1")
    assert out["a"]["assigned_at"] == AS_OF
    assert (out["b"]["group_name"], out["b"]["assigned_by"]) == ("pro", "bob")


def test_upsert_repeated_user_fails(spark):
    grp = spark.createDataFrame([("a", "freemium", None, "alice", None)], GROUPS)
    batch = spark.createDataFrame([("a", "pro", "x", None), ("a", "enterprise", "y", None)],
                                  "user_id string, group_name string, assigned_by string, notes string")
    with pytest.raises(Exception):
        maintenance.upsert_groups(grp, batch, CLOCK).collect()


def test_g24_seed_keeps_existing(spark):
    existing = limits(spark, [("freemium", 7, 70)])
    out = {r["group_name"]: r for r in maintenance.seed_limits(existing, maintenance.default_tiers(spark)).collect()}
    assert (out["freemium"]["daily_token_limit"], out["freemium"]["monthly_token_limit"]) == (7, 70)
    assert out["pro"]["daily_token_limit"] == 5000000 and out["enterprise"]["daily_token_limit"] == -1


def test_g25_empty_user(spark):
    ex, rec = _extract(spark, {"usage": {"prompt_tokens": 1, "completion_tokens": 1}}, user="")
    assert ex["user_id"] is None and rec == []
    led = ledger(spark, [(1, "a", T0, 1, 0, 1)])
    req = spark.createDataFrame([(7, "", "user")], "id long, user_id string, role string")
    d = gate.gate_decisions(req, led, groups(spark, []), limits(spark), CLOCK).collect()[0]
    assert (d["outcome"], d["allowed"]) == ("unidentified", True)


def test_violations_report(spark):
    led = ledger(spark, [(1, "a", T0, 1, 1, 5), (2, None, T0, 1, 1, 2), (3, "x" * 300, T0, 1, 1, 2)])
    got = sorted((r["id"], r["violation"]) for r in maintenance.ledger_violations(led).collect())
    assert got == [(1, "total_tokens <> prompt_tokens + completion_tokens"), (2, "user_id is null"),
                   (3, "user_id longer than 255")]


def test_zero_limit_blocks_and_nulls_percent(spark):
    led = ledger(spark, [(1, "a", T0, 1, 0, 1)])
    lim = limits(spark, [("freemium", 0, 10)])
    s = quota.usage_summary(led, groups(spark, [("a", "freemium")]), lim, CLOCK).collect()[0]
    assert s["daily_percent_used"] is None
    assert _decide(spark, led, groups(spark, [("a", "freemium")]), lim)["outcome"] == "blocked"
