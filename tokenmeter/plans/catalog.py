"""The registered queries: each builds its inputs from the driver's tables
(``sources.fixtures``) and applies one operator.  Callables take
``(spark, sf_dir)`` and return a lazy DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import datetime as dt

from pyspark.sql import functions as F

from tokenmeter.functions.literals import ts_ntz
from tokenmeter.operators import extract, gate, maintenance, notices, quota, rollups
from tokenmeter.params import Clock
from tokenmeter.params import FIXTURE_CLOCK as CLOCK
from tokenmeter.params import QuotaSettings
from tokenmeter.session import configure
from tokenmeter.sources import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]


def _inputs(spark: SparkSession, sf_dir: str):
    configure(spark)
    ledger = fx.usage_records(spark, sf_dir)
    return ledger, fx.user_groups(ledger), fx.usage_limits(spark)


def q_ledger_scan(spark, sf_dir):
    return rollups.ledger_scan(_inputs(spark, sf_dir)[0])


def q_groups_dim(spark, sf_dir):
    return _inputs(spark, sf_dir)[1]


def q_usage_daily(spark, sf_dir):
    return rollups.usage_daily(_inputs(spark, sf_dir)[0])


def q_usage_monthly(spark, sf_dir):
    return rollups.usage_monthly(_inputs(spark, sf_dir)[0])


def q_usage_monthly_orders(spark, sf_dir):
    """The monthly rollup of a ledger that spans years."""
    configure(spark)
    return rollups.usage_monthly(fx.second_ledger(spark, sf_dir))


def q_tokens_today(spark, sf_dir):
    return rollups.tokens_today(_inputs(spark, sf_dir)[0], CLOCK)


def q_tokens_month_to_date(spark, sf_dir):
    return rollups.tokens_month_to_date(_inputs(spark, sf_dir)[0], CLOCK)


def q_usage_summary(spark, sf_dir):
    return quota.usage_summary(*_inputs(spark, sf_dir), CLOCK)


def q_users_near_limit(spark, sf_dir):
    return quota.ranked_near_limit(quota.near_limit(quota.usage_summary(*_inputs(spark, sf_dir), CLOCK)))


def q_user_usage_status(spark, sf_dir):
    ledger, groups, limits = _inputs(spark, sf_dir)
    return quota.user_usage_status(fx.request_ids(spark, sf_dir), ledger, groups, limits, CLOCK)


def q_orphan_groups(spark, sf_dir):
    """Users whose tier has lost its quota row (the unlimited tier's)."""
    _, groups, limits = _inputs(spark, sf_dir)
    return quota.orphan_groups(groups, limits.filter(F.col("group_name") != "enterprise"))


def q_usage_history_by_group(spark, sf_dir):
    ledger, groups, _ = _inputs(spark, sf_dir)
    return rollups.usage_history_by_group(ledger, groups)


def _decisions(spark, sf_dir, settings=QuotaSettings()):
    ledger, groups, limits = _inputs(spark, sf_dir)
    return gate.gate_decisions(fx.request_log(spark, sf_dir), ledger, groups, limits, CLOCK, settings)


def q_gate_decisions(spark, sf_dir):
    return _decisions(spark, sf_dir)


def q_gate_decisions_advisory(spark, sf_dir):
    return _decisions(spark, sf_dir, QuotaSettings(enable_blocking=False))


def q_status_lines(spark, sf_dir):
    ledger, groups, limits = _inputs(spark, sf_dir)
    requests = fx.request_log(spark, sf_dir).select("id", "user_id")
    return notices.status_lines(quota.with_status(requests, ledger, groups, limits, CLOCK))


def q_block_notices(spark, sf_dir):
    return notices.block_notices(_decisions(spark, sf_dir))


def _replay(spark, sf_dir):
    """Replay of the request log; every user has a tier row (tier by id % 10)."""
    configure(spark)
    log = fx.request_log(spark, sf_dir)
    groups = fx.user_groups(log, every_user=True)
    return gate.gate_replay(log, groups, fx.usage_limits(spark))


def q_gate_replay(spark, sf_dir):
    return _replay(spark, sf_dir)


def q_gate_replay_by_tier(spark, sf_dir):
    return gate.gate_replay_by_tier(_replay(spark, sf_dir))


def q_post_response_warnings(spark, sf_dir):
    ledger, groups, limits = _inputs(spark, sf_dir)
    return notices.post_response_warnings(gate.status_after_each(ledger, groups, limits, QuotaSettings()))


# Retention is evaluated at the end of the events span with a 15-day window.
RETENTION_CLOCK = Clock(dt.datetime(2024, 1, 30))
RETENTION_DAYS = 15


def _extracted(spark, sf_dir):
    configure(spark)
    return extract.usage_extract(fx.bodies(spark, sf_dir))


def q_usage_extract(spark, sf_dir):
    return _extracted(spark, sf_dir)


def q_usage_recordable(spark, sf_dir):
    return extract.usage_recordable(_extracted(spark, sf_dir))


def q_record_usage(spark, sf_dir):
    return extract.record_usage(_extracted(spark, sf_dir), ts_ntz(CLOCK.as_of))


def q_register_first_seen(spark, sf_dir):
    ledger = _inputs(spark, sf_dir)[0]
    new_rows = extract.record_usage(_extracted(spark, sf_dir), ts_ntz(CLOCK.as_of))
    return maintenance.register_first_seen(fx.user_group_rows(ledger), new_rows, assigned_at=ts_ntz(CLOCK.as_of))


def q_seed_limits(spark, sf_dir):
    """Seed a table that has, with a description, the tiers of the users that
    are not on the unlimited one: that tier is missing and comes from the seed."""
    _, groups, limits = _inputs(spark, sf_dir)
    limited = groups.filter(F.col("group_name") != "enterprise").select("group_name").distinct()
    mine = limits.join(limited, "group_name", "left_semi").select(
        "group_name", "daily_token_limit", "monthly_token_limit", F.lit(60).alias("rate_limit_rpm"),
        ts_ntz(CLOCK.day_start).alias("created_at"), ts_ntz(CLOCK.day_start).alias("updated_at"), F.lit("own").alias("description"))
    return maintenance.seed_limits(mine, maintenance.default_tiers(spark), ts_ntz(CLOCK.as_of))


def q_upsert_groups(spark, sf_dir):
    ledger = _inputs(spark, sf_dir)[0]
    return maintenance.upsert_groups(fx.user_group_rows(ledger), fx.tier_change_batch(ledger), CLOCK)


def q_retention_kept(spark, sf_dir):
    return maintenance.retention_kept(_inputs(spark, sf_dir)[0], RETENTION_CLOCK, RETENTION_DAYS)


def q_retention_deleted_count(spark, sf_dir):
    return maintenance.retention_deleted_count(_inputs(spark, sf_dir)[0], RETENTION_CLOCK, RETENTION_DAYS)


def q_ledger_violations(spark, sf_dir):
    configure(spark)
    return maintenance.ledger_violations(fx.dirty_ledger(spark, sf_dir))


def q_ledger_store(spark, sf_dir):
    """A stored ledger: written, appended to, purged, read back."""
    from tokenmeter.session import scratch_path
    from tokenmeter.sources import store

    ledger = _inputs(spark, sf_dir)[0]
    path = scratch_path(spark, "tables", "stored-ledger")
    store.write_ledger(ledger.filter(F.col("id") % 2 == 0), path)
    store.write_ledger(ledger.filter(F.col("id") % 2 == 1), path)
    store.purge_ledger(spark, path, RETENTION_CLOCK, RETENTION_DAYS)
    return store.read_ledger(spark, path).select(*ledger.columns)


def _usage_store(spark, sf_dir, purged: bool):
    """The ledger stored in two appends, the second one repeated, with rollups."""
    from tokenmeter.session import scratch_path
    from tokenmeter.sources.usage_store import UsageStore

    ledger = _inputs(spark, sf_dir)[0]
    store = UsageStore(spark, scratch_path(spark, "tables", "usage-store"), ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ledger.schema))
    for n in (0, 1, 1):
        store.append(ledger.filter(F.pmod("id", F.lit(2)) == n), n)
    if purged:
        store.purge(RETENTION_CLOCK, RETENTION_DAYS + 5)
        store.purge(RETENTION_CLOCK, RETENTION_DAYS)
    return store


def q_purged_usage_daily(spark, sf_dir):
    """Daily sums after two purges, by subtraction."""
    return _usage_store(spark, sf_dir, purged=True).daily()


def q_purged_usage_monthly(spark, sf_dir):
    return _usage_store(spark, sf_dir, purged=True).monthly()


def q_usage_summary_maintained(spark, sf_dir):
    """The summary from folded days and today's partition."""
    _, groups, limits = _inputs(spark, sf_dir)
    return quota.summary_of(_usage_store(spark, sf_dir, purged=False).period_totals(CLOCK), groups, limits)


def q_view_user_usage(spark, sf_dir):
    """A user's usage, asked of the named view."""
    from tokenmeter.plans.views import register_views

    register_views(spark, *_inputs(spark, sf_dir), CLOCK)
    return spark.sql("SELECT * FROM usage_summary WHERE user_id = '11'")


def q_view_near_limits(spark, sf_dir):
    from tokenmeter.plans.views import register_views

    register_views(spark, *_inputs(spark, sf_dir), CLOCK)
    return spark.sql("SELECT n.user_id, n.group_name, d.usage_date, d.total_tokens FROM users_near_limit n JOIN usage_daily d USING (user_id)")


def q_sql_user_usage_status(spark, sf_dir):
    """The status function asked in SQL for each row of a table of ids."""
    from tokenmeter.plans.functions import register_functions

    register_functions(spark, *_inputs(spark, sf_dir), CLOCK)
    fx.request_ids(spark, sf_dir).createOrReplaceTempView("asked_users")
    return spark.sql("SELECT a.user_id, s.* FROM (SELECT DISTINCT user_id FROM asked_users) a, LATERAL get_user_usage_status(a.user_id) s")


def q_sql_record_usage(spark, sf_dir):
    """Ledger rows of the recordable responses, made by the SQL function."""
    from tokenmeter.plans.functions import register_functions

    register_functions(spark, *_inputs(spark, sf_dir), CLOCK)
    extracted = _extracted(spark, sf_dir)
    extracted.filter(extract.recordable(extracted)).createOrReplaceTempView("responses")
    return spark.sql("""SELECT r.conv_id AS id, u.* FROM responses r,
        LATERAL record_usage(r.user_id, r.prompt_tokens, r.completion_tokens, r.model_id, NULL, r.chat_id) u""")


def q_sql_cleanup(spark, sf_dir):
    """Rows the purge would delete and keep, asked in SQL."""
    from tokenmeter.plans.functions import register_functions

    register_functions(spark, *_inputs(spark, sf_dir), RETENTION_CLOCK)
    return spark.sql(f"""SELECT c.deleted_count, k.kept FROM cleanup_old_usage_records({RETENTION_DAYS}) c,
        (SELECT count(*) AS kept FROM kept_usage_records({RETENTION_DAYS})) k""")


def q_tier_store(spark, sf_dir):
    """Tiers in buckets: a third of the users register when first seen, then a
    fifth of all move to another tier."""
    from tokenmeter.session import scratch_path
    from tokenmeter.sources.tier_store import TierStore

    ledger = _inputs(spark, sf_dir)[0]
    rows = fx.user_group_rows(ledger)
    low = F.col("user_id").cast("int") % 3 == 0
    store = TierStore(spark, scratch_path(spark, "tables", "tiers"), buckets=8)
    store.create(rows.filter(~low))
    store.register(ledger.filter(low), ts_ntz(CLOCK.day_start))
    store.upsert(fx.tier_change_batch(ledger.filter(F.col("user_id").cast("int") % 5 == 0)), CLOCK)
    return store.read()


def q_annotated_messages(spark, sf_dir):
    ledger, groups, limits = _inputs(spark, sf_dir)
    out = notices.annotated_messages(fx.bodies(spark, sf_dir), ledger, groups, limits, CLOCK)
    return out.select("conv_id", "user_id", "usage_blocked", "warning_kind", F.size("messages").alias("message_count"), "body")


def _in_turn(spark, table: DataFrame, name: str, parts: int, feed) -> None:
    """Land ``table`` in ``parts`` arrivals (dealt by its first column, so each
    holds old and new rows) and feed each as a micro-batch of its own."""
    from tokenmeter.session import scratch_path
    from tokenmeter.streaming.io import file_stream

    landing = scratch_path(spark, "landing", name)
    for k in range(parts):
        table.filter(F.pmod(table.columns[0], F.lit(parts)) == k).write.mode("append").parquet(landing)
        feed(file_stream(spark, landing, "*.parquet", files_per_trigger=None, schema=table.schema))


def _daily_stream(spark, sf_dir):
    """Three micro-batches, each with late rows of all days and rows without a
    time."""
    from tokenmeter.sources.tables import read_table
    from tokenmeter.streaming.rollups import DailyStream

    configure(spark)
    stream = DailyStream(spark)
    events = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "value", "props"])
    _in_turn(spark, events, "events", 3, lambda part: stream.feed(fx.late_ledger(part)))
    return stream.daily()


def q_stream_usage_daily(spark, sf_dir):
    return _daily_stream(spark, sf_dir)


def q_stream_usage_monthly(spark, sf_dir):
    from tokenmeter.streaming.rollups import monthly_from_daily

    return monthly_from_daily(_daily_stream(spark, sf_dir))


def q_stream_usage_windowed(spark, sf_dir):
    """Daily usage by a stateful windowed aggregate.  Three arrivals: the first and
    third come in order of time, the second mixes all days; rows without a time
    are in each."""
    from tokenmeter.session import scratch_path
    from tokenmeter.sources.tables import read_table
    from tokenmeter.streaming.io import file_stream
    from tokenmeter.streaming.windows import WindowedDaily

    configure(spark)
    stream, landing = WindowedDaily(spark), scratch_path(spark, "landing", "windowed")
    ev = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "value", "props"])
    mixed, early = F.col("event_id") % 5 == 0, F.coalesce(F.col("ts") < ts_ntz(CLOCK.as_of), F.lit(True))
    for arrival in (~mixed & early, mixed, ~mixed & ~early):
        ev.filter(arrival).write.mode("append").parquet(landing)
        stream.feed(fx.late_ledger(file_stream(spark, landing, "*.parquet", files_per_trigger=None, schema=ev.schema)))
    return stream.daily()


def _ledger_stream(spark, sf_dir) -> tuple[str, str]:
    """Bodies land in three arrivals, each with its repeats of the one before;
    returns the folders of the ledger and of the registrations."""
    from tokenmeter.session import scratch_path
    from tokenmeter.streaming.io import run_available
    from tokenmeter.streaming.ledger import start_ledger_ingest

    _, groups, _ = _inputs(spark, sf_dir)
    bodies = fx.bodies(spark, sf_dir)
    ledger_path, groups_path = scratch_path(spark, "tables", "ledger"), scratch_path(spark, "tables", "registrations")
    checkpoint = scratch_path(spark, "checkpoints", "ledger")
    _in_turn(spark, bodies, "bodies", 3, lambda part: run_available(start_ledger_ingest(
        spark, part.union(part), ledger_path, groups_path, groups, checkpoint, recorded_at=ts_ntz(CLOCK.as_of), once="7 days")))
    return ledger_path, groups_path


def q_stream_ledger(spark, sf_dir):
    from tokenmeter.sources.schemas import LEDGER

    return spark.read.parquet(_ledger_stream(spark, sf_dir)[0]).select(*LEDGER.fieldNames())


def q_stream_registrations(spark, sf_dir):
    """Users registered by the ledger stream, each once."""
    from tokenmeter.streaming.ledger import registrations

    return registrations(spark, _ledger_stream(spark, sf_dir)[1]).all()


def _in_halves(spark, sf_dir, start) -> None:
    """The events arrive in two halves (split at the midpoint of their time
    span); the stream of ``start`` runs over each arrival in turn."""
    from tokenmeter.session import scratch_path
    from tokenmeter.sources.tables import read_table
    from tokenmeter.streaming.io import file_stream, run_available

    configure(spark)
    ev = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "value", "props"])
    groups = fx.user_groups(fx.request_log(spark, sf_dir), every_user=True)
    lo, hi = ev.agg(F.min("ts"), F.max("ts")).first()
    landing = scratch_path(spark, "landing", "events")
    halves = [ev] if lo is None else [ev.filter(F.col("ts") < F.lit(lo + (hi - lo) / 2)),
                                      ev.filter(F.col("ts") >= F.lit(lo + (hi - lo) / 2))]
    for part in halves:
        part.write.mode("append").parquet(landing)
        stream = file_stream(spark, landing, "*.parquet", files_per_trigger=None, schema=ev.schema)
        run_available(start(fx.requests_from_events(stream), groups, fx.usage_limits(spark)))


def q_stream_gate(spark, sf_dir):
    """One checkpoint, so the second micro-batch continues the first one's days
    and months through the carry table."""
    from tokenmeter.session import scratch_path
    from tokenmeter.streaming.gate import start_stream_gate

    sink, state, checkpoint = (scratch_path(spark, kind, "gate") for kind in ("sinks", "state", "checkpoints"))
    _in_halves(spark, sf_dir, lambda requests, groups, limits: start_stream_gate(requests, groups, limits, sink, state, checkpoint,
                                                                                 today=lambda: CLOCK.as_of_date))
    return spark.read.parquet(sink).drop("batch_id")


def q_stream_gate_keyed(spark, sf_dir):
    """The same over Spark's keyed state; each half is a run of its own, so the
    second one restarts from the checkpoint."""
    from tokenmeter.session import scratch_path
    from tokenmeter.streaming.keyed import keyed_state, start_keyed_gate

    sink, checkpoint = scratch_path(spark, "sinks", "keyed-gate"), scratch_path(spark, "checkpoints", "keyed-gate")
    with keyed_state(spark):
        _in_halves(spark, sf_dir, lambda requests, groups, limits: start_keyed_gate(requests, groups, limits, sink, checkpoint))
    return spark.read.parquet(sink).drop("batch_id")


QUERIES: dict[str, Query] = {
    "ledger_scan": q_ledger_scan,
    "groups_dim": q_groups_dim,
    "usage_daily": q_usage_daily,
    "usage_monthly": q_usage_monthly,
    "usage_monthly_orders": q_usage_monthly_orders,
    "tokens_today": q_tokens_today,
    "tokens_month_to_date": q_tokens_month_to_date,
    "usage_summary": q_usage_summary,
    "users_near_limit": q_users_near_limit,
    "user_usage_status": q_user_usage_status,
    "orphan_groups": q_orphan_groups,
    "usage_history_by_group": q_usage_history_by_group,
    "gate_decisions": q_gate_decisions,
    "gate_decisions_advisory": q_gate_decisions_advisory,
    "status_lines": q_status_lines,
    "block_notices": q_block_notices,
    "gate_replay": q_gate_replay,
    "gate_replay_by_tier": q_gate_replay_by_tier,
    "post_response_warnings": q_post_response_warnings,
    "usage_extract": q_usage_extract,
    "usage_recordable": q_usage_recordable,
    "record_usage": q_record_usage,
    "register_first_seen": q_register_first_seen,
    "seed_limits": q_seed_limits,
    "upsert_groups": q_upsert_groups,
    "retention_kept": q_retention_kept,
    "retention_deleted_count": q_retention_deleted_count,
    "ledger_violations": q_ledger_violations,
    "ledger_store": q_ledger_store,
    "purged_usage_daily": q_purged_usage_daily,
    "purged_usage_monthly": q_purged_usage_monthly,
    "usage_summary_maintained": q_usage_summary_maintained,
    "view_user_usage": q_view_user_usage,
    "view_near_limits": q_view_near_limits,
    "sql_user_usage_status": q_sql_user_usage_status,
    "sql_record_usage": q_sql_record_usage,
    "sql_cleanup": q_sql_cleanup,
    "tier_store": q_tier_store,
    "annotated_messages": q_annotated_messages,
    "stream_usage_daily": q_stream_usage_daily,
    "stream_usage_monthly": q_stream_usage_monthly,
    "stream_usage_windowed": q_stream_usage_windowed,
    "stream_ledger": q_stream_ledger,
    "stream_registrations": q_stream_registrations,
    "stream_gate": q_stream_gate,
    "stream_gate_keyed": q_stream_gate_keyed,
}
