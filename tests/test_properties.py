"""Properties: replay closed form = sequential loop; rollup consistency;
maintenance identities; plan shape (pushdown, single ledger scan, bounded windows)."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL
from tokenmeter.operators import gate, maintenance, quota, rollups
from tokenmeter.params import FIXTURE_CLOCK, Clock, QuotaSettings
from tokenmeter.sources import fixtures as fx
from tokenmeter.sources.schemas import LIMITS

REQ_DDL = "id long, user_id string, requested_at timestamp_ntz, role string, total_tokens int"


def python_replay(rows, tiers, lims, blocking=True, admin_bypass=True):
    """The hooks, literally: check status before the request, record if admitted."""
    out, state = {}, {}
    for rid, uid, ts, role, tok in sorted(rows, key=lambda r: (r[1], r[2], r[0])):
        g = tiers.get(uid, "freemium")
        dl, ml = lims.get(g, (1000000, 10000000))
        st = state.setdefault(uid, {"d": None, "m": None, "du": 0, "mu": 0})
        if st["m"] != (ts.year, ts.month):
            st.update(m=(ts.year, ts.month), mu=0, d=None)
        if st["d"] != ts.date():
            st.update(d=ts.date(), du=0)
        over_d = dl != -1 and st["du"] >= dl
        over_m = ml != -1 and st["mu"] >= ml
        admin = admin_bypass and role == "admin"
        admitted = not (over_d or over_m) or admin or not blocking
        label = "daily" if over_d else ("monthly" if over_m else None)
        out[rid] = (admitted, label, st["du"], st["mu"])
        if admitted:
            st["du"] += tok
            st["mu"] += tok
    return out


def random_log(seed, n=400, negative=False, admins=0.1):
    rnd = random.Random(seed)
    start = dt.datetime(2024, 1, 28)
    rows = []
    for i in range(n):
        uid = str(rnd.randrange(6))
        ts = start + dt.timedelta(seconds=rnd.randrange(6 * 86400))  # crosses a month end
        role = "admin" if rnd.random() < admins else "user"
        tok = rnd.randrange(0, 400)
        if negative and rnd.random() < (0.05 if negative is True else negative):
            tok = -rnd.randrange(1, 300)
        rows.append((i, uid, ts, role, tok))
    # ties on time exercise the id tie-break
    rows += [(n + k, "1", start + dt.timedelta(hours=5), "user", 100) for k in range(5)]
    return rows


@pytest.mark.parametrize("seed,negative,bucket,admins", [(1, False, 60, 0.1), (2, False, 7, 0.1), (3, True, 60, 0.1), (4, True, 3600, 0.1), (11, 0.3, 3600, 0.3),
                                                         (12, True, 3600, 0), (13, 0.4, 20000, 0), (14, 0.4, 20000, 0.2), (15, 0.4, 60, 0)])
def test_replay_matches_sequential_loop(spark, seed, negative, bucket, admins):
    """Negative counts of held requests take the closed form, those of requests
    that no limit holds the composed functions; both equal the literal loop."""
    rows = random_log(seed, negative=negative, admins=admins)
    tiers = {"0": "pro", "1": "freemium", "2": "enterprise", "3": "gold", "4": "freemium"}
    lims = {"freemium": (900, 3000), "pro": (2000, 8000), "enterprise": (-1, -1)}
    req = spark.createDataFrame(rows, REQ_DDL)
    grp = spark.createDataFrame(list(tiers.items()), "user_id string, group_name string")
    lim = spark.createDataFrame([(g, d, m, None, None, None, None) for g, (d, m) in lims.items()], LIMITS)
    got = {r["id"]: (r["admitted"], r["limit_type"], r["tokens_today_before"], r["tokens_month_before"])
           for r in gate.gate_replay(req, grp, lim, bucket_seconds=bucket).collect()}
    want = python_replay(rows, tiers, lims)
    assert got == want


@pytest.mark.parametrize("seed,negative", [(7, False), (8, True)])
def test_stream_gate_batches_match_sequential_loop(spark, seed, negative):
    """The log arrives in four slices (one mid-day, one across the month end);
    each is one micro-batch continuing from the carry of the one before."""
    from tokenmeter.session import scratch_path
    from tokenmeter.streaming.gate import gate_batch

    rows = random_log(seed, negative=negative)
    tiers = {"0": "pro", "1": "freemium", "2": "enterprise", "3": "gold", "4": "freemium"}
    lims = {"freemium": (900, 3000), "pro": (2000, 8000), "enterprise": (-1, -1)}
    req = spark.createDataFrame(rows, REQ_DDL)
    grp = spark.createDataFrame(list(tiers.items()), "user_id string, group_name string")
    lim = spark.createDataFrame([(g, d, m, None, None, None, None) for g, (d, m) in lims.items()], LIMITS)
    sink, state = scratch_path(spark, "test", "sink"), scratch_path(spark, "test", "state")
    run = gate_batch(grp, lim, sink, state)
    start = dt.datetime(2024, 1, 28)
    cuts = [start, start + dt.timedelta(hours=36), start + dt.timedelta(days=3, hours=23),
            start + dt.timedelta(days=4, hours=17), start + dt.timedelta(days=7)]
    for i, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
        run(req.filter((F.col("requested_at") >= F.lit(lo)) & (F.col("requested_at") < F.lit(hi))), i)
    got = {r["id"]: (r["admitted"], r["limit_type"], r["tokens_today_before"], r["tokens_month_before"])
           for r in spark.read.parquet(sink).collect()}
    assert got == python_replay(rows, tiers, lims)


def test_replay_unlimited_admits_all(spark):
    rows = random_log(5)
    req = spark.createDataFrame(rows, REQ_DDL)
    lim = spark.createDataFrame([("freemium", -1, -1, None, None, None, None)], LIMITS)
    grp = spark.createDataFrame([], "user_id string, group_name string")
    r = gate.gate_replay(req, grp, lim)
    assert r.filter(~F.col("admitted")).count() == 0 and r.count() == len(rows)


def test_replay_advisory_admits_all(spark):
    rows = random_log(6)
    req = spark.createDataFrame(rows, REQ_DDL)
    lim = spark.createDataFrame([("freemium", 100, 200, None, None, None, None)], LIMITS)
    grp = spark.createDataFrame([], "user_id string, group_name string")
    r = gate.gate_replay(req, grp, lim, settings=QuotaSettings(enable_blocking=False))
    assert r.filter(~F.col("admitted")).count() == 0
    assert r.filter(F.col("outcome") == "advisory").count() > 0


def test_daily_rolls_up_to_monthly(spark):
    led = fx.usage_records(spark, SF_SMALL)
    d = rollups.usage_daily(led).groupBy("user_id").agg(F.sum("total_tokens").alias("t"), F.sum("request_count").alias("n"))
    m = rollups.usage_monthly(led).groupBy("user_id").agg(F.sum("total_tokens").alias("t"), F.sum("request_count").alias("n"))
    assert d.exceptAll(m).count() == 0 and m.exceptAll(d).count() == 0


def test_status_equals_summary_on_tiered_users(spark):
    led = fx.usage_records(spark, SF_SMALL)
    grp, lim = fx.user_groups(led), fx.usage_limits(spark)
    s = quota.usage_summary(led, grp, lim, FIXTURE_CLOCK).select("user_id", "tokens_today", "tokens_this_month")
    st = quota.user_usage_status(grp.select("user_id"), led, grp, lim, FIXTURE_CLOCK).select(
        "user_id", "tokens_today", "tokens_this_month")
    assert s.exceptAll(st).count() == 0 and st.exceptAll(s).count() == 0


def test_retention_partitions_input(spark):
    led = fx.usage_records(spark, SF_SMALL)
    clock = Clock(dt.datetime(2024, 1, 30))
    kept = maintenance.retention_kept(led, clock, 15).count()
    deleted = maintenance.retention_deleted_count(led, clock, 15).collect()[0][0]
    assert kept + deleted == led.count() and deleted == 494


def test_registration_and_seed_idempotent(spark):
    led = fx.usage_records(spark, SF_SMALL)
    grp = fx.user_groups(led)
    once = maintenance.register_first_seen(grp, led)
    twice = maintenance.register_first_seen(once, led)
    assert once.count() == twice.count() == led.select("user_id").distinct().count()
    lim = maintenance.seed_limits(fx.usage_limits(spark), maintenance.default_tiers(spark))
    assert maintenance.seed_limits(lim, maintenance.default_tiers(spark)).count() == lim.count() == 3


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_summary_single_ledger_scan_with_pushed_range(spark):
    df = E.queries()["usage_summary"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().sparkPlan().toString()
    # the tier fixture reads user ids only; exactly one scan reads the token columns
    scans = [l for l in plan.splitlines() if "FileScan parquet" in l and "value:double" in l]
    assert len(scans) == 1, plan
    assert "GreaterThanOrEqual(ts,2024-01-01T00:00)" in scans[0] and "LessThanOrEqual(ts," in scans[0]
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,value:double,props:string>" in scans[0]


def test_replay_windows_are_bounded(spark):
    df = E.queries()["gate_replay"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().sparkPlan().toString()
    windows = [l for l in plan.splitlines() if " Window [" in l]
    assert windows
    for w in windows:
        part = w.split("], [")[1] if "], [" in w else w
        assert "__month" in part or "__bucket" in part, w


def test_replay_shuffles_the_log_once(spark):
    """Of all that the replay returns, one exchange carries whole requests."""
    df = E.queries()["gate_replay"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    rows = [l for l in plan.splitlines() if "Exchange hashpartitioning" in l and "__bucket" in l]
    assert len(rows) <= 2, plan  # the requests, and the bucket table
    scans = [l for l in plan.splitlines() if "FileScan parquet" in l and "event_id" in l]
    assert len(scans) == 1, plan


def test_gate_decisions_reads_requests_once(spark):
    """Status lookups join the requests directly: the request log (the only
    scan reading event_id) is read once, not again for a distinct-id set."""
    df = E.queries()["gate_decisions"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().sparkPlan().toString()
    scans = [l for l in plan.splitlines() if "FileScan parquet" in l and "event_id:bigint" in l]
    assert len(scans) == 1, plan


def test_tier_dimension_broadcast_by_size(spark):
    """No hint is used; the tier table is broadcast because its size is
    under the threshold (checked at runtime by AQE)."""
    df = E.queries()["usage_summary"](spark, SF_SMALL)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in plan
    joins = [l for l in plan.splitlines() if "BroadcastHashJoin" in l and "group_name" in l]
    assert joins, plan
    assert "broadcast" not in df._jdf.queryExecution().logical().toString().lower()


def test_streaming_daily_equals_batch(spark):
    """Three micro-batches with late rows and rows without a time lose none."""
    from tokenmeter.sources.tables import read_table

    stream = E.queries()["stream_usage_daily"](spark, SF_SMALL)
    events = read_table(spark, SF_SMALL, "events", ["event_id", "ts", "user_id", "value", "props"])
    batch = rollups.usage_daily(fx.late_ledger(events)).select(*stream.columns)
    assert batch.filter("usage_date IS NULL").count() > 0
    assert stream.count() == batch.count()
    assert stream.exceptAll(batch).count() == 0 and batch.exceptAll(stream).count() == 0


def test_declared_schemas_match_files(spark):
    from tokenmeter.sources.tables import DECLARED, table_path

    for name, ddl in DECLARED.items():
        path = table_path(SF_SMALL, name)
        assert spark.read.parquet(path).schema.simpleString() == spark.read.schema(ddl).parquet(path).schema.simpleString()


def test_batch_table_folds_and_misses_nothing(spark):
    """Parts of many batches, compacted on the way, add up; a missing part fails."""
    from tokenmeter.session import scratch_path
    from tokenmeter.streaming.batches import BatchTable

    def table(path):
        return BatchTable(spark, path, "k string, v bigint", lambda d: d.groupBy("k").agg(F.sum("v").alias("v")), every=3)

    path = scratch_path(spark, "test", "parts")
    t = table(path)
    for n in range(8):
        assert {r["k"]: r["v"] for r in t.before(n).collect()} == ({"a": n, "b": sum(range(n))} if n else {})
        t.write(spark.createDataFrame([("a", 1), ("b", n)], "k string, v bigint"), n)
    assert {r["k"]: r["v"] for r in t.all().collect()} == {"a": 8, "b": 28}
    with pytest.raises(Exception):
        table(scratch_path(spark, "test", "nothing")).before(1).collect()


def _gate(spark, lims=(("freemium", 1000, 100000),)):
    from tokenmeter.session import scratch_path
    from tokenmeter.streaming.gate import gate_batch

    lim = spark.createDataFrame([(g, d, m, None, None, None, None) for g, d, m in lims], LIMITS)
    grp = spark.createDataFrame([], "user_id string, group_name string")
    sink, state = scratch_path(spark, "test", "sink"), scratch_path(spark, "test", "state")
    run = gate_batch(grp, lim, sink, state)

    def feed(n, *rows):
        run(spark.createDataFrame([(i, u, t, "user", tok) for i, u, t, tok in rows], REQ_DDL), n)
        return {r["id"]: (r["outcome"], r["tokens_today_before"]) for r in spark.read.parquet(f"{sink}/batch_id={n}").collect()}

    return feed


def test_stream_gate_late_and_future_requests(spark):
    """A late request on an exhausted day is blocked; a request of another user
    dated far ahead expires nobody's usage."""
    feed = _gate(spark)
    day = dt.datetime(2024, 1, 20, 9)
    feed(0, (1, "a", day, 1000), (2, "b", day, 1000))
    assert feed(1, (3, "c", dt.datetime(2024, 3, 1), 5), (4, "a", day + dt.timedelta(days=1), 10)) == {3: ("allowed", 0), 4: ("allowed", 0)}
    got = feed(2, (5, "a", day + dt.timedelta(hours=1), 10), (6, "b", day + dt.timedelta(hours=2), 10))
    assert got == {5: ("blocked", 1000), 6: ("blocked", 1000)}


def test_stream_gate_missing_carry_fails(spark):
    with pytest.raises(Exception):
        _gate(spark)(1, (1, "a", dt.datetime(2024, 1, 20), 10))


def test_replay_keeps_requests_without_counts(spark):
    """A user-month whose counts are all NULL comes out whole."""
    t = dt.datetime(2024, 1, 20)
    req = spark.createDataFrame([(1, "a", t, "user", None), (2, "a", t, "user", None), (3, "b", t, "user", 5)], REQ_DDL)
    lim = spark.createDataFrame([("freemium", 10, 100, None, None, None, None)], LIMITS)
    grp = spark.createDataFrame([], "user_id string, group_name string")
    got = {r["id"]: r["outcome"] for r in gate.gate_replay(req, grp, lim).collect()}
    assert got == {1: "allowed", 2: "allowed", 3: "allowed"}


def _with_conf(spark, values, run):
    old = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        return run()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_user_is_split_in_the_status_join(spark, tmp_path):
    """Without broadcasts, one user with half of the requests is split by AQE:
    there is one join on user_id and both its sides are plain shuffles."""
    n = 40_000
    rows = spark.range(n).select(F.col("id"), F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("u"), F.col("id").cast("string"))).alias("user_id"), F.lit("user").alias("role"))
    rows.repartition(16).write.parquet(f"{tmp_path}/r")
    rows.select("id", "user_id", F.expr("timestamp_ntz'2024-01-20 10:00:00'").alias("recorded_at"), F.lit(1).alias("prompt_tokens"), F.lit(1).alias("completion_tokens"),
                F.lit(2).alias("total_tokens")).write.parquet(f"{tmp_path}/l")
    rows.select("user_id", F.lit("freemium").alias("group_name")).distinct().write.parquet(f"{tmp_path}/g")
    lim = spark.createDataFrame([("freemium", 10, 100, None, None, None, None)], LIMITS)

    def run():
        df = gate.gate_decisions(spark.read.parquet(f"{tmp_path}/r"), spark.read.parquet(f"{tmp_path}/l"), spark.read.parquet(f"{tmp_path}/g"), lim, FIXTURE_CLOCK)
        df.collect()
        return df._jdf.queryExecution().executedPlan().toString()

    plan = _with_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
                              "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000", "spark.sql.files.maxPartitionBytes": "30000", "spark.sql.files.openCostInBytes": "1000"}, run)
    assert "SortMergeJoin(skew=true)" in plan, [x for x in plan.splitlines() if "Join" in x]
    final = [x for x in plan.split("== Final Plan ==")[1].split("== Initial Plan ==")[0].splitlines() if "SortMergeJoin" in x and "user_id" in x]
    assert len([x for x in final if "LeftOuter" in x]) <= 2, final


def test_status_of_listed_ids_filters_the_scan(spark, tmp_path):
    led = fx.usage_records(spark, SF_SMALL)
    led.write.parquet(f"{tmp_path}/l")
    stored = spark.read.parquet(f"{tmp_path}/l")
    grp, lim = fx.user_groups(led), fx.usage_limits(spark)
    df = quota.user_usage_status(["11", "12", "999999"], stored, grp, lim, FIXTURE_CLOCK)
    plan = df._jdf.queryExecution().sparkPlan().toString()
    assert any("PushedFilters" in l and "In(user_id" in l for l in plan.splitlines()), plan
    whole = quota.user_usage_status(spark.createDataFrame([("11",), ("12",), ("999999",)], "user_id string"), stored, grp, lim, FIXTURE_CLOCK)
    assert sorted(df.collect()) == sorted(whole.collect()) and df.count() == 3


def test_stored_ledger_spreads_one_day_and_purges(spark, tmp_path):
    from tokenmeter.sources import store

    day = spark.range(200_000).select(F.col("id"), F.concat(F.lit("u"), (F.col("id") % 5000).cast("string")).alias("user_id"), F.expr("timestamp_ntz'2024-01-20 10:00:00'").alias("recorded_at"),
                                      F.lit(1).alias("prompt_tokens"), F.lit(1).alias("completion_tokens"), F.lit(2).alias("total_tokens"))
    path = f"{tmp_path}/ledger"
    _with_conf(spark, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "200000"}, lambda: store.write_ledger(day, path))
    assert len(list((tmp_path / "ledger" / "usage_date=2024-01-20").glob("part-*"))) > 1
    rows = [(1, "a", dt.datetime(2024, 1, 1)), (2, "a", dt.datetime(2024, 1, 10, 3)), (3, "a", dt.datetime(2024, 1, 10, 12)), (4, "a", None)]
    more = spark.createDataFrame([(i, u, t, 1, 1, 2) for i, u, t in rows], "id long, user_id string, recorded_at timestamp_ntz, prompt_tokens int, completion_tokens int, total_tokens int")
    store.write_ledger(more, path)
    assert store.purge_ledger(spark, path, Clock(dt.datetime(2024, 1, 20, 12)), 10) == 2
    left = store.read_ledger(spark, path)
    assert left.count() == 200_002 and {r["id"] for r in left.filter("user_id = 'a'").collect()} == {3, 4}


def test_shared_folder_must_be_set_on_a_cluster(spark, monkeypatch):
    from tokenmeter import session

    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)

    class Session:
        conf = type("Conf", (), {"get": staticmethod(lambda k, d=None: d)})()
        sparkContext = Context()

    with pytest.raises(RuntimeError):
        session.shared_dir(Session())


def test_named_views_answer_sql(spark):
    assert E.queries()["view_user_usage"](spark, SF_SMALL).columns[:2] == ["user_id", "group_name"]
    assert spark.sql("SELECT count(*) FROM usage_monthly").first()[0] > 0
    assert spark.sql("SELECT * FROM users_near_limit").collect() == spark.sql(
        "SELECT * FROM users_near_limit ORDER BY monthly_percent_used DESC, daily_percent_used DESC, user_id").collect()
