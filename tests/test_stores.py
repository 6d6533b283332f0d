"""Stored relations: purge as one step, maintained sums, point lookups, tiers in
buckets, SQL functions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tokenmeter.operators import maintenance, quota, rollups
from tokenmeter.operators.prefix import layered_sums
from tokenmeter.params import FIXTURE_CLOCK, Clock
from tokenmeter.plans.functions import register_functions
from tokenmeter.session import scratch_path
from tokenmeter.sources import fixtures as fx
from tokenmeter.sources.tier_store import TierStore
from tokenmeter.sources.usage_store import UsageStore

COLUMNS = "id long, user_id string, recorded_at timestamp_ntz, prompt_tokens int, completion_tokens int, total_tokens int"


def stored(spark, rows, appends=2):
    store = UsageStore(spark, scratch_path(spark, "test", "store"), COLUMNS)
    for n in range(appends):
        store.append(rows.filter(F.pmod("id", F.lit(appends)) == n), n)
    return store


def same(a, b):
    return sorted(map(str, a.collect())) == sorted(map(str, b.select(*a.columns).collect()))


def state(store):
    ledger = store.ledger().drop("usage_date")
    return sorted(map(str, ledger.collect())), sorted(map(str, store.daily().collect())), sorted(map(str, store.monthly().collect()))


def test_purge_is_seen_whole_or_not_at_all(spark, monkeypatch):
    """A purge killed before its commit changes nothing a reader sees; run again it
    deletes the same rows; asked again it answers the same count."""
    rows = fx.usage_records(spark, SF_SMALL).unionByName(spark.createDataFrame([(-1, "11", None, 1, 1, 2)], COLUMNS))
    store, clock = stored(spark, rows), Clock(dt.datetime(2024, 1, 30, 12))
    before = state(store)

    def killed(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m, pytest.raises(KeyboardInterrupt):
        m.setattr(store, "_commit", killed)
        store.purge(clock, 15)
    assert state(store) == before
    want = maintenance.retention_deleted_count(rows, clock, 15).first()[0]
    assert store.purge(clock, 15) == want > 0
    kept = maintenance.retention_kept(rows, clock, 15)
    assert same(store.ledger().drop("usage_date"), kept)
    assert same(store.daily(), rollups.usage_daily(kept)) and same(store.monthly(), rollups.usage_monthly(kept))
    assert store.purge(clock, 15) == want and store.purge(clock, 20) == 0
    after = state(store)
    assert len(store.vacuum()) == 14 and store.vacuum() == [] and state(store) == after
    later = Clock(dt.datetime(2024, 2, 5))
    assert store.purge(later, 15) == maintenance.retention_deleted_count(kept, later, 15).first()[0] > 0
    kept = maintenance.retention_kept(kept, later, 15)
    assert same(store.daily(), rollups.usage_daily(kept)) and same(store.monthly(), rollups.usage_monthly(kept))


def test_append_repeated_replaces_itself(spark):
    rows = fx.usage_records(spark, SF_SMALL)
    store = stored(spark, rows)
    before = state(store)
    store.append(rows.filter(F.col("id") % 2 == 1), 1)
    assert state(store) == before


def test_maintained_totals_read_one_partition(spark):
    rows = fx.usage_records(spark, SF_SMALL)
    store = stored(spark, rows)
    groups, limits = fx.user_groups(rows), fx.usage_limits(spark)
    totals = store.period_totals(FIXTURE_CLOCK)
    assert same(quota.summary_of(totals, groups, limits), quota.usage_summary(rows, groups, limits, FIXTURE_CLOCK))
    plan = totals._jdf.queryExecution().executedPlan().toString()
    scans = [x for x in plan.splitlines() if "FileScan" in x and "recorded_at" in x]
    filters = scans[0].split("PartitionFilters: [")[1].split("]")[0]
    assert len(scans) == 1 and "usage_date" in filters and "= 2024-01-20" in filters, plan


def test_point_lookup_skips_row_groups(spark, tmp_path):
    """One user of 20,000 in a day: the scan hands on a few row groups' rows."""
    import glob

    import pyarrow.parquet as pq

    rows = spark.range(200_000).select(F.col("id"), F.concat(F.lit("u"), F.lpad((F.xxhash64("id") % 20_000).cast("string"), 6, "0")).alias("user_id"),
                                       F.expr("timestamp_ntz'2024-01-20 10:00:00'").alias("recorded_at"), F.lit(1).alias("prompt_tokens"), F.lit(1).alias("completion_tokens"), F.lit(2).alias("total_tokens"))
    store = UsageStore(spark, f"{tmp_path}/s", COLUMNS)
    store.append(rows.coalesce(1), 0, row_group=100_000)
    files = glob.glob(f"{tmp_path}/s/ledger/usage_date=*/batch_id=0/*.parquet")
    assert sum(pq.ParquetFile(f).num_row_groups for f in files) > 5
    user = rows.first()["user_id"]
    hit = store.ledger().filter(F.col("user_id") == user).select("id", "user_id")
    found = hit.collect()
    scan = hit._jdf.queryExecution().executedPlan().collectLeaves().head()
    read = scan.metrics().get("numOutputRows").get().value()
    assert len(found) == rows.filter(F.col("user_id") == user).count() > 0 and read < 60_000, read


def test_tier_change_leaves_other_buckets(spark, tmp_path):
    groups = spark.range(200).select(F.col("id").cast("string").alias("user_id"), F.lit("freemium").alias("group_name"), F.lit(None).cast("timestamp_ntz").alias("assigned_at"),
                                     F.lit("x").alias("assigned_by"), F.lit("n").alias("notes"))
    store = TierStore(spark, f"{tmp_path}/tiers", buckets=16)
    store.create(groups)
    files = lambda: {p: p.stat().st_mtime_ns for p in (tmp_path / "tiers").glob("bucket=*/*.parquet")}
    before = files()
    batch = spark.createDataFrame([("7", "pro", "admin", "up"), ("new", "pro", "admin", "up")], "user_id string, group_name string, assigned_by string, notes string")
    touched = store.upsert(batch, FIXTURE_CLOCK)
    assert 1 <= len(touched) <= 2
    kept = {p: t for p, t in before.items() if int(p.parent.name.split("=")[1]) not in touched}
    assert kept and kept.items() <= files().items() and len(kept) >= 14
    got = {r["user_id"]: (r["group_name"], r["assigned_by"]) for r in store.read().collect()}
    assert len(got) == 201 and got["7"] == ("pro", "x") and got["new"] == ("pro", "admin") and got["8"] == ("freemium", "x")
    after = files()
    with pytest.raises(Exception):
        store.upsert(batch.union(batch), FIXTURE_CLOCK)
    assert files() == after
    assert store.register(spark.createDataFrame([("8",), ("9",)], "user_id string"), F.lit(None)) == [] and files() == after
    store.register(spark.createDataFrame([("8",), ("other",), ("other",)], "user_id string"), F.lit(None))
    assert store.read().count() == 202


def test_functions_answer_sql(spark):
    rows = fx.usage_records(spark, SF_SMALL)
    groups, limits = fx.user_groups(rows), fx.usage_limits(spark)
    register_functions(spark, rows, groups, limits, FIXTURE_CLOCK)
    users = ["11", "7", "nobody"]
    want = {r["user_id"]: tuple(r)[1:] for r in quota.user_usage_status(users, rows, groups, limits, FIXTURE_CLOCK).collect()}
    for u in users:
        assert tuple(spark.sql(f"SELECT * FROM get_user_usage_status('{u}')").first()) == want[u]
    asked = spark.sql("SELECT a.u, s.* FROM VALUES ('11'), ('7'), ('nobody'), ('7'), (NULL) a(u), LATERAL get_user_usage_status(a.u) s")
    got = asked.collect()
    assert len(got) == 5 and all(tuple(r)[1:] == want[r["u"]] for r in got if r["u"])
    plan = asked._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert tuple(spark.sql("SELECT * FROM record_usage('u', 3, 4, p_chat_id => 'c')").first())[2:] == (3, 4, 7, None, None, "c", "chat")
    assert spark.sql("SELECT * FROM record_usage('u', 2147483647, 1)").count() == 0
    assert spark.sql("SELECT * FROM record_usage('u', NULL, 1)").count() == 0
    gone = spark.sql("SELECT * FROM cleanup_old_usage_records(10)").first()[0]
    assert gone == maintenance.retention_deleted_count(rows, FIXTURE_CLOCK, 10).first()[0]
    assert spark.sql("SELECT * FROM kept_usage_records(10)").count() == rows.count() - gone


def test_layered_sums_over_many_buckets(spark):
    import random

    rnd = random.Random(4)
    rows = [(k, f"u{rnd.randrange(3)}", rnd.randrange(-5, 9)) for k in rnd.sample(range(5000), 600)]
    df = spark.createDataFrame(rows, "k long, user_id string, v int")
    got = {r["k"]: r["s"] for r in layered_sums(df, ["user_id"], "k", F.col("v"), "s", fan=4, layers=3).collect()}
    total, want = {}, {}
    for k, u, v in sorted(rows):
        total[u] = total.get(u, 0) + v
        want[k] = total[u]
    assert got == want
