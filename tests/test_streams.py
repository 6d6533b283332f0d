"""Streams over Spark's state store: keyed gate, windowed daily usage, bounded
dedupe."""

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from tokenmeter.functions import scan
from tokenmeter.session import scratch_path
from tokenmeter.sources.schemas import LIMITS
from tokenmeter.streaming import ledger as L
from tokenmeter.streaming.gate import gate_batch
from tokenmeter.streaming.io import file_stream, run_available
from tokenmeter.streaming.keyed import keyed_state, start_keyed_gate
from tokenmeter.streaming.windows import WindowedDaily
from test_properties import REQ_DDL, _with_conf, random_log

TIERS = {"0": "pro", "1": "freemium", "2": "enterprise", "3": "gold", "4": "freemium"}
LIMS = {"freemium": (900, 3000), "pro": (2000, 8000), "enterprise": (-1, -1)}


def dims(spark):
    grp = spark.createDataFrame(list(TIERS.items()), "user_id string, group_name string")
    return grp, spark.createDataFrame([(g, d, m, None, None, None, None) for g, (d, m) in LIMS.items()], LIMITS)


def answers(df):
    return {r["id"]: (r["outcome"], r["limit_type"], r["group_name"], r["tokens_today_before"], r["tokens_month_before"], r["total_tokens"]) for r in df.collect()}


@pytest.mark.parametrize("seed,negative", [(21, False), (22, True)])
def test_keyed_gate_decides_as_the_additive_one(spark, seed, negative):
    """Three micro-batches, the last with late requests of earlier days, each in
    a run of its own: the state comes from the checkpoint."""
    rows = random_log(seed, n=200, negative=negative) + [(900, None, dt.datetime(2024, 1, 29), "user", 5), (901, "1", None, "user", 5), (902, "5", dt.datetime(2024, 1, 29), None, None)]
    grp, lim = dims(spark)
    req = spark.createDataFrame(rows, REQ_DDL)
    late = F.col("id") % 11 == 0
    cut = F.col("requested_at") < F.lit(dt.datetime(2024, 1, 30, 7))
    parts = [req.filter(~late & cut), req.filter(~late & ~cut), req.filter(late | F.col("requested_at").isNull())]
    sink, state = scratch_path(spark, "test", "sink"), scratch_path(spark, "test", "state")
    run = gate_batch(grp, lim, sink, state)
    landing, keyed, checkpoint = (scratch_path(spark, "test", n) for n in ("landing", "keyed", "checkpoint"))
    with keyed_state(spark):
        for n, part in enumerate(parts):
            part.write.mode("append").parquet(landing)
            run(part, n)
            run_available(start_keyed_gate(file_stream(spark, landing, "*.parquet", files_per_trigger=None, schema=req.schema), grp, lim, keyed, checkpoint))
    want, got = answers(spark.read.parquet(sink)), answers(spark.read.parquet(keyed))
    assert got == want and len(got) == len(rows) - 2


def test_keyed_gate_forgets_after_keep(spark):
    """A day is dropped when ``keep`` has passed since it was written."""
    grp, lim = dims(spark)
    landing, sink, checkpoint = (scratch_path(spark, "test", n) for n in ("landing", "sink", "checkpoint"))
    day = dt.datetime(2024, 1, 20, 9)

    def land(i):
        spark.createDataFrame([(i, "1", day, "user", 900)], REQ_DDL).coalesce(1).write.mode("append").parquet(landing)

    def wait(n):
        for _ in range(120):
            if query.exception() is not None:
                raise query.exception()
            found = spark.read.schema("id long, outcome string").option("recursiveFileLookup", "true").parquet(sink).collect() if query.lastProgress else []
            if len(found) >= n:
                return {r["id"]: r["outcome"] for r in found}
            time.sleep(0.5)
        raise AssertionError("no answer")

    land(1)
    with keyed_state(spark):
        stream = file_stream(spark, landing, "*.parquet", files_per_trigger=None, schema=spark.createDataFrame([], REQ_DDL).schema)
        query = start_keyed_gate(stream, grp, lim, sink, checkpoint, keep=dt.timedelta(seconds=8)).trigger(processingTime="500 milliseconds").start()
    try:
        wait(1)
        land(2)
        wait(2)
        time.sleep(10)
        land(3)
        assert wait(3) == {1: "allowed", 2: "blocked", 3: "allowed"}
    finally:
        query.stop()


def test_keyed_gate_meets_a_month_once_a_batch():
    """The state is read and written once for each month that a user's requests
    of a micro-batch fall in, however many days those are."""
    from pyspark.sql import Row

    from tokenmeter.streaming import keyed as K

    class Months(dict):
        calls = 0

        def getValue(self, key):
            self.calls += 1
            return self.get(key)

        def updateValue(self, key, value):
            self.calls += 1
            self[key] = value

    class Handle:
        months = Months()

        def getMapState(self, *_):
            return self.months

    gate, handle, request = K.KeyedGate(True, None), Handle(), Row(*K.REQUEST)
    gate.init(handle)
    first = dt.date(2024, 1, 1).toordinal() - dt.date(1970, 1, 1).toordinal()
    log = [request(i, "u", dt.datetime(2024, 1, 1) + dt.timedelta(days=i % 31, hours=i // 31), "user", "pro", 10, first + i % 31, 25, -1, False) for i in range(124)]
    made = [r for half in (log[:62], log[62:]) for r in gate.handleInputRows(("u",), iter(half), None)]
    assert handle.months.calls == 4 and len(handle.months) == 1
    assert [r.admitted for r in sorted(made, key=lambda r: r.id)] == [True] * 93 + [False] * 31
    assert made[-1].tokens_today_before == 30 and made[-1].tokens_month_before == 930


def test_dedupe_state_is_bounded(spark):
    """Over 100 micro-batches the ids held stay those of the horizon; an id that
    comes again within it passes once, later again."""
    landing, out, checkpoint = (scratch_path(spark, "test", n) for n in ("landing", "out", "checkpoint"))
    start = dt.datetime(2024, 1, 1)
    rows = []
    for n in range(100):
        at = start + dt.timedelta(hours=n)
        rows += [(n, 10 * n + i, at) for i in range(10)] + [(n, 10 * (n - 2) + i, at) for i in range(5) if n > 1]
    rows += [(99, 3, start + dt.timedelta(hours=99))]
    spark.createDataFrame(rows, "n int, conv_id long, received_at timestamp_ntz").repartition(1).write.partitionBy("n").parquet(landing)
    progress = []

    def run():
        stream = spark.readStream.schema("conv_id long, received_at timestamp_ntz, n int").option("maxFilesPerTrigger", 1).option("latestFirst", "false").parquet(landing)
        once = L.once_within(stream, "5 hours", received_at="received_at")
        q = once.writeStream.option("checkpointLocation", checkpoint).foreachBatch(lambda b, i: b.write.mode("overwrite").parquet(f"{out}/batch_id={i}")).trigger(availableNow=True).start()
        q.awaitTermination()
        progress.extend(q.recentProgress)

    _with_conf(spark, {"spark.sql.shuffle.partitions": "1", "spark.sql.streaming.numRecentProgressUpdates": "300"}, run)
    kept = spark.read.parquet(out).groupBy("conv_id").count().collect()
    assert {r["conv_id"]: r["count"] for r in kept} == {i: 2 if i == 3 else 1 for i in range(1000)}
    held = [p["stateOperators"][0]["numRowsTotal"] for p in progress if p["numInputRows"]]
    assert len(held) == 100 and max(held[20:99]) == max(held[:20]) == 110


def test_windowed_daily_equals_batch(spark):
    """Late rows, rows without a time, a row dated far ahead, a repeated feed of
    nothing; the aggregate itself drops no row."""
    schema = "user_id string, recorded_at timestamp_ntz, prompt_tokens int, completion_tokens int, total_tokens int"
    day = dt.datetime(2024, 1, 20, 9)
    feeds = [
        [("a", day, 1, 2, 3), ("a", day + dt.timedelta(days=1), 1, 0, 1), ("b", None, 5, 5, 10)],
        [("a", day + dt.timedelta(days=6), 1, 1, 2), ("a", day - dt.timedelta(days=3), 7, 0, 7), ("c", None, 1, 1, 2)],
        [("a", day, 4, 4, 8), ("b", day + dt.timedelta(days=5), 2, 2, 4), ("d", dt.datetime(2030, 1, 1), 1, 1, 2)],
        [("a", day + dt.timedelta(days=6), 3, 3, 6), ("d", dt.datetime(2030, 1, 1, 5), 1, 1, 2), ("b", None, 1, 0, 1)],
        [],
    ]
    stream, landing = WindowedDaily(spark, delay="2 days"), scratch_path(spark, "test", "landing")
    whole = spark.createDataFrame([r for f in feeds for r in f], schema)
    for rows in feeds:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(landing)
        stream.feed(file_stream(spark, landing, "*.parquet", files_per_trigger=None, schema=whole.schema))
    from tokenmeter.operators.rollups import usage_daily

    got, want = stream.daily(), usage_daily(whole)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.select(*got.columns).collect()))
    states = [s for p in stream.progress for s in p["stateOperators"]]
    assert states and all(s["numRowsDroppedByWatermark"] == 0 for s in states)


def test_daily_parts_with_a_gap_fail(spark):
    from tokenmeter.streaming.batches import BatchTable

    path = scratch_path(spark, "test", "parts")
    t = BatchTable(spark, path, "k string, v bigint", lambda d: d.groupBy("k").agg(F.sum("v").alias("v")), every=3)
    for n in (0, 1, 3):
        if n < 3:
            t.write(spark.createDataFrame([("a", 1)], "k string, v bigint"), n)
        else:
            spark.createDataFrame([("a", 1)], "k string, v bigint").write.parquet(f"{path}/batch_id={n}")
    with pytest.raises(RuntimeError):
        t.all()


def test_functions_compose():
    """A composed function moves every room as its requests do one by one."""
    import random

    rnd = random.Random(5)
    for _ in range(60):
        runs = [[(rnd.randrange(-9, 12), rnd.random() < 0.3) for _ in range(rnd.randrange(0, 9))] for _ in range(rnd.randrange(1, 5))]
        made = None
        for run in runs:
            f = scan.of_requests([t for t, _ in run], [a for _, a in run])
            made = f if made is None else scan.then(made, f)
        for h in [-40, -5, -1, 0, 1, 2, 3, 7, 11, 20, 60, scan.FAR]:
            room = h
            for t, always in (x for run in runs for x in run):
                room -= t if always or room > 0 else 0
            assert h - scan.apply(made, h) == room
