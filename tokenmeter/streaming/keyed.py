"""O-47 over Spark's keyed state: the gate as a stateful processor.

Spark keeps, for each user, a map from month to the tokens recorded on its days,
in its own (RocksDB) state store: a restarted stream continues from its
checkpoint, and a retried batch starts from the state of the batch before.  A
micro-batch reads and writes a user's months that it has requests in, once each,
not days one by one.  A micro-batch's requests of one user are decided in
order of (time, id): a late request sees all usage recorded so far on its own day
and in its own month.  With ``keep`` a user's day is dropped that long after it was
last written (the store drops a month so long after its last day was written).

The processor holds one user's requests of one micro-batch, so the trigger's
size bounds a hot user; ``streaming.gate`` has no such group and decides alike."""

from __future__ import annotations

import datetime as dt
import sys
from contextlib import contextmanager

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tokenmeter.functions.sequential import REPLAY_SCHEMA, step
from tokenmeter.operators.gate import _tier_enricher, has_user, is_admin
from tokenmeter.params import QuotaSettings
from tokenmeter.sources.store import write_version
from tokenmeter.streaming.io import batch_folder

# Executors need this code but not the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


#: A user's days of one month; ``at`` is the batch time a day was last written.
MONTH = "days array<int>, used array<bigint>, at array<bigint>"
REQUEST = ["id", "user_id", "requested_at", "role", "group_name", "total_tokens", "day", "daily_limit", "monthly_limit", "is_admin"]
DECISION = Row(*(c.split()[0] for c in REPLAY_SCHEMA.split(", ")))


class KeyedGate(StatefulProcessor):
    def __init__(self, blocking: bool, keep_ms: int | None):
        self.blocking, self.keep_ms = blocking, keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.months = handle.getMapState("used_by_month", "month int", MONTH, self.keep_ms)

    def handleInputRows(self, key, rows, timerValues):
        now = 0 if self.keep_ms is None else timerValues.getCurrentProcessingTimeInMs()
        month_of = lambda day: (d := dt.date(1970, 1, 1) + dt.timedelta(days=day)).year * 12 + d.month
        month_by_day: dict = {}
        months: dict = {}  # month: {day: [used, at]}
        used: dict = {}  # in the month
        touched = set()
        for r in sorted(rows, key=lambda r: (r[2], r[0] is None, r[0])):
            id_, user, at, role, group, total, day, daily, monthly, admin = r
            if (month := month_by_day.get(day)) is None:
                month = month_by_day[day] = month_of(day)
            if month not in months:
                held = self.months.getValue((month,))
                days = {} if held is None else {d: [n, t] for d, n, t in zip(*held) if self.keep_ms is None or t + self.keep_ms > now}
                months[month], used[month] = days, sum(n for n, _ in days.values())
            tokens = 0 if total is None else total
            today = months[month][day][0] if day in months[month] else 0
            admitted, outcome, label, today, so_far = step({}, day, month, tokens, daily, monthly, bool(admin), self.blocking, today, used[month])
            if admitted:
                months[month][day] = [today + tokens, now]
                used[month] = so_far + tokens
                touched.add(month)
            yield DECISION(id_, user, at, role, group, total, admitted, outcome, label, today, so_far)
        for month in touched:
            days = months[month]
            self.months.updateValue((month,), (list(days), [n for n, _ in days.values()], [t for _, t in days.values()]))

    def close(self) -> None:
        pass


@contextmanager
def keyed_state(spark: SparkSession):
    """Streams started inside keep their state in RocksDB, which this API needs."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.unset(PROVIDER) if before is None else spark.conf.set(PROVIDER, before)


def keyed_decisions(requests: DataFrame, groups: DataFrame, limits: DataFrame, settings: QuotaSettings = QuotaSettings(),
                    keep: dt.timedelta | None = None) -> DataFrame:
    """The stream's decisions (columns of ``gate_replay``).  ``keep`` runs on the
    wall clock, so such a stream takes a processing-time trigger."""
    known = requests.filter(has_user() & F.col("requested_at").isNotNull()).withColumn("role", F.coalesce("role", F.lit("user")))
    tiered = _tier_enricher(groups, limits, settings)(known).withColumns({
        "day": F.unix_date(F.to_date("requested_at")), "daily_limit": F.col("__dl"), "monthly_limit": F.col("__ml"), "is_admin": is_admin(settings)}).select(*REQUEST)
    keep_ms = None if keep is None else int(keep.total_seconds() * 1000)
    return tiered.groupBy("user_id").transformWithState(
        KeyedGate(settings.enable_blocking, keep_ms), REPLAY_SCHEMA, "Update", "None" if keep is None else "ProcessingTime")


def start_keyed_gate(requests: DataFrame, groups: DataFrame, limits: DataFrame, sink: str, checkpoint: str,
                     settings: QuotaSettings = QuotaSettings(), keep: dt.timedelta | None = None):
    """The keyed gate as a ``DataStreamWriter``, to be started within
    ``keyed_state``; decisions of batch ``n`` go to ``batch_id=n``."""
    spark = requests.sparkSession
    known = spark.read.schema(groups.schema).parquet(write_version(groups, spark, "stream-groups"))

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(batch_folder(sink, batch_id))

    return (keyed_decisions(requests, known, limits, settings, keep).writeStream.outputMode("update")
            .option("checkpointLocation", checkpoint).foreachBatch(write))
