"""O-47: the gate over a request stream, continuing across micro-batches.

Each micro-batch is replayed with the closed form of ``gate_replay`` (running
sums over a calendar hierarchy: no user's rows are gathered into one group),
seeded by the usage admitted before it.  Admitted usage adds up, so batch ``n``
leaves its own sums per (user, day) and reads the sums of the batches before it
(``batches.BatchTable``), for its own users only.  Carried usage enters the
replay as an offset on the running sums: a stream fed in time order decides
exactly like one replay of the whole log, and a late request sees all usage
recorded so far on its own day and in its own month, as it would at the hook.

Durability: decisions and sums of batch ``n`` go to their own ``batch_id=n``
folders (overwrite); a retried batch recomputes from the same input and
replaces what it wrote.  A missing earlier folder fails the job.  The sums are
derived from the decisions as written, not from a second replay.

Carried days expire against the clock ``today`` (by default the wall clock), never
against times found in the data: days before the month of ``KEEP_DAYS`` ago are
no longer read."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenmeter.operators.gate import gate_replay, has_user
from tokenmeter.params import QuotaSettings
from tokenmeter.sources.store import write_version
from tokenmeter.streaming.batches import BatchTable
from tokenmeter.streaming.io import batch_folder

KEEP_DAYS = 31
CARRY_SCHEMA = "user_id string, day date, used bigint"


def carry_table(spark: SparkSession, state_path: str) -> BatchTable:
    return BatchTable(spark, state_path, CARRY_SCHEMA, lambda c: c.groupBy("user_id", "day").agg(F.sum("used").alias("used")))


def admitted_usage(decisions: DataFrame) -> DataFrame:
    """Usage recorded by a batch, per (user, day)."""
    d = decisions.filter(has_user() & F.col("requested_at").isNotNull() & F.col("admitted"))
    return d.groupBy("user_id", F.to_date("requested_at").alias("day")).agg(
        F.sum(F.coalesce(F.col("total_tokens"), F.lit(0)).cast("long")).alias("used")
    )


def gate_batch(groups: DataFrame, limits: DataFrame, sink: str, state_path: str,
               settings: QuotaSettings = QuotaSettings(), bucket_seconds: int = 60,
               keep_from: Callable[[], dt.date] | None = None):
    """``foreachBatch`` function of the stream gate."""

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        state = carry_table(spark, state_path)
        carry = state.before(batch_id)
        if keep_from is not None:
            carry = carry.filter(F.col("day") >= F.lit(keep_from()))
        carry = carry.join(batch.select("user_id").distinct(), "user_id", "left_semi")
        decisions = gate_replay(batch, groups, limits, settings, bucket_seconds=bucket_seconds, carry=carry)
        out = batch_folder(sink, batch_id)
        decisions.write.mode("overwrite").parquet(out)
        state.write(admitted_usage(spark.read.schema(decisions.schema).parquet(out)), batch_id)

    return run


def utc_today() -> dt.date:
    return dt.datetime.now(dt.timezone.utc).date()


def start_stream_gate(requests: DataFrame, groups: DataFrame, limits: DataFrame, sink: str, state_path: str,
                      checkpoint: str, settings: QuotaSettings = QuotaSettings(),
                      today: Callable[[], dt.date] = utc_today, keep_days: int = KEEP_DAYS):
    """The stream gate as a ``DataStreamWriter`` (caller picks the trigger).
    The tier side is written once, not evaluated again by every batch."""

    def keep_from() -> dt.date:
        return (today() - dt.timedelta(days=keep_days)).replace(day=1)

    spark = requests.sparkSession
    known = spark.read.schema(groups.schema).parquet(write_version(groups, spark, "stream-groups"))
    return (
        requests.writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(gate_batch(known, limits, sink, state_path, settings, keep_from=keep_from))
    )
