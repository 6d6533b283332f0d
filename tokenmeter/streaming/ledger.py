"""O-45: chat bodies arriving as a stream -> usage extraction -> ledger
append + first-seen registration, one ``foreachBatch`` per micro-batch.

Both writes of a batch go to that batch's own folders (overwrite), so a
retried batch replaces exactly what it wrote before: the append and the
registration stay together (S22) and are idempotent per batch.  A batch reads
the registrations of all batches before it, and fails if one is missing, so a
user is registered once.  Across batches a repeated body is recorded again
(S21) unless the caller gives a horizon: then a body whose request id arrived
within that time before is not recorded again (D7).  Spark's state store keeps
the ids of the horizon and drops older ones, so the state does not grow with the
history.  Arrival is the micro-batch's own time, so no body comes too late to
be recorded; ``received_at`` names a column instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenmeter.operators.extract import record_usage, usage_extract
from tokenmeter.operators.maintenance import new_users
from tokenmeter.sources.schemas import GROUPS
from tokenmeter.sources.store import with_usage_date, write_version
from tokenmeter.streaming.batches import BatchTable
from tokenmeter.streaming.io import batch_folder

def registrations(spark: SparkSession, groups_path: str) -> BatchTable:
    """New tier rows, one part per batch; users of different parts differ."""
    return BatchTable(spark, groups_path, GROUPS, lambda g: g)


def ingest_batch(spark: SparkSession, ledger_path: str, groups_path: str, base_groups: DataFrame, recorded_at: Column):
    registered = registrations(spark, groups_path)

    def run(batch: DataFrame, batch_id: int) -> None:
        rows = with_usage_date(record_usage(usage_extract(batch), recorded_at))
        out = batch_folder(ledger_path, batch_id)
        rows.write.mode("overwrite").partitionBy("usage_date").parquet(out)
        users = spark.read.schema(rows.schema).parquet(out).select("user_id")
        known = base_groups.select("user_id").unionByName(registered.before(batch_id).select("user_id"))
        registered.write(new_users(known, users, assigned_at=recorded_at), batch_id)

    return run


def once_within(bodies_stream: DataFrame, horizon: str, key: str = "conv_id", received_at: str | None = None) -> DataFrame:
    """Bodies whose id did not arrive within ``horizon`` before."""
    at = F.current_timestamp() if received_at is None else F.col(received_at).cast("timestamp")
    stamped = bodies_stream.withColumn("__received", at).withWatermark("__received", horizon)
    return stamped.dropDuplicatesWithinWatermark([key]).drop("__received")


def start_ledger_ingest(spark, bodies_stream: DataFrame, ledger_path: str, groups_path: str, base_groups: DataFrame,
                        checkpoint: str, recorded_at: Column | None = None, once: str | None = None, received_at: str | None = None):
    at = recorded_at if recorded_at is not None else F.localtimestamp()
    users = base_groups.select("user_id")
    known = spark.read.schema(users.schema).parquet(write_version(users, spark, "stream-known-users"))
    bodies = bodies_stream if once is None else once_within(bodies_stream, once, received_at=received_at)
    return (
        bodies.writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(ingest_batch(spark, ledger_path, groups_path, known, at))
    )
