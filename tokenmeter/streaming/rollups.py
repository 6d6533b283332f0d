"""O-46: daily usage maintained incrementally, monthly derived from it.

Sums and counts add up, so each micro-batch writes its own partial sums per
(user, date) and readers add the parts (``batches.BatchTable``).  There is no
watermark and no state: a row counts toward the day of its own timestamp
however late it comes (D8), and rows without a time form the NULL date as in
the batch view (S10).  The monthly rollup aggregates the daily table: at most
31 rows per user-month."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenmeter.operators.rollups import usage_daily
from tokenmeter.session import scratch_path
from tokenmeter.streaming.batches import BatchTable
from tokenmeter.streaming.io import run_available

DAILY_KEYS = ["user_id", "usage_date"]
SUMS = ["prompt_tokens", "completion_tokens", "total_tokens", "request_count"]
DAILY_SCHEMA = "user_id string, usage_date date, prompt_tokens bigint, completion_tokens bigint, total_tokens bigint, request_count bigint"


def _add_up(parts: DataFrame, keys: list) -> DataFrame:
    return parts.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in SUMS])


def daily_parts(spark: SparkSession, sink: str) -> BatchTable:
    return BatchTable(spark, sink, DAILY_SCHEMA, lambda parts: _add_up(parts, DAILY_KEYS))


def start_daily(spark: SparkSession, ledger_stream: DataFrame, sink: str, checkpoint: str):
    parts = daily_parts(spark, sink)
    return (
        ledger_stream.writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(lambda batch, batch_id: parts.write(usage_daily(batch), batch_id))
    )


class DailyStream:
    """A daily rollup fed by streams that share one sink and checkpoint."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.sink, self.checkpoint = scratch_path(spark, "sinks", "usage_daily"), scratch_path(spark, "checkpoints", "usage_daily")

    def feed(self, ledger_stream: DataFrame) -> None:
        run_available(start_daily(self.spark, ledger_stream, self.sink, self.checkpoint))

    def daily(self) -> DataFrame:
        return daily_parts(self.spark, self.sink).all()


def monthly_from_daily(daily: DataFrame) -> DataFrame:
    month = F.to_timestamp_ntz(F.trunc(F.col("usage_date"), "month"))
    return _add_up(daily, ["user_id", month.alias("usage_month")])
