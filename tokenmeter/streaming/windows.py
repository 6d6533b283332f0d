"""O-46 over Spark's state store: a windowed aggregate per user and day.

An aggregate that forgets closed windows drops what comes later than its
watermark.  So arrivals are routed first: rows less than ``delay`` behind the
latest time of the micro-batches before go to the aggregate, in update mode; later
ones and rows without a time go to the additive parts (``batches``).  The
router's bound never lies below the aggregate's watermark, which sees the same
rows or fewer, so the aggregate drops nothing.  The daily table is the last
update of each (user, day) plus the additive parts; its state holds the days
within ``delay`` only.

Routed rows of batch ``n`` go to ``batch_id=n`` (overwrite); the aggregate runs
when the router is done, so a retried batch is replaced before it is read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenmeter.operators.rollups import _sums, usage_daily
from tokenmeter.session import scratch_path
from tokenmeter.streaming.batches import BatchTable
from tokenmeter.streaming.io import batch_folder, run_available
from tokenmeter.streaming.rollups import DAILY_KEYS, DAILY_SCHEMA, SUMS, _add_up, daily_parts

LEDGER_ROWS = "user_id string, recorded_at timestamp_ntz, prompt_tokens int, completion_tokens int, total_tokens int"


class WindowedDaily:
    """Feeds of one ledger stream; folders and checkpoints under ``root``."""

    def __init__(self, spark: SparkSession, delay: str = "2 days", root: str | None = None):
        self.spark, self.delay = spark, delay
        self.root = root or scratch_path(spark, "tables", "windowed-daily")
        self.late = daily_parts(spark, f"{self.root}/late")
        self.latest = BatchTable(spark, f"{self.root}/latest", "at timestamp_ntz", lambda t: t.agg(F.max("at").alias("at")))
        last = lambda u: u.groupBy(*DAILY_KEYS).agg(F.max_by(F.struct(*SUMS, "n"), "n").alias("v")).select(*DAILY_KEYS, "v.*")
        self.updates = BatchTable(spark, f"{self.root}/updates", f"{DAILY_SCHEMA}, n bigint", last)
        self.progress: list = []

    def _route(self, batch: DataFrame, batch_id: int) -> None:
        rows = batch.select(*[f.split()[0] for f in LEDGER_ROWS.split(", ")])
        bound = self.latest.before(batch_id).agg((F.max("at") - F.expr(f"INTERVAL {self.delay}")).alias("at")).first()["at"]
        late = F.col("recorded_at").isNull()
        if bound is not None:
            late = late | (F.col("recorded_at") < F.lit(bound))
        self.late.write(usage_daily(rows.filter(late)), batch_id)
        self.latest.write(rows.agg(F.max("recorded_at").alias("at")), batch_id)
        rows.filter(~late).write.mode("overwrite").parquet(batch_folder(f"{self.root}/on-time", batch_id))

    def _aggregate(self):
        rows = self.spark.readStream.schema(LEDGER_ROWS).option("recursiveFileLookup", "true").parquet(f"{self.root}/on-time")
        sums = rows.withColumn("at", F.col("recorded_at").cast("timestamp")).withWatermark("at", self.delay)
        sums = sums.groupBy("user_id", F.window("at", "1 day").alias("day")).agg(*_sums())
        sums = sums.select("user_id", F.to_date(F.col("day.start")).alias("usage_date"), *SUMS)
        return sums.writeStream.outputMode("update").option("checkpointLocation", f"{self.root}/checkpoint-windows").foreachBatch(
            lambda b, n: self.updates.write(b.withColumn("n", F.lit(n).cast("long")), n))

    def feed(self, ledger_stream: DataFrame) -> None:
        run_available(ledger_stream.writeStream.option("checkpointLocation", f"{self.root}/checkpoint-route").foreachBatch(self._route))
        query = self._aggregate().trigger(availableNow=True).start()
        query.awaitTermination()
        self.progress += query.recentProgress

    def daily(self) -> DataFrame:
        """Usage per (user, day) of all rows fed so far."""
        return _add_up(self.updates.all().select(*DAILY_KEYS, *SUMS).unionByName(self.late.all()), DAILY_KEYS)
