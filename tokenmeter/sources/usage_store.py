"""A stored ledger with maintained rollups and an atomic purge.

Folders under one root:

* ``ledger/usage_date=D/batch_id=N`` rows of append ``N``, sorted by user with a
  bloom filter on ``user_id``: a point lookup skips row groups;
* ``daily`` and ``monthly``: signed sums per user and day / month, one part per append;
* ``taken-daily/cutoff=C``, ``taken-monthly/cutoff=C``: the negative sums of what
  the purge at cutoff ``C`` took out;
* ``purges/cutoff=C``: one row, the purge's commit.

A repeated append ``N`` replaces its own partitions.  A purge writes its negative
sums first and then commits with one file.  Readers hide rows before the last
committed cutoff and add up the negative sums of committed purges only, so they see
a purge whole or not at all; a killed purge starts over, and a committed one
answers its count again.  Whole days are taken from the daily sums, without
reading the ledger; of the ledger only the cutoff's own day is read.  ``vacuum``
deletes the folders of days that a committed purge hides, as a later, repeatable
step."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenmeter.functions.literals import ts_ntz
from tokenmeter.operators.rollups import usage_daily
from tokenmeter.params import DEFAULT_RETENTION_DAYS, Clock
from tokenmeter.sources.store import with_usage_date

SUMS = ["prompt_tokens", "completion_tokens", "total_tokens", "request_count"]
SUM_DDL = ", ".join(f"{c} bigint" for c in SUMS)
DAY_KEYS, MONTH_KEYS = ["user_id", "usage_date"], ["user_id", "usage_month"]
DAILY = f"user_id string, usage_date date, {SUM_DDL}"
MONTHLY = f"user_id string, usage_month timestamp_ntz, {SUM_DDL}"
PURGES = "at timestamp_ntz, deleted bigint, cutoff string"
#: Rows of one row group are this many bytes at most: what a point lookup reads.
ROW_GROUP = 8 << 20


def added_up(parts: DataFrame, keys: list) -> DataFrame:
    """Signed sums per key; a key whose rows are all gone goes too."""
    return parts.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in SUMS]).filter(F.col("request_count") != 0)


def months_of(daily: DataFrame) -> DataFrame:
    month = F.to_timestamp_ntz(F.trunc("usage_date", "month")).alias("usage_month")
    return daily.groupBy("user_id", month).agg(*[F.sum(c).alias(c) for c in SUMS])


class UsageStore:
    def __init__(self, spark: SparkSession, root: str, columns: str):
        """``columns``: the ledger's columns as DDL."""
        self.spark, self.root, self.columns = spark, root.rstrip("/"), columns

    def _path(self, *parts: str) -> str:
        return "/".join([self.root, *parts])

    def _read(self, schema: str, *paths: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    # -- appending

    def append(self, rows: DataFrame, batch_id: int, row_group: int = ROW_GROUP) -> None:
        """O-05: rows of one append; a repeated ``batch_id`` replaces them."""
        daily = usage_daily(rows)
        daily.write.mode("overwrite").parquet(self._path("daily", f"batch_id={batch_id}"))
        written = self._read(DAILY, self._path("daily", f"batch_id={batch_id}"))
        months_of(written).write.mode("overwrite").parquet(self._path("monthly", f"batch_id={batch_id}"))
        (with_usage_date(rows).withColumn("batch_id", F.lit(batch_id))
         .hint("rebalance", F.col("usage_date")).sortWithinPartitions("usage_date", "user_id", "recorded_at")
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("parquet.block.size", row_group)
         .option("parquet.bloom.filter.enabled#user_id", "true").partitionBy("usage_date", "batch_id").parquet(self._path("ledger")))

    # -- reading

    def purges(self) -> list:
        """Committed purges by cutoff: one row each."""
        begun = self.spark.createDataFrame([], "at timestamp_ntz, deleted bigint")  # the folder can be read before the first purge
        begun.write.mode("ignore").parquet(self._path("purges", "cutoff=none"))
        return self.spark.read.schema(PURGES).parquet(self._path("purges")).orderBy("at").collect()

    def ledger(self) -> DataFrame:
        """Rows that no committed purge took: by partition before the cutoff's day,
        by time on it.  Rows without a time stay."""
        rows = self._read(f"{self.columns}, usage_date date, batch_id int", self._path("ledger")).drop("batch_id")
        done = self.purges()
        if not done:
            return rows
        cutoff = done[-1]["at"]
        day = F.col("usage_date")
        kept = day.isNull() | (day > F.lit(cutoff.date())) | ((day == F.lit(cutoff.date())) & (F.col("recorded_at") >= ts_ntz(cutoff)))
        return rows.filter(kept)

    def _sums(self, name: str, schema: str, keys: list) -> DataFrame:
        parts = self.spark.read.schema(schema).parquet(self._path(name))
        taken = [self._path(f"taken-{name}", f"cutoff={p['cutoff']}") for p in self.purges()]
        return added_up(parts.select(*keys, *SUMS).unionByName(self._read(schema, *taken)), keys)

    def daily(self) -> DataFrame:
        """O-26 from the signed sums."""
        return self._sums("daily", DAILY, DAY_KEYS)

    def monthly(self) -> DataFrame:
        """O-27 from the signed sums."""
        return self._sums("monthly", MONTHLY, MONTH_KEYS)

    def period_totals(self, clock: Clock) -> DataFrame:
        """Today and month to date (O-28, O-29) per user: folded days of the month
        before today, and of the ledger only today's partition."""
        today = F.lit(clock.as_of_date)
        before = self.daily().filter((F.col("usage_date") >= F.lit(clock.month_start.date())) & (F.col("usage_date") < today))
        raw = self.ledger().filter((F.col("usage_date") == today) & (F.col("recorded_at") <= ts_ntz(clock.as_of)))
        none = F.lit(None).cast("long")
        both = before.select("user_id", none.alias("d"), F.col("total_tokens").alias("m")).unionByName(
            raw.groupBy("user_id").agg(F.sum("total_tokens").alias("d")).select("user_id", "d", F.col("d").alias("m")))
        return both.groupBy("user_id").agg(F.sum("d").alias("tokens_today"), F.sum("m").alias("tokens_this_month"))

    # -- purging

    def purge(self, clock: Clock, days: int = DEFAULT_RETENTION_DAYS) -> int:
        """O-08: hide rows strictly older than ``now - days``; how many they were."""
        cutoff = clock.cutoff(days)
        name = cutoff.strftime("%Y%m%dT%H%M%S%f")
        done = self.purges()
        for p in done:
            if p["cutoff"] == name:
                return p["deleted"]
        if done and done[-1]["at"] >= cutoff:
            return 0
        whole = self.daily().filter(F.col("usage_date") < F.lit(cutoff.date()))
        edge = self.ledger().filter((F.col("usage_date") == F.lit(cutoff.date())) & (F.col("recorded_at") < ts_ntz(cutoff)))
        gone = whole.unionByName(usage_daily(edge))
        taken = gone.select(*DAY_KEYS, *[(-F.col(c)).alias(c) for c in SUMS])
        daily, monthly = self._path("taken-daily", f"cutoff={name}"), self._path("taken-monthly", f"cutoff={name}")
        taken.write.mode("overwrite").parquet(daily)
        taken = self._read(DAILY, daily)
        months_of(taken).write.mode("overwrite").parquet(monthly)
        deleted = -(taken.agg(F.sum("request_count")).first()[0] or 0)
        self._commit(name, cutoff, deleted)
        return deleted

    def _commit(self, name: str, cutoff: dt.datetime, deleted: int) -> None:
        one = self.spark.createDataFrame([(cutoff, deleted)], "at timestamp_ntz, deleted bigint")
        one.coalesce(1).write.mode("overwrite").parquet(self._path("purges", f"cutoff={name}"))

    def vacuum(self) -> list[dt.date]:
        """Delete the ledger folders of days that a committed purge hides."""
        done = self.purges()
        if not done:
            return []
        day = F.col("usage_date")
        rows = self._read("usage_date date, batch_id int", self._path("ledger"))
        hidden = [r[0] for r in rows.filter(day < F.lit(done[-1]["at"].date())).select(day).distinct().collect()]  # one per expired day
        for d in hidden:
            folder = self.spark._jvm.org.apache.hadoop.fs.Path(self._path("ledger", f"usage_date={d.isoformat()}"))
            folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)
        return hidden
