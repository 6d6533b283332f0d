"""The user→tier dimension stored in hash buckets of ``user_id``, so that a change
rewrites only the buckets its users fall in (O-06, O-07)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenmeter.operators.maintenance import new_users, upsert_groups
from tokenmeter.params import DEFAULT_GROUP, Clock
from tokenmeter.sources.schemas import GROUPS
from tokenmeter.sources.store import write_version

BUCKETS = 64


class TierStore:
    """``buckets`` is fixed when the store is created: a bucket should stay a file
    of some 100 MB."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets

    def _bucketed(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn("bucket", F.pmod(F.xxhash64("user_id"), F.lit(self.buckets)).cast("int"))

    def _write(self, rows: DataFrame) -> None:
        """Replace the buckets that ``rows`` fall in, and no others."""
        columns = [F.col(f.name).cast(f.dataType) for f in GROUPS.fields]
        (self._bucketed(rows.select(*columns)).repartition("bucket").write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(self.path))

    def create(self, groups: DataFrame) -> None:
        self._write(groups)

    def _read(self) -> DataFrame:
        ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in GROUPS.fields)
        return self.spark.read.schema(f"{ddl}, bucket int").parquet(self.path)

    def read(self) -> DataFrame:
        return self._read().drop("bucket")

    def _merged(self, changed_users: DataFrame, merge) -> list[int]:
        touched = sorted(r[0] for r in self._bucketed(changed_users).select("bucket").distinct().collect())  # at most ``buckets``
        if touched:
            old = self._read().filter(F.col("bucket").isin(touched)).drop("bucket")
            made = merge(old)
            # Written elsewhere first: the buckets are still being read, and a
            # batch that fails must leave them as they are.
            staged = self.spark.read.schema(made.schema).parquet(write_version(made, self.spark, "tier-merge"))
            self._write(staged)
        return touched

    def upsert(self, batch: DataFrame, clock: Clock) -> list[int]:
        """O-07; the buckets rewritten.  A user repeated in the batch fails the
        job before anything is replaced."""
        return self._merged(batch.select("user_id"), lambda old: upsert_groups(old, batch, clock))

    def register(self, ledger_rows: DataFrame, assigned_at: Column, default_group: str = DEFAULT_GROUP) -> list[int]:
        """O-06 for the users of ``ledger_rows`` that have no tier row."""
        fresh = new_users(self.read(), ledger_rows, default_group, assigned_at)
        fresh = self.spark.read.schema(fresh.schema).parquet(write_version(fresh, self.spark, "tier-new"))
        return self._merged(fresh.select("user_id"), lambda old: old.unionByName(fresh))
