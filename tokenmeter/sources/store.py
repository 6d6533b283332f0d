"""Persisted relations: the ledger as Parquet partitioned by ``usage_date``
(partition pruning for "today" / "this month" / retention), dimensions as
plain Parquet.  A dimension change writes a new version folder; the purge drops
whole partitions and rewrites only the cutoff day."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenmeter.functions.literals import ts_ntz
from tokenmeter.params import DEFAULT_RETENTION_DAYS, Clock
from tokenmeter.session import scratch_path


def with_usage_date(ledger: DataFrame) -> DataFrame:
    return ledger.withColumn("usage_date", F.to_date("recorded_at"))


def write_ledger(ledger: DataFrame, path: str, mode: str = "append") -> str:
    """Append (or write) ledger rows, clustered by day so each task writes few
    partition folders.  Rebalancing lets AQE split a large day (an append is
    normally one day) over as many tasks as its size asks for."""
    (
        with_usage_date(ledger)
        .hint("rebalance", F.col("usage_date"))
        .sortWithinPartitions("usage_date", "user_id")
        .write.mode(mode)
        .partitionBy("usage_date")
        .parquet(path)
    )
    return path


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def purge_ledger(spark: SparkSession, path: str, clock: Clock, days: int = DEFAULT_RETENTION_DAYS) -> int:
    """O-08 on a stored ledger: rows strictly older than ``now - days`` go;
    returns how many.  Days before the cutoff's are dropped as partitions, the
    cutoff's own day is rewritten, newer days and rows without a time are not
    touched."""
    cutoff = clock.cutoff(days)
    ledger = read_ledger(spark, path)
    day = F.col("usage_date")
    old = ledger.filter(day < F.lit(cutoff.date()))
    counts = old.groupBy("usage_date").count().collect()  # one row per expired day
    edge = ledger.filter((day == F.lit(cutoff.date())))
    gone = F.col("recorded_at") < ts_ntz(cutoff)
    n_edge, n_gone = edge.agg(F.count(F.lit(1)), F.count(F.when(gone, 1))).first()
    drop = [r["usage_date"] for r in counts]
    if n_gone:
        if n_gone == n_edge:
            drop.append(cutoff.date())
        else:
            kept = spark.read.schema(ledger.schema).parquet(write_version(edge.filter(~gone), spark, "purge"))
            kept.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("usage_date").parquet(path)
    for d in drop:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/usage_date={d.isoformat()}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return sum(r["count"] for r in counts) + n_gone


def write_version(df: DataFrame, spark: SparkSession, name: str) -> str:
    """Write a relation to a fresh folder under the shared root; return it."""
    path = scratch_path(spark, name)
    df.write.mode("errorifexists").parquet(path)
    return path


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write to ``spark.checkpoint.dir`` (survives executor loss) and continue
    from the written data: computed once, lineage cut."""
    spark = df.sparkSession
    return spark.read.schema(df.schema).parquet(write_version(df, spark, "steps"))
