"""Helpers the operators share: written intermediate tables, row keys, text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tokenmeter.session import scratch_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Rows up to which a side known to be slim (a few words a row) is broadcast.
BROADCAST_ROWS = 200_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write to a fresh folder under ``spark.checkpoint.dir``
    (shared by all executors, so a lost one costs nothing) and read it back."""
    spark = df.sparkSession
    path = scratch_path(spark, "llm", name)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, by: list[str], order: list, name: str) -> DataFrame:
    """``df`` with ``id`` 0, 1, ... in the given order within equal values of
    ``by`` (never null).  Rows are numbered per range of a sort, on top of the
    ranges before, so no task holds all rows of one value."""
    at = df.orderBy(*by, *order).withColumns({"__part": F.spark_partition_id(), "__row": F.monotonically_increasing_id()})
    at = written(at, name)
    sizes = at.groupBy(*by, "__part").agg(F.count(F.lit(1)).alias("__size"))  # a row per range and value in it
    ahead = sizes.withColumn("__ahead", F.sum("__size").over(Window.partitionBy(*by).orderBy("__part")) - F.col("__size")).drop("__size")
    own = F.row_number().over(Window.partitionBy(*by, "__part").orderBy("__row"))
    rows = at.withColumn("__own", own).join(ahead, [*by, "__part"])
    return rows.select(*df.columns, (F.col("__ahead") + F.col("__own") - 1).alias("id"))


def maybe_broadcast(df: DataFrame, rows: int, bound: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast ``df`` only when its counted ``rows`` are within ``bound``;
    beyond it the join is a shuffle join that AQE may split."""
    return F.broadcast(df) if rows <= bound else df


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only.  ``lower`` is the same on pure ASCII and far
    cheaper than ``translate``, which maps one code point at a time."""
    return F.when(F.octet_length(c) == F.length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def release() -> None:
    """Give freed memory back to the system at the end of a task: workers are
    reused, and what one stage's worker keeps is missing in the next stage."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc
    if trim is not None:
        trim(0)


def text_of(docs: DataFrame, column: str = "text") -> Column:
    return F.coalesce(docs[column].cast("string"), F.lit(""))
