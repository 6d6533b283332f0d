"""Reading the input tables: Parquet with explicit column lists so every scan
is pruned to what the query reads (``ReadSchema`` in the plan).  The tables
this package reads have declared schemas, so no job reads file footers to
infer one before planning (at scale, inference touches the files first)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


# The schemas of the driver's tables that the queries read
# (timestamps are stored without a zone, hence TIMESTAMP_NTZ).
DECLARED = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
}


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    reader = spark.read.schema(DECLARED[name]) if name in DECLARED else spark.read
    df = reader.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df
