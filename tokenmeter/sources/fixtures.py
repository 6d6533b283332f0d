"""The metering relations derived from the driver's tables.

* ``usage_records`` (the ledger) from ``events``: one row per event,
  prompt = floor(value*100), completion = 10 * props.k.
* ``usage_limits``: a literal tier table sized so both limits bite.
* ``user_groups``: every ledger user except every 7th (those exercise the
  "no tier row" path); tier by user_id % 10.
* ``request_log``: the same events seen as incoming requests; role 'admin'
  when user_id % 13 = 0.
* ``bodies``: one chat payload (JSON) per conversation, usage placed by
  conv_id % 6 (see FIXTURES.md).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tokenmeter.sources.schemas import LIMITS
from tokenmeter.sources.tables import read_table

# Fixed values of the test tier table: (group_name, daily, monthly).
FIXTURE_TIERS = [
    ("freemium", 15000, 250000),
    ("pro", 40000, 500000),
    ("enterprise", -1, -1),
]


def _prompt(value: str = "value"):
    return F.floor(F.col(value) * 100).cast("int")


def _completion(props: str = "props"):
    return F.get_json_object(F.col(props), "$.k").cast("int") * 10


def usage_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger_from_events(read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "value", "props"]))


def ledger_from_events(ev: DataFrame) -> DataFrame:
    """Ledger projection of ``events`` rows (batch or stream)."""
    p, c = _prompt(), _completion()
    return ev.select(
        F.col("event_id").alias("id"),
        F.col("user_id").cast("string").alias("user_id"),
        F.col("ts").alias("recorded_at"),
        p.alias("prompt_tokens"),
        c.alias("completion_tokens"),
        (p + c).alias("total_tokens"),
    )


def usage_limits(spark: SparkSession) -> DataFrame:
    rows = [(g, d, m, None, None, None, None) for g, d, m in FIXTURE_TIERS]
    return spark.createDataFrame(rows, LIMITS).select("group_name", "daily_token_limit", "monthly_token_limit")


def tier_of(user_id_col):
    uid = user_id_col.cast("int")
    return (
        F.when(uid % 10 == 0, F.lit("enterprise"))
        .when((uid % 10).isin(1, 2, 3), F.lit("pro"))
        .otherwise(F.lit("freemium"))
    )


def user_groups(ledger: DataFrame, every_user: bool = False) -> DataFrame:
    users = ledger.select("user_id").distinct()
    if not every_user:
        users = users.filter(F.col("user_id").cast("int") % 7 != 0)
    return users.select("user_id", tier_of(F.col("user_id")).alias("group_name"))


def request_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests with the tokens each would consume if admitted."""
    return requests_from_events(read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "value", "props"]))


def requests_from_events(ev: DataFrame) -> DataFrame:
    return ev.select(
        F.col("event_id").alias("id"),
        F.col("user_id").cast("string").alias("user_id"),
        F.col("ts").alias("requested_at"),
        F.when(F.col("user_id") % 13 == 0, F.lit("admin")).otherwise(F.lit("user")).alias("role"),
        (_prompt() + _completion()).alias("total_tokens"),
    )


def request_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A set of user ids to look up: every customer key.  It covers ledger
    users with and without a tier row and ids never seen in the ledger."""
    cust = read_table(spark, sf_dir, "customer", ["c_custkey"])
    return cust.select(F.col("c_custkey").cast("string").alias("user_id"))


def bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One chat body per conversation (conv_id, user_id, payload JSON)."""
    conv = read_table(spark, sf_dir, "conversations", ["conv_id", "turn", "role", "text"])
    per_conv = Window.partitionBy("conv_id")
    is_asst = F.col("role") == "assistant"
    est = F.expr("(length(text) + 3) div 4")
    c = conv.select(
        "conv_id",
        "turn",
        "role",
        F.coalesce("text", F.lit("")).alias("text"),
        F.max(F.when(is_asst, F.col("turn"))).over(per_conv).alias("la"),
        F.min(F.when(is_asst, F.col("turn"))).over(per_conv).alias("fa"),
        F.sum(F.when(~is_asst, est).otherwise(0)).over(per_conv).cast("int").alias("p"),
        F.sum(F.when(is_asst, est).otherwise(0)).over(per_conv).cast("int").alias("k"),
    )
    case = F.col("conv_id") % 6
    usage_frag = (
        F.when((case == 2) & (F.col("turn") == F.col("la")),
               F.format_string(',"usage":{"prompt_tokens":%d,"completion_tokens":%d}', "p", "k"))
        .when((case == 3) & (F.col("turn") == F.col("fa")),
              F.format_string(',"usage":{"prompt_tokens":0,"prompt_eval_count":%d,"eval_count":%d}', "p", "k"))
        .when((case == 4) & (F.col("turn") == F.col("la")),
              F.format_string(',"usage":{"prompt_tokens":%d,"completion_tokens":%d}',
                              F.col("p") * 2, F.col("k") * 2))
        .when((case == 5) & (F.col("turn") == F.col("la")), F.lit(',"usage":null'))
        .otherwise(F.lit(""))
    )
    written = F.to_json(F.struct("role", F.col("text").alias("content")))
    m = c.select(
        "conv_id", "turn", "p", "k",
        # to_json(struct(role, content)) without its closing brace, then the usage
        F.concat(F.substring(written, F.lit(1), F.length(written) - 1), usage_frag, F.lit("}")).alias("j"),
    )
    g = m.groupBy("conv_id").agg(
        F.max("p").alias("p"),
        F.max("k").alias("k"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "j"))), lambda x: x["j"]), ",").alias("msgs"),
    )
    # What the hooks and providers leave in a body, by conv_id.
    cid = F.col("conv_id")
    usage = (
        F.when(cid % 13 == 0, F.lit("{}"))
        .when(cid % 19 == 0, F.format_string('{"prompt_tokens":3000000000,"completion_tokens":%d}', "k"))
        .when(cid % 23 == 0, F.format_string('{"prompt_tokens":"12","completion_tokens":%d}', "k"))
        .otherwise(F.format_string('{"prompt_tokens":%d,"completion_tokens":%d}', "p", "k"))
    )
    body_usage = F.when((cid % 6).isin(1, 4, 5), F.concat(F.lit(',"usage":'), usage)).otherwise(F.lit(""))
    flag = F.when(cid % 11 == 0, ',"_usage_blocked":true').when(cid % 11 == 1, ',"_usage_blocked":"false"').when(cid % 11 == 2, ',"_usage_blocked":0').otherwise("")
    tag = F.when(cid % 7 == 0, F.format_string(',"_usage_user_id":"%d"', cid % 15 + 1)).otherwise("")
    return g.select(
        "conv_id",
        F.when(cid % 17 != 0, (cid % 15).cast("string")).alias("user_id"),
        F.concat(F.lit('{"model":"m1","chat_id":"'), cid.cast("string"), F.lit('"'), body_usage, flag, tag,
                 F.lit(',"messages":['), F.col("msgs"), F.lit("]}")).alias("payload"),
    )


def late_ledger(ev: DataFrame) -> DataFrame:
    """The ledger with rows that lack a time (every 97th event)."""
    return ledger_from_events(ev.withColumn("ts", F.when(F.col("event_id") % 97 != 0, F.col("ts"))))


def dirty_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger with rows that break every rule of the stored table, by
    event_id % 50 (0 .. 9), and all its text columns."""
    led = usage_records(spark, sf_dir)
    k = F.col("id") % 50
    long = F.repeat(F.lit("x"), 300)
    return led.select(
        "id",
        F.when(k == 0, None).when(k == 5, long).otherwise(F.col("user_id")).alias("user_id"),
        "recorded_at",
        F.when(k != 1, F.col("prompt_tokens")).alias("prompt_tokens"),
        F.when(k != 2, F.col("completion_tokens")).alias("completion_tokens"),
        F.when(k == 3, None).when(k == 4, F.col("total_tokens") + 1).otherwise(F.col("total_tokens")).alias("total_tokens"),
        F.when(k == 6, long).otherwise(F.lit("m1")).alias("model_id"),
        F.when(k == 7, long).alias("pipeline_id"),
        F.when(k == 8, long).alias("chat_id"),
        F.when(k == 9, long).otherwise(F.lit("chat")).alias("request_type"),
    )


def second_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A ledger spanning many calendar months (orders: user = customer,
    total = floor(price)), used where month rollover matters."""
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"])
    tot = F.floor(F.col("o_totalprice")).cast("int")
    return o.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").cast("string").alias("user_id"),
        F.col("o_orderdate").cast(T.TimestampNTZType()).alias("recorded_at"),
        tot.alias("prompt_tokens"),
        F.lit(0).alias("completion_tokens"),
        tot.alias("total_tokens"),
    )


def user_group_rows(ledger: DataFrame) -> DataFrame:
    """``user_groups`` with the bookkeeping columns of the stored table."""
    return user_groups(ledger).select(
        "user_id", "group_name",
        F.lit(None).cast(T.TimestampNTZType()).alias("assigned_at"),
        F.lit("bootstrap").alias("assigned_by"),
        F.lit("initial").alias("notes"),
    )


def tier_change_batch(ledger: DataFrame) -> DataFrame:
    """An upsert batch covering every ledger user: each moves to the tier of
    the next id (users without a tier row are inserted)."""
    users = ledger.select("user_id").distinct()
    return users.select(
        "user_id",
        tier_of(F.col("user_id").cast("int") + 1).alias("group_name"),
        F.lit("admin").alias("assigned_by"),
        F.lit("upgrade").alias("notes"),
    )
