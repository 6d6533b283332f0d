"""O-09: the reference's named views, over any ledger and dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tokenmeter.operators import quota, rollups
from tokenmeter.params import Clock


def register_views(spark: SparkSession, ledger: DataFrame, groups: DataFrame, limits: DataFrame, clock: Clock) -> list[str]:
    """Make the stored relations and the four views queryable by name through
    ``spark.sql``; each is expanded into the plan of the query that names it."""
    views = {
        "usage_records": ledger,
        "user_groups": groups,
        "usage_limits": limits,
        "usage_daily": rollups.usage_daily(ledger),
        "usage_monthly": rollups.usage_monthly(ledger),
        "usage_summary": quota.usage_summary(ledger, groups, limits, clock),
        "users_near_limit": quota.users_near_limit(ledger, groups, limits, clock),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return list(views)
