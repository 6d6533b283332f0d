"""Quota arithmetic: percents, over-limit flags, the unlimited sentinel."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tokenmeter.params import UNLIMITED

PERCENT_TYPE = "decimal(38,2)"


def view_percent(used: Column, limit: Column) -> Column:
    """Percent shown by the summary views: exact NUMERIC division rounded
    half-up to 2 places; an unlimited tier shows 100.00 (so every unlimited
    user is "near" its limit).  D4: a zero limit gives NULL instead of an error."""
    exact = F.try_divide(used.cast("decimal(20,0)"), limit) * F.lit(100)
    return (
        F.when(limit == UNLIMITED, F.lit(100).cast(PERCENT_TYPE))
        .otherwise(F.round(exact, 2).cast(PERCENT_TYPE))
    )


def hook_percent(used: Column, limit: Column) -> Column:
    """Percent used by the request hooks: floating point, 0 when unlimited."""
    return F.when(limit == UNLIMITED, F.lit(0.0)).otherwise(F.try_divide(used.cast("double"), limit.cast("double")) * 100.0)


def is_over(used: Column, limit: Column) -> Column:
    """Over = used >= limit (equality already blocks); never over when unlimited."""
    return F.when(limit == UNLIMITED, F.lit(False)).otherwise(used >= limit)


def under(used: Column, limit: Column) -> Column:
    """Negation of ``is_over`` for non-null inputs."""
    return (limit == UNLIMITED) | (used < limit)
