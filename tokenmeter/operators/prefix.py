"""Running sums over a time-ordered key without one task per key.

A running sum partitioned by ``user_id`` puts every row of a user in one task;
with one user holding a third of the data that is one task holding a third of
the data.  Here the order is cut into a two-level hierarchy whose fan-out is
bounded by the calendar, not by the data:

    partition  (user_id, month)       buckets per month <= 31 * 86400 / W
    coarse     day   (int)
    fine       bucket of W seconds    rows per bucket = that user's traffic in W seconds
    order      (ts, id)

Row-level windows run per finest group (partition, coarse, fine).  Per-bucket
totals are pre-aggregated (map-side partial sums) and prefix-summed by ONE
window over the partition, ordered by (coarse, fine); a RANGE frame over
``coarse`` gives the sum of earlier coarse groups in the same pass, so
"earlier in the same day" = "earlier in the month" - "earlier days".  The
bucket table is joined back on the finest key, which is also the row window's
partitioning: the rows are shuffled once and only the bucket table moves.

Result columns per value ``n``:
    n__d0  sum over earlier rows of the partition group (e.g. the month)
    n__d1  sum over earlier rows of the same coarse group (e.g. the day)
    n__d2  sum over earlier rows of the same bucket
(``inclusive=True`` also counts the row itself.)
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


@dataclass(frozen=True)
class Hierarchy:
    partition: tuple[str, ...]
    coarse: str
    fine: str
    order: tuple[str, ...]

    @property
    def keys(self) -> list[str]:
        return [*self.partition, self.coarse, self.fine]


def running_sums(
    rows: DataFrame,
    h: Hierarchy,
    values: dict[str, Column],
    inclusive: bool = False,
    bucket_aggs: list[Column] | None = None,
    enrich: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Add ``<name>__d0/1/2`` running sums for every value (see module doc).

    ``bucket_aggs`` are extra aggregates kept per bucket; ``enrich`` maps the
    bucket table before it is joined back, so per-user attributes (tier,
    limits, flags) are looked up per bucket and ride along the one join.
    Hierarchy keys must be non-null; ``coarse`` must be numeric.
    """
    keys = h.keys
    names = list(values)
    end = 0 if inclusive else -1
    within = Window.partitionBy(*keys).orderBy(*h.order).rowsBetween(Window.unboundedPreceding, end)
    r = rows.select("*", *[values[n].cast("long").alias(f"__v_{n}") for n in names])
    r = r.select("*", *[F.coalesce(F.sum(f"__v_{n}").over(within), F.lit(0)).cast("long").alias(f"__w_{n}") for n in names])

    buckets = r.groupBy(*keys).agg(
        *[F.sum(f"__v_{n}").cast("long").alias(f"__t_{n}") for n in names], *(bucket_aggs or [])
    )
    if enrich is not None:
        # Enriching first: a user-keyed join leaves the bucket table hashed on
        # user_id, which already clusters the (user, month) window below.
        buckets = enrich(buckets)
    earlier = Window.partitionBy(*h.partition).orderBy(h.coarse, h.fine).rowsBetween(Window.unboundedPreceding, -1)
    earlier_coarse = Window.partitionBy(*h.partition).orderBy(h.coarse).rangeBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    buckets = buckets.select(
        "*",
        *[F.coalesce(F.sum(f"__t_{n}").over(earlier), zero).alias(f"__p_{n}") for n in names],
        *[F.coalesce(F.sum(f"__t_{n}").over(earlier_coarse), zero).alias(f"__c_{n}") for n in names],
    ).drop(*[f"__t_{n}" for n in names])

    out = r.join(buckets, keys)
    cols = []
    for n in names:
        w, p, c = F.col(f"__w_{n}"), F.col(f"__p_{n}"), F.col(f"__c_{n}")
        cols += [(p + w).alias(f"{n}__d0"), (p - c + w).alias(f"{n}__d1"), w.alias(f"{n}__d2")]
    drop = [f"__{k}_{n}" for n in names for k in ("v", "w", "p", "c")]
    return out.select("*", *cols).drop(*drop)


def layered_sums(rows: DataFrame, partition: list[str], key: str, value: Column, name: str, fan: int = 1024, layers: int = 3) -> DataFrame:
    """``rows`` with ``name``: the sum of ``value`` over the rows of ``partition`` up
    to and including this one, in the order of the integer ``key``.

    Keys are cut into buckets of ``fan``, these into buckets of ``fan`` buckets,
    and so on: a window spans one bucket of rows, or the ``fan`` buckets of a
    larger one (the last layer those of the partition: with three layers of 1024,
    one per 2^30 keys).  No window holds all buckets of a user."""
    zero = F.lit(0).cast("long")
    at = lambda layer: f"__k{layer}"
    r = rows.select("*", F.floor(F.col(key) / fan).alias(at(1)), value.cast("long").alias("__v"))
    upto = Window.partitionBy(*partition, at(1)).orderBy(key).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    tables, totals = [], r.groupBy(*partition, at(1)).agg(F.sum("__v").alias("__t"))
    for layer in range(1, layers + 1):
        last = layer == layers
        if not last:
            totals = totals.withColumn(at(layer + 1), F.floor(F.col(at(layer)) / fan))
        within = [*partition] if last else [*partition, at(layer + 1)]
        earlier = Window.partitionBy(*within).orderBy(at(layer)).rowsBetween(Window.unboundedPreceding, -1)
        tables.append(totals.select(*within, at(layer), F.coalesce(F.sum("__t").over(earlier), zero).alias("__p")))
        totals = totals.groupBy(*within).agg(F.sum("__t").alias("__t"))
    offsets = tables.pop()
    for layer in range(layers - 1, 0, -1):
        above = offsets.withColumnRenamed("__p", "__above")
        offsets = tables.pop().join(above, [*partition, at(layer + 1)]).select(*partition, at(layer), (F.col("__p") + F.col("__above")).alias("__p"))
    r = r.withColumn("__w", F.coalesce(F.sum("__v").over(upto), zero)).join(offsets, [*partition, at(1)])
    return r.select(*rows.columns, (F.col("__w") + F.col("__p")).alias(name))
