"""Typed SQL literals.  A Python ``datetime`` passed to ``F.lit`` is converted
with the driver's local zone and typed TIMESTAMP; these build TIMESTAMP_NTZ /
DATE literals from text so a predicate on the ledger's timestamp column stays
a plain pushed range."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def ts_ntz(value: dt.datetime) -> Column:
    return F.expr(f"TIMESTAMP_NTZ'{value.isoformat(sep=' ')}'")


def date_lit(value: dt.date) -> Column:
    return F.expr(f"DATE'{value.isoformat()}'")
