"""Job parameters: quota settings and the clock.

D1: the clock is a parameter (``Clock.as_of``).  Ledger rows recorded after
``as_of`` are ignored by "today" / "month to date", which makes every status
query replayable.  Live, nothing lies after now, so results are unchanged.
D2: the default tier is a parameter defaulting to 'freemium'.
D3: the README's tier sizes are not used; the defaults below are the ones the
schema bootstrap seeds.
D6: ``rate_limit_rpm`` is carried in the schema only; it is never enforced.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

# Fixed values that must equal the reference's behaviour.
DEFAULT_GROUP = "freemium"
# Limits used when a user's tier has no row in usage_limits.
FALLBACK_DAILY_LIMIT = 1_000_000
FALLBACK_MONTHLY_LIMIT = 10_000_000
# -1 means "no limit" (only exactly -1).
UNLIMITED = -1
# Threshold of the near-limit view (strict '>' and not configurable).
NEAR_LIMIT_PERCENT = 80
# Seeded tiers: (group_name, daily_token_limit, monthly_token_limit, description)
DEFAULT_TIERS = [
    ("freemium", 1000000, 10000000, "Free tier - 1M/day, 10M/month"),
    ("pro", 5000000, 100000000, "Pro tier - 5M/day, 100M/month"),
    ("enterprise", -1, -1, "Enterprise tier - unlimited (-1 = no limit)"),
]
DEFAULT_REQUEST_TYPE = "chat"
DEFAULT_RETENTION_DAYS = 90
RESET_DAILY = "midnight UTC"
RESET_MONTHLY = "the 1st of next month"


@dataclass(frozen=True)
class QuotaSettings:
    """The settings of the gate that change results (the rest is plumbing)."""

    enable_blocking: bool = True
    show_usage_status: bool = True
    warn_at_percent: int = 80
    admin_bypass: bool = True
    default_group: str = DEFAULT_GROUP


@dataclass(frozen=True)
class Clock:
    """Point in time the status queries are evaluated at (UTC, naive)."""

    as_of: dt.datetime

    @property
    def day_start(self) -> dt.datetime:
        return dt.datetime(self.as_of.year, self.as_of.month, self.as_of.day)

    @property
    def month_start(self) -> dt.datetime:
        return dt.datetime(self.as_of.year, self.as_of.month, 1)

    @property
    def as_of_date(self) -> dt.date:
        return self.as_of.date()

    def cutoff(self, days: int) -> dt.datetime:
        """``now - N days`` of the retention purge."""
        return self.as_of - dt.timedelta(days=days)


# The clock the test fixtures are evaluated at.
FIXTURE_CLOCK = Clock(dt.datetime(2024, 1, 20, 23, 59, 59, 999999))
