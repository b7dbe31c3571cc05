"""Run context: the clock, time zone and run switches of one pipeline run.

The reference reads the live clock in several places (current date in
New York, current timestamp). Here one ``RunContext`` carries those values
as literals so a run is reproducible and every stage sees the same instant.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's.
REPORT_TZ = "America/New_York"


@dataclass(frozen=True)
class RunContext:
    now_utc: dt.datetime = field(default_factory=lambda: dt.datetime.now(dt.timezone.utc))
    tz: str = REPORT_TZ
    env: str = "prod"  # full refreshes need an explicit "dev"
    override: bool = False
    full_refresh: bool = False

    @property
    def local_now(self) -> dt.datetime:
        """Wall clock in the reporting zone, without zone info."""
        now = self.now_utc if self.now_utc.tzinfo else self.now_utc.replace(tzinfo=dt.timezone.utc)
        return now.astimezone(ZoneInfo(self.tz)).replace(tzinfo=None)

    @property
    def as_of_date(self) -> dt.date:
        """``current_date(tz)``: today in the reporting zone."""
        return self.local_now.date()

    @property
    def utc_date(self) -> dt.date:
        """``current_date()`` without a zone (UTC)."""
        now = self.now_utc if self.now_utc.tzinfo else self.now_utc.replace(tzinfo=dt.timezone.utc)
        return now.astimezone(dt.timezone.utc).date()

    def as_of(self) -> Column:
        return F.lit(self.as_of_date)

    def today_utc(self) -> Column:
        return F.lit(self.utc_date)

    def created_at(self) -> Column:
        """``CURRENT_TIMESTAMP()`` stamp as a UTC wall-clock timestamp."""
        now = self.now_utc if self.now_utc.tzinfo else self.now_utc.replace(tzinfo=dt.timezone.utc)
        return F.lit(now.astimezone(dt.timezone.utc).replace(tzinfo=None)).cast("timestamp_ntz")

    def local_stamp(self) -> Column:
        """``timestamp(datetime(now, tz))``: local wall clock labelled as a timestamp."""
        return F.lit(self.local_now).cast("timestamp_ntz")

    @classmethod
    def at(cls, when: str | dt.datetime, **kw) -> "RunContext":
        """Context pinned to a UTC instant, e.g. ``RunContext.at('2025-11-28 15:00')``."""
        if isinstance(when, str):
            when = dt.datetime.fromisoformat(when)
        if when.tzinfo is None:
            when = when.replace(tzinfo=dt.timezone.utc)
        return cls(now_utc=when, **kw)
