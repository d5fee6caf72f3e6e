"""Time windows and bucket lists that select part of the bid log."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date, datetime, timedelta
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

from bidweave.schema import ALL_BUCKETS

ONE_HOUR = timedelta(hours=1)


def _day(value: str | date) -> date:
    if isinstance(value, datetime):
        return value.date()
    return value if isinstance(value, date) else date.fromisoformat(value)


@dataclass(frozen=True)
class Window:
    """``hours`` whole hours from ``start``, in the session time zone."""

    start: datetime
    hours: int

    @classmethod
    def day(cls, day: str | date | None = None, today: date | None = None) -> Window:
        """All hours of a day; without a day (or with "None"), of yesterday."""
        if day in (None, "", "None"):
            day = (today or date.today()) - timedelta(days=1)
        return cls(datetime.combine(_day(day), datetime.min.time()), 24)

    @classmethod
    def hour(cls, day: str | date | None, hour: int | str, today: date | None = None) -> Window:
        """One hour of a day; "5" and "05" mean the same hour."""
        number = int(hour)
        if not 0 <= number <= 23:
            raise ValueError(f"hour must be 0..23, got {hour!r}")
        return cls(cls.day(day, today).start + timedelta(hours=number), 1)

    @classmethod
    def trailing(
        cls, executed_at: str | datetime, hours: int = 6, zone: str | None = None
    ) -> Window:
        """The ``hours`` whole hours before the execution time.

        A time with an offset is converted to ``zone``, the session's time zone.
        """
        at = executed_at
        if isinstance(at, str):
            at = datetime.fromisoformat(at)
        if at.tzinfo is not None and zone is not None:
            at = at.astimezone(ZoneInfo(zone))
        end = at.replace(minute=0, second=0, microsecond=0, tzinfo=None)
        return cls(end - timedelta(hours=hours), hours)

    @property
    def end(self) -> datetime:
        return self.start + timedelta(hours=self.hours)

    def hours_by_day(self) -> dict[date, list[int]]:
        found: dict[date, list[int]] = {}
        for n in range(self.hours):
            at = self.start + n * ONE_HOUR
            found.setdefault(at.date(), []).append(at.hour)
        return found

    def on_key(self, day: date, hour: int) -> bool:
        return hour in self.hours_by_day().get(day, ())

    def on_partitions(self, day_column: str = "dt", hour_column: str = "hh") -> Column:
        """Predicate on the ``dt`` and ``hh`` partition columns, or columns like them."""
        chosen = F.lit(False)
        for day, hours in self.hours_by_day().items():
            one = F.col(day_column) == F.lit(day)
            if len(hours) < 24:
                one = one & F.col(hour_column).isin(hours)
            chosen = chosen | one
        return chosen


def parse_mods(mods: str | int | Iterable[int] | None) -> list[int] | None:
    """Bucket list from text or numbers; None means all buckets.

    None, "None", an empty text and any list holding 999 select all buckets; an
    empty list, as a caller's filter may leave it, is an error.
    """
    if mods is None or mods == "None":
        return None
    if isinstance(mods, int):
        mods = [mods]
    numbers = [int(m) for m in (mods.split() if isinstance(mods, str) else mods)]
    if not numbers and not isinstance(mods, str):
        raise ValueError("the bucket list is empty; pass None for all buckets")
    if not numbers or ALL_BUCKETS in numbers:
        return None
    return sorted(set(numbers))


def in_mods(bucket: Column, mods: list[int] | None) -> Column:
    return F.lit(True) if mods is None else bucket.isin(mods)
