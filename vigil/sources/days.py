"""Sets of days, for tables written by date."""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date, timedelta
from functools import reduce
from operator import and_

from pyspark.sql import Column, SparkSession, functions as F

from vigil.sources.storage import names_in

DAY = 86400


@dataclass(frozen=True)
class Days:
    """Ranges (first, last) of days, both inclusive; None leaves an end open.

    ``undated`` also counts rows whose date is null.
    """

    ranges: tuple[tuple[date | None, date | None], ...]
    undated: bool = False

    @staticmethod
    def between(first: date | str | None, last: date | str | None) -> Days:
        return Days(((_date(first), _date(last)),))

    @staticmethod
    def of(days: Iterable[date | None]) -> Days:
        """These days, neighbours as one range; None stands for rows without a date."""
        days = set(days)
        ranges: list[tuple[date, date]] = []
        for day in sorted(d for d in days if d is not None):
            if ranges and day - ranges[-1][1] <= timedelta(days=1):
                ranges[-1] = (ranges[-1][0], day)
            else:
                ranges.append((day, day))
        return Days(tuple(ranges), None in days)

    def reach(self, before: int = 0, after: int = 0) -> Days:
        """The same days and so many before and after each."""
        return Days(
            tuple(
                (first and first - timedelta(days=before), last and last + timedelta(days=after))
                for first, last in self.ranges
            ),
            self.undated,
        )

    def holds(self, day: Column) -> Column:
        """Whether a date is one of these days; a null date counts only with ``undated``."""
        inside = F.lit(False)
        for first, last in self.ranges:
            ends = [day >= F.lit(first)] if first else []
            ends += [day <= F.lit(last)] if last else []
            inside = inside | reduce(and_, ends or [day.isNotNull()])
        return inside | day.isNull() if self.undated else inside

    def __contains__(self, day: date) -> bool:
        return any((not first or first <= day) and (not last or day <= last) for first, last in self.ranges)


def _date(day: date | str | None) -> date | None:
    return date.fromisoformat(day) if isinstance(day, str) else day


def day_of(second: Column) -> Column:
    """The UTC date of an epoch second."""
    return F.date_add(F.lit("1970-01-01").cast("date"), F.floor(second / DAY).cast("int"))


def days_to_reach(seconds: int) -> int:
    """How many further days a span of seconds past a day's end or start can lie in."""
    return -(-seconds // DAY)


def stored_days(spark: SparkSession, path: str) -> list[date]:
    """Days a table written by date has, in order, from the names of its folders. No file is opened, no job is run."""
    found = (re.fullmatch(r"date=(\d{4}-\d\d-\d\d)", name) for name in names_in(spark, path))
    return sorted(date.fromisoformat(day[1]) for day in found if day)
