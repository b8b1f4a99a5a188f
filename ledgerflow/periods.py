"""Accounting periods (closed date intervals) and their defaults.

A period is a pair of python dates turned into literals; every operator that
filters by period takes a ``Period``.
"""

from __future__ import annotations

import calendar
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def _month_start(d: date) -> date:
    return d.replace(day=1)


def _month_end(d: date) -> date:
    return d.replace(day=calendar.monthrange(d.year, d.month)[1])


def _add_months(d: date, months: int) -> date:
    idx = d.year * 12 + (d.month - 1) + months
    year, month = divmod(idx, 12)
    month += 1
    day = min(d.day, calendar.monthrange(year, month)[1])
    return date(year, month, day)


def _as_date(value) -> date | None:
    if value is None:
        return None
    if isinstance(value, date):
        return value
    text = str(value).strip()
    if not text:
        return None
    return date.fromisoformat(text)


@dataclass(frozen=True)
class Period:
    """Closed interval ``[start, end]`` of calendar dates."""

    start: date
    end: date

    def __post_init__(self):
        if self.start > self.end:
            raise ValueError(f"period start {self.start} is after end {self.end}")

    # -- constructors ---------------------------------------------------
    @staticmethod
    def of(start=None, end=None, today: date | None = None,
           end_default: str = "month_end") -> "Period":
        """Given bounds win; a blank or missing one takes its default.

        Start defaults to the first day of today's month; end to the last day
        of today's month, or to today itself with ``end_default="today"``.
        """
        today = today or date.today()
        s = _as_date(start) or _month_start(today)
        e = _as_date(end)
        if e is None:
            if end_default == "today":
                e = today
            elif end_default == "month_end":
                e = _month_end(today)
            else:
                raise ValueError(f"unknown end default {end_default!r}")
        return Period(s, e)

    @staticmethod
    def month(year: int, month: int) -> "Period":
        first = date(year, month, 1)
        return Period(first, _month_end(first))

    @staticmethod
    def month_of(run_date: date) -> "Period":
        """Month that starts at the run date: start, start + 1 month - 1 day."""
        run_date = _as_date(run_date)
        return Period(run_date, _add_months(run_date, 1) - timedelta(days=1))

    @staticmethod
    def previous_month(today: date | None = None) -> "Period":
        today = today or date.today()
        first = _add_months(_month_start(today), -1)
        return Period(first, _month_end(first))

    @staticmethod
    def from_generator_args(start=None, end_exclusive=None,
                            today: date | None = None) -> "Period":
        """Both bounds (end exclusive) or neither; neither is last month."""
        s, e = _as_date(start), _as_date(end_exclusive)
        if (s is None) != (e is None):
            raise ValueError("give both start and end, or neither")
        if s is None:
            return Period.previous_month(today)
        return Period(s, e - timedelta(days=1))

    # -- derived values -------------------------------------------------
    @property
    def end_exclusive(self) -> date:
        return self.end + timedelta(days=1)

    @property
    def first_month(self) -> date:
        return _month_start(self.start)

    @property
    def last_month(self) -> date:
        return _month_start(self.end)

    def months(self) -> list["Period"]:
        """Calendar months touched by the period, in order (backfill order)."""
        out, m = [], self.first_month
        while m <= self.last_month:
            out.append(Period(m, _month_end(m)))
            m = _add_months(m, 1)
        return out

    # -- column predicates ----------------------------------------------
    def contains(self, date_col: Column) -> Column:
        return date_col.between(F.lit(self.start), F.lit(self.end))

    def contains_month(self, month_col: Column) -> Column:
        """Month bucket between the truncated bounds (trial balance pruning)."""
        return month_col.between(F.lit(self.first_month), F.lit(self.last_month))

    def up_to_end_month(self, month_col: Column) -> Column:
        """Cumulative bound: every month up to and including the end's month."""
        return month_col <= F.lit(self.last_month)

    def __str__(self) -> str:
        return f"{self.start.isoformat()}..{self.end.isoformat()}"


def bounds_columns(run_date: Column) -> list[Column]:
    """Period defaults for a column of run dates, as the scheduler would see them."""
    month_start = F.trunc(run_date, "month")
    next_start = F.add_months(month_start, 1)
    prev_start = F.add_months(month_start, -1)
    return [
        month_start.alias("default_start"),
        F.last_day(run_date).alias("default_end"),
        run_date.alias("default_end_today"),
        month_start.alias("run_start"),
        F.date_sub(next_start, 1).alias("run_end_inclusive"),
        next_start.alias("run_end_exclusive"),
        prev_start.alias("previous_month_start"),
        month_start.alias("previous_month_end_exclusive"),
    ]
