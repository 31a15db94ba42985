"""Start and label of the reporting periods."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loamframe.constants import DURATIONS

# Months per period, and months by which the first period of a year is shifted:
# water years begin on October 1, seasons on December, March, June, September 1.
_MONTHS = {"MONTHLY": (1, 0), "CALENDAR_YEAR": (12, 0), "WATER_YEAR": (12, 9), "SEASONAL": (3, 11)}


def _month_start(ts: Column, months: int, shift: int) -> Column:
    index = F.year(ts) * 12 + F.month(ts) - 1
    start = F.floor((index - shift) / months) * months + shift
    return F.make_date(F.floor(start / 12).cast("int"), (F.pmod(start, F.lit(12)) + 1).cast("int"), F.lit(1))


def period_start(ts: Column, duration: str) -> Column:
    """First instant of the period a time falls in."""
    if duration not in DURATIONS:
        raise ValueError(f"unknown duration {duration!r}")
    if duration == "HOURLY":
        start = F.date_trunc("hour", ts)
    elif duration == "DAILY":
        start = F.to_date(ts)
    elif duration == "SEMIMONTHLY":
        start = F.date_add(F.trunc(ts, "month"), F.when(F.dayofmonth(ts) < 16, 0).otherwise(15))
    else:
        start = _month_start(ts, *_MONTHS[duration])
    return start.cast("timestamp_ntz")


def period_end(start: Column, duration: str) -> Column:
    """End label: the last day of the period, or the end of the hour."""
    day = start.cast("date")
    if duration == "HOURLY":
        return start + F.expr("interval 1 hour")
    if duration == "DAILY":
        return start
    if duration == "SEMIMONTHLY":
        end = F.when(F.dayofmonth(day) == 1, F.date_add(day, 14)).otherwise(F.last_day(day))
    else:
        end = F.date_sub(F.add_months(day, _MONTHS[duration][0]), 1)
    return end.cast("timestamp_ntz")
