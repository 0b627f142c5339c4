"""Date helpers. ``as_of`` is always a DATE column, so that runs can be repeated."""

from __future__ import annotations

import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_of_date(as_of: datetime.date | str | None) -> Column:
    """The reporting date as a column; the current date where none is given."""
    if as_of is None:
        return F.current_date()
    return F.lit(str(as_of)).cast("date")


def whole_days(later: Column, earlier: Column) -> Column:
    """Whole 24 h days between two timestamps, cut toward zero (not calendar days)."""
    gap = later.cast("timestamp_ntz") - earlier.cast("timestamp_ntz")
    return F.extract(F.lit("DAY"), gap)


def month_start(day: Column) -> Column:
    """First instant of the month of a date, as a timestamp without zone."""
    return F.trunc(day, "MM").cast("timestamp_ntz")
