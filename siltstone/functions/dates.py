"""Date helpers, and the explicit "now" that every operator takes.

All timestamps are ``timestamp_ntz``; nothing here reads the wall clock, so a
load can be repeated for any past day and gives the same rows.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, functions as F


def ntz(value: dt.datetime | str) -> Column:
    """Literal ``timestamp_ntz`` (``F.lit(datetime)`` would be zoned)."""
    text = value if isinstance(value, str) else value.isoformat(sep=" ")
    return F.lit(text).cast("timestamp_ntz")


@dataclass(frozen=True)
class AsOf:
    """The moment a load pretends to run at."""

    ts: dt.datetime

    @property
    def timestamp(self) -> Column:
        return ntz(self.ts)

    @property
    def date(self) -> Column:
        return F.lit(self.ts.date())

    @property
    def month(self) -> Column:
        return F.lit(self.ts.date().replace(day=1))


@dataclass(frozen=True)
class Calendar:
    """Bounds of the gap-free date dimension; a spine that would leave them is an error."""

    first: dt.date
    last: dt.date


def whole_years(born: Column, on: Column) -> Column:
    """Completed years; somebody born on 29 February ages on 1 March."""
    before_birthday = (F.month(on) * 100 + F.dayofmonth(on)) < (
        F.month(born) * 100 + F.dayofmonth(born)
    )
    return (F.year(on) - F.year(born) - before_birthday.cast("int")).cast("int")


def date_key(day: Column) -> Column:
    """yyyymmdd as an integer."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")
