"""Run period and rule validity, both ends inclusive."""

from __future__ import annotations

import re
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

# Days are halved so often: 2 ** 23 days are more than all years with four digits.
LEVELS = 23

_ISO_DATE = re.compile(r"\d{4}-\d{2}-\d{2}")


@dataclass(frozen=True)
class Period:
    """The dates a run covers."""

    start: date
    end: date

    @classmethod
    def parse(cls, start: str | date | None, end: str | date | None) -> Period:
        return cls(_iso(start, "start_date"), _iso(end, "end_date"))

    def begin_of(self, rule_start: Column) -> Column:
        """Later of the two starts; a rule without a start is open there."""
        return F.greatest(rule_start, day(self.start))

    def end_of(self, rule_end: Column) -> Column:
        """Earlier of the two ends; a rule without an end is open there."""
        return F.least(rule_end, day(self.end))

    def covers(self, moment: Column) -> Column:
        return within_days(moment, day(self.start), day(self.end))


def day(value: date) -> Column:
    """A date literal, written out so that early years keep their four digits."""
    return F.lit(value.isoformat()).cast("date")


def within_days(moment: Column, first: Column, last: Column) -> Column:
    """``to_date(moment)`` lies in ``[first, last]``.

    Written as a half-open range on the column itself, so that a scan can use it.
    """
    return (moment >= first) & (moment < F.date_add(last, 1))


def dyadic(first_day: Column, last_day: Column) -> Column:
    """The fewest dyadic intervals that make up some days: ``array<struct<level, place>>``.

    At level n they have 2 ** n days and start at multiples of that; a day lies in one of each level (:func:`interval_of`), so a
    day and an interval of days meet by equality. At each level the first interval stays if its place is odd, and so does
    the last if it has an even one. No days give no intervals.
    """
    lo, hi = F.unix_date(first_day), F.unix_date(last_day)

    def at(level: Column) -> Column:
        size = F.call_function("shiftleft", F.lit(1).cast("long"), level)
        first = F.ceil(lo / size)
        end = F.floor((hi + 1) / size)

        def piece(wanted: Column, place: Column) -> Column:
            return F.when(
                (first < end) & wanted, F.struct(level.alias("level"), place.cast("int").alias("place"))
            )

        return F.array(piece(F.pmod(first, F.lit(2)) == 1, first), piece(F.pmod(end, F.lit(2)) == 1, end - 1))

    levels = F.sequence(F.lit(0), F.lit(LEVELS - 1))
    return F.array_compact(F.flatten(F.transform(levels, at)))


def interval_of(moment: Column, level: Column | int) -> Column:
    """The place of the dyadic interval of a level in which a day lies."""
    return F.call_function("shiftright", F.unix_date(moment), F.lit(level) if isinstance(level, int) else level)


def _iso(value: str | date | None, name: str) -> date:
    if isinstance(value, date):
        return value
    if not value or not _ISO_DATE.fullmatch(value):
        raise ValueError(f"{name} must be a date written yyyy-MM-dd, got {value!r}")
    try:
        return date.fromisoformat(value)
    except ValueError as bad:
        raise ValueError(f"{name}: {bad}") from bad
