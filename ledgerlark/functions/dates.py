"""Calendar expressions and cadences. All of them stay inside whole-stage codegen."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: months of the units that have a name of their own.
MONTHS_PER = {"month": 1, "quarter": 3}
#: The first Monday that day numbers count.
MONDAY = date(1970, 1, 5)


@dataclass(frozen=True)
class Cadence:
    """Periods of ``length`` months or weeks, numbered in order, and how many in a row (``lookback``)
    must be billed before the next one counts as expected.

    ``starts`` is the month (1 to 12) or the day of the week (1 Monday, 7 Sunday) on which periods
    begin: ``Cadence("month", 3, starts=2)`` are quarters from February, May, August and November.
    Periods of several weeks count from the first such day of 1970.
    """

    unit: str = "month"
    length: int = 1
    lookback: int = 3
    starts: int = 1

    def __post_init__(self) -> None:
        if self.unit not in ("month", "week"):
            raise ValueError(f"a cadence counts months or weeks, not {self.unit!r}")
        if self.length < 1 or self.lookback < 1:
            raise ValueError("length and lookback must be 1 or more")
        if not 1 <= self.starts <= (12 if self.unit == "month" else 7):
            raise ValueError(f"starts is out of range for a {self.unit}: {self.starts}")

    @classmethod
    def of(cls, given: Cadence | str | Mapping) -> Cadence:
        """A cadence, one of the names in ``CADENCES``, or a mapping as a configuration has it."""
        if isinstance(given, Cadence):
            return given
        if isinstance(given, str):
            if given not in CADENCES:
                raise ValueError(f"cadence must be one of {sorted(CADENCES)}, not {given!r}")
            return CADENCES[given]
        return cls(**given)

    @property
    def days(self) -> int:
        """About how long a period is."""
        return self.length * (30 if self.unit == "month" else 7)

    @property
    def _first_day(self) -> int:
        return (MONDAY - date(1970, 1, 1)).days + self.starts - 1

    def ordinal(self, day: Column) -> Column:
        """The number of the period that holds ``day``; that of the one after it is larger by 1."""
        if self.unit == "month":
            count, size = F.year(day) * 12 + F.month(day) - self.starts, self.length
        else:
            count, size = F.unix_date(day) - self._first_day, 7 * self.length
        return F.call_function("div", count - F.pmod(count, F.lit(size)), F.lit(size)).cast("int")

    def start(self, ordinal: Column) -> Column:
        """The first day of a period."""
        if self.unit == "month":
            month = ordinal * self.length + (self.starts - 1)
            return F.make_date(F.call_function("div", month, F.lit(12)).cast("int"), F.pmod(month, F.lit(12)) + 1, F.lit(1))
        return F.date_from_unix_date(ordinal * (7 * self.length) + self._first_day)

    def usual_day(self, day: Column) -> Column:
        """The day of the month, or that of the period of weeks, from 1."""
        if self.unit == "month":
            return F.dayofmonth(day)
        return F.pmod(F.unix_date(day) - self._first_day, F.lit(7 * self.length)) + 1

    def place(self, start: Column, day: Column, clamped: bool) -> Column:
        """Usual day ``day`` in the period that begins at ``start``: in its first month, as its last day
        or not at all where that is too short."""
        if self.unit == "week":
            return F.date_add(start, day - 1)
        return day_in_month_clamped(start, day) if clamped else day_in_month(start, day)

    def deadline(self, start: Column) -> Column:
        """Until when an invoice of the period that begins at ``start`` stays due: its first month, or
        all its weeks."""
        return F.add_months(start, 1) if self.unit == "month" else F.date_add(start, 7 * self.length)

    def holds(self, other: Cadence) -> bool:
        """Whether each period of ``other`` lies in one of this cadence."""
        if self.unit != other.unit or self.length % other.length:
            return False
        if self.unit == "month":
            return (self.starts - other.starts) % other.length == 0
        return self.starts == other.starts


#: The cadences with names, with the periods each looks back.
CADENCES = {
    "month": Cadence("month", 1, 3),
    "quarter": Cadence("month", 3, 2),
    "half_year": Cadence("month", 6, 2),
    "year": Cadence("month", 12, 2),
    "week": Cadence("week", 1, 3),
}


def cadence_start(date: Column, unit: str) -> Column:
    """First day of the month or quarter holding ``date``."""
    if unit not in MONTHS_PER:
        raise ValueError(f"cadence must be one of {sorted(MONTHS_PER)}, not {unit!r}")
    return F.trunc(date, unit)


def shift_cadence(start: Column, unit: str, steps: int) -> Column:
    return F.add_months(start, MONTHS_PER[unit] * steps)


def day_in_month(month_start: Column, day: Column) -> Column:
    """Day ``day`` of the month, or NULL where the month is too short for it."""
    placed = F.date_add(month_start, day - 1)
    return F.when(F.trunc(placed, "month") == month_start, placed)


def day_in_month_clamped(month_start: Column, day: Column) -> Column:
    """Day ``day`` of the month, or its last day where the month is too short for it."""
    return F.least(F.date_add(month_start, day - 1), F.last_day(month_start))


def whole_months_between(later: Column, earlier: Column) -> Column:
    return F.floor(F.months_between(later, earlier))
