"""Public holidays as column expressions of a date: fixed, movable and substitute days."""
from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

MONDAY, TUESDAY, SATURDAY, SUNDAY = 0, 1, 5, 6


def _div(a: Column, b: int) -> Column:
    return F.floor(a / b).cast("int")


def easter_sunday(year: Column) -> Column:
    """Easter Sunday of a Gregorian year: the first Sunday after the full moon of the church calendar on or after 21 March.

    The age of the moon follows the year's place in a cycle of 19 years, corrected by the century for skipped leap days and for the drift of the moon.
    """
    place = F.pmod(year, F.lit(19))
    century = _div(year, 100)
    skipped, drift = century - _div(century, 4), _div(century * 8 + 13, 25)
    moon = F.pmod(place * 19 + skipped - drift + 15, F.lit(30))  # days from 21 March to the full moon
    # two moons would fall a day too late: 19 April, and 18 April in the later part of the cycle
    moon = moon - F.when((moon == 29) | ((moon == 28) & (place > 10)), 1).otherwise(0)
    full = F.date_add(F.make_date(year, F.lit(3), F.lit(21)), moon)
    return F.date_add(full, 7 - F.pmod(F.weekday(full) + 1, F.lit(7)))


def nth_weekday(year: Column, month: int, weekday: int, n: int) -> Column:
    """The n-th of a weekday (Monday is 0) in a month."""
    first = F.make_date(year, F.lit(month), F.lit(1))
    return F.date_add(first, F.pmod(F.lit(weekday) - F.weekday(first), F.lit(7)) + 7 * (n - 1))


@dataclass(frozen=True)
class Holiday:
    """A day of the year. ``shifts`` gives, for weekdays it may fall on, how many days later a substitute is kept too."""

    name: str
    day: tuple[int, int] | None = None  # month and day
    easter: int | None = None  # days after Easter Sunday
    nth: tuple[int, int, int] | None = None  # month, weekday, which
    shifts: tuple[tuple[int, int], ...] = ()

    def of(self, year: Column) -> Column:
        if self.day:
            return F.make_date(year, *[F.lit(x) for x in self.day])
        if self.nth:
            return nth_weekday(year, *self.nth)
        return F.date_add(easter_sunday(year), self.easter or 0)

    def substitute(self, year: Column) -> Column:
        """The substitute day of a year, null without one."""
        date = self.of(year)
        found = [F.when(F.weekday(date) == on, F.date_add(date, later)) for on, later in self.shifts]
        return F.coalesce(*found) if found else F.lit(None).cast("date")


# The public holidays of New South Wales, in the order of the year.
NEXT_MONDAY = ((SATURDAY, 2), (SUNDAY, 1))
NSW_HOLIDAYS = (
    Holiday("New Year's Day", day=(1, 1), shifts=NEXT_MONDAY),
    Holiday("Australia Day", day=(1, 26), shifts=NEXT_MONDAY),
    Holiday("Good Friday", easter=-2),
    Holiday("Easter Saturday", easter=-1),
    Holiday("Easter Sunday", easter=0),
    Holiday("Easter Monday", easter=1),
    Holiday("Anzac Day", day=(4, 25)),
    Holiday("King's Birthday", nth=(6, MONDAY, 2)),
    Holiday("Labour Day", nth=(10, MONDAY, 1)),
    Holiday("Christmas Day", day=(12, 25), shifts=((SATURDAY, 2), (SUNDAY, 2))),
    Holiday("Boxing Day", day=(12, 26), shifts=((SATURDAY, 2), (SUNDAY, 2))),
)


def holiday_name(date: Column, rules: tuple[Holiday, ...] = NSW_HOLIDAYS) -> Column:
    """The holiday a date is, by its first rule, null for other days and for a null date. Substitute days are named after theirs, ``… (substitute)``;
    they are all in the year of the holiday."""
    day = date.cast("date")
    year = F.year(day)
    own = [F.when(day == rule.of(year), F.lit(rule.name)) for rule in rules]
    later = [F.when(day == rule.substitute(year), F.lit(f"{rule.name} (substitute)")) for rule in rules if rule.shifts]
    return reduce(lambda a, b: F.coalesce(a, b), [*own, *later])
