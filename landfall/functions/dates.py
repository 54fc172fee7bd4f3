"""Day numbers (days since 1960-01-01) to zone-free timestamps and date parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: day zero of the extract's day numbers.
DAY_ZERO = "1960-01-01"


def whole_day(number: Column) -> Column:
    """Day number as an integer; a fraction is cut off toward zero."""
    return number.cast("int")


def day_to_ts(number: Column) -> Column:
    """Midnight of the numbered day; null stays null, negative days lie before 1960."""
    day = F.date_add(F.to_date(F.lit(DAY_ZERO)), whole_day(number))
    return day.cast("timestamp_ntz")


def departure_ts(number: Column, null_departure: bool = False) -> Column:
    """Departure day; with none given it is day zero, or null on request."""
    if null_departure:
        return day_to_ts(F.when(number != 0.0, number))
    return day_to_ts(F.coalesce(number, F.lit(0.0)))


def date_parts(ts: Column) -> dict[str, Column]:
    """The six parts of the time dimension; weeks are ISO, weekday 1 is Sunday."""
    return {
        "hour": F.hour(ts),
        "day": F.dayofmonth(ts),
        "week": F.weekofyear(ts),
        "month": F.month(ts),
        "year": F.year(ts),
        "weekday": F.dayofweek(ts),
    }
