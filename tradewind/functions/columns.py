"""Column expressions shared by the operators. All stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

DAY_MICROS = 86_400_000_000


def parse_timestamp(column: Column) -> Column:
    """Text to a timestamp without zone; anything unreadable becomes null."""
    return column.try_cast("timestamp_ntz")


def floor_days(start: Column, end: Column) -> Column:
    """Whole days from start to end, rounded down, in exact integer arithmetic."""
    micros = F.timestamp_diff("MICROSECOND", start, end)
    return ((micros - F.pmod(micros, F.lit(DAY_MICROS))) / DAY_MICROS).cast("int")


def year_month(moment: Column) -> Column:
    """Month as yyyy-MM text."""
    return F.date_format(moment, "yyyy-MM")


def half_up(value: Column, digits: int) -> Column:
    """Round a double, ties away from zero.

    A mean of money is often an exact tie that binary division misses by one
    unit in the last place, so the value goes through ten decimals first.
    """
    return F.round(value.cast("decimal(38,10)"), digits).cast("double")


def ratio(part: Column, whole: Column, digits: int | None = None) -> Column:
    """part / whole as a double, null when whole is zero."""
    value = F.try_divide(part.cast("double"), whole.cast("double"))
    return value if digits is None else half_up(value, digits)


def percent(part: Column, whole: Column, digits: int | None = 2) -> Column:
    """100 * part / whole as a double, null when whole is zero."""
    value = F.try_divide(F.lit(100.0) * part.cast("double"), whole.cast("double"))
    return value if digits is None else half_up(value, digits)


def change_percent(now: Column, before: Column, digits: int = 2) -> Column:
    """Growth over the earlier value in percent, null when that is zero or missing."""
    growth = F.try_divide((now - before).cast("double"), before.cast("double")) * 100
    return half_up(growth, digits)


def count_where(condition: Column) -> Column:
    """Rows for which the condition holds, 0 on empty input."""
    return F.count_if(F.coalesce(condition, F.lit(False)))


def month_number(moment: Column) -> Column:
    """Months since year 0, so that differences count calendar boundaries."""
    return F.year(moment) * 12 + F.month(moment)
