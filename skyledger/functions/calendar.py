"""Month arithmetic for collection plans. The clock is always an argument."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Address and options of an archive request.
ARCHIVE_BASE = "https://archive-api.open-meteo.com/v1/archive"
ARCHIVE_OPTIONS = (
    "&daily=weather_code,temperature_2m_max,temperature_2m_min,relative_humidity_2m_mean"
    "&timezone=Africa%2FCairo&format=csv"
)


def months_to_collect(today: Column) -> Column:
    """First days of January up to the last complete month.

    A month counts as complete on its own last day. In an unfinished January the list is the whole
    previous year.
    """
    last_complete = F.when(today == F.last_day(today), F.trunc(today, "month")).otherwise(
        F.add_months(F.trunc(today, "month"), -1)
    )
    return F.sequence(F.trunc(last_complete, "year"), last_complete, F.expr("interval 1 month"))


def month_bounds(year: Column, month: Column) -> tuple[Column, Column]:
    first = F.make_date(year, month, F.lit(1))
    return first, F.last_day(first)


def archive_request(latitude: Column, longitude: Column, year: Column, month: Column,
                    base: str = ARCHIVE_BASE, options: str = ARCHIVE_OPTIONS) -> Column:
    """Request text for one location and month."""
    first, last = month_bounds(year, month)
    return F.concat(
        F.lit(f"{base}?latitude="), latitude.cast("string"), F.lit("&longitude="),
        longitude.cast("string"), F.lit("&start_date="), F.date_format(first, "yyyy-MM-dd"),
        F.lit("&end_date="), F.date_format(last, "yyyy-MM-dd"), F.lit(options),
    )


def is_day_of_month(day: Column, year: Column, month: Column) -> Column:
    """Whether ``day`` exists in that month."""
    _, last = month_bounds(year, month)
    return day.between(1, F.dayofmonth(last))
