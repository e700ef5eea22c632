"""Scalar derivations over observation columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Lower bounds of the heat levels, hottest first, and the level below them all.
HEAT_LEVELS = [(45, "extreme"), (35, "high"), (25, "moderate")]
COOLEST_LEVEL = "low"

# Months of each season; every other month is autumn.
SEASON_MONTHS = {"winter": [12, 1, 2], "spring": [3, 4, 5], "summer": [6, 7, 8]}
LAST_SEASON = "autumn"

# Friday and Saturday in Spark's numbering (Sunday is 1).
WEEKEND_DAYS = [6, 7]


def temp_range(high: Column, low: Column) -> Column:
    """Daily spread to two decimals."""
    return F.round(high - low, 2).cast("double")


def heat_level(high: Column) -> Column:
    """Heat class of a maximum temperature. A missing maximum falls to the coolest class."""
    level = F.lit(COOLEST_LEVEL)
    for bound, name in reversed(HEAT_LEVELS):
        level = F.when(high >= bound, F.lit(name)).otherwise(level)
    return level


def season(month: Column) -> Column:
    names = F.lit(LAST_SEASON)
    for name, months in SEASON_MONTHS.items():
        names = F.when(month.isin(months), F.lit(name)).otherwise(names)
    return names


def is_weekend(day: Column) -> Column:
    return F.dayofweek(day).isin(WEEKEND_DAYS)


def date_parts(day: Column) -> dict[str, Column]:
    return {
        "year": F.year(day),
        "month": F.month(day),
        "day": F.dayofmonth(day),
        "day_of_year": F.dayofyear(day),
    }


def observation_id(place: Column, day: Column) -> Column:
    """``place_yyyy-MM-dd``; a missing place reads ``NA``."""
    return F.concat_ws("_", F.coalesce(place, F.lit("NA")), day.cast("string"))


def split_id(identifier: Column) -> tuple[Column, Column]:
    """Place and date text of an identifier: its first and its last ``_`` part."""
    parts = F.split(identifier, "_")
    return F.element_at(parts, 1), F.element_at(parts, -1)


def to_number(text: Column) -> Column:
    """Double, or null where the text is no number."""
    return text.try_cast("double")


def to_day(text: Column) -> Column:
    """Date, or null where the text is no date."""
    return F.try_to_date(text)


def fahrenheit_to_celsius(text: Column) -> Column:
    """First signed integer of a text, read as Fahrenheit, in Celsius to one decimal."""
    fahrenheit = F.regexp_extract(text, r"-?\d+", 0).try_cast("int")
    return F.round((fahrenheit - 32) * 5 / 9, 1)


def first_small_number(text: Column) -> Column:
    """First number of one or two digits in a text."""
    return F.regexp_extract(text, r"\d{1,2}", 0).try_cast("int")


def climate_value(text: Column) -> Column:
    """Leading number of a climate-normals cell: ``18.9(66.0)`` is 18.9 and ``3,451`` is 3451.

    Cells of header and footnote rows hold no leading number and give null.
    """
    leading = F.regexp_extract(F.trim(text), r"^([-−]?[0-9][0-9,]*(?:\.[0-9]+)?)", 1)
    return F.translate(leading, "−,", "-").try_cast("double")


def pair_count(a: Column, b: Column) -> Column:
    return a.isNotNull().cast("int") + b.isNotNull().cast("int")


def pair_mean(a: Column, b: Column) -> Column:
    """Mean of the values that are present, to two decimals; null when neither is."""
    both = (a + b) / 2
    return F.round(F.coalesce(both, a, b), 2).cast("decimal(5,2)")


def pair_range(a: Column, b: Column) -> Column:
    """Distance of two values; zero as soon as one is missing."""
    return F.coalesce(F.abs(a - b), F.lit(0)).cast("decimal(5,2)")


def pair_std(a: Column, b: Column) -> Column:
    """Population deviation of the present values: half the distance of two, zero for one."""
    alone = F.when(pair_count(a, b) == 1, F.lit(0))
    return F.coalesce(F.round(F.abs(a - b) / 2, 2), alone).cast("double")
