"""Star schema: three dimensions, the fact table and the model input table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.functions import weather
from skyledger.operators.columns import drop_if_present, priority_first
from skyledger.operators.ranking import dense_ids
from skyledger.schemas import ML_DROPPED, ML_FIRST
from skyledger.storage import staged

# Region of each known place.
REGIONS = {
    "Cairo": "Central", "Giza": "Central", "Qalyubia": "Central", "Alexandria": "North",
    "Beheira": "North", "Kafr El Sheikh": "North", "Damietta": "North", "Port Said": "North",
    "Dakahlia": "North", "Gharbia": "North", "Menofia": "North", "Sharkia": "North",
    "Ismailia": "North", "Suez": "North", "Fayoum": "Central", "Beni Suef": "Central",
    "Minya": "Central", "Assiut": "Upper Egypt", "Sohag": "Upper Egypt", "Qena": "Upper Egypt",
    "Luxor": "Upper Egypt", "Aswan": "Upper Egypt", "Red Sea": "East", "South Sinai": "East",
    "North Sinai": "East", "New Valley": "West", "Matrouh": "West",
}
NO_REGION = "Unknown"


def region_of(place: Column, regions: dict[str, str] = REGIONS) -> Column:
    known = F.create_map(*[F.lit(x) for pair in regions.items() for x in pair])
    return F.coalesce(F.try_element_at(known, place), F.lit(NO_REGION))


def dim_location(silver: DataFrame, regions: dict[str, str] = REGIONS) -> DataFrame:
    places = dense_ids(silver.select("governorate").distinct(), ["governorate"], "location_id")
    return places.select("location_id", "governorate", region_of(F.col("governorate"), regions).alias("region"))


def dim_date(silver: DataFrame) -> DataFrame:
    """One row per day. The unpartitioned window sees distinct calendar days only."""
    day = F.col("date")
    parts = weather.date_parts(day)
    return (
        silver.select("date").distinct()
        .select(
            F.row_number().over(Window.orderBy("date")).alias("date_id"),
            day,
            parts["year"].alias("year"),
            parts["month"].alias("month"),
            parts["day"].alias("day"),
            weather.season(parts["month"]).alias("season"),
            weather.is_weekend(day).alias("is_weekend"),
        )
    )


def dim_condition(silver: DataFrame) -> DataFrame:
    names = dense_ids(silver.select("condition").distinct(), ["condition"], "condition_id")
    return names.select("condition_id", "condition")


def fact_weather(silver: DataFrame, location: DataFrame, date: DataFrame,
                 condition: DataFrame) -> DataFrame:
    """Measures with the keys of their dimensions.

    Pass dimensions that were read from written tables: their file size then decides between a
    broadcast and a shuffled join.
    """
    high, low = F.col("avg_max_temp"), F.col("avg_min_temp")
    return (
        silver.join(location.select("governorate", "location_id"), "governorate", "left")
        .join(date.select("date", "date_id"), "date", "left")
        .join(condition.select("condition", "condition_id"), "condition", "left")
        .select(
            "id", "location_id", "date_id", "condition_id", high, low, "avg_humidity",
            weather.temp_range(high, low).alias("temp_range"),
            weather.heat_level(high).alias("heat_level"),
        )
    )


def star_schema(silver: DataFrame, regions: dict[str, str] = REGIONS) -> dict[str, DataFrame]:
    """Fact and dimensions of a written silver table; each dimension becomes a stage table."""
    dims = {
        "dim_location": staged(dim_location(silver, regions), "dim-location"),
        "dim_date": staged(dim_date(silver), "dim-date"),
        "dim_condition": staged(dim_condition(silver), "dim-condition"),
    }
    return {"fact_weather": fact_weather(silver, *dims.values()), **dims}


def ml_ready(silver: DataFrame) -> DataFrame:
    """Silver rows with date parts and classes, less the columns no model reads."""
    parts = weather.date_parts(F.col("date"))
    high = F.col("avg_max_temp")
    wide = silver.withColumns({
        "year": parts["year"],
        "month": parts["month"],
        "day": parts["day"],
        "season": weather.season(parts["month"]),
        "temp_range": weather.temp_range(high, F.col("avg_min_temp")),
        "heat_level": weather.heat_level(high),
    })
    return priority_first(drop_if_present(wide, ML_DROPPED), ML_FIRST)
