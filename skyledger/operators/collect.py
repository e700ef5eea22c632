"""What to collect: every location and month that is not loaded yet, with its request text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.functions.calendar import ARCHIVE_BASE, ARCHIVE_OPTIONS, archive_request, months_to_collect
from skyledger.sources.writers import new_months

# Places with latitude and longitude.
LOCATIONS = [
    ("Cairo", 30.0444, 31.2357), ("Alexandria", 31.2001, 29.9187), ("Giza", 30.0131, 31.2089),
    ("Dakahlia", 31.0409, 31.3785), ("Red Sea", 27.2579, 33.8116), ("Beheira", 31.0357, 30.4700),
    ("Fayoum", 29.3084, 30.8428), ("Gharbia", 30.7865, 31.0004), ("Ismailia", 30.5965, 32.2715),
    ("Menofia", 30.5765, 30.9985), ("Minya", 28.0991, 30.7503), ("Qalyubia", 30.4591, 31.1786),
    ("New Valley", 25.4390, 30.5586), ("Suez", 29.9668, 32.5498), ("Aswan", 24.0889, 32.8998),
    ("Assiut", 27.1783, 31.1849), ("Beni Suef", 29.0744, 31.0978), ("Port Said", 31.2653, 32.3019),
    ("Damietta", 31.4175, 31.8144), ("Sharkia", 30.5765, 31.5041), ("South Sinai", 28.5063, 34.1166),
    ("Kafr El Sheikh", 31.1049, 30.9402), ("Matrouh", 31.3543, 27.2373), ("Luxor", 25.6872, 32.6396),
    ("Qena", 26.1551, 32.7160), ("North Sinai", 31.1325, 33.8033), ("Sohag", 26.5570, 31.6948),
]


def locations(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(LOCATIONS, "city string, latitude double, longitude double")


def collection_plan(places: DataFrame, today: Column) -> DataFrame:
    """Every place with every month to collect; months come from an array, not from a join."""
    first = F.explode(months_to_collect(today)).alias("_first")
    return places.select("*", first).select(
        *places.columns, F.year("_first").alias("year"), F.month("_first").alias("month")
    )


def still_missing(plan: DataFrame, loaded: DataFrame, today: Column) -> DataFrame:
    """The part of a plan that is not loaded yet; the current month is always collected again."""
    current = (F.col("year") == F.year(today)) & (F.col("month") == F.month(today))
    return plan.where(current).unionByName(new_months(plan.where(~current), loaded))


def with_requests(plan: DataFrame, base: str = ARCHIVE_BASE, options: str = ARCHIVE_OPTIONS) -> DataFrame:
    request = archive_request(
        F.col("latitude"), F.col("longitude"), F.col("year"), F.col("month"), base, options
    )
    return plan.withColumn("request", request)
