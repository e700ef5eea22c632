"""Projection operators: canonical names, defaults, order."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.functions import weather

# Source spellings of the canonical columns, and the order in which a temperature
# column may stand in for a missing average.
CANONICAL = {
    "Governorate": "governorate",
    "Date": "date",
    "Weather_Code": "weather_code",
    "Avg_Humidity": "avg_humidity",
    "Source": "source",
}
STAND_INS = {
    "avg_max_temp": ["Max_Temp", "max_temp"],
    "avg_min_temp": ["Min_Temp", "min_temp"],
}
# Spellings of one source next to those the other sources use. Not applied by default.
PLACE_ALIASES = {"Kalyoubia": "Qalyubia", "Monufia": "Menofia", "Asyut": "Assiut"}
DEFAULT_CONDITION = "weather_data"
DEFAULT_SOURCE = "unknown"


def canonical_names(columns: list[str]) -> dict[str, str]:
    """Source column -> canonical column. Matching is by exact spelling."""
    names = {c: CANONICAL.get(c, c) for c in columns}
    for average, spellings in STAND_INS.items():
        if average not in columns:
            found = next((s for s in spellings if s in columns), None)
            if found:
                names[found] = average
    return names


def rename_places(df: DataFrame, aliases: dict[str, str] | None, column: str = "governorate") -> DataFrame:
    """Alternative place spellings become the one used elsewhere; other places stay."""
    if not aliases:
        return df
    known = F.create_map(*[F.lit(x) for pair in aliases.items() for x in pair])
    return df.withColumn(column, F.coalesce(F.try_element_at(known, F.col(column)), F.col(column)))


def standardize(df: DataFrame, aliases: dict[str, str] | None = None) -> DataFrame:
    """Any weather-like frame in canonical names and types, in one projection.

    ``aliases`` maps alternative place spellings to the one used elsewhere.
    """
    columns = {new: F.col(f"`{old}`") for old, new in canonical_names(df.columns).items()}
    if aliases:
        known = F.create_map(*[F.lit(x) for pair in aliases.items() for x in pair])
        place = columns["governorate"]
        columns["governorate"] = F.coalesce(F.try_element_at(known, place), place)
    if "date" in columns:
        columns["date"] = columns["date"].try_cast("date")
    for name in ("avg_max_temp", "avg_min_temp", "avg_humidity", "weather_code"):
        if name in columns:
            columns[name] = columns[name].try_cast("double")
    if "weather_code" in columns:
        columns["weather_code"] = columns["weather_code"].try_cast("int")
    if "id" not in columns:
        columns["id"] = weather.observation_id(columns["governorate"], columns["date"])
    columns.setdefault("condition", F.lit(DEFAULT_CONDITION))
    columns.setdefault("source", F.lit(DEFAULT_SOURCE))
    return df.select(*[value.alias(name) for name, value in columns.items()])


def add_defaults(df: DataFrame, defaults: dict[str, Column]) -> DataFrame:
    """Add each default only where the frame has no such column."""
    missing = {name: value for name, value in defaults.items() if name not in df.columns}
    return df.withColumns(missing) if missing else df


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Union by column name; a column a frame lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def rename_positional(df: DataFrame, names: list[str]) -> DataFrame:
    return df.toDF(*names)


def priority_first(df: DataFrame, first: list[str]) -> DataFrame:
    """Priority columns first, the rest behind them in their own order."""
    return df.select(*first, *[c for c in df.columns if c not in first])


def drop_if_present(df: DataFrame, names: list[str]) -> DataFrame:
    return df.drop(*names)


def coerce_numeric(df: DataFrame, names: list[str]) -> DataFrame:
    """Listed columns as doubles; text that is no number becomes null."""
    present = [c for c in names if c in df.columns]
    return df.withColumns({c: weather.to_number(F.col(c)) for c in present}) if present else df


def serving_view(forecast: DataFrame) -> DataFrame:
    """Forecast rows in the column names the question operators read.

    The place name travels with the forecast; a numeric place code stands in only where a frame
    carries nothing else.
    """
    stand_ins = {
        "governorate": ("city_encoded", "string"),
        "avg_max_temp": ("predicted_max_temp", "double"),
        "avg_min_temp": ("predicted_min_temp", "double"),
    }
    named = add_defaults(
        forecast.withColumn("date", F.col("date").try_cast("date")),
        {
            name: F.col(source).cast(kind)
            for name, (source, kind) in stand_ins.items()
            if source in forecast.columns
        },
    )
    return add_defaults(
        named,
        {
            "avg_humidity": F.lit(0.0),
            "temp_range": F.col("avg_max_temp") - F.col("avg_min_temp"),
            "heat_level": F.lit("moderate"),
            "season": F.lit("forecast"),
        },
    )
