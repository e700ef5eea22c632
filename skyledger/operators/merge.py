"""Null-aware merge of two observation sources on (place, day)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.functions import weather
from skyledger.operators.columns import union_all

KEYS = ["governorate", "weather_date"]


def outer_match(calendar: DataFrame, archive: DataFrame, keys_unique: bool) -> DataFrame:
    """Full outer join with coalesced keys.

    Where the caller states one row per key and source, the plain full outer join is best: views grouped on
    the key need no further shuffle for it. Otherwise one key may hold most rows, and a full outer join cannot
    be split. So matches come from an inner join, which adaptive execution splits on both sides, and each source's
    other rows from an anti join with the other's distinct keys, which it splits on the large side. Rows without a place
    match nothing and skip the joins.
    """
    if keys_unique:
        return calendar.join(archive, KEYS, "full_outer")
    placed = F.col("governorate").isNotNull()
    g, e = calendar.where(placed), archive.where(placed)
    return union_all([
        g.join(e, KEYS, "inner"),
        g.join(e.select(*KEYS).distinct(), KEYS, "left_anti"),
        e.join(g.select(*KEYS).distinct(), KEYS, "left_anti"),
        calendar.where(~placed),
        archive.where(~placed),
    ])


def merge_sources(calendar: DataFrame, archive: DataFrame, keys_unique: bool = False) -> DataFrame:
    """One row per matched or unmatched (place, day), with mean, range and deviation of the pair.

    Rows without a day are left out before the join, which gives the same rows as afterwards (a
    null key never matches) and keeps them out of the shuffle.
    """
    dated = F.col("weather_date").isNotNull()
    pairs = outer_match(
        calendar.where(dated).select(*KEYS, "condition", "high_temp_c", "low_temp_c"),
        archive.where(dated).select(*KEYS, "weather_code", "max_temp", "min_temp", "avg_humidity"),
        keys_unique,
    )
    place, day = F.col("governorate"), F.col("weather_date")
    high, top = F.col("high_temp_c"), F.col("max_temp")
    low, bottom = F.col("low_temp_c"), F.col("min_temp")
    return pairs.select(
        weather.observation_id(place, day).alias("id"),
        place,
        day.alias("date"),
        "weather_code",
        "condition",
        high,
        top,
        weather.pair_mean(high, top).alias("avg_max_temp"),
        weather.pair_range(high, top).alias("range_max_temp"),
        weather.pair_std(high, top).alias("std_max_temp"),
        low,
        bottom,
        weather.pair_mean(low, bottom).alias("avg_min_temp"),
        weather.pair_range(low, bottom).alias("range_min_temp"),
        weather.pair_std(low, bottom).alias("std_min_temp"),
        "avg_humidity",
    )
