"""Column functions on hand-written values."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from skyledger.functions import calendar, text, weather


def one(spark, column, **inputs):
    frame = spark.range(1).select(*[F.lit(v).alias(k) for k, v in inputs.items()])
    return frame.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("high, level", [
    (24.99, "low"), (25.0, "moderate"), (34.99, "moderate"), (35.0, "high"), (44.99, "high"),
    (45.0, "extreme"), (None, "low"),
])
def test_heat_level_bounds(spark, high, level):
    assert one(spark, weather.heat_level(F.lit(high).cast("double"))) == level


def test_season_of_every_month(spark):
    rows = spark.range(1, 13).select(weather.season(F.col("id")).alias("s")).collect()
    assert [r["s"] for r in rows] == (
        ["winter"] * 2 + ["spring"] * 3 + ["summer"] * 3 + ["autumn"] * 3 + ["winter"])


def test_weekend_is_friday_and_saturday(spark):
    days = [date(2026, 1, d) for d in (1, 2, 3, 4)]  # Thursday to Sunday
    df = spark.createDataFrame([(d,) for d in days], "d date")
    assert [r[0] for r in df.select(weather.is_weekend(F.col("d"))).collect()] == [False, True, True, False]


@pytest.mark.parametrize("shown, celsius", [
    ("95 F", 35.0), ("-4", -20.0), ("32°", 0.0), ("no digits", None), ("", None), ("100/60", 37.8),
])
def test_fahrenheit(spark, shown, celsius):
    assert one(spark, weather.fahrenheit_to_celsius(F.lit(shown))) == celsius


@pytest.mark.parametrize("cell, number", [
    ("18.9(66.0)", 18.9), ("0(0)", 0.0), ("3,451", 3451.0), ("11.5", 11.5), ("-1.2(29.8)", -1.2),
    ("−1.2(29.8)", -1.2), ("Jan", None), (None, None), ("Source 1: text", None),
])
def test_climate_value(spark, cell, number):
    assert one(spark, weather.climate_value(F.lit(cell).cast("string"))) == number


@pytest.mark.parametrize("a, b, mean, distance, std", [
    ("30.00", "20.00", 25.0, 10.0, 5.0), ("30.00", None, 30.0, 0.0, 0.0), (None, "20.50", 20.5, 0.0, 0.0),
    (None, None, None, 0.0, None), ("1.01", "1.00", 1.01, 0.01, 0.01), ("7.00", "7.00", 7.0, 0.0, 0.0),
])
def test_pair_of_sources(spark, a, b, mean, distance, std):
    x, y = (F.lit(v).cast("decimal(5,2)") for v in (a, b))
    row = spark.range(1).select(
        weather.pair_mean(x, y).cast("double"), weather.pair_range(x, y).cast("double"),
        weather.pair_std(x, y)).first()
    assert tuple(row) == (mean, distance, std)


def test_identifier_round_trip(spark):
    df = spark.createDataFrame([("Red Sea", date(2024, 2, 9)), (None, date(2024, 2, 9))], "p string, d date")
    ids = df.select(weather.observation_id(F.col("p"), F.col("d")).alias("id"))
    assert [r["id"] for r in ids.collect()] == ["Red Sea_2024-02-09", "NA_2024-02-09"]
    place, day = weather.split_id(F.col("id"))
    assert tuple(ids.select(place, day).first()) == ("Red Sea", "2024-02-09")


@pytest.mark.parametrize("today, first, last, n", [
    ("2026-01-15", "2025-01-01", "2025-12-01", 12), ("2026-01-31", "2026-01-01", "2026-01-01", 1),
    ("2026-03-10", "2026-01-01", "2026-02-01", 2), ("2026-12-31", "2026-01-01", "2026-12-01", 12),
])
def test_months_to_collect(spark, today, first, last, n):
    months = one(spark, calendar.months_to_collect(F.lit(today).cast("date")))
    assert (str(months[0]), str(months[-1]), len(months)) == (first, last, n)


def test_request_and_bounds(spark):
    request = calendar.archive_request(F.lit(30.0444), F.lit(31.2357), F.lit(2024), F.lit(2), "http://x", "&format=csv")
    assert one(spark, request) == (
        "http://x?latitude=30.0444&longitude=31.2357&start_date=2024-02-01&end_date=2024-02-29&format=csv")


@pytest.mark.parametrize("question, found", [
    ("weather on 2026-07-15?", "2026-07-15"), ("on 15/7/2026", "2026-07-15"), ("15-7-2026 please", "2026-07-15"),
    ("21/7/2026", "2026-07-21"), ("31/2/2026", None), ("31/2/2026 or 1-3-2026", "2026-03-01"),
    ("Give me advice for tomorrow", "2026-05-11"), ("TODAY or 2020-01-01", "2026-05-10"),
    ("yesterday", "2026-05-09"), ("ما طقس غدًا", "2026-05-11"), ("أمس", "2026-05-09"), ("اليوم", "2026-05-10"),
    ("الطقس ١٥/٧/٢٠٢٦", "2026-07-15"), ("112026-07-15", None), ("no date", None), ("", None), (None, None),
    ("2026-13-40", None),
])
def test_date_in_text(spark, question, found):
    got = one(spark, text.date_in_text(F.lit(question).cast("string"), F.lit("2026-05-10").cast("date")))
    assert (got and str(got)) == found


def test_numbers_and_days_never_fail(spark):
    df = spark.createDataFrame([("9.10", "2024-02-29"), ("invalid", "2023-02-29"), (None, None)], "n string, d string")
    rows = df.select(weather.to_number(F.col("n")), weather.to_day(F.col("d"))).collect()
    assert [tuple(r) for r in rows] == [(9.1, date(2024, 2, 29)), (None, None), (None, None)]


def test_temp_range_rounds(spark):
    assert one(spark, weather.temp_range(F.lit(34.357), F.lit(21.15))) == 13.21
