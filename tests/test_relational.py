"""Merge, cleaning, as-of, ranking, star schema and normals."""

import random
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from skyledger.operators import asof, cleaning, columns, merge, normals, ranking, star
from skyledger.schemas import ARCHIVE_STAGING, CALENDAR_STAGING, ML_FIRST
from skyledger.storage import staged
from tests.conftest import values

D = [date(2024, 1, d) for d in range(1, 32)]
CALENDAR = [("Cairo", "Sunny", Decimal("30"), Decimal("20"), D[0]), ("Cairo", "Fog", None, Decimal("18"), D[1]),
            ("Giza", "Sunny", None, None, D[2]), (None, "Lost", Decimal("1"), Decimal("1"), D[3]),
            ("Giza", "Undated", Decimal("1"), Decimal("1"), None)]
ARCHIVE = [("Cairo", D[0], 1, Decimal("32"), Decimal("22"), Decimal("50"), "a"),
           ("Cairo", D[1], 2, Decimal("31"), None, None, "a"),
           ("Luxor", D[0], 3, Decimal("40"), Decimal("25"), Decimal("10"), "a"),
           ("Giza", D[2], 4, None, None, Decimal("5"), "a"),
           (None, D[3], 5, Decimal("2"), Decimal("2"), Decimal("2"), "a")]


@pytest.mark.parametrize("unique", [True, False])
def test_merge_cases(spark, unique):
    got = merge.merge_sources(spark.createDataFrame(CALENDAR, CALENDAR_STAGING),
                              spark.createDataFrame(ARCHIVE, ARCHIVE_STAGING), unique)
    rows = sorted(
        tuple(None if x is None else float(x) if isinstance(x, Decimal) else x for x in r)
        for r in got.select("id", "avg_max_temp", "range_max_temp", "std_max_temp", "avg_min_temp",
                            "avg_humidity", F.coalesce("condition", F.lit("-"))).collect())
    assert rows == [
        ("Cairo_2024-01-01", 31.0, 2.0, 1.0, 21.0, 50.0, "Sunny"),
        ("Cairo_2024-01-02", 31.0, 0.0, 0.0, 18.0, None, "Fog"),
        ("Giza_2024-01-03", None, 0.0, None, None, 5.0, "Sunny"),
        ("Luxor_2024-01-01", 40.0, 0.0, 0.0, 25.0, 10.0, "-"),
        ("NA_2024-01-04", 1.0, 0.0, 0.0, 1.0, None, "Lost"),
        ("NA_2024-01-04", 2.0, 0.0, 0.0, 2.0, 2.0, "-"),
    ]


def test_merge_forms_agree_on_repeated_keys(spark):
    rng = random.Random(1)
    place = lambda: rng.choice(["hot"] * 5 + ["a", "b", "c", None])
    left = [(place(), "x", Decimal(rng.randint(0, 40)), Decimal(rng.randint(0, 40)), D[rng.randint(0, 2)]) for _ in range(60)]
    right = [(place(), D[rng.randint(0, 3)], 1, Decimal(rng.randint(0, 40)), None, None, "s") for _ in range(60)]
    g, e = spark.createDataFrame(left, CALENDAR_STAGING), spark.createDataFrame(right, ARCHIVE_STAGING)
    expected = values(merge.merge_sources(g, e, True))
    assert expected == values(merge.merge_sources(g, e))
    assert expected == values(merge.merge_sources(g, e))


CANON = "id string, governorate string, date date, condition string, source string, avg_max_temp double, avg_min_temp double, avg_humidity double, std_max_temp double, max_temp double"


def obs(spark, rows):
    return spark.createDataFrame(rows, CANON)


def test_dedup_prefers_source_then_values(spark):
    df = obs(spark, [
        ("1", "Cairo", D[0], "x", "b", 50.0, 1.0, 1.0, None, None),
        ("2", "Cairo", D[0], "x", "a", 10.0, 1.0, 1.0, None, None),
        ("3", "Cairo", D[0], "x", "a", None, 1.0, 1.0, None, None),
        ("4", "Cairo", D[1], "x", None, 5.0, 1.0, 1.0, None, None),
        ("5", "Cairo", D[1], "x", "zzz", 6.0, 1.0, 1.0, None, None),
    ])
    assert sorted(r["id"] for r in cleaning.dedup_rows(df, ["a", "b"]).collect()) == ["2", "5"]
    assert sorted(r["id"] for r in cleaning.dedup_rows(df).collect()) == ["1", "5"]


def test_plausible_bounds_are_inclusive(spark):
    high = [-10.0, -10.01, 60.0, 60.01, None]
    df = obs(spark, [(str(h), "a", D[0], "x", "s", h, 0.0, 50.0, None, None) for h in high])
    assert sorted(r["id"] for r in cleaning.filter_plausible(df).collect()) == ["-10.0", "60.0"]
    humid = [0.0, 100.0, 100.5, None]
    df = obs(spark, [(str(h), "a", D[0], "x", "s", 0.0, 0.0, h, None, None) for h in humid])
    assert sorted(r["id"] for r in cleaning.filter_plausible(df).collect()) == ["0.0", "100.0"]


def test_clean_fills_after_filtering(spark):
    df = obs(spark, [
        ("1", "a", D[0], None, "s", 10.0, 1.0, 1.0, 1.0, None),
        ("2", "b", D[0], "x", None, 10.0, 1.0, 1.0, 2.004, None),
        ("3", "c", D[0], "x", "s", 10.0, 1.0, 1.0, None, None),
        ("4", "d", D[0], "x", "s", 99.0, 1.0, 1.0, 100.0, None),
        ("5", "e", D[0], "x", "s", 10.0, 1.0, None, 100.0, None),
    ])
    rows = {r["id"]: r for r in cleaning.clean(df).collect()}
    assert sorted(rows) == ["1", "2", "3"]
    assert rows["3"]["std_max_temp"] == 1.5 and rows["2"]["std_max_temp"] == 2.004
    assert rows["3"]["max_temp"] is None  # a column without any value stays null
    assert rows["1"]["condition"] == "unknown" and rows["2"]["source"] == "unknown"


def test_audit_counts_each_step(spark):
    df = obs(spark, [
        ("1", "a", D[0], "x", "s", 10.0, 1.0, 1.0, None, None), ("1", "a", D[0], "x", "s", 9.0, 1.0, 1.0, None, None),
        ("2", "b", D[0], "x", "s", None, 1.0, 1.0, None, None), ("3", "c", D[0], "x", "s", 99.0, 1.0, 1.0, None, None),
        ("4", "d", None, "x", "s", 99.0, 1.0, 1.0, None, None),
    ])
    assert tuple(cleaning.row_audit(df).first()) == (5, 4, 2, 1)
    assert cleaning.null_counts(df).first()["date"] == 1


def log(spark, rows):
    return spark.createDataFrame(rows, "revision_timestamp timestamp_ntz, user string, comment string")


def left_days(spark, days):
    return spark.createDataFrame(list(enumerate(days)), "k int, date date")


def test_asof_cases(spark):
    changes = log(spark, [
        (datetime(2024, 1, 5, 23, 0), "u1", "late"), (datetime(2024, 1, 5, 1, 0), "u9", "early"),
        (datetime(2024, 1, 9, 12, 0), "b", "y"), (datetime(2024, 1, 9, 12, 0), "a", "z"),
        (datetime(2024, 1, 9, 12, 0), "a", "m"), (None, "n", "never"),
    ])
    days = [D[3], D[4], D[6], D[8], D[8], D[30], None, date(2030, 5, 5)]
    got = {r["k"]: (r["user"], r["comment"]) for r in asof.asof_backward(left_days(spark, days), changes).collect()}
    assert got == {0: (None, None), 1: ("u1", "late"), 2: ("u1", "late"), 3: ("a", "m"), 4: ("a", "m"),
                   5: ("a", "m"), 6: (None, None), 7: ("a", "m")}


def test_asof_without_any_change_keeps_rows(spark):
    got = asof.asof_backward(left_days(spark, [D[0], D[0], None]), log(spark, []))
    assert [r["user"] for r in got.collect()] == [None] * 3


def test_asof_against_brute_force(spark):
    rng = random.Random(7)
    changes = [(datetime(2024, 1, 1) + timedelta(hours=rng.randint(0, 2000)), str(i), "c") for i in range(40)]
    days = [date(2023, 12, 20) + timedelta(days=rng.randint(0, 120)) for _ in range(200)]
    got = {r["k"]: r["user"] for r in asof.asof_backward(left_days(spark, days), log(spark, changes)).collect()}
    for k, day in enumerate(days):
        before = [c for c in changes if c[0].date() <= day]
        best = min(before, key=lambda c: (-c[0].timestamp(), c[1]), default=(None, None))
        assert got[k] == best[1]


def test_nearest_date_cases(spark):
    table = spark.createDataFrame([(D[4],), (D[4],), (D[8],), (D[9],)], "date date")
    asked = [D[4], D[0], D[30], D[6], D[5], D[7], None]
    q = spark.createDataFrame(list(enumerate(asked)), "question_id int, asked_date date")
    got = {r["question_id"]: r["nearest_date"] for r in asof.with_nearest_date(q, table).collect()}
    assert got == {0: D[4], 1: D[4], 2: D[9], 3: D[4], 4: D[4], 5: D[8], 6: None}


def brute_run(seq):
    best, start = (0, -1, 0), 0
    for i in range(len(seq)):
        if i and seq[i] <= seq[i - 1]:
            start = i
        if i - start + 1 > best[2]:
            best = (start, i, i - start + 1)
    return best


@pytest.mark.parametrize("seq", [
    [5], [29, 30, 1, 2, 5, 31, 1, 2, 3], [1, 2, 1, 2], [3, 2, 1], [1, 2, 5, 9], [7, 7, 7],
    [30, 31, *range(1, 32), 1, 2],
])
@pytest.mark.parametrize("stretch", [2, 3, 1 << 16])
def test_longest_run_cases(spark, seq, stretch):
    df = spark.createDataFrame([("g", i, v) for i, v in enumerate(seq)], "g string, i int, v int")
    row = ranking.longest_increasing_run(df, ["g"], "i", "v", stretch).first()
    assert (row["run_start"], row["run_end"], row["run_length"]) == brute_run(seq)


def test_longest_run_over_stretches_against_brute_force(spark):
    rng = random.Random(3)
    seqs = {f"g{n}": [rng.randint(0, 30) if rng.random() < 0.3 else i for i in range(rng.randint(1, 120))] for n in range(25)}
    rows = [(g, i, v) for g, s in seqs.items() for i, v in enumerate(s)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, i int, v int")
    for stretch in (4, 7, 32):
        got = {r["g"]: (r["run_start"], r["run_end"], r["run_length"])
               for r in ranking.longest_increasing_run(df, ["g"], "i", "v", stretch).collect()}
        assert got == {g: brute_run(s) for g, s in seqs.items()}


def test_longest_run_of_nothing(spark):
    df = spark.createDataFrame([], "g string, i int, v int")
    assert ranking.longest_increasing_run(df, ["g"], "i", "v").count() == 0


def test_dense_ids_are_sorted_ranks(spark):
    names = [f"place {i * 7919 % 1000:04d}" for i in range(1000)]
    df = spark.createDataFrame([(n,) for n in names], "name string").repartition(7)
    got = {r["name"]: r["n"] for r in ranking.dense_ids(df, ["name"], "n").collect()}
    assert got == {n: i + 1 for i, n in enumerate(sorted(names))}
    assert ranking.dense_ids(df.where("name = ''"), ["name"], "n").count() == 0


def test_label_encode_counts_nulls_as_a_label(spark):
    df = spark.createDataFrame([("Luxor",), (None,), ("Cairo",), ("Aswan",), ("Cairo",)], "city string")
    rows = ranking.label_encode(df, "city", "code", "unknown").collect()
    assert sorted((str(r["city"]), r["code"]) for r in rows) == [
        ("Aswan", 0), ("Cairo", 1), ("Cairo", 1), ("Luxor", 2), ("None", 3)]


def silver(spark):
    rows = [(f"{p}_{d}", p, d, c, "s", 20.0 + i, 10.0, 50.0, 1.0, 1.0)
            for i, (p, d, c) in enumerate([("Cairo", D[1], "Sunny"), ("Cairo", D[0], "Fog"), ("Nowhere", D[1], "Fog"),
                                           ("Red Sea", D[4], "Dust")])]
    return staged(obs(spark, rows), "silver")


def test_star_schema(spark):
    table = silver(spark)
    tables = star.star_schema(table)
    assert values(tables["dim_location"]) == [(1, "Cairo", "Central"), (2, "Nowhere", "Unknown"), (3, "Red Sea", "East")]
    assert values(tables["dim_condition"]) == [(1, "Dust"), (2, "Fog"), (3, "Sunny")]
    dates = {r["date"]: r for r in tables["dim_date"].collect()}
    assert [dates[d]["date_id"] for d in (D[0], D[1], D[4])] == [1, 2, 3] and dates[D[4]]["is_weekend"]
    fact = tables["fact_weather"]
    assert fact.count() == table.count()
    assert fact.columns == ["id", "location_id", "date_id", "condition_id", "avg_max_temp", "avg_min_temp",
                            "avg_humidity", "temp_range", "heat_level"]
    assert fact.where("location_id is null or date_id is null or condition_id is null").count() == 0


def test_ml_ready_columns(spark):
    out = star.ml_ready(silver(spark).withColumn("weather_code", F.lit(1)))
    assert out.columns[:13] == ML_FIRST and "source" not in out.columns and "weather_code" not in out.columns


def test_standardize_spellings(spark):
    raw = spark.createDataFrame([("Kalyoubia", "2024-01-01", "61.0", "20", "x", "50", None)],
                                "Governorate string, Date string, Weather_Code string, Max_Temp string, Min_Temp string, Avg_Humidity string, Source string")
    row = columns.standardize(raw, {"Kalyoubia": "Qalyubia"}).first().asDict()
    assert row == {"governorate": "Qalyubia", "date": D[0], "weather_code": 61, "avg_max_temp": 20.0,
                   "avg_min_temp": None, "avg_humidity": 50.0, "source": None, "id": "Qalyubia_2024-01-01",
                   "condition": "weather_data"}


def test_standardize_keeps_plain_temperatures_next_to_averages(spark):
    raw = spark.createDataFrame([("i", "a", D[0], 1.0, 2.0, 3.0)], "id string, governorate string, date date, max_temp double, avg_max_temp double, min_temp double")
    out = columns.standardize(raw)
    assert out.columns == ["id", "governorate", "date", "max_temp", "avg_max_temp", "avg_min_temp", "condition", "source"]


def test_standardize_malformed_date_is_null(spark):
    raw = spark.createDataFrame([("a", "31/12/2024"), ("b", "2024-02-30")], "governorate string, date string")
    assert [r["date"] for r in columns.standardize(raw).collect()] == [None, None]


def test_serving_view_decodes_or_falls_back(spark):
    row = columns.serving_view(spark.createDataFrame([("2026-07-01", 5, 36.5, 23.0)],
                               "date string, city_encoded int, predicted_max_temp double, predicted_min_temp double")).first()
    assert (row["governorate"], row["avg_humidity"], row["temp_range"], row["heat_level"], row["season"]) == (
        "5", 0.0, 13.5, "moderate", "forecast")
    named = columns.serving_view(spark.createDataFrame([("2026-07-01", "Cairo", 5, 36.5, 23.0)],
                                 "date string, governorate string, city_encoded int, predicted_max_temp double, predicted_min_temp double"))
    assert named.first()["governorate"] == "Cairo"


def test_unpivot_and_month_join(spark):
    wide = spark.createDataFrame([("Rain", *[f"{m}.5(1)" for m in range(1, 13)])],
                                 "metric_name string, " + ", ".join(f"{m} string" for m in normals.MONTHS))
    long = normals.unpivot_months(wide)
    assert sorted((r["month_num"], r["value"]) for r in long.collect()) == [(m, f"{m}.5(1)") for m in range(1, 13)]
    joined = normals.join_month_normals(left_days(spark, [D[0], date(2024, 12, 1), None]), long)
    assert sorted((r["k"], r["climate_normal_value"]) for r in joined.collect()) == [(0, "1.5(1)"), (1, "12.5(1)")]


def test_a_third_of_all_rows_on_one_key(spark):
    rng = random.Random(11)
    rows = [("x", "hot" if rng.random() < 0.34 else f"p{rng.randint(0, 40)}", D[0] if rng.random() < 0.34 else D[rng.randint(0, 9)],
             "c", "s", float(rng.randint(-20, 70)), float(rng.randint(-20, 70)), 50.0, None, None) for _ in range(6000)]
    best = {}
    for r in rows:
        k, valid = (r[1], r[2]), all(-10 <= x <= 60 for x in r[5:7])
        best[k] = max(best.get(k, (False, -99.0, -99.0)), (valid, r[5], r[6]))
    best = {k: v[1:] for k, v in best.items()}
    df = obs(spark, rows).repartition(8)
    got = {(r["governorate"], r["date"]): (r["avg_max_temp"], r["avg_min_temp"]) for r in cleaning.dedup_rows(df).collect()}
    assert got == best
    audit = cleaning.row_audit(df).first()
    assert (audit["rows_before"], audit["rows_after_dedup"]) == (6000, len(best))
