"""Features, split, grid and models."""

from datetime import date, timedelta
from math import ceil

import pytest
from pyspark.sql import functions as F

from skyledger.operators import columns, features, forecast

DAY = date(2024, 1, 1)


def rows_of(spark, per_day):
    rows = [(f"p{j:03d}", DAY + timedelta(days=i)) for i, n in enumerate(per_day) for j in range(n)]
    return spark.createDataFrame(rows, "governorate string, date date").repartition(3), sorted(rows, key=lambda r: (r[1], r[0]))


@pytest.mark.parametrize("per_day", [[1, 1, 1, 1], [5], [1, 6], [2, 2, 2, 1], [1], [1, 50, 1], [3, 0, 9, 30]])
def test_chronological_split(spark, per_day):
    df, ordered = rows_of(spark, per_day)
    train, test = features.split_chronological(df)
    cut = len(ordered) - ceil(0.2 * len(ordered))
    assert sorted((r["date"], r["governorate"]) for r in train.collect()) == [(d, g) for g, d in ordered[:cut]]
    assert sorted((r["date"], r["governorate"]) for r in test.collect()) == [(d, g) for g, d in ordered[cut:]]


def test_split_without_holdout(spark):
    df, ordered = rows_of(spark, [3, 2])
    train, test = features.split_chronological(df, holdout=0.0)
    assert train.count() == 5 and test.count() == 0
    assert features.split_chronological(df.where("date is null"))[0].count() == 0


def test_prepare_from_identifier_and_dirty_text(spark):
    df = spark.createDataFrame(
        [("Siwa_2023-03-01", "11.4", "27.5", None), ("Tanta_2023-06-30", "8.25", "33.0", "Rain"),
         ("Qena_soon", None, "n/a", "Rain"), ("Qena_2023-06-29", None, "n/a", "Haze")],
        "id string, temp_range string, max_temp string, condition string")
    out = features.prepare(df)
    rows = {r["city"]: r for r in out.collect()}
    assert len(rows) == 3 and rows["Qena"]["max_temp"] is None and rows["Siwa"]["temp_range"] == 11.4
    assert [rows[c]["city_encoded"] for c in ("Qena", "Siwa", "Tanta")] == [0, 1, 2]
    assert [rows[c]["condition_encoded"] for c in ("Qena", "Tanta", "Siwa")] == [0, 1, 2]
    assert (rows["Siwa"]["month"], rows["Siwa"]["day_of_year"], rows["Siwa"]["year"]) == (3, 60, 2023)
    assert features.feature_names(out) == ["month", "day_of_year", "year", "city_encoded", "temp_range"]


def test_coerce_skips_absent_columns(spark):
    df = spark.createDataFrame([("9.10",), ("x",)], "temp_range string")
    assert [r[0] for r in columns.coerce_numeric(df, ["temp_range", "max_temp"]).collect()] == [9.1, None]


def test_targets(spark):
    both = spark.createDataFrame([(1.0, 2.0, 3.0, 4.0)], "avg_max_temp double, avg_min_temp double, max_temp double, min_temp double")
    assert features.target_names(both) == ("avg_max_temp", "avg_min_temp")
    assert features.target_names(both.drop("avg_max_temp", "avg_min_temp")) == ("max_temp", "min_temp")
    with pytest.raises(KeyError):
        features.target_names(both.select("avg_max_temp"))


def ready(spark):
    rows = [(c, DAY + timedelta(days=i), 25.0 + 10 * (i % 5) + k, 12.0 + k, 13.0 + 10 * (i % 5), "hot" if i % 5 > 2 else "mild")
            for k, c in enumerate(["Cairo", "Luxor"]) for i in range(60)]
    df = spark.createDataFrame(rows, "governorate string, date date, avg_max_temp double, avg_min_temp double, temp_range double, condition string")
    return features.prepare(df).cache()


def test_future_grid(spark):
    df = ready(spark)
    grid = features.future_grid(df, 180)
    assert grid.count() == 360
    first = grid.agg(F.min("date"), F.max("date"), F.min("temp_range"), F.max("temp_range")).first()
    assert (first[0], first[1]) == (DAY + timedelta(days=60), DAY + timedelta(days=239))
    assert first[2] == first[3] == pytest.approx(33.0)
    assert features.future_grid(df, 3, "Cairo").select("city_encoded").distinct().collect()[0][0] == 0
    unknown = features.future_grid(df, 3, "Nowhere")
    assert unknown.count() == 3 and unknown.first()["city_encoded"] == 0
    local = features.future_grid(df, 180, by_place_month=True)
    assert local.where("temp_range is null").count() == 0 and local.columns.count("temp_range") == 1


def test_models_train_and_decode(spark):
    df = ready(spark)
    train, test = features.split_chronological(df)
    models = forecast.train_models(train, trees=5)
    scored = forecast.predict(models, test, forecast.condition_labels(df))
    assert scored.count() == 24 and set(r[0] for r in scored.select("predicted_condition").distinct().collect()) <= {"hot", "mild"}
    metrics = forecast.holdout_metrics(scored, train).first()
    assert metrics["rows"] == 24 and metrics["rmse_max"] < metrics["seasonal_rmse_max"]


def test_rows_with_missing_features_are_predicted(spark):
    df = ready(spark).withColumns({
        "temp_range": F.when(F.dayofmonth("date") % 3 != 0, F.col("temp_range")), "std_max_temp": F.lit(None).cast("double"),
        "std_min_temp": F.when(F.col("city") == "Cairo", 1.5)})
    models = forecast.train_models(df, trees=3)
    out = forecast.predict(models, df, forecast.condition_labels(df))
    assert out.count() == df.count() == 120
    assert out.where("predicted_max_temp is null or predicted_min_temp is null or predicted_condition is null").count() == 0


def test_no_classifier_without_condition(spark):
    df = ready(spark).drop("condition_encoded")
    models = forecast.train_models(df, trees=2)
    assert models.condition is None and "predicted_condition" not in forecast.predict(models, df).columns


def test_forecast_of_one_place(spark):
    df = ready(spark)
    out = forecast.forecast(df, df, days=7, place="Luxor", trees=2)
    assert out.count() == 7 and out.columns[-3:] == ["predicted_max_temp", "predicted_min_temp", "predicted_condition"]


def test_holdout_errors_at_a_small_size(spark, monkeypatch):
    """Errors and comparisons are those of brute force."""
    from skyledger.plans import models

    df = ready(spark)
    train, test = features.split_chronological(df)
    guess = test.withColumns({"predicted_max_temp": F.col("avg_max_temp") + F.dayofmonth("date") % 4, "predicted_min_temp": F.col("avg_min_temp") + 100})
    monkeypatch.setattr(models, "split", lambda spark, sf: (df, train, test))
    monkeypatch.setattr(models, "scored", lambda train, test: guess)
    got = models.QUERIES["ml_holdout_errors"](spark, "").first()
    past, rows = train.collect(), guess.collect()

    def rmse(pairs):
        return (sum((a - b) ** 2 for a, b in pairs) / len(rows)) ** 0.5

    def seasonal(r, column):
        same = [p[column] for p in past if (p.city_encoded, p.month) == (r.city_encoded, r.month)] or [p[column] for p in past]
        return sum(same) / len(same)

    assert got.rows == len(rows)
    for side in ("max", "min"):
        column = f"avg_{side}_temp"
        own, base = rmse([(r[f"predicted_{side}_temp"], r[column]) for r in rows]), rmse([(seasonal(r, column), r[column]) for r in rows])
        assert got[f"rmse_{side}"] == pytest.approx(own) and got[f"seasonal_rmse_{side}"] == pytest.approx(base)
        assert got[f"{side}_beats_seasonal"] is (own < base)
    assert got.max_beats_seasonal and not got.min_beats_seasonal


def test_holdout_verdict_is_a_bootstrap_by_day(spark):
    import random

    from skyledger.operators.features import split_chronological

    df = ready(spark)
    train, test = split_chronological(df)
    guess = test.withColumns({"predicted_max_temp": F.col("avg_max_temp") + F.dayofmonth("date") % 4, "predicted_min_temp": F.col("avg_min_temp") + 100})
    got = forecast.holdout_verdict(guess, train).first()
    assert got == forecast.holdout_verdict(guess.repartition(5), train).first()
    assert (got.verdict_max, got.verdict_min) == ("better", "worse") and got.low_max <= got.difference_max <= got.high_max
    rows = forecast.with_seasonal(guess, train).collect()
    days = sorted({r.date for r in rows})
    per = {d: [(r.predicted_max_temp - r.avg_max_temp) ** 2 for r in rows if r.date == d] for d in days}
    base = {d: [(r._high - r.avg_max_temp) ** 2 for r in rows if r.date == d] for d in days}
    rng, found = random.Random(1), []
    for _ in range(4000):
        chosen = [d for d in rng.choices(days, k=len(days))]
        own, mean = ([x for d in chosen for x in part[d]] for part in (per, base))
        found.append((sum(own) / len(own)) ** 0.5 - (sum(mean) / len(mean)) ** 0.5)
    found.sort()
    width = found[3900] - found[100]
    assert got.low_max == pytest.approx(found[100], abs=0.35 * width) and got.high_max == pytest.approx(found[3900], abs=0.35 * width)
    same = guess.withColumn("predicted_max_temp", F.col("avg_max_temp") + F.when(F.dayofmonth("date") % 2 == 0, 9).otherwise(0))
    assert forecast.holdout_verdict(same, train).first().verdict_max in ("open", "better", "worse")
    assert forecast.holdout_verdict(guess.limit(0), train).first().verdict_max is None


def test_poisson_weights(spark):
    w = spark.range(200_000).select(forecast.poisson_one((F.col("id") + 0.5) / 200_000).alias("w")).groupBy("w").count().collect()
    share = {r.w: r["count"] / 200_000 for r in w}
    assert share[0] == pytest.approx(0.36788, abs=1e-3) and share[1] == pytest.approx(0.36788, abs=1e-3) and share[3] == pytest.approx(0.06131, abs=1e-3)
    assert sum(k * v for k, v in share.items()) == pytest.approx(1, abs=1e-3)


def test_boosting_of_several_classes_beats_the_most_frequent_one(spark):
    kinds = ["clear", "fog", "rain", "storm"]
    rows = [("Cairo" if i % 2 else "Luxor", DAY + timedelta(days=i), 20.0 + i % 30, 10.0, float((7 * i) % 40), kinds[((7 * i) % 40) // 10 ^ (i % 2)]) for i in range(400)]
    df = features.prepare(spark.createDataFrame(
        rows, "governorate string, date date, avg_max_temp double, avg_min_temp double, temp_range double, condition string"))
    train, test = features.split_chronological(df)
    coded = forecast.score(forecast.train_classifier(train, trees=4), test, "_condition_code").cache()
    got = forecast.condition_accuracy(coded, train).first()
    pairs = [(r.condition_encoded, r._condition_code) for r in coded.collect()]
    codes = [r.condition_encoded for r in train.collect()]
    most = min(set(codes), key=lambda c: (-codes.count(c), c))
    assert got.rows == len(pairs) == 80 and got.accuracy == pytest.approx(sum(a == b for a, b in pairs) / 80)
    assert got.most_frequent_accuracy == pytest.approx(sum(a == most for a, _ in pairs) / 80)
    assert got.accuracy > 0.8 and got.beats_most_frequent
    one = forecast.train_classifier(train.withColumn("condition_encoded", F.lit(0)), trees=2)
    assert {r._condition_code for r in forecast.score(one, test, "_condition_code").collect()} == {0.0}


def test_a_day_with_one_place_is_split_evenly_and_reproducibly(spark):
    """Most rows are of one day and place: 900 different ones and 300 copies of one row, beside other days and places."""
    from skyledger.operators.features import mark_split

    rows = [(date(2024, 1, 1), "a", i) for i in range(20)] + [(date(2024, 1, 2), p, i) for p in ("b", None, "z") for i in range(5)]
    hot = [(date(2024, 1, 2), "h", i) for i in range(900)] + [(date(2024, 1, 2), "h", -1)] * 300
    df = spark.createDataFrame(rows + hot + [(date(2024, 1, 3), "a", 1), (None, "a", 2)], "date date, governorate string, v int")
    n, seen = len(rows) + len(hot) + 2, []
    for share in (0.05, 0.5, 0.77, 1.0):
        for parts in (2, 7):
            marked = mark_split(df.repartition(parts), share)
            assert marked.count() == n
            train = sorted((tuple(r)[:3] for r in marked.where("is_train").collect()), key=str)
            assert len(train) == max(1, n - ceil(share * n))  # the row without a day trains
            seen.append(train)
        assert seen[-1] == seen[-2]
        early = {r[1] for r in seen[-1] if r[0] == date(2024, 1, 2)}
        assert "z" not in early or {"b", "h", None} <= early
    copies = spark.createDataFrame([(date(2024, 1, 1), "a", 1)] * 3_500, "date date, governorate string, v int")
    assert mark_split(copies, 0.3).where("is_train").count() == 2_450
