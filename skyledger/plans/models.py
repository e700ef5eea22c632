"""Registered queries: features, models, forecast.

Predicted values have no SQL equivalent. Queries with SQL return what it can state of models: the rows they must cover, and whether
each has its predictions. Measured errors are returned by queries without SQL, which tests hold against brute force.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from skyledger.operators import cleaning, features, forecast, star
from skyledger.plans import bindings as b
from skyledger.plans.bindings import with_views
from skyledger.storage import staged

TREES = forecast.TREES


def prepared(spark, sf):
    """Model input of the merged nation observations, as a stage table."""
    silver = cleaning.clean(b.plain(b.merged(spark, sf)))
    return staged(features.prepare(star.ml_ready(silver)), "prepared")


def split(spark, sf):
    """Prepared rows and their chronological parts. The split is written once; both parts read it."""
    ready = prepared(spark, sf)
    marked = staged(features.mark_split(ready), "split")
    return ready, marked.where("is_train").drop("is_train"), marked.where(~F.col("is_train")).drop("is_train")


def ml_feature_select(spark, sf):
    ready = prepared(spark, sf)
    return ready.select("id", *features.feature_names(ready))


def scored(train, test):
    """Hold-out rows with both regressors' predictions, as a stage table."""
    high, low = features.target_names(train)
    with_max = forecast.score(forecast.train_regressor(train, high, "predicted_max_temp", TREES), test, "predicted_max_temp")
    return staged(forecast.score(forecast.train_regressor(train, low, "predicted_min_temp", TREES), with_max, "predicted_min_temp"), "scored")


def ml_train_regressors(spark, sf):
    """Hold-out rows per month, and those that have both predictions within the range of the observed values."""
    _, train, test = split(spark, sf)
    high, low = features.target_names(train)
    bounds = staged(train.agg(*[f(c).alias(f"{f.__name__}_{i}") for i, c in enumerate((high, low)) for f in (F.min, F.max)]), "bounds")

    def near(column, i):
        spread = bounds.select(F.col(f"max_{i}") - F.col(f"min_{i}")).scalar()
        return F.col(column).between(bounds.select(f"min_{i}").scalar() - spread, bounds.select(f"max_{i}").scalar() + spread)

    sound = near("predicted_max_temp", 0) & near("predicted_min_temp", 1)
    return scored(train, test).groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(sound).alias("predicted"))


def ml_train_classifier(spark, sf):
    """Hold-out rows per observed condition, and those whose predicted condition is a known one."""
    ready, train, test = split(spark, sf)
    coded = forecast.score(forecast.train_classifier(train, TREES), test, "_condition_code")
    known = forecast.condition_labels(ready).select(F.col("condition_encoded").cast("double").alias("_condition_code"), F.lit(True).alias("known"))
    return coded.join(known, "_condition_code", "left").groupBy("condition_encoded").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if("known").alias("decoded"))


def ml_future_grid(spark, sf):
    grid = features.future_grid(prepared(spark, sf))
    return grid.withColumns({c: F.round(c, 6) for c in features.IMPUTED if c in grid.columns})


def ml_predict_decode(spark, sf):
    """Every place and day ahead, with whether both temperatures and a known condition are predicted."""
    ready, train, _ = split(spark, sf)
    labels = forecast.condition_labels(ready).select(F.col("condition").alias("predicted_condition"), F.lit(True).alias("_known"))
    ahead = forecast.forecast(ready, train, days=180, trees=TREES).join(labels, "predicted_condition", "left")
    return ahead.select(
        "governorate", "date", (F.col("predicted_max_temp").isNotNull() & F.col("predicted_min_temp").isNotNull()).alias("both_predicted"),
        F.coalesce("_known", F.lit(False)).alias("condition_known"))


def ml_target_fallback(spark, sf):
    """Both column families: averages where present, plain temperatures otherwise."""
    merged = b.plain(b.merged(spark, sf))
    plain_only = merged.drop("avg_max_temp", "avg_min_temp")
    high, low = features.target_names(merged)
    plain_high, plain_low = features.target_names(plain_only)
    return merged.select(
        "id", F.col(high).alias("target_max"), F.col(low).alias("target_min"),
        F.col(plain_high).alias("plain_target_max"), F.col(plain_low).alias("plain_target_min"))


def ml_holdout_metrics(spark, sf):
    """Hold-out errors next to those of a seasonal mean, the interval of their difference and a verdict, at every size."""
    _, train, test = split(spark, sf)
    return forecast.holdout_verdict(scored(train, test), train)


def ml_classifier_accuracy(spark, sf):
    """Hold-out accuracy of the condition model, next to that of always naming the most frequent condition, at every size."""
    _, train, test = split(spark, sf)
    coded = staged(forecast.score(forecast.train_classifier(train, TREES), test, "_condition_code"), "coded")
    return forecast.condition_accuracy(coded, train)


def ml_holdout_errors(spark, sf):
    """Hold-out rows, the errors of models and seasonal mean, and whether the models' are smaller, at every size.

    Null only without a hold-out row. No SQL can state these values.
    """
    _, train, test = split(spark, sf)
    return forecast.holdout_metrics(scored(train, test), train).withColumns({
        "max_beats_seasonal": F.col("rmse_max") < F.col("seasonal_rmse_max"),
        "min_beats_seasonal": F.col("rmse_min") < F.col("seasonal_rmse_min")})


QUERIES = {
    "ml_feature_select": ml_feature_select, "ml_train_regressors": ml_train_regressors,
    "ml_train_classifier": ml_train_classifier, "ml_future_grid": ml_future_grid,
    "ml_predict_decode": ml_predict_decode, "ml_target_fallback": ml_target_fallback,
    "ml_holdout_metrics": ml_holdout_metrics, "ml_holdout_errors": ml_holdout_errors,
    "ml_classifier_accuracy": ml_classifier_accuracy,
}

# Cleaning of the merged table: keys are unique already.
PREPARED = f""", kept AS (SELECT * FROM merged WHERE avg_max_temp IS NOT NULL AND avg_min_temp IS NOT NULL
  AND avg_humidity IS NOT NULL AND avg_max_temp BETWEEN -10 AND 60 AND avg_min_temp BETWEEN -10 AND 60
  AND avg_humidity BETWEEN 0 AND 100),
prepared AS (SELECT id, governorate, date, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
  CAST(dayofyear(date) AS INTEGER) AS day_of_year,
  CAST(dense_rank() OVER (ORDER BY governorate) - 1 AS INTEGER) AS city_encoded,
  round(avg_max_temp - avg_min_temp, 2) AS temp_range,
  coalesce(std_min_temp, (SELECT round(avg(std_min_temp), 2) FROM kept)) AS std_min_temp,
  coalesce(std_max_temp, (SELECT round(avg(std_max_temp), 2) FROM kept)) AS std_max_temp,
  CAST(dense_rank() OVER (ORDER BY coalesce(condition, 'unknown')) - 1 AS INTEGER) AS condition_encoded,
  row_number() OVER (ORDER BY date, governorate) > count(*) OVER () - ceil(0.2 * count(*) OVER ()) AS held FROM kept)
"""

SQL = {
    "ml_feature_select": with_views(f"""{PREPARED} SELECT id, month, day_of_year, year, city_encoded, temp_range,
  std_min_temp, std_max_temp FROM prepared""", "merged"),
    "ml_future_grid": with_views(f"""{PREPARED}, grid AS (SELECT governorate, city_encoded,
  CAST((SELECT max(date) FROM prepared) + CAST(n AS INTEGER) AS DATE) AS date
  FROM (SELECT DISTINCT governorate, city_encoded FROM prepared), range(1, 181) r(n))
SELECT governorate, date, CAST(month(date) AS INTEGER) AS month, CAST(dayofyear(date) AS INTEGER) AS day_of_year,
  CAST(year(date) AS INTEGER) AS year, city_encoded, (SELECT round(avg(temp_range), 6) FROM prepared) AS temp_range,
  (SELECT round(avg(std_min_temp), 6) FROM prepared) AS std_min_temp,
  (SELECT round(avg(std_max_temp), 6) FROM prepared) AS std_max_temp FROM grid""", "merged"),
    "ml_train_regressors": with_views(f"""{PREPARED} SELECT year, month, count(*) AS rows, count(*) AS predicted
FROM prepared WHERE held GROUP BY year, month""", "merged"),
    "ml_train_classifier": with_views(f"""{PREPARED} SELECT condition_encoded, count(*) AS rows, count(*) AS decoded
FROM prepared WHERE held GROUP BY condition_encoded""", "merged"),
    "ml_predict_decode": with_views(f"""{PREPARED} SELECT governorate,
  CAST((SELECT max(date) FROM prepared) + CAST(n AS INTEGER) AS DATE) AS date, true AS both_predicted, true AS condition_known
FROM (SELECT DISTINCT governorate FROM prepared), range(1, 181) r(n)""", "merged"),
    "ml_target_fallback": with_views("""SELECT id, avg_max_temp AS target_max, avg_min_temp AS target_min,
  max_temp AS plain_target_max, min_temp AS plain_target_min FROM merged""", "merged"),
}
