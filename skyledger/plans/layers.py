"""Registered queries: whole layers, from both observation sources to silver and fact."""

from __future__ import annotations

from skyledger.operators import star
from skyledger.plans import bindings as b
from skyledger.plans import lakehouse
from skyledger.plans.bindings import plain, with_views
from skyledger.plans.relational import HEAT_CASE
from skyledger.storage import staged

SOURCE_ORDER = ["unknown", "archive"]


def silver_layer(spark, sf):
    monthly = plain(b.archive(spark, sf)).withColumnRenamed("weather_date", "date")
    observed = lakehouse.bronze(plain(b.merged(spark, sf)), monthly)
    return lakehouse.silver(observed, b.order_revisions(spark, sf), SOURCE_ORDER)


def gold_fact(spark, sf):
    return star.star_schema(staged(silver_layer(spark, sf), "silver"))["fact_weather"]


QUERIES = {"silver_layer": silver_layer, "gold_fact": gold_fact}

FILLED = ["high_temp_c", "max_temp", "range_max_temp", "std_max_temp", "low_temp_c", "min_temp",
          "range_min_temp", "std_min_temp"]
LAYERS = f""", bronze AS (
SELECT id, governorate, date, weather_code, condition, 'unknown' AS source, avg_max_temp, avg_min_temp, avg_humidity,
  {', '.join(FILLED)} FROM merged
UNION ALL SELECT governorate || '_' || strftime(weather_date, '%Y-%m-%d'), governorate, weather_date, weather_code,
  'weather_data', 'archive', max_temp, min_temp, avg_humidity, {', '.join(['NULL'] * len(FILLED))} FROM archive),
one_per_day AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY governorate, date
  ORDER BY CASE source WHEN 'unknown' THEN 1 ELSE 2 END) AS rn FROM bronze) WHERE rn = 1),
usable AS (SELECT * EXCLUDE (rn) FROM one_per_day WHERE governorate IS NOT NULL AND date IS NOT NULL
  AND avg_max_temp BETWEEN -10 AND 60 AND avg_min_temp BETWEEN -10 AND 60 AND avg_humidity BETWEEN 0 AND 100),
in_force AS (SELECT d.date, v.* FROM (SELECT DISTINCT date FROM usable) d LEFT JOIN LATERAL (
  SELECT * FROM order_revisions v WHERE CAST(v.revision_timestamp AS DATE) <= d.date
  ORDER BY v.revision_timestamp DESC, v."user", v.comment LIMIT 1) v ON TRUE),
layer AS (SELECT u.* REPLACE (coalesce(u.condition, 'unknown') AS condition,
  {', '.join(f'coalesce(u.{c}, (SELECT round(avg({c}), 2) FROM usable)) AS {c}' for c in FILLED)}),
  f.revision_timestamp, coalesce(f."user", 'unknown') AS "user", coalesce(f.comment, 'unknown') AS comment
  FROM usable u JOIN in_force f ON f.date = u.date)
"""

SQL = {
    "silver_layer": with_views(f"{LAYERS} SELECT * FROM layer", "merged", "archive", "order_revisions"),
    "gold_fact": with_views(f"""{LAYERS} SELECT id,
  CAST(dense_rank() OVER (ORDER BY governorate) AS INTEGER) AS location_id,
  CAST(dense_rank() OVER (ORDER BY date) AS INTEGER) AS date_id,
  CAST(dense_rank() OVER (ORDER BY condition) AS INTEGER) AS condition_id,
  avg_max_temp, avg_min_temp, avg_humidity, round(avg_max_temp - avg_min_temp, 2) AS temp_range,
  {HEAT_CASE} AS heat_level FROM layer""", "merged", "archive", "order_revisions"),
}
