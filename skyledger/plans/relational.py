"""Registered queries: projections, filters, joins, aggregates, windows, sorts, set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyledger.functions import weather
from skyledger.functions.text import date_in_text
from skyledger.operators import asof, cleaning, collect, columns, extract, merge, normals, ranking, retrieval, star
from skyledger.operators.features import feature_means, mark_split, sort_chronological
from skyledger.plans import bindings as b
from skyledger.plans.bindings import plain, with_views
from skyledger.schemas import MEAN_FILLED, ML_DROPPED
from skyledger.sources.writers import new_months
from skyledger.storage import staged

# Regions of the nations in the given tables; nations beyond these have none.
NATION_REGIONS = {
    "NATION_0": "Central", "NATION_1": "North", "NATION_2": "Upper Egypt", "NATION_3": "East",
    "NATION_4": "West",
}
REGION_CASE = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in NATION_REGIONS.items())


def raw_reports(spark, sf):
    """Reports in the spelling of a raw file: capitalised names, every value as text."""
    r = b.reports(spark, sf)
    names = {
        "Governorate": "governorate", "Date": "date", "Weather_Code": "weather_code",
        "Max_Temp": "avg_max_temp", "Min_Temp": "avg_min_temp", "Avg_Humidity": "avg_humidity",
        "Source": "source",
    }
    return r.select(*[F.col(c).cast("string").alias(n) for n, c in names.items()])


def silver_table(spark, sf):
    """Cleaned reports: a projection on the stage table of valid rows, which dimensions and fact all read."""
    return cleaning.clean(b.reports(spark, sf), b.SOURCE_ORDER)


def valid_reports(spark, sf):
    return staged(cleaning.keep_valid(b.reports(spark, sf), b.SOURCE_ORDER), "valid")


# ---- projections -------------------------------------------------------------------------------

def standardize_columns(spark, sf):
    return columns.standardize(raw_reports(spark, sf))


def synth_id(spark, sf):
    return b.archive(spark, sf).select(
        weather.observation_id(F.col("governorate"), F.col("weather_date")).alias("id"), "weather_code"
    )


def default_columns(spark, sf):
    bare = b.reports(spark, sf).select("id", "avg_max_temp", "avg_min_temp", "source")
    return columns.add_defaults(bare, {
        "condition": F.lit(columns.DEFAULT_CONDITION),
        "source": F.lit(columns.DEFAULT_SOURCE),
        "avg_humidity": F.lit(0.0),
        "temp_range": F.col("avg_max_temp") - F.col("avg_min_temp"),
    })


def rename_positional(spark, sf):
    raw = raw_reports(spark, sf).select("Date", "Weather_Code", "Max_Temp", "Min_Temp", "Avg_Humidity")
    return columns.rename_positional(raw, [f"Column_{i}" for i in range(5)])


def reorder_priority(spark, sf):
    return columns.priority_first(plain(b.merged(spark, sf)), ["governorate", "date", "avg_max_temp"])


def drop_if_present(spark, sf):
    return columns.drop_if_present(plain(b.merged(spark, sf)), ML_DROPPED)


def cast_timestamp(spark, sf):
    text = b.table(spark, sf, "events").select(
        "event_id", F.when(F.col("event_type") == "signup", F.lit("no time")).otherwise(
            F.col("ts").cast("string")).alias("text"))
    return text.select("event_id", F.col("text").try_cast("timestamp_ntz").alias("revision_timestamp"))


def normalize_forecast(spark, sf):
    forecast = b.archive(spark, sf).select(
        "governorate", F.col("weather_date").alias("date"),
        F.col("max_temp").cast("double").alias("predicted_max_temp"),
        F.col("min_temp").cast("double").alias("predicted_min_temp"),
    )
    return columns.serving_view(forecast)


def ml_ready(spark, sf):
    return star.ml_ready(cleaning.clean(b.reports(spark, sf), b.SOURCE_ORDER))


# ---- filters -----------------------------------------------------------------------------------

def drop_null_core(spark, sf):
    return cleaning.drop_null_core(b.reports(spark, sf))


def filter_plausible(spark, sf):
    return cleaning.filter_plausible(b.reports(spark, sf))


def filter_date_not_null(spark, sf):
    lines = b.table(spark, sf, "lineitem")
    text = F.when(F.col("l_linenumber") == 7, F.lit("unknown")).otherwise(F.col("l_shipdate").cast("string"))
    return lines.select("l_orderkey", "l_linenumber", weather.to_day(text).alias("date")).where(
        F.col("date").isNotNull())


def filter_valid_day(spark, sf):
    orders = b.table(spark, sf, "orders")
    day = F.dayofmonth("o_orderdate") + F.when(F.col("o_orderstatus") == "P", F.lit(3)).otherwise(F.lit(0))
    return extract.valid_days(orders.select(
        "o_orderkey", F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"),
        day.alias("day")))


def point_lookup(spark, sf):
    return retrieval.point_lookup(b.serving(spark, sf), "NATION_7", b.TODAY)


def filter_optional(spark, sf):
    table = staged(b.serving(spark, sf), "serving")
    questions = staged(b.questions(spark, sf), "questions")
    asked = retrieval.understand(questions, table.select("governorate"), b.today())
    return retrieval.matching_rows(staged(retrieval.question_keys(asked, table), "keys"), table)


# ---- joins -------------------------------------------------------------------------------------

def join_full_outer_merge(spark, sf):
    return plain(b.merged(spark, sf))


def join_aliased_merge(spark, sf):
    """The calendar spells some places its own way; aliases bring its rows back to those of the archive."""
    own = F.when(F.length("governorate") % 2 == 0, F.concat(F.lit("Greater "), "governorate")).otherwise(F.col("governorate"))
    names = [r[0] for r in b.table(spark, sf, "nation").select("n_name").collect()]  # 25 rows at any size
    calendar = columns.rename_places(b.calendar(spark, sf).withColumn("governorate", own), {f"Greater {n}": n for n in names})
    return plain(merge.merge_sources(calendar, b.archive(spark, sf)))


def join_asof_backward(spark, sf):
    left = b.table(spark, sf, "events").select(
        "event_id", "user_id", F.col("ts").cast("date").alias("date"))
    return asof.asof_backward(left, b.revisions(spark, sf))


def join_lateral_top1(spark, sf):
    left = b.reports(spark, sf).select("id", "governorate", "date", "avg_max_temp")
    return asof.asof_backward(left, b.order_revisions(spark, sf))


def join_month_normals(spark, sf):
    observed = b.archive(spark, sf).select(
        "governorate", F.col("weather_date").alias("date"), F.col("max_temp").cast("double").alias("max_temp"))
    return normals.join_month_normals(observed, normals.unpivot_months(b.normals(spark, sf)))


def join_star_dims(spark, sf):
    return star.star_schema(silver_table(spark, sf))["fact_weather"]


def monthly(spark, sf):
    """Archive observations with their month, as they are dropped file by file."""
    day = F.col("weather_date")
    return plain(b.archive(spark, sf)).select(
        "governorate", day.alias("date"), F.year(day).alias("year"), F.month(day).alias("month"),
        F.col("weather_code").cast("double").alias("weather_code"), "max_temp", "min_temp",
        "avg_humidity", "source")


def join_anti_loaded(spark, sf):
    loaded = b.table(spark, sf, "orders").where(F.col("o_orderstatus") == "P").where(
        F.month("o_orderdate") < 7).select(
        F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"))
    return new_months(monthly(spark, sf), loaded)


def join_cross_plan(spark, sf):
    places = b.table(spark, sf, "supplier").select(F.col("s_name").alias("city"))
    return collect.collection_plan(places, b.today())


def join_region_map(spark, sf):
    return b.archive(spark, sf).select(
        "governorate", "weather_date",
        star.region_of(F.col("governorate"), NATION_REGIONS).alias("region"))


def join_nearest_date(spark, sf):
    asked = b.questions(spark, sf).select(
        "question_id", date_in_text(F.col("question"), b.today()).alias("asked_date"))
    asked = staged(asked.where(F.col("asked_date").isNotNull()), "asked")
    return asof.with_nearest_date(asked, b.serving(spark, sf))


# ---- aggregates --------------------------------------------------------------------------------

def agg_column_means(spark, sf):
    means = cleaning.column_means(valid_reports(spark, sf), MEAN_FILLED)
    return means.select(*[F.round(c, 6).alias(c) for c in means.columns])


def agg_mean_features(spark, sf):
    r = b.reports(spark, sf)
    ranged = r.withColumn("temp_range", weather.temp_range(F.col("avg_max_temp"), F.col("avg_min_temp")))
    return feature_means(ranged).select(
        F.round("temp_range", 6).alias("temp_range"), F.round("std_min_temp", 6).alias("std_min_temp"),
        F.round("std_max_temp", 6).alias("std_max_temp"))


def agg_null_counts(spark, sf):
    return cleaning.null_counts(b.reports(spark, sf))


def agg_row_audit(spark, sf):
    return cleaning.row_audit(b.reports(spark, sf), b.SOURCE_ORDER)


def agg_date_range(spark, sf):
    return retrieval.date_range(b.reports(spark, sf))


def agg_argmax_hottest(spark, sf):
    return retrieval.hottest_row(b.serving(spark, sf))


def agg_distinct_sorted(spark, sf):
    return retrieval.known_places(b.reports(spark, sf))


def agg_distinct(spark, sf):
    return b.reports(spark, sf).select("governorate", "condition").distinct()


def agg_row_mean_nullaware(spark, sf):
    m = b.merged(spark, sf)
    return plain(m.select("id", "avg_max_temp", "avg_min_temp"))


def agg_row_range(spark, sf):
    return plain(b.merged(spark, sf).select("id", "range_max_temp", "range_min_temp"))


def agg_row_std(spark, sf):
    return b.merged(spark, sf).select("id", "std_max_temp", "std_min_temp")


# ---- windows -----------------------------------------------------------------------------------

def win_latest_per_key(spark, sf):
    e = b.table(spark, sf, "events").select("event_id", "user_id", "event_type", "ts", "value")
    return ranking.top_per_key(e, ["user_id", "event_type"], [F.desc("ts"), F.desc("event_id")])


def win_surrogate_key(spark, sf):
    return star.dim_location(silver_table(spark, sf), NATION_REGIONS)


def dim_date(spark, sf):
    return star.dim_date(silver_table(spark, sf))


def dim_condition(spark, sf):
    return star.dim_condition(silver_table(spark, sf))


def win_longest_increasing_run(spark, sf):
    e = b.table(spark, sf, "events").select(
        "event_type", "event_id", F.get_json_object("props", "$.k").cast("int").alias("k"))
    return ranking.longest_increasing_run(e, ["event_type"], "event_id", "k")


def win_dedup_keep_first(spark, sf):
    arrivals = b.table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("date"), "o_totalprice")
    return extract.first_seen(arrivals, ["o_custkey", "date"], ["o_orderkey"])


def win_label_encode(spark, sf):
    return ranking.label_encode(
        b.reports(spark, sf).select("id", "weather_code", "condition"), "condition",
        "condition_encoded", "unknown")


# ---- sorts and top-k ---------------------------------------------------------------------------

def sort_by_day(spark, sf):
    return sort_chronological(silver_table(spark, sf).select("date", "governorate", "avg_max_temp"))


def split_chronological(spark, sf):
    marked = mark_split(silver_table(spark, sf).select("id", "date", "governorate"))
    return marked.select("id", "is_train")


def topk_context(spark, sf):
    r = b.reports(spark, sf).select("governorate", "date", "avg_max_temp", "avg_min_temp", "avg_humidity")
    return ranking.top_per_key(r, ["date"], retrieval.first_row_order(r), 5, rank="position")


def limit_top1(spark, sf):
    return b.revisions(spark, sf).orderBy(
        F.desc("revision_timestamp"), F.asc("user"), F.asc("comment")).limit(1)


# ---- set operations ----------------------------------------------------------------------------

def union_by_name(spark, sf):
    m = plain(b.merged(spark, sf)).select("id", "governorate", "date", "avg_max_temp", "condition")
    r = b.reports(spark, sf).select("id", "date", "governorate", "avg_max_temp", "source")
    return columns.union_all([m, r])


def union_all_concat(spark, sf):
    g = b.calendar(spark, sf).select("governorate", "weather_date", F.col("high_temp_c").alias("temp"))
    e = b.archive(spark, sf).select("governorate", "weather_date", F.col("max_temp").alias("temp"))
    return plain(columns.union_all([g, e]))


def unpivot_months(spark, sf):
    return normals.unpivot_months(b.normals(spark, sf))


def dedup_rows(spark, sf):
    return cleaning.dedup_rows(b.reports(spark, sf), b.SOURCE_ORDER)


QUERIES = {
    "standardize_columns": standardize_columns, "synth_id": synth_id, "default_columns": default_columns,
    "rename_positional": rename_positional, "reorder_priority": reorder_priority,
    "drop_if_present": drop_if_present, "cast_timestamp": cast_timestamp,
    "normalize_forecast": normalize_forecast, "ml_ready": ml_ready,
    "drop_null_core": drop_null_core, "filter_plausible": filter_plausible,
    "filter_date_not_null": filter_date_not_null, "filter_valid_day": filter_valid_day,
    "point_lookup": point_lookup, "filter_optional": filter_optional,
    "join_full_outer_merge": join_full_outer_merge, "join_aliased_merge": join_aliased_merge, "join_asof_backward": join_asof_backward,
    "join_lateral_top1": join_lateral_top1, "join_month_normals": join_month_normals,
    "join_star_dims": join_star_dims, "join_anti_loaded": join_anti_loaded,
    "join_cross_plan": join_cross_plan, "join_region_map": join_region_map,
    "join_nearest_date": join_nearest_date,
    "agg_column_means": agg_column_means, "agg_mean_features": agg_mean_features,
    "agg_null_counts": agg_null_counts, "agg_row_audit": agg_row_audit, "agg_date_range": agg_date_range,
    "agg_argmax_hottest": agg_argmax_hottest, "agg_distinct_sorted": agg_distinct_sorted,
    "agg_distinct": agg_distinct, "agg_row_mean_nullaware": agg_row_mean_nullaware,
    "agg_row_range": agg_row_range, "agg_row_std": agg_row_std,
    "win_latest_per_key": win_latest_per_key, "win_surrogate_key": win_surrogate_key,
    "dim_date": dim_date, "dim_condition": dim_condition,
    "win_longest_increasing_run": win_longest_increasing_run,
    "win_dedup_keep_first": win_dedup_keep_first, "win_label_encode": win_label_encode,
    "sort_chronological": sort_by_day, "split_chronological": split_chronological,
    "topk_context": topk_context, "limit_top1": limit_top1,
    "union_by_name": union_by_name, "union_all_concat": union_all_concat,
    "unpivot_months": unpivot_months, "dedup_rows": dedup_rows,
}

HEAT_CASE = """CASE WHEN avg_max_temp >= 45 THEN 'extreme' WHEN avg_max_temp >= 35 THEN 'high'
  WHEN avg_max_temp >= 25 THEN 'moderate' ELSE 'low' END"""
SEASON_CASE = """CASE WHEN month(date) IN (12, 1, 2) THEN 'winter' WHEN month(date) IN (3, 4, 5) THEN 'spring'
  WHEN month(date) IN (6, 7, 8) THEN 'summer' ELSE 'autumn' END"""
MONTHLY = """SELECT governorate, weather_date AS date, CAST(year(weather_date) AS INTEGER) AS year,
  CAST(month(weather_date) AS INTEGER) AS month, CAST(weather_code AS DOUBLE) AS weather_code, max_temp, min_temp,
  avg_humidity, source FROM archive"""

SQL = {
    "standardize_columns": with_views("""SELECT governorate, date, weather_code, avg_max_temp, avg_min_temp,
  avg_humidity, source, id, 'weather_data' AS condition FROM reports""", "reports"),
    "synth_id": with_views("""SELECT coalesce(governorate, 'NA') || '_' || strftime(weather_date, '%Y-%m-%d') AS id,
  weather_code FROM archive""", "archive"),
    "default_columns": with_views("""SELECT id, avg_max_temp, avg_min_temp, source, 'weather_data' AS condition,
  0.0::DOUBLE AS avg_humidity, avg_max_temp - avg_min_temp AS temp_range FROM reports""", "reports"),
    "rename_positional": with_views("""SELECT CAST(date AS VARCHAR) AS "Column_0", CAST(weather_code AS VARCHAR) AS "Column_1",
  CAST(avg_max_temp AS VARCHAR) AS "Column_2", CAST(avg_min_temp AS VARCHAR) AS "Column_3",
  CAST(avg_humidity AS VARCHAR) AS "Column_4" FROM reports""", "reports"),
    "reorder_priority": with_views("""SELECT governorate, date, avg_max_temp,
  * EXCLUDE (governorate, date, avg_max_temp) FROM merged""", "merged"),
    "drop_if_present": with_views("SELECT * EXCLUDE (weather_code, high_temp_c, low_temp_c) FROM merged", "merged"),
    "cast_timestamp": """SELECT event_id, CASE WHEN event_type <> 'signup' THEN ts END AS revision_timestamp FROM events""",
    "normalize_forecast": with_views("""SELECT governorate, weather_date AS date, max_temp AS predicted_max_temp,
  min_temp AS predicted_min_temp, max_temp AS avg_max_temp, min_temp AS avg_min_temp, 0.0::DOUBLE AS avg_humidity,
  max_temp - min_temp AS temp_range, 'moderate' AS heat_level, 'forecast' AS season FROM archive""", "archive"),
    "ml_ready": with_views(f"""SELECT id, governorate, date, CAST(year(date) AS INTEGER) AS year,
  CAST(month(date) AS INTEGER) AS month, CAST(day(date) AS INTEGER) AS day, {SEASON_CASE} AS season, avg_max_temp,
  avg_min_temp, avg_humidity, round(avg_max_temp - avg_min_temp, 2) AS temp_range, {HEAT_CASE} AS heat_level,
  condition, std_max_temp, std_min_temp FROM silver""", "silver"),
    "drop_null_core": with_views("""SELECT * FROM reports WHERE governorate IS NOT NULL AND date IS NOT NULL
  AND avg_max_temp IS NOT NULL AND avg_min_temp IS NOT NULL AND avg_humidity IS NOT NULL""", "reports"),
    "filter_plausible": with_views("""SELECT * FROM reports WHERE avg_max_temp BETWEEN -10 AND 60
  AND avg_min_temp BETWEEN -10 AND 60 AND avg_humidity BETWEEN 0 AND 100""", "reports"),
    "filter_date_not_null": """SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS date FROM lineitem
  WHERE l_linenumber <> 7""",
    "filter_valid_day": """SELECT * FROM (SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year,
  CAST(month(o_orderdate) AS INTEGER) AS month,
  CAST(day(o_orderdate) + CASE WHEN o_orderstatus = 'P' THEN 3 ELSE 0 END AS INTEGER) AS day FROM orders)
WHERE day BETWEEN 1 AND day(last_day(make_date(year, month, 1)))""",
    "point_lookup": with_views(f"""SELECT * FROM serving WHERE governorate = 'NATION_7' AND date = DATE '{b.TODAY}'""", "serving"),
    "filter_optional": with_views("""SELECT d.asked_place, s.* FROM
  (SELECT DISTINCT asked_place, coalesce(asked_date, default_date) AS day FROM defaulted) d JOIN serving s
  ON s.date = d.day AND (d.asked_place IS NULL OR d.asked_place = s.governorate)""",
  "defaulted"),
    "join_full_outer_merge": with_views("SELECT * FROM merged", "merged"),
    "join_aliased_merge": with_views("SELECT * FROM merged", "merged"),
    "join_asof_backward": with_views("""SELECT e.event_id, e.user_id, CAST(e.ts AS DATE) AS date, r.revision_timestamp, r."user", r.comment
FROM events e LEFT JOIN LATERAL (SELECT * FROM revisions v WHERE CAST(v.revision_timestamp AS DATE) <= CAST(e.ts AS DATE)
  ORDER BY v.revision_timestamp DESC, v."user", v.comment LIMIT 1) r ON TRUE""", "revisions"),
    "join_lateral_top1": with_views("""SELECT l.id, l.governorate, l.date, l.avg_max_temp, r.revision_timestamp, r."user", r.comment
FROM reports l LEFT JOIN (SELECT d.date, v.* FROM (SELECT DISTINCT date FROM reports) d JOIN LATERAL (
  SELECT * FROM order_revisions v WHERE CAST(v.revision_timestamp AS DATE) <= d.date
  ORDER BY v.revision_timestamp DESC, v."user", v.comment LIMIT 1) v ON TRUE) r ON r.date = l.date""",
  "reports", "order_revisions"),
    "join_month_normals": with_views("""SELECT governorate, weather_date AS date, max_temp, metric_name,
  value AS climate_normal_value FROM archive JOIN normals_long ON month(weather_date) = month_num""",
  "archive", "normals_long"),
    "join_star_dims": with_views(f"""SELECT s.id, l.location_id, d.date_id, c.condition_id, s.avg_max_temp, s.avg_min_temp,
  s.avg_humidity, round(s.avg_max_temp - s.avg_min_temp, 2) AS temp_range, {HEAT_CASE} AS heat_level
FROM silver s LEFT JOIN dim_location l ON s.governorate = l.governorate LEFT JOIN dim_date d ON s.date = d.date
LEFT JOIN dim_condition c ON s.condition = c.condition""", "silver", "dim_location", "dim_date", "dim_condition"),
    "join_anti_loaded": with_views(f"""SELECT * FROM ({MONTHLY}) m WHERE NOT EXISTS (SELECT 1 FROM orders
  WHERE o_orderstatus = 'P' AND month(o_orderdate) < 7 AND year(o_orderdate) = m.year AND month(o_orderdate) = m.month)""",
  "archive"),
    "join_cross_plan": f"""SELECT s_name AS city, CAST(year(DATE '{b.TODAY}') AS INTEGER) AS year, CAST(m AS INTEGER) AS month
FROM supplier, range(1, month(DATE '{b.TODAY}')) r(m)""",
    "join_region_map": with_views(f"""SELECT governorate, weather_date,
  CASE governorate {REGION_CASE} ELSE 'Unknown' END AS region FROM archive""", "archive"),
    "join_nearest_date": with_views("""SELECT question_id, asked_date, nearest_date FROM asked JOIN nearest USING (asked_date)""",
  "asked", "nearest"),
    "agg_column_means": with_views("""SELECT round(avg(std_max_temp), 6) AS std_max_temp,
  round(avg(std_min_temp), 6) AS std_min_temp FROM valid""", "valid"),
    "agg_mean_features": with_views("""SELECT round(avg(round(avg_max_temp - avg_min_temp, 2)), 6) AS temp_range,
  round(avg(std_min_temp), 6) AS std_min_temp, round(avg(std_max_temp), 6) AS std_max_temp FROM reports""", "reports"),
    "agg_null_counts": with_views("SELECT " + ", ".join(
        f"count(*) - count({c}) AS {c}" for c in ["id", "governorate", "date", "weather_code", "condition", "source",
        "avg_max_temp", "avg_min_temp", "avg_humidity", "std_max_temp", "std_min_temp"]) + " FROM reports", "reports"),
    "agg_row_audit": with_views("""SELECT (SELECT count(*) FROM reports) AS rows_before,
  (SELECT count(*) FROM deduped) AS rows_after_dedup, (SELECT count(*) FROM with_core) AS rows_after_null_drop,
  (SELECT count(*) FROM valid) AS rows_after_range_filter""", "valid"),
    "agg_date_range": with_views("SELECT min(date) AS first_date, max(date) AS last_date FROM reports", "reports"),
    "agg_argmax_hottest": with_views("""SELECT * FROM serving ORDER BY avg_max_temp DESC, date, governorate LIMIT 1""", "serving"),
    "agg_distinct_sorted": with_views("SELECT DISTINCT governorate FROM reports ORDER BY governorate", "reports"),
    "agg_distinct": with_views("SELECT DISTINCT governorate, condition FROM reports", "reports"),
    "agg_row_mean_nullaware": with_views("SELECT id, avg_max_temp, avg_min_temp FROM merged", "merged"),
    "agg_row_range": with_views("SELECT id, range_max_temp, range_min_temp FROM merged", "merged"),
    "agg_row_std": with_views("SELECT id, std_max_temp, std_min_temp FROM merged", "merged"),
    "win_latest_per_key": """SELECT event_id, user_id, event_type, ts, value FROM (SELECT *, row_number() OVER (
  PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""",
    "win_surrogate_key": with_views("SELECT * FROM dim_location", "dim_location"),
    "dim_date": with_views("SELECT * FROM dim_date", "dim_date"),
    "dim_condition": with_views("SELECT * FROM dim_condition", "dim_condition"),
    "win_longest_increasing_run": """WITH s AS (SELECT event_type, event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events),
m AS (SELECT *, CASE WHEN k <= lag(k) OVER (PARTITION BY event_type ORDER BY event_id) THEN 1 ELSE 0 END AS brk FROM s),
r AS (SELECT *, sum(brk) OVER (PARTITION BY event_type ORDER BY event_id) AS run FROM m),
g AS (SELECT event_type, run, min(event_id) AS run_start, max(event_id) AS run_end, count(*) AS run_length FROM r GROUP BY event_type, run)
SELECT event_type, run_start, run_end, run_length FROM (SELECT *, row_number() OVER (PARTITION BY event_type
  ORDER BY run_length DESC, run_start) AS rn FROM g) WHERE rn = 1""",
    "win_dedup_keep_first": """SELECT o_orderkey, o_custkey, date, o_totalprice FROM (SELECT o_orderkey, o_custkey,
  CAST(o_orderdate AS DATE) AS date, o_totalprice, row_number() OVER (PARTITION BY o_custkey, CAST(o_orderdate AS DATE)
  ORDER BY o_orderkey) AS rn FROM orders) WHERE rn = 1""",
    "win_label_encode": with_views("""SELECT id, weather_code, condition,
  CAST(dense_rank() OVER (ORDER BY coalesce(condition, 'unknown')) - 1 AS INTEGER) AS condition_encoded FROM reports""", "reports"),
    "sort_chronological": with_views("SELECT date, governorate, avg_max_temp FROM silver ORDER BY date, governorate", "silver"),
    "split_chronological": with_views("""SELECT id, row_number() OVER (ORDER BY date, governorate)
  <= (SELECT count(*) - CAST(ceil(count(*) * 0.2) AS BIGINT) FROM silver) AS is_train FROM silver""", "silver"),
    "topk_context": with_views("""SELECT governorate, date, avg_max_temp, avg_min_temp, avg_humidity, CAST(rn AS INTEGER) AS position
FROM (SELECT *, row_number() OVER (PARTITION BY date ORDER BY governorate, avg_max_temp DESC NULLS LAST,
  avg_min_temp DESC NULLS LAST, avg_humidity DESC NULLS LAST) AS rn FROM reports) WHERE rn <= 5""", "reports"),
    "limit_top1": with_views("""SELECT * FROM revisions ORDER BY revision_timestamp DESC, "user", comment LIMIT 1""", "revisions"),
    "union_by_name": with_views("""SELECT id, governorate, date, avg_max_temp, condition, NULL::VARCHAR AS source FROM merged
UNION ALL SELECT id, governorate, date, avg_max_temp, NULL::VARCHAR, source FROM reports""", "merged", "reports"),
    "union_all_concat": with_views("""SELECT governorate, weather_date, high_temp_c AS temp FROM calendar
UNION ALL SELECT governorate, weather_date, max_temp FROM archive""", "calendar", "archive"),
    "unpivot_months": with_views("SELECT metric_name, month_num, value FROM normals_long", "normals_long"),
    "dedup_rows": with_views("SELECT * FROM deduped", "deduped"),
}
