"""Registered queries: column functions, one query per function, over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyledger.functions import calendar, text, weather
from skyledger.operators import cleaning, columns, normals
from skyledger.plans import bindings as b
from skyledger.plans.bindings import with_views
from skyledger.plans.relational import HEAT_CASE, SEASON_CASE, valid_reports
from skyledger.schemas import MEAN_FILLED

LINE = ["l_orderkey", "l_linenumber"]


def fn_temp_range(spark, sf):
    return b.reports(spark, sf).select(
        "id", weather.temp_range(F.col("avg_max_temp"), F.col("avg_min_temp")).alias("temp_range"))


def fn_heat_level(spark, sf):
    m = b.merged(spark, sf).select("id", F.when(F.col("condition") != "5-LOW", F.col("avg_max_temp")).alias("high"))
    return m.select("id", weather.heat_level(F.col("high")).alias("heat_level"))


def fn_season(spark, sf):
    return b.table(spark, sf, "orders").select(
        "o_orderkey", weather.season(F.month("o_orderdate")).alias("season"))


def fn_is_weekend(spark, sf):
    return b.table(spark, sf, "orders").select(
        "o_orderkey", weather.is_weekend(F.col("o_orderdate").cast("date")).alias("is_weekend"))


def fn_date_parts(spark, sf):
    parts = weather.date_parts(F.col("l_shipdate").cast("date"))
    return b.table(spark, sf, "lineitem").select(*LINE, *[c.alias(n) for n, c in parts.items()])


def fn_fill_numeric_mean(spark, sf):
    valid = valid_reports(spark, sf)
    return cleaning.fill_with_means(valid, cleaning.column_means(valid, MEAN_FILLED)).select(
        "id", "std_max_temp", "std_min_temp")


def fn_fill_text(spark, sf):
    return cleaning.fill_text(b.reports(spark, sf)).select("id", "weather_code", "condition", "source")


def dirty_numbers(spark, sf):
    lines = b.table(spark, sf, "lineitem")
    dirty = F.when(F.col("l_linenumber") == 7, F.lit("invalid")).otherwise(F.col("l_extendedprice").cast("string"))
    return lines.select(*LINE, dirty.alias("max_temp"), F.col("l_quantity").cast("string").alias("temp_range"))


def fn_coerce_numeric(spark, sf):
    return columns.coerce_numeric(dirty_numbers(spark, sf), ["temp_range", "max_temp", "absent"])


def fn_coerce_date(spark, sf):
    dirty = F.when(F.col("l_linenumber") == 7, F.lit("31/31/1998")).when(
        F.col("l_linenumber") == 6, F.lit("1998-02-30")).otherwise(
        F.date_format("l_shipdate", "yyyy-MM-dd"))
    return b.table(spark, sf, "lineitem").select(*LINE, weather.to_day(dirty).alias("date"))


def fn_split_id(spark, sf):
    place, day = weather.split_id(F.col("id"))
    return b.reports(spark, sf).select("id", place.alias("city"), day.alias("day_text"))


def fn_f_to_c(spark, sf):
    degrees = F.floor(F.col("l_extendedprice") / 700 - 40).cast("string")
    shown = F.when(F.col("l_linenumber") == 7, F.lit("no reading")).otherwise(F.concat(F.lit("about "), degrees, F.lit(" F")))
    return b.table(spark, sf, "lineitem").select(*LINE, weather.fahrenheit_to_celsius(shown).alias("celsius"))


def fn_extract_int(spark, sf):
    return b.table(spark, sf, "part").select(
        "p_partkey", weather.first_small_number(F.col("p_brand")).alias("number"),
        weather.first_small_number(F.col("p_type")).alias("none"))


def fn_month_calendar(spark, sf):
    months = calendar.months_to_collect(F.col("o_orderdate").cast("date"))
    return b.table(spark, sf, "orders").select("o_orderkey", F.explode(months).alias("first_day"))


def fn_month_bounds(spark, sf):
    year, month = F.year("o_orderdate"), F.month("o_orderdate")
    first, last = calendar.month_bounds(year, month)
    request = calendar.archive_request(F.col("o_custkey"), F.col("o_orderkey"), year, month)
    return b.table(spark, sf, "orders").select(
        "o_orderkey", first.alias("first_day"), last.alias("last_day"), request.alias("request"))


def fn_extract_date(spark, sf):
    return b.questions(spark, sf).select(
        "question_id", text.date_in_text(F.col("question"), b.today()).alias("asked_date"))


def fn_parse_normal(spark, sf):
    return normals.unpivot_months(b.normals(spark, sf)).select(
        "metric_name", "month_num", weather.climate_value(F.col("value")).alias("value"))


QUERIES = {
    "fn_temp_range": fn_temp_range, "fn_heat_level": fn_heat_level, "fn_season": fn_season,
    "fn_is_weekend": fn_is_weekend, "fn_date_parts": fn_date_parts,
    "fn_fill_numeric_mean": fn_fill_numeric_mean, "fn_fill_text": fn_fill_text,
    "fn_coerce_numeric": fn_coerce_numeric, "fn_coerce_date": fn_coerce_date, "fn_split_id": fn_split_id,
    "fn_f_to_c": fn_f_to_c, "fn_extract_int": fn_extract_int, "fn_month_calendar": fn_month_calendar,
    "fn_month_bounds": fn_month_bounds, "fn_extract_date": fn_extract_date, "fn_parse_normal": fn_parse_normal,
}

SQL = {
    "fn_temp_range": with_views("SELECT id, round(avg_max_temp - avg_min_temp, 2) AS temp_range FROM reports", "reports"),
    "fn_heat_level": with_views(f"""SELECT id, {HEAT_CASE} AS heat_level FROM (SELECT id,
  CASE WHEN condition <> '5-LOW' THEN avg_max_temp END AS avg_max_temp FROM merged)""", "merged"),
    "fn_season": f"SELECT o_orderkey, {SEASON_CASE} AS season FROM (SELECT o_orderkey, o_orderdate AS date FROM orders)",
    "fn_is_weekend": "SELECT o_orderkey, dayofweek(o_orderdate) IN (5, 6) AS is_weekend FROM orders",
    "fn_date_parts": """SELECT l_orderkey, l_linenumber, CAST(year(l_shipdate) AS INTEGER) AS year,
  CAST(month(l_shipdate) AS INTEGER) AS month, CAST(day(l_shipdate) AS INTEGER) AS day,
  CAST(dayofyear(l_shipdate) AS INTEGER) AS day_of_year FROM lineitem""",
    "fn_fill_numeric_mean": with_views("SELECT id, std_max_temp, std_min_temp FROM silver", "silver"),
    "fn_fill_text": with_views("""SELECT id, weather_code, coalesce(condition, 'unknown') AS condition,
  coalesce(source, 'unknown') AS source FROM reports""", "reports"),
    "fn_coerce_numeric": """SELECT l_orderkey, l_linenumber, l_quantity AS temp_range,
  CASE WHEN l_linenumber <> 7 THEN l_extendedprice END AS max_temp FROM lineitem""",
    "fn_coerce_date": """SELECT l_orderkey, l_linenumber, TRY_CAST(CASE l_linenumber WHEN 7 THEN '31/31/1998'
  WHEN 6 THEN '1998-02-30' ELSE strftime(l_shipdate, '%Y-%m-%d') END AS DATE) AS date FROM lineitem""",
    "fn_split_id": with_views("""SELECT id, split_part(id, '_', 1) AS city, split_part(id, '_', -1) AS day_text FROM reports""", "reports"),
    "fn_f_to_c": """SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber <> 7 THEN
  round((CAST(floor(l_extendedprice / 700 - 40) AS INTEGER) - 32) * 5 / 9::DOUBLE, 1) END AS celsius FROM lineitem""",
    "fn_extract_int": r"""SELECT p_partkey, TRY_CAST(regexp_extract(p_brand, '\d{1,2}') AS INTEGER) AS number,
  TRY_CAST(regexp_extract(p_type, '\d{1,2}') AS INTEGER) AS none FROM part""",
    "fn_month_calendar": """WITH d AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS t FROM orders),
l AS (SELECT o_orderkey, CASE WHEN t = last_day(t) THEN t ELSE CAST(date_trunc('month', t) AS DATE) - 1 END AS x FROM d)
SELECT o_orderkey, make_date(year(x), m, 1) AS first_day FROM l, range(1, 13) r(m) WHERE m <= month(x)""",
    "fn_month_bounds": f"""SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS first_day,
  last_day(o_orderdate) AS last_day, '{calendar.ARCHIVE_BASE}?latitude=' || o_custkey || '&longitude=' || o_orderkey
  || '&start_date=' || strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') || '&end_date='
  || strftime(last_day(o_orderdate), '%Y-%m-%d') || '{calendar.ARCHIVE_OPTIONS}' AS request FROM orders""",
    "fn_extract_date": with_views("SELECT question_id, asked_date FROM dated", "dated"),
    "fn_parse_normal": with_views("""SELECT metric_name, month_num,
  TRY_CAST(split_part(value, '(', 1) AS DOUBLE) AS value FROM normals_long""", "normals_long"),
}
