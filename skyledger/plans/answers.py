"""Registered queries: places in text, contexts for questions, suggestions."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyledger.operators import retrieval
from skyledger.plans import bindings as b
from skyledger.plans.bindings import with_views
from skyledger.storage import staged


def serving_table(spark, sf):
    """The table questions are answered from, as a stage table: several steps read it."""
    return staged(b.serving(spark, sf), "serving")


def question_table(spark, sf):
    return staged(b.questions(spark, sf), "questions")


def fn_extract_place(spark, sf):
    return retrieval.places_in_text(question_table(spark, sf), serving_table(spark, sf).select("governorate")).select(
        "question_id", "asked_place")


def fn_format_context(spark, sf):
    return retrieval.format_context(serving_table(spark, sf), ["date"])


def retrieve_context(spark, sf):
    return retrieval.retrieve_context(question_table(spark, sf), serving_table(spark, sf), b.today())


def fn_format_suggestions(spark, sf):
    return retrieval.suggestions(serving_table(spark, sf)).select(F.explode("suggestions").alias("suggestion"))


QUERIES = {
    "fn_extract_place": fn_extract_place, "fn_format_context": fn_format_context,
    "retrieve_context": retrieve_context, "fn_format_suggestions": fn_format_suggestions,
}

LINE = """'- ' || governorate || ' on ' || CAST(date AS VARCHAR) || ': Max ' || CAST(avg_max_temp AS VARCHAR) || '°C, Min '
  || CAST(avg_min_temp AS VARCHAR) || '°C, Humidity ' || CAST(avg_humidity AS VARCHAR) || '%, Temp Range '
  || CAST(temp_range AS VARCHAR) || '°C, Heat Level: ' || heat_level || ', Season: ' || season"""
FIRST_LINES = f"""first_lines AS (SELECT date, string_agg(line, chr(10) ORDER BY governorate) AS context FROM (
  SELECT date, governorate, {LINE} AS line, row_number() OVER (PARTITION BY date ORDER BY governorate) AS rn FROM serving)
  WHERE rn <= 5 GROUP BY date)"""

SQL = {
    "fn_extract_place": with_views("SELECT question_id, asked_place FROM asked", "asked"),
    "fn_format_context": with_views(f", {FIRST_LINES} SELECT date, context FROM first_lines", "serving"),
    "retrieve_context": with_views(f""", {FIRST_LINES},
exact AS (SELECT d.*, EXISTS (SELECT 1 FROM serving s WHERE s.date = d.asked_date
    AND (d.asked_place IS NULL OR d.asked_place = s.governorate)) AS hit, n.nearest_date
  FROM defaulted d LEFT JOIN nearest n ON n.asked_date = d.asked_date),
used AS (SELECT *, CASE WHEN asked_date IS NULL THEN default_date WHEN hit THEN asked_date ELSE nearest_date END AS day FROM exact),
found AS (SELECT u.*, CASE WHEN asked_place IS NULL THEN f.context ELSE c.line END AS context
  FROM used u LEFT JOIN first_lines f ON f.date = u.day
  LEFT JOIN (SELECT governorate, date, {LINE} AS line FROM serving) c ON c.governorate = u.asked_place AND c.date = u.day)
SELECT question_id, coalesce(context, 'No matching data found for your query.') AS context,
  concat_ws(' | ', 'Date: ' || CAST(asked_date AS VARCHAR), 'Governorate: ' || asked_place,
    CASE WHEN asked_date IS NULL AND asked_place IS NULL THEN 'Latest available date: ' || CAST(default_date AS VARCHAR)
         WHEN asked_date IS NULL THEN 'Latest date for ' || asked_place || ': ' || CAST(default_date AS VARCHAR)
         WHEN NOT hit THEN 'Closest available date: ' || CAST(nearest_date AS VARCHAR) || ' (requested: ' || CAST(asked_date AS VARCHAR) || ')' END) AS trace
FROM found""", "defaulted", "nearest"),
    "fn_format_suggestions": with_views("""SELECT unnest([
  'What are the weather conditions in Cairo on ' || CAST((SELECT max(date) FROM serving) AS VARCHAR) || '? Give me health advice.',
  'The hottest recorded day was ' || CAST(date AS VARCHAR) || ' in ' || governorate || ' (' || CAST(avg_max_temp AS VARCHAR)
    || '°C). What precautions should I take?',
  'Compare weather between Alexandria and Cairo on ' || CAST((SELECT max(date) FROM serving) AS VARCHAR) || '.']) AS suggestion
FROM (SELECT * FROM serving ORDER BY avg_max_temp DESC, date, governorate LIMIT 1)""", "serving"),
}
