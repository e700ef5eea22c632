"""Registered queries: sources, sinks, payload extraction, streaming.

Each one writes a view of the given tables in the format under test to a fresh place in the shared
folder, and reads it back through the operator.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from skyledger.operators import asof, extract
from skyledger.plans import bindings as b
from skyledger.plans.bindings import plain, with_views
from skyledger.plans.relational import MONTHLY, monthly, raw_reports
from skyledger.schemas import ARCHIVE_STAGING, MONTHLY as MONTHLY_DDL, REVISIONS
from skyledger.sources import readers, writers
from skyledger.storage import fresh_path, staged
from skyledger.streaming.months import load_months, watch_months

BOM = "﻿"


# ---- sources -----------------------------------------------------------------------------------

def scan_csv_history(spark, sf):
    path = fresh_path(spark, "history")
    raw_reports(spark, sf).write.option("header", True).csv(path)
    return readers.read_text_csv(spark, path)


def scan_csv_many(spark, sf):
    history, current = fresh_path(spark, "history"), fresh_path(spark, "current")
    raw = raw_reports(spark, sf)
    recent = F.col("Date") >= "2000-01-01"
    raw.where(~recent).write.option("header", True).csv(history)
    with_month = raw.where(recent).select(
        "Governorate", "Date", F.substring("Date", 1, 4).alias("Year"),
        F.substring("Date", 6, 2).alias("Month"), "Weather_Code", "Max_Temp", "Min_Temp",
        "Avg_Humidity", "Source")
    # collectors of two times: the later one writes the columns in another order
    late = F.col("Year") >= "2001"
    with_month.where(~late).write.option("header", True).csv(current)
    turned = with_month.where(late).select("Source", "Min_Temp", "Max_Temp", "Year", "Month", "Date", "Avg_Humidity", "Weather_Code", "Governorate")
    turned.write.mode("append").option("header", True).csv(current)
    return readers.read_weather_csvs(spark, [(history, "*.csv"), (current, "*.csv")])


def scan_csv_typed(spark, sf):
    path = fresh_path(spark, "staging")
    b.archive(spark, sf).write.option("header", True).csv(path)
    return plain(readers.read_typed_csv(spark, path, ARCHIVE_STAGING))


def scan_first_available(spark, sf):
    missing = fresh_path(spark, "missing")
    return readers.read_available([
        lambda: spark.read.parquet(missing),
        lambda: plain(b.merged(spark, sf)).select("id", "governorate", "date", "weather_code",
                                                  "condition", "avg_max_temp", "avg_min_temp", "avg_humidity"),
        lambda: plain(b.archive(spark, sf)).withColumnRenamed("weather_date", "date"),
    ])


def scan_empty_typed(spark, sf):
    missing = fresh_path(spark, "missing")
    log = readers.read_optional(spark, lambda: spark.read.parquet(missing), REVISIONS)
    left = b.table(spark, sf, "events").select("event_id", F.col("ts").cast("date").alias("date"))
    return asof.asof_backward(left, log.drop("source")).select("event_id", "date", "user", "comment")


def scan_parquet(spark, sf):
    lines = readers.read_parquet(spark, f"{sf}/lineitem.parquet",
                                 ["l_orderkey", "l_linenumber", "l_quantity", "l_shipdate"])
    return lines.withColumn("l_shipdate", F.col("l_shipdate").cast("date"))


def scan_text_csv_bom(spark, sf):
    """Raw revision CSV with a byte-order mark, quotes and line breaks, rewritten without the mark."""
    raw, tidy = fresh_path(spark, "raw"), fresh_path(spark, "tidy")
    log = b.revisions(spark, sf).select(
        F.date_format("revision_timestamp", "yyyy-MM-dd HH:mm:ss").alias("t"), "user",
        F.concat(F.lit('said "hi", '), "comment", F.when(F.col("user") > "5", F.lit("\nmore")).otherwise(
            F.lit(""))).alias("comment"))
    log.toDF(f"{BOM}Timestamp", "User", "Comment").write.option("header", True).option("escape", '"').csv(raw)
    writers.write_clean_csv(readers.read_multiline_csv(spark, raw), tidy)
    return readers.read_multiline_csv(spark, tidy)


def archive_payloads(spark, sf):
    """Archive answers: one CSV text per (nation, month), at most 31 data lines each."""
    day = F.col("weather_date")
    line = F.concat_ws(
        ",", day.cast("string"), F.col("weather_code").cast("string"), F.col("max_temp").cast("string"),
        F.col("min_temp").cast("string"), F.coalesce(F.col("avg_humidity").cast("string"), F.lit("")))
    days = F.array_join(F.array_sort(F.collect_list(line)), "\n")
    head = F.lit("latitude,longitude\n30.0,31.0\n\ntime,weather_code,max,min,humidity\n")
    return b.archive(spark, sf).groupBy("governorate", F.year(day).alias("year"), F.month(day).alias("month")).agg(
        F.concat(head, days, F.lit("\n")).alias("payload"))


def parse_archive_payload(spark, sf):
    return extract.parse_archive_payload(archive_payloads(spark, sf))


def parse_revision_json(spark, sf):
    """One answer per event: a page with two revisions (the second without comment) and a bare page."""
    e = b.table(spark, sf, "events")
    user, time = F.col("user_id").cast("string"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    payload = F.concat(
        F.lit('{"query":{"pages":{"'), F.col("event_id").cast("string"),
        F.lit('":{"revisions":[{"timestamp":"'), time, F.lit('","user":"'), user, F.lit('","comment":"'),
        F.col("event_type"), F.lit('"},{"timestamp":"'), time, F.lit('","user":"'), user,
        F.lit('"}]},"-1":{"missing":""}}}}'))
    return extract.parse_revision_json(e.select(payload.alias("payload")))


def pages_with_table(spark, sf):
    """The given pages with a table of their own url and size in front of the article."""
    def text(c):
        return F.regexp_replace(F.regexp_replace(c, "&", "&amp;"), "<", "&lt;")

    row = F.concat(
        F.lit('<table class="wikitable sortable"><tr><th>Key</th><th>Value</th></tr><tr><th> url </th><td><a href="#">'),
        text("url"), F.lit("</a></td></tr><tr><td>size</td><td>\n<b>"), F.length("html").cast("string"),
        F.lit("</b> chars</td></tr></table><article>"))
    at = F.instr("html", "<article>")
    html = F.when(at > 0, F.concat(F.substring("html", F.lit(1), at - 1), row,
                                   F.substring("html", at + len("<article>"), F.length("html")))
                  ).otherwise(F.concat(row, "html"))
    return b.table(spark, sf, "pages").select("page_id", html.alias("html"))


def parse_html_table(spark, sf):
    return extract.table_columns(staged(extract.parse_html_table(pages_with_table(spark, sf)), "rows"))


def calendar_pages(spark, sf):
    """Calendar pages, one per (nation, month): observed days plus the edges of both neighbours.

    A cell of a neighbouring month carries that day's number; some cells lack the condition.
    """
    cells = b.calendar(spark, sf)
    day = F.col("weather_date")

    def cell(number, condition):
        return F.concat(
            F.lit('<li class="calendar-day x"><div class="date">'), number.cast("string"),
            F.lit("</div><div class='phrase'> "), condition, F.lit(' </div><span class="hi">'),
            F.col("high_temp_c").cast("int").cast("string"), F.lit('&deg; F</span>/<span class="low">-'),
            F.col("low_temp_c").cast("int").cast("string"), F.lit("&deg;</span></li>"))

    bare = F.concat(F.lit('<li class="calendar-day"><div class="date">'), F.dayofmonth(day).cast("string"),
                    F.lit("</div></li>"))
    shown = F.when(F.col("condition") == "5-LOW", bare).otherwise(cell(F.dayofmonth(day), F.col("condition")))
    body = F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct(day.alias("d"), shown.alias("h")))), lambda x: x["h"]), "")
    before = F.concat(*[
        F.lit(f'<li class="calendar-day"><div class="date">{n}</div><div class="phrase">Edge</div>'
              '<span class="hi">50</span><span class="low">40</span></li>') for n in (30, 31)])
    after = F.lit('<li class="calendar-day"><div class="date">1</div><div class="phrase">Edge</div>'
                  '<span class="hi">50</span><span class="low">40</span></li>')
    return (
        cells.groupBy("governorate", F.year(day).alias("year"), F.month(day).alias("month"))
        .agg(F.concat(F.lit("<html><ul>"), before, body, after, F.lit("</ul></html>")).alias("html"))
        .select(F.concat_ws("/", "governorate", F.col("year").cast("string"), F.col("month").cast("string")).alias("page_id"),
                "governorate", "year", "month", "html"))


def parse_calendar_cells(spark, sf):
    return extract.parse_calendar_cells(calendar_pages(spark, sf)).select(
        "page_id", "day", "condition", "high_c", "low_c")


def calendar_observations(spark, sf):
    return extract.calendar_observations(staged(calendar_pages(spark, sf), "pages"))


# ---- sinks -------------------------------------------------------------------------------------

def sink_parquet_overwrite(spark, sf):
    path = fresh_path(spark, "gold")
    observed = plain(b.archive(spark, sf))
    writers.overwrite_parquet(observed.where(F.col("weather_code") > 1), path)
    writers.overwrite_parquet(observed, path)
    return readers.read_parquet(spark, path)


def sink_csv_overwrite(spark, sf):
    path = fresh_path(spark, "forecast")
    writers.overwrite_csv(plain(b.archive(spark, sf)), path)
    return readers.read_text_csv(spark, path)


def sink_month_partition(spark, sf):
    """All months are written, then one of them again with other values; the rest stays."""
    path = fresh_path(spark, "months")
    rows = monthly(spark, sf)
    writers.replace_months(rows, path)
    again = rows.where((F.col("year") == 1998) & (F.col("month") == 7))
    writers.replace_months(again.withColumn("source", F.lit("corrected")), path)
    return spark.read.parquet(path)


def sink_create_table_as(spark, sf):
    path = fresh_path(spark, "table")
    name = f"t_{path.rsplit('-', 1)[1]}"
    writers.create_table_as(plain(b.archive(spark, sf)), name, path)
    return spark.table(name)


def sink_insert_select(spark, sf):
    path = fresh_path(spark, "history")
    name = f"t_{path.rsplit('-', 1)[1]}"
    log = b.revisions(spark, sf)
    writers.create_table_as(log.where(F.col("comment") < ""), name, path)
    writers.insert_select(log.withColumn("revision_timestamp", F.col("revision_timestamp").cast("string")), name)
    return spark.table(name)


def sink_append_new_months(spark, sf):
    """Half a load, then everything twice: each month arrives once."""
    path = fresh_path(spark, "loaded")
    rows = monthly(spark, sf)
    writers.append_new_months(rows.where(F.col("month") < 7), path)
    writers.append_new_months(rows.withColumn("source", F.lit("second")), path)
    writers.append_new_months(rows.withColumn("source", F.lit("third")), path)
    return spark.read.parquet(path)


# ---- streams -----------------------------------------------------------------------------------

def drop_month_files(df, folder, version):
    """CSV files of one drop, as collectors leave them: a month may be spread over several files."""
    names = {"Governorate": "governorate", "Date": "date", "Year": "year", "Month": "month",
             "Weather_Code": "weather_code", "Max_Temp": "max_temp", "Min_Temp": "min_temp",
             "Avg_Humidity": "avg_humidity", "Source": "source"}
    files = df.select(*[F.col(c).alias(n) for n, c in names.items()], F.col("year").alias("y"))
    files.repartition(3, "governorate").write.mode("append").option("header", True).partitionBy("y").csv(f"{folder}/drop={version}")


def stream_month_files(spark, sf):
    """Two runs over a growing folder; the second also finds known months again, which stay as they were."""
    folder, target, state = (fresh_path(spark, n) for n in ("drop", "target", "state"))
    rows = monthly(spark, sf)
    drops = (rows.where(F.col("year") < 1998), rows.where(F.col("year") >= 1997).withColumn("source", F.lit("second")))
    for version, batch in enumerate(drops):
        drop_month_files(batch, folder, version)
        load_months(watch_months(spark, folder, MONTHLY_DDL, max_files=10), target, state).awaitTermination()
    return writers.read_months(spark, target, "first")


def stream_upsert_month(spark, sf):
    """Two runs; months dropped again replace what was there."""
    folder, target, state = (fresh_path(spark, n) for n in ("drop", "target", "state"))
    rows = monthly(spark, sf)
    for version, batch in enumerate((rows, rows.where(F.col("year") == 1998).withColumn("source", F.lit("corrected")))):
        drop_month_files(batch, folder, version)
        load_months(watch_months(spark, folder, MONTHLY_DDL, max_files=10), target, state).awaitTermination()
    return writers.read_months(spark, target, "newest")


QUERIES = {
    "scan_csv_history": scan_csv_history, "scan_csv_many": scan_csv_many, "scan_csv_typed": scan_csv_typed,
    "scan_first_available": scan_first_available, "scan_empty_typed": scan_empty_typed,
    "scan_parquet": scan_parquet, "scan_text_csv_bom": scan_text_csv_bom,
    "parse_archive_payload": parse_archive_payload, "parse_revision_json": parse_revision_json,
    "parse_html_table": parse_html_table, "parse_calendar_cells": parse_calendar_cells,
    "calendar_observations": calendar_observations,
    "sink_parquet_overwrite": sink_parquet_overwrite, "sink_csv_overwrite": sink_csv_overwrite,
    "sink_month_partition": sink_month_partition, "sink_create_table_as": sink_create_table_as,
    "sink_insert_select": sink_insert_select, "sink_append_new_months": sink_append_new_months,
    "stream_month_files": stream_month_files, "stream_upsert_month": stream_upsert_month,
}

RAW_TEXT = """CAST(date AS VARCHAR) AS "Date", CAST(weather_code AS VARCHAR) AS "Weather_Code",
  CAST(avg_max_temp AS VARCHAR) AS "Max_Temp", CAST(avg_min_temp AS VARCHAR) AS "Min_Temp",
  CAST(avg_humidity AS VARCHAR) AS "Avg_Humidity", source AS "Source\""""
CELSIUS = "round((CAST({} AS INTEGER) - 32) * 5 / 9::DOUBLE, 1)"
CALENDAR_PAGES = """pages_of AS (SELECT governorate, year(weather_date) AS y, month(weather_date) AS m,
  count(*) FILTER (condition <> '5-LOW') AS shown FROM calendar GROUP BY ALL)"""

SQL = {
    "scan_csv_history": with_views(f"""SELECT governorate AS "Governorate", {RAW_TEXT} FROM reports""", "reports"),
    "scan_csv_many": with_views("""SELECT id, governorate, date, weather_code, avg_max_temp, avg_min_temp, avg_humidity,
  source, 'weather_data' AS condition, CASE WHEN date >= DATE '2000-01-01' THEN strftime(date, '%Y') END AS "Year",
  CASE WHEN date >= DATE '2000-01-01' THEN strftime(date, '%m') END AS "Month" FROM reports""", "reports"),
    "scan_csv_typed": with_views("SELECT * FROM archive", "archive"),
    "scan_first_available": with_views("""SELECT id, governorate, date, weather_code, condition, avg_max_temp, avg_min_temp,
  avg_humidity, 'unknown' AS source FROM merged
UNION ALL SELECT governorate || '_' || strftime(weather_date, '%Y-%m-%d'), governorate, weather_date, weather_code,
  'weather_data', max_temp, min_temp, avg_humidity, source FROM archive""", "merged"),
    "scan_empty_typed": """SELECT event_id, CAST(ts AS DATE) AS date, NULL::VARCHAR AS "user", NULL::VARCHAR AS comment FROM events""",
    "scan_parquet": "SELECT l_orderkey, l_linenumber, l_quantity, CAST(l_shipdate AS DATE) AS l_shipdate FROM lineitem",
    "scan_text_csv_bom": with_views("""SELECT strftime(revision_timestamp, '%Y-%m-%d %H:%M:%S') AS "Timestamp", "user" AS "User",
  'said "hi", ' || comment || CASE WHEN "user" > '5' THEN chr(10) || 'more' ELSE '' END AS "Comment" FROM revisions""", "revisions"),
    "parse_archive_payload": with_views(f"""SELECT governorate AS "Governorate", date AS "Date", year AS "Year", month AS "Month",
  weather_code AS "Weather_Code", max_temp AS "Max_Temp", min_temp AS "Min_Temp", avg_humidity AS "Avg_Humidity",
  '{extract.ARCHIVE_SOURCE}' AS "Source" FROM ({MONTHLY})""", "archive"),
    "parse_revision_json": f"""SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS timestamp, CAST(user_id AS VARCHAR) AS "user",
  CASE WHEN n = 0 THEN event_type ELSE '' END AS comment, '{extract.REVISION_SOURCE}' AS source FROM events, range(0, 2) r(n)""",
    "parse_html_table": f"""SELECT page_id, 1::INTEGER AS row_num, 'url' AS "Column_0", url AS "Column_1", '{extract.TABLE_SOURCE}' AS source
  FROM pages WHERE html IS NOT NULL
UNION ALL SELECT page_id, 2, 'size', CAST(length(html) AS VARCHAR) || ' chars', '{extract.TABLE_SOURCE}' FROM pages
  WHERE html IS NOT NULL""",
    "parse_calendar_cells": with_views(f""", {CALENDAR_PAGES}
SELECT governorate || '/' || y || '/' || m AS page_id, CAST(day(weather_date) AS INTEGER) AS day, condition,
  {CELSIUS.format('high_temp_c')} AS high_c, {CELSIUS.format('-low_temp_c')} AS low_c
FROM pages_of p JOIN calendar c USING (governorate)
WHERE year(weather_date) = y AND month(weather_date) = m AND condition <> '5-LOW'
UNION ALL SELECT governorate || '/' || y || '/' || m, d, 'Edge', 10.0::DOUBLE, 4.4::DOUBLE
FROM pages_of, (VALUES (30), (31), (1)) v(d)""", "calendar"),
    "calendar_observations": with_views(f""", {CALENDAR_PAGES}
SELECT governorate, condition, {CELSIUS.format('high_temp_c')} AS high_temp_c,
  {CELSIUS.format('-low_temp_c')} AS low_temp_c, weather_date AS date
FROM pages_of p JOIN calendar c USING (governorate)
WHERE year(weather_date) = y AND month(weather_date) = m AND condition <> '5-LOW' AND shown > 2
UNION ALL
-- with one or two days of its own, the two days before are the longest run of a page
SELECT governorate, 'Edge', 10.0::DOUBLE, 4.4::DOUBLE, make_date(y, m, d) FROM pages_of, (VALUES (30), (31)) v(d)
WHERE shown <= 2 AND d <= day(last_day(make_date(y, m, 1)))""", "calendar"),
    "sink_parquet_overwrite": with_views("SELECT * FROM archive", "archive"),
    "sink_csv_overwrite": with_views("""SELECT governorate, CAST(weather_date AS VARCHAR) AS weather_date,
  CAST(weather_code AS VARCHAR) AS weather_code, CAST(max_temp AS VARCHAR) AS max_temp, CAST(min_temp AS VARCHAR) AS min_temp,
  CAST(avg_humidity AS VARCHAR) AS avg_humidity, source FROM archive""", "archive"),
    "sink_month_partition": with_views(f"""SELECT * REPLACE (CASE WHEN year = 1998 AND month = 7 THEN 'corrected' ELSE source END AS source)
  FROM ({MONTHLY})""", "archive"),
    "sink_create_table_as": with_views("SELECT * FROM archive", "archive"),
    "sink_insert_select": with_views("SELECT * FROM revisions", "revisions"),
    "sink_append_new_months": with_views(f"""SELECT * REPLACE (CASE WHEN month < 7 THEN source ELSE 'second' END AS source)
  FROM ({MONTHLY})""", "archive"),
    "stream_month_files": with_views(f"""SELECT * REPLACE (CASE WHEN year < 1998 THEN source ELSE 'second' END AS source)
  FROM ({MONTHLY})""", "archive"),
    "stream_upsert_month": with_views(f"""SELECT * REPLACE (CASE WHEN year = 1998 THEN 'corrected' ELSE source END AS source)
  FROM ({MONTHLY})""", "archive"),
}
