"""Observation-shaped views over the given tables, in Spark and as SQL common table expressions.

The views are declarative: a query that needs two columns of one reads two columns of the files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.functions import weather
from skyledger.operators.merge import merge_sources
from skyledger.schemas import MONTHS

TODAY = "1998-07-15"
SOURCE_ORDER = ["archive", "calendar"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, so that both engines of a comparison print them alike."""
    return df.select(*[
        F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType)
        else F.col(f.name)
        for f in df.schema
    ])


def shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with the nation of their supplier.

    Joined one dimension after the other, largest table first, so that each join has a plain table
    on its small side whose size the optimizer knows.
    """
    return (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    )


def ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the nation of their customer."""
    return (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    )


def archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive-like observations: one row per (nation, ship day)."""
    count = F.count(F.lit(1))
    return (
        shipped(spark, sf_dir)
        .groupBy(F.col("n_name").alias("governorate"),
                 F.col("l_shipdate").cast("date").alias("weather_date"))
        .agg(
            count.cast("int").alias("weather_code"),
            F.max("l_quantity").cast("decimal(5,2)").alias("max_temp"),
            F.min("l_quantity").cast("decimal(5,2)").alias("min_temp"),
            F.when(count % 7 != 0, F.max("l_discount") * 1000).cast("decimal(5,2)").alias("avg_humidity"),
        )
        .withColumn("source", F.lit("archive"))
    )


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar-like observations: one row per (nation, order day)."""
    return (
        ordered(spark, sf_dir)
        .groupBy(F.col("n_name").alias("governorate"),
                 F.col("o_orderdate").cast("date").alias("weather_date"))
        .agg(
            F.min("o_orderpriority").alias("condition"),
            F.floor(F.max("o_totalprice") / 8000).cast("decimal(5,2)").alias("high_temp_c"),
            F.floor(F.min("o_totalprice") / 8000).cast("decimal(5,2)").alias("low_temp_c"),
        )
    )


def merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both sources. They are grouped on the join key, so the join needs no further shuffle."""
    return merge_sources(calendar(spark, sf_dir), archive(spark, sf_dir), keys_unique=True)


def reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row-level station reports, one per line item, in canonical columns.

    Stations are suppliers. Several reports can share a station and a day; some values are missing
    or implausible.
    """
    stations = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    # whole percents, so that sums and products below are exact in doubles
    tax, discount = F.rint(F.col("l_tax") * 100), F.rint(F.col("l_discount") * 100)
    quantity, line = F.col("l_quantity"), F.col("l_linenumber")
    place, day = F.col("s_name"), F.col("l_shipdate").cast("date")
    return (
        table(spark, sf_dir, "lineitem")
        .join(stations, F.col("l_suppkey") == F.col("s_suppkey"))
        .select(
            weather.observation_id(place, day).alias("id"),
            place.alias("governorate"),
            day.alias("date"),
            line.alias("weather_code"),
            F.when(F.col("l_returnflag") != "R", F.concat("l_returnflag", "l_linestatus")).alias("condition"),
            F.when(F.col("l_linestatus") == "F", F.lit("archive")).otherwise(F.lit("calendar")).alias("source"),
            (quantity + tax * 2).alias("avg_max_temp"),
            (quantity - discount * 2).alias("avg_min_temp"),
            F.when(line != 7, discount * 10).alias("avg_humidity"),
            F.when(~line.isin(2, 4), tax).alias("std_max_temp"),
            F.when(line != 3, discount).alias("std_min_temp"),
        )
    )


def serving(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What questions are answered from: one row per (nation, day) with derived classes."""
    high, low, day = F.col("max_temp").cast("double"), F.col("min_temp").cast("double"), F.col("weather_date")
    return archive(spark, sf_dir).select(
        "governorate",
        day.alias("date"),
        high.alias("avg_max_temp"),
        low.alias("avg_min_temp"),
        F.coalesce(F.col("avg_humidity").cast("double"), F.lit(0.0)).alias("avg_humidity"),
        weather.temp_range(high, low).alias("temp_range"),
        weather.heat_level(high).alias("heat_level"),
        weather.season(F.month(day)).alias("season"),
    )


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One question per order: with a date and a place, one of them, a relative day, or neither."""
    shift = F.when(F.col("o_orderstatus") == "P", F.lit(1200)).otherwise(F.lit(0))
    day = F.date_add(F.col("o_orderdate").cast("date"), shift)
    place, kind, status = F.col("n_name"), F.col("o_orderpriority"), F.col("o_orderstatus")
    text = (
        F.when(kind == "1-URGENT",
               F.concat(F.lit("weather in "), place, F.lit(" on "), F.date_format(day, "dd/MM/yyyy")))
        .when(kind == "2-HIGH",
              F.concat(F.lit("Forecast for "), F.date_format(day, "yyyy-MM-dd"), F.lit(" please")))
        .when(kind == "3-MEDIUM", F.concat(F.lit("How hot does "), F.lower(place), F.lit(" get?")))
        .when((kind == "4-NOT SPECIFIED") & (status == "F"), F.lit("Give me advice for tomorrow"))
        .when(kind == "4-NOT SPECIFIED",
              F.concat(F.lit("What was "), place, F.lit(" like yesterday?")))
        .when(status == "P", F.concat(F.lit("Is it hot on 31/2/1999 in "), place, F.lit("?")))
        .otherwise(F.lit("What should I wear?"))
    )
    return ordered(spark, sf_dir).select(F.col("o_orderkey").alias("question_id"), text.alias("question"))


def today():
    return F.lit(TODAY).cast("date")


def revisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change log: all events."""
    return (
        table(spark, sf_dir, "events")
        .select(F.col("ts").alias("revision_timestamp"), F.col("user_id").cast("string").alias("user"),
                F.col("props").alias("comment"))
    )


def order_revisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change log in the span of the line items: all orders."""
    return (
        table(spark, sf_dir, "orders")
        .select(F.col("o_orderdate").alias("revision_timestamp"),
                F.col("o_custkey").cast("string").alias("user"), F.col("o_orderpriority").alias("comment"))
    )


def normals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide normals as text, one metric per (return flag, line status), in one pass.

    Like a scraped table it starts with a header row and ends in a footnote row.
    """
    lines = table(spark, sf_dir, "lineitem")
    month = F.month(F.col("l_shipdate"))
    values = lines.groupBy("l_returnflag", "l_linestatus").agg(
        *[F.max(F.when(month == i + 1, F.col("l_quantity") - F.col("l_linenumber"))).alias(m)
          for i, m in enumerate(MONTHS)]
    )

    def cell(m: str):
        return F.concat(F.col(m).cast("string"), F.lit("("), (F.col(m) * 9 / 5 + 32).cast("string"), F.lit(")"))

    body = values.select(
        F.concat(F.lit("Mean "), "l_returnflag", "l_linestatus").alias("metric_name"),
        *[cell(m).alias(m) for m in MONTHS],
    )
    edges = table(spark, sf_dir, "nation").agg(F.count(F.lit(1)).alias("n"))
    header = edges.select(F.lit("Month").alias("metric_name"), *[F.lit(m.title()).alias(m) for m in MONTHS])
    note = edges.select(
        F.concat(F.lit("Source 1: stations, "), F.col("n").cast("string"), F.lit(" places")).alias("metric_name"),
        *[F.lit(None).cast("string").alias(m) for m in MONTHS],
    )
    return header.unionByName(body).unionByName(note)


# The same views for the check engine. All numbers are doubles there.
CTES = {
    "archive": """
SELECT n_name AS governorate, CAST(l_shipdate AS DATE) AS weather_date,
       CAST(count(*) AS INTEGER) AS weather_code,
       CAST(max(l_quantity) AS DOUBLE) AS max_temp, CAST(min(l_quantity) AS DOUBLE) AS min_temp,
       CASE WHEN count(*) % 7 <> 0 THEN CAST(CAST(max(l_discount) * 1000 AS DECIMAL(5,2)) AS DOUBLE) END AS avg_humidity,
       'archive' AS source
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
GROUP BY n_name, CAST(l_shipdate AS DATE)""",
    "calendar": """
SELECT n_name AS governorate, CAST(o_orderdate AS DATE) AS weather_date,
       min(o_orderpriority) AS condition,
       CAST(floor(max(o_totalprice) / 8000) AS DOUBLE) AS high_temp_c,
       CAST(floor(min(o_totalprice) / 8000) AS DOUBLE) AS low_temp_c
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
GROUP BY n_name, CAST(o_orderdate AS DATE)""",
    # both values as a list, nulls left out; the list functions give mean, spread and population deviation
    "pairs": """
SELECT governorate, weather_date AS date, max(weather_code) AS weather_code, max(condition) AS condition,
       max(high_temp_c) AS high_temp_c, max(max_temp) AS max_temp, max(low_temp_c) AS low_temp_c,
       max(min_temp) AS min_temp, max(avg_humidity) AS avg_humidity,
       list_filter([max(high_temp_c), max(max_temp)], lambda x: x IS NOT NULL) AS tops,
       list_filter([max(low_temp_c), max(min_temp)], lambda x: x IS NOT NULL) AS bottoms
FROM (SELECT governorate, weather_date, condition, high_temp_c, low_temp_c, NULL AS weather_code, NULL AS max_temp,
             NULL AS min_temp, NULL AS avg_humidity FROM calendar
      UNION ALL BY NAME
      SELECT governorate, weather_date, weather_code, max_temp, min_temp, avg_humidity FROM archive)
GROUP BY governorate, weather_date""",
    "merged": """
SELECT coalesce(governorate, 'NA') || '_' || strftime(date, '%Y-%m-%d') AS id, governorate, date,
       weather_code, condition, high_temp_c, max_temp, round(list_avg(tops), 2) AS avg_max_temp,
       coalesce(list_max(tops) - list_min(tops), 0.0::DOUBLE) AS range_max_temp,
       round(list_stddev_pop(tops), 2) AS std_max_temp,
       low_temp_c, min_temp, round(list_avg(bottoms), 2) AS avg_min_temp,
       coalesce(list_max(bottoms) - list_min(bottoms), 0.0::DOUBLE) AS range_min_temp,
       round(list_stddev_pop(bottoms), 2) AS std_min_temp, avg_humidity
FROM pairs""",
    "reports": """
SELECT s_name || '_' || strftime(CAST(l_shipdate AS DATE), '%Y-%m-%d') AS id, s_name AS governorate,
       CAST(l_shipdate AS DATE) AS date, CAST(l_linenumber AS INTEGER) AS weather_code,
       CASE WHEN l_returnflag <> 'R' THEN l_returnflag || l_linestatus END AS condition,
       CASE WHEN l_linestatus = 'F' THEN 'archive' ELSE 'calendar' END AS source,
       CAST(CAST(l_quantity AS DECIMAL(6,2)) + CAST(l_tax AS DECIMAL(6,2)) * 200 AS DOUBLE) AS avg_max_temp,
       CAST(CAST(l_quantity AS DECIMAL(6,2)) - CAST(l_discount AS DECIMAL(6,2)) * 200 AS DOUBLE) AS avg_min_temp,
       CASE WHEN l_linenumber <> 7 THEN CAST(CAST(l_discount AS DECIMAL(6,2)) * 1000 AS DOUBLE) END AS avg_humidity,
       CASE WHEN l_linenumber NOT IN (2, 4) THEN CAST(CAST(l_tax AS DECIMAL(6,2)) * 100 AS DOUBLE) END AS std_max_temp,
       CASE WHEN l_linenumber <> 3 THEN CAST(CAST(l_discount AS DECIMAL(6,2)) * 100 AS DOUBLE) END AS std_min_temp
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey""",
    "deduped": """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (
    PARTITION BY governorate, date
    ORDER BY CASE WHEN governorate IS NOT NULL AND date IS NOT NULL AND avg_max_temp BETWEEN -10 AND 60
               AND avg_min_temp BETWEEN -10 AND 60 AND avg_humidity BETWEEN 0 AND 100 THEN 0 ELSE 1 END,
             CASE source WHEN 'archive' THEN 1 WHEN 'calendar' THEN 2 END NULLS LAST,
             avg_max_temp DESC NULLS LAST, avg_min_temp DESC NULLS LAST, avg_humidity DESC NULLS LAST,
             condition ASC NULLS FIRST, id ASC NULLS FIRST, weather_code DESC NULLS LAST,
             std_max_temp DESC NULLS LAST, std_min_temp DESC NULLS LAST) AS rn
  FROM reports) WHERE rn = 1""",
    "with_core": """
SELECT * FROM deduped WHERE governorate IS NOT NULL AND date IS NOT NULL AND avg_max_temp IS NOT NULL
  AND avg_min_temp IS NOT NULL AND avg_humidity IS NOT NULL""",
    "valid": """
SELECT * FROM with_core WHERE avg_max_temp BETWEEN -10 AND 60 AND avg_min_temp BETWEEN -10 AND 60
  AND avg_humidity BETWEEN 0 AND 100""",
    "silver": """
SELECT id, governorate, date, weather_code, coalesce(condition, 'unknown') AS condition,
       coalesce(source, 'unknown') AS source, avg_max_temp, avg_min_temp, avg_humidity,
       coalesce(std_max_temp, (SELECT round(avg(std_max_temp), 2) FROM valid)) AS std_max_temp,
       coalesce(std_min_temp, (SELECT round(avg(std_min_temp), 2) FROM valid)) AS std_min_temp
FROM valid""",
    "dim_location": """
SELECT CAST(row_number() OVER (ORDER BY governorate NULLS FIRST) AS INTEGER) AS location_id, governorate,
       'Unknown' AS region
FROM (SELECT DISTINCT governorate FROM silver)""",
    "dim_date": """
SELECT CAST(row_number() OVER (ORDER BY date) AS INTEGER) AS date_id, date,
       CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
       CAST(day(date) AS INTEGER) AS day,
       CASE WHEN month(date) IN (12, 1, 2) THEN 'winter' WHEN month(date) IN (3, 4, 5) THEN 'spring'
            WHEN month(date) IN (6, 7, 8) THEN 'summer' ELSE 'autumn' END AS season,
       dayofweek(date) IN (5, 6) AS is_weekend
FROM (SELECT DISTINCT date FROM silver)""",
    "dim_condition": """
SELECT CAST(row_number() OVER (ORDER BY condition NULLS FIRST) AS INTEGER) AS condition_id, condition
FROM (SELECT DISTINCT condition FROM silver)""",
    "serving": """
SELECT governorate, weather_date AS date, max_temp AS avg_max_temp, min_temp AS avg_min_temp,
       coalesce(avg_humidity, 0.0::DOUBLE) AS avg_humidity, round(max_temp - min_temp, 2) AS temp_range,
       CASE WHEN max_temp >= 45 THEN 'extreme' WHEN max_temp >= 35 THEN 'high'
            WHEN max_temp >= 25 THEN 'moderate' ELSE 'low' END AS heat_level,
       CASE WHEN month(weather_date) IN (12, 1, 2) THEN 'winter' WHEN month(weather_date) IN (3, 4, 5) THEN 'spring'
            WHEN month(weather_date) IN (6, 7, 8) THEN 'summer' ELSE 'autumn' END AS season
FROM archive""",
    "questions": """
SELECT o_orderkey AS question_id,
       CASE WHEN o_orderpriority = '1-URGENT' THEN 'weather in ' || n_name || ' on ' || strftime(d, '%d/%m/%Y')
            WHEN o_orderpriority = '2-HIGH' THEN 'Forecast for ' || strftime(d, '%Y-%m-%d') || ' please'
            WHEN o_orderpriority = '3-MEDIUM' THEN 'How hot does ' || lower(n_name) || ' get?'
            WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'F' THEN 'Give me advice for tomorrow'
            WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'What was ' || n_name || ' like yesterday?'
            WHEN o_orderstatus = 'P' THEN 'Is it hot on 31/2/1999 in ' || n_name || '?'
            ELSE 'What should I wear?' END AS question
FROM (SELECT *, CAST(o_orderdate AS DATE) + CASE WHEN o_orderstatus = 'P' THEN 1200 ELSE 0 END AS d FROM orders)
JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
    "dated": f"""
SELECT question_id, question,
       CASE WHEN contains(lower(question), 'today') THEN DATE '{TODAY}'
            WHEN contains(lower(question), 'tomorrow') THEN DATE '{TODAY}' + 1
            WHEN contains(lower(question), 'yesterday') THEN DATE '{TODAY}' - 1
            ELSE CAST(coalesce(
              try_strptime(regexp_extract(question, '\\b(\\d{{4}}-\\d{{2}}-\\d{{2}})\\b', 1), '%Y-%m-%d'),
              try_strptime(regexp_extract(question, '\\b(\\d{{1,2}}/\\d{{1,2}}/\\d{{4}})\\b', 1), '%d/%m/%Y'),
              try_strptime(regexp_extract(question, '\\b(\\d{{1,2}}-\\d{{1,2}}-\\d{{4}})\\b', 1), '%d-%m-%Y')) AS DATE)
       END AS asked_date
FROM questions""",
    "asked": """
SELECT question_id, question, asked_date,
       (SELECT min(governorate) FROM (SELECT DISTINCT governorate FROM serving) p
        WHERE contains(lower(question), lower(governorate))) AS asked_place
FROM dated""",
    "nearest": """
SELECT asked_date, arg_min(date, (abs(date - asked_date), date)) AS nearest_date
FROM (SELECT DISTINCT asked_date FROM asked WHERE asked_date IS NOT NULL),
     (SELECT DISTINCT date FROM serving)
GROUP BY asked_date""",
    "defaulted": """
SELECT a.*, CASE WHEN asked_date IS NULL THEN coalesce(l.latest, (SELECT max(date) FROM serving)) END AS default_date
FROM asked a LEFT JOIN (SELECT governorate, max(date) AS latest FROM serving GROUP BY governorate) l
  ON l.governorate = a.asked_place""",
    "revisions": """
SELECT ts AS revision_timestamp, CAST(user_id AS VARCHAR) AS "user", props AS comment
FROM events""",
    "order_revisions": """
SELECT o_orderdate AS revision_timestamp, CAST(o_custkey AS VARCHAR) AS "user", o_orderpriority AS comment
FROM orders""",
    "normals_long": """
SELECT 'Mean ' || l_returnflag || l_linestatus AS metric_name, CAST(m AS INTEGER) AS month_num,
       CAST(q AS VARCHAR) || '(' || CAST(q * 9 / 5 + 32 AS VARCHAR) || ')' AS value
FROM (SELECT l_returnflag, l_linestatus, m, max(l_quantity - l_linenumber) FILTER (month(l_shipdate) = m) AS q
      FROM lineitem, range(1, 13) r(m) GROUP BY l_returnflag, l_linestatus, m)
UNION ALL SELECT 'Month', CAST(m AS INTEGER),
  ['Jan','Feb','Mar','Apr','May','Jun','Jul','Aug','Sep','Oct','Nov','Dec'][m] FROM range(1, 13) r(m)
UNION ALL SELECT 'Source 1: stations, ' || CAST((SELECT count(*) FROM nation) AS VARCHAR) || ' places',
  CAST(m AS INTEGER), NULL FROM range(1, 13) r(m)""",
}

# What each view is built from.
NEEDS = {
    "pairs": ["calendar", "archive"], "merged": ["pairs"], "deduped": ["reports"],
    "with_core": ["deduped"], "valid": ["with_core"], "silver": ["valid"],
    "dim_location": ["silver"], "dim_date": ["silver"], "dim_condition": ["silver"],
    "serving": ["archive"], "dated": ["questions"], "asked": ["dated", "serving"],
    "nearest": ["asked"], "defaulted": ["asked"],
}


def with_views(select: str, *views: str) -> str:
    """``select`` behind the common table expressions it names, in order of dependence."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in NEEDS.get(name, []):
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for view in views:
        add(view)
    return "WITH " + ",\n".join(f"{v} AS ({CTES[v]})" for v in ordered) + "\n" + select
