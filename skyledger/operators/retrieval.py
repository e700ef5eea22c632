"""A table of questions answered from a table of dated, place-keyed rows."""

from __future__ import annotations

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.functions.text import date_in_text
from skyledger.operators.asof import with_nearest_date
from skyledger.operators.ranking import top_per_key
from skyledger.storage import staged

# The wording of answers, and the rows an answer shows.
NO_MATCH = "No matching data found for your query."
NO_DATA, NOT_LOADED = "No data available.", "No data loaded."
DEFAULT_SUGGESTION = "What data is available?"
ROWS_PER_ANSWER = 5
#: Leading characters of a name by which texts find it.
HEAD = 4
#: Bytes of names up to which an automaton is sent to all executors.
NAMES_BYTES = 16 << 20


def _first_place(spark: SparkSession, automaton: ahocorasick.Automaton, names: list[str]):
    """Pandas function over lower-cased texts: the first of ``names`` that occurs, in one pass over each text."""
    sent = spark.sparkContext.broadcast((automaton, names))

    @F.pandas_udf("string")
    def find(texts: pd.Series) -> pd.Series:
        machine, spelled = sent.value
        if not spelled:
            return pd.Series([None] * len(texts), dtype=object)
        first = [None if t is None else min((n for _, n in machine.iter(t)), default=None) for t in texts]
        return pd.Series([None if n is None else spelled[n] for n in first], dtype=object)

    return find


def places_in_text(questions: DataFrame, places: DataFrame, name: str = "asked_place",
                   text: str = "question", limit: int = NAMES_BYTES) -> DataFrame:
    """Adds the alphabetically first known place whose name occurs in the text, in any case.

    Distinct names make an automaton (a trie with failure links), which reads each text once, whatever the number of names, and
    shuffles nothing. It is sent to all executors, so their total bytes are checked first; names of more than ``limit``
    bytes meet the texts in a join instead, with the same result.
    """
    names = staged(
        places.select(F.col("governorate").alias("_name"), F.lower("governorate").alias("_lower"))
        .where(F.length("_lower") > 0).groupBy("_lower").agg(F.min("_name").alias("_name")), "names")
    if (names.agg(F.sum(F.octet_length("_name") + F.octet_length("_lower"))).first()[0] or 0) > limit:
        return _places_by_join(questions, names, name, text)
    automaton = ahocorasick.Automaton()
    spelled = sorted((r["_name"], r["_lower"]) for r in names.collect())
    for number, (_, lower) in enumerate(spelled):
        automaton.add_word(lower, number)
    automaton.make_automaton()
    return questions.withColumn(name, _first_place(questions.sparkSession, automaton, [n for n, _ in spelled])(F.lower(text)))


def _places_by_join(questions: DataFrame, names: DataFrame, name: str, text: str) -> DataFrame:
    """The same for names of any number.

    Each distinct text gets a number. Its distinct pieces of up to ``HEAD`` characters travel with that number,
    never with the text, and meet the heads of names in an equality join; the names found are then looked for
    in the text itself. The work grows with the text, not with its square or with texts times places.
    """
    names = names.withColumn("_head", F.substring("_lower", 1, HEAD))
    sizes = names.agg(F.collect_set(F.length("_head"))).scalar()
    texts = staged(questions.select(text).where(F.col(text).isNotNull()).distinct().withColumn(
        "_id", F.monotonically_increasing_id()), "texts")
    lettered = texts.select("_id", F.regexp_extract_all(F.lower(text), F.lit("(?s)."), F.lit(0)).alias("_chars"), sizes.alias("_sizes"))

    def run_at(i: Column, size: Column) -> Column:
        return F.array_join(F.slice("_chars", i, size), "")

    runs = lettered.select("_id", "_chars", F.explode("_sizes").alias("_size")).where(F.size("_chars") >= F.col("_size"))
    pieces = runs.select("_id", F.explode(F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.size("_chars") - F.col("_size") + 1), lambda i: run_at(i, F.col("_size"))))).alias("_head"))
    likely = pieces.join(names, "_head").groupBy("_id").agg(F.collect_set(F.struct("_name", "_lower")).alias("_likely"))
    found = texts.join(likely, "_id").select(text, F.array_min(F.transform(
        F.filter("_likely", lambda x: F.contains(F.lower(text), x["_lower"])), lambda x: x["_name"])).alias(name))
    return questions.join(found, text, "left")


def understand(questions: DataFrame, places: DataFrame, today: Column) -> DataFrame:
    """Adds ``asked_date`` and ``asked_place``."""
    dated = questions.withColumn("asked_date", date_in_text(F.col("question"), today))
    return places_in_text(dated, places)


def with_default_date(asked: DataFrame, table: DataFrame) -> DataFrame:
    """Adds ``default_date`` for questions without a date: the place's latest day, else the latest."""
    latest = table.groupBy(F.col("governorate").alias("asked_place")).agg(F.max("date").alias("_latest"))
    overall = table.agg(F.max("date")).scalar()
    of_place = asked.join(latest, "asked_place", "left")
    return of_place.withColumn(
        "default_date", F.when(F.col("asked_date").isNull(), F.coalesce("_latest", overall))
    ).drop("_latest")


def question_keys(asked: DataFrame, table: DataFrame) -> DataFrame:
    """``question_id, asked_place, date``: what each question looks up; a null place stands for any."""
    return with_default_date(asked, table).select(
        "question_id", "asked_place", F.coalesce("asked_date", "default_date").alias("date"))


def matching_rows(keys: DataFrame, table: DataFrame) -> DataFrame:
    """Every table row that meets a key (day, place, or both), once for each distinct key.

    Questions that ask the same share the rows: ``question_keys`` leads from a question to its key, so
    the output grows with the table, not with questions times places.
    """
    distinct = keys.select("asked_place", "date").where("date IS NOT NULL").distinct()
    placed = distinct.where("asked_place IS NOT NULL").withColumn("governorate", F.col("asked_place"))
    anywhere = distinct.where("asked_place IS NULL")
    return placed.join(table, ["governorate", "date"]).unionByName(anywhere.join(table, "date"))


def answer_line() -> Column:
    def text(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit("nan"))

    return F.concat(
        F.lit("- "), "governorate", F.lit(" on "), text("date"),
        F.lit(": Max "), text("avg_max_temp"), F.lit("°C, Min "), text("avg_min_temp"),
        F.lit("°C, Humidity "), text("avg_humidity"), F.lit("%, Temp Range "), text("temp_range"),
        F.lit("°C, Heat Level: "), "heat_level", F.lit(", Season: "), "season",
    )


def format_context(table: DataFrame, keys: list[str]) -> DataFrame:
    """The first rows of every key as one text, a line each."""
    ranked = top_per_key(table, keys, first_row_order(table), ROWS_PER_ANSWER, rank="_n")
    lines = F.array_sort(F.collect_list(F.struct("_n", answer_line().alias("line"))))
    return ranked.groupBy(*keys).agg(
        F.array_join(F.transform(lines, lambda x: x["line"]), "\n").alias("context")
    )


def first_row_order(table: DataFrame) -> list[Column]:
    """Place, then the measures: a total order over everything an answer shows."""
    shown = ["avg_max_temp", "avg_min_temp", "avg_humidity", "temp_range", "heat_level", "season"]
    return [F.asc("date"), F.asc("governorate"), *[F.desc_nulls_last(c) for c in shown if c in table.columns]]


def retrieve_context(questions: DataFrame, table: DataFrame, today: Column) -> DataFrame:
    """``question_id, context, trace`` for every question.

    A day nobody has data for is replaced by the closest day of the whole table; so is a day the
    asked place has no row on, which then still finds nothing. Contexts are made once per asked (place,
    day) and asked day, so a question is one lookup and never meets more than one row. An empty table has an answer
    of its own.
    """
    asked = understand(questions, table.select("governorate"), today)
    ready = staged(with_nearest_date(with_default_date(asked, table), table).withColumn(
        "_day", F.coalesce("nearest_date", "default_date")
    ), "ready")
    # only what somebody asks for is put into words
    keys = ready.select(F.col("asked_place").alias("governorate"), F.col("_day").alias("date")).distinct()
    of_cell = format_context(table.join(keys, ["governorate", "date"], "left_semi"), ["governorate", "date"])
    days = keys.where("governorate IS NULL").select("date")
    of_day = format_context(table.join(days, "date", "left_semi"), ["date"]).withColumn(
        "governorate", F.lit(None).cast("string"))
    contexts = of_cell.unionByName(of_day).select(
        F.col("governorate").alias("_place"), F.col("date").alias("_found_day"), "context"
    )
    found = ready.join(
        contexts,
        (F.col("_day") == F.col("_found_day")) & F.col("asked_place").eqNullSafe(F.col("_place")),
        "left",
    )
    missed = F.col("asked_date").isNotNull() & (
        F.col("context").isNull() | (F.col("nearest_date") != F.col("asked_date"))
    )
    no_date, no_place = F.col("asked_date").isNull(), F.col("asked_place").isNull()
    trace = F.concat_ws(
        " | ",
        F.concat(F.lit("Date: "), F.col("asked_date").cast("string")),
        F.concat(F.lit("Governorate: "), F.col("asked_place")),
        F.when(no_date & no_place,
               F.concat(F.lit("Latest available date: "), F.col("default_date").cast("string"))),
        F.when(no_date & ~no_place,
               F.concat(F.lit("Latest date for "), F.col("asked_place"), F.lit(": "),
                        F.col("default_date").cast("string"))),
        F.when(missed,
               F.concat(F.lit("Closest available date: "), F.col("nearest_date").cast("string"),
                        F.lit(" (requested: "), F.col("asked_date").cast("string"), F.lit(")"))),
    )
    loaded = table.agg(F.count(F.lit(1)) > 0).scalar()
    return found.select(
        "question_id", F.when(loaded, F.coalesce("context", F.lit(NO_MATCH))).otherwise(NO_DATA).alias("context"),
        F.when(loaded, trace).otherwise(NOT_LOADED).alias("trace"),
    )


def point_lookup(table: DataFrame, place: str, day: str) -> DataFrame:
    """The row of a place on a day, or none."""
    wanted = (F.col("governorate") == place) & (F.col("date") == F.lit(day).cast("date"))
    return table.where(wanted).orderBy(*first_row_order(table)).limit(1)


def date_range(table: DataFrame) -> DataFrame:
    return table.agg(F.min("date").alias("first_date"), F.max("date").alias("last_date"))


def hottest_row(table: DataFrame) -> DataFrame:
    """The row with the highest maximum; the earliest on a tie."""
    known = table.where(F.col("avg_max_temp").isNotNull())
    return known.orderBy(F.desc("avg_max_temp"), *first_row_order(table)).limit(1)


def known_places(table: DataFrame) -> DataFrame:
    return table.select("governorate").distinct().orderBy("governorate")


def suggestions(table: DataFrame, home: str = "Cairo", other: str = "Alexandria") -> DataFrame:
    """Three example questions about the latest and the hottest day, as one row; one question if the table is empty.

    A table without any known maximum has no hottest day and gives the other two.
    """
    latest = table.agg(F.max("date")).scalar().cast("string")
    best = hottest_row(table).select(F.concat(
        F.lit("The hottest recorded day was "), F.col("date").cast("string"), F.lit(" in "), "governorate",
        F.lit(" ("), F.col("avg_max_temp").cast("string"), F.lit("°C). What precautions should I take?"))
        .alias("question")).agg(F.max("question").alias("hottest"))
    three = F.array(
        F.concat(F.lit(f"What are the weather conditions in {home} on "), latest, F.lit("? Give me health advice.")),
        F.col("hottest"),
        F.concat(F.lit(f"Compare weather between {other} and {home} on "), latest, F.lit(".")),
    )
    return best.select(F.when(latest.isNull(), F.array(F.lit(DEFAULT_SUGGESTION))).otherwise(
        F.array_compact(three)).alias("suggestions"))
