"""Question answering over a small table."""

import time
from datetime import date

import pytest
from pyspark.sql import functions as F

from skyledger.operators import retrieval
from tests.conftest import values

TODAY = "2026-07-10"
PLACES = ["Aswan", "Cairo", "Giza", "Luxor", "Minya", "New Cairo", "Qena"]


@pytest.fixture(scope="module")
def table(spark):
    rows = [(p, date(2026, 7, d), 30.0 + d, 20.0, 0.0, 10.0 + d, "moderate", "summer")
            for p in PLACES for d in (9, 10, 20) if not (p == "Giza" and d == 20)]
    return spark.createDataFrame(rows, "governorate string, date date, avg_max_temp double, avg_min_temp double, "
                                 "avg_humidity double, temp_range double, heat_level string, season string").cache()


def ask(spark, table, *questions):
    df = spark.createDataFrame(list(enumerate(questions)), "question_id int, question string")
    got = retrieval.retrieve_context(df, table, F.lit(TODAY).cast("date")).collect()
    return [(r["context"], r["trace"]) for r in sorted(got, key=lambda r: r["question_id"])]


def test_policy(spark, table):
    answers = ask(
        spark, table, "Cairo on 9/7/2026", "How is GIZA?", "what about 2026-07-09", "hello", "tomorrow",
        "Giza 2026-07-20", "Luxor 1/1/2020", "31/2/2026 in Qena", "15/7/2026", None)
    assert answers[0] == ("- Cairo on 2026-07-09: Max 39.0°C, Min 20.0°C, Humidity 0.0%, Temp Range 19.0°C, "
                          "Heat Level: moderate, Season: summer", "Date: 2026-07-09 | Governorate: Cairo")
    assert answers[1][0].startswith("- Giza on 2026-07-10") and answers[1][1] == (
        "Governorate: Giza | Latest date for Giza: 2026-07-10")
    lines = answers[2][0].split("\n")
    assert [x.split(" on ")[0] for x in lines] == ["- Aswan", "- Cairo", "- Giza", "- Luxor", "- Minya"]
    assert answers[3][1] == "Latest available date: 2026-07-20" and len(answers[3][0].split("\n")) == 5
    assert answers[4][1] == "Date: 2026-07-11 | Closest available date: 2026-07-10 (requested: 2026-07-11)"
    # other places have the day, so it is its own closest day, and the place still has no row
    assert answers[5] == (retrieval.NO_MATCH, "Date: 2026-07-20 | Governorate: Giza | "
                          "Closest available date: 2026-07-20 (requested: 2026-07-20)")
    assert answers[6][0].startswith("- Luxor on 2026-07-09")
    assert answers[7][1] == "Governorate: Qena | Latest date for Qena: 2026-07-20"
    assert answers[8][1].endswith("Closest available date: 2026-07-10 (requested: 2026-07-15)")  # tie: earlier day
    assert answers[9][1] == "Latest available date: 2026-07-20"


def test_place_is_the_first_in_the_alphabet(spark, table):
    q = spark.createDataFrame([(1, "Luxor or new cairo?"), (2, "NEW CAIRO"), (3, "xaswanx"), (4, "Cair"), (5, None)],
                              "question_id int, question string")
    got = {r["question_id"]: r["asked_place"] for r in retrieval.places_in_text(q, table.select("governorate")).collect()}
    assert got == {1: "Cairo", 2: "Cairo", 3: "Aswan", 4: None, 5: None}


def test_places_against_brute_force(spark):
    names = ["ab", "b", "abc", "Ca", "bca", "ß", "é a"]
    texts = ["abcab", "xx", "", "CAB", "bcab", "ÉéÉ A", "straße", "aaaa", "b"] * 2
    q = spark.createDataFrame(list(enumerate(texts)), "question_id int, question string")
    places = spark.createDataFrame([(n,) for n in names], "governorate string")
    for limit in (retrieval.NAMES_BYTES, 0):  # an automaton, and a join for names of any number
        got = {r["question_id"]: r["asked_place"] for r in retrieval.places_in_text(q, places, limit=limit).collect()}
        assert got == {i: min((n for n in names if n.lower() in t.lower()), default=None) for i, t in enumerate(texts)}
    assert {r["asked_place"] for r in retrieval.places_in_text(q, places.limit(0)).collect()} == {None}


def test_places_shuffle_no_text(spark, table):
    q = spark.createDataFrame([(1, "Giza")], "question_id int, question string")
    plan = retrieval.places_in_text(q, table.select("governorate"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_optional_predicates(spark, table):
    q = spark.createDataFrame([(1, "Cairo on 9/7/2026"), (2, "9/7/2026"), (3, "Giza"), (4, "hi"), (5, "Giza 1/1/2020")],
                              "question_id int, question string")
    asked = retrieval.understand(q, table.select("governorate"), F.lit(TODAY).cast("date"))
    keys = retrieval.question_keys(asked, table)
    assert {r.question_id: (r.asked_place, str(r.date)) for r in keys.collect()} == {
        1: ("Cairo", "2026-07-09"), 2: (None, "2026-07-09"), 3: ("Giza", "2026-07-10"), 4: (None, "2026-07-20"), 5: ("Giza", "2020-01-01")}
    rows = retrieval.matching_rows(keys.union(keys), table).groupBy("asked_place", "date").count()
    assert values(rows.selectExpr("asked_place", "cast(date as string)", "count")) == [
        ("Cairo", "2026-07-09", 1), ("Giza", "2026-07-10", 1), (None, "2026-07-09", 7), (None, "2026-07-20", 6)]


def test_empty_table(spark, table):
    empty = table.limit(0)
    assert ask(spark, empty, "Cairo on 9/7/2026", "hello") == [("No data available.", "No data loaded.")] * 2
    assert retrieval.suggestions(empty).first()["suggestions"] == ["What data is available?"]


def test_long_texts_take_linear_time(spark, table):
    def seconds(n):
        text = "".join(chr(97 + (i * i + i // 7) % 26) for i in range(n)) + " giza"
        q = spark.createDataFrame([(1, text)], "question_id int, question string")
        start = time.perf_counter()
        assert retrieval.places_in_text(q, table.select("governorate")).first()["asked_place"] == "Giza"
        return time.perf_counter() - start

    seconds(4_000)
    assert seconds(160_000) < 10 * max(seconds(16_000), 1)


def test_lookups(spark, table):
    assert retrieval.point_lookup(table, "Giza", "2026-07-09").first()["avg_max_temp"] == 39.0
    assert retrieval.point_lookup(table, "Giza", "2026-07-20").count() == 0
    assert tuple(retrieval.date_range(table).first()) == (date(2026, 7, 9), date(2026, 7, 20))
    hottest = retrieval.hottest_row(table).first()
    assert (hottest["governorate"], hottest["date"]) == ("Aswan", date(2026, 7, 20))
    assert [r[0] for r in retrieval.known_places(table).collect()] == sorted(PLACES)
    assert retrieval.suggestions(table).first()["suggestions"] == [
        "What are the weather conditions in Cairo on 2026-07-20? Give me health advice.",
        "The hottest recorded day was 2026-07-20 in Aswan (50.0°C). What precautions should I take?",
        "Compare weather between Alexandria and Cairo on 2026-07-20."]
