"""Payload and page extraction on literal documents."""

import time
from datetime import date

import pytest
from pyspark.sql import functions as F

from skyledger.operators import extract
from tests.conftest import values


def test_archive_payload(spark):
    text = ("latitude,longitude\n30.0,31.2\n\ntime,weather_code,max,min,humidity\n"
            "2024-02-01,61,20.5,10.25,50\r\n2024-02-02,,21,,\n\nbad line\n")
    df = spark.createDataFrame([("Cairo", 2024, 2, text), ("Giza", 2024, 2, "a\nb\nc\nheader\n")],
                               "governorate string, year int, month int, payload string")
    rows = values(extract.parse_archive_payload(df))
    assert rows[0] == ("Cairo", date(2024, 2, 1), 2024, 2, 61.0, 20.5, 10.25, 50.0, extract.ARCHIVE_SOURCE)
    assert rows[1][:8] == ("Cairo", date(2024, 2, 2), 2024, 2, None, 21.0, None, None)
    assert rows[2][1] is None and len(rows) == 3


def test_revision_json(spark):
    answers = [
        '{"query":{"pages":{"1":{"revisions":[{"timestamp":"t1","user":"a","comment":"c"},{"timestamp":"t2","user":"b"}]},'
        '"2":{"title":"bare"},"3":{"revisions":[]}}}}',
        '{"query":{"pages":{"9":{"revisions":[{"timestamp":"t3","comment":"no user"}]}}}}', "not json", None,
    ]
    df = spark.createDataFrame([(a,) for a in answers], "payload string")
    assert [r[:3] for r in values(extract.parse_revision_json(df))] == [
        ("t1", "a", "c"), ("t2", "b", ""), ("t3", None, "no user")]


PAGE = """<html><body><table><tr><th>plain</th></tr><tr><td>skip</td></tr></table>
<table class="sortable wikitable"><caption>c</caption>
<tr><th>Month</th><th>Jan</th></tr>
<tr><th> High &deg;C </th><td>31.0<br>(87.8)</td></tr>
<tr></tr>
<tr><td>nested<table><tr><td>inner</td></tr></table></td><td>"3,451"</td>
<tr><td>unclosed<td>cells
</table>
<table class="wikitable"><tr><th>x</th></tr><tr><td>second table</td></tr></table></body></html>"""


def test_first_wikitable_only(spark):
    df = spark.createDataFrame([(1, PAGE), (2, "<p>none</p>"), (3, "<b>wikitable</b>"), (4, None)], "page_id long, html string")
    got = extract.parse_html_table(df)
    rows = {r["row_num"]: r["cells"] for r in got.collect()}
    assert rows == {1: ["High °C", "31.0(87.8)"], 3: ["nestedinner", '"3,451"'], 4: ["unclosed", "cells"]}
    wide = {r["row_num"]: (r["Column_0"], r["Column_2"]) for r in extract.table_columns(got, 3).collect()}
    assert wide[1] == ("High °C", None)


def cell(day, phrase="Sunny", hi="95°", low="-4"):
    parts = f'<div class="date">{day}</div>'
    parts += f'<div class="phrase big"> {phrase} </div>' if phrase else ""
    parts += f'<div><span class="hi">{hi}</span>|<span class="low">{low}</span></div>' if hi else ""
    return f'<li class="calendar-day x">{parts}</li>'


def page(days):
    return "<ul><li>menu</li>" + "".join(days) + "</ul>"


def test_calendar_cells(spark):
    html = page([cell(1), cell(2, phrase=None), cell(3, hi=None), cell("", phrase="7 clouds"), cell("4 ", hi="none")])
    df = spark.createDataFrame([("p", html)], "page_id string, html string")
    rows = extract.parse_calendar_cells(df).select("day", "condition", "high_c", "low_c").collect()
    assert [tuple(r) for r in rows] == [(1, "Sunny", 35.0, -20.0), (4, "Sunny", None, -20.0)]


def test_marked_elements_never_give_the_day(spark):
    extra = cell(4).replace('<div class="date">', '<span class="phrase">7 x</span><div class="hi">88</div><b class="low">9</b><div class="date">')
    df = spark.createDataFrame([("p", page([extra, cell(5)]))], "page_id string, html string")
    assert [r.day for r in extract.parse_calendar_cells(df).collect()] == [4, 5]


@pytest.mark.parametrize("text", [
    "<a ", "<script>", "<!--", "<a '\"", "<a \">\"", "<b>", "</i>", "<li class='calendar-day'><b>", "<a<a ", "<table class=wikitable><tr><td>"])
@pytest.mark.parametrize("tail", ["", ">", "'>"])
def test_broken_pages_take_linear_time(text, tail):
    html = text * (1_000_000 // len(text)) + tail
    start = time.perf_counter()
    extract._calendar_days(html)
    extract._table_rows(html)
    assert time.perf_counter() - start < 6


def test_comments_and_scripts_in_cells(spark):
    html = '<table class="wikitable"><tr><td>h</td></tr><tr><td>a<!-- x > -->b<script>"</td>"</script>c</td><td title="x > y">d</td></tr></table>'
    df = spark.createDataFrame([(1, html)], "page_id long, html string")
    assert extract.parse_html_table(df).first()["cells"] == ["abc", "d"]


def test_no_cell_is_cut(spark):
    rows = spark.createDataFrame([(1, 1, ["a", "b", "c"], "s"), (1, 2, ["d"], "s")], "page_id int, row_num int, cells array<string>, source string")
    wide = extract.table_columns(rows)
    assert wide.columns == ["page_id", "row_num", "Column_0", "Column_1", "Column_2", "source"]
    assert values(wide.select("Column_0", "Column_2")) == [("a", "c"), ("d", None)]
    with pytest.raises(Exception, match="more than 2 cells"):
        extract.table_columns(rows, 2).collect()


def test_calendar_month_is_the_longest_run(spark):
    feb = page([cell(30), cell(31), *[cell(d) for d in range(1, 31)], cell(1), cell(2)])
    again = page([cell(d, phrase="Late") for d in range(1, 4)])
    df = spark.createDataFrame(
        [("a", "Cairo", 2023, 2, feb), ("b", "Cairo", 2023, 3, again), ("c", "Giza", 2023, 3, page([]))],
        "page_id string, governorate string, year int, month int, html string")
    rows = extract.calendar_observations(df).collect()
    # 29 and 30 are no days of February 2023
    assert sorted(r["date"] for r in rows) == [date(2023, 2, d) for d in range(1, 29)] + [date(2023, 3, d) for d in (1, 2, 3)]
    assert {r["condition"] for r in rows if r["date"].month == 2} == {"Sunny"}


def test_first_seen(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 1, 2), ("b", 1, 9)], "g string, d int, pos int")
    assert values(extract.first_seen(df, ["g", "d"], ["pos"])) == [("a", 1, 2), ("b", 1, 9)]


def test_valid_days(spark):
    df = spark.createDataFrame([(2024, 2, 29), (2023, 2, 29), (2024, 4, 31), (2024, 4, 0)], "year int, month int, day int")
    assert values(extract.valid_days(df)) == [(2024, 2, 29)]
    assert df.where(F.col("day") == 0).count() == 1
