"""Rows out of raw payloads: archive CSV text, revision JSON, HTML tables and calendars."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.functions import weather
from skyledger.functions.calendar import is_day_of_month
from skyledger.operators.ranking import longest_increasing_run, top_per_key

# Line layout of an archive payload and the lineage texts of the sources.
ARCHIVE_COLUMNS = "Date string, Weather_Code double, Max_Temp double, Min_Temp double, Avg_Humidity double"
ARCHIVE_LINES_BEFORE_DATA = 4
ARCHIVE_SOURCE = "Open-Meteo Historical Weather API"
REVISION_SOURCE = "Wikipedia API - Revision History"
TABLE_SOURCE = "Web Scraping - Wikipedia Climate Data"
REVISION_JSON = (
    "query struct<pages: map<string, struct<revisions: "
    "array<struct<timestamp: string, user: string, comment: string>>>>>"
)


def parse_archive_payload(payloads: DataFrame) -> DataFrame:
    """``governorate, year, month, payload`` to one typed row per data line of the payload.

    A payload is CSV text: three lines of preamble, a header, then data.
    """
    lines = F.split("payload", "\r?\n")
    data = F.filter(
        F.slice(lines, ARCHIVE_LINES_BEFORE_DATA + 1, F.size(lines)), lambda x: F.trim(x) != ""
    )
    row = F.from_csv("line", F.lit(ARCHIVE_COLUMNS))
    return (
        payloads.select("governorate", "year", "month", F.explode(data).alias("line"))
        .select("governorate", "year", "month", row.alias("r"))
        .select(
            F.col("governorate").alias("Governorate"), weather.to_day(F.col("r.Date")).alias("Date"),
            F.col("year").cast("int").alias("Year"), F.col("month").cast("int").alias("Month"),
            "r.Weather_Code", "r.Max_Temp", "r.Min_Temp", "r.Avg_Humidity",
            F.lit(ARCHIVE_SOURCE).alias("Source"),
        )
    )


def parse_revision_json(payloads: DataFrame, payload: str = "payload") -> DataFrame:
    """One row per revision of every page in every payload; a missing comment is empty text."""
    pages = F.map_values(F.from_json(payload, REVISION_JSON)["query"]["pages"])
    return (
        payloads.select(F.explode(pages).alias("page"))
        .select(F.explode("page.revisions").alias("rev"))
        .select(
            F.col("rev.timestamp").alias("timestamp"), F.col("rev.user").alias("user"),
            F.coalesce("rev.comment", F.lit("")).alias("comment"),
            F.lit(REVISION_SOURCE).alias("source"),
        )
    )


_NAME = re.compile(r"<(/?)([a-z][^\s/>]*)", re.IGNORECASE)
_STOP = re.compile("""[>"']""")
_ENDS = {name: re.compile(rf"</{name}\s*>", re.IGNORECASE) for name in ("script", "style")}
_CLASS = re.compile(r"""\bclass\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)


def _tag_end(html: str, at: int) -> int:
    """Where the tag around ``at`` closes, outside of quoted values; -1 if a quote is never closed."""
    while stop := _STOP.search(html, at):
        if stop[0] == ">":
            return stop.start()
        at = html.find(stop[0], stop.end()) + 1
        if not at:
            return -1
    return -1


def _tags(html: str) -> Iterator[tuple[str, bool, str, list[str]]]:
    """The tags of a page, each as (text before it, whether it ends an element, name, classes); last the text after all tags.

    Comments, scripts and styles are left out. One forward pass: an end that was once searched in vain is not searched
    again, and after a quote that never closes, quotes are ignored, so broken pages take linear time too.
    """
    last, done, at, held = html.rfind(">"), 0, 0, []
    missing: set[str] = set()
    while -1 < (start := html.find("<", at)) < last:
        at = start + 1
        if html.startswith("<!--", start):
            end = -1 if "-->" in missing else html.find("-->", start + 4)
            if end < 0:
                missing.add("-->")
                continue
            held.append(html[done:start])
            done = at = end + 3
            continue
        tag = _NAME.match(html, start)
        if not tag:
            continue
        name = tag[2].lower()
        if name in _ENDS and not tag[1] and name not in missing:
            if found := _ENDS[name].search(html, tag.end()):
                held.append(html[done:start])
                done = at = found.end()
                continue
            missing.add(name)
        end = html.find(">", tag.end()) if "quote" in missing else _tag_end(html, tag.end())
        if end < 0:
            missing.add("quote")
            end = html.find(">", tag.end())
        attributes = html[tag.end():end]
        found = _CLASS.search(attributes) if attributes else None
        classes = found[found.lastindex].split() if found and found.lastindex else []
        held.append(html[done:start])
        yield "".join(held), tag[1] == "/", name, classes
        held, done = [], end + 1
        at = done
    yield "".join([*held, html[done:]]), False, "", []


def _table_rows(html: str) -> list[list[str]]:
    """Rows of the first ``wikitable``, each a list of cell texts; tables inside a cell are text."""
    rows: list[list[str]] = []
    depth, cell = 0, None
    for text, ends, name, classes in _tags(html):
        if cell is not None:
            cell.append(text)
        border = depth == 1 and name in ("table", "tr", "td", "th", "") and (ends or name != "table")
        if border and cell is not None:
            rows[-1].append(unescape("".join(cell)).strip())
            cell = None
        if name == "table" and ends and depth:
            depth -= 1
            if depth == 0:
                break
        elif name == "table" and not ends and (depth or "wikitable" in classes):
            depth += 1
        elif depth == 1 and name == "tr" and not ends:
            rows.append([])
        elif depth == 1 and name in ("td", "th") and not ends and rows:
            cell = []
    return rows


# The marked parts of a calendar cell and the elements they are read from.
_CELL_PARTS = {"phrase": "div", "hi": "span", "low": "span"}


def _calendar_days(html: str) -> list[dict[str, str]]:
    """Each ``li`` of class ``calendar-day``: its marked parts, and the rest of its text as ``free``.

    A part is the first element of its class and tag. Text of any other element of those classes belongs to none, so
    a number in it is never taken for the day.
    """
    cells: list[dict[str, list[str]]] = []
    inside: list[tuple[str, str]] = []  # open elements of the cell, with the part their text belongs to
    open_: Counter[str] = Counter()
    for text, ends, name, classes in _tags(html):
        if inside and text:
            cells[-1][inside[-1][1]].append(text)
        if not name or not (inside or classes):
            continue
        if ends:
            while open_[name]:
                closed = inside.pop()[0]
                open_[closed] -= 1
                if closed == name:
                    break
        elif name == "li" and any("calendar-day" in c for c in classes):
            cells.append({"free": [], "": []})
            inside, open_ = [(name, "free")], Counter([name])
        elif inside:
            part = inside[-1][1]
            for marked in _CELL_PARTS.keys() & set(classes):
                first = _CELL_PARTS[marked] == name and marked not in cells[-1]
                part = marked if first else ""
                if first:
                    cells[-1][marked] = []
                    break
            inside.append((name, part))
            open_[name] += 1
    return [{part: unescape("".join(text)) for part, text in cell.items() if part} for cell in cells]


def parse_html_table(pages: DataFrame) -> DataFrame:
    """``page_id, html`` to ``page_id, row_num, cells, source`` for the first ``wikitable`` of a page.

    The header row is left out, row numbers start at 1. Pages without the class name never reach
    Python.
    """

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [
                (page, number, cells)
                for page, html in zip(batch["page_id"], batch["html"])
                for number, cells in enumerate(_table_rows(html))
                if number > 0 and cells
            ]
            yield pd.DataFrame(found, columns=["page_id", "row_num", "cells"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return (
        pages.where(F.col("html").contains("wikitable")).select("page_id", "html")
        .mapInPandas(rows, f"page_id {kind}, row_num int, cells array<string>")
        .withColumn("source", F.lit(TABLE_SOURCE))
    )


def table_columns(rows: DataFrame, width: int | None = None) -> DataFrame:
    """Cells as ``Column_0``, ``Column_1`` and so on; short rows end in nulls.

    Without ``width`` the longest row decides, which takes a count over ``rows``. A row with more cells than a given
    ``width`` is an error: no cell is left out.
    """
    if width is None:
        width = rows.agg(F.max(F.size("cells"))).first()[0] or 0
    fits = F.when(F.size("cells") <= width, F.col("cells")).otherwise(
        F.raise_error(F.lit(f"a row has more than {width} cells")).cast("array<string>"))
    return rows.withColumn("cells", fits).select(
        "page_id", "row_num", *[F.get("cells", F.lit(i)).alias(f"Column_{i}") for i in range(width)],
        "source",
    )


def parse_calendar_cells(pages: DataFrame) -> DataFrame:
    """``page_id, html`` to ``page_id, pos, day, condition, high_c, low_c`` in page order.

    A cell without condition, high or low is skipped, and so is one without a day number outside
    of those parts.
    """

    def cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["free", "phrase", "hi", "low"]
        for batch in batches:
            found = [
                (page, pos, *(cell.get(n) for n in names))
                for page, html in zip(batch["page_id"], batch["html"])
                for pos, cell in enumerate(_calendar_days(html))
            ]
            yield pd.DataFrame(found, columns=["page_id", "pos", *names])

    kind = pages.schema["page_id"].dataType.simpleString()
    raw = (
        pages.where(F.col("html").contains("calendar-day")).select("page_id", "html")
        .mapInPandas(cells, f"page_id {kind}, pos int, free string, phrase string, hi string, low string")
    )
    return raw.dropna(subset=["phrase", "hi", "low"]).select(
        "page_id", "pos", weather.first_small_number(F.col("free")).alias("day"),
        F.trim("phrase").alias("condition"),
        weather.fahrenheit_to_celsius(F.col("hi")).alias("high_c"),
        weather.fahrenheit_to_celsius(F.col("low")).alias("low_c"),
    ).where(F.col("day").isNotNull())


def valid_days(df: DataFrame) -> DataFrame:
    """Rows whose ``day`` exists in their ``year`` and ``month``."""
    return df.where(is_day_of_month(F.col("day"), F.col("year"), F.col("month")))


def first_seen(df: DataFrame, keys: list[str], arrival: list[str]) -> DataFrame:
    """First row of every key in arrival order."""
    return top_per_key(df, keys, [F.asc(c) for c in arrival])


def calendar_observations(pages: DataFrame) -> DataFrame:
    """Calendar pages (``page_id, governorate, year, month, html``) to dated observations.

    A page also shows trailing days of the month before and leading days of the month after. The
    longest increasing run of day numbers is the month itself.
    """
    cells = parse_calendar_cells(pages)
    run = longest_increasing_run(cells, ["page_id"], "pos", "day")
    about = pages.select("page_id", "governorate", "year", "month")
    dated = valid_days(
        cells.join(run, "page_id")
        .where(F.col("pos").between(F.col("run_start"), F.col("run_end")))
        .join(about, "page_id")
    ).withColumn("date", F.make_date("year", "month", "day"))
    return first_seen(dated, ["governorate", "date"], ["year", "month", "pos"]).select(
        "governorate", "condition", F.col("high_c").alias("high_temp_c"),
        F.col("low_c").alias("low_temp_c"), "date",
    )
