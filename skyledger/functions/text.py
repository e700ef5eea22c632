"""Dates in free text. ``today`` is a column, so results do not depend on the wall clock."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Relative words in order of precedence, with their distance from today in days.
RELATIVE_DAYS = [
    ("today", 0),
    ("اليوم", 0),
    ("tomorrow", 1),
    ("غدا", 1),
    ("غدًا", 1),
    ("yesterday", -1),
    ("امس", -1),
    ("أمس", -1),
]

# Date spellings in order of precedence, as (pattern, format); day before month.
DATE_SPELLINGS = [
    (r"(?U)\b(\d{4}-\d{2}-\d{2})\b", "yyyy-MM-dd"),
    (r"(?U)\b(\d{1,2}/\d{1,2}/\d{4})\b", "d/M/yyyy"),
    (r"(?U)\b(\d{1,2}-\d{1,2}-\d{4})\b", "d-M-yyyy"),
]

# Arabic-Indic digits, then their eastern forms
ARABIC_DIGITS = "٠١٢٣٤٥٦٧٨٩" "۰۱۲۳۴۵۶۷۸۹"


def relative_date(text: Column, today: Column) -> Column:
    lowered = F.lower(text)
    return F.coalesce(
        *[F.when(lowered.contains(word), F.date_add(today, days)) for word, days in RELATIVE_DAYS]
    )


def written_date(text: Column) -> Column:
    """First spelling that is a real calendar date."""
    plain = F.translate(text, ARABIC_DIGITS, "0123456789" * 2)
    return F.coalesce(
        *[
            F.try_to_date(F.nullif(F.regexp_extract(plain, pattern, 1), F.lit("")), fmt)
            for pattern, fmt in DATE_SPELLINGS
        ]
    )


def date_in_text(text: Column, today: Column) -> Column:
    """Asked date: a relative word wins over a written date; null when there is neither."""
    return F.coalesce(relative_date(text, today), written_date(text))
