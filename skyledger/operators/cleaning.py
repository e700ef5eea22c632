"""Silver layer: duplicates, missing core values, implausible values, fills, audit."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.operators.ranking import top_per_key
from skyledger.schemas import CORE, MEAN_FILLED, PLAUSIBLE, TEXT_FILLED
from skyledger.storage import staged

UNKNOWN = "unknown"
# The day leads: sorting by a number first is cheaper than by names that share a prefix.
DAY_KEYS = ["date", "governorate"]


def is_valid(columns: list[str]) -> Column:
    """True where every core value is there and within its range; false otherwise, never null."""
    checks = [F.col(c).isNotNull() for c in CORE if c in columns]
    checks += [F.col(c).between(*bounds) for c, bounds in PLAUSIBLE.items() if c in columns]
    return F.coalesce(reduce(lambda a, b: a & b, checks, F.lit(True)), F.lit(False))


def survivor_order(columns: list[str], source_order: list[str]) -> list[Column]:
    """Which of several rows for one place and day is kept: a total order over the facts.

    Complete and plausible rows come first, so a day with a valid report is never lost to an invalid one.
    """
    order = [F.desc(is_valid(columns))]
    if source_order and "source" in columns:
        # a source the caller does not list ranks behind all listed ones
        position = F.array_position(F.array(*[F.lit(s) for s in source_order]), F.col("source"))
        order.append(F.asc_nulls_last(F.nullif(position, F.lit(0))))
    order += [F.desc_nulls_last(c) for c in CORE[2:] if c in columns]
    order += [F.asc_nulls_first(c) for c in ("condition", "id") if c in columns]
    rest = [c for c in columns if c in MEAN_FILLED + ["weather_code"]]
    return order + [F.desc_nulls_last(c) for c in rest]


def dedup_rows(df: DataFrame, source_order: list[str] | None = None) -> DataFrame:
    """One row per (place, day)."""
    return top_per_key(df, DAY_KEYS, survivor_order(df.columns, source_order or []))


def drop_null_core(df: DataFrame) -> DataFrame:
    return df.dropna(subset=[c for c in CORE if c in df.columns])


def filter_plausible(df: DataFrame, ranges: dict[str, tuple] = PLAUSIBLE) -> DataFrame:
    """Rows inside every inclusive range. A null is outside."""
    for name, (low, high) in ranges.items():
        df = df.where(F.col(name).between(low, high))
    return df


def column_means(df: DataFrame, names: list[str]) -> DataFrame:
    """Means of the listed columns that exist, as one row, in one pass."""
    return df.agg(*[F.avg(c).alias(c) for c in names if c in df.columns])


def fill_with_means(df: DataFrame, means: DataFrame) -> DataFrame:
    """Nulls become the column mean to two decimals; a column without any value stays null.

    Each mean is a scalar subquery on the one-row ``means``.
    """
    return df.withColumns({
        c: F.coalesce(
            F.col(c).cast("double"), F.round(means.select(F.col(c).cast("double")).scalar(), 2)
        )
        for c in means.columns
    })


def fill_text(df: DataFrame, names: list[str] = TEXT_FILLED) -> DataFrame:
    return df.fillna({c: UNKNOWN for c in names if c in df.columns})


def null_counts(df: DataFrame) -> DataFrame:
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])


def row_audit(df: DataFrame, source_order: list[str] | None = None) -> DataFrame:
    """Rows before cleaning and after each of its steps, as one row.

    The rows before are counted next to, not inside, the duplicate removal, so that the latter can
    still cut hot groups before its shuffle.
    """
    kept = dedup_rows(df, source_order)
    whole = F.lit(True)
    for name in CORE:
        whole = whole & F.col(name).isNotNull()
    plausible = whole
    for name, (low, high) in PLAUSIBLE.items():
        plausible = plausible & F.col(name).between(low, high)
    return kept.agg(
        df.agg(F.count(F.lit(1))).scalar().alias("rows_before"),
        F.count(F.lit(1)).alias("rows_after_dedup"),
        F.count_if(whole).alias("rows_after_null_drop"),
        F.count_if(plausible).alias("rows_after_range_filter"),
    )


def keep_valid(df: DataFrame, source_order: list[str] | None = None) -> DataFrame:
    """Duplicates, then missing core values, then implausible values removed."""
    return filter_plausible(drop_null_core(dedup_rows(df, source_order)))


def clean(df: DataFrame, source_order: list[str] | None = None) -> DataFrame:
    """The whole cleaning step.

    Valid rows are written as a stage table once; the means read only its fill columns, instead of
    running the duplicate removal a second time.
    """
    valid = staged(keep_valid(df, source_order), "valid")
    fillable = [c for c in MEAN_FILLED if c in valid.columns]
    filled = fill_with_means(valid, column_means(valid, fillable)) if fillable else valid
    return fill_text(filled)
