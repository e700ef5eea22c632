"""Joins on the nearest day: latest change on or before a day, closest available day."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyledger.operators.ranking import top_per_key
from skyledger.storage import staged


def change_days(changes: DataFrame, ts: str = "revision_timestamp") -> DataFrame:
    """For every day from the first to the last change, the change in force on that day.

    First one row per day with a change (the latest by time; ties by the other columns), then each
    of them is repeated up to the day before the next. So there is at most one row per calendar
    day, whatever the number of changes. The unpartitioned window sees one row per day with a
    change.
    """
    ties = [F.asc_nulls_first(c) for c in changes.columns if c != ts]
    per_day = top_per_key(
        changes.withColumn("_day", F.col(ts).cast("date")).where(F.col("_day").isNotNull()),
        ["_day"],
        [F.desc(ts), *ties],
    )
    following = F.lead("_day").over(Window.orderBy("_day"))
    spans = per_day.withColumn("_until", F.coalesce(F.date_sub(following, 1), F.col("_day")))
    return spans.withColumn("_day", F.explode(F.sequence("_day", "_until"))).drop("_until")


def asof_backward(left: DataFrame, changes: DataFrame, day: str = "date",
                  ts: str = "revision_timestamp") -> DataFrame:
    """Every left row with the latest change made on its day or before; nulls where there is none.

    An equality join on the day: rows behind the last change look up the last change's day. No
    range predicate, no pairs, one pass over ``left``. The day table is a stage table, broadcast
    while its size allows it.
    """
    days = staged(change_days(changes, ts), "change-days")
    last = days.agg(F.max("_day")).scalar()
    lookup = F.when(F.col(day).isNotNull(), F.least(F.col(day), last))
    return left.withColumn("_day", lookup).join(days, "_day", "left").drop("_day")


def nearest_days(asked: DataFrame, available: DataFrame) -> DataFrame:
    """``asked_date -> nearest_date`` for every distinct asked day; the earlier day wins a tie.

    Both inputs are single-column frames named ``asked_date`` and ``date``. They are reduced to
    distinct days first, so the unpartitioned windows see calendar days, not rows.
    """
    marks = (
        available.select(F.col("date").alias("_day"), F.lit(True).alias("_has"))
        .unionByName(asked.select(F.col("asked_date").alias("_day"), F.lit(False).alias("_has")))
        .where(F.col("_day").isNotNull())
        .groupBy("_day")
        .agg(F.max("_has").alias("_has"), F.count_if(~F.col("_has")).alias("_asks"))
    )
    here = F.when(F.col("_has"), F.col("_day"))
    upto = Window.orderBy("_day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    onward = Window.orderBy("_day").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    earlier = F.last(here, ignorenulls=True).over(upto)
    later = F.first(here, ignorenulls=True).over(onward)
    both = marks.withColumns({"_earlier": earlier, "_later": later}).where(F.col("_asks") > 0)
    closer = F.when(
        F.datediff("_later", "_day") < F.datediff("_day", "_earlier"), F.col("_later")
    ).otherwise(F.coalesce("_earlier", "_later"))
    return both.select(F.col("_day").alias("asked_date"), closer.alias("nearest_date"))


def with_nearest_date(questions: DataFrame, table: DataFrame) -> DataFrame:
    """Adds ``nearest_date``: the asked day, or the closest day the table has any row for.

    The map is broadcast: two dates per calendar day, at most a few megabytes.
    """
    days = nearest_days(questions.select("asked_date"), table.select("date"))
    return questions.join(F.broadcast(days), "asked_date", "left")
