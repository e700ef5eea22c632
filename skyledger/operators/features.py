"""Model input: typed features, label codes, chronological split, future days."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyledger.functions import weather
from skyledger.operators.columns import add_defaults, coerce_numeric
from skyledger.operators.ranking import label_encode
from skyledger.schemas import ML_FEATURES, ML_NUMERIC
from skyledger.storage import cut_lineage

#: Copies of one row that are written out together.
COPIES = 1_000
IMPUTED = ["temp_range", "std_min_temp", "std_max_temp"]


def prepare(df: DataFrame) -> DataFrame:
    """Dated rows with date parts, numeric measures and label codes.

    Date and place come from the identifier where a frame lacks those columns.
    """
    if "id" in df.columns:
        place, day = weather.split_id(F.col("id"))
        df = add_defaults(df, {"date": day})
        if "governorate" not in df.columns and "city" not in df.columns:
            df = df.withColumn("city", place)
    if "governorate" in df.columns:
        df = df.withColumn("city", F.col("governorate"))
    dated = df.withColumn("date", F.col("date").try_cast("date")).where(F.col("date").isNotNull())
    parts = weather.date_parts(F.col("date"))
    ready = coerce_numeric(
        dated.withColumns({c: parts[c] for c in ("month", "day_of_year", "year")}), ML_NUMERIC
    )
    for column, code, missing in (
        ("city", "city_encoded", "unknown"),
        ("condition", "condition_encoded", "unknown"),
        ("heat_level", "heat_level_encoded", "moderate"),
    ):
        if column in ready.columns:
            ready = label_encode(ready, column, code, missing)
    return ready


def feature_names(df: DataFrame) -> list[str]:
    """Known features the frame has, in their fixed order."""
    return [c for c in ML_FEATURES if c in df.columns]


def target_names(df: DataFrame) -> tuple[str, str]:
    """Averaged temperatures, or the plain ones where the averages are missing."""
    names = tuple(
        average if average in df.columns else plain
        for average, plain in (("avg_max_temp", "max_temp"), ("avg_min_temp", "min_temp"))
    )
    absent = [c for c in names if c not in df.columns]
    if absent:
        raise KeyError(f"temperature columns not found: {', '.join(absent)}")
    return names


def sort_chronological(df: DataFrame) -> DataFrame:
    """By day, then place: a total order over deduplicated rows."""
    return df.orderBy("date", "governorate")


def mark_split(df: DataFrame, holdout: float = 0.2, ties: tuple[str, ...] = ("governorate",)) -> DataFrame:
    """Adds ``is_train``: true for the first ``n - ceil(holdout * n)`` rows by day, ``ties`` and a hash of the whole row.

    The cut is found by counts, without sorting rows: rows per day (one per calendar day meets in one task), then rows per
    value of ``ties`` on the day of the cut (ranges of values, added up over all executors), then rows per piece of the hash among the rows
    of one such value. So a day on which one place holds most rows is cut as evenly and reproducibly as any other. Marking is
    one pass. Of equal rows, which nothing can tell apart, as many as needed train. Rows without a date train.
    """
    per_day = df.groupBy("date").agg(F.count(F.lit(1)).alias("_n"))
    upto = Window.orderBy("date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = per_day.withColumns({"_upto": F.sum("_n").over(upto), "_all": F.sum("_n").over(
        Window.orderBy("date").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )}).withColumn("_train", F.col("_all") - F.ceil(F.col("_all") * F.lit(holdout).cast("decimal(9,6)")))
    cut = total.where((F.col("_upto") > F.col("_train")) & F.col("date").isNotNull()).orderBy("date").limit(1).select(
        "date", (F.col("_train") - F.col("_upto") + F.col("_n")).cast("long").alias("remaining")).first()
    if cut is None:  # nothing held out
        return df.withColumn("is_train", F.lit(True))
    day = F.lit(cut["date"]).cast(df.schema["date"].dataType)
    by_day = F.coalesce(F.col("date") < day, F.lit(True))
    on_day = F.coalesce(F.col("date") == day, F.lit(False))
    if cut["remaining"] <= 0:
        return df.withColumn("is_train", by_day)
    group = _group_of_cut(df.where(on_day).groupBy(*ties).agg(F.count(F.lit(1)).alias("_n")), list(ties), cut["remaining"])
    tied, edge = F.struct(*ties), F.struct(*[F.lit(group[c]).cast(df.schema[c].dataType).alias(c) for c in ties])
    if group["_left"] == 0:
        return df.withColumn("is_train", F.when(on_day, tied < edge).otherwise(by_day))
    level = on_day & tied.eqNullSafe(edge)
    code = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    last, left, equal = _hash_of_cut(df.where(level).select(code.alias("_code")), group["_left"])
    marked = F.when(level, code <= last if left == equal else code < last).when(on_day, tied < edge).otherwise(by_day)
    if left in (0, equal):
        return df.withColumn("is_train", marked)
    same = level & (code == last)
    return df.where(~same).withColumn("is_train", marked).unionByName(_cut_copies(df.where(same), left))


def _group_of_cut(groups: DataFrame, ties: list[str], remaining: int):
    """The first group, in the order of ``ties``, with which more than ``remaining`` rows are reached; ``_left`` of its rows still train."""
    slices = cut_lineage(groups.repartitionByRange(*ties).sortWithinPartitions(*ties).withColumn("_place", F.monotonically_increasing_id()))
    slices = slices.withColumn("_slice", F.shiftright("_place", 33))
    sums = slices.groupBy("_slice").agg(F.sum("_n").alias("_sum")).withColumn(
        "_before", F.sum("_sum").over(Window.orderBy("_slice")) - F.col("_sum"))
    found = sums.where(F.col("_before") <= remaining).orderBy(F.desc("_slice")).first()
    along = F.sum("_n").over(Window.orderBy("_place")) - F.col("_n") + found["_before"]
    inside = slices.where(F.col("_slice") == found["_slice"]).withColumn("_left", F.lit(remaining) - along)
    return inside.where("_left >= 0").orderBy(F.desc("_place")).first()


def _hash_of_cut(codes: DataFrame, left: int) -> tuple[int, int, int]:
    """The hash up to which the first ``left`` rows reach, how many of them have it, and how many rows have it. Four rounds of 65,536 counts."""
    piece = lambda level: F.shiftright("_code", 48 - 16 * level)
    at = None
    for level in range(4):
        inside = codes if at is None else codes.where(piece(level - 1) == at)
        counts = inside.groupBy(piece(level).alias("_piece")).agg(F.count(F.lit(1)).alias("_n"))
        found = counts.withColumn("_before", F.sum("_n").over(Window.orderBy("_piece")) - F.col("_n")).where(
            F.col("_before") < left).orderBy(F.desc("_piece")).first()
        at, left, equal = found["_piece"], left - found["_before"], found["_n"]
    return at, left, equal


def _cut_copies(rows: DataFrame, left: int) -> DataFrame:
    """Rows with one hash (copies of one row), of which ``left`` train."""
    columns = rows.columns
    counted = rows.groupBy(*[F.col(f"`{c}`") for c in columns]).agg(F.count(F.lit(1)).alias("_n"))
    order = Window.orderBy(*[F.col(f"`{c}`") for c in columns])
    share = F.greatest(F.lit(0), F.least(F.col("_n"), F.lit(left) - (F.sum("_n").over(order) - F.col("_n"))))
    runs = counted.withColumn("_share", share).withColumn(
        "_run", F.explode(F.sequence(F.lit(0), F.floor((F.col("_n") - 1) / COPIES).cast("long"))))
    each = runs.withColumn("_nth", F.explode(F.sequence(
        F.col("_run") * COPIES, F.least(F.col("_n"), (F.col("_run") + 1) * COPIES) - 1)))
    return each.select(*[F.col(f"`{c}`") for c in columns], (F.col("_nth") < F.col("_share")).alias("is_train"))


def split_chronological(df: DataFrame, holdout: float = 0.2,
                        ties: tuple[str, ...] = ("governorate",)) -> tuple[DataFrame, DataFrame]:
    marked = mark_split(df, holdout, ties)
    return (
        marked.where("is_train").drop("is_train"),
        marked.where(~F.col("is_train")).drop("is_train"),
    )


def feature_means(df: DataFrame) -> DataFrame:
    return df.agg(*[F.avg(c).alias(c) for c in IMPUTED if c in df.columns])


def future_grid(df: DataFrame, days: int = 180, place: str | None = None,
                by_place_month: bool = False) -> DataFrame:
    """The ``days`` days after the last observed one, for one place or for every place.

    Measures of the future are imputed by their mean over all rows, or by the mean of the same
    place and month where ``by_place_month`` asks for it (all rows where that mean is missing). A
    single ``place`` that never occurs gets code 0.
    """
    last = df.agg(F.max("date")).scalar()
    places = df.groupBy("city").agg(F.min("city_encoded").alias("city_encoded"))
    if place is not None:
        code = places.where(F.col("city") == place).agg(F.min("city_encoded")).scalar()
        places = df.agg(F.lit(place).alias("city"), F.coalesce(code, F.lit(0)).alias("city_encoded"))
    ahead = F.explode(F.sequence(F.date_add(last, 1), F.date_add(last, days)))
    dated = places.select(F.col("city").alias("governorate"), "city_encoded", ahead.alias("date"))
    parts = weather.date_parts(F.col("date"))
    grid = dated.select(
        "governorate", "date", parts["month"].alias("month"),
        parts["day_of_year"].alias("day_of_year"), parts["year"].alias("year"), "city_encoded",
    )
    means = feature_means(df)
    overall = {c: means.select(c).scalar() for c in means.columns}
    if not by_place_month:
        return grid.withColumns(overall) if overall else grid
    local = df.groupBy(F.col("city").alias("governorate"), "month").agg(
        *[F.avg(c).alias(c) for c in overall]
    )
    return grid.join(local, ["governorate", "month"], "left").withColumns(
        {c: F.coalesce(c, mean) for c, mean in overall.items()}
    )
