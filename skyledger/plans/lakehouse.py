"""The batch plan from raw files to gold tables and forecast.

Every layer is a written Parquet table that the next layer reads. So no layer is computed twice, a
lost executor or a stopped run costs one layer, and the joins of the next layer see real file sizes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.operators import asof, cleaning, features, forecast, normals, star
from skyledger.operators.columns import rename_places, standardize, union_all
from skyledger.operators.merge import merge_sources
from skyledger.schemas import ARCHIVE_STAGING, CALENDAR_STAGING, NORMALS_STAGING, REVISIONS
from skyledger.sources import readers, writers

CHANGE_COLUMNS = ["revision_timestamp", "user", "comment"]


def bronze(merged: DataFrame, monthly: DataFrame | None = None) -> DataFrame:
    """Merged observations and, where there are any, the monthly ones, in canonical columns."""
    frames = [standardize(frame) for frame in (merged, monthly) if frame is not None]
    return union_all(frames)


def silver(observations: DataFrame, changes: DataFrame, source_order: list[str] | None = None) -> DataFrame:
    """Cleaned observations, each with the change in force on its day.

    The change depends on the day alone, so it is attached after cleaning, when duplicates and
    implausible rows are gone and rows are narrow in the shuffle.
    """
    cleaned = cleaning.clean(observations, source_order)
    return cleaning.fill_text(asof.asof_backward(cleaned, changes.select(CHANGE_COLUMNS)))


def gold(silver_table: DataFrame, folder: str, regions: dict[str, str] = star.REGIONS) -> dict[str, DataFrame]:
    """Write the dimensions, the fact and the model input of a written silver table."""
    spark = silver_table.sparkSession

    def write(df: DataFrame, name: str) -> DataFrame:
        writers.overwrite_parquet(df, f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    location = write(star.dim_location(silver_table, regions), "dim_location")
    day = write(star.dim_date(silver_table), "dim_date")
    condition = write(star.dim_condition(silver_table), "dim_condition")
    return {
        "dim_location": location, "dim_date": day, "dim_condition": condition,
        "fact_weather": write(star.fact_weather(silver_table, location, day, condition), "fact_weather"),
        "ml_ready": write(star.ml_ready(silver_table), "ml_ready"),
    }


def build(spark: SparkSession, raw: dict[str, str], out: str, trees: int = forecast.TREES,
          place: str | None = None, source_order: list[str] | None = None,
          aliases: dict[str, str] | None = None, by_place_month: bool = False) -> dict[str, DataFrame]:
    """All layers from raw files.

    ``raw`` names the folders ``calendar``, ``archive`` and, as far as they exist, ``monthly``,
    ``normals`` and ``revisions``. The result maps table names to written tables below ``out``.
    ``source_order`` says which source wins a day that several have; ``aliases`` maps other spellings of
    places to the one to use, before sources are merged; ``by_place_month`` imputes the forecast's measures locally.
    Lines with a value that does not fit its type stay with a null there and are also listed in a ``rejected_`` table.
    """
    def write(df: DataFrame, name: str) -> DataFrame:
        writers.overwrite_parquet(df, f"{out}/{name}")
        return spark.read.parquet(f"{out}/{name}")

    def staging(name: str, ddl: str) -> DataFrame:
        # text is parsed once; the merge reads each source several times
        parsed = readers.read_typed_csv(spark, raw[name], ddl, keep_corrupt=True, multi_line=name == "revisions")
        kept = write(parsed, f"staging/{name}")
        tables[f"rejected_{name}"] = kept.where("_corrupt_record IS NOT NULL").select("_corrupt_record")
        return kept.drop("_corrupt_record")

    tables: dict[str, DataFrame] = {}
    sources = [rename_places(staging(n, ddl), aliases) for n, ddl in (("calendar", CALENDAR_STAGING), ("archive", ARCHIVE_STAGING))]
    tables["merged_weather"] = write(merge_sources(*sources), "merged_weather")
    if "normals" in raw:
        tables["climate_insights"] = staging("normals", NORMALS_STAGING)
        tables["climate_insights_long"] = write(
            normals.unpivot_months(tables["climate_insights"]), "climate_insights_long")
    changes = spark.createDataFrame([], REVISIONS)
    if "revisions" in raw:
        changes = tables["revision_history"] = staging("revisions", REVISIONS)
    # month files come from collectors of several times: each is read by its own header
    months = [standardize(f, aliases) for f in readers.read_csv_by_header(spark, raw["monthly"])] if "monthly" in raw else []
    monthly = union_all(months) if months else None
    tables["silver"] = write(silver(bronze(tables["merged_weather"], monthly), changes, source_order), "silver")
    tables.update(gold(tables["silver"], f"{out}/gold"))
    prepared = write(features.prepare(tables["ml_ready"]), "prepared")
    marked = write(features.mark_split(prepared), "split")
    predicted = forecast.forecast(prepared, marked.where("is_train").drop("is_train"), place=place, trees=trees, by_place_month=by_place_month)
    writers.overwrite_csv(predicted, f"{out}/forecast")
    tables["forecast"] = spark.read.schema(predicted.schema).option("header", True).csv(f"{out}/forecast")
    return tables
