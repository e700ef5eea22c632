"""From extracted rows to staging tables, so that raw payloads can enter the batch plan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.schemas import ARCHIVE_STAGING, CALENDAR_STAGING, MONTHS, NORMALS_STAGING, REVISIONS


def _as(df: DataFrame, ddl: str) -> DataFrame:
    """Columns of a schema by name, cast to its types; a value that does not fit is null."""
    schema = df.sparkSession.createDataFrame([], ddl).schema
    return df.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema])


def calendar_staging(observations: DataFrame) -> DataFrame:
    """Rows of ``extract.calendar_observations`` as calendar staging rows."""
    return _as(observations.withColumnRenamed("date", "weather_date"), CALENDAR_STAGING)


def archive_staging(observations: DataFrame) -> DataFrame:
    """Rows of ``extract.parse_archive_payload`` as archive staging rows."""
    return _as(observations.withColumnRenamed("Date", "weather_date"), ARCHIVE_STAGING)


def revision_staging(revisions: DataFrame) -> DataFrame:
    """Rows of ``extract.parse_revision_json`` as change log rows."""
    return _as(revisions.withColumnRenamed("timestamp", "revision_timestamp"), REVISIONS)


def normals_staging(rows: DataFrame) -> DataFrame:
    """Rows of ``extract.parse_html_table`` as wide normals: metric, twelve months, year. Short rows end in nulls."""
    names = ["metric_name", *MONTHS, "year_value"]
    return _as(rows.select(*[F.get("cells", F.lit(i)).alias(n) for i, n in enumerate(names)], "source"), NORMALS_STAGING)
