"""Climate normals: months from columns to rows, and their join to dated rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.schemas import MONTHS
from skyledger.storage import staged


def unpivot_months(wide: DataFrame) -> DataFrame:
    """``metric_name, jan..dec`` to ``metric_name, month_num, value`` in one scan."""
    long = wide.unpivot(["metric_name"], MONTHS, "_month", "value")
    names = F.array(*[F.lit(m) for m in MONTHS])
    return long.select(
        "metric_name", F.array_position(names, F.col("_month")).cast("int").alias("month_num"), "value"
    )


def join_month_normals(observations: DataFrame, long: DataFrame) -> DataFrame:
    """Each dated row with every normal of its month.

    There are only twelve keys, so the normals are a stage table: broadcast while small, and
    otherwise split by adaptive execution on both sides.
    """
    normals = staged(
        long.select("month_num", "metric_name", F.col("value").alias("climate_normal_value")),
        "normals",
    )
    return observations.join(normals, F.month("date") == F.col("month_num")).drop("month_num")
