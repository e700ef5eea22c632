"""Writers. All of them write in parallel from the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.sources.readers import try_read

MONTH = ["year", "month"]


def overwrite_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def overwrite_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_clean_csv(df: DataFrame, path: str) -> None:
    """Quotes only where needed, doubled inner quotes, CRLF line ends, no byte-order mark.

    A line break inside a quoted field becomes CRLF too; reading it back gives one break again.
    """
    (
        df.write.mode("overwrite").option("header", True).option("lineSep", "\r\n")
        .option("quote", '"').option("escape", '"').option("emptyValue", "").csv(path)
    )


def replace_months(df: DataFrame, path: str) -> None:
    """Write by (year, month); months in ``df`` are replaced, all others stay.

    The rebalance gathers a month for one file; a month too big for one task is split again by
    adaptive execution.
    """
    (
        df.hint("rebalance", *MONTH).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy(*MONTH).parquet(path)
    )


def create_table_as(df: DataFrame, table: str, path: str) -> None:
    """Replace a catalog table by the rows of ``df``, stored under ``path``."""
    df.write.mode("overwrite").option("path", path).format("parquet").saveAsTable(table)


def insert_select(df: DataFrame, table: str) -> None:
    """Append ``df`` to a table, cast to the table's columns by name."""
    target = df.sparkSession.table(table).schema
    df.select(*[F.col(f.name).cast(f.dataType) for f in target]).write.insertInto(table)


def new_months(incoming: DataFrame, loaded: DataFrame) -> DataFrame:
    """Incoming rows of months that are not loaded yet.

    The loaded side is reduced to its distinct months, two numbers each, so it is broadcast.
    """
    months = loaded.select(*MONTH).distinct()
    return incoming.join(F.broadcast(months), MONTH, "left_anti")


#: One row of the load ledger: what a batch of a run brought, under which load number.
LEDGER = "year int, month int, version string, load long, run string, batch long"


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The loads of a target: one row for each (year, month, version) of each batch. Empty before the first load."""
    found = try_read(lambda: spark.read.schema(LEDGER).parquet(f"{path}/ledger"))
    return spark.createDataFrame([], LEDGER) if found is None else found


def add_versions(df: DataFrame, path: str, batch: int, run: str = "direct") -> None:
    """Write rows (with a ``version`` column) as one load; a batch of a run that is written again replaces itself.

    Rows lie below ``rows`` by run, batch and month. The ledger entry is written after them, so a batch that failed on its way stays
    invisible. Nothing that is loaded is read or removed: months may arrive as any number of files in any number
    of batches and runs. A load gets the next number; a repeated one keeps its own. A null version is the empty one;
    rows without a year or month form a month of their own. ``read_months`` picks the version of each month.
    """
    spark, place = df.sparkSession, f"run={run}/batch={batch}"
    rows = df.withColumns({"version": F.coalesce(F.col("version").cast("string"), F.lit("")), "_year": F.col("year"), "_month": F.col("month")})
    ledger = read_ledger(spark, path)
    own = (F.col("run") == run) & (F.col("batch") == batch)
    known, last = ledger.agg(F.max(F.when(own, F.col("load"))), F.max("load")).first()
    load = known if known is not None else (0 if last is None else last + 1)
    rows.hint("rebalance", "_year", "_month").write.mode("overwrite").partitionBy("_year", "_month").parquet(f"{path}/rows/{place}")
    written = spark.read.schema(rows.schema).parquet(f"{path}/rows/{place}").select(
        F.col("year").cast("int"), F.col("month").cast("int"), "version").distinct()
    entry = written.select("*", F.lit(load).cast("long").alias("load"), F.lit(run).alias("run"), F.lit(batch).cast("long").alias("batch"))
    entry.coalesce(1).write.mode("overwrite").parquet(f"{path}/ledger/{place}")


def chosen_loads(ledger: DataFrame, keep: str) -> DataFrame:
    """Loads whose rows count: ``run, batch, year, month, version`` of the ``newest`` or ``first`` version of each month.

    A version is as old as its first load, whatever month that brought, so late files of an old version do not make it new.
    Versions that come first in the same load are ordered as numbers, where they are such, and then as text.
    """
    age = ledger.groupBy("version").agg(F.min("load").alias("age")).withColumn(
        "rank", F.struct("age", F.expr("coalesce(try_cast(version AS decimal(38, 9)), -1)"), "version"))
    pick = {"newest": F.max_by, "first": F.min_by}[keep]
    known = ledger.join(age, "version")
    best = known.groupBy("year", "month").agg(pick("version", "rank").alias("version"))
    return _null_safe(ledger, best, ["year", "month", "version"])


def _null_safe(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``left`` that ``right`` has a key for; null equals null."""
    named = right.select(*[F.col(k).alias(f"_{k}_") for k in keys])
    same = [left[k].eqNullSafe(F.col(f"_{k}_")) for k in keys]
    return left.join(named, same, "left_semi")


def read_months(spark: SparkSession, path: str, keep: str = "newest") -> DataFrame:
    """All rows of one version of each month: the ``newest`` that was loaded or the ``first``.

    The choice reads the ledger only, a row per (month, version, batch). Rows of batches without a ledger entry do not count.
    """
    rows = spark.read.option("basePath", f"{path}/rows").parquet(f"{path}/rows").drop("_year", "_month")
    rows = rows.withColumn("run", F.col("run").cast("string"))
    wanted = chosen_loads(read_ledger(spark, path), keep)
    return _null_safe(rows, wanted, ["run", "batch", "year", "month", "version"]).drop("run", "batch", "version")


def append_new_months(incoming: DataFrame, path: str) -> None:
    """Add months the target does not have; a second run adds nothing.

    Each new month appears as one renamed partition folder, so after a failure a month is there
    as a whole or not at all, and a repeated run brings the missing ones.
    """
    spark = incoming.sparkSession
    loaded = try_read(lambda: spark.read.parquet(path))
    replace_months(incoming if loaded is None else new_months(incoming, loaded), path)
