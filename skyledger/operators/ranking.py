"""First-per-key, top-k and dense ordinals without a single-task sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.storage import cut_lineage, staged


def top_per_key(df: DataFrame, keys: list[str], order: list[Column], k: int = 1,
                rank: str | None = None) -> DataFrame:
    """First ``k`` rows of every key.

    The rank filter lets Spark cut each group to ``k`` rows before the shuffle, so a hot key sends
    at most ``k`` rows per map task. ``rank`` keeps the 1-based position under that name.
    """
    name = rank or "_rank"
    ranked = df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    kept = ranked.where(F.col(name) <= k)
    return kept if rank else kept.drop(name)


def dense_ids(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """1-based dense ordinal in sorted order, computed on all executors.

    Rows are range-partitioned and sorted within their slice. The checkpoint fixes that layout, so
    the two readers below agree. A row's ordinal is its place in the slice plus the number of rows
    in earlier slices; only one count per slice meets in a single task.
    """
    slices = cut_lineage(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id())
    ).withColumn("_slice", F.shiftright("_place", 33))
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        slices.groupBy("_slice").agg(F.count(F.lit(1)).alias("_n"))
        .select("_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    # one row of two numbers per slice
    numbered = slices.join(F.broadcast(offsets), "_slice")
    in_slice = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    return numbered.select(*df.columns, (F.col("_offset") + in_slice + 1).cast("int").alias(name))


def label_encode(df: DataFrame, column: str, code: str, null_label: str) -> DataFrame:
    """0-based code of each label in sorted label order; nulls count as ``null_label``.

    The label table is a stage table, so it is broadcast only while it is small.
    """
    label = F.coalesce(F.col(column), F.lit(null_label))
    labels = dense_ids(df.select(label.alias("_label")).distinct(), ["_label"], "_id")
    codes = staged(labels.select("_label", (F.col("_id") - 1).alias(code)), "labels")
    return df.withColumn("_label", label).join(codes, "_label", "left").drop("_label")


def longest_increasing_run(df: DataFrame, keys: list[str], pos: str, value: str,
                           stretch: int = 1 << 16) -> DataFrame:
    """First longest strictly increasing run of consecutive values, per key.

    Returns ``keys, run_start, run_end, run_length`` with positions of the first and last element.
    A run ends where a value is not above its predecessor.

    Each key's sequence is cut into stretches of ``stretch`` positions that are worked on in
    parallel. A run inside one stretch is final there; only a stretch's first and last run can
    reach over its edge. So at most three candidate runs per stretch meet for the joining step, and
    a key holding most of the rows is spread over many tasks.
    """
    cut = df.select(*keys, F.col(pos).alias("_pos"), F.col(value).alias("_val")).withColumn(
        "_part", F.floor(F.col("_pos") / stretch)
    )
    inside = Window.partitionBy(*keys, "_part").orderBy("_pos")
    runs = (
        cut.withColumn("_new", (F.col("_val") <= F.lag("_val").over(inside)).cast("int"))
        .withColumn("_run", F.sum(F.coalesce("_new", F.lit(0))).over(inside))
        .groupBy(*keys, "_part", "_run")
        .agg(
            F.min("_pos").alias("_start"), F.max("_pos").alias("_end"),
            F.count(F.lit(1)).alias("_len"),
            F.min_by("_val", "_pos").alias("_first"), F.max_by("_val", "_pos").alias("_last"),
        )
    )
    part = Window.partitionBy(*keys, "_part")
    edges = runs.withColumns({
        "_lead": F.col("_run") == F.min("_run").over(part),
        "_tail": F.col("_run") == F.max("_run").over(part),
        "_best": F.row_number().over(part.orderBy(F.desc("_len"), "_start")) == 1,
    }).where(F.col("_lead") | F.col("_tail") | F.col("_best"))

    along = Window.partitionBy(*keys).orderBy("_start")
    # Only the first run of a stretch can go on from the run before it.
    goes_on = F.col("_lead") & (F.col("_first") > F.lag("_last").over(along))
    joined = (
        edges.withColumn("_breaks", F.coalesce(~goes_on, F.lit(True)).cast("int"))
        .withColumn("_chain", F.sum("_breaks").over(along))
        .groupBy(*keys, "_chain")
        .agg(F.min("_start").alias("run_start"), F.max("_end").alias("run_end"),
             F.sum("_len").alias("run_length"))
        .drop("_chain")
    )
    return top_per_key(joined, keys, [F.desc("run_length"), F.asc("run_start")])
