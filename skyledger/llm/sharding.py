"""Reproducible shuffle into shards: a Feistel permutation over global row numbers.

Rows are numbered 0..n-1 in an order that follows from their content alone, so neither file layout
nor cluster size changes a number. The permutation of [0, n) is a keyed Feistel network over the
grid ``a x b`` with ``a = ceil(sqrt(n))`` and ``b = ceil(n / a)``; a value that falls outside [0, n) is
encrypted again until it falls inside (cycle walking). Place ``p`` goes to shard ``p mod shards`` at
slot ``p div shards``: both can be computed from a row number, and a row number from both, without a table.

Everything is DataFrame functions.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import without

ROUNDS = 6
#: Encryptions of one value at most. A grid has fewer than sqrt(n) values outside [0, n), and a walk
#: meets each of them at most once: up to n = 4096 the limit cannot be met; beyond, the chance of meeting
#: it is below (1 / sqrt(n)) ** 64 a row. A row that met it would raise, not be misplaced.
WALK = 64
#: Copies of one row that are numbered together.
COPIES = 10_000


def grid(rows: int) -> tuple[int, int]:
    a = max(1, math.isqrt(max(rows - 1, 0)) + 1)
    return a, max(1, -(-rows // a))


def _encrypt(p: Column, a: int, b: int, seed: int, back: bool = False) -> Column:
    """One pass of the network over the grid. Rounds change the two halves in turn."""
    def step(state: Column, i: Column) -> Column:
        left, right = state["l"], state["r"]
        sign = -1 if back else 1
        moved_left = F.pmod(left + sign * F.pmod(F.xxhash64(F.lit(seed), i, right), F.lit(a)), F.lit(a))
        moved_right = F.pmod(right + sign * F.pmod(F.xxhash64(F.lit(seed), i, left), F.lit(b)), F.lit(b))
        odd = i % 2 == 1
        return F.struct(F.when(odd, moved_left).otherwise(left).cast("long").alias("l"),
                        F.when(odd, right).otherwise(moved_right).cast("long").alias("r"))

    order = range(ROUNDS, 0, -1) if back else range(1, ROUNDS + 1)
    start = F.struct((p % a).cast("long").alias("l"), ((p - p % a) / a).cast("long").alias("r"))
    return F.aggregate(F.array(*[F.lit(i) for i in order]), start, step, lambda s: s["r"] * a + s["l"])


def permuted(number: Column, rows: int, seed: int, back: bool = False) -> Column:
    """Place of a row number after the shuffle; with ``back`` the row number of a place."""
    a, b = grid(rows)
    first = _encrypt(number, a, b, seed, back)
    walked = F.aggregate(
        F.sequence(F.lit(1), F.lit(WALK)), first,
        lambda p, _: F.when(p < rows, p).otherwise(_encrypt(p, a, b, seed, back)))
    inside = F.when(walked < rows, walked).otherwise(F.raise_error(F.lit("cycle walk too long: take another seed")))
    return F.when(first < rows, first).otherwise(inside.cast("long"))


def place(number: Column, rows: int, shards: int, seed: int) -> tuple[Column, Column]:
    """Shard and slot of a row number."""
    p = permuted(number, rows, seed)
    return (p % shards).cast("int"), ((p - p % shards) / shards).cast("long")


def number_at(shard: Column, slot: Column, rows: int, shards: int, seed: int) -> Column:
    """The row number that ``place`` put at this shard and slot."""
    return permuted(slot.cast("long") * shards + shard, rows, seed, back=True)


def number_rows(df: DataFrame, rows: int, name: str = "row_number") -> DataFrame:
    """``df`` with a number from 0 that follows from the content of the rows.

    Equal rows are combined before the shuffle and dealt in runs of ``COPIES``, so rows repeated without
    end spread like any others. Runs fall into buckets by hash; a number is the bucket's offset plus
    the place in the bucket. Only one total per bucket (about 100,000 rows) meets in a single task.
    """
    df = without(df, name)
    columns = [F.col(f"`{c}`") for c in df.columns]
    buckets = max(1024, rows // 100_000)
    runs = (
        df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_copies"))
        .withColumn("_run", F.explode(F.sequence(F.lit(0), F.floor((F.col("_copies") - 1) / COPIES).cast("int"))))
        .withColumn("_here", F.least(F.lit(COPIES), F.col("_copies") - F.col("_run") * COPIES))
        .withColumn("_hash", F.xxhash64(*columns, "_run"))
        .withColumn("_bucket", F.pmod("_hash", F.lit(buckets)))
    )
    sortable = [c for c, kind in df.dtypes if "map<" not in kind and "variant" not in kind]
    inside = Window.partitionBy("_bucket").orderBy("_hash", *[F.col(f"`{c}`") for c in sortable], "_run")
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = runs.groupBy("_bucket").agg(F.sum("_here").alias("_rows")).select(
        "_bucket", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    ranked = runs.withColumn("_first", F.sum("_here").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_here"))
    return ranked.join(offsets, "_bucket").select(
        *columns, F.explode(F.sequence(F.lit(0), (F.col("_here") - 1).cast("int"))).alias("_i"), "_first", "_offset",
    ).select(*columns, (F.col("_offset") + F.col("_first") + F.col("_i")).cast("long").alias(name))


def shard(df: DataFrame, shards: int, seed: int = 0) -> DataFrame:
    """Rows of ``df`` with ``shard`` and ``slot``; shard sizes differ by one row at most.

    The result is the same for the same rows, shard count and seed. Repeated rows each get a place of their
    own; nulls, empty and long values are values like others. Columns of ``df`` named ``shard``, ``slot`` or ``row_number``
    are replaced. An empty table gives an empty table.
    """
    if shards < 1:
        raise ValueError("shards must be at least 1")
    df = without(df, "shard", "slot", "row_number")
    rows = df.count()
    to, slot = place(F.col("row_number"), rows, shards, seed)
    return number_rows(df, rows).withColumns({"shard": to, "slot": slot}).drop("row_number")


def op1_sharding(spark, sf_dir: str) -> DataFrame:
    """All documents over eight shards. A null text counts as empty: size 1, checksum 0."""
    text = F.coalesce("text", F.lit(""))
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    return shard(rows, 8, seed=42).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
