"""Exact duplicates by distributed most-significant-digit radix partitioning.

A digit is a run of successive bytes; the runs grow eightfold from level to level (64, 512, 4096, ...), so the
longest text decides the number of levels only by its logarithm. On each level documents that share a group and
the next digit form a new group. A group with one member is done. A group whose digit ended the text is
done too: its members are equal, byte for byte, and no digest was needed. All other groups go on to
the next level with the rest of their texts; only they are read there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Stage, lower_ascii

FIRST, GROWTH = 64, 8


def _folded(digit: Column) -> Column:
    """A digit with A-Z lower-cased. Bytes of letters beyond ASCII are never in that range, so this is safe byte by byte."""
    return lower_ascii(F.decode(digit, "ISO-8859-1"))


def exact_dedup(df: DataFrame, text: str = "text", rank: str = "doc_id", carry: list[str] | None = None) -> DataFrame:
    """Rows of ``df`` with ``keep_id``, ``group_size`` and ``kept``.

    Rows whose texts are equal but for the case of A-Z form a group; null counts as empty. The row with the largest ``rank``
    stays (``keep_id``; null only if the whole group has no rank). If that rank is repeated, as
    in repeated rows, one of them stays. ``carry`` names the columns to return (default all); columns of the
    operator's own names are replaced. An empty table gives an empty table.

    Level 0 sends each document once to the group of its first 64 bytes. Counts are combined before
    the shuffle, and the join of documents with counts is one whose hot keys adaptive execution splits. The table
    of shared digits grows with the documents, so it is never broadcast.
    """
    own = ("keep_id", "group_size", "kept")
    stage = Stage(df.sparkSession, "exact-dedup")
    carry = [c for c in (df.columns if carry is None else carry) if c.lower() not in own]
    kept = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(carry)]
    named = [F.col(f"row.c{i}").alias(c) for i, c in enumerate(carry)]
    inside = text in carry
    rows = df.select(F.struct(*kept, F.lit(0).alias("_")).alias("row"), F.col(f"`{rank}`").alias("rank"),
                     *([] if inside else [F.col(f"`{text}`").alias("text")]))
    content = F.coalesce(F.col(f"row.c{carry.index(text)}") if inside else F.col("text"), F.lit("")).cast("binary")

    def result(part: DataFrame, keep: Column, size: Column, stays: Column) -> DataFrame:
        return part.select(*named, keep.alias("keep_id"), size.cast("long").alias("group_size"), stays.alias("kept"))

    # Level 0: the narrow side finds the shared digits, the documents follow once.
    zero = rows.withColumn("digit", _folded(F.substring(content, 1, FIRST)))
    shared = zero.groupBy("digit").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    # a digit is looked at again with the rows' numbers, which name the groups from then on
    level0 = stage.keep(zero.join(shared.hint("merge"), "digit", "left").select(
        "row", "rank", F.when(F.col("size").isNotNull(), content).alias("rest"), F.lit(0).cast("long").alias("group"),
        F.monotonically_increasing_id().alias("uid"), F.col("size").isNotNull().alias("more")), "level0", by="more")
    everything = result(level0.where("NOT more"), F.col("rank"), F.lit(1), F.lit(True))
    active, level, width = level0.where("more").drop("more"), 0, FIRST
    while not active.isEmpty():
        cut = active.withColumns({"raw": F.substring("rest", 1, width)})
        cut = cut.withColumns({"digit": _folded(F.col("raw")), "ended": F.octet_length("raw") < width}).drop("raw")
        found = cut.groupBy("group", "digit").agg(
            F.count(F.lit(1)).alias("size"), F.max("rank").alias("keep"), F.min("uid").alias("name"),
            F.max(F.struct("rank", "uid")).alias("best")).where("size > 1")
        joined = cut.join(found.hint("merge"), ["group", "digit"], "left")
        onward = F.col("size").isNotNull() & ~F.col("ended")
        after = stage.keep(joined.select(
            "row", "rank", "uid", "size", "keep", "best", F.col("name").alias("group"),
            F.when(onward, F.substring("rest", width + 1, 2**31 - 1)).alias("rest"), onward.alias("more")), f"level{level + 1}", by="more")
        stage.drop(f"level{level}", part="/more=true")
        alone = F.col("size").isNull()
        everything = everything.union(result(
            after.where("NOT more"), F.when(alone, F.col("rank")).otherwise(F.col("keep")),
            F.coalesce("size", F.lit(1)), alone | (F.col("uid") == F.col("best.uid"))))
        active = after.where("more").select("row", "rank", "uid", "group", "rest")
        level, width = level + 1, width * GROWTH
    return everything


def op7_exact_dedup(spark, sf_dir: str) -> DataFrame:
    """Every document with the document that stays for its text."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    digest = F.sha2(lower_ascii(F.coalesce("text", F.lit(""))), 256)
    rows = docs.select("doc_id", "text", digest.alias("text_sha256"))
    return exact_dedup(rows, carry=["doc_id", "text_sha256"]).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP7_SQL = """
WITH t AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
  FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY norm) AS kept, sha256(norm) AS text_sha256
FROM t
"""
