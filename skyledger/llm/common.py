"""What several operators need: stage tables, keys of texts, connected components, word hashes."""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.storage import fresh_path


class Stage:
    """Tables written to the shared folder, which a lost executor cannot take away.

    ``keep`` writes a table and reads it back; ``drop`` deletes one that no later step reads.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.label, self.paths = spark, label, {}

    def keep(self, df: DataFrame, name: str, by: str | None = None) -> DataFrame:
        """``by`` names a column whose values get folders of their own, which ``drop`` can take one by one."""
        path = fresh_path(self.spark, f"{self.label}-{name}")
        (df.write.partitionBy(by) if by else df.write).parquet(path)
        self.paths[name] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str, part: str = "") -> None:
        for name in names:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(self.paths[name] + part)
            conf = self.spark.sparkContext._jsc.hadoopConfiguration()
            path.getFileSystem(conf).delete(path, True)


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only; other letters stay as they are. ``translate`` runs only where it must."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def text_key(text: Column) -> Column:
    """16 bytes that stand for a text in joins; null counts as empty."""
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without columns of these names in any case, so that an operator may add its own."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def components(edges: DataFrame, stage: Stage) -> DataFrame:
    """Smallest member reachable from each end of ``edges`` (columns ``a``, ``b``): ``node, root``.

    Alternating large-star and small-star steps; each halves the depth of the trees at least, so the
    rounds follow the logarithm of the longest chain. A node's minimum is combined before the
    shuffle, and the join back on a hot node is one that adaptive execution may split. Nodes without
    an edge to another node are not returned.
    """
    def stars(pairs: DataFrame, both: bool) -> DataFrame:
        turned = pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))
        around = pairs.union(turned) if both else pairs
        least = around.groupBy("a").agg(F.min("b").alias("m"))
        least = least.select("a", F.least("a", "m").alias("m"))
        joined = around.join(least, "a")
        if both:
            return joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        own = least.select("a", F.col("m").alias("b"))
        return joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(own)

    def mark(table: DataFrame):
        return table.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()

    down = edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now, turn = stage.keep(down.distinct(), "edges0"), 0
    before = mark(now)
    while before[0]:
        large = stars(now, True).where("a != b").distinct()
        after = stage.keep(stars(large, False).where("a != b").distinct(), f"edges{turn + 1}")
        stage.drop(f"edges{turn}")
        now, turn, seen = after, turn + 1, mark(after)
        if seen == before:
            break
        before = seen
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def pieces(texts: list[bytes], limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Runs of texts (from, to) that hold about ``limit`` bytes each; at least one text."""
    start = held = 0
    for i, text in enumerate(texts):
        if i > start and held + len(text) > limit:
            yield start, i
            start, held = i, 0
        held += len(text)
    if start < len(texts):
        yield start, len(texts)


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: each output bit follows from all input bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
