"""Near-duplicate embeddings by collision counting over sorted projections.

Each of ``tables`` one-dimensional Gaussian projections is sorted, and a vector meets those that lie in a window around it. So that windows
stay short whatever the number of vectors, the sorted line of a table is cut into cells by ``cuts`` further
projections: a collision is the same cell and a distance of at most ``window`` on the line. A pair at the threshold collides in a table
with a known probability ``q``, so its collisions are binomial, and the count that a pair must reach is the largest one that
such a pair reaches with probability ``RECALL``. Pairs that pass are verified by cosine in double precision.

No pair is ever a row. A task takes the vectors of some cells, works out all their collisions, keeps a pair only in
the first table in which it collides, and returns one row for each vector: its links there and the smallest vector it is
joined with. Cells with many vectors are cut into blocks that meet two by two. Equal vectors are one vector with a weight.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Stage, components, mix

#: Probability that a pair at the threshold is verified, at least; vectors in a cell that are aimed at; in a block; in a task.
RECALL, CELL, BLOCK, TASK = 0.9999, 64, 1024, 4096


def _normal(x: float) -> float:
    return 0.5 * (1 + math.erf(x / math.sqrt(2)))


def same_cell(ratio: float) -> float:
    """Chance that two points fall into one cell of a Gaussian projection: cell width over their distance is ``ratio``."""
    return 1 - 2 * _normal(-ratio) - 2 / (math.sqrt(2 * math.pi) * ratio) * (1 - math.exp(-ratio * ratio / 2))


def at_least(count: int, tables: int, q: float) -> float:
    return 1 - sum(math.comb(tables, i) * q**i * (1 - q) ** (tables - i) for i in range(count))


@dataclass(frozen=True)
class Plan:
    """Widths, cuts, tables and the calibrated count for a cosine and a number of vectors."""

    cosine: float
    width: float
    window: float
    cuts: int
    tables: int
    count: int

    @classmethod
    def of(cls, cosine: float, vectors: int) -> Plan:
        distance = math.sqrt(2 - 2 * cosine)
        width, window = 4 * distance, 2 * distance
        apart = same_cell(width / math.sqrt(2))
        cuts = max(1, math.ceil(math.log(max(2.0, vectors / CELL)) / -math.log(apart)))
        q = same_cell(4.0) ** cuts * (2 * _normal(2.0) - 1)
        tables = next(t for t in range(4, 1 << 20) if at_least(2, t, q) >= RECALL)
        count = max(c for c in range(1, tables + 1) if at_least(c, tables, q) >= RECALL)
        return cls(cosine, width, window, cuts, tables, count)

    def project(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cell names and places on the line of unit vectors, by table."""
        rng = np.random.default_rng(20_240_607)
        axes = rng.normal(size=(self.tables, self.cuts + 1, units.shape[1]))
        shift = rng.uniform(0, self.width, size=(self.tables, self.cuts))
        values = np.einsum("vd,tkd->vtk", units, axes, optimize=True)
        cut = np.floor((values[:, :, : self.cuts] + shift) / self.width).astype(np.int64).view(np.uint64)
        names = np.broadcast_to(np.arange(self.tables, dtype=np.uint64), cut.shape[:2]).copy()
        for c in range(self.cuts):
            names = mix(names * np.uint64(0x9E3779B97F4A7C15) + cut[:, :, c])
        return names, values[:, :, self.cuts]


def _matrix(column: pa.ChunkedArray | pa.Array, size: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)


def _units(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def _placer(plan: Plan):
    def run(batches):
        for batch in batches:
            sizes = batch.column("size").to_numpy()
            for size in np.unique(sizes):
                part = batch.filter(pa.array(sizes == size))
                for a in range(0, len(part), 2048):
                    some = part.slice(a, 2048)
                    names, _ = plan.project(_units(_matrix(some.column("vector"), int(size))))
                    label = some.column("space").to_numpy().astype(np.uint64)
                    cells = mix(names + mix(label)[:, None]).view(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [some.column("uid"), pa.ListArray.from_arrays(
                            pa.array(np.arange(0, cells.size + 1, plan.tables), pa.int32()), pa.array(cells.ravel()))],
                        names=["uid", "cells"])
    return run


def _linker(plan: Plan):
    def pairs(line: np.ndarray, first: np.ndarray, second: np.ndarray, same: bool):
        """Pairs of members within the window of each other, query by query, some 100,000 at a time."""
        second = second[np.argsort(line[second], kind="stable")]
        low = np.searchsorted(line[second], line[first] - plan.window, "left")
        many = np.searchsorted(line[second], line[first] + plan.window, "right") - low
        start = 0
        while start < len(first):
            stop = start + max(1, int(np.searchsorted(np.cumsum(many[start:]), 100_000)))
            m = many[start:stop]
            a = np.repeat(first[start:stop], m)
            b = second[np.repeat(low[start:stop] - np.concatenate(([0], np.cumsum(m)[:-1])), m) + np.arange(m.sum())]
            yield (a[a < b], b[a < b]) if same else (a, b)
            start = stop

    def run(table: pa.Table) -> pa.Table:
        uid, copies = table.column("uid").to_numpy(), table.column("copies").to_numpy()
        units = _units(_matrix(table.column("vector"), table.column("size")[0].as_py()))
        names, lines = plan.project(units)
        number, side, cell = table.column("t").to_numpy(), table.column("side").to_numpy(), table.column("cell").to_numpy()
        root, links = np.arange(len(uid)), np.zeros(len(uid), np.int64)
        ends_a, ends_b = [], []
        order = np.argsort(cell, kind="stable")
        for members in np.split(order, np.flatnonzero(np.diff(cell[order])) + 1):
            t = number[members[0]]
            halves = members[side[members] == 0], members[side[members] == 1]
            two = bool(len(halves[1]))
            for a, b in pairs(lines[:, t], halves[0], halves[1] if two else halves[0], not two):
                met = (names[a] == names[b]) & (np.abs(lines[a] - lines[b]) <= plan.window)
                asked = (met.sum(axis=1) >= plan.count) & (met.argmax(axis=1) == t) & met[:, t]
                a, b = a[asked], b[asked]
                near = np.einsum("ij,ij->i", units[a], units[b]) >= plan.cosine
                a, b = a[near], b[near]
                np.add.at(links, a, copies[b])
                np.add.at(links, b, copies[a])
                ends_a.append(a)
                ends_b.append(b)
        a, b = np.concatenate(ends_a or [root[:0]]), np.concatenate(ends_b or [root[:0]])
        # a vector may be here for several tables: its rows are one node
        _, first, inverse = np.unique(uid, return_index=True, return_inverse=True)
        while len(a):
            before = root.copy()
            for x, y in ((a, b), (b, a)):
                np.minimum.at(root, x, root[y])
            root = np.minimum(root, root[root])
            shared = np.full(len(first), len(uid))
            np.minimum.at(shared, inverse, root)
            root = shared[inverse]
            if (root == before).all():
                break
        return pa.table({"uid": pa.array(uid), "links": pa.array(links), "root": pa.array(uid[root])}).filter(pa.array(links > 0))
    return run


def near_embeddings(df: DataFrame, cosine: float = 0.98, vector: str = "embedding", label: str = "label", id: str = "vec_id") -> DataFrame:
    """One row for each row of ``df``: id, ``n_links``, ``component_id``, ``kept``.

    Vectors of one label (not null) and one length link at ``cosine`` or more. Vectors that are null, empty or zero, or hold null or
    non-finite components, and rows without label link with nothing. Equal vectors link with each other. ``component_id`` is
    the smallest id that links reach, nulls only where there is no other; ``kept`` is ``id = component_id`` (nulls equal).
    Repeated rows count as rows. An empty table gives an empty table. Other columns are not read.
    """
    stage = Stage(df.sparkSession, "embeddings")
    kind = df.schema[vector].dataType.elementType.simpleString()
    rows = df.select(F.col(f"`{id}`").alias("id"), F.col(f"`{vector}`").alias("vector"), F.col(f"`{label}`").alias("label"))
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    good = F.coalesce(F.col("label").isNotNull() & (F.size("vector") > 0) & ~bad & F.exists("vector", lambda x: x != 0), F.lit(False))
    sound = rows.where(good)
    reps = stage.keep(sound.groupBy("label", "vector").agg(F.count(F.lit(1)).alias("copies"), F.min("id").alias("least")).withColumns({
        "uid": F.monotonically_increasing_id(), "size": F.size("vector"), "space": F.xxhash64("label", F.size("vector"))}), "vectors")
    most = reps.groupBy("space").count().agg(F.max("count")).first()[0] or 0
    plan = Plan.of(cosine, most)

    placed = stage.keep(reps.select("uid", "vector", "size", "space").mapInArrow(_placer(plan), "uid long, cells array<long>"), "cells")
    members = placed.select("uid", F.posexplode("cells").alias("t", "cell"))
    full = members.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    here = members.join(full, "cell").withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
    tasks = max(1, reps.count() * plan.tables // TASK)
    own = F.pmod(F.xxhash64("uid", F.lit(3)), "blocks").cast("int")
    whole = here.where("blocks = 1").select("uid", "t", "cell", F.pmod(F.xxhash64("cell"), F.lit(tasks)).alias("g"),
                                            F.lit(0).alias("i"), F.lit(0).alias("j"), F.lit(0).alias("side"))
    cut = here.where("blocks > 1").withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cut = cut.select("uid", "t", "cell", F.col("cell").alias("g"), F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                     (F.col("own") > F.col("other")).cast("int").alias("side"))
    dealt = whole.union(cut).join(reps.select("uid", "copies", "size", "vector"), "uid")
    found = stage.keep(dealt.groupBy("g", "i", "j", "size").applyInArrow(_linker(plan), "uid long, links long, root long"), "links")

    roots = components(found.select(F.col("uid").alias("a"), F.col("root").alias("b")), stage)
    sums = found.groupBy("uid").agg(F.sum("links").alias("links"))
    known = reps.select("uid", "label", "vector", "copies", "least").join(sums, "uid", "left").join(
        roots, F.col("uid") == F.col("node"), "left").withColumn("root", F.coalesce("root", "uid"))
    known = stage.keep(known.select("label", "vector", "root", "least", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "known")
    names = known.groupBy("root").agg(F.min("least").alias("component_id"))
    answers = stage.keep(known.join(names, "root").select("label", "vector", "n_links", "component_id"), "answers")
    some = sound.join(answers, ["label", "vector"]).select("id", "n_links", "component_id")
    none = rows.where(~good).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return some.union(none).select(F.col("id").alias(id), "n_links", "component_id",
                                   F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def op3_near_embeddings(spark, sf_dir: str) -> DataFrame:
    """Links of all embeddings of equal labels at cosine 0.98."""
    return near_embeddings(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
