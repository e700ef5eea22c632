"""Variable-capacity best-fit packing of documents into training sequences.

Several sequence lengths are permitted. Pieces are placed longest first; a piece goes to the open bin that it fills best, of whatever
length. If none has room, the bin size that costs least per token among those that hold the piece is opened. At the end
every bin is cut down to the smallest permitted length that holds its contents, so short leftovers do not pay for long
sequences. Documents longer than the largest length are cut into pieces of that length; only the last one is shorter.

Rows are dealt at random (by a hash of their content) into groups of about ``GROUP`` pieces, and each group is packed
by itself: best fit over thousands of pieces wastes as little as over all of them, and no task sees more than a group.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import without

GROUP = 5_000
#: Copies of one row that are dealt together.
COPIES = 1_000
INNER = ("_group", "_hash", "_id", "_copies")


def best_fit(sizes: list[int], lengths: list[int], costs: list[float]) -> tuple[list[int], list[int], list[int]]:
    """Bin and offset of each size (in the given order, longest first is best), and the final length of each bin."""
    order = sorted(range(len(lengths)), key=lambda i: (costs[i] / lengths[i], -lengths[i]))
    rooms: list[tuple[int, int]] = []
    filled: list[int] = []
    opened: list[int] = []
    bins, offsets = [], []
    for size in sizes:
        at = bisect_left(rooms, (size, -1))
        if at < len(rooms):
            room, b = rooms.pop(at)
        else:
            b, room = len(filled), lengths[next(i for i in order if lengths[i] >= size)]
            filled.append(0)
            opened.append(room)
        bins.append(b)
        offsets.append(filled[b])
        filled[b] += size
        if room > size:
            insort(rooms, (room - size, b))
    by_cost = sorted(range(len(lengths)), key=lambda i: (costs[i], lengths[i]))
    final = [lengths[next(i for i in by_cost if lengths[i] >= n)] for n in filled]
    return bins, offsets, final


def _packer(lengths: list[int], costs: list[float]):
    def run(table: pa.Table) -> pa.Table:
        copies = table.column("_copies").to_numpy()
        table = table.take(pa.array(np.repeat(np.arange(len(copies)), copies)))
        table = table.sort_by([("tokens", "descending"), ("_id", "ascending"), ("_hash", "ascending"), ("piece", "ascending")])
        bins, offsets, final = best_fit(table.column("tokens").to_pylist(), lengths, costs)
        group = table.column("_group")[0].as_py()
        extra = {
            "bin_id": pa.array([(group << 32) + b for b in bins], pa.int64()), "bin_offset": pa.array(offsets, pa.int64()),
            "bin_length": pa.array([final[b] for b in bins], pa.int64())}
        kept = table.drop_columns(list(INNER))
        for name, column in extra.items():
            kept = kept.append_column(name, column)
        return kept
    return run


def pack(df: DataFrame, tokens: str, id: str, lengths: list[int], costs: list[float] | None = None) -> DataFrame:
    """One row for each piece of each row of ``df``: its columns, ``piece``, ``piece_start``, ``tokens``, ``bin_id``,
    ``bin_offset``, ``bin_length``.

    ``tokens`` names the column with the length of a row; null, zero and negative lengths count as one token (the
    end mark). ``costs`` are those of a bin of each length (default: the length, so that the padding is least).
    The pieces of a row stay in order but may lie in different bins. Repeated rows are packed once each. Ties are broken
    by id (nulls last) and content. Columns of ``df`` with the operator's names are replaced. An empty table gives an empty table.
    """
    own = ("piece", "piece_start", "bin_id", "bin_offset", "bin_length")
    if not lengths or min(lengths) < 1:
        raise ValueError("lengths must be positive")
    if costs is not None and len(costs) != len(lengths):
        raise ValueError("one cost for each length")
    largest = max(lengths)
    df = without(df, *own, *INNER)
    plain = [c for c in df.columns if c.lower() != "tokens"]
    length = F.coalesce(F.col(f"`{tokens}`").cast("long"), F.lit(1))
    rows = df.select(*[F.col(f"`{c}`") for c in plain], F.greatest(length, F.lit(1)).alias("_size"))
    last = F.floor((F.col("_size") - 1) / largest).cast("long")
    many = rows.agg(F.coalesce(F.sum(last + 1), F.lit(0))).first()[0]
    groups = max(1, many // GROUP)
    # equal rows are combined before the shuffle and dealt in runs, so that a row repeated without end is spread
    runs = rows.groupBy(*[F.col(f"`{c}`") for c in rows.columns]).agg(F.count(F.lit(1)).alias("_all")).withColumn(
        "_run", F.explode(F.sequence(F.lit(0), F.floor((F.col("_all") - 1) / COPIES).cast("int"))))
    cut = runs.withColumns({
        "_copies": F.least(F.lit(COPIES), F.col("_all") - F.col("_run") * COPIES).cast("int"), "_id": F.col(f"`{id}`"),
        "_hash": F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns]), "piece": F.explode(F.sequence(F.lit(0).cast("long"), last))})
    dealt = cut.withColumns({
        "piece_start": F.col("piece") * largest, "tokens": F.least(F.lit(largest).cast("long"), F.col("_size") - F.col("piece") * largest),
        "_group": F.pmod(F.xxhash64("_hash", "piece", "_run"), F.lit(groups))}).drop("_size", "_all", "_run")
    types = {f.name: f.dataType.simpleString() for f in dealt.schema}
    kept = [c for c in dealt.columns if c not in INNER]
    schema = ", ".join(f"`{c}` {types[c]}" for c in kept) + ", bin_id long, bin_offset long, bin_length long"
    return dealt.groupBy("_group").applyInArrow(_packer(list(lengths), list(costs or lengths)), schema)


#: Permitted sequence lengths of the registered query and the pipeline, in bytes.
LENGTHS = [1024, 2048, 4096, 8192]
#: Costs of a sequence of each length there: a fixed part, one that grows with the length, and attention, which grows with its square.
#: A token is cheapest at 4,096 and dearest at 1,024.
COSTS = [1024 + length + length * length / 16384 for length in LENGTHS]


def with_tokens(docs: DataFrame) -> DataFrame:
    """Byte-level tokens of each text and one end mark."""
    return docs.withColumn("tokens", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1)


def op10_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    """All documents in sequences of 1 to 8 KB of byte-level tokens: where each piece of a text lies."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return pack(with_tokens(docs).drop("text"), "tokens", "doc_id", LENGTHS, COSTS)
