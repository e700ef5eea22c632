"""Near-duplicate documents: fast similarity sketches, banding, exact verification.

A document is the set of its distinct word shingles. Its sketch has ``BINS`` coordinates, filled in rounds: in
round ``i`` every element is hashed into a bin with a value in [i, i + 1), and a bin keeps its least value. After
``BINS`` random rounds, round ``BINS + j`` throws every element into bin ``j``, so each coordinate fills. A
coordinate of two sketches agrees with probability equal to the Jaccard similarity, and their number is
concentrated as if all coordinates were independent. ``BANDS`` bands of ``BINS / BANDS`` coordinates name
buckets: a pair at similarity 0.8 shares none with probability (1 - 0.8 ** 4) ** 24 = 3e-6. A lower threshold gets more bands of
fewer coordinates, so that a pair on it is missed with probability ``MISS`` at most.

Pairs are never listed by bucket. Each bucket first compares its members with one of them, the one that meets most
others in all buckets, and links found are joined into components. Where that leaves several components in a bucket, the
members outside its largest component (the strays) are compared with its members in blocks: a task holds
about ``LEAD_BYTES`` of strays and ``BLOCK_BYTES`` of members, however many there are, counts common shingles through an index of its
block, and returns one link for each component that a stray reaches. Blocks go by classes of set size, and a stray meets only its own
class and the two beside it, since sets whose sizes are further apart cannot reach the threshold; members of classes that no stray
reaches are not moved. So every link between two components that a bucket can show is found, and no pair is a row before it is a
link. Within a class of a bucket, texts are sent once for each block of the other side: a bucket of many unlinked texts
of like size costs their bytes times the number of such blocks. Comparisons are exact, on the sets of whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Stage, components, mix, pieces, text_key, without

BINS, BANDS = 96, 24
#: Chance at most that a pair at the threshold shares no bucket; bands get fewer coordinates where it needs that.
MISS = 1e-5
LEAD_BYTES, BLOCK_BYTES = 1 << 20, 4 << 20
ROWS = 512
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], dtype=np.uint64)
_BASE = 0x5851F42D4C957F2D
_ALL = (1 << 64) - 1


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        steps = np.full(n, base, dtype=np.uint64)
        steps[0] = 1
        out.append(np.cumprod(steps, dtype=np.uint64))
    return out[0], out[1]


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts, A-Z lower-cased, and the number of words of each text."""
    joined = b" ".join(texts).lower()
    data = np.frombuffer(joined, dtype=np.uint8)
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.flatnonzero(np.diff(np.concatenate(([True], blank, [True])).astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    size = 1 << max(19, int(len(data)).bit_length())
    up, down = _powers(size)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    words = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * _ODD[4])
    begins = np.cumsum([0] + [len(t) + 1 for t in texts])
    return words, np.diff(np.searchsorted(starts, begins))


def shingle_sets(texts: list[bytes], k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts, one text after the other, and their numbers.

    A text of fewer than ``k`` words has its whole sequence as one shingle; one without words has none.
    """
    words, counts = word_hashes(texts)
    ends = np.cumsum(counts)
    starts = ends - counts
    sizes = np.where(counts >= k, counts - k + 1, (counts > 0).astype(np.int64))
    if not len(words):
        return np.zeros(0, np.uint64), sizes
    padded = np.concatenate((words, np.zeros(k, np.uint64)))
    rolled = sum((padded[j: j + len(words)] * _ODD[j] for j in range(k)), np.zeros(len(words), np.uint64))
    owner = np.repeat(np.arange(len(texts)), sizes)
    first = np.concatenate(([0], np.cumsum(sizes)))
    at = np.arange(first[-1]) - first[owner] + starts[owner]
    out = mix(rolled[at])
    for d in np.flatnonzero((counts > 0) & (counts < k)):
        whole = words[starts[d]: ends[d]]
        out[first[d]] = mix((whole * _ODD[: 1] * np.arange(3, 2 * len(whole) + 3, 2, dtype=np.uint64)).sum(keepdims=True)
                            + np.uint64(len(whole)))[0]
    for d in np.flatnonzero(sizes > 1):
        out[first[d]: first[d + 1]].sort()
    new = np.ones(len(out), dtype=bool)
    new[1:] = (out[1:] != out[:-1]) | (owner[1:] != owner[:-1])
    return out[new], np.bincount(owner[new], minlength=len(texts))


def sketches(sets: np.ndarray, sizes: np.ndarray, bins: int = BINS) -> np.ndarray:
    """One row of ``bins`` coordinates for each set; rows of empty sets stay at the largest value."""
    empty = np.uint64(0xFFFFFFFFFFFFFFFF)
    table = np.full((len(sizes), bins), empty)
    flat = table.ravel()
    owner = np.repeat(np.arange(len(sizes)), sizes)
    left = sets
    for turn in range(2 * bins):
        if not len(left):
            break
        value = mix(left + np.uint64((turn + 1) * int(_ODD[0]) & _ALL))
        if turn < bins:
            where = ((value >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)
        else:
            where = np.full(len(left), turn - bins)
        spot = owner * bins + where
        # a bin filled in an earlier round holds a lower value already
        open_ = flat[spot] >= np.uint64(turn << 32)
        np.minimum.at(flat, spot[open_], (value[open_] & np.uint64(0xFFFFFFFF)) | np.uint64(turn << 32))
        lacking = (table == empty).any(axis=1)
        more = lacking[owner]
        if not more.all():
            left, owner = left[more], owner[more]
    return table


def bands(table: np.ndarray, count: int = BANDS) -> np.ndarray:
    """Bucket names: a hash of the coordinates of each band and its number."""
    rows = table.shape[1] // count
    cut = mix(table).reshape(len(table), count, rows)
    return mix((cut * _ODD[:rows]).sum(axis=2, dtype=np.uint64) + np.arange(1, count + 1, dtype=np.uint64) * _ODD[5]).view(np.int64)


def band_count(percent: int) -> int:
    """Bands for a threshold: the fewest, from ``BANDS`` on, that keep to ``MISS``."""
    for rows in range(BINS // BANDS, 0, -1):
        if BINS % rows == 0 and 0 < percent <= 100 and (1 - (percent / 100) ** rows) ** (BINS // rows) <= MISS:
            return BINS // rows
    raise ValueError(f"percent must be at most 100 and high enough that {BINS} bins miss a pair with chance {MISS} at most: 12 or more")


def _texts(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches in slices of ``ROWS``, so that few texts at a time are Python objects."""
    for batch in batches:
        for a in range(0, len(batch), ROWS):
            yield batch.slice(a, ROWS)


def _sketcher(k: int, count: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            texts = _texts(batch.column("text"))
            for a, b in pieces(texts, 1 << 19):
                sets, sizes = shingle_sets(texts[a:b], k)
                names = bands(sketches(sets, sizes), count)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, (b - a + 1) * count, count), pa.int32()), pa.array(names.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(a, b - a), batch.column("key").slice(a, b - a), pa.array(sizes), lists],
                    names=["id", "key", "n", "buckets"])
    return run


def _verifier(k: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        @lru_cache(maxsize=32)
        def whole(text: bytes) -> np.ndarray:
            return shingle_sets([text], k)[0]

        for batch in _slices(batches):
            good = []
            for x, y in zip(_texts(batch.column("text_a")), _texts(batch.column("text_b")), strict=True):
                p, q = whole(x), whole(y)
                at = np.searchsorted(q, p)
                both = int((q[np.minimum(at, len(q) - 1)] == p).sum()) if len(p) and len(q) else 0
                good.append(both > 0 and 100 * both >= percent * (len(p) + len(q) - both))
            keep = pa.array(good, pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column("a").filter(keep), batch.column("b").filter(keep)], names=["a", "b"])
    return run


def _block(k: int, percent: int):
    def run(table: pa.Table) -> pa.Table:
        """Links between strays and members of one block that lead to another component."""
        table = table.combine_chunks()
        lead = table.column("lead").to_numpy(zero_copy_only=False).astype(bool)
        rids, roots = table.column("rid").to_numpy(), table.column("root").to_numpy()
        sets, sizes = [], []
        texts = _texts(table.column("text"))
        for a, b in pieces(texts, 1 << 19):
            s, n = shingle_sets(texts[a:b], k)
            sets.append(s)
            sizes.append(n)
        sets, sizes = np.concatenate(sets), np.concatenate(sizes)
        ends = np.cumsum(sizes)
        owner = np.repeat(np.arange(len(sizes)), sizes)
        member = ~lead[owner]
        order = np.argsort(sets[member], kind="stable")
        index, holder = sets[member][order], owner[member][order]
        out = []
        for x in np.flatnonzero(lead):
            own = sets[ends[x] - sizes[x]: ends[x]]
            low = np.searchsorted(index, own, "left")
            many = np.searchsorted(index, own, "right") - low
            at = np.repeat(low - np.concatenate(([0], np.cumsum(many)[:-1])), many) + np.arange(many.sum())
            common = np.bincount(holder[at], minlength=len(sizes))
            good = (common > 0) & (100 * common >= percent * (sizes[x] + sizes - common)) & (roots != roots[x])
            for root in np.unique(roots[good]):
                out.append((rids[x], rids[good & (roots == root)][0]))
        a, b = zip(*out, strict=True) if out else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})
    return run


def near_dedup(df: DataFrame, text: str = "text", id: str = "doc_id", k: int = 4, percent: int = 80) -> DataFrame:
    """For every row of ``df``: id, ``n_shingles``, ``component_id``, ``kept``, ``text_key`` (``common.text_key`` of its text).

    Documents are linked if their shingle sets (``k`` words, A-Z lower-cased, words apart by ASCII white space)
    share at least ``percent`` per cent of their union. ``component_id`` is the smallest id that links reach; null ids
    count only where a component has no other. ``kept`` is ``id = component_id`` (nulls equal). Null or
    empty texts have no shingles and are linked with nothing. A link at the threshold is missed with chance ``MISS`` at most; ``percent``
    too low for that raises an error. Rows with equal texts are linked and are compared
    as one. Repeated rows get equal answers. An empty table gives an empty table. Columns other than
    id and text are not read.

    """
    if not 2 <= k <= len(_ODD):
        raise ValueError(f"k must be from 2 to {len(_ODD)}")
    count = band_count(percent)
    spark = df.sparkSession
    stage = Stage(spark, "near-dedup")
    base = df.select(F.col(f"`{id}`").alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    base = base.withColumn("key", text_key(F.col("text")))
    id_type = df.schema[id].dataType.simpleString()

    # one pass over all texts; then one row per distinct text, numbered
    drawn = stage.keep(base.select("id", "key", "text").mapInArrow(
        _sketcher(k, count), f"id {id_type}, key binary, n long, buckets array<long>"), "sketches")
    reps = stage.keep(drawn.where("n > 0").dropDuplicates(["key"]).withColumn("rid", F.monotonically_increasing_id()), "texts")

    # buckets with several members, and how many others a member meets in all of them
    rows = reps.select("rid", "n", F.explode("buckets").alias("bucket"))
    shared = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    hits = stage.keep(rows.join(shared, "bucket").select("bucket", "rid", "n", "size"), "hits")
    degree = hits.groupBy("rid").agg(F.sum("size").alias("degree"))
    hits = stage.keep(hits.join(degree, "rid"), "ranked")
    stage.drop("hits")

    # texts that meet another one, read once
    involved = hits.select("rid").distinct().join(reps.select("rid", F.col("id").alias("_id"), F.col("key").alias("_key")), "rid")
    joined = base.join(involved, base["id"].eqNullSafe(F.col("_id")) & (base["key"] == F.col("_key")))
    texts = stage.keep(joined.select("rid", "text").dropDuplicates(["rid"]), "involved")

    # every bucket compares its members with one of them
    first = hits.groupBy("bucket").agg(F.max_by(F.struct("rid", "n"), F.struct("degree", F.negative("rid"))).alias("lead"))
    low, high = F.least("n", "lead.n"), F.greatest("n", "lead.n")
    pairs = hits.join(first, "bucket").where((F.col("rid") != F.col("lead.rid")) & (100 * low >= percent * high)).select(
        F.least("rid", "lead.rid").alias("a"), F.greatest("rid", "lead.rid").alias("b")).distinct()
    text_a, text_b = (texts.select(F.col("rid").alias(x), F.col("text").alias(f"text_{x}")) for x in "ab")
    links = stage.keep(pairs.join(text_a, "a").join(text_b, "b").select("a", "b", "text_a", "text_b")
                       .mapInArrow(_verifier(k, percent), "a long, b long"), "links1")

    # where several components remain in a bucket, strays meet all its members in blocks
    roots = stage.keep(components(links, stage), "roots1")
    placed = hits.join(roots, hits["rid"] == roots["node"], "left").select(
        "bucket", "rid", "n", F.coalesce("root", "rid").alias("root"))
    per_root = placed.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("size"))
    main = per_root.groupBy("bucket").agg(
        F.max_by("root", F.struct("size", F.negative("root"))).alias("main"), F.count(F.lit(1)).alias("roots"),
        F.sum("size").alias("all")).where("roots > 1 AND all > 2").select("bucket", "main")
    mixed = stage.keep(placed.join(main, "bucket").join(
        texts.select("rid", F.octet_length("text").alias("bytes")), "rid").withColumn("stray", F.expr("root != main")), "mixed")
    # linked sets lie in one class of sizes or in two that follow each other; classes are a trifle wide, for the rounding of logarithms
    sized = mixed.withColumn("class", F.floor(F.log("n") / F.log(F.lit(100 / percent * 1.0001))).cast("int"))
    leads = sized.where("stray").withColumn("class", F.explode(F.array(F.col("class") - 1, F.col("class"), F.col("class") + 1)))
    blocks = sized.groupBy("bucket", "class").agg(F.ceil(F.sum("bytes") / BLOCK_BYTES).cast("int").alias("member_blocks")).join(
        leads.groupBy("bucket", "class").agg(F.ceil(F.sum("bytes") / LEAD_BYTES).cast("int").alias("lead_blocks")), ["bucket", "class"])
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = lambda n, salt: F.pmod(F.xxhash64("rid", F.lit(salt)), n).cast("int")
    block = ["bucket", "class", "m", "s"]
    as_member = sized.join(blocks, ["bucket", "class"]).withColumns({"m": own("member_blocks", 0), "s": every("lead_blocks")}).select(
        *block, "rid", "root", F.lit(False).alias("lead"))
    as_lead = leads.join(blocks, ["bucket", "class"]).withColumns({"m": every("member_blocks"), "s": own("lead_blocks", 1)}).select(
        *block, "rid", "root", F.lit(True).alias("lead"))
    strays = stage.keep(as_member.union(as_lead).join(texts, "rid").groupBy(*block).applyInArrow(
        _block(k, percent), "a long, b long"), "links2")
    roots = stage.keep(components(links.union(strays), stage), "roots2")

    stage.drop("ranked", "involved", "mixed", "links1", "links2", "roots1")

    # answers for all rows: text -> component -> smallest id
    named = reps.select("key", "rid").join(roots, F.col("rid") == F.col("node"), "left").select(
        "key", F.coalesce("root", "rid").alias("root"))
    placed = stage.keep(drawn.where("n > 0").select("id", "key", "n").join(named, "key").select("id", "n", "root", "key"), "placed")
    least = placed.groupBy("root").agg(F.min("id").alias("component_id"))
    some = placed.join(least, "root").select("id", "n", "component_id", "key")
    none = drawn.where("n = 0").select("id", "n", F.col("id").alias("component_id"), "key")
    return some.union(none).select(
        F.col("id").alias(id), F.col("n").alias("n_shingles"), "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
        F.col("key").alias("text_key"))


def op8_near_dedup(spark, sf_dir: str) -> DataFrame:
    """Every document with its near-duplicate component at four words and similarity 0.8."""
    return near_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("text_key")
