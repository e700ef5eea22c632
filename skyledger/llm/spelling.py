"""Spelling variants: words one edit apart, found by search schemes over bidirectional FM-indexes.

A word is cut in two halves. Of two words that differ by one inserted, deleted or replaced letter, one half of the
first stands unchanged at its end of the second: as its beginning or as its ending. So there are two schemes.
Each starts in the middle of the word, matches one half exactly towards its end and its delimiter, and then turns
round and extends across the other half with at most one error, to the other delimiter. The index of a vocabulary is
the text ``|word|word|...|``; a state is the interval of suffix ranks of the matched piece, in the order of
suffixes and, kept in step, in that of reversed prefixes, so that a piece can grow at both ends.

The vocabulary is dealt to indexes by what has to be equal: scheme, length of the searching word, and its exact half.
A word lies in the groups of three lengths (its own and one more or less) per scheme and searches in one group per scheme. Groups are
hashed into blocks of about ``BLOCK`` words; a group beyond that is cut into parts, each searching word then visits all parts.
Block sizes so do not grow with the vocabulary. What leaves a block is one row per searching word, not its pairs.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Stage, lower_ascii

#: Entries of one index; (word, symbol) cells that a search step holds at once.
BLOCK, CELLS = 20_000, 1 << 20
LEAST_LENGTH, LEAST_COUNT, RATIO = 6, 5, 5


def _suffix_order(text: np.ndarray) -> np.ndarray:
    """Order of all rotations, by doubling the compared length."""
    rank, width = text.astype(np.int64), 1
    while True:
        key = rank * (len(text) + 1) + np.roll(rank, -width)
        order = np.argsort(key, kind="stable")
        fresh = np.concatenate(([0], np.cumsum(np.diff(key[order]) != 0)))
        rank = np.empty(len(text), np.int64)
        rank[order] = fresh
        width *= 2
        if fresh[-1] == len(text) - 1 or width > len(text):
            return order


class Ranks:
    """How often each symbol stands before a place of the Burrows-Wheeler transform, from bits and running counts."""

    def __init__(self, text: np.ndarray, symbols: int):
        self.order = _suffix_order(text)
        bwt = text[self.order - 1]
        size = -(-(len(text) + 1) // 64)
        bits = np.zeros((symbols, size * 64), bool)
        bits[bwt, np.arange(len(bwt))] = True
        self.words = np.packbits(bits, axis=1, bitorder="little").view(np.uint64)
        held = np.bitwise_count(self.words).astype(np.int32)
        self.before = np.cumsum(held, axis=1, dtype=np.int32) - held
        self.first = np.concatenate(([0], np.cumsum(np.bincount(bwt, minlength=symbols))[:-1])).astype(np.int64)

    def count(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        word = place >> 6
        low = (np.uint64(1) << (place & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[symbol, word].astype(np.int64) + np.bitwise_count(self.words[symbol, word] & low)

    def narrow(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Interval of the piece with ``symbol`` put before it."""
        return self.first[symbol] + self.count(symbol, lo), self.first[symbol] + self.count(symbol, hi)


class BidirectionalIndex:
    """FM-indexes of ``|word|word|...|`` read forwards and backwards; symbol 0 is the delimiter."""

    def __init__(self, words: list[str]):
        points = np.frombuffer("|".join(["", *words, ""]).encode("utf-32-le"), np.uint32)
        own = np.unique(np.frombuffer("".join(words).encode("utf-32-le"), np.uint32))
        self.points = own
        self.symbols = len(own) + 1
        lengths = np.array([len(w) for w in words])
        self.starts = np.concatenate(([0], np.cumsum(lengths + 1)))  # places of the delimiters
        text = np.searchsorted(own, points) + 1
        text[self.starts] = 0
        self.size = len(text)
        self.sides = Ranks(text, self.symbols), Ranks(text[::-1].copy(), self.symbols)

    def codes(self, words: list[str]) -> np.ndarray:
        """Symbols of words of one length; -1 for letters that the index does not hold."""
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), -1)
        at = np.minimum(np.searchsorted(self.points, points), len(self.points) - 1)
        return np.where(self.points[at] == points, at + 1, -1)

    def turn(self, side: int, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows whose ``codes`` (in the order of growth, then the delimiter) are matched exactly, and the intervals on the other side.

        Side 0 grows to the left, side 1 to the right. Both intervals are narrowed in step.
        """
        ranks = self.sides[side]
        rows = np.flatnonzero((codes >= 0).all(axis=1))
        lo, hi = np.zeros(len(rows), np.int64), np.full(len(rows), self.size, np.int64)
        other = lo.copy()
        for column in [*codes.T, np.zeros(len(codes), np.int64)]:
            c = column[rows]
            smaller = np.zeros(len(rows), np.int64)
            for x in range(int(c.max(initial=0))):
                at = np.flatnonzero(c > x)
                here = np.full(len(at), x)
                smaller[at] += ranks.count(here, hi[at]) - ranks.count(here, lo[at])
            lo, hi = ranks.narrow(c, lo, hi)
            other = other + smaller
            live = hi > lo
            rows, lo, hi, other = rows[live], lo[live], hi[live], other[live]
        return rows, other, other + hi - lo

    def across(self, side: int, codes: np.ndarray, rows: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (row, word) where the word goes on as ``codes`` with exactly one error, up to the delimiter."""
        ranks, length = self.sides[side], codes.shape[1]
        exact, wrong = (rows, lo, hi), tuple(np.zeros(0, np.int64) for _ in range(3))

        def put(state, symbol):
            row, a, b = state
            known = symbol >= 0
            row, a, b, symbol = row[known], a[known], b[known], symbol[known]
            a, b = ranks.narrow(symbol, a, b)
            live = b > a
            return row[live], a[live], b[live]

        def join(*states):
            return tuple(np.concatenate(x) for x in zip(*states, strict=True))

        for i in range(length + 1):
            row, a, b = exact
            every = np.tile(np.arange(1, self.symbols), len(row))
            spread = tuple(np.repeat(x, self.symbols - 1) for x in exact)
            more = put(spread, every)  # an inserted letter
            wrong = join(wrong, more)
            if i == length:
                break
            wrong = put(wrong, codes[wrong[0], i])
            # replaced letters (the right one comes along and is left out at the end), and the left-out letter
            wrong = join(wrong, more, exact)
            if len(wrong[0]) > 4 * len(rows) + 64:  # one error at several places of a run of equal letters is one state
                order = np.lexsort(wrong)
                wrong = tuple(x[order] for x in wrong)
                new = np.any([np.diff(x, prepend=-1) != 0 for x in wrong], axis=0)
                wrong = tuple(x[new] for x in wrong)
            exact = put(exact, codes[row, i])
        row, a, b = put(wrong, np.zeros(len(wrong[0]), np.int64))
        place = ranks.order[a] if side == 0 else self.size - 1 - ranks.order[a]
        # the piece starts with one delimiter and ends with the next: the first is the word's own
        word = np.searchsorted(self.starts, place) - (side == 1)
        return row, word


def near_words(queries: list[str], index: BidirectionalIndex, words: list[str], scheme: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, word) at one edit that share the beginning (scheme 0) or the ending but not the beginning (scheme 1)."""
    found_q, found_w = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    by_length: dict[int, list[int]] = {}
    for i, q in enumerate(queries):
        by_length.setdefault(len(q), []).append(i)
    for length, all_ids in sorted(by_length.items()):
        step = max(1, CELLS // max(length, index.symbols))
        half = length // 2
        for at in range(0, len(all_ids), step):
            ids = all_ids[at: at + step]
            codes = index.codes([queries[i] for i in ids])
            first, second = codes[:, :half], codes[:, half:]
            if scheme == 0:
                row, word = index.across(1, second, *index.turn(0, first[:, ::-1]))
            else:
                row, word = index.across(0, first[:, ::-1], *index.turn(1, second))
            pairs = np.unique(row * len(words) + word)
            row, word = pairs // len(words), pairs % len(words)
            for r, w in zip(row.tolist(), word.tolist(), strict=True):
                q, t = queries[ids[r]], words[w]
                if t != q and (scheme == 0 or not t.startswith(q[:half])):
                    found_q.append(ids[r])
                    found_w.append(w)
    return np.hstack(found_q).astype(np.int64), np.hstack(found_w).astype(np.int64)


_BEST = pa.schema([("word", pa.string()), ("n", pa.int64()), ("n_near", pa.int64()), ("near", pa.string()), ("near_n", pa.int64())])


def _search_block(table: pa.Table) -> pa.Table:
    """One row per searching word of a block: near words in this block, and the one of the largest count."""
    scheme = table["scheme"][0].as_py()
    asks, n = table["asks"].to_numpy(zero_copy_only=False), table["n"].to_numpy()
    text = np.array(table["word"].to_pylist(), dtype=object)
    words = sorted(set(text[~asks]))
    queries = dict(zip(text[asks], n[asks].tolist(), strict=True))
    names = list(queries)
    rows, found = (near_words(names, BidirectionalIndex(words), words, scheme) if words and names else (np.zeros(0, np.int64),) * 2)
    count = dict(zip(text[~asks], n[~asks].tolist(), strict=True))
    size = np.array([count[w] for w in words], np.int64)
    order = np.lexsort((found, -size[found] if len(found) else found, rows))  # words are sorted, so ties go to the smallest
    rows, found = rows[order], found[order]
    best = np.full(len(names), -1)
    first = np.flatnonzero(np.diff(rows, prepend=-1))
    best[rows[first]] = found[first]
    near = np.bincount(rows, minlength=len(names))
    return pa.Table.from_arrays([
        pa.array(names, pa.string()), pa.array(list(queries.values()), pa.int64()), pa.array(near, pa.int64()),
        pa.array([words[b] if b >= 0 else None for b in best], pa.string()),
        pa.array([int(size[b]) if b >= 0 else None for b in best], pa.int64())], schema=_BEST)


def letter_runs(text: Column) -> Column:
    """Runs of Latin letters (ASCII and U+00C0 to U+00FF), A-Z lower-cased."""
    return F.regexp_extract_all(lower_ascii(text), F.lit("([a-zÀ-ÿ]+)"), F.lit(1))


def worn(run: Column, id: Column, every: int) -> Column:
    """``run``, or for one in ``every`` checksums of ``<id>:<run>`` the run without the letter that the checksum names."""
    h = F.crc32(F.concat(F.coalesce(id.cast("string"), F.lit("")), F.lit(":"), run))
    at = (h % F.char_length(run)).cast("int")
    return F.when(h % every == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.lit(2**31 - 1)))).otherwise(run)


def vocabulary(df: DataFrame, text: str = "text", id: str = "doc_id", every: int | None = None,
               length: int = LEAST_LENGTH, count: int = LEAST_COUNT) -> DataFrame:
    """Distinct words of at least ``length`` letters and ``count`` occurrences: ``word, n``.

    ``every`` takes one letter from one in so many words, by checksum (see ``worn``). Counts are combined before the shuffle.
    """
    runs = df.select(F.col(f"`{id}`").alias("id"), F.explode(letter_runs(F.col(f"`{text}`"))).alias("run"))
    runs = runs.where(F.char_length("run") >= length)
    word = worn(F.col("run"), F.col("id"), every) if every else F.col("run")
    return runs.select(word.alias("word")).where(F.char_length("word") >= length).groupBy("word").agg(
        F.count(F.lit(1)).alias("n")).where(F.col("n") >= count)


def variants(words: DataFrame, ratio: int = RATIO, block: int = BLOCK) -> DataFrame:
    """Near words of each word of ``words`` (distinct ``word`` of at least two letters, ``n``): ``word, n, n_near, form, form_n, root``.

    ``form`` is the near word of the largest count (ties: the smallest) if its count is ``ratio`` times the word's at least, else
    null; ``root`` follows forms to the last one. A form outnumbers its word, so chains end, after ``log(largest count)`` steps at
    most; they are followed by doubling. Rows with a null or shorter word are left out. An empty table gives an empty table.
    """
    stage = Stage(words.sparkSession, "spelling")
    words = stage.keep(words.where(F.char_length("word") >= 2).select("word", "n"), "words")
    half = F.floor(F.col("len") / 2).cast("int")
    piece = F.when(F.col("scheme") == 0, F.substring("word", F.lit(1), half)).otherwise(F.expr("right(word, len - cast(floor(len / 2) AS int))"))
    both = words.withColumn("scheme", F.explode(F.array(F.lit(0), F.lit(1))))
    size = F.char_length("word")
    asking = both.select("scheme", "word", "n", size.alias("len"), F.lit(True).alias("asks"))
    held = both.select("scheme", "word", "n", F.explode(F.sequence(F.greatest(size - 1, F.lit(2)), size + 1)).alias("len"), F.lit(False).alias("asks"))
    keyed = held.union(asking).select("scheme", "word", "n", "asks", F.xxhash64("scheme", "len", piece).alias("key"))
    sizes = stage.keep(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > block), "large")
    total, longest = words.agg(F.count(F.lit(1)), F.max("n")).first()
    blocks = max(1, math.ceil(8 * total / block))
    parts = F.ceil(F.coalesce("rows", F.lit(0)) / F.lit(block)).cast("int")
    own = F.pmod(F.xxhash64("word"), F.lit(2**31)).cast("int") % F.greatest("parts", F.lit(1))
    dealt = keyed.join(sizes, "key", "left").withColumn("parts", parts).withColumn("own", own)
    # light groups share blocks; of heavy ones each part of the searching words meets each part of the held ones
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.greatest("parts", F.lit(1)) - 1)))
    cell = F.when(F.col("asks"), F.struct(F.col("own").alias("a"), F.col("other").alias("b"))).otherwise(
        F.struct(F.col("other").alias("a"), F.col("own").alias("b")))
    dealt = dealt.withColumn("cell", cell).select(
        "scheme", "word", "n", "asks", F.when(F.col("parts") == 0, F.pmod("key", F.lit(blocks))).otherwise(F.col("key")).alias("key"),
        F.when(F.col("parts") == 0, F.lit(-1)).otherwise(F.col("cell.a")).alias("a"), F.col("cell.b").alias("b"))
    best = dealt.groupBy("scheme", "key", "a", "b").applyInArrow(
        _search_block, "word string, n long, n_near long, near string, near_n long")
    top = F.min(F.when(F.col("near").isNotNull(), F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("word"))))
    found = best.groupBy("word").agg(F.first("n").alias("n"), F.sum("n_near").alias("n_near"), top.alias("top"))
    strong = -F.col("top.n") >= ratio * F.col("n")
    found = stage.keep(found.select("word", "n", "n_near", F.when(strong, F.col("top.word")).alias("form"),
                                    F.when(strong, -F.col("top.n")).alias("form_n")), "found")
    steps = math.log(max(2, longest or 2)) / math.log(max(2, ratio)) + 1
    chain = found.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    for turn in range(math.ceil(math.log2(steps)) + 1):
        chain = stage.keep(chain, f"chain{turn}")
        onward = chain.select(F.col("word").alias("root"), F.col("root").alias("next"))
        chain = chain.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
    return found.join(chain, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))


def op11_spelling_variants(spark, sf_dir: str) -> DataFrame:
    """Spelling variants among all words of all documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return variants(vocabulary(docs, every=199)).select("word", "form", "root", "n", "n_near", "form_n")
