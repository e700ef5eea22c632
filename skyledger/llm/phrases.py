"""Phrase collocations: counts of phrases in HAT-tries, merged by prefix, and scores by the weakest cut.

Each task keeps a trie over word numbers. Its root leads to hash containers that many first words share; a container that
outgrows ``BURST`` entries bursts, and each of its first words gets a container of its own, later one for each slice
of second words. When a trie holds ``HELD`` entries, its largest subtrees are spilled whole, as runs sorted by phrase, until half is free.

A run goes to the partition of its prefix: language, first two words, and a slice of the last word, so that a
frequent prefix is cut into ``SLICES``. Spark moves the runs; each partition merges its own by ranges of phrases, so what
is unpacked at once has a bound too. Only phrases that reach the least count leave it; all counts are exact.
"""

from __future__ import annotations

import math
import re
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Stage, mix

#: Longest phrase, least occurrences of a phrase, phrases a language, share (percent) of a longer phrase that swallows one.
WORDS, LEAST, TOP, SWALLOWED = 3, 10, 2000, 50
#: Entries of a container before it bursts, of a trie before it spills; different words before a trie starts anew.
BURST, HELD, NAMES = 1 << 15, 1 << 20, 1 << 18
#: Containers at the root and below a word that has burst; slices of a prefix; text bytes a partition; entries merged at once.
ROOTS, LIMBS, SLICES, PART_BYTES, MERGED = 64, 16, 64, 4 << 20, 1 << 21
#: Bytes of texts joined, and tokens counted, at once.
_CUT, _STRETCH = 1 << 20, 1 << 17
_BITS = 20
_PACKING = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=1))
#: On UTF-8 bytes; those of letters beyond ASCII stay as they are.
_TABLE = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\r\x0b\x0c\t", b"abcdefghijklmnopqrstuvwxyz" + b"\n" * 9 + b" ")
_TOKENS = re.compile(b"[^ \n]+|\n")


class HatTrie:
    """Counts of word sequences. Nodes are arrays over word numbers; leaves are hash containers of packed sequences."""

    def __init__(self, burst: int | None = None):
        self.burst = burst or BURST
        self.leaves: list[Counter | None] = [Counter() for _ in range(ROOTS)]
        self.of_word = np.zeros(0, np.int64)  # the leaf, or the first of LIMBS leaves, of a first word
        self.split = np.zeros(0, bool)
        self.size = 0

    def add(self, keys: np.ndarray) -> None:
        """Count packed sequences (first word in the highest bits)."""
        if not len(keys):
            return
        first = keys >> (2 * _BITS)
        top = int(first.max(initial=0)) + 1
        if top > len(self.of_word):
            self.of_word = np.concatenate((self.of_word, np.arange(len(self.of_word), top) % ROOTS))
            self.split = np.concatenate((self.split, np.zeros(top - len(self.split), bool)))
        leaf = self.of_word[first] + np.where(self.split[first], (keys >> _BITS) % LIMBS, 0)
        order = np.argsort(leaf, kind="stable")
        keys, leaf = keys[order].tolist(), leaf[order]
        begins = np.flatnonzero(np.diff(leaf, prepend=-1))
        for a, b, i in zip(begins.tolist(), [*begins[1:].tolist(), len(keys)], leaf[begins].tolist(), strict=True):
            held = self.leaves[i]
            before = len(held)
            held.update(keys[a:b])
            self.size += len(held) - before
            if len(held) > self.burst:
                self._burst(i)

    def _burst(self, i: int) -> None:
        """A shared container gives each of its words an own one; an own container is cut by second words, once."""
        held = self.leaves[i]
        keys, counts = _arrays(held)
        first = keys >> (2 * _BITS)
        names = np.unique(first)
        if len(names) == 1 and self.split[names[0]]:
            return
        self.leaves[i] = Counter() if i < ROOTS else None
        if len(names) == 1:
            self.split[names[0]] = True
            self.of_word[names[0]] = len(self.leaves)
            target = len(self.leaves) + (keys >> _BITS) % LIMBS
            self.leaves.extend(Counter() for _ in range(LIMBS))
        else:
            self.of_word[names] = len(self.leaves) + np.arange(len(names))
            target = self.of_word[first]
            self.leaves.extend(Counter() for _ in names)
        for key, count, leaf in zip(keys.tolist(), counts.tolist(), target.tolist(), strict=True):
            self.leaves[leaf][key] = count

    def spill(self, until: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Whole subtrees, the largest first, until no more than ``until`` entries stay: keys and counts."""
        by_size = sorted((i for i, held in enumerate(self.leaves) if held), key=lambda i: -len(self.leaves[i]))
        for i in by_size:
            if self.size <= until:
                return
            yield _arrays(self.leaves[i])
            self.size -= len(self.leaves[i])
            self.leaves[i] = Counter()


def _arrays(held: Counter) -> tuple[np.ndarray, np.ndarray]:
    return np.fromiter(held.keys(), np.int64, len(held)), np.fromiter(held.values(), np.int64, len(held))


class _Names(dict):
    """Numbers of words in order of appearance; 0 is the end of a piece."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


class _Counter:
    """Tries of all languages of a task, and the names of their words."""

    def __init__(self, parts: int):
        self.parts = parts
        self.start()

    def start(self) -> None:
        self.names, self.tries = _Names({b"\n": 0}), {}
        self.hashes, self.held = [0], 0

    def add(self, lang: str, text: bytes) -> Iterator[pa.RecordBatch]:
        """Count the phrases of a text; long ones come in stretches that overlap by the words that a phrase may reach back."""
        line = text.translate(_TABLE)
        tokens = iter(_TOKENS.findall(line)) if len(line) <= _CUT else (m.group() for m in _TOKENS.finditer(line))
        back = [b"\n"] * (WORDS - 1)
        while run := list(islice(tokens, _STRETCH)):
            run = back + run
            back = run[1 - WORDS:]
            if len(self.names) > NAMES:
                yield from self.spilled(0)
                self.start()
            ids = np.fromiter(map(self.names.__getitem__, run), np.int64, len(run))
            a, b, c = ids[:-2], ids[1:-1], ids[2:]
            two, three = (b > 0) & (c > 0), (a > 0) & (b > 0) & (c > 0)
            trie = self.tries.setdefault(lang, HatTrie())
            for keys in (c[c > 0] << 2 * _BITS, (b[two] << 2 * _BITS) | (c[two] << _BITS),
                         (a[three] << 2 * _BITS) | (b[three] << _BITS) | c[three]):
                self.held -= trie.size
                trie.add(keys)
                self.held += trie.size
            if self.held > HELD:
                yield from self.spilled(HELD // 2)

    def spilled(self, until: int) -> Iterator[pa.RecordBatch]:
        """Sorted runs of the largest subtrees, one row for each run and partition."""
        words = list(self.names)
        self.hashes.extend(map(zlib.crc32, words[len(self.hashes):]))
        hashes = np.array(self.hashes, np.uint64)
        order = np.zeros(len(words), np.int64)
        order[sorted(range(1, len(words)), key=words.__getitem__)] = np.arange(1, len(words))
        back = np.argsort(order)
        named = pa.array(words, pa.binary()).cast(pa.string())
        low = (1 << _BITS) - 1
        for lang, trie in sorted(self.tries.items(), key=lambda x: -x[1].size):
            before = trie.size
            found = list(trie.spill(max(0, until - (self.held - before))))
            self.held -= before - trie.size
            if not found:
                continue
            keys, counts = (np.concatenate(x) for x in zip(*found, strict=True))
            keys = (order[keys >> 2 * _BITS] << 2 * _BITS) | (order[(keys >> _BITS) & low] << _BITS) | order[keys & low]
            sort = np.argsort(keys)
            keys, counts = keys[sort], counts[sort]
            a, b, c = back[keys >> 2 * _BITS], back[(keys >> _BITS) & low], back[keys & low]
            tail = np.where(c > 0, hashes[c], np.uint64(0)) % np.uint64(SLICES)
            prefix = mix(mix(mix(np.full(len(a), zlib.crc32(lang.encode()), np.uint64)) + hashes[a]) + hashes[b])
            part = (mix(prefix + tail) % np.uint64(self.parts)).astype(np.int64)
            group = np.argsort(part.astype(np.uint16) if self.parts < 1 << 16 else part, kind="stable")
            part, a, b, c, counts = part[group], a[group], b[group], c[group], counts[group]
            phrase = named.take(pa.array(a))
            for more in (b, c):
                phrase = pc.if_else(pa.array(more > 0), pc.binary_join_element_wise(phrase, named.take(pa.array(more)), " "), phrase)
            held = pa.RecordBatch.from_arrays([phrase, pa.array(counts)], names=["phrase", "n"])
            begins = np.flatnonzero(np.diff(part, prepend=-1)).tolist()
            for x in range(0, len(begins), 256):
                some = [*begins[x:x + 257], len(part)][:257]
                yield pa.RecordBatch.from_arrays([
                    pa.array(part[some[:-1]]), pa.array([lang] * (len(some) - 1)),
                    pa.array([_packed(held.slice(i, j - i)) for i, j in zip(some, some[1:], strict=False)], pa.binary())], names=["part", "lang", "run"])


def _packed(run: pa.RecordBatch) -> bytes:
    """A sorted run as an Arrow stream of phrases and counts."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, run.schema, options=_PACKING) as out:
        out.write_batch(run)
    return sink.getvalue().to_pybytes()


def _runs(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    """Sorted runs of the phrases of a task's texts."""
    counter = _Counter(parts)
    for batch in batches:
        waiting: dict[str, list[bytes]] = {}
        held: dict[str, int] = {}
        for lang, text in zip(batch["lang"].to_pylist(), batch["text"], strict=True):
            text = text.as_buffer().to_pybytes()
            waiting.setdefault(lang, []).append(text)
            held[lang] = held.get(lang, 0) + len(text)
            if held[lang] > _CUT // 4:
                del held[lang]
                yield from counter.add(lang, b"\n".join(waiting.pop(lang)))
        for lang, texts in waiting.items():
            yield from counter.add(lang, b"\n".join(texts))
    yield from counter.spilled(0)


def _words_of(phrases: pa.Array, at: int) -> list[str]:
    return phrases[at].as_py().split(" ")


def _merge(table: pa.Table, least: int) -> pa.Table:
    """Phrases of a partition with at least ``least`` occurrences, and (phrase null) all occurrences of its single words."""
    runs = []
    for run in table["run"]:
        one = pa.ipc.open_stream(run.as_buffer()).read_all().combine_chunks()
        runs.append((one["phrase"].chunk(0), one["n"].chunk(0)))
    cuts = max(1, math.ceil(sum(len(p) for p, _ in runs) / MERGED))
    widest = max(runs, key=lambda r: len(r[0]))[0]
    edges = [_words_of(widest, i * len(widest) // cuts) for i in range(1, cuts)]
    places = [[0, *[bisect_left(range(len(p)), e, key=lambda i, p=p: _words_of(p, i)) for e in edges], len(p)] for p, _ in runs]
    kept, single = [], 0
    for i in range(cuts):
        some = pa.table({"phrase": pa.chunked_array([p[x[i]:x[i + 1]] for (p, _), x in zip(runs, places, strict=True)]),
                         "n": pa.chunked_array([n[x[i]:x[i + 1]] for (_, n), x in zip(runs, places, strict=True)])})
        words = some.filter(pc.invert(pc.match_substring(some["phrase"], " ")))
        single += pc.sum(words["n"]).as_py() or 0
        found = some.group_by("phrase").aggregate([("n", "sum")])
        kept.append(found.filter(pc.greater_equal(found["n_sum"], least)).select(["phrase", "n_sum"]).rename_columns(["phrase", "n"]))
    out = pa.concat_tables([*kept, pa.table({"phrase": pa.array([None], pa.string()), "n": pa.array([single], pa.int64())})])
    return out.append_column("lang", pa.array([table["lang"][0].as_py()] * len(out), pa.string())).select(["lang", "phrase", "n"])


def phrase_counts(df: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST) -> DataFrame:
    """Occurrences of all phrases of one to three words that occur ``least`` times in a language: ``lang, phrase, n``.

    A row with a null phrase holds occurrences of single words, whatever their count; there are several a language, to be summed.
    """
    rows = df.select(F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    bytes_ = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    parts = max(1, math.ceil(bytes_ / PART_BYTES))
    runs = rows.mapInArrow(lambda batches: _runs(batches, parts), "part long, lang string, run binary")
    return runs.groupBy("lang", "part").applyInArrow(lambda table: _merge(table, least), "lang string, phrase string, n long")


def collocations(df: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, top: int = TOP) -> DataFrame:
    """Each language's first ``top`` phrases of two or three words: ``lang, rank, phrase, a, l, r, n, score``.

    A-Z is lower-cased; ``.,;:!?`` and line breaks end a piece, spaces and tabs a word; phrases lie within pieces. ``a``
    counts the phrase (``least`` at least), ``l`` and ``r`` the parts of its lowest-scoring cut (ties: the first), ``n`` all words of the
    language. ``score`` is ``floor(1000000 a a / (l r))``, exactly (38 digits). Phrases of two words with half of their occurrences or more inside one
    counted phrase of three are left out. Null texts are empty, a null language is ``und``; an empty table gives an empty table.
    """
    stage = Stage(df.sparkSession, "phrases")
    counted = stage.keep(phrase_counts(df, text, lang, least), "counts")
    totals = counted.where("phrase IS NULL").groupBy("lang").agg(F.sum("n").alias("n"))
    known = counted.where("phrase IS NOT NULL")
    word = F.split("phrase", " ", -1)
    longer = known.select("lang", "phrase", F.col("n").alias("a"), word.alias("w")).where(F.size("w") > 1)
    cut = F.explode(F.transform(F.sequence(F.lit(1), F.size("w") - 1), lambda k: F.struct(
        k.alias("k"), F.array_join(F.slice("w", F.lit(1), k), " ").alias("first"),
        F.array_join(F.slice("w", k + 1, F.size("w") - k), " ").alias("rest"))))
    cuts = longer.select("lang", "phrase", "a", F.size("w").alias("words"), cut.alias("cut")).select("lang", "phrase", "a", "words", "cut.*")
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l")), ["lang", "first"])
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r")), ["lang", "rest"])
    exact = F.expr("(CAST(1000000 AS DECIMAL(7,0)) * CAST(a AS DECIMAL(15,0)) * CAST(a AS DECIMAL(15,0)))"
                   " div (CAST(l AS DECIMAL(18,0)) * CAST(r AS DECIMAL(18,0)))")
    scored = cuts.withColumn("score", exact).groupBy("lang", "phrase", "a", "words").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    inner = longer.where(F.size("w") == WORDS).select("lang", "a", F.explode(F.array(
        F.array_join(F.slice("w", 1, WORDS - 1), " "), F.array_join(F.slice("w", 2, WORDS - 1), " "))).alias("phrase"))
    inner = inner.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = scored.join(inner, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (100 * F.col("longer") < SWALLOWED * F.col("a")))
    order = Window.partitionBy("lang").orderBy(F.col("cut.score").desc(), F.col("a").desc(), F.col("phrase"))
    ranked = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def op13_phrase_collocations(spark, sf_dir: str) -> DataFrame:
    """Collocations of every language of all documents."""
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet").select("lang", "text"))


OP13_SQL = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
words AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM pieces),
grams AS (
  SELECT lang, array_to_string(w[i : i + k - 1], ' ') AS phrase, k
  FROM (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words), (SELECT unnest([1, 2, 3]) AS k) WHERE i + k - 1 <= len(w)),
f AS (SELECT lang, phrase, k, count(*) AS n FROM grams GROUP BY ALL),
totals AS (SELECT lang, sum(n)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
cand AS (SELECT lang, phrase, k, n AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND n >= 10),
cuts AS (SELECT c.*, j, array_to_string(w[1 : j], ' ') AS p, array_to_string(w[j + 1 :], ' ') AS q
         FROM (SELECT *, unnest(range(1, k)) AS j FROM cand) c),
scored AS (
  SELECT cuts.lang, cuts.phrase, cuts.k, a, x.n AS l, y.n AS r, (1000000::HUGEINT * a * a) // (x.n::HUGEINT * y.n) AS score,
         row_number() OVER (PARTITION BY cuts.lang, cuts.phrase ORDER BY (1000000::HUGEINT * a * a) // (x.n::HUGEINT * y.n), j) AS place
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = p JOIN f y ON y.lang = cuts.lang AND y.phrase = q),
inner_ AS (SELECT lang, unnest([array_to_string(w[1 : 2], ' '), array_to_string(w[2 : 3], ' ')]) AS phrase, a FROM cand WHERE k = 3),
swallowed AS (SELECT lang, phrase, max(a) AS longer FROM inner_ GROUP BY ALL),
ranked AS (
  SELECT s.lang, s.phrase, a, l, r, score::BIGINT AS score,
         row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, s.phrase) AS rank
  FROM scored s LEFT JOIN swallowed z ON z.lang = s.lang AND z.phrase = s.phrase
  WHERE place = 1 AND (longer IS NULL OR 100 * longer < 50 * a))
SELECT ranked.lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals ON totals.lang = ranked.lang WHERE rank <= 2000
"""
