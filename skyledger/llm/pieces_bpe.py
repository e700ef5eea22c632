"""SentencePiece merges with seeded dropout, and lossless decoding.

A text is cut into chunks (a word with the spaces before it, or a run of line feeds), since no piece of the vocabulary reaches over their
edges. In a chunk an agenda holds the candidate merges, best score first, leftmost on ties. A candidate is skipped for
good if a keyed hash of its span falls below ``dropout``; the key is the seed and a number that id, text and chunk
number draw. So every place of a word skips by itself, yet every run with the same seed gives the same pieces. With
dropout 0 the pieces are the library's own.

What a worker remembers changes no draw: for a chunk and the candidates skipped so far, it holds the pieces and the candidates met on the
way. A place asks its own hash about those; if none is skipped the pieces are its own, else it goes on to the
entry with the newly skipped ones. Entries asked for by a few places only are not made; those places are segmented many at a time.

Characters without a piece, and the space mark itself, become byte pieces, so decoding returns every text exactly.
"""

from __future__ import annotations

import heapq
import re
from array import array
from collections import Counter
from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import without

SPACE = "▁"
_CHUNK = re.compile(r" *[^ \n]+| +(?=\n|$)|\n+| +")
_MASK = (1 << 64) - 1
#: Chunks, or chunks with skipped candidates, that a Python worker remembers, over all of its tasks.
REMEMBERED = 1 << 19
#: Places that are drawn together. Candidates of one entry, as bits of a mask; chunks with more are segmented by themselves.
PLACES, BITS = 1 << 16, 62
#: Places that ask for an entry before it is made; until then they are segmented many at a time.
ASKED = 4
#: Chunks longer than this are segmented one by one, others many at a time. Slots of the table of pairs.
SHORT, SLOT_BITS = 48, 20
#: Texts that a worker encodes together.
ROWS = 256
SLOTS = 1 << SLOT_BITS


class Vocabulary:
    """Pieces and scores of a merge-type model file, read on the driver; small and bounded by the file."""

    def __init__(self, model_file: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        n = model.get_piece_size()
        self.pieces = [model.id_to_piece(i) for i in range(n)]
        self.bytes = [0] * 256
        self.plain: dict[str, tuple[int, float]] = {}
        for i, piece in enumerate(self.pieces):
            if model.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.plain[piece] = (i, -model.get_score(i))
        self.spelled = [p.replace(SPACE, " ").encode() for p in self.pieces]
        for b, i in enumerate(self.bytes):
            self.spelled[i] = bytes([b])
        self.encoders: dict[tuple, Encoder] = {}
        self.merges: tuple[np.ndarray, np.ndarray] | None = None
        if len(set(self.bytes)) != 256:
            raise ValueError("the model has no byte pieces, so decoding would lose characters")
        if any(SPACE in p.lstrip(SPACE) or "\n" in p for p in self.plain):
            raise ValueError("a piece reaches over a space or line feed")


    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Hash table of the pairs of pieces that make a piece: keys (left * 2**20 + right, else -1) and the piece."""
        if self.merges is None:
            keys, made = np.full(SLOTS, -1, np.int64), np.zeros(SLOTS, np.int32)
            for piece, (i, _) in self.plain.items():
                for cut in range(1, len(piece)):
                    a, b = self.plain.get(piece[:cut]), self.plain.get(piece[cut:])
                    if a and b:
                        key = a[0] << 20 | b[0]
                        slot = (key * 0x9E3779B97F4A7C15 & _MASK) >> 64 - SLOT_BITS
                        while keys[slot] >= 0:
                            slot = (slot + 1) % SLOTS
                        keys[slot], made[slot] = key, i
            self.merges = keys, made
        return self.merges

    def encoder(self, dropout: float, seed: int, variants: int) -> Encoder:
        """One encoder for each setting, kept as long as the worker that holds this vocabulary."""
        key = dropout, seed, variants
        if key not in self.encoders:
            self.encoders[key] = Encoder(self, dropout, seed, variants)
        return self.encoders[key]


class Encoder:
    def __init__(self, vocabulary: Vocabulary, dropout: float, seed: int, variants: int):
        self.vocabulary, self.variants = vocabulary, variants
        self.seed, self.limit = seed & _MASK, int(dropout * (1 << 32))
        self.known: list[dict[str, bytes]] = [{} for _ in range(max(1, variants))]
        self.symbol = {p: i for p, (i, _) in vocabulary.plain.items() if len(p) == 1}
        self.score = np.full(len(vocabulary.pieces), np.inf)
        for i, score in vocabulary.plain.values():
            self.score[i] = score
        self._forget()

    def _forget(self) -> None:
        """Entry 0 stands for chunks that are segmented by themselves."""
        # an entry, 0 if there cannot be one, or how often it was asked for, below 0
        self.entries: dict[str | tuple[int, int], int] = {}
        self.made, self.above, self.skipped = [b""], [-1], [0]
        self.asks, self.first = array("Q"), array("q", [0, 0])

    def _key(self, chunk: str, variant: int) -> int:
        return (self.seed * 0x9E3779B97F4A7C15 + variant * 0xC2B2AE3D27D4EB4F
                + crc32(chunk.encode("utf-8", "surrogatepass")) * 0x165667B19E3779F9) & _MASK

    def _segment(self, chunk: str, variant: int) -> tuple[int, ...]:
        """Pieces of one chunk."""
        key, limit = self._key(chunk, variant), self.limit

        def skips(span: int) -> bool:
            x = key ^ span
            x = (x ^ x >> 32) * 0xD6E8FEB86659FD93 & _MASK
            x = (x ^ x >> 32) * 0xD6E8FEB86659FD93 & _MASK
            return x >> 32 < limit

        return self._merge(chunk, skips if limit else None)

    def _merge(self, chunk: str, skips: Callable[[int], bool] | None) -> tuple[int, ...]:
        """Pieces of one chunk; ``skips`` is asked once about each candidate, a number of its start, middle and end."""
        known = self.vocabulary.plain
        # the space mark in a text is no space: nothing may join it
        parts: list[str | None] = [SPACE if c == " " else c if c != SPACE else None for c in chunk]
        size = len(parts)
        ends = list(range(1, size + 1))
        starts = list(range(-1, size - 1))
        agenda: list[tuple[float, int, int, int]] = []

        def offer(left: int, right: int) -> None:
            a, b = parts[left], parts[right]
            if a is None or b is None:
                return
            found = known.get(a + b)
            if found is None:
                return
            if skips and skips(left << 42 | right << 21 | ends[right]):
                return
            heapq.heappush(agenda, (found[1], left, right, len(a) + len(b)))

        for i in range(size - 1):
            offer(i, i + 1)
        while agenda:
            _, left, right, length = heapq.heappop(agenda)
            a, b = parts[left], parts[right]
            # one of the two may have been merged since
            if a is None or b is None or ends[left] != right or len(a) + len(b) != length:
                continue
            parts[left], parts[right] = a + b, None
            ends[left] = ends[right]
            if ends[left] < size:
                starts[ends[left]] = left
            if starts[left] >= 0:
                offer(starts[left], left)
            if ends[left] < size:
                offer(left, ends[left])
        out: list[int] = []
        at = 0
        while at < size:
            piece = parts[at]
            found = known.get(piece) if piece is not None else None
            if found:
                out.append(found[0])
            else:
                out.extend(self.vocabulary.bytes[b] for b in (piece or SPACE).encode("utf-8", "surrogatepass"))
            at = ends[at]
        return tuple(out)

    def _offers(self, keys: np.ndarray, left: np.ndarray, right: np.ndarray, spans: tuple) -> tuple[np.ndarray, np.ndarray]:
        """Piece and score of each pair of symbols; the score is infinite where there is no piece or it is skipped."""
        table, made = self.vocabulary.pairs()
        asked = left.astype(np.int64) << 20 | right
        slot = ((asked.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        piece = np.full(asked.shape, -1, np.int32)
        waiting = np.flatnonzero((left >= 0) & (right >= 0))
        while len(waiting):
            there = table[slot[waiting]]
            hit = there == asked[waiting]
            piece[waiting[hit]] = made[slot[waiting[hit]]]
            waiting = waiting[~hit & (there >= 0)]
            slot[waiting] = (slot[waiting] + 1) % SLOTS
        found = np.flatnonzero(piece >= 0)
        score = np.full(asked.shape, np.inf)
        if self.limit and len(found):
            a, b, c = (x[found].astype(np.uint64) for x in spans)
            x = keys[found] ^ (a << np.uint64(42) | b << np.uint64(21) | c)
            for _ in range(2):
                x = (x ^ x >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
            found = found[x >> np.uint64(32) >= np.uint64(self.limit)]
        score[found] = self.score[piece[found]]
        return piece, score

    def _segment_many(self, chunks: list[str], keys: np.ndarray) -> list[bytes]:
        """Pieces of many short chunks of known characters: each step makes the best merge of every chunk at once."""
        size = max(map(len, chunks))
        lengths = np.array([len(c) for c in chunks])
        symbols = np.full((len(chunks), size + 1), -1, np.int32)
        symbols[np.arange(size + 1) < lengths[:, None]] = [self.symbol[c] for chunk in chunks for c in chunk.replace(" ", SPACE)]
        starts = np.minimum(np.arange(size + 1), lengths[:, None])
        piece, score = np.full((len(chunks), size), -1, np.int32), np.full((len(chunks), size), np.inf)
        row, at = np.nonzero(np.arange(size) + 1 < lengths[:, None])
        end = np.minimum(at + 2, lengths[row])
        piece[row, at], score[row, at] = self._offers(keys[row], symbols[row, at], symbols[row, at + 1], (at, at + 1, end))
        done: list[bytes | None] = [None] * len(chunks)
        number, count = np.arange(len(chunks)), lengths.copy()
        while len(number):
            best = score.argmin(axis=1)
            lines = np.arange(len(number))
            live = np.isfinite(score[lines, best])
            for i in np.flatnonzero(~live):
                done[number[i]] = symbols[i, : count[i]].tobytes()
            if not live.all():
                number, count, keys, best = number[live], count[live], keys[live], best[live]
                symbols, starts, piece, score = symbols[live], starts[live], piece[live], score[live]
                if not len(number):
                    break
                size = int(count.max())
                symbols, starts, piece, score = symbols[:, : size + 1], starts[:, : size + 1], piece[:, :size], score[:, :size]
                lines = np.arange(len(number))
            symbols[lines, best] = piece[lines, best]
            # what lies behind the merged pair moves up by one
            cells = np.arange(symbols.shape[1])
            ahead = np.minimum(cells + (cells > best[:, None]), symbols.shape[1] - 1)
            symbols, starts = np.take_along_axis(symbols, ahead, 1), np.take_along_axis(starts, ahead, 1)
            ahead = np.minimum(ahead[:, : score.shape[1]], score.shape[1] - 1)
            piece, score = np.take_along_axis(piece, ahead, 1), np.take_along_axis(score, ahead, 1)
            count -= 1
            score[lines, count - 1] = np.inf
            for where in (best - 1, best):
                some = np.flatnonzero((where >= 0) & (where + 1 < count))
                w = where[some]
                span = starts[some, w], starts[some, w + 1], starts[some, np.minimum(w + 2, starts.shape[1] - 1)]
                piece[some, w], score[some, w] = self._offers(keys[some], symbols[some, w], symbols[some, w + 1], span)
        return done

    def _enter(self, chunk: str, above: int, skipped: int) -> int:
        """A new entry: ``chunk`` with what was skipped on the way to entry ``above``, and there by the mask ``skipped``."""
        asked, without, entry, mask = set(), set(), above, skipped
        while entry >= 0:
            spans = self.asks[self.first[entry]: self.first[entry + 1]]
            asked.update(spans)
            without.update(x for i, x in enumerate(spans) if mask >> i & 1)
            entry, mask = self.above[entry], self.skipped[entry]
        met: list[int] = []

        def skips(span: int) -> bool:
            met.append(span)
            return span in without

        pieces = self._merge(chunk, skips)
        met = [x for x in met if x not in asked]
        if len(met) > BITS:
            return 0
        self.made.append(array("i", pieces).tobytes())
        self.above.append(above)
        self.skipped.append(skipped)
        self.asks.extend(met)
        self.first.append(len(self.asks))
        return len(self.made) - 1

    def _draw(self, chunks: list[str], draws: np.ndarray) -> list[bytes]:
        """Pieces of each chunk, as ``_segment`` gives them for its own draw."""
        if len(self.entries) > REMEMBERED:
            self._forget()
        entries, limit = self.entries, np.uint64(self.limit)
        number = Counter(chunks)
        for c, times in number.items():
            self._ask(c, times, c, -1, 0)
        entry = np.maximum(np.array([entries[c] for c in chunks], np.int64), 0)
        sums = {c: crc32(c.encode("utf-8", "surrogatepass")) for c in number}
        keys = (np.uint64(self.seed * 0x9E3779B97F4A7C15 & _MASK) + draws * np.uint64(0xC2B2AE3D27D4EB4F)
                + np.array([sums[c] for c in chunks], np.uint64) * np.uint64(0x165667B19E3779F9))
        live = np.flatnonzero(entry)
        while len(live):
            first = np.array(self.first, np.int64)
            begin = first[entry[live]]
            count = first[entry[live] + 1] - begin
            owner = np.repeat(np.arange(len(live)), count)
            bit = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
            x = keys[live][owner] ^ np.array(self.asks, np.uint64)[begin[owner] + bit]
            for _ in range(2):
                x = (x ^ x >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
            hit = np.flatnonzero(x >> np.uint64(32) < limit)
            if not len(hit):
                break
            owner = owner[hit]
            edge = np.flatnonzero(np.diff(owner, prepend=-1))
            masks = np.bitwise_or.reduceat(np.int64(1) << bit[hit], edge).tolist()
            live = live[owner[edge]]
            nexts = []
            for i, step in zip(live.tolist(), zip(entry[live].tolist(), masks, strict=True), strict=True):
                found = entries.get(step, -1)
                nexts.append(found if found > 0 else self._ask(step, 1, chunks[i], *step))
            entry[live] = nexts
            live = live[entry[live] > 0]
        made = self.made
        out = [made[e] for e in entry.tolist()]
        rest = np.flatnonzero(entry == 0).tolist()
        plain = {c for c in {chunks[i] for i in rest} if self._plain(c)}
        many = sorted((i for i in rest if chunks[i] in plain), key=lambda i: len(chunks[i]))
        for a in range(0, len(many), 4096):
            part = many[a: a + 4096]
            for i, ids in zip(part, self._segment_many([chunks[i] for i in part], keys[part]), strict=True):
                out[i] = ids
        for i in rest:
            if chunks[i] not in plain:
                out[i] = array("i", self._segment(chunks[i], int(draws[i]))).tobytes()
        return out

    def _ask(self, name: str | tuple[int, int], times: int, chunk: str, above: int, skipped: int) -> int:
        """The entry of this name, made if it was asked for often enough; else 0."""
        found = self.entries.get(name, -1) if len(chunk) <= SHORT else 0
        if found < 0:
            found -= times
            if found < -ASKED:
                found = self._enter(chunk, above, skipped)
        self.entries[name] = found
        return max(found, 0)

    def _plain(self, chunk: str) -> bool:
        """True for a short chunk of known characters."""
        return len(chunk) <= SHORT and SPACE not in chunk and all(c == " " or c in self.symbol for c in chunk)

    def _encode_drawn(self, texts: list[str], keys: list[int]) -> list[bytes]:
        """``encode_all`` where every place of a chunk has a draw of its own."""
        words = [_CHUNK.findall(" " + text) if text else [] for text in texts]
        draws = [np.arange(1, len(c) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(key & _MASK) for c, key in zip(words, keys, strict=True)]
        x = np.concatenate([*draws, np.empty(0, np.uint64)])
        x = (x ^ x >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
        chunks = [c for part in words for c in part]
        out = []
        for a in range(0, len(chunks), PLACES):
            out += self._draw(chunks[a: a + PLACES], x[a: a + PLACES])
        ends = np.cumsum([0, *map(len, words)]).tolist()
        return [b"".join(out[a:b]) for a, b in zip(ends, ends[1:])]

    def encode_all(self, texts: list[str], keys: list[int]) -> list[bytes]:
        """Ids of texts as 32-bit numbers; ``keys`` stand for their rows. Each text is led by one space, as the model expects."""
        if self.limit and not self.variants:
            return self._encode_drawn(texts, keys)
        words, draws, new = [], [], [set() for _ in self.known]
        varied = self.limit and self.variants > 1
        for text, key in zip(texts, keys, strict=True):
            chunks = _CHUNK.findall(" " + text) if text else []
            if varied:
                x = np.arange(1, len(chunks) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(key & _MASK)
                x = (x ^ x >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
                drawn = ((x >> np.uint64(33)) % np.uint64(self.variants)).tolist()
            else:
                drawn = [0] * len(chunks)
            for chunk, v in zip(chunks, drawn, strict=True):
                if chunk not in self.known[v]:
                    new[v].add(chunk)
            words.append(chunks)
            draws.append(drawn)
        for v, chunks in enumerate(new):
            self._learn(sorted(chunks), v)
        known = self.known
        out = [b"".join([known[v][c] for c, v in zip(chunks, drawn, strict=True)]) for chunks, drawn in zip(words, draws, strict=True)]
        for table in known:
            if len(table) > REMEMBERED // len(known):
                table.clear()
        return out

    def _learn(self, chunks: list[str], variant: int) -> None:
        table, plain = self.known[variant], []
        for chunk in chunks:
            if self._plain(chunk):
                plain.append(chunk)
            else:
                table[chunk] = array("i", self._segment(chunk, variant)).tobytes()
        plain.sort(key=len)
        for a in range(0, len(plain), 4096):
            part = plain[a: a + 4096]
            keys = np.array([self._key(c, variant) for c in part], np.uint64)
            table.update(zip(part, self._segment_many(part, keys), strict=True))

    def encode(self, text: str, key: int) -> list[int]:
        return np.frombuffer(self.encode_all([text], [key])[0], np.int32).tolist()


def decode(ids: list[int], vocabulary: Vocabulary) -> str:
    """The text of ids from ``Encoder.encode``."""
    return b"".join(map(vocabulary.spelled.__getitem__, ids))[1:].decode("utf-8", "surrogatepass")


def encode(df: DataFrame, model_file: str, dropout: float = 0.1, seed: int = 0, variants: int = 0, text: str = "text", id: str = "doc_id") -> DataFrame:
    """``df`` without its text, with ``ids`` (array of int), ``n_pieces`` and ``lossless`` (decoding gave the text back).

    Each place of a word draws by itself; with ``variants`` above 0 it takes one of so many ways to cut the word.
    Null and empty texts have no pieces. Repeated rows get equal pieces. Columns of these names are replaced; an
    empty table gives an empty table. The vocabulary is the only thing sent to executors.
    """
    if not 0 <= dropout < 1:
        raise ValueError("dropout must be in [0, 1)")
    df = without(df, "ids", "n_pieces", "lossless", "_key", "_text")
    vocabulary = Vocabulary(model_file)
    sent = df.sparkSession.sparkContext.broadcast(vocabulary)
    kept = [c for c in df.columns if c.lower() != text.lower()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = sent.value.encoder(dropout, seed, variants)
        for batch in batches:
            for a in range(0, len(batch), ROWS):
                part = batch.slice(a, ROWS)
                texts = [x or "" for x in part.column("_text").to_pylist()]
                found = encoder.encode_all(texts, part.column("_key").to_pylist())
                ids = np.frombuffer(b"".join(found), np.int32)
                counts = [len(f) // 4 for f in found]
                same = [decode(np.frombuffer(f, np.int32).tolist(), sent.value) == x for f, x in zip(found, texts, strict=True)]
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32()), pa.array(ids))
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in kept], lists, pa.array(counts, pa.int64()), pa.array(same, pa.bool_())],
                    names=[*kept, "ids", "n_pieces", "lossless"])

    content = F.col(f"`{text}`")
    keyed = df.select(*[F.col(f"`{c}`") for c in kept], content.alias("_text"), F.xxhash64(F.lit(seed), F.col(f"`{id}`"), content).alias("_key"))
    shape = ", ".join([f"`{c}` {df.schema[c].dataType.simpleString()}" for c in kept] + ["ids array<int>, n_pieces long, lossless boolean"])
    return keyed.mapInArrow(run, shape)


def decode_ids(df: DataFrame, model_file: str, ids: str = "ids") -> DataFrame:
    """``df`` with ``text`` from its ids; null ids give null."""
    df = without(df, "text") if ids.lower() != "text" else df
    sent = df.sparkSession.sparkContext.broadcast(Vocabulary(model_file))

    @F.pandas_udf("string")
    def texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for column in batches:
            yield pd.Series([None if x is None else decode(list(x), sent.value) for x in column], dtype=object)

    return df.withColumn("text", texts(F.col(f"`{ids}`")))


#: Where this machine keeps the vocabulary of the registered query.
MODEL_FILE = "/opt/tokenizers/piece_bpe_32k.model"


def op6_piece_dropout(spark, sf_dir: str) -> DataFrame:
    """Pieces of every whole document at dropout 0.1, with the proof that they decode."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return encode(docs, MODEL_FILE, dropout=0.1, seed=42)
