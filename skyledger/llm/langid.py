"""Language identification by interpolated Kneser-Ney character models, one per language.

Texts are lower-cased; letters stay, everything else is one space. A model of order ``ORDER`` holds, for each
order, the sorted hashes of the n-grams it has seen with their interpolated probabilities and the sorted hashes of
contexts with their back-off weights. The highest order counts occurrences, lower ones count the distinct
characters that came before (continuation counts). The language whose model needs the fewest nats per character wins.

Rejection is calibrated on texts that did not teach the model they are held against: a fifth of each language's sample, and with fewer than five
texts each one in turn (a single one: its halves in turn). A limit is their mean plus ``MARGIN`` deviations plus ``SLACK``; a
deviation has one part that shrinks with a text's length and one that does not. Languages with less than ``EVIDENCE`` held-back texts
take the larger of their own deviations and those of all languages. A text is rejected only if it is beyond the limits of
all languages, and no text on a limit without held-back evidence.

Every language that occurs gets a model, fitted in a task of its own on a bounded sample: ``sample`` texts, those with the least
hash of id and text, of a longer one ``STRETCHES`` stretches spread over it that hold ``chars`` characters together. So a model is
bounded, and what is sent to executors grows only with the number of languages. Prediction reads whole texts.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Stage, mix, without

ORDER = 4
#: Texts per language and characters a text that are learned from at most; stretches of a longer text.
SAMPLE, SAMPLE_CHARS, STRETCHES = 600, 20_000, 10
#: Standard deviations above the mean of held-back texts from which a text is rejected.
MARGIN, SLACK = 6.0, 0.5
#: Held-back texts from which a language's own deviations count alone; slices in which samples are first cut.
EVIDENCE, SLICES = 20, 64
_STEP = np.uint64(0x9E3779B97F4A7C15)
_WEIGHTS = mix(np.arange(1, 9, dtype=np.uint64) * _STEP) | np.uint64(1)
#: Characters scored at once, and rows turned into Python texts at once: what a worker holds follows from them.
_CUT, _ROWS = 1 << 18, 256


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(0x110000)])


def characters(texts: list[str], lead: int) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, each led by ``lead`` spaces, with runs of other characters as one space; lengths."""
    gap = "\n" * lead
    points = np.frombuffer("".join(gap + t for t in texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    begins = np.cumsum([0] + [len(t) + lead for t in texts])
    letter = _letters()[points]
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    for j in range(lead):
        keep[begins[:-1] + j] = True
    kept = np.where(letter, points, np.uint32(32))[keep]
    return kept, np.diff(np.concatenate(([0], np.cumsum(keep)))[begins])


def gram_hashes(points: np.ndarray, length: int, ends: np.ndarray | None = None) -> np.ndarray:
    """Hashes of the ``length``-grams that end at the given (or all) positions; spaces come before the first one."""
    padded = np.concatenate((np.full(length, 32, np.uint64), points.astype(np.uint64)))
    ends = slice(length, None) if ends is None else ends + length
    at = (lambda back: padded[length - back: len(padded) - back]) if isinstance(ends, slice) else (lambda back: padded[ends - back])
    code = np.full(len(at(0)), length, np.uint64) * _STEP
    for back in range(length):
        code = code + at(back) * _WEIGHTS[back]
    return mix(code)


@dataclass
class Model:
    """Interpolated probabilities of seen n-grams and back-off weights of seen contexts, sorted by hash, by order."""

    grams: list[np.ndarray]
    probs: list[np.ndarray]
    contexts: list[np.ndarray]
    weights: list[np.ndarray]
    floor: float

    def log_probs(self, grams: list[np.ndarray], contexts: list[np.ndarray]) -> np.ndarray:
        """Log probability of each n-gram of the highest order, from its suffixes' hashes and their contexts'."""
        p = np.full(len(grams[0]), self.floor)
        for n in range(1, len(grams)):
            at = np.minimum(np.searchsorted(self.grams[n], grams[n]), len(self.grams[n]) - 1)
            seen = self.grams[n][at] == grams[n]
            ctx = np.minimum(np.searchsorted(self.contexts[n], contexts[n]), len(self.contexts[n]) - 1)
            known = self.contexts[n][ctx] == contexts[n]
            p = np.where(seen, self.probs[n][at], np.where(known, self.weights[n][ctx], 1.0) * p)
        return np.log(p)


def fit(texts: list[str], order: int = ORDER) -> Model:
    """Kneser-Ney model of the characters of ``texts``."""
    points, counts = characters(texts, order)
    own = np.ones(len(points), bool)
    for j in range(order):
        own[np.cumsum(counts) - counts + j] = False
    ends = np.flatnonzero(own)
    hashes = [gram_hashes(points, n, ends) for n in range(order + 1)]
    context = [hashes[0]] + [gram_hashes(points, n - 1, ends - 1) for n in range(1, order + 1)]
    first = [np.unique(hashes[n], return_index=True, return_counts=True) for n in range(order + 1)]
    letters = max(1, len(first[1][0]))
    grams, probs, contexts, weights = ([None] * (order + 1) for _ in range(4))
    floor = 1.0 / (letters + 1)
    lower = np.full(1, floor)
    lower_keys = np.zeros(1, np.uint64)
    for n in range(1, order + 1):
        keys, at, number = first[n]
        if n < order:  # distinct characters before: one for each seen longer n-gram that ends in this one
            longer = first[n + 1][1]
            suffix = np.searchsorted(keys, hashes[n][longer])
            number = np.bincount(suffix, minlength=len(keys))
        number = np.maximum(number, 1).astype(float)
        once, twice = (number == 1).sum(), (number == 2).sum()
        discount = once / max(1.0, once + 2 * twice) if once else 0.5
        ctx = context[n][at]
        names, inverse = np.unique(ctx, return_inverse=True)
        total = np.bincount(inverse, weights=number)
        kinds = np.bincount(inverse)
        weight = discount * kinds / total
        shorter = lower[np.searchsorted(lower_keys, hashes[n - 1][at])] if n > 1 else np.full(len(keys), floor)
        grams[n], probs[n] = keys, (number - discount) / total[inverse] + weight[inverse] * shorter
        contexts[n], weights[n] = names, weight
        lower, lower_keys = probs[n], keys
    return Model(grams, probs, contexts, weights, floor)


def cross_entropies(texts: list[str], models: list[Model], order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """Nats per character of each text under each model, and the number of characters scored.

    Each distinct n-gram of a stretch is looked up once. A text longer than a stretch is scored in several.
    """
    sums, many = np.zeros((len(texts), len(models))), np.zeros(len(texts))
    for run in _runs(texts):
        points, counts = characters([t for _, t in run], order)
        owner = np.repeat([i for i, _ in run], counts)
        scored = np.ones(len(points), bool)
        for j in range(order):
            scored[np.cumsum(counts) - counts + j] = False
        where = np.flatnonzero(scored)
        if not len(where):
            continue
        full = gram_hashes(points, order)[where]
        rank = np.argsort(full)
        new = np.concatenate(([True], np.diff(full[rank]) != 0))
        inverse = np.empty(len(rank), np.int64)
        inverse[rank] = np.cumsum(new) - 1
        spot = where[rank[new]]
        grams = [gram_hashes(points, n, spot) for n in range(order + 1)]
        contexts = [grams[0]] + [gram_hashes(points, n - 1, spot - 1) for n in range(1, order + 1)]
        for m, model in enumerate(models):
            sums[:, m] += np.bincount(owner[where], weights=model.log_probs(grams, contexts)[inverse], minlength=len(texts))
        many += np.bincount(owner[where], minlength=len(texts))
    return -sums / np.maximum(many, 1)[:, None], many


def _runs(texts: list[str]) -> Iterator[list[tuple[int, str]]]:
    """Texts with their numbers, about ``_CUT`` characters at a time; longer texts come in stretches."""
    run, held = [], 0
    for i, text in enumerate(texts):
        for a in range(0, max(1, len(text)), _CUT):
            part = text[a: a + _CUT].lower()
            if run and held + len(part) > _CUT:
                yield run
                run, held = [], 0
            run.append((i, part))
            held += len(part)
    if run:
        yield run


@dataclass
class Identifier:
    """Models of the languages, and what their limits follow from: mean, deviation of a character and deviation of a whole text."""

    names: list[str]
    models: list[Model]
    mean: np.ndarray
    spread: np.ndarray
    between: np.ndarray

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score from 0 to 1 and rejection of each text."""
        texts = [t or "" for t in texts]
        blank = np.array([not any(map(str.isalpha, t)) for t in texts], dtype=bool)
        if not self.names:
            return ["und"] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        nats, many = cross_entropies(texts, self.models)
        best = nats.argmin(axis=1)
        least = nats[np.arange(len(texts)), best]
        # odds of the best language against all others, over 100 characters at most
        odds = np.exp(-(nats - least[:, None]) * np.minimum(many, 100)[:, None]).sum(axis=1)
        shrinking = self.spread ** 2 / np.maximum(many, 1)[:, None]
        limits = self.mean + MARGIN * np.sqrt(shrinking + self.between ** 2) + SLACK
        rejected = blank | (nats > limits).all(axis=1)
        names = ["und" if b else self.names[i] for b, i in zip(blank, best, strict=True)]
        return names, np.where(blank, 0.0, 1.0 / odds), rejected


def fit_language(texts: list[str]) -> tuple[Model, np.ndarray, np.ndarray] | None:
    """Model of a language, and nats and characters of texts held back from it; null without a letter."""
    texts = [t.lower() for t in texts if any(map(str.isalpha, t))]
    if not texts:
        return None
    if len(texts) >= 5:
        folds = [range(0, len(texts), 5)]
    else:
        if len(texts) == 1:
            texts = [t for t in (texts[0][: len(texts[0]) // 2], texts[0][len(texts[0]) // 2:]) if any(map(str.isalpha, t))]
        folds = [[i] for i in range(len(texts))] if len(texts) > 1 else []
    nats, many = [], []
    for held in folds:
        model = fit([t for i, t in enumerate(texts) if i not in held])
        found, sizes = cross_entropies([texts[i] for i in held], [model])
        nats.append(found[sizes > 0, 0])
        many.append(sizes[sizes > 0])
    return model if len(texts) >= 5 else fit(texts), np.hstack([[], *nats]), np.hstack([[], *many])


def deviations(residuals: np.ndarray, many: np.ndarray) -> tuple[float, float]:
    """Deviation of one character, from the shorter half of texts, and of whole texts, from the longer half."""
    order = np.argsort(many)
    short, long = order[: -(-len(order) // 2)], order[len(order) // 2:]
    return float(np.sqrt(np.mean(residuals[short] ** 2 * many[short]))), float(np.sqrt(np.mean(residuals[long] ** 2)))


def identifier(fitted: list[tuple[str, tuple[Model, np.ndarray, np.ndarray]]]) -> Identifier:
    """Limits of all languages. One without held-back evidence has none: infinite."""
    centres = [float(np.average(n, weights=m)) if len(n) else np.inf for _, (_, n, m) in fitted]
    held = [(n - c, m) for (_, (_, n, m)), c in zip(fitted, centres, strict=True) if len(n)]
    pooled = deviations(*(np.concatenate(x) for x in zip(*held, strict=True))) if held else (0.0, 0.0)
    own = [deviations(n - c, m) if len(n) else pooled for (_, (_, n, m)), c in zip(fitted, centres, strict=True)]
    used = [o if len(n) >= EVIDENCE else tuple(map(max, o, pooled)) for o, (_, (_, n, _)) in zip(own, fitted, strict=True)]
    return Identifier([n for n, _ in fitted], [f[0] for _, f in fitted], np.array(centres),
                      np.array([u[0] for u in used]), np.array([u[1] for u in used]))


def held_out(id: Column) -> Column:
    """True for a third of all ids, which nothing is learned from. False for a null id."""
    return F.coalesce(F.crc32(id.cast("string")) % 3 == 1, F.lit(False))


def stretched(text: Column, chars: int) -> Column:
    """Texts of up to ``chars`` characters, of longer ones spread stretches of as many together, with line feeds between."""
    many = max(1, min(STRETCHES, chars // 100))
    wide = chars // many
    spare = F.char_length(text) - wide
    parts = [F.substring(text, (F.floor(spare * i / max(1, many - 1)) + 1).cast("int"), F.lit(wide)) for i in range(many)]
    return F.when(F.char_length(text) > chars, F.concat_ws("\n", *parts)).otherwise(text)


def train(df: DataFrame, text: str = "text", lang: str = "lang", id: str = "doc_id", sample: int = SAMPLE, chars: int = SAMPLE_CHARS) -> Identifier:
    """A model of every language, from ``sample`` texts of each and ``chars`` characters of a text at most.

    Rows that are held out or have no text or language teach nothing; a language without a letter has no model.
    """
    rows = df.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").cast("string").alias("lang"))
    rows = rows.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("id")))
    rows = rows.withColumn("_hash", F.xxhash64("id", "text"))
    # ranks need no text: first within slices, so that no task meets more than a bounded number of rows of a language
    narrow = rows.select("lang", "id", "_hash", F.pmod("_hash", F.lit(SLICES)).alias("_slice")).distinct()
    for keys in (["lang", "_slice"], ["lang"]):
        order = Window.partitionBy(*keys).orderBy("_hash", "id")
        narrow = narrow.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= sample)
    stage = Stage(df.sparkSession, "langid")
    chosen = stage.keep(narrow.select("lang", "id", "_hash", "_rank"), "chosen")
    # a repeated row counts once
    texts = rows.join(chosen, ["lang", "id", "_hash"]).groupBy("lang", "_rank").agg(F.first("text").alias("text"))
    texts = texts.withColumn("text", stretched(F.col("text"), chars))

    def fitted(part: pd.DataFrame) -> pd.DataFrame:
        found = fit_language(part.sort_values("_rank")["text"].tolist())
        return pd.DataFrame({"lang": [part["lang"].iloc[0]], "fitted": [found and pickle.dumps(found)]})

    models = stage.keep(texts.groupBy("lang").applyInPandas(fitted, "lang string, fitted binary"), "models")
    found = sorted((r.lang, bytes(r.fitted)) for r in models.where("fitted IS NOT NULL").toLocalIterator())
    stage.drop("models", "chosen")
    return identifier([(n, pickle.loads(x)) for n, x in found])


def identify(df: DataFrame, identifier: Identifier, text: str = "text") -> DataFrame:
    """``df`` with ``lang_pred``, ``score`` and ``rejected``.

    ``und`` if the text is null or has no letter (score 0, rejected). All other texts get the best language even if
    rejected. Repeated rows get equal answers; columns of these names are replaced; an empty table gives an empty table.
    """
    df = without(df, "lang_pred", "score", "rejected")
    sent = df.sparkSession.sparkContext.broadcast(identifier)

    @F.arrow_udf("lang_pred string, score double, rejected boolean")
    def judged(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            parts = [sent.value.predict(texts.slice(a, _ROWS).to_pylist()) for a in range(0, len(texts), _ROWS)]
            names, score, rejected = ([x for p in parts for x in p[i]] for i in range(3))
            yield pa.StructArray.from_arrays(
                [pa.array(names, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())],
                names=["lang_pred", "score", "rejected"])

    columns = [F.col(f"`{c}`") for c in df.columns]
    return df.select(*columns, judged(F.col(f"`{text}`")).alias("_lang")).select(*columns, "_lang.*")


def op2_langid(spark, sf_dir: str) -> DataFrame:
    """Language of every document, learned from two thirds of the labelled ones."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = identify(docs.select("doc_id", "text"), train(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")
