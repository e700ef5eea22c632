"""Toxic passages: maximum-scoring segments over token log-odds, judged by extreme-value statistics.

A token's log-odds say how much more often texts labelled toxic hold it. The prior of a word is a Dirichlet one that
its stem gives, and the stem's is its shorter stem's: the share of toxic texts among those with a stem, but not with its next longer one
in the chain, pulls the share of the next by ``PRIOR`` texts. So an inflected form never seen is judged by its stem, and nothing
is counted twice. ``DRIFT`` is taken off, so that ordinary text sinks.

One linear scan finds all maximal scoring segments of a text. Of ``n`` ordinary tokens, the best segment follows an
extreme-value law: more than ``s`` with expectation ``K n exp(-lambda s)``. Lambda solves the moment equation
of the scores of clean texts, K is fitted to their best segments. A segment is significant below ``SIGNIFICANT``. A text's evidence is the sum of its
significant segments' log expectations (else the best one's), and a logistic curve over its inverse hyperbolic sine turns it into a score. All three are calibrated on
texts that did not teach the log-odds used (four folds).

Training reads a bounded sample: about ``SAMPLE`` different texts of each label, those with the least checksums, whole. So the model
that is sent to executors is bounded as well. Scoring reads every whole text.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Stage, without

#: Different texts of each label that are learned from (about), and folds that calibrate.
SAMPLE, FOLDS = 4_000, 4
#: Partitions of the sample, which has a bound.
SAMPLE_PARTS = 24
#: Shortest and longest stem, texts that a token or stem must occur in, strength of a prior in texts, and what each score loses.
STEM, LONGEST, LEAST, PRIOR, DRIFT = 3, 12, 2, 3.0, 1.0
#: Expected number of chance segments below which a segment counts.
SIGNIFICANT = 0.05
_WORD = re.compile(r"\w+")
_REMEMBERED = 1 << 17


def tokens_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def stems(word: str) -> list[str]:
    """Beginnings of a word from the shortest stem on (each ends in ``-``), then the word itself."""
    return [word[:k] + "-" for k in range(STEM, min(len(word), LONGEST) + 1)] + [word]


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (from, to, sum), in one pass over the scores."""
    gain = np.flatnonzero(scores > 0)
    if not len(gain):
        return []
    total = np.concatenate(([0.0], np.cumsum(scores)))
    found: list[tuple[int, int, float, float, int]] = []  # from, to, sum before, sum after, nearest earlier one that starts lower
    for at, left, right in zip(gain.tolist(), total[gain].tolist(), total[gain + 1].tolist(), strict=True):
        begin, lower = at, len(found) - 1
        while True:
            while lower >= 0 and found[lower][2] >= left:
                lower = found[lower][4]
            if lower < 0 or found[lower][3] >= right:
                break
            # the earlier one starts lower and ends lower: it grows to the end of this one
            begin, _, left, _, before = found[lower]
            del found[lower:]
            lower = before
        found.append((begin, at + 1, left, right, lower))
    return [(a, b, y - x) for a, b, x, y, _ in found]


def share_of(chain: list[tuple[float, float]], base: float) -> float:
    """Share of toxic texts, from (toxic, all) texts of each stem of a chain, shortest first; each counts without the next."""
    share = base
    for (toxic, seen), (less, fewer) in zip(chain, [*chain[1:], (0.0, 0.0)], strict=False):
        share = (toxic - less + PRIOR * share) / (seen - fewer + PRIOR)
    return share


class _Scores(dict):
    """Scores of words met so far; a new one is asked of the model."""

    def __init__(self, model: Model):
        super().__init__()
        self.model = model

    def __missing__(self, word: str) -> float:
        if len(self) >= _REMEMBERED:
            self.clear()
        self[word] = found = self.model.score_of(word)
        return found


@dataclass
class Model:
    """Toxic and all texts of each token and stem, share of toxic texts, and the calibration."""

    index: dict[str, int]
    toxic: np.ndarray
    texts: np.ndarray
    base: float
    lam: float = 1.0
    k: float = 1.0
    slope: float = 1.0
    offset: float = 0.0
    #: Score of every text where labels of one kind only were seen; null otherwise.
    constant: float | None = None
    by_stem: dict[str, float] = field(default_factory=dict)

    def __post_init__(self):
        self.known = _Scores(self)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("known", "by_stem")}

    def __setstate__(self, state):
        self.__dict__.update(state, by_stem={})
        self.__post_init__()

    def score_of(self, word: str) -> float:
        """Log-odds of the word if it was counted, else of its longest counted stem. A counted stem's shorter ones are counted too."""
        token = word
        if word not in self.index:
            low, high = STEM - 1, min(len(word), LONGEST)
            while low < high:
                mid = (low + high + 1) // 2
                low, high = (mid, high) if word[:mid] + "-" in self.index else (low, mid - 1)
            token = word[:low] + "-" if low >= STEM else ""
        found = self.by_stem.get(token)
        if found is None:
            chain = stems(token[:-1])[:-1] if token.endswith("-") else stems(token) if token else []
            at = [self.index[t] for t in chain]
            share = share_of([(float(self.toxic[i]), float(self.texts[i])) for i in at], self.base)
            found = float(np.log(share / (1 - share)) - np.log(self.base / (1 - self.base)) - DRIFT)
            self.by_stem[token] = found
        return found

    def scores(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.known.__getitem__, words), float, len(words))

    def chance(self, score: float, tokens: int) -> float:
        """Log of the expected number of segments of this score in an ordinary text."""
        return float(np.log(self.k * max(1, tokens)) - self.lam * score)

    def evidence(self, tokens: int, sums: list[float]) -> float:
        logs = [-self.chance(s, tokens) for s in sums]
        strong = [x for x in logs if x > -np.log(SIGNIFICANT)]
        return sum(strong) if strong else max(logs, default=-self.chance(0.0, tokens))

    def probability(self, evidence: float) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * np.arcsinh(evidence) + self.offset, -35, 35))))

    def judge(self, text: str | None) -> tuple[float, list[tuple[int, int, float]]]:
        """Score of a text, and its significant passages: first and last character (end exclusive), log expectation."""
        if self.constant is not None:
            return self.constant, []
        words = tokens_of(text)
        found = segments(self.scores(words))
        score = self.probability(self.evidence(len(words), [s for _, _, s in found]))
        strong = [(a, b, self.chance(s, len(words))) for a, b, s in found if self.chance(s, len(words)) < np.log(SIGNIFICANT)]
        if not strong:
            return score, []
        places = [m.span() for m in _WORD.finditer((text or "").lower())]
        # lower-casing may lengthen a letter; then places are those of the lower-cased text
        return score, [(places[a][0], places[b - 1][1], e) for a, b, e in strong]


def solve_lambda(scores: np.ndarray, weights: np.ndarray) -> float:
    """Positive root of the mean of exp(x s) = 1; a wide one if no score is positive."""
    if not (weights[scores > 0].sum() > 0) or float(scores @ weights) >= 0:
        return 1.0
    low, high = 1e-6, 50.0 / max(1e-9, float(scores[weights > 0].max()))
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if weights @ np.exp(mid * scores) < weights.sum() else (low, mid)
    return (low + high) / 2


def fit_logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope (not negative) and offset of a logistic curve, by Newton steps with a small penalty on the slope."""
    scale = float(x.std()) or 1.0
    z = np.column_stack(((x - x.mean()) / scale, np.ones(len(x))))
    w = np.array([0.0, float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)))])
    penalty = np.diag([0.01, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -35, 35)))
        step = np.linalg.solve(z.T @ (z * (p * (1 - p) + 1e-9)[:, None]) + penalty, z.T @ (p - y) + penalty @ w)
        w = w - step / max(1.0, float(np.abs(step).max()))
        if np.abs(step).max() < 1e-8:
            break
    slope = max(0.0, float(w[0] / scale))
    return slope, float(w[1] - slope * x.mean())


def held_out(id: Column) -> Column:
    """True for a fifth of all ids, which nothing is learned from. False for a null id."""
    return F.coalesce(F.crc32(id.cast("string")) % 5 == 0, F.lit(False))


def _sample(df: DataFrame, labels: DataFrame | None, text: str, toxic: str, id: str, sample: int, stage: Stage) -> DataFrame:
    """About ``sample`` different texts of each label: those with the least checksums. Copies of a text count once.

    Labels meet checksums, not texts. What is chosen is bounded by ``sample``, so it goes to the texts.
    """
    def label(column):
        return F.col(f"`{column}`").cast("int").alias("toxic")

    rows = df.where(F.col(f"`{text}`").isNotNull()).withColumn("_sum", F.crc32(F.md5(f"`{text}`")))
    if labels is None:
        marks = rows.select(label(toxic), "_sum")
    else:
        per_id = labels.groupBy(F.col(f"`{id}`").alias("_id")).agg(F.max(label(toxic)).alias("toxic"))
        marks = rows.select(F.col(f"`{id}`").alias("_id"), "_sum").join(per_id, "_id").select("toxic", "_sum")
    marks = stage.keep(marks.where(F.col("toxic").isin(0, 1)).distinct(), "marks")
    many = marks.groupBy("toxic").agg(F.count(F.lit(1)).alias("many"))
    below = many.select("toxic", (F.lit(float(sample)) / F.col("many") * 2**32).alias("below"))
    chosen = stage.keep(marks.join(below, "toxic").where(F.col("_sum") <= F.col("below")).select("toxic", "_sum"), "chosen")
    texts = rows.select(F.col(f"`{text}`").alias("text"), "_sum").join(F.broadcast(chosen), "_sum")
    return texts.groupBy("toxic", "_sum").agg(F.min("text").alias("text")).select("text", "toxic", (F.col("_sum") % FOLDS).cast("int").alias("fold"))


def _count_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of each token or stem, by label and fold."""
    seen: dict[tuple[int, int], Counter] = {}
    for batch in batches:
        for text, toxic, fold in zip(batch["text"], batch["toxic"].to_pylist(), batch["fold"].to_pylist(), strict=True):
            seen.setdefault((toxic, fold), Counter()).update({s for w in set(tokens_of(text.as_py())) for s in stems(w)})
        for (toxic, fold), held in seen.items():
            size = len(held)
            yield pa.RecordBatch.from_arrays(
                [pa.array(held.keys(), pa.string()), pa.array(np.full(size, toxic, np.int32)), pa.array(np.full(size, fold, np.int32)),
                 pa.array(held.values(), pa.int64())], names=["token", "toxic", "fold", "n"])
        seen.clear()


def train(df: DataFrame, labels: DataFrame | None = None, text: str = "text", toxic: str = "toxic", id: str = "doc_id",
          sample: int = SAMPLE) -> Model:
    """Model of the rows of ``df`` with a label 0 or 1 (others and null texts teach nothing).

    Labels are a column of ``df``, or of ``labels``, which has ids too (an id with several is toxic if one says so).
    Without two kinds of labels every text gets the same score: 1 if only toxic ones were seen, else 0.
    """
    spark, stage = df.sparkSession, Stage(df.sparkSession, "toxicity")
    rows = stage.keep(_sample(df, labels, text, toxic, id, sample, stage).repartition(SAMPLE_PARTS), "sample")
    sizes = {(r.toxic, r.fold): r["count"] for r in rows.groupBy("toxic", "fold").count().collect()}
    if len({y for y, _ in sizes}) < 2:
        return Model({}, np.zeros(0), np.zeros(0), 0.5, constant=float(any(y for y, _ in sizes)))
    counted = rows.mapInArrow(_count_tokens, "token string, toxic int, fold int, n long")
    folds = [F.sum(F.when((F.col("fold") == f) & (F.col("toxic") >= y), F.col("n")).otherwise(0)).alias(f"{'nt'[y]}{f}")
             for f in range(FOLDS) for y in (0, 1)]
    table = counted.groupBy("token").agg(*folds, F.sum("n").alias("all")).where(F.col("all") >= LEAST)
    found = table.toArrow()
    index = {token: i for i, token in enumerate(found["token"].to_pylist())}
    seen = np.array([found[f"n{f}"].to_numpy() for f in range(FOLDS)], float)
    bad = np.array([found[f"t{f}"].to_numpy() for f in range(FOLDS)], float)

    def model(index: dict[str, int], left_out: int | None) -> Model:
        use = [f for f in range(FOLDS) if f != left_out]
        texts, toxic = (sum(sizes.get((y, f), 0) for f in use for y in kinds) for kinds in ((0, 1), (1,)))
        return Model(index, bad[use].sum(axis=0), seen[use].sum(axis=0), (toxic + 0.5) / (texts + 1))

    blind = spark.sparkContext.broadcast([model(index, f) for f in range(FOLDS)])

    def calibrating(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []  # a bounded number of texts, with what a text's segments and score classes take
            for content, y, fold in zip(batch["text"], batch["toxic"].to_pylist(), batch["fold"].to_pylist(), strict=True):
                scores = blind.value[fold].scores(tokens_of(content.as_py()))
                bins, many = np.unique(np.round(scores, 2), return_counts=True)
                out.append({"toxic": y, "tokens": len(scores), "sums": [s for _, _, s in segments(scores)],
                            "bins": [] if y else bins.tolist(), "many": [] if y else many.tolist()})
            yield pa.RecordBatch.from_pylist(out, pa.schema([("toxic", pa.int32()), ("tokens", pa.int64()), ("sums", pa.list_(pa.float64())),
                                                            ("bins", pa.list_(pa.float64())), ("many", pa.list_(pa.int64()))]))

    seen_rows = stage.keep(rows.mapInArrow(calibrating, "toxic int, tokens long, sums array<double>, bins array<double>, many array<long>"), "calibration")
    spread = seen_rows.select(F.explode(F.arrays_zip("bins", "many")).alias("x")).groupBy("x.bins").agg(F.sum("x.many").alias("many")).toArrow()
    final = model(index, None)
    if len(spread):
        final.lam = solve_lambda(spread["bins"].to_numpy(), spread["many"].to_numpy().astype(float))
    best = seen_rows.where("toxic = 0 AND tokens > 0").select("tokens", F.coalesce(F.array_max("sums"), F.lit(0.0)).alias("best")).toArrow()
    if len(best):
        final.k = len(best) / float(np.sum(best["tokens"].to_numpy() * np.exp(-final.lam * best["best"].to_numpy())))
    judged = seen_rows.select("toxic", "tokens", "sums").toArrow()
    x = np.array([final.evidence(n, s) for n, s in zip(judged["tokens"].to_pylist(), judged["sums"].to_pylist(), strict=True)])
    final.slope, final.offset = fit_logistic(np.arcsinh(x), judged["toxic"].to_numpy().astype(float))
    blind.unpersist()
    stage.drop("marks", "chosen", "sample", "calibration")
    return final


def score(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``df`` with ``score`` (0 to 1), ``predicted`` (1 from 0.5 on) and ``passages`` (first and last character, log expectation).

    Null and empty texts are texts without tokens: they get the score of no evidence, and no passage. Repeated rows get equal answers; columns of
    these names are replaced; an empty table gives an empty table.
    """
    df = without(df, "score", "predicted", "passages")
    sent = df.sparkSession.sparkContext.broadcast(model)
    kind = pa.struct([("score", pa.float64()), ("passages", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("chance", pa.float64())])))])

    @F.arrow_udf("score double, passages array<struct<start:long,end:long,chance:double>>")
    def judged(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            found = (sent.value.judge(t.as_py()) for t in texts)
            yield pa.array([{"score": s, "passages": [{"start": a, "end": b, "chance": e} for a, b, e in spans]} for s, spans in found], kind)

    columns = [F.col(f"`{c}`") for c in df.columns]
    out = df.select(*columns, judged(F.col(f"`{text}`")).alias("_found"))
    return out.select(*columns, F.col("_found.score").alias("score"), (F.col("_found.score") >= 0.5).cast("int").alias("predicted"),
                      F.col("_found.passages").alias("passages"))


def op12_toxicity(spark, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from four fifths of the labelled ones."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = train(docs.where(~held_out(F.col("doc_id"))), spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic"))
    return score(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", "passages")
