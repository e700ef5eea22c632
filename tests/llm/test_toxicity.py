import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyledger.llm import toxicity

from .fixtures import DOC, LONG, awkward_docs

SF = "/root/testdata/sf0.01"


def plain_segments(scores, a, b):
    """By definition: the best stretch (the shortest, first), then the same left and right of it."""
    total = np.concatenate(([0], np.cumsum(scores)))
    best = max(((total[j] - total[i], i - j, -i, i, j) for i in range(a, b) for j in range(i + 1, b + 1)), default=(0, 0, 0, 0, 0))
    if best[0] <= 0:
        return []
    return plain_segments(scores, a, best[3]) + [best[3:]] + plain_segments(scores, best[4], b)


def test_segments_equal_the_definition():
    rng = np.random.default_rng(3)
    for _ in range(300):
        scores = rng.normal(-0.3, 1, rng.integers(0, 25))
        got = toxicity.segments(scores)
        assert [(a, b) for a, b, _ in got] == plain_segments(scores, 0, len(scores))
        assert all(s == pytest.approx(scores[a:b].sum()) for a, b, s in got)


def test_segments_are_linear():
    assert toxicity.segments(np.zeros(5)) == []
    rng = np.random.default_rng(4)
    assert len(toxicity.segments(rng.normal(-0.2, 1, 300_000))) > 1000


def test_share_of_a_chain_counts_each_text_once():
    base = 0.1
    assert toxicity.share_of([], base) == base
    alone = toxicity.share_of([(4, 5)], base)
    assert toxicity.share_of([(4, 5)] * 6, base) == pytest.approx(alone)
    assert alone == pytest.approx((4 + 3 * 0.1) / 8)
    assert toxicity.share_of([(40, 41), (4, 4)], base) > toxicity.share_of([(4, 41), (4, 4)], base)


def test_lambda_solves_the_equation():
    scores, weights = np.array([-1.0, -0.5, 2.0]), np.array([80.0, 15.0, 5.0])
    lam = toxicity.solve_lambda(scores, weights)
    assert lam > 0.1 and weights @ np.exp(lam * scores) == pytest.approx(weights.sum(), rel=1e-6)
    assert toxicity.solve_lambda(np.array([-1.0]), np.array([3.0])) == 1.0


def test_logistic_fit():
    rng = np.random.default_rng(5)
    x = rng.normal(0, 2, 20_000)
    y = (rng.random(len(x)) < 1 / (1 + np.exp(-(1.5 * x - 1)))).astype(float)
    slope, offset = toxicity.fit_logistic(x, y)
    assert slope == pytest.approx(1.5, abs=0.1) and offset == pytest.approx(-1, abs=0.1)
    assert toxicity.fit_logistic(np.ones(9), np.zeros(9))[0] == 0


def planted(many=900, seed=6):
    rng = random.Random(seed)
    plain = ["stone", "river", "cloud", "table", "green", "paper", "north", "seven", "quiet", "light"]
    rows = []
    for i in range(many):
        words = [rng.choice(plain) + rng.choice(["", "s", "y", "er"]) for _ in range(rng.randrange(20, 120))]
        toxic = i % 6 == 0
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), "grobb" + rng.choice(["le", "ling", "lest", "i", "o", "um"]))
        rows.append((i, " ".join(words), int(toxic)))
    return rows


def test_planted_stems_are_found_in_new_forms(spark):
    model = toxicity.train(spark.createDataFrame(planted(), "doc_id long, text string, toxic int"))
    assert model.lam > 0 and model.k > 0 and model.slope > 0
    score, spans = model.judge("stone rivers cloud grobbzak table GROBBLEST greener " + "paper " * 50)
    text = "stone rivers cloud grobbzak table GROBBLEST greener "
    assert score > 0.5 and {text[a:b].lower() for a, b, _ in spans} & {"grobbzak", "grobblest", "grobbzak table grobblest"}
    assert all(e < math.log(toxicity.SIGNIFICANT) for *_, e in spans)
    assert model.judge("stone rivers cloud tabler " * 20)[0] < 0.5
    assert model.judge("unseen things of all kinds, none of them known")[0] < 0.5
    new = planted(seed=7)
    right = [(model.judge(t)[0] >= 0.5) == bool(y) for _, t, y in new]
    assert sum(right) / len(right) > 0.98


def test_scores_follow_the_expected_number_of_chance_segments(spark):
    """In clean texts the best segment exceeds its limit about as often as the extreme-value law says."""
    model = toxicity.train(spark.createDataFrame(planted(3000), "doc_id long, text string, toxic int"))
    best = []
    for _, t, y in planted(3000, 8):
        if not y:
            words = toxicity.tokens_of(t)
            best.append(min((model.chance(s, len(words)) for *_, s in toxicity.segments(model.scores(words))), default=9))
    assert np.mean(np.array(best) < math.log(0.01)) < 0.05


def test_awkward_rows(spark):
    rows = awkward_docs()
    docs = spark.createDataFrame(rows, DOC).withColumns({"Score": F.lit("clash"), "toxic": F.when(F.col("doc_id") % 7 == 0, 1).when(F.col("doc_id") % 7 < 5, 0)})
    model = toxicity.train(docs)
    got = toxicity.score(docs, model).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        assert by.setdefault(r.text, r.score) == r.score
        assert all(0 <= p.start < p.end <= len(r.text) for p in r.passages)
    assert by[None] == by[""] == by[" "] and LONG in by
    assert toxicity.score(docs.limit(0), model).count() == 0
    for kept, value in ((docs.where("toxic = 0"), 0.0), (docs.where("toxic = 1"), 1.0), (docs.limit(0), 0.0), (docs.withColumn("toxic", F.lit(5)), 0.0)):
        assert {r.score for r in toxicity.score(docs, toxicity.train(kept)).collect()} == {value}


def test_copies_of_a_text_teach_once(spark):
    rows = planted(300)
    copies = rows + [(1000 + i, rows[0][1], 1) for i in range(500)]
    one, other = (toxicity.train(spark.createDataFrame(r, "doc_id long, text string, toxic int")) for r in (rows, copies))
    assert len(one.index) == len(other.index) and one.base == other.base


def test_sample_has_a_bound(spark):
    df = spark.createDataFrame(planted(2000), "doc_id long, text string, toxic int").drop("doc_id")
    stage = toxicity.Stage(spark, "test")
    sizes = {r.toxic: r["count"] for r in toxicity._sample(df, None, "text", "toxic", "doc_id", 100, stage).groupBy("toxic").count().collect()}
    assert all(60 < n < 150 for n in sizes.values())


def test_labels_of_their_own_table(spark):
    rows = planted(300)
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    again = spark.createDataFrame([(i, y) for i, _, y in rows] + [(0, 0), (77_777, 1), (None, 1)], "doc_id long, toxic int")
    one, other = toxicity.train(df), toxicity.train(df.drop("toxic").union(df.drop("toxic").limit(5)), again)
    assert one.index.keys() == other.index.keys() and one.slope == pytest.approx(other.slope)


def test_query_on_held_out_rows(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    got = toxicity.op12_toxicity(spark, SF).collect()
    assert len(got) == 1000
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    held = [(r.score, labels[r.doc_id]) for r in got if r.held_out and r.doc_id in labels]
    assert sum((s >= 0.5) == bool(y) for s, y in held) / len(held) > 0.92
    assert not any(s >= 0.5 for s, y in held if not y)
    pairs = [(a > b) + 0.5 * (a == b) for a, y in held for b, z in held if y and not z]
    assert sum(pairs) / len(pairs) > 0.9


def test_labels_of_held_out_rows_teach_nothing(spark):
    docs = spark.createDataFrame(planted(400), "doc_id long, text string, toxic int")
    held = toxicity.held_out(F.col("doc_id"))
    models = [toxicity.train(docs.withColumn("toxic", F.when(held, y).otherwise(F.col("toxic"))).where(~held)) for y in (0, 1)]
    assert models[0].index.keys() == models[1].index.keys() and models[0].slope == models[1].slope
