from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyledger.llm import embedding

SF = "/root/testdata/sf0.1"


def plain(rows, cosine=0.98):
    """Links by all pairs."""
    groups = defaultdict(list)
    for i, (_, v, label) in enumerate(rows):
        if v is not None and label is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v):
            groups[label, len(v)].append(i)
    links, root = [0] * len(rows), list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for members in groups.values():
        m = np.array([rows[i][1] for i in members], float)
        m /= np.abs(m).max(axis=1)[:, None]
        m /= np.linalg.norm(m, axis=1)[:, None]
        for x, y in zip(*np.where(np.triu(m @ m.T >= cosine, 1)), strict=True):
            a, b = members[x], members[y]
            links[a] += 1
            links[b] += 1
            root[find(a)] = find(b)
    least = defaultdict(list)
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)].append(r[0])
    return sorted(((r[0], links[i], min(least[find(i)], default=None)) for i, r in enumerate(rows)), key=str)


def answers(df):
    rows = df.collect()
    assert all(r.kept == (r.vec_id == r.component_id) for r in rows)
    return sorted(((r.vec_id, r.n_links, r.component_id) for r in rows), key=str)


def cluster_rows(seed=2, around=120, dim=24):
    rng = np.random.default_rng(seed)
    rows = [(1, None, 0), (2, [], 0), (3, [0.0] * dim, 0), (4, [1.0, None] * (dim // 2), 0), (5, [float("nan")] * dim, 0), (6, [float("inf")] * dim, 0)]
    rows += [(7, [1.0] * dim, None), (8, [1.0] * dim, 0), (9, [2.0] * dim, 0), (10, [1.0] * dim, 1), (11, [1.0] * 3, 0), (12, [1e300] * dim, 1), (13, [-1.0] * dim, 0)]
    at = 20
    for label in range(3):
        centre = rng.normal(size=dim)
        for _ in range(around):
            noise = rng.normal(size=dim) * np.linalg.norm(centre) / np.sqrt(dim) * rng.choice([0.05, 0.14, 0.2])
            rows.append((at, [float(x) for x in centre + noise], label))
            at += 1
    rows += [rows[-1], rows[-1], (None, rows[-1][1], 2), (None, None, None)]
    return rows


def test_awkward_rows(spark, monkeypatch):
    monkeypatch.setattr(embedding, "BLOCK", 40)
    rows = cluster_rows()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("n_links", F.lit("clash")).repartition(5)
    got, want = answers(embedding.near_embeddings(df)), plain(rows)
    assert [g[::2] for g in got] == [w[::2] for w in want]
    assert sum(g[1] for g in got) >= 0.999 * sum(w[1] for w in want) and all(g[1] <= w[1] for g, w in zip(got, want, strict=True))
    assert embedding.near_embeddings(df.limit(0)).count() == 0


def test_query_equals_all_pairs(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert answers(embedding.op3_near_embeddings(spark, SF)) == plain(rows)


@pytest.mark.parametrize("vectors", [1, 1000, 10**6, 10**9])
def test_count_is_calibrated(vectors):
    plan = embedding.Plan.of(0.98, vectors)
    rng = np.random.default_rng(0)
    a = rng.normal(size=(400, 64))
    a /= np.linalg.norm(a, axis=1)[:, None]
    b = rng.normal(size=(400, 64))
    b -= (a * b).sum(1)[:, None] * a
    b /= np.linalg.norm(b, axis=1)[:, None]
    b = 0.98 * a + np.sqrt(1 - 0.98**2) * b
    (na, la), (nb, lb) = plan.project(a), plan.project(b)
    met = ((na == nb) & (np.abs(la - lb) <= plan.window)).sum(1)
    assert (met >= plan.count).mean() > 0.995 and plan.count >= 2
    other = np.roll(np.arange(400), 1)
    assert ((na == na[other]) & (np.abs(la - la[other]) <= plan.window)).mean() < 0.5 * embedding.CELL / max(vectors, embedding.CELL) + 0.02
