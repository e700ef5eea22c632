import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyledger.llm import exact_dedup, near_dedup

from .fixtures import DOC, LONG, awkward_docs, lower_ascii, rows_of, shingles

SF = "/root/testdata/sf0.01"


def exact_answers(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[lower_ascii(r[1])].append(r[0])
    largest = {k: max((i for i in ids if i is not None), default=None) for k, ids in groups.items()}
    return sorted(((r[0], largest[lower_ascii(r[1])], len(groups[lower_ascii(r[1])])) for r in rows), key=str)


def test_exact_on_awkward_rows(spark):
    rows = awkward_docs()
    docs = spark.createDataFrame(rows, DOC).withColumn("kept", F.lit("clash")).repartition(5)
    got = exact_dedup.exact_dedup(docs).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size) for r in got), key=str) == exact_answers(rows)
    kept = [r for r in got if r.kept]
    assert len(kept) == len({lower_ascii(r[1]) for r in rows})
    assert all(r.doc_id == r.keep_id for r in kept)
    assert exact_dedup.exact_dedup(docs.limit(0)).count() == 0


def test_exact_digits_end_on_every_edge(spark):
    rows = [(i, "x" * n + end) for i, (n, end) in enumerate((n, e) for n in (0, 1, 62, 63, 64, 65, 319, 320, 321, 1344, 1345) for e in ("", "", "y"))]
    got = exact_dedup.exact_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size) for r in got), key=str) == exact_answers(rows)


def test_exact_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = exact_dedup.op7_exact_dedup(spark, SF).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size) for r in got), key=str) == exact_answers(docs)
    texts = {r.doc_id: r.text for r in docs}
    assert all(r.text_sha256 == hashlib.sha256(lower_ascii(texts[r.doc_id]).encode()).hexdigest() for r in got)
    assert all(r.kept == (r.doc_id == r.keep_id) for r in got)


def near_answers(rows, k=4, percent=80):
    sets = [shingles(r[1], k) for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    at = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            at[x].append(i)
    common = defaultdict(int)
    for ids in at.values():
        for a in ids:
            for b in ids:
                if a < b:
                    common[a, b] += 1
    for (a, b), n in common.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            root[find(a)] = find(b)
    least = defaultdict(list)
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)].append(r[0])
    return sorted(((r[0], len(sets[i]), min(least[find(i)], default=None)) for i, r in enumerate(rows)), key=str)


def test_near_on_awkward_rows(spark):
    rows = awkward_docs()
    docs = spark.createDataFrame(rows, DOC).withColumn("component_id", F.lit("clash")).repartition(3)
    got = near_dedup.near_dedup(docs)
    assert rows_of(got, "doc_id", "n_shingles", "component_id") == sorted(near_answers(rows), key=lambda r: tuple((x is None, str(x)) for x in r))
    assert all(r.kept == (r.doc_id == r.component_id) for r in got.collect())
    assert near_dedup.near_dedup(docs.limit(0)).count() == 0


def test_near_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = near_dedup.op8_near_dedup(spark, SF).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == near_answers(docs)


def test_bucket_whose_first_leader_is_apart(spark):
    """A chain: each text is near its neighbours only, so no single leader links them all."""
    words = [f"w{i}" for i in range(140)]
    rows = [(i, " ".join(words[i * 4:i * 4 + 100])) for i in range(11)] + [(50 + i, " ".join(f"{i}x{j}" for j in range(30))) for i in range(3)]
    got = near_dedup.near_dedup(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()), key=str) == near_answers(rows)


@pytest.mark.parametrize("percent", [60, 80, 95])
def test_strays_meet_members_of_other_sizes(spark, monkeypatch, percent):
    """Chains of texts that grow step by step, in blocks of a few texts: links lead over size classes and blocks."""
    monkeypatch.setattr(near_dedup, "BLOCK_BYTES", 2000)
    monkeypatch.setattr(near_dedup, "LEAD_BYTES", 1000)
    rng, rows = random.Random(percent), []
    for chain in range(6):
        n = 20 + chain * 3
        for step in range(14):
            rows.append((100 * chain + step, " ".join(f"c{chain}w{j}" for j in range(n))))
            n = n * 100 // percent if rng.random() < 0.7 else n + 1
            if n > 600:
                break
    got = near_dedup.near_dedup(spark.createDataFrame(rows, "doc_id long, text string"), percent=percent)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()), key=str) == near_answers(rows, percent=percent)


def test_word_hashes_and_sets():
    texts = ["One two\tTHREE\x0bfour five".encode(), b"", "été one two".encode(), b"  ", b"one two three four", LONG.encode()]
    words, counts = near_dedup.word_hashes(texts)
    assert counts.tolist() == [5, 0, 3, 0, 4, 40_000]
    assert words[0] == words[6] == words[8] and words[0] != words[1]
    sets, sizes = near_dedup.shingle_sets(texts, 4)
    assert sizes.tolist() == [len(shingles(t.decode())) for t in texts]
    assert set(sets[:2]) & set(sets[3:4]) == set(sets[3:4])


def test_sketches_fill_and_estimate():
    rng = np.random.default_rng(3)
    pool = rng.integers(0, 2**63, 3000).astype(np.uint64)
    sets = [pool[:1], pool[:5], pool[:1000], pool[100:1100], pool]
    table = near_dedup.sketches(np.concatenate(sets), np.array([len(s) for s in sets]))
    assert (table != np.uint64(0xFFFFFFFFFFFFFFFF)).all()
    agree = (table[2] == table[3]).mean()
    assert agree == pytest.approx(900 / 1100, abs=0.15)
    alone = near_dedup.sketches(sets[2], np.array([1000]))
    assert (alone[0] == table[2]).all()


def test_pairs_on_a_low_threshold_meet(spark):
    """200 pairs with 20 of 40 shingles in common."""
    rows = []
    for i in range(200):
        same = [f"s{i}x{j}" for j in range(23)]
        rows += [(2 * i + e, " ".join(same + [f"e{e}y{i}z{j}" for j in range(10)])) for e in (0, 1)]
    got = near_dedup.near_dedup(spark.createDataFrame(rows, "doc_id long, text string"), percent=50)
    assert got.where("kept").count() == 200
    assert near_dedup.band_count(80) == near_dedup.BANDS == near_dedup.band_count(100)
    for percent in range(12, 101):
        n = near_dedup.band_count(percent)
        assert (1 - (percent / 100) ** (near_dedup.BINS // n)) ** n <= 1e-5
    for percent in (-1, 0, 5, 101):
        with pytest.raises(ValueError):
            near_dedup.near_dedup(spark.createDataFrame(rows[:2], "doc_id long, text string"), percent=percent)
