import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from skyledger.llm import phrases

from .fixtures import DOC, awkward_docs, lower_ascii


def answers(rows, least=10, top=2000):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", lower_ascii(text)):
            w = [x for x in re.split("[ \t]+", piece) if x]
            n[lang] += len(w)
            for k in (1, 2, 3):
                f[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = set()
    for lang, held in f.items():
        cand = {p: a for p, a in held.items() if len(p) > 1 and a >= least}
        gone = {q for p, b in cand.items() if len(p) == 3 for q in (p[:2], p[1:]) if q in cand and 100 * b >= 50 * cand[q]}
        found = []
        for p, a in cand.items():
            if p not in gone:
                score, k = min((1_000_000 * a * a // (held[p[:k]] * held[p[k:]]), k) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), held[p[:k]], held[p[k:]]))
        for i, (score, a, p, l, r) in enumerate(sorted(found)[:top], 1):
            out.add((lang, i, p.decode(), -a, l, r, n[lang], -score))
    return out


def found(df):
    return {tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()}


def text_rows(seed, many=400):
    rng = random.Random(seed)
    words = ["the", "of", "new", "york", "city", "été", "don't", "a\x01b", "…", "state", "gate"]
    mark = [" ", " ", " ", " ", "\t ", ", ", ".", "\n", "\r\n", "; ", "!?"]
    return [(rng.choice(["en", "en", "en", "fr", None, "x\ty"]), "".join(
        rng.choice([rng.choice(words), "New York City", "of the"]) + rng.choice(mark) for _ in range(rng.randrange(60)))) for _ in range(many)]


@pytest.fixture
def small(monkeypatch):
    """So small that containers burst, tries spill, words start anew and partitions merge by ranges."""
    for name, value in {"BURST": 20, "HELD": 150, "NAMES": 9, "PART_BYTES": 2000, "MERGED": 40, "_CUT": 300, "_STRETCH": 16}.items():
        monkeypatch.setattr(phrases, name, value)


def test_counts_of_a_trie_that_bursts():
    rng = random.Random(1)
    keys = [(rng.choice([1, 1, 1, rng.randrange(1, 40)]) << 40) | (rng.randrange(30) << 20) | rng.randrange(9) for _ in range(20_000)]
    trie = phrases.HatTrie(burst=50)
    for i in range(0, len(keys), 700):
        trie.add(phrases.np.array(keys[i:i + 700]))
    assert trie.split[1] and trie.size == len(set(keys))
    got = Counter()
    for k, n in trie.spill(trie.size // 2):
        got.update(dict(zip(k.tolist(), n.tolist(), strict=True)))
    assert trie.size <= len(set(keys)) // 2
    for k, n in trie.spill(0):
        got.update(dict(zip(k.tolist(), n.tolist(), strict=True)))
    assert got == Counter(keys) and trie.size == 0


def test_equals_brute_force(spark):
    rows = text_rows(2)
    df = spark.createDataFrame(rows, "lang string, text string")
    assert found(phrases.collocations(df)) == answers(rows)
    assert found(phrases.collocations(df, least=3, top=7)) == answers(rows, 3, 7)


def test_bursts_spills_and_ranges_change_nothing(spark, small):
    rows = text_rows(3, 150)
    counter = phrases._Counter(5)
    batches = [phrases.pa.RecordBatch.from_pylist([{"lang": a or "und", "text": t} for a, t in rows])]
    runs = [r for b in phrases._runs(iter(batches), 5) for r in b.to_pylist()]
    assert len(runs) > 60 and {r["part"] for r in runs} == set(range(5)) and counter.held == 0
    by = defaultdict(list)
    for r in runs:
        by[r["lang"], r["part"]].append(r)
    got = defaultdict(Counter)
    for (lang, _), held in by.items():
        for r in phrases._merge(phrases.pa.Table.from_pylist(held), 1).to_pylist():
            assert r["phrase"] is None or r["phrase"] not in got[lang]
            got[lang][r["phrase"]] += r["n"]
    want = defaultdict(Counter)
    for lang, text in rows:
        for piece in re.split("[.,;:!?\n-\r]", lower_ascii(text)):
            w = [x for x in re.split("[ \t]+", piece) if x]
            want[lang or "und"].update([None] * len(w))
            for k in (1, 2, 3):
                want[lang or "und"].update(" ".join(w[i:i + k]) for i in range(len(w) - k + 1))
    assert got == want


def test_runs_are_sorted_by_words():
    counter = phrases._Counter(1)
    list(counter.add("en", b"b a! b a b\x01 a c"))
    for batch in counter.spilled(0):
        for run in batch["run"]:
            held = phrases.pa.ipc.open_stream(run.as_buffer()).read_all()["phrase"].to_pylist()
            assert held == sorted(held, key=lambda p: p.split(" "))


def test_exact_beyond_64_bits(spark):
    n = {"a": 3_000_000_000_000, "b": 2_999_999_999_999, "a b": 2_999_999_999_998}
    df = spark.createDataFrame([("en", p, v) for p, v in n.items()], "lang string, phrase string, a long").alias("x")
    got = df.where("phrase = 'a b'").selectExpr(
        "(CAST(1000000 AS DECIMAL(7,0)) * CAST(a AS DECIMAL(15,0)) * CAST(a AS DECIMAL(15,0)))"
        f" div (CAST({n['a']} AS DECIMAL(18,0)) * CAST({n['b']} AS DECIMAL(18,0)))").first()[0]
    assert got == 1_000_000 * n["a b"] ** 2 // (n["a"] * n["b"])


def test_awkward_rows(spark):
    rows = awkward_docs()
    rows += [(950 + i, "one two three. one two three, ONE two", "en", "s", 3) for i in range(9)] + [(970, "x y z " * 400_000, None, "s", 1)]
    docs = spark.createDataFrame(rows, DOC).withColumns({"Phrase": F.lit("clash"), "n": F.lit(-1)})
    assert found(phrases.collocations(docs)) == answers([(r[2], r[1]) for r in rows])
    assert phrases.collocations(docs.limit(0)).count() == 0
    assert phrases.collocations(docs.withColumn("text", F.lit(None).cast("string"))).count() == 0
