import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from skyledger.llm import spelling

from .fixtures import DOC, awkward_docs, lower_ascii

SF = "/root/testdata/sf0.01"


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def answers(n, ratio=5):
    """word: (form, root, n, n_near, form_n), from all pairs that share a word with one letter left out."""
    groups = defaultdict(set)
    for w in n:
        for g in {w, *(w[:i] + w[i + 1:] for i in range(len(w)))}:
            groups[g].add(w)
    near = {w: set() for w in n}
    for g in groups.values():
        for a in g:
            near[a].update(b for b in g if one_edit(a, b))
    form = {}
    for w, around in near.items():
        if around and n[best := min(around, key=lambda x: (-n[x], x))] >= ratio * n[w]:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w
    return {w: (form.get(w), root(w), n[w], len(near[w]), n[form[w]] if w in form else None) for w in n}


def counted(rows, every=199, length=6, count=5):
    n = Counter()
    for id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower_ascii(run)
            h = zlib.crc32(f"{'' if id is None else id}:{run}".encode())
            if every and h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= length and k >= count}


def found(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def some_words(seed, many=700, letters="abcé", longest=9):
    rng = random.Random(seed)
    words = sorted({"".join(rng.choice(letters) for _ in range(rng.randrange(2, longest))) for _ in range(many)})
    return {w: rng.choice([1, 2, 5, 9, 30, 150, 800]) for w in words}


def test_search_schemes_find_each_pair_once():
    words = sorted(some_words(1))
    index = spelling.BidirectionalIndex(words)
    pairs = [{(words[q], words[w]) for q, w in zip(*spelling.near_words(words, index, words, s), strict=True)} for s in (0, 1)]
    assert not pairs[0] & pairs[1]
    assert pairs[0] | pairs[1] == {(a, b) for a in words for b in words if one_edit(a, b)}


def test_intervals_on_both_sides_hold_the_same_places():
    words = ["banana", "ananas", "bandana"]
    index = spelling.BidirectionalIndex(words)
    codes = index.codes(["ana", "ban", "zzz"])
    assert codes[2].tolist() == [-1, -1, -1]
    row, lo, hi = index.turn(0, codes[:, ::-1])  # |ana..., |ban...
    assert row.tolist() == [0, 1] and (hi - lo).tolist() == [1, 2]
    row, lo, hi = index.turn(1, codes)  # ...ana|
    assert row.tolist() == [0] and (hi - lo).tolist() == [2]


def test_ranks_count_symbols():
    text = spelling.np.array([0, 2, 1, 2, 2, 0] * 40)
    ranks = spelling.Ranks(text, 3)
    bwt = text[ranks.order - 1]
    for place in (0, 1, 63, 64, 65, 200, 240):
        for symbol in range(3):
            assert ranks.count(spelling.np.array([symbol]), spelling.np.array([place]))[0] == (bwt[:place] == symbol).sum()


@pytest.mark.parametrize("block", [5, 60, 20_000])
def test_blocks_and_cut_groups_do_not_matter(spark, block):
    n = some_words(2)
    got = found(spelling.variants(spark.createDataFrame(list(n.items()), "word string, n long"), block=block))
    assert got == answers(n)


def test_chains_are_followed_to_their_end(spark):
    words = ["aaaaaaaaaa"[:10 - i] + "bbbbbbbbbb"[:i] for i in range(11)]
    n = {w: 5 ** i for i, w in enumerate(words)}
    got = found(spelling.variants(spark.createDataFrame(list(n.items()), "word string, n long")))
    assert got == answers(n) and got[words[0]][1] == words[-1]


def test_ties_and_thresholds(spark):
    n = {"colour": 10, "coloured": 2, "color": 50, "colours": 50, "colou": 49, "x": 9, None: 3}
    got = found(spelling.variants(spark.createDataFrame(list(n.items()), "word string, n long")))
    assert got["colour"] == ("color", "color", 10, 3, 50) and got["coloured"][0] is None
    assert set(got) == {w for w in n if w and len(w) > 1}


def test_awkward_rows(spark):
    rows = [*awkward_docs(), (900, "déjà-vu ×÷× ABCDEFGH abcdefgh " * 9, "fr", "s", 1), (901, "y" * 3_000 + " " + "y" * 2_999, "en", "s", 1)]
    docs = spark.createDataFrame(rows, DOC).withColumn("Word", F.lit("clash"))
    for every, length, count in ((199, 6, 5), (3, 4, 1)):
        words = spelling.vocabulary(docs, every=every, length=length, count=count)
        n = counted([r[:2] for r in rows], every, length, count)
        assert {r.word: r.n for r in words.collect()} == n
        assert found(spelling.variants(words)) == answers(n)
    assert spelling.variants(spelling.vocabulary(docs.limit(0))).count() == 0


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    want = answers(counted(rows))
    got = spelling.op11_spelling_variants(spark, SF)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert found(got) == want and sum(x[0] is not None for x in want.values()) > 20
