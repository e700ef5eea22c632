import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from skyledger.llm import packing

from .fixtures import DOC, awkward_docs

SF = "/root/testdata/sf0.01"


def check(rows, lengths, sizes):
    """Every token lies in one bin once, no bin overlaps or overflows, and none could be shorter."""
    bins, cover = defaultdict(list), defaultdict(list)
    for r in rows:
        bins[r.bin_id].append(r)
        cover[r.doc_id].append((r.piece_start, r.tokens))
    for parts in bins.values():
        parts.sort(key=lambda r: r.bin_offset)
        at = 0
        for r in parts:
            assert r.bin_offset == at
            at += r.tokens
        assert len({r.bin_length for r in parts}) == 1
        assert parts[0].bin_length == min(x for x in lengths if x >= at)
    for id, spans in cover.items():
        assert sum(n for _, n in spans) == sizes[id]
    return bins


def test_best_fit_by_hand():
    bins, offsets, final = packing.best_fit([7, 5, 3, 3, 2], [4, 8], [4, 8])
    assert bins == [0, 1, 1, 2, 2] and offsets == [0, 0, 5, 0, 3] and final == [8, 8, 8]
    assert packing.best_fit([3], [4, 8], [4, 8])[2] == [4]
    # a dear long bin is opened only for what needs it
    assert packing.best_fit([8, 4, 3], [4, 8], [4, 20]) == ([0, 1, 2], [0, 0, 0], [8, 4, 4])


def plain_best_fit(sizes, lengths, costs):
    """The rule, bin by bin: the fullest bin with room, else the size with the least cost per token that holds the piece."""
    bins, placed = [], []
    for size in sizes:
        fits = [b for b, (length, used) in enumerate(bins) if length - used >= size]
        if fits:
            b = min(fits, key=lambda b: (bins[b][0] - bins[b][1], b))
        else:
            b = len(bins)
            holds = [i for i, length in enumerate(lengths) if length >= size]
            bins.append([lengths[min(holds, key=lambda i: (costs[i] / lengths[i], -lengths[i]))], 0])
        placed.append((b, bins[b][1]))
        bins[b][1] += size
    cheapest = lambda used: min((costs[i], length) for i, length in enumerate(lengths) if length >= used)[1]
    return [b for b, _ in placed], [at for _, at in placed], [cheapest(used) for _, used in bins]


def least_cost(sizes, lengths, costs):
    """The cheapest of all ways to share out the pieces."""
    def share(rest, loads):
        if not rest:
            return sum(min(c for c, length in zip(costs, lengths, strict=True) if length >= used) for used in loads)
        more = [loads[:i] + [used + rest[0]] + loads[i + 1:] for i, used in enumerate(loads) if used + rest[0] <= max(lengths)]
        return min(share(rest[1:], x) for x in [*more, [*loads, rest[0]]])
    return share(sizes, [])


def test_best_fit_equals_the_plain_rule():
    rng = random.Random(8)
    for _ in range(300):
        lengths = sorted(rng.sample(range(4, 40), 3))
        costs = sorted(rng.uniform(1, 60) for _ in lengths)
        sizes = sorted((rng.randint(1, lengths[-1]) for _ in range(rng.randrange(40))), reverse=True)
        assert packing.best_fit(sizes, lengths, costs) == plain_best_fit(sizes, lengths, costs)


def test_cost_against_all_ways():
    rng = random.Random(9)
    spent = best = longest = 0
    for _ in range(150):
        sizes = sorted((rng.randint(100, 5000) for _ in range(6)), reverse=True)
        price = dict(zip(packing.LENGTHS, packing.COSTS, strict=True))
        cost = sum(price[x] for x in packing.best_fit(sizes, packing.LENGTHS, packing.COSTS)[2])
        least = least_cost(sizes, packing.LENGTHS, packing.COSTS)
        assert least <= cost + 1e-9
        spent, best = spent + cost, best + least
        longest += sum(price[x] for x in packing.best_fit(sizes, packing.LENGTHS, packing.LENGTHS)[2])
    assert spent < 1.1 * best and spent < longest


def test_registered_costs_decide():
    # a piece up to 4,096 opens a bin of 4,096 although 8,192 is permitted; a longer one opens 8,192
    assert packing.best_fit([3000, 3000], packing.LENGTHS, packing.COSTS) == ([0, 1], [0, 0], [4096, 4096])
    assert packing.best_fit([5000, 3000], packing.LENGTHS, packing.COSTS) == ([0, 0], [0, 5000], [8192])


def test_awkward_rows(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP", 15)
    monkeypatch.setattr(packing, "COPIES", 4)
    rows = [r for r in awkward_docs() if r[0] is not None] + [awkward_docs()[3]] * 30
    docs = spark.createDataFrame(rows, DOC).withColumns({"Bin_Id": F.lit("clash"), "tokens": F.lit("clash")})
    sized = docs.withColumn("size", F.octet_length("text"))
    got = packing.pack(sized.repartition(3), "size", "doc_id", [64, 512, 1000]).collect()
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[0]] += max(1, len((r[1] or "x").encode()))
    check(got, [64, 512, 1000], sizes)
    assert len({r.bin_id >> 32 for r in got}) > 5
    key = lambda r: (r.doc_id, r.piece, r.bin_id, r.bin_offset)
    again = packing.pack(sized.repartition(8), "size", "doc_id", [64, 512, 1000]).collect()
    assert sorted(map(key, got)) == sorted(map(key, again))
    assert packing.pack(sized.limit(0), "size", "doc_id", [8]).count() == 0
    for bad in ([], [0, 4]):
        with pytest.raises(ValueError):
            packing.pack(sized, "size", "doc_id", bad)


def test_null_ids_and_costs(spark):
    rows = spark.createDataFrame([(None, 3), (None, None), (1, 9), (1, -5)], "doc_id long, size long")
    got = packing.pack(rows, "size", "doc_id", [4, 8], [1.0, 5.0]).collect()
    assert sum(r.tokens for r in got) == 3 + 1 + 9 + 1


def test_query_packs_tightly(spark):
    docs = {r.doc_id: len(r.text.encode()) + 1 for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    bins = check(packing.op10_best_fit_packing(spark, SF).collect(), packing.LENGTHS, docs)
    room = sum(parts[0].bin_length for parts in bins.values())
    assert sum(docs.values()) / room > 0.98
