import zlib

import pytest
from pyspark.sql import functions as F

from skyledger.llm import sharding

from .fixtures import DOC, awkward_docs

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("rows", [1, 2, 3, 7, 64, 1000, 5000])
def test_places_are_a_permutation_with_an_inverse(spark, rows):
    shard, slot = sharding.place(F.col("id"), rows, 3, 5)
    got = spark.range(rows).select("id", shard.alias("shard"), slot.alias("slot")).withColumn(
        "back", sharding.number_at(F.col("shard"), F.col("slot"), rows, 3, 5)).collect()
    assert sorted(r.slot * 3 + r.shard for r in got) == list(range(rows))
    assert all(r.back == r.id for r in got)
    if rows >= 1000:
        assert sum(r.id == r.slot * 3 + r.shard for r in got) < rows / 50


def check(rows, shards):
    sizes = [sum(r.shard == s for r in rows) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    for s in range(shards):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sizes[s]))


def test_awkward_rows_and_layouts(spark):
    docs = spark.createDataFrame(awkward_docs(), DOC).withColumn("Slot", F.lit("taken"))
    a = sharding.shard(docs, 4, 9).collect()
    b = sharding.shard(docs.repartition(7), 4, 9).collect()
    check(a, 4)
    key = lambda r: (str(r.doc_id), r.shard, r.slot)
    assert sorted(map(key, a)) == sorted(map(key, b))
    assert sorted(map(key, a)) != sorted(map(key, sharding.shard(docs, 4, 10).collect()))
    assert sharding.shard(docs.limit(0), 4).count() == 0
    with pytest.raises(ValueError):
        sharding.shard(docs, 0)


def test_rows_repeated_beyond_a_run(spark, monkeypatch):
    monkeypatch.setattr(sharding, "COPIES", 10)
    rows = sharding.shard(spark.range(203).select(F.lit(1).alias("x"), F.lit(None).cast("string").alias("y")), 5).collect()
    check(rows, 5)


def test_query(spark):
    got = sharding.op1_sharding(spark, SF).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert len(got) == len(docs)
    check(got, 8)
    for r in got:
        data = (docs[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(data) + 1, zlib.crc32(data), "rows", None)
