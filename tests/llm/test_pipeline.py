from collections import defaultdict

import corpus_pipeline as cp
from pyspark.sql import functions as F

from skyledger.llm import packing

from .fixtures import DOC, awkward_docs
from .test_dedup import near_answers
from .test_packing import check
from .test_secrets import plain

SF = "/root/testdata/sf0.01"


def redacted(text):
    out, at = [], 0
    for a, _, b in plain(text):
        if a > at or not at:
            out += [text[at:a], "[secret]"]
        at = max(at, b)
    return "".join(out) + (text or "")[at:]


def expected(rows):
    """Documents that reach packing, by brute force, from those that language ID has kept."""
    lower = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)
    by = {}
    for r in sorted(rows, key=lambda r: -1 if r[0] is None else r[0]):
        by[lower(r[1])] = r
    rows = list(by.values())
    kept = {id for id, _, least in near_answers(rows, k=5) if id == least}
    return {r[0]: redacted(r[1]) for r in rows if r[0] in kept}


def test_stages_on_awkward_rows(spark):
    rows = awkward_docs() + [(800, "a note with password=abcdef123 in it", "en", "s", 36)]
    docs = spark.createDataFrame(rows, DOC)
    for name, stage in cp.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
        if name == "language_id":
            known = [tuple(r) for r in docs.collect()]
            assert not {r[1] for r in known} & {None, "", " "} and 2 * len(known) > len(rows)
    got = {r.doc_id: r for r in docs.collect()}
    assert {i: r.text for i, r in got.items()} == expected(known)
    assert all(r.lang for r in got.values())
    empty = spark.createDataFrame([], DOC)
    for _, stage in cp.STAGES:
        empty = stage(spark, empty, SF)
    assert empty.count() == 0


def test_run_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert all(any(map(str.isalpha, t)) for _, t in rows)
    want = {i: len(t.encode()) + 1 for i, t in expected(rows).items()}
    got = cp.run(spark, SF).collect()
    sizes = defaultdict(int)
    for r in got:
        sizes[r.doc_id] += r.tokens
    assert dict(sizes) == want
    check(got, packing.LENGTHS, want)


def test_names_and_order():
    assert [n for n, _ in cp.STAGES] == ["language_id", "exact_dedup", "near_dedup", "secret_scan", "best_fit_packing"]
    assert cp.ORACLE_SQL is None


def test_secrets_are_gone(spark):
    docs = spark.createDataFrame([(1, "token = abcdef1 and AKIA" + "A" * 16, "en", "s", 40), (2, "clean text", "en", "s", 10)], DOC)
    out = {r.doc_id: r.text for r in cp.redact_secrets(spark, docs, SF).collect()}
    assert out == {1: "[secret] and [secret]", 2: "clean text"}
    assert cp.redact_secrets(spark, docs.withColumn("text", F.lit(None).cast("string")), SF).where("text is not null").count() == 0


def test_a_language_without_a_model_stays(spark):
    import zlib

    held = next(i for i in range(10**6, 10**6 + 99) if zlib.crc32(str(i).encode()) % 3 == 1)
    text = "стол и окно и дом на берегу реки"
    rows = [(i, f"plain words of number {'abcdefg'[i % 7]}", "en", "s", 9) for i in range(40)]
    docs = spark.createDataFrame([*rows, (held, text, "ru", "s", 9), (held + 300_000, text, None, "s", 9), (held, None, "ru", "s", 0)], DOC)
    kept = {(r.doc_id, r.lang) for r in cp.keep_known_languages(spark, docs, SF).collect()}
    assert kept == {(r[0], "en") for r in rows} | {(held, "ru")}
