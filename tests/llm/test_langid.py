import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyledger.llm import langid

from .fixtures import DOC, LONG, awkward_docs

SF = "/root/testdata/sf0.01"


def plain_kneser_ney(texts, order):
    """Probability function by the textbook definition."""
    grams = [Counter() for _ in range(order + 1)]
    for text in texts:
        line = " " * order + "".join(c for i, c in enumerate(text) if c.isalpha() or (i and text[i - 1].isalpha())).translate(
            {ord(c): " " for c in text if not c.isalpha()})
        for i in range(order, len(line)):
            for n in range(1, order + 1):
                grams[n][line[i - n + 1:i + 1]] += 1
    counts = [None] * (order + 1)
    counts[order] = grams[order]
    for n in range(1, order):
        before = defaultdict(set)
        for g in grams[n + 1]:
            before[g[1:]].add(g[0])
        counts[n] = {g: max(1, len(before[g])) for g in grams[n]}
    floor = 1 / (len(grams[1]) + 1)

    def p(gram):
        n = len(gram)
        if not n:
            return floor
        c = counts[n]
        ones, twos = sum(v == 1 for v in c.values()), sum(v == 2 for v in c.values())
        d = ones / max(1, ones + 2 * twos) if ones else 0.5
        after = [v for g, v in c.items() if g[:-1] == gram[:-1]]
        if not after:
            return p(gram[1:])
        return max(c.get(gram, 0) - d, 0) / sum(after) + d * len(after) / sum(after) * p(gram[1:])
    return p


def test_model_equals_the_definition():
    texts = ["the cat sat on the mat, the hat", "that cat", "é", ""]
    model, p = langid.fit(texts, 3), plain_kneser_ney(texts, 3)
    for text in ["the rat sat", "zzz the", "that hat é cat"]:
        line = "   " + text
        want = [math.log(p(line[i - 2:i + 1])) for i in range(3, len(line))]
        nats, many = langid.cross_entropies([text], [model], 3)
        assert many[0] == len(want) and nats[0, 0] == pytest.approx(-sum(want) / len(want))


def test_probabilities_sum_to_one_less_the_unseen_letter():
    texts = ["abracadabra", "cadabra abra"]
    p = plain_kneser_ney(texts, 3)
    model = langid.fit(texts, 3)
    for context in ["ab", "br", "zz", "  "]:
        assert sum(p(context + c) for c in "abrcd ") == pytest.approx(1 - p(context + "?"))
    assert all((g[1:] >= g[:-1]).all() for g in model.grams[1:])


def test_neighbours_and_stretches_do_not_matter(monkeypatch):
    model = langid.fit(["the cat sat on the mat"])
    texts = ["the cat", LONG[:5000], "", "sat!!  on"]
    together = langid.cross_entropies(texts, [model])[0]
    alone = np.concatenate([langid.cross_entropies([t], [model])[0] for t in texts])
    assert np.allclose(together, alone)
    monkeypatch.setattr(langid, "_CUT", 700)
    nats, many = langid.cross_entropies(texts, [model])
    assert np.allclose(nats, alone, rtol=0.02) and many[2] == 0


def test_awkward_rows(spark):
    docs = spark.createDataFrame(awkward_docs(), DOC).withColumn("Score", F.lit("clash"))
    who = langid.train(docs)
    got = langid.identify(docs, who).collect()
    assert len(got) == len(awkward_docs())
    for r in got:
        assert 0 <= r.score <= 1
        assert (r.lang_pred == "und") == (not any(map(str.isalpha, r.text or "")))
        assert r.lang_pred in ("en", "fr", "und") and (r.lang_pred != "und" or r.rejected)
    assert langid.identify(docs.limit(0), who).count() == 0
    none = langid.train(docs.limit(0))
    assert {r.lang_pred for r in langid.identify(docs, none).collect()} == {"und"}


def test_query_on_held_out_rows(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = langid.op2_langid(spark, SF).collect()
    assert sorted(r.doc_id for r in got) == sorted(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == docs[r.doc_id].lang for r in held) / len(held) > 0.98
    assert sum(r.rejected for r in got) <= len(got) / 100


def test_foreign_script_is_rejected(spark):
    who = langid.train(spark.read.parquet(f"{SF}/documents.parquet"))
    names, score, rejected = who.predict(["Это совсем другой язык, которого модель не видела никогда раньше", "qxzj vkqx zzxq jjkq wxqz kkzx qqxj " * 5])
    assert rejected.all() and all(n != "und" for n in names)


def test_no_column_but_the_text_decides(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    who = langid.train(docs)
    a = langid.identify(docs, who).select("doc_id", "lang_pred", "score").collect()
    b = langid.identify(docs.withColumns({"lang": F.lit("xx"), "source": F.lit(None)}), who).select("doc_id", "lang_pred", "score").collect()
    assert sorted(a) == sorted(b)


def test_every_language_has_a_model(spark):
    """More than 100 languages, one with long texts only; each document has the letters of its language."""
    rows = [(5 * i + j, " ".join(chr(0x4E00 + 20 * i + (k + j) % 20) * 2 for k in range(30)), f"l{i:03d}") for i in range(130) for j in range(5)]
    long = [(1000 + j, "".join("стол и окно "[(k + j) % 12] for k in range(langid.SAMPLE_CHARS)) + " дом" * 500, "long") for j in range(9)]
    docs = spark.createDataFrame(rows + long, "doc_id long, text string, lang string")
    who = langid.train(docs)
    taught = sorted({r.lang for r in docs.where(~langid.held_out(F.col("doc_id"))).collect()})
    assert who.names == taught and len(taught) > 120 and "long" in taught
    for r in langid.identify(docs.where(F.col("lang").isin(taught)), who).collect():
        assert r.lang_pred == r.lang


def test_sample_bounds(spark):
    text = "".join(chr(0x4E00 + i) for i in range(5000))
    got = spark.createDataFrame([(text,), ("short",)], "text string").select(langid.stretched(F.col("text"), 1000)).collect()
    assert got[1][0] == "short" and len(got[0][0]) == 1000 + langid.STRETCHES - 1
    parts = got[0][0].split("\n")
    assert all(p in text and len(p) == 100 for p in parts) and text.startswith(parts[0]) and text.endswith(parts[-1])
    docs = spark.createDataFrame([(i, "abc def" if i % 2 else "xyz " * 9, "en") for i in range(40)], "doc_id long, text string, lang string")
    one, all_ = langid.train(docs, sample=1), langid.train(docs)
    assert len(one.models[0].grams[1]) < len(all_.models[0].grams[1])


@pytest.mark.parametrize("many", [1, 2, 3, 4, 6])
def test_clean_texts_of_small_languages_are_not_rejected(spark, many):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where(~F.col("text").contains("!!"))
    spanish = [r.text for r in docs.where("lang = 'es'").orderBy("doc_id").collect()]
    rest = [(r.doc_id, r.text, r.lang) for r in docs.where("lang != 'es'").limit(300).collect()]
    ids = [i for i in range(10**6, 10**6 + 99) if zlib.crc32(str(i).encode()) % 3 != 1][:many]
    few = [(i, t, "es") for i, t in zip(ids, spanish, strict=False)]
    who = langid.train(spark.createDataFrame(rest + few, "doc_id long, text string, lang string"))
    assert "es" in who.names and np.isfinite(who.mean).all()
    names, _, rejected = who.predict(spanish[many:])
    assert len(names) > 50 and not rejected.any()
    assert who.predict(["Это совсем другой язык, которого модель не видела никогда раньше" * 10])[2].all()


def test_limits_need_evidence():
    model, nats, many = langid.fit_language(["a"])
    assert len(nats) <= 1
    assert langid.fit_language(["", " 1"]) is None
    none = langid.identifier([("xx", (model, np.zeros(0), np.zeros(0)))])
    assert not none.predict(["qqq zzz"])[2].any() and none.predict(["..."])[2].all()
    short, long = langid.deviations(np.array([2.0, -2.0, 0.5, 0.5]), np.array([4, 4, 400, 400]))
    assert short == 4 and long == 0.5


def test_hot_language_and_repeated_rows_meet_in_no_task(spark):
    row = (3, "the same text again and again", "en")
    docs = spark.createDataFrame([row] * 5000 + [(10 + i, f"another text of number {'abcdefghij'[i % 10] * (i % 7 + 1)}", "en") for i in range(400)],
                                 "doc_id long, text string, lang string")
    one = langid.train(docs)
    other = langid.train(docs.distinct())
    assert one.names == other.names == ["en"] and one.mean[0] == other.mean[0]
