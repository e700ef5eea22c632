import hashlib
import re
import time

from pyspark.sql import functions as F

from skyledger.llm import secret_scan as ss

from .fixtures import DOC, awkward_docs

SF = "/root/testdata/sf0.01"
HEX = "0123456789abcdef" * 2


def plain(text, rules=ss.BASE + ss.MORE):
    found = []
    for n, rule in enumerate(rules):
        for m in re.finditer(rule.pattern, text or ""):
            if len(m.group(rule.group)) >= rule.least:
                found.append((m.start(), n, m.end()))
    return sorted(found)


TEXTS = [
    None, "", "password", "password=", "password=short", "password=longer", "PASSWORD : 'longer1'", "été token=\"abcdef\" ñ",
    "secret: token: abcdefgh", "api_key==abcdefg api-key=abcdefg APIKEY:abcdefg", "passwd=token=abcdefgh", "AKIA" + "A" * 15, "AKIA" + "B" * 16 + "xAKIA" + "9" * 30,
    "akia" + "A" * 20, HEX, "x" + HEX[:24] + "y" + HEX[:23], "token=" + HEX, "𝔘𝔫𝔦 password=abcdefg 𝔠", "word " * 5000 + "secret=zzzzzzzz " + "word " * 5000,
    "ghp_" + "a1B2" * 9, "eyJhbGciOiJI.eyJzdWIiOiIx.SflKxwRJSMeK", "-----BEGIN RSA PRIVATE KEY-----", "xoxb-1234567890-abc", "token=abcdef token=ghijkl " * 200,
    "pass the word, secretary of tokens", "token\n=abcdefg", "token  =  abcdefg", "Ken tokKen=abcdefg",
]


def test_trigram_queries():
    assert ss.trigram_query("ab[0-9]+cdef") == [["cde", "def"]]
    assert ss.trigram_query("(abc|xyz)?def") == [["def"]]
    assert ss.trigram_query("ab?cde") == [["abc", "bcd", "cde"], ["acd", "cde"]]
    assert ss.trigram_query("(abcd)+e") == [["abc", "bcd"]]
    assert ss.trigram_query("[0-9a-f]+") is None and ss.trigram_query("abc|d") is None
    assert ss.trigram_query(ss.BASE[0].pattern)[4] == ["cre", "ecr", "ret", "sec"]


def test_every_match_meets_its_query():
    for rule in ss.BASE + ss.MORE:
        clauses = ss.trigram_query(rule.pattern)
        for text in TEXTS:
            if clauses and re.search(rule.pattern, text or ""):
                assert any(all(g in text.lower() for g in clause) for clause in clauses)


def test_spans_on_awkward_texts(spark):
    rows = awkward_docs() + [(1000 + i, t, "en", "s", 0) for i, t in enumerate(TEXTS)] + [(None, TEXTS[5], None, None, None), (1005, TEXTS[5], "en", "s", 0)]
    docs = spark.createDataFrame(rows, DOC).withColumn("Spans", F.lit("clash")).repartition(5)
    got = ss.scan(docs)
    plan = got._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    got = got.select("doc_id", "text", "spans", ss.redacted(F.coalesce("text", F.lit("")), F.col("spans")).alias("clean")).collect()
    assert len(got) == len(rows)
    for r in got:
        spans = [tuple(s) for s in r.spans]
        assert spans == plain(r.text), r.text
        covered = {i for a, _, b in spans for i in range(a, b)}
        if not covered:
            assert r.clean == (r.text or "")
        assert r.clean.replace("[secret]", "") == "".join(c for i, c in enumerate(r.text or "") if i not in covered)
    assert ss.scan(docs.limit(0)).count() == 0


def test_candidates_are_few_and_enough(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    rules = ss.BASE + ss.MORE
    index = ss.postings(docs, ["doc_id"], "text", rules)
    found = {r.doc_id: r.rules for r in ss.candidates(index, ["doc_id"], rules).collect()}
    for i, text in enumerate(TEXTS):
        for n, rule in enumerate(rules):
            if ss.trigram_query(rule.pattern) and re.search(rule.pattern, text or ""):
                assert found[i] >> n & 1
    assert 0 not in found and 1 not in found and not any(found.get(i, 0) & 2 for i in range(10))


def test_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = ss.op9_secret_scan(spark, SF).collect()
    assert len(rows) == len(docs)
    names = [r.kind for r in ss.BASE + ss.MORE]
    for r in rows:
        spans = plain(docs[r.doc_id])
        said = [f"{names[k]}:{a}:{b}" for a, k, b in spans]
        base = [x for x, s in zip(said, spans, strict=True) if s[1] < 3]
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(s[1] == k for s in spans) for k in range(3))
        assert r.spans == ",".join(said) and r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()


def test_rule_with_a_long_literal(spark):
    for n in (64, 65, 66, 70):
        literal = "".join(chr(97 + i * i % 23) + chr(97 + i * 7 % 26) for i in range(n))[:n]
        rule = ss.Rule("long", literal)
        assert len(ss.trigram_query(literal)[0]) > 60
        docs = spark.createDataFrame([(1, "x " + literal + " y"), (2, literal[:-1])], "doc_id long, text string")
        got = {r.doc_id: [tuple(s) for s in r.spans] for r in ss.scan(docs, (rule,)).collect()}
        assert got == {1: [(2, 0, 2 + n)], 2: []}


def test_texts_with_thousands_of_secrets_take_linear_time(spark):
    def seconds(n):
        text = "".join(f"token=abc{i:06d} ü AKIA{'B' * 16}{i}\n" for i in range(n // 2))
        docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
        start = time.perf_counter()
        r = ss.scan(docs).select("spans", ss.redacted(F.col("text"), F.col("spans")).alias("clean")).first()
        took = time.perf_counter() - start
        assert [tuple(s) for s in r.spans] == plain(text) and len(r.spans) == n // 2 * 2
        assert r.clean == "[secret] ü [secret]\n" * (n // 2)
        return took

    seconds(600)
    assert seconds(25_600) < 2.5 * max(1, seconds(12_800))
