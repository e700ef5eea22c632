import random
import re

from pyspark.sql import functions as F

from skyledger.llm import urls
from skyledger.llm.common import Stage

SF = "/root/testdata/sf0.01"
ODD = [None, "", "no scheme", "http://", "HTTP://A.Example.NET/en/x", "http://example.net", "http://example.net/", "http://net/en/", "http://xnet/",
       "http://a.example.com/de/?q=1#x", "http://example.com/dev/", "x://b.org/fr/1?://", "http://u@h.net:80/p", "a://b://c.net/", "http://x.org/fr", "http://é.net/\n/x"] + ["http://hot.net/same"] * 5


def plain(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (re.sub("[A-Z]", lambda c: c.group().lower(), m[1]), m[2]) if m else ("", "")
    fits = [r for r in urls.LISTED if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.host + r.path), default=None)
    return host, path, best and best.host + best.path, best and best.verdict


def test_parts_and_listed_rules(spark):
    df = spark.createDataFrame([(i, u) for i, u in enumerate(ODD)], "page_id long, url string").withColumn("Host", F.lit("clash"))
    got = urls.judge(df, df.select("url", F.lit(None).cast("string").alias("label"))).collect()
    assert len(got) == len(ODD)
    for r in got:
        host, path, rule, verdict = plain(r.url)
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, rule, verdict or "allow"), r.url
    assert urls.judge(df.limit(0), df.select("url", F.lit("allow").alias("label"))).count() == 0


def test_mined_rules_equal_brute_force(spark):
    rng = random.Random(7)
    rows = []
    for _ in range(400):
        host = rng.choice(["win", "news", "shop"]) + "." + rng.choice(["aa", "bb"])
        path = rng.choice(["bet", "read", "buy"])
        bad = "win" in host and path == "bet" or rng.random() < 0.02
        rows.append((f"http://{host}/{path}/{rng.randrange(99)}", "block" if bad else "allow"))
    rows += [(None, "block"), ("http://x.y/z", None)]
    df = spark.createDataFrame(rows, "url string, label string")
    rules = urls.mine(df, Stage(spark, "test"), support=0.01)
    got = {(tuple(r.tokens), r.label) for r in rules.collect()}
    sets = [(set(r.t), r.label) for r in df.where("url is not null and label is not null").select(urls.tokens(F.col("url")).alias("t"), "label").collect()]
    from itertools import combinations

    def bound(ts, label):
        n = sum(set(ts) <= s for s, _ in sets)
        k = sum(set(ts) <= s and x == label for s, x in sets)
        if k < 0.01 * len(sets):
            return 0
        p, z = k / n, 1.96
        return (p + z * z / 2 / n - z * ((p * (1 - p) + z * z / 4 / n) / n) ** 0.5) / (1 + z * z / n)

    every = sorted(set().union(*(s for s, _ in sets)))
    want = set()
    for n in range(1, urls.TOKENS + 1):
        for ts in combinations(every, n):
            for label in ("allow", "block"):
                b = bound(ts, label)
                if b >= urls.CONFIDENCE and not any(bound(c, label) >= max(b, urls.CONFIDENCE) for c in combinations(ts, n - 1) if c):
                    want.add((ts, label))
    assert got == want and any(x == "block" for _, x in got)
    fresh = spark.createDataFrame([("http://win.cc/bet/5",), ("http://news.cc/read/5",), ("http://q.cc/",)], "url string")
    verdicts = {r.url: r.verdict for r in urls.judge(fresh, df, rules=()).collect()}
    assert list(verdicts.values()).count("block") == 1 and verdicts["http://win.cc/bet/5"] == "block"


def test_query(spark):
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url").collect()}
    got = urls.op5_url_filter(spark, SF).collect()
    assert len(got) == len(pages)
    for r in got:
        host, path, rule, verdict = plain(pages[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule) and r.verdict == (verdict or r.verdict) and r.verdict in ("allow", "block")


def test_rules_of_every_size_equal_brute_force(spark):
    """Six tokens that only together go with ``block``: each smaller part goes with both labels."""
    from itertools import combinations, product

    rows = []
    for bits in product("ab", repeat=6):
        url = "http://h{}.t{}/p{}/q{}/r{}?s{}=1".format(*bits)
        rows += [(url, "block" if set(bits) == {"a"} else "allow")] * (40 if set(bits) == {"a"} else 12 if bits.count("b") == 1 else 1)
    df = spark.createDataFrame(rows, "url string, label string")
    got = {(tuple(r.tokens), r.label) for r in urls.mine(df, Stage(spark, "test"), support=0.01).collect()}
    sets = [(frozenset(r.t), r.label) for r in df.select(urls.tokens(F.col("url")).alias("t"), "label").collect()]
    every = sorted(frozenset().union(*(s for s, _ in sets)))

    def bound(ts, label):
        n = sum(s.issuperset(ts) for s, _ in sets)
        k = sum(x == label and s.issuperset(ts) for s, x in sets)
        if not n or k < 0.01 * len(sets):
            return 0
        p, z = k / n, 1.96
        return (p + z * z / 2 / n - z * ((p * (1 - p) + z * z / 4 / n) / n) ** 0.5) / (1 + z * z / n)

    sure = {(ts, x): b for n in range(1, 7) for ts in combinations(every, n) for x in ("allow", "block") if (b := bound(ts, x)) >= urls.CONFIDENCE}
    want = {(ts, x) for (ts, x), b in sure.items() if not any(sure.get((c, x), 0) >= b for c in combinations(ts, len(ts) - 1))}
    assert got == want and {len(ts) for ts, x in got if x == "block"} >= {6}
    fresh = spark.createDataFrame([("http://ha.ta/pa/qa/ra?sa=2",), ("http://ha.ta/pa/qa/rb?sa=2",)], "url string")
    assert {r.url[-7:-5]: r.verdict for r in urls.judge(fresh, df, rules=()).collect()} == {"ra": "block", "rb": "allow"}


def test_tokens_that_are_always_together_are_mined_as_one(spark):
    """25 query names of one form, which every url of a bad shop has: one rule each, as by brute force over all pairs, in seconds."""
    names = [f"n{chr(97 + i)}" for i in range(25)]
    rows = [("http://shop.aa/buy?" + "&".join(f"{n}=1" for n in names), "block")] * 8
    rows += [("http://news.aa/read", "allow")] * 900 + [("http://shop.aa/buy?na=1&x=2", "allow")] * 100
    df = spark.createDataFrame(rows, "url string, label string")
    got = {(tuple(r.tokens), r.label): (r.seen, r.key) for r in urls.mine(df, Stage(spark, "test"), confidence=0.6).collect()}
    block = {k: v for k, v in got.items() if k[1] == "block"}
    assert block == {((f"q:{n}",), "block"): (8, f"q:{n}") for n in names[1:]}
    assert {t for t, x in got if x == "allow"} >= {("p:read",), ("h2:news",), ("q:x",)}
