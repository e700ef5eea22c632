import random
import re

import pytest
from pyspark.sql import functions as F

from skyledger.llm import licenses as lic

from .fixtures import DOC, awkward_docs, lower_ascii

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def places(text, phrases=lic.PHRASES):
    words = WORD.findall(lower_ascii(text))
    out = []
    for phrase, label in phrases.items():
        own = WORD.findall(lower_ascii(phrase))
        out += [(i, label) for i in range(len(words) - len(own) + 1) if words[i:i + len(own)] == own]
    return len(words), sorted(out)


def test_matching_statistics_equal_brute_force():
    rng = random.Random(4)
    for _ in range(40):
        sequences = [[rng.randrange(3) for _ in range(rng.randrange(1, 12))] for _ in range(3)]
        auto = lic.Automaton(sequences)
        runs = {tuple(s[i:j]) for s in sequences for i in range(len(s)) for j in range(i + 1, len(s) + 1)}
        text = [rng.randrange(4) for _ in range(60)]
        state = matched = 0
        for i, token in enumerate(text):
            state, matched = auto.step(state, matched, token)
            want = max((n for n in range(i + 2) if n == 0 or tuple(text[i + 1 - n:i + 1]) in runs))
            assert matched == want
            if matched:
                found = tuple(text[i + 1 - matched:i + 1])
                for number, end in auto.ends[state].items():
                    assert tuple(sequences[number][end - matched:end]) == found
                assert set(auto.ends[state]) == {n for n, s in enumerate(sequences) if any(tuple(s[j:j + matched]) == found for j in range(len(s)))}


def test_phrases_in_random_texts():
    rng = random.Random(5)
    scanner = lic.Scanner({"a b": "x", "b": "y", "b a b": "x", "a b a": "z"}, {"t": "a b c a b"})
    for _ in range(100):
        text = " ".join(rng.choice("abcd") for _ in range(rng.randrange(30)))
        found = scanner.scan(text)
        assert (found["n_words"], found["places"]) == places(text, {"a b": "x", "b": "y", "b a b": "x", "a b a": "z"})


def test_template_spans():
    scanner = lic.Scanner(lic.PHRASES, lic.TEMPLATES)
    mit = lic.TEMPLATES["mit-grant"]
    assert scanner.scan(f"Something first.\n{mit} and more")["spans"] == [("mit-grant", 2, 2 + len(lic.words(mit)), 1.0)]
    changed = mit.replace("free of charge", "at no cost").replace("merge, ", "")
    name, start, _, cover = scanner.scan("x " + changed)["spans"][0]
    assert (name, start) == ("mit-grant", 1) and 0.8 <= cover < 1
    assert not scanner.scan(" ".join(mit.split()[:20]))["spans"]
    twice = scanner.scan(f"{mit} {mit}")["spans"]
    assert [s[0] for s in twice] == ["mit-grant"] * 2
    with pytest.raises(ValueError):
        lic.Scanner({"!!": "x"}, {})


def common_runs(text, template, seed):
    """Runs (end in the text, end in the template, length) that go on to neither side."""
    out = []
    for i in range(len(text)):
        for j in range(len(template)):
            n = 0
            while i + n < len(text) and j + n < len(template) and text[i + n] == template[j + n]:
                n += 1
            if n >= seed and (i == 0 or j == 0 or text[i - 1] != template[j - 1]):
                out.append((i + n, j + n, n))
    return out


def every_chain(runs, gap):
    """Best (covered, start) for the last run of a chain, over all chains."""
    best = {}

    def go(run, covered, start):
        best[run] = max(best.get(run, (0, 0)), (covered, start))
        for nxt in runs:
            fresh = min(nxt[2], nxt[0] - run[0], nxt[1] - run[1])
            if fresh > 0 and nxt[0] - fresh - run[0] <= gap:
                go(nxt, covered + fresh, start)
    for run in runs:
        go(run, run[2], run[0] - run[2])
    return best


def plain_spans(text, templates, seed, cover, gap):
    out = []
    for name, template in templates.items():
        size, taken = len(template), []
        best = every_chain(common_runs(text, template, seed), max(gap, size // 2))
        for covered, start, end in sorted(((c, s, r[0]) for r, (c, s) in best.items()), key=lambda x: (-x[0], x[2] - x[1], x[1])):
            if covered >= cover * size and all(end <= a or b <= start for a, b in taken):
                taken.append((start, end))
                out.append((name, start, end, covered / size))
    return sorted(out, key=lambda s: (s[1], s[2], s[0]))


def test_spans_equal_brute_force():
    rng = random.Random(6)
    some = 0
    for _ in range(400):
        templates = {f"t{i}": [rng.choice("abcdef") for _ in range(rng.randrange(4, 14))] for i in range(3)}
        text = []
        for _ in range(rng.randrange(1, 5)):
            own = list(rng.choice(list(templates.values())))
            for _ in range(rng.randrange(3)):
                at = rng.randrange(len(own) + 1)
                own[at:at + rng.randrange(2)] = [rng.choice("abcdefxyz") for _ in range(rng.randrange(4))]
            text += own
        seed, cover, gap = rng.choice([1, 2, 3]), rng.choice([0.5, 0.8]), rng.choice([0, 2, 8])
        if seed == 1:
            text = text[:12]
        want = plain_spans(text, templates, seed, cover, gap)
        scanner = lic.Scanner({"a b": "x"}, {k: " ".join(v) for k, v in templates.items()}, seed, cover, gap)
        assert scanner.scan(" ".join(text))["spans"] == want
        some += len(want)
    assert some > 300


@pytest.mark.parametrize("name", ["mit-grant", "apache-notice", "gpl-notice", "bsd-grant"])
def test_changed_notices_keep_their_label(name):
    own = lic.words(lic.TEMPLATES[name])
    half = len(own) // 2
    for middle in ([f"clause{i}" for i in range(9)], own[:4], own[half - 6:half - 2]):
        spans = lic.Scanner(lic.PHRASES, lic.TEMPLATES).scan(" ".join(own[:half] + middle + own[half:]))["spans"]
        assert (name, 0, len(own) + len(middle)) in [s[:3] for s in spans]


def test_long_text_of_notices():
    scanner = lic.Scanner(lic.PHRASES, lic.TEMPLATES)
    text = " ".join([lic.TEMPLATES["mit-grant"]] * 2000)
    assert [s[0] for s in scanner.scan(text)["spans"]] == ["mit-grant"] * 2000


def test_awkward_rows(spark):
    rows = awkward_docs() + [(900, "MIT License mit-license MIT\tLICENSE, Apache Général Public License GENERAL PUBLIC LICENSE", None, None, None)]
    docs = spark.createDataFrame(rows, DOC).withColumn("Spans", F.lit("clash"))
    for r in lic.scan(docs).collect():
        assert (r.n_words, [(p.start, p.label) for p in r.places]) == places(r.text or "")
    assert lic.scan(docs.limit(0)).count() == 0


def test_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = lic.op4_license_scan(spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        n, found = places(docs[r.doc_id])
        starts = [s for s, _ in found]
        labels = sorted({x for _, x in found})
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == (
            n, len(found), min(starts, default=None), max(starts, default=None), ",".join(labels))
        assert set(labels) <= set(r.labels.split(",")) and 0 <= r.score <= 1 and r.labels == ",".join(sorted(set(r.labels.split(","))))
