"""Small tables with the awkward cases, and the answers of plain Python."""

import random

LONG = " ".join(f"word{i % 977}" for i in range(40_000))
DOC = "doc_id long, text string, lang string, source string, n_chars long"


def awkward_docs(seed=1):
    """Copies, near copies around one text, nulls, empty and very long texts, repeated rows, odd letters."""
    rng = random.Random(seed)
    words = ["alpha", "beta", "gamma", "delta", "été", "straße", "ñandú", "omega", "sigma", "tau", "phi", "rho"]
    base = [rng.choice(words) + str(rng.randrange(50)) for _ in range(60)]
    texts = [None, "", " ", "One", "one", "Two words", "two WORDS", "ÉTÉ", "été", LONG, LONG + " end", LONG.upper()]
    texts += [" ".join(base)] * 5
    for _ in range(30):
        near = list(base)
        for _ in range(rng.randrange(1, 4)):
            near[rng.randrange(len(near))] = "changed" + str(rng.randrange(99))
        texts.append(" ".join(near))
    texts += [" ".join(rng.choice(words) + str(rng.randrange(500)) for _ in range(rng.randrange(1, 90))) for _ in range(40)]
    rows = [(i, t, rng.choice(["en", "fr", None]), rng.choice(["hot", "hot", None, "s"]), None if t is None else len(t)) for i, t in enumerate(texts)]
    rows += [rows[12], rows[12], rows[0], (None, "no id here at all", "en", None, 3)]
    return rows


def lower_ascii(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def shingles(text, k=4):
    words = (text or "").encode().lower().split()
    if not words:
        return set()
    return {tuple(words[i:i + k]) for i in range(max(1, len(words) - k + 1))}


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=lambda r: tuple((x is None, str(x)) for x in r))
