"""Secret scans through a trigram inverted index.

Every rule's regular expression is turned into a Boolean query: an OR of clauses, each an AND of trigrams without
which that way through the expression cannot match. Postings (trigram, document) are kept for the trigrams that rules ask for,
over lower-cased text, and intersected clause by clause: a bit per trigram, combined before the shuffle. Only
documents that pass a clause are verified with the expression. A rule with a clause that has no mandatory trigram
is run over every document.

Everything on this path is DataFrame functions. Positions count code points; ends are exclusive.
"""

from __future__ import annotations

from dataclasses import dataclass
from re import _constants as op
from re import _parser as parser

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import without


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` (leftmost, not overlapping) whose ``group`` has ``least`` characters or more."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    scan: str = ""  # a pattern with the same remaining matches that is cheaper to run


#: Patterns and least lengths of the base rules.
BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", "AKIA[A-Z0-9]+", 0, 20, "AKIA[A-Z0-9]{16,}"),
    Rule("hex", "[0-9a-f]+", 0, 24, "[0-9a-f]{24,}"),
)
#: Well-known forms of keys and tokens.
MORE = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
)
#: Ways through an expression, and members of a character class, up to which they are told apart.
WAYS, CLASS = 64, 8

Way = tuple[str | None, ...]  # literals in order; None stands for anything between them


def _join(a: Way, b: Way) -> Way:
    if a and b and a[-1] is not None and b[0] is not None:
        return (*a[:-1], a[-1] + b[0], *b[1:])
    return (*a, *b)


def _ways(items) -> list[Way]:
    """Ways through a parsed expression, each with the literals that it must pass."""
    found: list[Way] = [()]
    for code, arg in items:
        if code is op.LITERAL:
            here = [(chr(arg).lower(),)]
        elif code is op.IN and len(arg) <= CLASS and all(c is op.LITERAL for c, _ in arg):
            here = sorted({(chr(v).lower(),) for _, v in arg})
        elif code is op.BRANCH:
            here = [w for branch in arg[1] for w in _ways(branch)]
        elif code is op.SUBPATTERN:
            here = _ways(arg[3])
        elif code in (op.MAX_REPEAT, op.MIN_REPEAT, op.POSSESSIVE_REPEAT):
            low, high, inner = arg
            once = _ways(inner)
            here = [()] if not low else once
            if (low, high) == (0, 1):
                here = [(), *once]
            elif (low, high) != (1, 1):
                here = [(*w, None) for w in here]
        elif code is op.AT:
            here = [()]
        else:
            here = [(None,)]
        if len(found) * len(here) > WAYS:
            here = [(None,)]
        found = [_join(a, b) for a in found for b in here]
    return found


def trigram_query(pattern: str) -> list[list[str]] | None:
    """Clauses of trigrams of which one must be met whole; None if the expression must be run everywhere."""
    clauses = set()
    for way in _ways(parser.parse(pattern)):
        grams = frozenset(run[i:i + 3] for run in way if run for i in range(len(run) - 2))
        if not grams:
            return None
        clauses.add(grams)
    least = [c for c in clauses if not any(o < c for o in clauses)]
    return sorted(sorted(c) for c in least)


def postings(df: DataFrame, keys: list[str], text: str, rules: tuple[Rule, ...]) -> DataFrame:
    """The inverted index: one row (keys, trigram) for each trigram of the rules' queries in each text."""
    wanted = sorted({g for rule in rules for clause in trigram_query(rule.pattern) or [] for g in clause})
    if not wanted:
        return df.select(*keys, F.lit("").alias("trigram")).where(F.lit(False))
    lower = df.select(*keys, F.lower(text).alias("_lower"))
    return lower.select(*keys, F.explode(F.filter(
        F.array(*[F.lit(g) for g in wanted]), lambda g: F.contains(F.col("_lower"), g))).alias("trigram"))


def candidates(index: DataFrame, keys: list[str], rules: tuple[Rule, ...]) -> DataFrame:
    """Documents that meet a clause of a rule's query: keys and ``rules``, a bit for each rule."""
    spark: SparkSession = index.sparkSession
    table = []
    for r, rule in enumerate(rules):
        for c, clause in enumerate(trigram_query(rule.pattern) or []):
            # a long has room for 62 trigrams; the expression itself verifies the rest
            table += [(g, 1 << r, c, 1 << i, (1 << min(len(clause), 62)) - 1) for i, g in enumerate(clause[:62])]
    if not table:
        return index.select(*keys, F.lit(0).cast("long").alias("rules")).where(F.lit(False))
    names = ("trigram", "rule", "clause", "bit", "all")
    clauses = spark.range(1).select(F.explode(F.array(*[F.struct(*[
        F.lit(v).cast("string" if n == "trigram" else "long").alias(n) for n, v in zip(names, row, strict=True)]) for row in table])).alias("x")).select("x.*")
    met = index.join(clauses, "trigram").groupBy(*keys, "rule", "clause", "all").agg(F.bit_or("bit").alias("bits"))
    met = met.where(F.col("bits") == F.col("all"))
    return met.groupBy(*keys).agg(F.bit_or("rule").alias("rules"))


SPANS = "array<struct<start:int,kind:int,end:int>>"
#: Matches of one text that are added up together.
BLOCK = 256


def _bound(value: Column, use) -> Column:
    """``use`` of ``value``, which is computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _in_blocks(items: Column, start: int, after, result, empty: str) -> Column:
    """``result(block, state)`` of each block of ``items``, joined. ``after(block, state)`` is the state behind a block, an int.

    State arrays grow by copies, so one over all matches of a text would be quadratic; blocks keep that cost constant for each match.
    """
    def cut(all_: Column) -> Column:
        return F.when(F.size(all_) > 0, F.transform(
            F.sequence(F.lit(0), F.floor((F.size(all_) - 1) / BLOCK).cast("int")), lambda b: F.slice(all_, b * BLOCK + 1, BLOCK)))

    def states(blocks: Column) -> Column:
        kind = "struct<at:int,out:array<int>>"
        begin = F.struct(F.lit(start).alias("at"), F.array().cast("array<int>").alias("out")).cast(kind)
        return F.aggregate(blocks, begin, lambda s, b: F.struct(
            after(b, s["at"]).alias("at"), F.concat(s["out"], F.array(s["at"])).alias("out")).cast(kind), lambda s: s["out"])

    joined = _bound(items, lambda all_: _bound(cut(all_), lambda blocks: F.flatten(F.zip_with(blocks, states(blocks), result))))
    return F.coalesce(joined, F.array().cast(empty))


def _spans(text: Column, rule: Rule, number: int) -> Column:
    """Spans of one rule: (start, kind number, end). Pieces between matches and matches alternate."""
    pattern = F.lit(rule.scan or rule.pattern)
    pieces = F.split(text, rule.scan or rule.pattern, -1)
    whole = F.regexp_extract_all(text, pattern, F.lit(0))
    judged = F.regexp_extract_all(text, pattern, F.lit(rule.group))
    kind = f"struct<at:int,out:{SPANS}>"

    def size(x: Column) -> Column:
        return F.char_length(x["piece"]) + F.coalesce(F.char_length(x["whole"]), F.lit(0))

    def step(state: Column, x: Column) -> Column:
        start = state["at"] + F.char_length(x["piece"])
        end = state["at"] + size(x)
        good = x["whole"].isNotNull() & (F.char_length(x["judged"]) >= rule.least)
        span = F.struct(start.alias("start"), F.lit(number).alias("kind"), end.alias("end"))
        return F.struct(end.alias("at"), F.when(good, F.concat(state["out"], F.array(span))).otherwise(state["out"]).alias("out")).cast(kind)

    def of_block(block: Column, at: Column) -> Column:
        return F.aggregate(block, F.struct(at.alias("at"), F.array().cast(SPANS).alias("out")).cast(kind), step, lambda s: s["out"])

    zipped = F.arrays_zip(pieces.alias("piece"), whole.alias("whole"), judged.alias("judged"))
    return _in_blocks(zipped, 0, lambda block, at: at + F.aggregate(block, F.lit(0), lambda n, x: n + size(x)), of_block, SPANS)


def scan(df: DataFrame, rules: tuple[Rule, ...] = BASE + MORE, text: str = "text", id: str = "doc_id") -> DataFrame:
    """Rows of ``df`` with ``spans``: array of (start, kind number, end), by start, then kind.

    A null text counts as empty and has no spans; so do texts without matches. Repeated rows get equal
    answers, and an empty table an empty one. A column of ``df`` named ``spans`` is replaced.

    Postings and candidates carry the id and a hash of the text, so ids that are null or repeated do no harm. The texts
    meet their candidates in one join on that key; it is a join that adaptive execution may split.
    """
    if len(rules) > 62:
        raise ValueError("at most 62 rules in one scan")
    df = without(df, "spans", "_key", "_hash", "_rules")
    content = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    keyed = df.withColumns({"_key": F.col(f"`{id}`"), "_hash": F.xxhash64(content)})
    index = postings(keyed.withColumn("_text", content), ["_key", "_hash"], "_text", rules)
    found = candidates(index, ["_key", "_hash"], rules).withColumnsRenamed({"_key": "_k", "_hash": "_h"})
    joined = keyed.join(found, F.col("_key").eqNullSafe(F.col("_k")) & (F.col("_hash") == F.col("_h")), "left")
    parts = []
    for number, rule in enumerate(rules):
        everywhere = trigram_query(rule.pattern) is None
        asked = F.lit(True) if everywhere else F.col("rules").bitwiseAND(F.lit(1 << number)) != 0
        hit = asked & F.rlike(content, F.lit(rule.scan or rule.pattern))
        parts.append(F.when(hit, _spans(content, rule, number)).otherwise(
            F.array().cast(SPANS)))
    columns = [F.col(f"`{c}`") for c in df.columns]
    return joined.select(*columns, F.array_sort(F.concat(*parts)).alias("spans"))


def redacted(text: Column, spans: Column, mark: str = "[secret]") -> Column:
    """The text with every stretch that spans cover replaced by ``mark``; stretches that overlap become one."""
    kind = "struct<at:int,out:array<string>>"

    def after(block: Column, at: Column) -> Column:
        return F.aggregate(block, at, lambda n, s: F.greatest(n, s["end"]))

    def of_block(block: Column, at: Column) -> Column:
        # a place in a text is found by counting from its front, so each block counts in its own stretch
        return _bound(F.substring(text, at + 1, after(block, at) - at), lambda own: F.aggregate(
            block, F.struct(at.alias("at"), F.array().cast("array<string>").alias("out")).cast(kind), lambda state, s: F.struct(
                F.greatest(state["at"], s["end"]).alias("at"),
                F.when((s["start"] > state["at"]) | (state["at"] == 0), F.concat(state["out"], F.array(
                    F.substring(own, state["at"] - at + 1, s["start"] - state["at"]), F.lit(mark)))).otherwise(state["out"]).alias("out")
            ).cast(kind), lambda state: state["out"]))

    pieces = _in_blocks(spans, 0, after, of_block, "array<string>")
    rest = F.substring(text, F.array_max(F.transform(spans, lambda s: s["end"])) + 1, F.lit(2**31 - 1))
    return F.when(F.size(spans) > 0, F.concat(F.array_join(pieces, ""), rest)).otherwise(text)


def spelled(spans: Column, rules: tuple[Rule, ...] = BASE + MORE) -> Column:
    """``kind:start:end`` of all spans, comma-joined."""
    names = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def _equals(n: int):
    return lambda k: k == n


def op9_secret_scan(spark, sf_dir: str) -> DataFrame:
    """Secrets of every whole document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = scan(docs).drop("text")
    kinds = F.transform("spans", lambda s: s["kind"])
    counts = [F.size(F.filter(kinds, _equals(n))).cast("long").alias(f"n_{rule.kind}") for n, rule in enumerate(BASE)]
    base = F.filter("spans", lambda s: s["kind"] < len(BASE))
    return found.select("doc_id", *counts, F.sha2(spelled(base), 256).alias("base_sha256"), spelled(F.col("spans")).alias("spans"))


def check_sql(rules: tuple[Rule, ...] = BASE + MORE) -> str:
    """The same rows from whole texts without an index."""
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    lists, parts, names = [], [], []
    for n, rule in enumerate(rules):
        rx = quoted(rule.pattern)
        names.append(f"h{n}")
        lists.append(f"string_split_regex(t, {rx}) AS p{n}, regexp_extract_all(t, {rx}, 0) AS w{n}, "
                     f"regexp_extract_all(t, {rx}, {rule.group}) AS g{n}")
        parts.append(f"""
  list_transform(list_filter(range(1, len(w{n}) + 1), lambda i: length(g{n}[i]) >= {rule.least}), lambda i: {{
    'start': length(array_to_string(p{n}[1:i], '')) + length(array_to_string(w{n}[1:i - 1], '')),
    'kind': {n}, 'name': {quoted(rule.kind)}, 'len': length(w{n}[i])}}) AS h{n}""")
    spell = "list_transform(list_sort({}), lambda x: x.name || ':' || x.start::BIGINT || ':' || (x.start + x.len)::BIGINT)"
    base, everything = (spell.format(" || ".join(names[:n])) for n in (len(BASE), len(rules)))
    counts = ", ".join(f"len({names[n]}) AS n_{r.kind}" for n, r in enumerate(BASE))
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
l AS MATERIALIZED (SELECT doc_id, {", ".join(lists)} FROM d),
f AS MATERIALIZED (SELECT doc_id, {", ".join(parts)} FROM l)
SELECT doc_id, {counts}, sha256(array_to_string({base}, ',')) AS base_sha256, array_to_string({everything}, ',') AS spans FROM f
"""
