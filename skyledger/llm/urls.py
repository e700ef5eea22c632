"""URL filters: listed rules first, then association rules mined from labelled urls.

A url becomes a set of tokens: host labels by their distance from the end, path words, query names; digits count as ``#``. FP-growth
mines the combinations of tokens that go with a label. A combination becomes a rule if its support and the lower bound
of its confidence suffice and no part of it is as good a rule; it may have any number of tokens. Rules are found through an
inverted index: each is listed under its rarest token, urls meet it there, and its other tokens are then compared.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Stage, without


@dataclass(frozen=True)
class Listed:
    """A rule for a host with all its subdomains and the paths that begin with ``path``."""

    verdict: str
    host: str
    path: str


#: The listed rules.
LISTED = (
    Listed("block", "net", "/"), Listed("allow", "example.net", "/en/"),
    Listed("block", "example.com", "/de/"), Listed("allow", "org", "/fr/"),
)
#: Share of labelled urls with a combination, lower bound of its confidence (at 95 per cent).
SUPPORT, CONFIDENCE = 0.002, 0.7
#: Tokens up to which a test compares rules with brute force. Rules have any number of tokens.
TOKENS = 4
DEFAULT = "allow"


def host(url: Column) -> Column:
    """What follows the first ``://``, up to a slash, question mark, hash or the end; A-Z lower-cased."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path(url: Column) -> Column:
    """What follows the host, up to a question mark, hash or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def listed(host_: Column, path_: Column, rules: tuple[Listed, ...]) -> tuple[Column, Column]:
    """Rule (host and path) and verdict of the longest listed rule that fits; null if none does."""
    rule = verdict = None
    for r in sorted(rules, key=lambda r: (-len(r.host + r.path), r.host + r.path)):
        fits = ((host_ == r.host) | host_.endswith("." + r.host)) & path_.startswith(r.path)
        rule = (F if rule is None else rule).when(fits, r.host + r.path)
        verdict = (F if verdict is None else verdict).when(fits, r.verdict)
    nothing = F.lit(None).cast("string")
    return (nothing, nothing) if rule is None else (rule, verdict)


def tokens(url: Column) -> Column:
    """Distinct tokens: ``h1:`` for the last host label, ``h2:`` for the one before, ``p:`` path words, ``q:`` query names."""
    plain = lambda part: F.regexp_replace(part, "[0-9]+", "#")
    labels = F.filter(F.reverse(F.split(host(url), r"\.")), lambda x: x != "")
    words = F.filter(F.split(F.lower(path(url)), r"[^\p{L}\p{N}]+"), lambda x: x != "")
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"\?([^#]*)", 1)
    names = F.filter(F.transform(F.split(F.lower(query), "&"), lambda x: F.substring_index(x, "=", 1)), lambda x: x != "")
    return F.array_distinct(F.concat(
        F.transform(labels, lambda x, i: F.concat(F.lit("h"), (i + 1).cast("string"), F.lit(":"), plain(x))),
        F.transform(words, lambda x: F.concat(F.lit("p:"), plain(x))),
        F.transform(names, lambda x: F.concat(F.lit("q:"), plain(x)))))


def mine(labelled: DataFrame, stage: Stage, support: float = SUPPORT, confidence: float = CONFIDENCE) -> DataFrame:
    """Rules from ``labelled`` (url, label): ``tokens, label, seen, confidence, key``; the key is the rarest token.

    Rows without url or label teach nothing. A rule's confidence is the lower bound of the Wilson interval, so few
    sightings alone make no rule. Rules are few: each holds a share ``support`` of all labelled urls. Tokens that are always together are
    mined as one, so any number of them costs no more than one.
    """
    none = F.lit(None).cast("string")
    rows = stage.keep(labelled.where(F.col("url").isNotNull() & F.col("label").isNotNull()).select(
        F.monotonically_increasing_id().alias("row"), "label", tokens(F.col("url")).alias("tokens")), "labelled")
    n = rows.count()
    if not n:
        return labelled.select(F.array(none).alias("tokens"), none.alias("label"), F.lit(0).cast("long").alias("seen"),
                               F.lit(0.0).alias("confidence"), none.alias("key")).where(F.lit(False))
    same = stage.keep(_always_together(rows, support * n), "same")
    # only the few frequent tokens meet the rows; rows without any stay
    merged = rows.select("row", "label", F.explode_outer("tokens").alias("token")).join(same, "token", "left").groupBy("row", "label").agg(
        F.collect_set("class").alias("classes"))
    items = merged.select(F.concat("classes", F.array(F.concat(F.lit("="), F.col("label")))).alias("items"))
    sets = stage.keep(FPGrowth(itemsCol="items", minSupport=support, minConfidence=0.0).fit(items).freqItemsets, "itemsets")
    is_label = lambda x: F.startswith(x, F.lit("="))
    split = sets.select(
        F.array_sort(F.filter("items", lambda x: ~is_label(x))).alias("tokens"),
        F.filter("items", is_label).alias("labels"), F.col("freq").alias("seen"))
    whole = split.where("size(labels) = 0 AND size(tokens) > 0").select("tokens", F.col("seen").alias("all"))
    with_label = split.where("size(labels) = 1 AND size(tokens) > 0").select("tokens", F.substring(F.col("labels")[0], 2, 1 << 20).alias("label"), "seen")
    z = 1.96
    p = F.col("seen") / F.col("all")
    bound = (p + z * z / (2 * F.col("all")) - z * F.sqrt((p * (1 - p) + z * z / (4 * F.col("all"))) / F.col("all"))) / (1 + z * z / F.col("all"))
    good = stage.keep(with_label.join(whole, "tokens").select("tokens", "label", "seen", bound.alias("confidence"))
                      .where(F.col("confidence") >= confidence), "good")
    # a rule is idle if one with fewer of its tokens is as sure; looked up through each left-out token
    less = good.select("tokens", "label", "confidence", F.explode("tokens").alias("out")).select(
        F.col("tokens").alias("full"), "label", F.col("confidence").alias("own"),
        F.array_except("tokens", F.array("out")).alias("tokens"))
    idle = less.join(good, ["tokens", "label"]).where("confidence >= own").select(F.col("full").alias("tokens"), "label").distinct()
    rules = good.join(idle, ["tokens", "label"], "left_anti")
    # of tokens that are always together a rule holds one: with two it would be idle. So each choice of one for each class is a rule
    members = rules.select("tokens", "label", "seen", "confidence", F.explode("tokens").alias("class")).join(
        same.groupBy("class").agg(F.collect_list("token").alias("members"), F.first("all").alias("all")), "class")
    choices = members.groupBy("tokens", "label", "seen", "confidence").agg(F.collect_list(
        F.transform("members", lambda t: F.struct(F.col("all"), t.alias("token")))).alias("members"))
    pair = "array<array<struct<all:bigint,token:string>>>"
    chosen = F.aggregate("members", F.array(F.array()).cast(pair), lambda found, more: F.flatten(F.transform(
        found, lambda x: F.transform(more, lambda t: F.concat(x, F.array(t))))))
    return stage.keep(choices.select("label", "seen", "confidence", F.explode(chosen).alias("x")).select(
        F.array_sort(F.transform("x", lambda t: t["token"])).alias("tokens"), "label", "seen", "confidence",
        F.array_min("x")["token"].alias("key")), "rules")


def _always_together(rows: DataFrame, least: float) -> DataFrame:
    """``token, class, all``: tokens in at least ``least`` rows, the first token that is in exactly the same rows, and their number.

    Mining grows with the subsets of tokens that come together, so tokens that always do are mined as one. Equal counts and sums
    of row hashes propose a class; it stands if no row has some but not all of its tokens.
    """
    each = rows.select("row", F.explode("tokens").alias("token"))
    code = F.xxhash64("row")
    counted = each.groupBy("token").agg(F.count(F.lit(1)).alias("all"), F.sum(code.cast("decimal(20,0)")).alias("sum"), F.bit_xor(code).alias("xor"))
    classes = counted.where(F.col("all") >= least).groupBy("all", "sum", "xor").agg(F.collect_set("token").alias("members")).select(
        F.array_min("members").alias("class"), F.size("members").alias("size"), "all", "members")
    proposed = classes.select("class", "size", "all", F.explode("members").alias("token"))
    # frequent tokens are at most the tokens of a url over the support, however many rows there are
    broken = each.join(F.broadcast(proposed.where("size > 1")), "token").groupBy("row", "class", "size").agg(F.count(F.lit(1)).alias("n")).where(
        "n != size").select("class", F.lit(True).alias("broken")).distinct()
    return proposed.join(broken, "class", "left").select("token", F.when(F.col("broken"), F.col("token")).otherwise(F.col("class")).alias("class"), "all")


def judge(df: DataFrame, labelled: DataFrame, url: str = "url", rules: tuple[Listed, ...] = LISTED) -> DataFrame:
    """``df`` with ``host``, ``path``, ``rule``, ``verdict``, ``mined`` (the tokens of the mined rule that decided) and ``confidence``.

    The longest listed rule decides. Where none fits, the surest mined rule does (ties: more tokens, then their order), and ``allow`` where
    none of these fits. Null urls and urls without ``://`` have an empty host and path. Each distinct url is judged
    once and joined back, so a repeated url costs no more. Columns of these names are replaced; an empty table gives an
    empty table.
    """
    stage = Stage(df.sparkSession, "urls")
    df = without(df, "host", "path", "rule", "verdict", "mined", "confidence")
    found = mine(labelled, stage)
    distinct = stage.keep(df.select(F.col(f"`{url}`").alias("_url")).where("_url IS NOT NULL").distinct().select(
        "_url", tokens(F.col("_url")).alias("_tokens")), "distinct")
    met = distinct.select("_url", "_tokens", F.explode("_tokens").alias("key")).join(found, "key")
    met = met.where(F.size(F.array_except("tokens", "_tokens")) == 0)
    best = met.groupBy("_url").agg(F.max_by(
        F.struct("label", "tokens", "confidence"), F.struct("confidence", F.size("tokens"), "tokens", "label")).alias("_best"))
    joined = df.join(best, df[url] == best["_url"], "left")
    rule, verdict = listed(host(F.col(f"`{url}`")), path(F.col(f"`{url}`")), rules)
    columns = [F.col(f"`{c}`") for c in df.columns]
    mined = F.when(rule.isNull(), F.col("_best"))
    return joined.select(
        *columns, host(F.col(f"`{url}`")).alias("host"), path(F.col(f"`{url}`")).alias("path"), rule.alias("rule"),
        F.coalesce(verdict, mined["label"], F.lit(DEFAULT)).alias("verdict"),
        F.array_join(mined["tokens"], " ").alias("mined"), mined["confidence"].alias("confidence"))


def op5_url_filter(spark, sf_dir: str) -> DataFrame:
    """Every page's url. Labels: a listed rule's verdict, else the page's row in ``labels`` (toxic or of low quality: block)."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    marks = spark.read.parquet(f"{sf_dir}/labels.parquet").groupBy("doc_id").agg(
        F.max(((F.col("toxic") == 1) | (F.col("quality") == 0)).cast("int")).alias("bad"))
    _, verdict = listed(host(F.col("url")), path(F.col("url")), LISTED)
    known = F.when(F.col("bad") == 1, "block").when(F.col("bad") == 0, "allow")
    labelled = pages.join(marks, pages["page_id"] == marks["doc_id"], "left").select("url", F.coalesce(verdict, known).alias("label"))
    return judge(pages, labelled).drop("url")
