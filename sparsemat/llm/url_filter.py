"""URL filters: fixed rules, then a tree of path templates per host.

Everything here is DataFrame and SQL functions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

#: (verdict, host/path) of the rules that the contract names.
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)

#: Levels of the tree; what lies deeper is part of the last one.
LEVELS = 4

#: A level with more branches, most of them rare, is generalised to a wildcard.
FAN_OUT, RARE = 32, 8

#: Pseudo-counts of the parent's purity, the standard errors within which branches are alike,
#: and the smoothed share of blocked urls from which a template is rejected.
PRIOR, ALIKE, REJECT = 8.0, 2.0, 0.6

#: A url that no rule decides counts as so much of an allowed one: rules mostly name what is bad.
UNDECIDED = 0.5

#: Share of blocked urls that a host is taken to have before its urls are seen.
BACKGROUND = 0.2


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    text = F.coalesce(url.cast("string"), F.lit(""))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(F.regexp_extract(text, pattern, 1), upper, upper.lower()), F.regexp_extract(text, pattern, 2)


def match_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, null if none does; the first in order of ties."""
    rule = verdict = None
    for kind, name in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        at, _, rest = name.partition("/")
        fits = ((host == at) | host.endswith(f".{at}")) & path.startswith(f"/{rest}")
        rule = F.when(fits, F.lit(name)) if rule is None else rule.when(fits, F.lit(name))
        verdict = F.when(fits, F.lit(kind)) if verdict is None else verdict.when(fits, F.lit(kind))
    none = F.lit(None).cast("string")
    return (none, none) if rule is None else (rule, verdict)


def segments(path: Column) -> Column:
    """``LEVELS`` segments (empty where the path ends); numbers, dates and long hexadecimal strings are ``*``."""
    parts = F.filter(F.split(path, "/"), lambda s: s != "")

    def general(s: Column) -> Column:
        return F.regexp_replace(F.regexp_replace(s, r"(?i)[0-9a-f]{8,}(-[0-9a-f]{4,})*", "*"), r"[0-9]+([-_.]?[0-9]+)*", "*")

    def levels(p: Column) -> Column:
        tail = F.when(F.size(p) > LEVELS, F.array_join(F.slice(p, LEVELS, F.greatest(F.size(p), F.lit(1))), "/")).otherwise(F.get(p, F.lit(LEVELS - 1)))
        return F.transform(F.array(*(F.get(p, F.lit(k)) for k in range(LEVELS - 1)), tail), lambda s: F.coalesce(general(s), F.lit("")))

    return F.transform(F.array(parts), levels)[0]


def _tree(nodes: DataFrame) -> DataFrame:
    """``nodes`` with ``template`` and ``purity``, the template's smoothed share of blocked urls.

    ``nodes``: ``host, s0.., n, labelled, blocked``, one row per distinct list of segments.
    Level by level, under each parent: if there are many branches the rare ones become a
    wildcard; branches whose share of blocked labels is within ``ALIKE`` standard errors of
    their parent's are merged under a wildcard too; each branch's share is smoothed towards
    its parent's. All of it is sums by parent and branch, joined back.
    """
    weight = F.sum(F.col("labelled") + UNDECIDED * (F.col("n") - F.col("labelled")))
    hosts = nodes.groupBy("host").agg(weight.alias("l"), F.sum("blocked").alias("b"))
    purity = (F.col("b") + PRIOR * BACKGROUND) / (F.col("l") + PRIOR)
    nodes = nodes.join(hosts.select("host", purity.alias("purity")), "host").withColumn("template", F.col("host"))
    one = F.lit(1)
    for k in range(LEVELS):
        key = ["template", f"s{k}"]
        branch = nodes.groupBy(*key).agg(
            F.sum("n").alias("n"), weight.alias("l"), F.sum("blocked").alias("b"), F.max("purity").alias("above")
        )
        branch = materialize(branch, "branches")
        fan = branch.groupBy("template").agg(F.count("*").alias("fan"))
        rare = (F.col("fan") > FAN_OUT) & (F.col("n") < RARE)
        error = F.sqrt(F.greatest(F.col("above") * (1 - F.col("above")), F.lit(0.01)) / F.greatest("l", one))
        alike = F.abs(F.col("b") / F.greatest("l", one) - F.col("above")) <= ALIKE * error
        name = F.when(F.col(f"s{k}") == "", F.lit("")).when(rare | alike, F.lit("/*"))
        name = name.otherwise(F.concat(F.lit("/"), F.col(f"s{k}")))
        branch = branch.join(fan, "template").withColumn("t", name)
        merged = branch.groupBy("template", "t").agg(F.sum("l").alias("l"), F.sum("b").alias("b"), F.max("above").alias("above"))
        share = (F.col("b") + PRIOR * F.col("above")) / (F.col("l") + PRIOR)
        named = branch.select(*key, "t").join(merged.select("template", "t", share.alias("share")), ["template", "t"])
        nodes = nodes.join(named, key).withColumn("template", F.concat("template", "t")).withColumn("purity", F.col("share"))
        nodes = materialize(nodes.drop("t", "share"), "templates")
    return nodes


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, key: str = "page_id", url: str = "url") -> DataFrame:
    """``(page_id, host, path, rule, verdict, template)`` for every row.

    The longest rule that fits decides. The urls that rules decide are the labels by which
    the tree judges the others: a template is rejected if its smoothed share of blocked urls
    reaches ``REJECT``; a host without any label is allowed. Null urls and urls without ``://`` have empty host and path and are allowed;
    rows keep their number, empty input gives no rows.
    """
    host, path = split_url(F.col(url))
    rows = pages.select(F.col(key).alias("page_id"), host.alias("host"), path.alias("path"))
    rule, verdict = match_rule(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": rule, "fixed": verdict, "s": segments(F.col("path"))})
    levels = [f"s{k}" for k in range(LEVELS)]
    rows = rows.select("page_id", "host", "path", "rule", "fixed", *(F.col("s")[k].alias(c) for k, c in enumerate(levels)))
    nodes = rows.groupBy("host", *levels).agg(
        F.count("*").alias("n"),
        F.count("fixed").alias("labelled"),
        F.count(F.when(F.col("fixed") == "block", 1)).alias("blocked"),
    )
    tree = _tree(materialize(nodes, "nodes")).select("host", *levels, "template", "purity")
    judged = rows.join(tree, ["host", *levels])
    own = F.when(F.col("purity") >= REJECT, F.lit("block")).otherwise(F.lit("allow"))
    return judged.select("page_id", "host", "path", "rule", F.coalesce("fixed", own).alias("verdict"), "template")
