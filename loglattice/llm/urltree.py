"""URL filters by a path-template tree per host, with DataFrame operations only.

Explicit rules come first: the longest rule that fits a url decides it, and such urls are the labelled ones. Paths are cut into segments.
Digits inside a segment become ``{n}``; then, level by level from the host down, a branch whose children are many and seldom repeated is
variable and its children become ``*``, labelled children whose block rate does not differ from their siblings' beyond chance are merged into
``+``, and unlabelled children that look alike and are about as frequent are merged under their shape. The tree ends where a branch has one
distinct path left or no path goes on, at whatever depth.

A branch's purity is its share of blocked labels, smoothed towards its parent's: the host's towards the corpus rate, and so on down. So a branch
with few or no labels takes after the nearest ancestor that has some. A template is rejected if its purity reaches ``MIN_PURITY``.

Levels work on distinct paths with counts, so a busy host or page weighs no more than its distinct paths. A null url or one without ``://`` has an
empty host and path, and fits no rule. Null page ids and repeated rows keep their rows. Columns with clashing names are not
read. An empty table gives an empty result.
"""

from __future__ import annotations

import string
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loglattice.llm.common import column, materialise
from loglattice.operators.lookup import lookup_join


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


#: Fixed rules.
RULES = (
    Rule("allow", "com", "/"), Rule("block", "example.com", "/en/"), Rule("allow", "www.example.com", "/en/"), Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)
#: A branch is variable from this many children on, if they have fewer urls each on average than the second number.
MIN_CHILDREN, MAX_MEAN_URLS = 8, 2
#: Labels that a child needs to be compared, standard errors within which it is similar.
MIN_LABELS, MAX_DEVIATIONS = 2, 2.0
#: Siblings of one shape that an unlabelled child needs to be merged with them.
MIN_ALIKE = 3
#: Pseudo-labels at the parent's purity, and the share of blocked labels that rejects a template.
SMOOTHING, MIN_PURITY = 4, 0.8


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host, A-Z lower-cased, and path; both empty for null or without ``://``."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host, path = (F.coalesce(F.regexp_extract(url, pattern, k), F.lit("")) for k in (1, 2))
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase), path


def fits(rule: Rule, host: Column, path: Column) -> Column:
    return ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)


def first_rule(host: Column, path: Column, rules: tuple[Rule, ...], value: str) -> Column:
    """``value`` (an attribute) of the longest rule that fits, else null."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.text)):
        out = F.when(fits(rule, host, path), getattr(rule, value)).otherwise(out)
    return out


def _segments(path: Column) -> Column:
    parts = F.transform(F.split(path, "/"), lambda s: F.regexp_replace(s, "[0-9]+", "{n}"))
    return F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))


def shape(segment: Column) -> Column:
    """Runs of letters as one ``a``."""
    return F.regexp_replace(segment, r"\p{L}+", "a")


def smoothed(blocked: Column, labelled: Column, towards: Column) -> Column:
    return (blocked + SMOOTHING * towards) / (labelled + SMOOTHING)


def _named(nodes: DataFrame, keys: list[str]) -> DataFrame:
    """The children of every open branch with the name they go by."""
    children = nodes.groupBy(*keys, "segment").agg(*[F.sum(c).alias(c) for c in ("n", "labelled", "blocked")])
    children = children.withColumn("shape", shape(F.col("segment")))
    parents = children.groupBy(*keys).agg(
        F.count("*").alias("children"), F.sum("n").alias("urls"), F.sum("labelled").alias("all_labelled"), F.sum("blocked").alias("all_blocked")
    )
    unlabelled = children.where(F.col("labelled") < MIN_LABELS)
    alike = unlabelled.groupBy(*keys, "shape").agg(F.count("*").alias("alike"), F.avg("n").alias("usual"))
    rate = (F.col("all_blocked") + 1) / (F.col("all_labelled") + 2)
    own = (F.col("blocked") + 1) / (F.col("labelled") + 2)
    close = F.abs(own - rate) <= MAX_DEVIATIONS * F.sqrt(rate * (1 - rate) / (F.col("labelled") + 2))
    variable = (F.col("children") >= MIN_CHILDREN) & (F.col("urls") < MAX_MEAN_URLS * F.col("children"))
    similar = (F.col("children") > 1) & (F.col("labelled") >= MIN_LABELS) & close
    usual = (F.col("labelled") < MIN_LABELS) & (F.col("alike") >= MIN_ALIKE) & (F.abs(F.col("n") - F.col("usual")) <= MAX_DEVIATIONS * F.sqrt("usual"))
    shown = F.when(variable, "*").when(similar, "+").when(usual, F.concat(F.lit("~"), "shape")).otherwise(F.col("segment"))
    found = children.join(parents, keys).join(alike, [*keys, "shape"], "left")
    return found.select(*keys, "segment", shown.alias("shown"))


def template_tree(urls: DataFrame, rate: float) -> DataFrame:
    """``urls(host, segments, n, labelled, blocked)``, one row per distinct path, with ``template`` and ``purity``; ``rate`` is the corpus's."""
    keys = ["host", "template"]
    whole = urls.groupBy("host").agg(F.count("*").alias("paths"), smoothed(F.sum("blocked"), F.sum("labelled"), F.lit(rate)).alias("purity"))
    nodes = materialise(urls.withColumn("template", F.lit("")).join(whole, "host"), "templates")
    finished, depth = [], 0
    while True:
        # A branch of one path, or a path that has ended, keeps its purity and the rest of its text.
        ended = (F.col("paths") == 1) | (F.size("segments") < depth)
        rest = F.slice("segments", depth + 1, F.greatest(F.size("segments") - depth, F.lit(0)))
        text = F.when(F.size(rest) > 0, F.concat("template", F.lit("/"), F.array_join(rest, "/"))).otherwise(F.col("template"))
        finished.append(nodes.where(ended).select("host", "segments", text.alias("template"), "purity"))
        nodes = nodes.where(~ended)
        if nodes.isEmpty():
            return reduce(DataFrame.unionByName, finished)
        # A path that ends here is a child of its own, without a segment.
        there = nodes.withColumn("segment", F.get("segments", F.lit(depth)))
        named = _named(there.where("segment is not null"), keys)
        there = there.join(named, [*keys, "segment"], "left").withColumn("upper", F.col("purity"))
        longer = F.coalesce(F.concat("template", F.lit("/"), "shown"), "template")
        there = there.withColumn("template", longer).withColumn("ends", F.col("segment").isNull()).drop("segment", "shown", "paths", "purity")
        below = there.groupBy("host", "template", "ends").agg(
            F.count("*").alias("paths"), smoothed(F.sum("blocked"), F.sum("labelled"), F.max("upper")).alias("purity")
        )
        nodes = materialise(there.drop("upper").join(below, ["host", "template", "ends"]).drop("ends"), "templates")
        depth += 1


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES, page_id: str = "page_id", url: str = "url") -> DataFrame:
    """A row per page: ``page_id, host, path, rule, verdict, template, purity``."""
    host, path = url_parts(column(url).cast("string"))
    rows = pages.select(column(page_id).alias("page_id"), host.alias("host"), path.alias("path"))
    rows = rows.withColumns({"rule": first_rule(F.col("host"), F.col("path"), rules, "text"), "ruled": first_rule(F.col("host"), F.col("path"), rules, "verdict")})
    rows = rows.withColumn("segments", _segments(F.col("path")))
    counted = rows.groupBy("host", "segments").agg(
        F.count("*").alias("n"), F.count("ruled").alias("labelled"), F.count_if(F.col("ruled") == "block").alias("blocked")
    )
    counted = materialise(counted, "distinct-paths")
    totals = counted.agg(F.sum("blocked").alias("b"), F.sum("labelled").alias("l")).first()
    nodes = materialise(template_tree(counted, (totals["b"] or 0) / max(totals["l"] or 0, 1)), "judged-paths")
    judged = lookup_join(rows, nodes, ["host", "segments"], "inner")
    learned = F.when(F.col("purity") >= MIN_PURITY, "block").otherwise("allow")
    return judged.select("page_id", "host", "path", "rule", F.coalesce("ruled", learned).alias("verdict"), "template", F.round("purity", 6).alias("purity"))
