r"""URL filters: fixed rules first, then a tree of path templates per host.

Paths are cut into segments; variable ones become wildcards: those with digits, and all children of
a node that has many different ones which hardly recur, down to the deepest level that has such
nodes (the query's SQL stops at the third, the deepest of the given tables). Pages judged by a rule are the labelled
ones. Sibling templates whose labelled shares do not differ beyond chance are merged and share
their counts. A template is rejected when its smoothed share of blocked pages is high enough.

Edge cases: a null url, or one without ``://``, has an empty host and path and meets no rule; an
empty path is a template of its own; equal urls are judged alike; an empty table stays empty. Extra
columns are ignored. A host may hold any share of the rows: only counts are shuffled by host.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hexstats.sources.staging import stage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: a node's children are variable beyond this many, if each has fewer pages than that on average
MANY_CHILDREN, FEW_PAGES = 10, 3
#: siblings are told apart beyond this many standard errors
ERRORS = 2.0
#: pages at the overall rate that are added to a template's own; share from which it is rejected
SMOOTHING, REJECT = 2.0, 0.5


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str


RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, "://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def by_rule(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """Struct (rule, verdict) of the longest rule that fits; null without one."""
    found = F.lit(None).cast("struct<rule string, verdict string>")
    for rule in sorted(rules, key=lambda r: len(r.host + r.path)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        hit = F.struct(F.lit(rule.host + rule.path).alias("rule"), F.lit(rule.verdict).alias("verdict"))
        found = F.when(fits, hit).otherwise(found)
    return found


def segment_template(segment: Column) -> Column:
    """A segment with digits becomes a wildcard that keeps only the file extension."""
    extension = F.regexp_extract(segment, r"(\.[A-Za-z]+)$", 1)
    return F.when(segment.rlike("[0-9]"), F.concat(F.lit("*"), extension)).otherwise(segment)


def judged(pages: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(page_id, url, host, path, rule, template, verdict) of every page."""
    split = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    split = split.withColumn("_found", by_rule(F.col("host"), F.col("path"), rules))
    segments = F.transform(F.split(F.regexp_replace("path", "^/", ""), "/"), segment_template)
    rows = stage(
        split.select("page_id", "url", "host", "path", "_found.rule", F.col("_found.verdict").alias("ruled"),
                     segments.alias("segments"))
    )
    # the tree has a row per host and segment list, far fewer than pages
    tree = rows.groupBy("host", "segments").agg(
        F.count(F.lit(1)).alias("n"), F.count("ruled").alias("known"), F.count(F.when(F.col("ruled") == "block", 1)).alias("blocked")
    ).withColumn("original", F.col("segments"))
    tree = stage(tree)
    for level in range(1, _deepest(tree) + 1):
        tree = stage(_generalised_tree(tree, level))
    tree = stage(tree.withColumn("template", F.array_join("segments", "/")).withColumn(
        "parent", F.array_join(F.slice("segments", 1, F.greatest(F.size("segments") - 1, F.lit(0))), "/")
    ))
    templates = tree.groupBy("host", "parent", "template").agg(F.sum("known").alias("known"), F.sum("blocked").alias("blocked"))
    verdicts = _template_verdicts(templates)
    placed = tree.join(verdicts, ["host", "template"]).select(
        F.col("host").alias("_host"), F.col("original").alias("_segments"), "template", "rejected"
    )
    joined = rows.join(placed, (rows["host"] == placed["_host"]) & (rows["segments"] == placed["_segments"]))
    verdict = F.coalesce("ruled", F.when(F.col("rejected"), "block").otherwise("allow"))
    return joined.select("page_id", "url", "host", "path", "rule", "template", verdict.alias("verdict"))


def _deepest(tree: DataFrame) -> int:
    """The last level at which a node can have many children: enough paths of its host reach it."""
    sizes = tree.groupBy("host", F.size("segments").alias("size")).agg(F.count(F.lit(1)).alias("paths"))
    deeper = Window.partitionBy("host").orderBy(F.desc("size"))  # a row per host and length of path
    reached = sizes.withColumn("paths", F.sum("paths").over(deeper)).filter(F.col("paths") > MANY_CHILDREN)
    return reached.agg(F.max("size")).first()[0] or 0


def _generalised_tree(tree: DataFrame, level: int) -> DataFrame:
    """Replace the segments of one level by a wildcard wherever the node's children are variable."""
    reaches = F.size("segments") >= level
    node = F.array_join(F.slice("segments", 1, level - 1), "/")
    children = (
        tree.filter(reaches)
        .groupBy("host", node.alias("node"), F.element_at("segments", level).alias("child"))
        .agg(F.sum("n").alias("n"))
    )
    variable = (
        children.groupBy("host", "node")
        .agg(F.count(F.lit(1)).alias("children"), F.sum("n").alias("pages"))
        .filter((F.col("children") > MANY_CHILDREN) & (F.col("pages") < FEW_PAGES * F.col("children")))
        .select("host", "node", F.lit(True).alias("variable"))
    )
    wild = F.concat(
        F.slice("segments", 1, level - 1),
        F.array(F.lit("*")),
        F.slice("segments", level + 1, F.greatest(F.size("segments") - level, F.lit(0))),
    )
    return (
        tree.withColumn("node", node)
        .join(variable, ["host", "node"], "left")
        .withColumn("segments", F.when(F.col("variable") & reaches, wild).otherwise(F.col("segments")))
        .drop("variable", "node")
    )


def _template_verdicts(templates: DataFrame) -> DataFrame:
    """(host, template, rejected); ``templates`` has (host, parent, template, known, blocked)."""
    overall = templates.agg(F.sum("known").alias("known"), F.sum("blocked").alias("blocked")).first()
    rate = overall["blocked"] / overall["known"] if overall["known"] else 0.5
    pooled = templates.groupBy("host", "parent").agg(
        F.sum("known").alias("all_known"), F.sum("blocked").alias("all_blocked")
    )
    share, pool = F.try_divide("blocked", "known"), F.try_divide("all_blocked", "all_known")
    error = F.sqrt(F.try_divide(pool * (1 - pool), F.col("known")))
    alike = F.coalesce(F.abs(share - pool) <= ERRORS * error, F.lit(False))
    compared = templates.join(pooled, ["host", "parent"]).withColumn("alike", alike)
    merged = compared.groupBy("host", "parent").agg(
        F.sum(F.when(F.col("alike"), F.col("known"))).alias("merged_known"),
        F.sum(F.when(F.col("alike"), F.col("blocked"))).alias("merged_blocked"),
        F.min(F.col("alike") | (F.col("known") == 0)).alias("uniform"),
    )
    joins = F.col("alike") | (F.col("uniform") & (F.col("known") == 0))
    known = F.when(joins, F.coalesce("merged_known", F.lit(0))).otherwise(F.col("known"))
    blocked = F.when(joins, F.coalesce("merged_blocked", F.lit(0))).otherwise(F.col("blocked"))
    purity = (blocked + SMOOTHING * rate) / (known + SMOOTHING)
    rejected = (known > 0) & (purity >= REJECT)
    return compared.join(merged, ["host", "parent"]).select("host", "template", rejected.alias("rejected"))
