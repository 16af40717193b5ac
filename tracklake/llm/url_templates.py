"""URL filter: host and path rules, and a tree of path templates learned from them. DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklake.session import stage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
Rule = tuple[str, str]  # verdict, host and path


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path of a URL: both empty if it is null or has no `://`."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits (the first of equal length) as struct(verdict, rule), or null.

    Rules are an operator's parameter and become one expression, meant for up to some hundreds.
    """
    found = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, rule in sorted(reversed(list(rules)), key=lambda r: len(r[1])):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit(slash + rest))
        found = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule"))).otherwise(found)
    return found


def lexical_template(path: Column) -> Column:
    """Path segments with runs of digits as <n> and hexadecimal names of 8 or more as <h>."""
    parts = F.split(F.regexp_replace(path, "^/", ""), "/")
    return F.transform(
        parts,
        lambda s: F.regexp_replace(
            F.regexp_replace(s, r"(?<![0-9A-Za-z])(?=[a-f]*[0-9])[0-9a-f]{8,}(?![0-9A-Za-z])", "<h>"), r"[0-9]+", "<n>"
        ),
    )


def template_tree(shapes: DataFrame, min_share: float, min_count: int) -> DataFrame:
    """Adds `branch` (first segment) and `template` to rows of host, segs, n, allow, block.

    Level by level, the values below one node of a host's tree stay apart if each has a fair share of the node's
    pages; all others become the wildcard *. A node that no longer splits is finished at once: one shape with enough
    pages keeps its segments, and below a node with too few pages all are wildcards. The tree grows until no node is left.
    """
    names = ("host", "shape", "segs", "n", "allow", "block", "branch", "template")
    tree, done, level = shapes.withColumn("template", F.lit("")), None, 0
    while True:
        value = F.get(F.col("segs"), F.lit(level))
        here = tree.withColumn("value", value)
        values = here.where(F.col("value").isNotNull()).groupBy("host", "template", "value").agg(F.sum("n").alias("vn"))
        nodes = values.groupBy("host", "template").agg(F.sum("vn").alias("nn"))
        literal = (
            values.join(nodes, ["host", "template"])
            .where((F.col("vn") >= min_count) & (F.col("vn") >= F.col("nn") * F.lit(min_share)))
            .select("host", "template", "value", F.lit(True).alias("literal"))
        )
        step = F.when(F.col("value").isNull(), "").when(F.col("literal"), F.concat(F.lit("/"), "value")).otherwise("/*")
        grown = F.concat("template", step)
        # One row per host and shape; written because the next level reads it three times.
        tree = here.join(literal, ["host", "template", "value"], "left").select(
            "host", "shape", "segs", "n", "allow", "block", grown.alias("template"),
            F.col("branch") if level else grown.alias("branch"),
        )
        level += 1
        deeper = F.size("segs") > level
        sizes = tree.where(deeper).groupBy("host", "template").agg(F.sum("n").alias("nn"), F.count("*").alias("nshapes"))
        few = F.col("nn") < min_count
        rest = F.slice("segs", F.lit(level + 1), F.size("segs") - level)
        tail = F.when(few, F.repeat(F.lit("/*"), F.size("segs") - level)).when(
            F.col("nshapes") == 1, F.concat(F.lit("/"), F.array_join(rest, "/")))
        tree = stage(tree.join(sizes, ["host", "template"], "left").withColumn("open", deeper & ~few & (F.col("nshapes") > 1)).withColumn(
            "template", F.when(deeper & ~F.col("open"), F.concat("template", tail)).otherwise(F.col("template"))).select(*names, "open"))
        ended = tree.where(~F.col("open")).select(*names)
        done = ended if done is None else done.unionByName(ended)
        tree = tree.where("open").select(*names)
        if tree.isEmpty():
            return done


def template_purity(tree: DataFrame, smoothing: float, similar: float) -> DataFrame:
    """Adds `purity`, the smoothed share of allowed pages among the labelled ones of a template.

    Templates below one branch of a host whose share differs from the branch's by under `similar` standard errors
    are merged and pool their labels. The pooled share is smoothed towards the same template's share over all hosts, and
    that towards the share of all pages, so a host without labels takes over what its templates mean elsewhere.
    """
    labels = [F.sum("allow").alias("a"), F.sum("block").alias("b")]
    leaf = tree.groupBy("host", "branch", "template").agg(*labels)
    branch = leaf.groupBy("host", "branch").agg(F.sum("a").alias("ba"), F.sum("b").alias("bb"))
    share = (F.col("ba") + 1) / (F.col("ba") + F.col("bb") + 2)
    seen = F.col("a") + F.col("b")
    error = F.sqrt(share * (1 - share) / F.greatest(seen, F.lit(1)))
    apart = (seen > 0) & (F.abs(F.col("a") / F.greatest(seen, F.lit(1)) - share) >= error * F.lit(similar))
    grouped = leaf.join(branch, ["host", "branch"]).withColumn(
        "merged", F.when(apart, F.col("template")).otherwise(F.lit("*")))
    pooled = grouped.groupBy("host", "branch", "merged").agg(F.sum("a").alias("pa"), F.sum("b").alias("pb"))
    overall = leaf.agg(((F.coalesce(F.sum("a"), F.lit(0)) + 1) / (F.coalesce(F.sum("a") + F.sum("b"), F.lit(0)) + 2)).alias("base"))
    k = F.lit(float(smoothing))
    shape = leaf.groupBy("template").agg(F.sum("a").alias("ta"), F.sum("b").alias("tb"))
    shape = shape.join(F.broadcast(overall)).select(  # one row
        "template", ((F.col("ta") + k * F.col("base")) / (F.col("ta") + F.col("tb") + k)).alias("prior"))
    return (
        grouped.join(pooled, ["host", "branch", "merged"])
        .join(shape, "template")
        .select("host", "template", ((F.col("pa") + k * F.col("prior")) / (F.col("pa") + F.col("pb") + k)).alias("purity"))
    )


def filter_urls(
    pages: DataFrame,
    rules: Sequence[Rule],
    id_col: str = "page_id",
    url_col: str = "url",
    min_share: float = 0.02,
    min_count: int = 5,
    smoothing: float = 5.0,
    similar: float = 2.0,
    least_purity: float = 0.5,
) -> DataFrame:
    """One row per page: id, host, path, rule, verdict, template, purity.

    A rule's verdict holds. Pages without a rule are judged by their template: allowed if the template's smoothed
    purity, with the rules' verdicts as labels, is at least `least_purity`. Pages are grouped by host and shape of
    path before the tree is built, so the tree grows with the number of shapes and not with the pages; it has as many levels as shapes of a host share. Null URLs
    and URLs without `://` have empty host and path and share one template. Repeated rows each count. Paths of any
    length work. Without any labels every page has purity 0.5. An empty table gives an empty result.
    """
    host, path = url_parts(F.col(f"`{url_col}`"))
    parsed = pages.select(F.col(f"`{id_col}`").alias("id"), host.alias("host"), path.alias("path"))
    ruled = parsed.withColumn("hit", matching_rule(F.col("host"), F.col("path"), rules)).withColumn(
        "shape", F.array_join(lexical_template(F.col("path")), "/"))
    count_if = lambda verdict: F.sum(F.when(F.col("hit.verdict") == verdict, 1).otherwise(0))
    shapes = ruled.groupBy("host", "shape").agg(
        F.count("*").alias("n"), count_if("allow").alias("allow"), count_if("block").alias("block")
    ).withColumn("segs", F.split("shape", "/"))
    shapes = stage(shapes)
    tree = template_tree(shapes, min_share, min_count)
    judged = tree.select("host", "shape", "template").join(template_purity(tree, smoothing, similar), ["host", "template"])
    verdict = F.when(F.col("purity") >= least_purity, "allow").otherwise("block")
    return ruled.join(judged, ["host", "shape"]).select(
        F.col("id").alias(id_col), "host", "path", F.col("hit.rule").alias("rule"),
        F.coalesce(F.col("hit.verdict"), verdict).alias("verdict"), "template", "purity",
    )
