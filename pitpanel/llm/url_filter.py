"""URL filter: seed rules, and a tree of path templates per host judged by smoothed labelled purity; DataFrame functions alone.

1. Every url is cut into host and path; the longest fitting rule decides it.  Rules also label: urls that a rule blocks
   or allows are the labelled urls of the tree (or give a table of labels).
2. A path is its segments as they stand.  Equal paths are counted per host, so the tree is as large as the paths, not the
   urls.
3. The tree is gone down level by level.  At each node (host and generalised segments so far) the children (next
   segments) are looked at.  A child generalises into the wildcard ``*`` if its parent branches widely, the child is rare,
   and its labelled share of bad urls does not differ statistically (two-proportion z-test) from the rest of the branch;
   such similar branches merge and are counted as one on the next level, others keep their segment.  Only a kept segment
   that is a number, a hexadecimal id or a date stands for its kind.
4. Urls of equal host and generalised path are a template.  Its purity is the share of bad among its labelled urls,
   smoothed to that of the node above, and so on up to the host, whose share is smoothed to a fixed prior.  A node's
   share is the mean of its labelled branches, each of which counts once, however many urls it has, and it counts only
   where two branches at least are labelled: one branch says nothing about its neighbours.  So a template without labels
   has the share of the nearest nodes above whose branches agree.  Templates of at least ``REJECT`` are blocked.

Defined cases: a null url or one without ``://`` has empty host and path and is allowed by the method; empty segments
count; repeated rows count each; without labels nothing is blocked; a segment that is a plain ``*`` counts with the
wildcard; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitpanel.llm.text import stored

#: Seed rules (host with path, verdict); fixed values.
RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}
WIDE = 8
RARE = 0.05
Z = 1.96
#: Share of bad urls that is assumed where nothing is known, and how many labelled urls the assumption weighs.
PRIOR, WEIGHT = 0.1, 2.0
REJECT = 0.5


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to / ? # or end, A-Z lower-cased; path: from there up to ? # or end."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit("")), F.coalesce(path, F.lit(""))


def longest_rule(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest rule that fits: its host or a subdomain of it, and its path a prefix of the path."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), r)):  # later ones are longer and win
        own, _, prefix = rule.partition("/")
        fits = ((host == own) | host.endswith("." + own)) & F.startswith(path, F.lit("/" + prefix))
        out = F.when(fits, F.lit(rule)).otherwise(out)
    return out


def segments(path: Column) -> Column:
    """The path's segments."""
    return F.split(F.substr(path, F.lit(2)), "/")


def kind(s: Column) -> Column:
    """A segment that is a number, id or date as its kind (with its file ending), any other as it is."""
    stem = F.regexp_extract(s, r"(?s)^(.*?)(\.[A-Za-z][A-Za-z0-9]{0,4})?$", 1)
    end = F.regexp_extract(s, r"(?s)^(.*?)(\.[A-Za-z][A-Za-z0-9]{0,4})?$", 2)
    return (
        F.when(stem.rlike(r"^[0-9]{4}-[0-9]{2}(-[0-9]{2})?$"), F.concat(F.lit("{date}"), end))
        .when(stem.rlike(r"^[0-9]+$"), F.concat(F.lit("{number}"), end))
        .when(stem.rlike(r"^[0-9a-fA-F-]{16,}$"), F.concat(F.lit("{id}"), end))
        .otherwise(s)
    )


def templates(urls: DataFrame, *, wide: int = WIDE, rare: float = RARE, z: float = Z, prior: float = PRIOR, weight: float = WEIGHT) -> DataFrame:
    """``host, shape, template, n, labelled, bad, purity`` of every shape; ``urls``: ``host, path, bad`` (0, 1 or null)."""
    shapes = urls.groupBy("host", F.to_json(segments(F.col("path"))).alias("shape")).agg(F.count("*").alias("n"), F.count("bad").alias("labelled"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    shapes = stored(shapes.withColumn("parts", F.from_json("shape", "array<string>")).withColumn("prefix", F.lit("")), "shapes")
    at, done, level = shapes, [], 0
    while not at.isEmpty():
        # one level of the tree: a node is its host and the generalised segments before
        level += 1
        at = at.withColumn("child", F.element_at("parts", level))
        children = at.groupBy("host", "prefix", "child").agg(F.count("*").alias("shapes"), F.sum("n").alias("n"), F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad"))
        nodes = children.groupBy("host", "prefix").agg(F.count("*").alias("width"), F.sum("shapes").alias("all_shapes"), F.sum("n").alias("all_n"), F.sum("labelled").alias("all_labelled"), F.sum("bad").alias("all_bad"))
        rest_labelled, rest_bad = F.col("all_labelled") - F.col("labelled"), F.col("all_bad") - F.col("bad")
        pooled = F.col("all_bad") / F.col("all_labelled")
        spread = F.sqrt(pooled * (1 - pooled) * (1 / F.col("labelled") + 1 / rest_labelled))
        score = F.abs(F.col("bad") / F.col("labelled") - rest_bad / rest_labelled) / spread
        # nothing tells an unlabelled child from the rest; a labelled child among unlabelled ones stays apart
        alike = F.when(F.col("labelled") == 0, True).when(rest_labelled == 0, False).when(spread == 0, True).otherwise(score < z)
        merges = (F.col("width") >= wide) & (F.col("n") <= rare * F.col("all_n")) & alike
        # below a node of fewer shapes than a wide branch has children, nothing generalises any more
        step = children.join(nodes.where(F.col("all_shapes") >= wide), ["host", "prefix"]).select("host", "prefix", "child", merges.alias("merges"))
        moved = at.join(step, ["host", "prefix", "child"], "left")
        prefix = F.concat("prefix", F.lit("/"), F.when(F.col("merges"), "*").otherwise(kind(F.col("child"))))
        moved = moved.select("host", "shape", "n", "labelled", "bad", "parts", prefix.alias("prefix"), (F.col("merges").isNotNull() & (F.size("parts") > level)).alias("open"))
        moved = stored(moved, "level")
        rest = F.transform(F.slice("parts", level + 1, F.size("parts")), lambda s: F.concat(F.lit("/"), kind(s)))
        done.append(moved.where(~F.col("open")).select("host", "shape", F.concat("prefix", F.array_join(rest, "")).alias("template"), "n", "labelled", "bad"))
        at = moved.where("open").drop("open")
    named = reduce(DataFrame.union, done) if done else shapes.select("host", "shape", F.col("prefix").alias("template"), "n", "labelled", "bad")
    total = stored(named.groupBy("host", "template").agg(*(F.sum(c).alias(c) for c in ("n", "labelled", "bad"))), "totals")
    # the nodes above a template: its host (depth 1) and its shorter prefixes, each with the branch that leads on
    upto = lambda k: F.xxhash64(F.call_function("substring_index", F.col("template"), F.lit("/"), k))
    above = F.transform(F.sequence(F.lit(1), F.size(F.split("template", "/")) - 1), lambda k: F.struct(k.alias("depth"), upto(k).alias("node"), upto(k + 1).alias("branch")))
    above = total.select("host", "template", "labelled", "bad", F.explode(above).alias("at")).select("host", "template", "labelled", "bad", "at.*")
    branches = above.where("labelled > 0").groupBy("host", "depth", "node", "branch").agg((F.sum("bad") / F.sum("labelled")).alias("share"))
    known = branches.groupBy("host", "depth", "node").agg(F.count("*").alias("labelled"), F.sum("share").alias("bad")).where("labelled > 1")
    chain = above.drop("labelled", "bad").join(known, ["host", "depth", "node"]).groupBy("host", "template").agg(F.sort_array(F.collect_list(F.struct("depth", "labelled", "bad"))).alias("chain"))

    def smoothed(share: Column, node: Column) -> Column:
        own = F.when(node["depth"] == 1, F.lit(float(weight))).otherwise(F.lit(1.0))
        return (node["bad"] + share * own) / (node["labelled"] + own)

    share = F.coalesce(F.aggregate("chain", F.lit(float(prior)), smoothed), F.lit(float(prior)))
    judged = total.join(chain, ["host", "template"], "left").withColumn("purity", (F.col("bad") + share) / (F.col("labelled") + 1)).drop("chain")
    return named.select("host", "shape", "template").join(judged, ["host", "template"])


def judge(pages: DataFrame, *, page_id: str = "page_id", url: str = "url", rules: dict[str, str] | None = None, labels: DataFrame | None = None, reject: float = REJECT, **options) -> DataFrame:
    """``page_id, host, path, rule, template, purity, verdict`` of every page.

    ``labels``: optional ``url, bad`` beside the rules' labels (of a url labelled differently, bad counts).
    """
    rules = RULES if rules is None else rules
    host, path = host_and_path(F.col("url"))
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url")).select("page_id", "url", host.alias("host"), path.alias("path"))
    rows = rows.withColumn("rule", longest_rule(F.col("host"), F.col("path"), rules))
    verdict = F.lit(None).cast("string")
    for rule, own in rules.items():
        verdict = F.when(F.col("rule") == rule, F.lit(own)).otherwise(verdict)
    rows = rows.withColumn("by_rule", verdict)
    known = rows.withColumn("bad", F.when(F.col("by_rule") == "block", 1).when(F.col("by_rule") == "allow", 0))
    if labels is not None:
        known = known.join(labels.groupBy(F.col("url")).agg(F.max("bad").alias("told")), "url", "left").withColumn("bad", F.coalesce("bad", "told"))
    tree = stored(templates(known.select("host", "path", "bad"), **options).select("host", "shape", "template", "purity"), "templates")
    rows = rows.withColumn("shape", F.to_json(segments(F.col("path"))))
    return rows.join(tree, ["host", "shape"], "left").select("page_id", "host", "path", "rule", "template", "purity", F.coalesce("by_rule", F.when(F.col("purity") >= reject, "block").otherwise("allow")).alias("verdict"))
