"""URL filter: fixed rules first, then a tree of path templates for each host.

Paths become templates segment by segment: digit runs turn into ``#``, a tree
node whose children are many and even (the inverse Simpson index of their
counts reaches ``min_effective``) gets the wildcard ``*`` for all of them, and
sibling branches whose distributions of next segment and label differ no more
than chance allows are merged into ``+``.  The tree has no fixed depth: a node
is split as long as it holds blocked labels enough to reject a template and
other rows beside them; elsewhere the rest of a path stands as one tail ``**``,
since no split there could change a verdict.  A template is rejected when the
smoothed share of blocked among its labelled urls reaches ``reject_at``.
Labels are the urls that the rules decide, or a given table of them.  A
template without labels has the neutral share 0.5 and is allowed.

Only DataFrame functions are used.  All tree statistics are sums over
(host, path) counts, so a host with most of the rows is combined before each
shuffle; the joins back are plain equi-joins with the few nodes that split or
generalise, or that adaptive execution may split.  Each level is a round of
Spark jobs: urls of which each continues the one before (one segment more
every time, labels mixed throughout) cost a round for each of them.

Defined cases: a null url, or one without ``://``, has empty host and path and
is judged like any other; repeated rows are kept; an empty table gives an
empty result; very long urls are read whole, and segments that all paths of a node
share take one round together; other columns are ignored.
"""

from __future__ import annotations

import math
import string
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import written
from tessera.session import materialize

URL_RE = r"(?s)^.*?://([^/?#]*)([^?#]*)"
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))


def host_path(url: Column) -> tuple[Column, Column]:
    host = F.translate(F.regexp_extract(url, URL_RE, 1), string.ascii_uppercase, string.ascii_lowercase)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(url, URL_RE, 2), F.lit(""))


def rule_columns(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, decision in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        rule_host, _, rule_path = text.partition("/")
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith("/" + rule_path)
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(decision)).otherwise(verdict)
    return rule, verdict


def _grown(rows: DataFrame, min_block: int, min_effective: float) -> DataFrame:
    """One level of the tree: every open row's node is split, or closes its rows."""
    node = ["host", "node"]
    left = F.greatest(F.size("seg") - F.col("at"), F.lit(0))
    rows = rows.withColumn("rest", F.slice("seg", F.col("at") + 1, left))
    rows = rows.withColumn("head", F.coalesce(F.get("rest", F.lit(0)), F.lit("")))
    kids = rows.groupBy(*node, "head").agg(
        F.sum("n").cast("double").alias("c"), F.sum("n_block").alias("b"), F.count(F.lit(1)).alias("r"),
        F.min("rest").alias("lo"), F.max("rest").alias("hi"))
    c = F.sum("c")
    nodes = kids.groupBy(*node).agg(
        (c * c / F.greatest(F.sum(F.col("c") * F.col("c")), F.lit(1.0)) >= min_effective).alias("wide"),
        ((F.sum("b") >= min_block) & (F.sum("b") < c) & (F.sum("r") > 1)).alias("split"),
        F.min("lo").alias("lo"), F.max("hi").alias("hi")).where("wide or split")
    # What the first and the last of all continuations share, all share.
    differ = F.array_position(F.zip_with("lo", "hi", lambda x, y: x.eqNullSafe(y)), False)
    nodes = nodes.select(*node, "wide", "split", F.when(differ == 0, F.size("lo")).otherwise(differ - 1)
                         .cast("int").alias("same"))
    split, same = F.coalesce("split", F.lit(False)), F.coalesce("same", F.lit(0))
    peek = F.when(F.col("wide") & (F.col("head") != ""), F.lit("*")).otherwise(F.col("head"))
    step = F.when(same > 0, F.array_join(F.slice("rest", F.lit(1), same), "/")).otherwise(F.col("peek"))
    after = F.when(split, F.col("at") + F.greatest(same, F.lit(1))).otherwise(F.col("at"))
    return rows.join(nodes, node, "left").withColumn("peek", peek).withColumn("step", step).select(
        "host", "gen", "seg", "n", "n_block", "n_allow", after.alias("at"),
        F.when(split, F.concat_ws("/", "node", "step")).otherwise(F.col("node")).alias("node"),
        F.when(split, F.concat("levels", F.array("step"))).otherwise(F.col("levels")).alias("levels"),
        F.concat("peeks", F.array("peek")).alias("peeks"), (split & (after < F.size("seg"))).alias("open"))


def _merged(tree: DataFrame, d: int, slack: float) -> DataFrame:
    """Sibling branches of level ``d`` that are alike get the step ``+``."""
    node, kid = ["host", "pre"], "kid"
    tree = tree.withColumn("pre", F.concat_ws("/", F.slice("levels", 1, d))).withColumn(
        kid, F.get("levels", F.lit(d)))
    label = F.explode(F.array(
        F.struct(F.lit("block").alias("y"), F.col("n_block").alias("c")),
        F.struct(F.lit("allow").alias("y"), F.col("n_allow").alias("c")),
        F.struct(F.lit("none").alias("y"), (F.col("n") - F.col("n_block") - F.col("n_allow")).alias("c"))))
    cells = (tree.where(F.col(kid) != "")
             .select(*node, kid, F.coalesce(F.get("peeks", F.lit(d + 1)), F.lit("")).alias("nxt"), label.alias("l"))
             .groupBy(*node, kid, "nxt", F.col("l.y").alias("y")).agg(F.sum("l.c").alias("c")).where("c > 0"))
    cells = materialize(cells)
    pooled = cells.groupBy(*node, "nxt", "y").agg(F.sum("c").alias("all_c"))
    size_kid = cells.groupBy(*node, kid).agg(F.sum("c").alias("n_kid"))
    size_node = (size_kid.groupBy(*node).agg(F.sum("n_kid").alias("n_node"), F.count(F.lit(1)).alias("kids"))
                 .join(pooled.groupBy(*node).agg(F.count(F.lit(1)).alias("cells")), node))
    # Total variation between child and node is the sum of the child's excesses over the node.
    over = F.greatest(F.lit(0.0), F.col("c") / F.col("n_kid") - F.col("all_c") / F.col("n_node"))
    alike = (cells.join(pooled, [*node, "nxt", "y"]).join(size_kid, [*node, kid]).join(size_node, node)
             .where("kids > 1").groupBy(*node, kid)
             .agg(F.sum(over).alias("_tv"), F.max("n_kid").alias("_n"), F.max("cells").alias("_k"))
             .where(F.col("_tv") <= slack + 0.5 * F.sqrt(F.col("_k") / F.col("_n")))
             .select(*node, kid, F.lit(True).alias("_alike")))
    plus = F.concat(F.slice("levels", 1, d), F.array(F.lit("+")), F.slice("levels", d + 2, F.size("levels")))
    return tree.join(alike, [*node, kid], "left").withColumn(
        "levels", F.when(F.col("_alike"), plus).otherwise(F.col("levels"))).drop("_alike", "pre", kid)


def path_templates(paths: DataFrame, min_block: int = 2, min_effective: float = 12.0,
                   slack: float = 0.1) -> DataFrame:
    """Add ``template`` to rows (host, path, n, n_block, n_allow), one for each
    host and path.

    A node is split while it holds at least ``min_block`` blocked labels, other
    rows beside them and more than one continuation.  Rounds: one for each level
    of such nodes; segments that all of a node's paths share are one level.
    """
    paths = paths.withColumn("gen", F.regexp_replace(F.regexp_replace("path", "^/", ""), "[0-9]+", "#"))
    none = F.array().cast("array<string>")
    rows = materialize(paths.groupBy("host", "gen").agg(*[F.sum(c).alias(c) for c in ("n", "n_block", "n_allow")])
                       .select("host", "gen", F.split("gen", "/").alias("seg"), "n", "n_block", "n_allow",
                               F.lit(0).alias("at"), F.lit("").alias("node"), none.alias("levels"),
                               none.alias("peeks")))
    closed, rounds = [], 0
    while True:  # from the root: splits and wildcards
        rows = materialize(_grown(rows, min_block, min_effective))
        closed.append(rows.where("not open").drop("open"))
        rounds += 1
        rows = rows.where("open").drop("open")
        if rows.isEmpty():
            break
    tree = reduce(DataFrame.unionByName, closed)
    for d in reversed(range(rounds)):  # from the leaves: merge alike branches
        tree = materialize(_merged(tree, d, slack))
    tail = F.when(F.col("at") < F.size("seg"), F.array(F.lit("**"))).otherwise(none)
    shape = tree.select("host", "gen", F.concat(F.lit("/"), F.regexp_replace(
        F.concat_ws("/", F.concat("levels", tail)), "/+$", "")).alias("template"))
    return paths.join(shape, ["host", "gen"]).select("host", "path", "template", "n", "n_block", "n_allow")


def judge_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES, alpha: float = 2.0,
               reject_at: float = 0.75, labelled: DataFrame | None = None, **tree) -> DataFrame:
    """(page_id, host, path, rule, verdict, template, bad_share) for every row.

    ``labelled``: optional rows (url, label block or allow) that the tree
    learns from besides the rows that the rules decide.
    """
    host, path = host_path(F.col(url_col))
    rows = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    rule, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    rows = rows.withColumn("rule", rule).withColumn("by_rule", verdict)
    seen = rows.select("host", "path", F.lit(1).alias("n"), F.col("by_rule").alias("y"))
    if labelled is not None:
        h, p = host_path(F.col("url"))
        seen = seen.unionByName(labelled.select(h.alias("host"), p.alias("path"), F.lit(0).alias("n"),
                                                F.col("label").alias("y")))
    paths = materialize(seen.groupBy("host", "path").agg(
        F.sum(F.when((F.col("n") == 1) | F.col("y").isin("block", "allow"), 1).otherwise(0)).alias("n"),
        F.sum(F.when(F.col("y") == "block", 1).otherwise(0)).alias("n_block"),
        F.sum(F.when(F.col("y") == "allow", 1).otherwise(0)).alias("n_allow")))
    # Fewer blocked labels than this reach ``reject_at`` in no template.
    enough = math.ceil(alpha * (reject_at - 0.5) / (1 - reject_at)) if reject_at < 1 else 1
    shaped = materialize(path_templates(paths, **{"min_block": max(1, enough), **tree}))
    purity = shaped.groupBy("host", "template").agg(
        ((F.sum("n_block") + alpha / 2) / (F.sum("n_block") + F.sum("n_allow") + alpha)).alias("bad_share"))
    verdicts = written(shaped.join(purity, ["host", "template"]).select("host", "path", "template", "bad_share"),
                       "url-verdicts")
    by_method = F.when(F.col("bad_share") >= reject_at, F.lit("block")).otherwise(F.lit("allow"))
    return rows.join(verdicts, ["host", "path"], "left").select(
        "page_id", "host", "path", "rule", F.coalesce("by_rule", by_method).alias("verdict"), "template", "bad_share")
