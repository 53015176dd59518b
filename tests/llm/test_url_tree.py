"""The template tree without a fixed depth: against a plain recursion, on deep
paths, very long urls, repeated rows and a host with most of the rows."""

import collections
import itertools
import math
import random
import re

from pyspark.sql import functions as F

from tessera.llm.url_templates import judge_urls, path_templates


def brute(rows, min_block=2, min_effective=12.0, slack=0.1):
    """gen path -> template, for the rows (gen path, n, n_block, n_allow) of one host."""
    info = {g: dict(seg=g.split("/"), n=n, b=b, a=a, at=0, levels=[], peeks=[]) for g, n, b, a in rows}

    def grow(group):
        rest = {g: info[g]["seg"][info[g]["at"]:] for g in group}
        head = {g: rest[g][0] if rest[g] else "" for g in group}
        counts = collections.Counter()
        for g in group:
            counts[head[g]] += info[g]["n"]
        wide = sum(counts.values()) ** 2 / sum(c * c for c in counts.values()) >= min_effective
        for g in group:
            info[g]["peeks"].append("*" if wide and head[g] else head[g])
        n, b = sum(info[g]["n"] for g in group), sum(info[g]["b"] for g in group)
        if not (b >= min_block and b < n and len(group) > 1):
            return
        same = sum(1 for _ in itertools.takewhile(lambda col: len(set(col)) == 1, zip(*rest.values())))
        kids = collections.defaultdict(list)
        for g in group:
            step = "/".join(rest[g][:same]) if same else info[g]["peeks"][-1]
            info[g]["levels"].append(step)
            info[g]["at"] += max(1, same)
            kids[step].append(g)
        for members in kids.values():
            if going := [g for g in members if info[g]["at"] < len(info[g]["seg"])]:
                grow(going)

    grow(list(info))
    deepest = max(len(r["levels"]) for r in info.values())
    for d in reversed(range(deepest)):
        nodes = collections.defaultdict(lambda: collections.defaultdict(collections.Counter))
        for r in info.values():
            if len(r["levels"]) > d and r["levels"][d]:
                nxt = r["peeks"][d + 1] if len(r["peeks"]) > d + 1 else ""
                cells = nodes[tuple(r["levels"][:d])][r["levels"][d]]
                cells.update({(nxt, "b"): r["b"], (nxt, "a"): r["a"], (nxt, "-"): r["n"] - r["a"] - r["b"]})
        alike = set()
        for pre, kids in nodes.items():
            pooled = sum(kids.values(), collections.Counter())
            total = sum(pooled.values())
            for kid, cells in kids.items():
                n = sum(cells.values())
                tv = sum(max(0.0, c / n - pooled[x] / total) for x, c in cells.items() if c)
                if len(kids) > 1 and tv <= slack + 0.5 * math.sqrt(len(pooled) / n):
                    alike.add((pre, kid))
        for r in info.values():
            if len(r["levels"]) > d and (tuple(r["levels"][:d]), r["levels"][d]) in alike:
                r["levels"][d] = "+"
    return {g: "/" + re.sub("/+$", "", "/".join(r["levels"] + ["**"] * (r["at"] < len(r["seg"]))))
            for g, r in info.items()}


def test_tree_equals_a_plain_recursion(spark):
    rnd = random.Random(4)
    steps = ["a", "b", "c", "d", "", "x7", "*"]
    paths = {}
    for host in ("one", "two", "three", "four"):
        for _ in range(150):
            deep = rnd.choice(["", "/s/t/u/v/w"])
            path = deep + "".join("/" + rnd.choice(steps) for _ in range(rnd.randrange(0, 7)))
            if rnd.random() < 0.3:
                path += "/" + rnd.choice("klmnop") + rnd.choice("qrstuvw") + rnd.choice("xyz")
            bad = "/b" in path
            paths[host, path] = (rnd.randrange(1, 5), 1 if bad and rnd.random() < 0.5 else 0,
                                 1 if not bad and rnd.random() < 0.3 else 0)
    rows = [(h, p, max(n, b + a), b, a) for (h, p), (n, b, a) in paths.items()]
    df = spark.createDataFrame(rows, "host string, path string, n long, n_block long, n_allow long")
    got = {(r.host, r.path): r.template for r in path_templates(df).collect()}
    gen = lambda p: re.sub("[0-9]+", "#", p[1:] if p.startswith("/") else p)
    want = {}
    for host in {h for h, *_ in rows}:
        merged = collections.defaultdict(lambda: [0, 0, 0])
        for h, p, *c in rows:
            if h == host:
                merged[gen(p)] = [x + y for x, y in zip(merged[gen(p)], c)]
        found = brute([(g, *c) for g, c in merged.items()])
        want.update({(h, p): found[gen(p)] for h, p, *_ in rows if h == host})
    assert got == want
    assert any("+" in t for t in got.values()) and any("*" in t.split("/") for t in got.values())
    assert max(t.count("/") for t in got.values()) > 5


def judged(spark, urls, marked):
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    labels = spark.createDataFrame(marked, "url string, label string")
    return {r.page_id: r.verdict for r in judge_urls(pages, labelled=labels).collect()}


def test_deep_branches_are_told_apart(spark):
    bad = [f"http://h.com/en/a/b/c/bad/p{i}x{i}" for i in range(40)]
    good = [f"http://h.com/en/a/b/c/good/q{i}" for i in range(40)]
    got = judged(spark, bad + good, [(u, "block") for u in bad[:20]] + [(u, "allow") for u in good[:20]])
    assert all(v == ("block" if i < 40 else "allow") for i, v in got.items())


def test_very_long_urls_and_repeats(spark):
    trunk = "http://h.com/" + "/".join(f"s{'abcdefghij'[i % 10]}" for i in range(10000))
    bad, good = [[f"{trunk}/{kind}/w{c}" for c in "abcdefghijklmnop"] for kind in ("bad", "good")]
    urls = (bad + good) * 2 + [None, "", "http://h.com"]
    got = judged(spark, urls, [(u, "block") for u in bad[:12] * 3] + [(u, "allow") for u in good[:12] * 3])
    assert [got[i] for i in range(64)] == (["block"] * 16 + ["allow"] * 16) * 2
    assert [got[i] for i in (64, 65, 66)] == ["allow"] * 3


def test_a_host_with_most_rows(spark):
    """Rows made in Spark: 20,000 urls of one host, 2,000 of 500 others."""
    hot = spark.range(20000).select("id", F.concat(
        F.lit("http://hot.com/"), F.when(F.col("id") % 2 == 0, "spam/").otherwise("news/"),
        F.translate(F.col("id").cast("string"), "0123456789", "abcdefghij")).alias("url"))
    cold = spark.range(20000, 22000).select("id", F.concat(
        F.lit("http://c"), F.col("id") % 500, F.lit(".com/spam/"), F.col("id")).alias("url"))
    marked = hot.where("id % 10 < 2").select("url", F.when(F.col("id") % 2 == 0, "block").otherwise("allow").alias("label"))
    got = judge_urls(hot.union(cold).withColumnRenamed("id", "page_id"), labelled=marked)
    seen = {(r.kind, r.verdict): r["count"] for r in got.groupBy(
        F.when(F.col("host") != "hot.com", "cold").otherwise(F.split("path", "/")[1]).alias("kind"), "verdict").count().collect()}
    assert seen == {("spam", "block"): 10000, ("news", "allow"): 10000, ("cold", "allow"): 2000}
