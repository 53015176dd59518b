"""The learner of the decision list against plain enumeration, and its sample."""

import math

import numpy as np
from pyspark.sql import functions as F

from tessera.llm.decision_list import Test as Rule
from tessera.llm.decision_list import _best_test, first_by_hash, learn_list


def test_best_test_equals_enumeration():
    rng = np.random.default_rng(3)
    for _ in range(20):
        x = {f: rng.integers(0, 9, 60).astype(float) for f in "abc"}
        bad = (x["b"] + rng.normal(0, 2, 60)) > 5
        gain, found = _best_test(x, bad, 64)
        best = 0.0
        for v in x.values():
            cuts = np.unique(np.quantile(v, np.linspace(0, 1, 65)[1:-1]))
            for cut in [*cuts, *((cuts[1:] + cuts[:-1]) / 2)]:
                for inside in (v >= cut, v < cut):
                    p, n = int((bad & inside).sum()), int(inside.sum())
                    if p:
                        best = max(best, p * (math.log2(p / n) - math.log2(bad.sum() / len(bad))))
        assert abs(gain - best) < 1e-9 and found.feature in x


def test_covering_finds_two_conjunctions():
    rng = np.random.default_rng(5)
    x = {"a": rng.random(3000), "b": rng.random(3000), "c": rng.random(3000)}
    bad = ((x["a"] > 0.7) & (x["b"] < 0.4)) | (x["c"] > 0.9)
    rules = learn_list(x, bad)
    hit = np.zeros(3000, dtype=bool)
    for tests in rules:
        m = np.ones(3000, dtype=bool)
        for t in tests:
            m &= t.holds(x)
        hit |= m
    assert len(rules) >= 2 and all(isinstance(t, Rule) for tests in rules for t in tests)
    assert (hit & bad).sum() >= 0.95 * bad.sum() and (hit & ~bad).sum() <= 0.02 * (~bad).sum()
    assert learn_list(x, np.zeros(3000, dtype=bool)) == []


def test_first_by_hash_is_the_sorted_head(spark):
    rows = spark.range(5000).select(F.col("id"), F.xxhash64("id").alias("h"))
    want = [r.id for r in sorted(rows.collect(), key=lambda r: (r.h, r.id))]
    for k in (0, 7, 900, 4999, 6000):
        assert [r.id for r in first_by_hash(rows, "h", ["id"], k).collect()] == want[:k]
    same = rows.withColumn("h", F.lit(2 ** 62))  # one hash for all: the bound rises until it holds them
    assert [r.id for r in first_by_hash(same, "h", ["id"], 7).collect()] == list(range(7))
