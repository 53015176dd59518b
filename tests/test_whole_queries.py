"""Queries that must cover their whole input."""

import math
import re
from collections import Counter

from conftest import SF_SMALL
from pyspark.sql import functions as F

from tessera.functions.text import normalize_text
from tessera.plans import eval_queries as eq
from tessera.sources.corpus import labelled_docs


def test_top_abs_features_weighs_all_labelled_documents(spark):
    """The 12 weights come from every split, not from the train rows alone."""
    rows = labelled_docs(spark, SF_SMALL).select("label", "split", normalize_text("text").alias("text")).collect()
    assert {r.split for r in rows} == {"train", "validation", "test"}
    df, cf, pos = Counter(), Counter(), Counter()
    for r in rows:
        tok = re.findall(r"\b\w\w+\b", r.text)
        grams = Counter(tok + [" ".join(p) for p in zip(tok, tok[1:])])
        cf.update(grams)
        df.update(grams.keys())
        if r.label:
            pos.update(grams.keys())
    vocab = sorted((t for t in df if df[t] >= 2), key=lambda t: (-cf[t], t))[:8000]
    n, p = len(rows), sum(r.label for r in rows)
    w = {t: math.log(((pos[t] + 1) * (n - p + 2)) / ((df[t] - pos[t] + 1) * (p + 2))) for t in vocab}
    want = sorted(w, key=lambda t: (-abs(w[t]), t))[:12]
    got = eq.q_top_abs_features(spark, SF_SMALL).orderBy(F.desc("abs_weight"), "feature").collect()
    assert [r.feature for r in got] == want
    assert all(abs(r.weight - w[r.feature]) < 1e-5 for r in got)
