"""TF-IDF against a brute-force Python computation of the same rules."""

import math
import re
from collections import Counter

from pyspark.sql import functions as F

from tessera.operators import features as fe

DOCS = [
    (1, "the cat sat on the mat"),
    (2, "the dog sat"),
    (3, "a cat and a dog"),
    (4, "zz"),
    (5, "x"),
    (6, "the the the cat"),
]


def brute(docs, lo, hi, min_df, max_features):
    grams = {}
    for d, t in docs:
        tok = re.findall(r"\w\w+", t)
        g = []
        for n in range(lo, hi + 1):
            g += [" ".join(tok[i:i + n]) for i in range(len(tok) - n + 1)]
        grams[d] = Counter(g)
    dfc, cf = Counter(), Counter()
    for c in grams.values():
        for k, v in c.items():
            dfc[k] += 1
            cf[k] += v
    keep = [k for k in dfc if dfc[k] >= min_df]
    keep = sorted(keep, key=lambda k: (-cf[k], k))[:max_features]
    vocab = {k: i for i, k in enumerate(sorted(keep))}
    n = len(docs)
    idf = {k: math.log((1 + n) / (1 + dfc[k])) + 1 for k in vocab}
    out = {}
    for d, c in grams.items():
        raw = {vocab[k]: (1 + math.log(v)) * idf[k] for k, v in c.items() if k in vocab}
        norm = math.sqrt(sum(x * x for x in raw.values()))
        for i, x in raw.items():
            out[(d, i)] = x / norm
    return vocab, out


def test_tfidf_matches_brute_force(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    spec = fe.VectorizerSpec("word", 1, 2, 2, 4)
    counts = fe.term_counts(docs, spec)
    vocab = fe.fit_vocab(counts, len(DOCS), spec)
    got_vocab = {r.term: r.idx for r in vocab.collect()}
    want_vocab, want = brute(DOCS, 1, 2, 2, 4)
    assert got_vocab == want_vocab
    got = {(r.doc_id, r.idx): r.value for r in fe.tfidf_long(counts, vocab, spec).collect()}
    assert got.keys() == want.keys()
    for k in want:
        assert abs(got[k] - want[k]) < 1e-12


def test_rows_have_unit_norm_and_empty_docs_have_none(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    spec = fe.VectorizerSpec("word", 1, 2, 2, 100)
    counts = fe.term_counts(docs, spec)
    t = fe.tfidf_long(counts, fe.fit_vocab(counts, len(DOCS), spec), spec)
    norms = t.groupBy("doc_id").agg(F.sqrt(F.sum(F.col("value") ** 2)).alias("n")).collect()
    assert all(abs(r.n - 1.0) < 1e-12 for r in norms)
    assert {r.doc_id for r in norms} == {1, 2, 3, 6}   # 4 and 5 have no known term


def test_vector_form_keeps_all_zero_rows(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    spec = fe.VectorizerSpec("word", 1, 1, 2, 100)
    counts = fe.term_counts(docs, spec)
    vocab = fe.fit_vocab(counts, len(DOCS), spec)
    size = vocab.count()
    vec = fe.to_vectors(fe.tfidf_long(counts, vocab, spec), size, docs=docs.select("doc_id"))
    rows = {r.doc_id: r.features for r in vec.collect()}
    assert len(rows) == len(DOCS)
    assert rows[5].numNonzeros() == 0 and rows[5].size == size


def test_uncapped_vocabulary_index(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    spec = fe.VectorizerSpec("word", 1, 1, 1, None)
    counts = fe.term_counts(docs, spec)
    v = fe.fit_vocab(counts, len(DOCS), spec).orderBy("idx").collect()
    assert [r.idx for r in v] == list(range(len(v)))
    assert [r.term for r in v] == sorted(r.term for r in v)
