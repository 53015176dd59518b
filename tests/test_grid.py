"""Vocabulary sweeps, leave-one-fold-out refits, cube scores, grids, ensembles and
the index/percentile helpers, each against a plainer computation."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tessera.operators import cube as cu
from tessera.operators import features as fe
from tessera.operators import models as mo
from tessera.operators import report as rp
from tessera.operators import validate as va
from tessera.operators import vocab as vo
from tessera.operators.ranks import dense_index, exact_percentile, group_top
from tessera.plans import experiments as ex
from tessera.plans import grid_queries as gq
from tessera.sources import corpus as co


@pytest.fixture(scope="module")
def corpus(spark):
    return ex.normalized_corpus(co.labelled_docs(spark, SF_SMALL)).cache()


# ----------------------------------------------------------------- ranks ---
def test_dense_index_and_percentile(spark):
    rng = random.Random(1)
    rows = [(rng.choice("aab"), i, rng.choice([0.0, 1.5, 1.5, rng.random()])) for i in range(3001)]
    df = spark.createDataFrame(rows, "g string, k long, v double").repartition(6)
    got = {r.k: r.idx for r in dense_index(df, ["k"]).collect()}
    assert got == {k: k for k in range(3001)}
    by = {}
    for g, k, _ in rows:
        by.setdefault(g, []).append(k)
    want = {(g, k): i for g, ks in by.items() for i, k in enumerate(sorted(ks))}
    assert {(r.g, r.k): r.idx for r in dense_index(df, ["k"], ["g"]).collect()} == want
    for n in (1, 2, 3001):
        part = df.where(F.col("k") < n)
        for q in (0.0, 0.25, 0.5, 0.9, 1.0):
            assert exact_percentile(part, F.col("v"), q) == pytest.approx(float(np.quantile([v for _, k, v in rows if k < n], q)), abs=1e-12)
    assert exact_percentile(df.where("false"), F.col("v"), 0.5) is None
    assert dense_index(df.where("false"), ["k"]).count() == 0
    plan = dense_index(df, ["k"])._jdf.queryExecution().toString()
    assert "Window" not in plan and "Python" not in plan


def test_group_top(spark):
    rng = random.Random(2)
    rows = [(rng.choice("aaaaab"), rng.randrange(50), i) for i in range(2000)]
    df = spark.createDataFrame(rows, "g string, v int, k int").repartition(9)
    got = {(r.g, r._rn): r.k for r in group_top(df, ["g"], [F.desc("v"), F.asc("k")], 7).collect()}
    want = {}
    for g in "ab":
        for i, r in enumerate(sorted((r for r in rows if r[0] == g), key=lambda r: (-r[1], r[2]))[:7], 1):
            want[(g, i)] = r[2]
    assert got == want


# ------------------------------------------------------------ vocabularies ---
def test_sweep_equals_single_fits(spark, corpus):
    train = corpus.where("split = 'train'")
    specs = [fe.WORD_1_2, fe.VectorizerSpec("word", 1, 3, 3, 200), fe.VectorizerSpec("word", 1, 1, 1, None),
             fe.VectorizerSpec("word", 2, 2, 2, 50), fe.VectorizerSpec("char", 3, 5, 2, 300), fe.VectorizerSpec("char", 3, 6, 3, 500)]
    got = {}
    for r in vo.fit_vocabs(train, specs).collect():
        got.setdefault(r.variant, {})[r.term] = (r.idx, r.df, r.cf, r.idf)
    n = train.count()
    for i, spec in enumerate(specs):
        want = {r.term: (r.idx, r.df, r.cf, r.idf) for r in fe.fit_vocab(fe.term_counts(train, spec), n, spec).collect()}
        assert got[i].keys() == want.keys()
        assert all(got[i][t][:3] == want[t][:3] and got[i][t][3] == pytest.approx(want[t][3], abs=1e-12) for t in want)


def test_refit_vocabulary_is_that_of_the_other_folds(spark, corpus):
    train = corpus.where("split = 'train'")
    train = train.join(va.stratified_folds(train, k=3).select("doc_id", "fold"), "doc_id")
    spec = fe.VectorizerSpec("word", 1, 2, 2, 150)
    got = {}
    for r in vo.fit_vocabs(train, [spec], 3, refit=True).collect():
        got.setdefault(r.slot, {})[r.term] = (r.idx, r.df, r.cf, r.idf)
    assert sorted(got) == [-1, 0, 1, 2]
    for slot in got:
        rest = train.where(F.col("fold") != slot)
        want = {r.term: (r.idx, r.df, r.cf, r.idf) for r in fe.fit_vocab(fe.term_counts(rest, spec), rest.count(), spec).collect()}
        assert {t: v[:3] for t, v in got[slot].items()} == {t: v[:3] for t, v in want.items()}
        assert all(got[slot][t][3] == pytest.approx(want[t][3], abs=1e-12) for t in want)


def test_many_tfidf_equals_single_transforms(spark, corpus):
    specs = [fe.VectorizerSpec("word", 1, 2, 2, 100), fe.VectorizerSpec("char", 3, 4, 2, 100), fe.VectorizerSpec("word", 1, 1, 2, 40)]
    train = corpus.where("split = 'train'")
    vocabs = vo.fit_vocabs(train, specs)
    got = {(r.variant, r.doc_id, r.idx): r.value for r in vo.tfidf_many(train, vocabs, specs).collect()}
    want = {}
    for i, spec in enumerate(specs):
        _, long = fe.fit_transform(train, spec)
        want |= {(i, r.doc_id, r.idx): r.value for r in long.collect()}
    assert got.keys() == want.keys() and max(abs(got[k] - want[k]) for k in want) < 1e-12


# --------------------------------------------------------- vectors and plans ---
def test_training_vectors_stay_in_the_jvm(spark, corpus):
    fs = mo.build_features(corpus, (fe.VectorizerSpec("word", 1, 1, 2, 30),))
    rows = mo.design(fs, True, True)
    assert "Python" not in rows._jdf.queryExecution().toString()
    entries = {}
    for r in fs.long.collect():
        entries.setdefault(r.doc_id, {})[r.idx] = r.value
    for r in rows.collect():
        want = {i: v * r.sign for i, v in entries.get(r.doc_id, {}).items()} | {fs.size: r.sign}
        assert r.features.size == fs.size + 1 and dict(zip(r.features.indices.tolist(), r.features.values.tolist())) == want
        assert r.label_fit == (r.label if r.sign > 0 else 1 - r.label) and r.nnz == len(want) - 1


def test_cube_reads_the_texts_once_for_each_kind(spark, corpus):
    specs = [fe.VectorizerSpec("word", 1, 2, 2, 100), fe.VectorizerSpec("word", 1, 1, 3, 50), fe.VectorizerSpec("char", 3, 4, 2, 100)]
    raw = co.labelled_docs(spark, SF_SMALL)
    train = raw.where("split = 'train'")
    train = train.join(va.stratified_folds(train, k=2).select("doc_id", "fold"), "doc_id").cache()
    vocabs = vo.fit_vocabs(train, specs).cache()
    blocks = [("a", 0), ("b", 1), ("c", 0), ("c", 2)]
    odds = vo.log_odds(train, vocabs, specs, 2)
    weights = None
    for b, (_, v) in enumerate(blocks):
        part = odds.where(F.col("variant") == v).select(F.lit(b).alias("block"), "slot", "term", "weight")
        weights = part if weights is None else weights.unionByName(part)
    docs = raw.withColumn("slots", F.array(F.lit(-1)))
    out = cu.cube_scores(docs, cu.weight_cube(vocabs, weights, specs, blocks, [-1, 0, 1]), specs, blocks, [-1, 0, 1], {("a", -1): 0.5})
    plan = out._jdf.queryExecution().sparkPlan().toString()
    # the words, the characters, and the rows that keep documents without a term:
    # neither the number of models nor that of slots adds a scan
    assert plan.count("FileScan parquet [doc_id") <= 2 * 3
    got = {(r.experiment, r.doc_id): r.score for r in out.collect()}
    fs = mo.build_features(raw, (specs[0],))
    v = {(r.term): r.idx for r in fs.vocabs[0][1].collect()}
    w = {v[r.term]: r.weight for r in odds.where("variant = 0 AND slot = -1").collect()}
    table = spark.createDataFrame(list(w.items()), "idx int, weight double")
    want = {r.doc_id: r.score for r in mo.weighted_scores(fs, table, 0.5).collect()}
    assert all(got[("a", d)] == pytest.approx(s, abs=1e-9) for d, s in want.items())
    assert {d for e, d in got if e == "c"} == set(want)


# ------------------------------------------------------------------- grids ---
@pytest.fixture(scope="module")
def grid(corpus):
    small = fe.VectorizerSpec("word", 1, 2, 2, 120)
    exps = [ex.Experiment("lr", (small,), mo.ModelSpec("lr", 4.0), cv=True),
            ex.Experiment("free", (small,), mo.ModelSpec("lr", 0.5, intercept="free"), select=True, cv=True),
            ex.Experiment("two", (small, fe.VectorizerSpec("char", 3, 4, 2, 80)), mo.ModelSpec("lr", 1.0, balanced=True))]
    return exps, ex.run_grid(corpus, exps, k=3)


def test_grid_scores_equal_single_fits(spark, corpus, grid):
    exps, res = grid
    got = {(r.experiment, r.doc_id): r.score for r in res.predictions.collect()}
    for e in (exps[0], exps[2]):
        _, scored = mo.train_and_score(mo.build_features(corpus, e.vectorizers), e.model)
        want = {r.doc_id: r.score for r in scored.collect()}
        assert len(want) == sum(x == e.name for x, _ in got)
        assert all(got[(e.name, d)] == pytest.approx(s, abs=1e-6) for d, s in want.items())
    assert all(f.converged for f in res.features.values())


def test_grid_folds_equal_cross_validation(spark, corpus, grid):
    exps, res = grid
    want = {r.fold: r.macro_f1 for r in mo.cross_validate(mo.build_features(corpus, exps[0].vectorizers), exps[0].model, k=3).collect()}
    got = {r.fold: r.macro_f1 for r in res.folds.where("experiment = 'lr'").collect()}
    assert got == pytest.approx(want)
    t = {r.experiment: r for r in res.table.collect()}
    assert t["two"].cv_mean is None and t["lr"].cv_mean == pytest.approx(np.mean(list(want.values())))


def test_grid_selection_keeps_the_columns_of_the_median_rule(spark, corpus, grid):
    exps, res = grid
    fs = mo.build_features(corpus, exps[1].vectorizers)
    selector = mo.fit_model(fs, ex.SELECTOR)
    kept = {r.idx for r in rp.feature_select(mo.coefficient_table(spark, selector, fs)).collect()}
    assert res.features["free"].size == len(kept)
    assert {r.idx for r in res.coefficients.where("experiment = 'free'").collect()} <= kept


def test_refit_grid_scores_every_fold_with_its_own_vocabulary(spark, corpus):
    small = fe.VectorizerSpec("word", 1, 1, 2, 60)
    res = ex.run_grid(corpus, [ex.Experiment("lr", (small,), mo.ModelSpec("lr", 4.0), cv=True)], k=3, refit_per_fold=True)
    train = corpus.where("split = 'train'")
    train = train.join(va.stratified_folds(train, k=3).select("doc_id", "fold"), "doc_id")
    want = {}
    for f in range(3):
        part = train.select("doc_id", "text", "label", F.when(F.col("fold") == f, "test").otherwise("train").alias("split"))
        _, scored = mo.train_and_score(mo.build_features(part, (small,)), mo.ModelSpec("lr", 4.0))
        from tessera.operators.evaluate import metric_bundle
        want[f] = metric_bundle(scored.where("split = 'test'"), ["split"]).first().macro_f1
    assert {r.fold: r.macro_f1 for r in res.folds.collect()} == pytest.approx(want)


@pytest.mark.parametrize("kind", ["soft", "majority"])
def test_votes_recomputed_from_their_members(spark, grid, kind):
    _, res = grid
    votes = ex.ensemble_votes(res, kind, k=3).collect()
    board = {r.experiment: r.val_macro_f1 for r in res.table.collect()}
    order = sorted(board, key=lambda e: (-board[e], e))
    pred = {(r.experiment, r.doc_id): r for r in res.predictions.collect()}
    assert len(votes) == len({d for _, d in pred})
    for v in votes:
        assert [m.experiment for m in v.members] == order
        out = [pred[(e, v.doc_id)] for e in order]
        if kind == "soft":
            w = [board[e] / sum(board.values()) for e in order]
            p = sum(a * r.prob for a, r in zip(w, out))
        else:
            w, p = [1.0] * 3, sum(r.prediction for r in out) / 3
        assert [m.weight for m in v.members] == pytest.approx(w) and v.prob == pytest.approx(p)
        assert v.prediction == int(v.prob >= 0.5)
    row = ex.with_ensemble(res, kind).where(F.col("experiment") == ex.ENSEMBLES[kind]).first()
    assert [m.experiment for m in row.members] == order and row.val_macro_f1 is not None


def test_every_setting_of_the_grids_is_swept():
    assert {v for g in (ex.BASE, ex.ORIGINAL, ex.IMPROVED, ex.V2) for e in g for v in e.vectorizers} == set(gq.SWEEP)
