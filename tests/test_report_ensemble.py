"""Leaderboards, summaries, ensembles, folds: goldens from the reference's
artifacts (copied as literals) and properties."""

import pytest
from pyspark.sql import functions as F

from tessera.operators import ensemble as en
from tessera.operators import report as rp
from tessera.operators import validate as va

V2_ROWS = [  # experiment, val_acc, val_f1, test_acc, test_f1, cv_mean, cv_std
    ("word_svc_balanced", 0.735, 0.7333357484058005, 0.49595959595959593, 0.4524742895332715, 0.7749280361545018, 0.007660409731897337),
    ("combined_features", 0.74, 0.7328137588582515, 0.4909090909090909, 0.43867449060407515, 0.7829831959576566, 0.01022743674836517),
    ("word_lr_tri_gram", 0.737, 0.7306958593720401, 0.49595959595959593, 0.45830989529364163, 0.7759372142859318, 0.007907133596516944),
    ("voting_ensemble", 0.734, 0.7289873500260824, 0.49427609427609426, 0.45143384161337924, None, None),
    ("word_lr_higher_c", 0.731, 0.7263030872808263, 0.5077441077441077, 0.47497417275428716, 0.7648936053053845, 0.006330333910563187),
    ("word_lr_balanced", 0.723, 0.7213478715303032, 0.4703703703703704, 0.40900950544152087, 0.7834018512092291, 0.007968781300531002),
    ("char_wider_range", 0.723, 0.7159996760140708, 0.4983164983164983, 0.4495514863963229, 0.773690197437407, 0.003533780444685366),
    ("word_lr_l2_strong", 0.701, 0.6567633124751039, 0.5215488215488215, 0.5177092052898776, 0.6432796608651273, 0.010968840826915445),
]
BASE_ROWS = [
    ("word_svc", 0.733, 0.7284816633599733, 0.5131313131313131, 0.48237159630716897),
    ("word_lr", 0.734, 0.7280430550784381, 0.5117845117845118, 0.4783411964731916),
    ("char_svc", 0.728, 0.7212155004181767, 0.49966329966329964, 0.45363967864740345),
]
SCHEMA = "experiment string, val_accuracy double, val_macro_f1 double, test_accuracy double, test_macro_f1 double"


def test_leaderboard_v2_order_and_summary(spark):
    shuffled = [V2_ROWS[i] for i in (5, 2, 7, 0, 3, 6, 1, 4)]
    t = rp.with_gap(spark.createDataFrame(shuffled, SCHEMA + ", cv_mean double, cv_std double"))
    board = rp.leaderboard_v2(t).orderBy("rank").collect()
    assert [r.experiment for r in board] == [r[0] for r in V2_ROWS]
    best = board[0]
    assert best.gap == pytest.approx(0.280861458872529, abs=1e-15)
    base = spark.createDataFrame(BASE_ROWS, SCHEMA)
    cmp = rp.baseline_compare(base, t).first()
    assert cmp.best_original_model == "word_svc" and cmp.best_improved_model == "word_svc_balanced"
    assert cmp.test_improvement == pytest.approx(-0.029897306773897403, abs=1e-15)
    assert cmp.gap_reduction == pytest.approx(-0.034751391819724586, abs=1e-15)


def test_best_model_summary_and_metric_long(spark):
    board = rp.leaderboard(spark.createDataFrame(BASE_ROWS, SCHEMA))
    s = rp.best_model_summary(board).first()
    assert s.best_validation_model == "word_svc"
    assert s.largest_drop_val_to_test_macro_f1 == pytest.approx(0.7212155004181767 - 0.45363967864740345)
    assert rp.metric_long(board).count() == 6


def test_append_rows_null_cv(spark):
    t = spark.createDataFrame([V2_ROWS[0]], SCHEMA + ", cv_mean double, cv_std double")
    e = spark.createDataFrame([("voting_ensemble", 0.7, 0.7, 0.4, 0.4)], SCHEMA)
    out = rp.append_rows(t, e).where("experiment = 'voting_ensemble'").first()
    assert out.cv_mean is None and out.cv_std is None


def test_soft_vote_weights_golden(spark):
    members = spark.createDataFrame([
        ("word_svc_strong_reg", 0.7349203461628421),
        ("combined_word_char", 0.7318215940565866),
        ("char_svc_strong_reg", 0.7134361087115423)], "experiment string, val_macro_f1 double")
    w = {r.experiment: r.weight for r in en.normalised_weights(members).collect()}
    assert w["word_svc_strong_reg"] == pytest.approx(0.3370918932622054, abs=1e-15)
    assert w["combined_word_char"] == pytest.approx(0.335670563427344, abs=1e-15)
    assert w["char_svc_strong_reg"] == pytest.approx(0.3272375433104506, abs=1e-15)


def test_votes(spark):
    pred = spark.createDataFrame([
        ("a", 1, "test", 0, 1, 0.9), ("b", 1, "test", 0, 0, 0.2),            # tie of two -> 1
        ("a", 2, "test", 1, 0, 0.4), ("b", 2, "test", 1, 0, 0.45)],
        "experiment string, doc_id long, split string, label int, prediction int, prob double")
    members = spark.createDataFrame([("a",), ("b",)], "experiment string")
    mv = {r.doc_id: r.prediction for r in en.majority_vote(pred, members).collect()}
    assert mv == {1: 1, 2: 0}
    wv = {r.doc_id: r.prediction for r in en.weighted_vote(pred, members=members).collect()}
    assert wv == {1: 1, 2: 0}
    w = spark.createDataFrame([("a", 0.5), ("b", 0.5)], "experiment string, weight double")
    sv = {r.doc_id: (r.prob, r.prediction) for r in en.soft_vote(pred, w).collect()}
    assert sv[1] == (pytest.approx(0.55), 1) and sv[2][1] == 0


def test_cv_summary_population_std(spark):
    scores = [0.7846683893195521, 0.7825919241563264, 0.7896524324723186, 0.7687858331086478, 0.7913106769893011]
    df = spark.createDataFrame([("word_lr_balanced", i, s) for i, s in enumerate(scores)],
                               "experiment string, fold int, macro_f1 double")
    r = va.cv_summary(df).first()
    assert r.cv_mean == pytest.approx(0.7834018512092291, abs=1e-15)
    assert r.cv_std == pytest.approx(0.007968781300531002, abs=1e-15)
    assert r.cv_scores == scores


def test_stratified_folds_balanced(spark):
    rows = [(i, int(i % 7 == 0)) for i in range(2000)]
    df = spark.createDataFrame(rows, "doc_id long, label int")
    f = va.stratified_folds(df, k=5)
    sizes = f.groupBy("label", "fold").count().collect()
    for lab in (0, 1):
        c = [r["count"] for r in sizes if r.label == lab]
        assert len(c) == 5 and max(c) - min(c) <= 1
    assert f.count() == 2000 and f.select("doc_id").distinct().count() == 2000


def test_class_weights_balanced(spark):
    df = spark.createDataFrame([(i, int(i < 10)) for i in range(40)], "doc_id long, label int")
    w = {r.label: r.weight for r in va.class_weights(df).collect()}
    assert w[1] == pytest.approx(40 / (2 * 10)) and w[0] == pytest.approx(40 / (2 * 30))


def test_error_examples_first_eight_by_id(spark):
    rows = [(i, 0, 1) for i in range(20)] + [(100 + i, 1, 0) for i in range(3)] + [(200, 1, 1)]
    pred = spark.createDataFrame(rows, "doc_id long, label int, prediction int")
    docs = spark.createDataFrame([(r[0], f"text {r[0]} bitches") for r in rows], "doc_id long, text string")
    out = rp.error_examples(pred, docs).collect()
    fp = sorted(r.doc_id for r in out if r.error_type == "false_positive")
    assert fp == list(range(8))
    assert sorted(r.doc_id for r in out if r.error_type == "false_negative") == [100, 101, 102]
    assert all(r.sanitized_text.endswith("b****es") for r in out)


def test_top_and_feature_select(spark):
    coef = spark.createDataFrame([(f"f{i:02d}", i, float(i - 20)) for i in range(40)],
                                 "feature string, idx int, weight double")
    top = rp.top_features(coef).collect()
    assert [r.feature for r in top if r["class"] == "hate"][:2] == ["f39", "f38"]
    assert [r.feature for r in top if r["class"] == "non_hate"][:2] == ["f00", "f01"]
    assert len(top) == 30
    ab = rp.top_abs_features(coef).collect()
    assert len(ab) == 12 and ab[0].feature == "f00"
    fs = rp.feature_select(coef)
    kept = fs.orderBy("new_idx").collect()
    assert [r.new_idx for r in kept] == list(range(len(kept)))
    med = sorted(abs(i - 20) for i in range(40))
    m = (med[19] + med[20]) / 2
    assert len(kept) == sum(1 for i in range(40) if abs(i - 20) >= m)
    assert fs.where(F.abs("weight") < m).count() == 0
