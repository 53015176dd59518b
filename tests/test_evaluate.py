"""Evaluation goldens from the reference's artifacts (copied as literals)
and the one-pass threshold sweep against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from tessera.functions.numeric import grid_values
from tessera.operators import evaluate as ev


def frame_from_cm(spark, cm, group="g"):
    rows, i = [], 0
    for t, row in enumerate(cm):
        for p, n in enumerate(row):
            for _ in range(n):
                rows.append((group, i, t, p))
                i += 1
    return spark.createDataFrame(rows, "experiment string, doc_id long, label int, prediction int")


def test_bundle_golden_1(spark):
    df = frame_from_cm(spark, [[441, 132], [134, 293]])
    b = ev.metric_bundle(df, ["experiment"]).first()
    assert b.accuracy == pytest.approx(0.734, abs=1e-15)
    assert b.macro_f1 == pytest.approx(0.7280430550784381, abs=1e-15)
    assert b.confusion_matrix == "[[441,132],[134,293]]"
    rep = {r.class_name: r for r in ev.classification_report(df, ["experiment"]).collect()}
    assert rep["0"].precision == pytest.approx(0.7669565217391304, abs=1e-15)
    assert rep["0"].recall == pytest.approx(0.7696335078534031, abs=1e-15)
    assert rep["0"].f1 == pytest.approx(0.7682926829268293, abs=1e-15)
    assert rep["0"].support == 573
    assert rep["accuracy"].f1 == pytest.approx(0.734)


def test_bundle_golden_2_weighted(spark):
    df = frame_from_cm(spark, [[384, 1334], [116, 1136]])
    b = ev.metric_bundle(df, ["experiment"]).first()
    assert b.accuracy == pytest.approx(0.5117845117845118, abs=1e-15)
    assert b.macro_f1 == pytest.approx(0.4783411964731916, abs=1e-15)
    assert b.weighted_f1 == pytest.approx(0.45761701437867675, abs=1e-14)


def test_bundle_golden_3(spark):
    df = frame_from_cm(spark, [[517, 1201], [51, 1201]])
    b = ev.metric_bundle(df, ["experiment"]).first()
    assert b.accuracy == pytest.approx(0.5784511784511784, abs=1e-15)
    assert b.macro_f1 == pytest.approx(0.5548401277426529, abs=1e-15)
    rep = {r.class_name: r for r in ev.classification_report(df, ["experiment"]).collect()}
    assert rep["1"].precision == 0.5


def test_class_never_predicted_and_missing_class(spark):
    never = frame_from_cm(spark, [[5, 0], [3, 0]])
    b = ev.metric_bundle(never, ["experiment"]).first()
    assert b.confusion_matrix == "[[5,0],[3,0]]"
    assert b.macro_f1 == pytest.approx((2 * 5 / (2 * 5 + 3) + 0.0) / 2)
    only0 = spark.createDataFrame([("g", 1, 0, 0), ("g", 2, 0, 0)], "experiment string, doc_id long, label int, prediction int")
    b = ev.metric_bundle(only0, ["experiment"]).first()
    assert b.confusion_matrix == "[[2]]" and b.macro_f1 == 1.0


def _brute_macro(labels, probs, t):
    preds = [int(p >= t) for p in probs]
    classes = sorted(set(labels) | set(preds))
    f1s = []
    for c in classes:
        tp = sum(1 for y, p in zip(labels, preds) if y == c and p == c)
        fp = sum(1 for y, p in zip(labels, preds) if y != c and p == c)
        fn = sum(1 for y, p in zip(labels, preds) if y == c and p != c)
        f1s.append(2 * tp / (2 * tp + fp + fn) if 2 * tp + fp + fn else 0.0)
    return sum(f1s) / len(f1s)


def test_sweep_equals_brute_force(spark):
    rng = random.Random(3)
    grid = grid_values()
    labels = [int(rng.random() < 0.3) for _ in range(600)]
    probs = [rng.random() for _ in range(560)] + [rng.choice(grid) for _ in range(40)]  # some exactly on a threshold
    df = spark.createDataFrame([("e", i, y, p) for i, (y, p) in enumerate(zip(labels, probs))],
                               "experiment string, doc_id long, label int, prob double")
    got = {(r.threshold, r.is_default): r.macro_f1 for r in ev.threshold_sweep(df, ["experiment"]).collect()}
    assert len(got) == 182
    for t in grid:
        assert got[(t, False)] == pytest.approx(_brute_macro(labels, probs, t), abs=1e-12)
    assert got[(0.5, True)] == pytest.approx(_brute_macro(labels, probs, 0.5), abs=1e-12)
    best = ev.best_threshold(ev.threshold_sweep(df, ["experiment"]), ["experiment"]).first()
    want_t, want = 0.5, _brute_macro(labels, probs, 0.5)
    for t in grid:
        s = _brute_macro(labels, probs, t)
        if s > want:
            want_t, want = t, s
    assert best.threshold == want_t


def test_best_threshold_ties_prefer_half_then_smallest(spark):
    # every probability far from the grid middle: many thresholds tie with 0.5
    df = spark.createDataFrame([("e", 1, 1, 0.99), ("e", 2, 0, 0.01)],
                               "experiment string, doc_id long, label int, prob double")
    best = ev.best_threshold(ev.threshold_sweep(df, ["experiment"]), ["experiment"]).first()
    assert best.threshold == 0.5 and best.macro_f1 == 1.0
    df2 = spark.createDataFrame([("e", 1, 1, 0.3), ("e", 2, 0, 0.2)],
                                "experiment string, doc_id long, label int, prob double")
    best2 = ev.best_threshold(ev.threshold_sweep(df2, ["experiment"]), ["experiment"]).first()
    assert best2.macro_f1 == 1.0 and best2.threshold == pytest.approx(0.205)


def test_threshold_inclusive(spark):
    from tessera.functions.numeric import apply_threshold
    df = spark.createDataFrame([(0.5,), (0.4999999,)], "p double")
    assert [r[0] for r in df.select(apply_threshold("p", 0.5)).collect()] == [1, 0]


def test_softmax_and_argmax_ties(spark):
    from tessera.functions.numeric import argmax_class, softmax_prob
    df = spark.createDataFrame([([1.0, 1.0],), ([0.0, 2.0],)], "l array<double>")
    rows = df.select(softmax_prob("l").alias("p"), argmax_class("l").alias("a")).collect()
    assert rows[0].p == 0.5 and rows[0].a == 0          # argmax gives 0, threshold 0.5 gives 1
    assert rows[1].a == 1 and rows[1].p == pytest.approx(1 / (1 + 2.718281828459045 ** -2))


def test_thresholded_metrics_uses_validation(spark):
    rows = [("e", i, "validation", y, p) for i, (y, p) in enumerate([(1, 0.9), (0, 0.7), (1, 0.8), (0, 0.1)])]
    rows += [("e", 10 + i, "test", y, p) for i, (y, p) in enumerate([(1, 0.75), (0, 0.70)])]
    df = spark.createDataFrame(rows, "experiment string, doc_id long, split string, label int, prob double")
    r = ev.thresholded_metrics(df).first()
    assert 0.7 < r.threshold <= 0.8 and r.val_macro_f1 == 1.0 and r.test_macro_f1 == 1.0
    assert df.where(F.col("split") == "test").count() == 2
