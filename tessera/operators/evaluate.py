"""Evaluation: confusion matrix, classification report, metric bundle,
one-pass threshold sweep, validation-chosen threshold applied to test.

Input is a long prediction table with grouping keys (e.g. experiment, split),
``label`` and ``prediction`` (or ``prob`` for the sweep).  Every operator
first reduces to per-group confusion cells (at most classes^2 rows per
group) with one partial+final aggregate; everything after works on those
few rows.  The class set of a group is the sorted union of labels and
predictions present in it; zero divisions give 0.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.numeric import (
    DEFAULT_THRESHOLD,
    GRID_POINTS,
    apply_threshold,
    grid_bucket,
    threshold_at,
)


def _safe_div(num: Column, den: Column) -> Column:
    return F.when(den != 0, num.cast("double") / den).otherwise(F.lit(0.0))


def confusion_cells(pred: DataFrame, keys: Sequence[str], label: str = "label",
                    prediction: str = "prediction") -> DataFrame:
    """(keys..., true_label, pred_label, n) over the group's class grid,
    missing cells 0.  Rows are true labels, columns predicted labels."""
    keys = list(keys)
    counts = pred.groupBy(*keys, F.col(label).alias("true_label"),
                          F.col(prediction).alias("pred_label")).agg(F.count(F.lit(1)).alias("n"))
    # One row per group with its at most classes^2 cells: whatever is derived from
    # it reuses one exchange, so the prediction table is read once and nothing
    # has to be kept.
    cells = counts.groupBy(*keys).agg(F.collect_list(F.struct("true_label", "pred_label", "n")).alias("c"))

    def column(name: str) -> Column:
        return F.array_compact(F.transform("c", lambda x: x[name]))

    classes = F.array_sort(F.array_union(column("true_label"), column("pred_label")))
    grid = (cells.select(*keys, "c", classes.alias("classes"))
            .select(*keys, "c", "classes", F.explode("classes").alias("true_label"))
            .select(*keys, "c", "true_label", F.explode("classes").alias("pred_label")))
    here = F.filter("c", lambda x: (x["true_label"] == F.col("true_label")) & (x["pred_label"] == F.col("pred_label")))
    return grid.select(*keys, "true_label", "pred_label", F.coalesce(F.get(here, F.lit(0))["n"], F.lit(0)).cast("long").alias("n"))


def per_class(cells: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys..., class, tp, fp, fn, support, precision, recall, f1)."""
    keys = list(keys)
    rows = cells.groupBy(*keys, F.col("true_label").alias("class")).agg(
        F.sum("n").alias("support"),
        F.sum(F.when(F.col("true_label") == F.col("pred_label"), F.col("n")).otherwise(0)).alias("tp"))
    cols = cells.groupBy(*keys, F.col("pred_label").alias("class")).agg(F.sum("n").alias("predicted"))
    j = rows.join(cols, keys + ["class"])
    tp, fp = F.col("tp"), F.col("predicted") - F.col("tp")
    fn = F.col("support") - F.col("tp")
    return j.select(
        *keys, "class", tp.cast("long").alias("tp"), fp.cast("long").alias("fp"), fn.cast("long").alias("fn"),
        F.col("support").cast("long").alias("support"),
        _safe_div(tp, F.col("predicted")).alias("precision"),
        _safe_div(tp, F.col("support")).alias("recall"),
        _safe_div(2 * tp, 2 * tp + fp + fn).alias("f1"))


def metric_bundle(pred: DataFrame, keys: Sequence[str], label: str = "label",
                  prediction: str = "prediction") -> DataFrame:
    """Per group: accuracy, macro-F1, support-weighted F1, n, and the
    confusion matrix as text ``[[..],[..]]`` (rows true, columns predicted)."""
    keys = list(keys)
    cells = confusion_cells(pred, keys, label, prediction)
    pc = per_class(cells, keys)
    scores = pc.groupBy(*keys).agg(
        F.sum("tp").alias("correct"), F.sum("support").alias("n"),
        F.avg("f1").alias("macro_f1"),
        F.avg("precision").alias("macro_precision"), F.avg("recall").alias("macro_recall"),
        (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("weighted_f1"))
    row_txt = (cells.groupBy(*keys, "true_label")
               .agg(F.array_sort(F.collect_list(F.struct("pred_label", "n"))).alias("r"))
               .select(*keys, "true_label",
                       F.concat(F.lit("["), F.array_join(F.transform("r", lambda x: x["n"].cast("string")), ","),
                                F.lit("]")).alias("row_txt")))
    cm = (row_txt.groupBy(*keys)
          .agg(F.array_sort(F.collect_list(F.struct("true_label", "row_txt"))).alias("rows"))
          .select(*keys, F.concat(F.lit("["), F.array_join(F.transform("rows", lambda x: x["row_txt"]), ","),
                                  F.lit("]")).alias("confusion_matrix")))
    return (scores.join(cm, keys)
            .select(*keys, (F.col("correct") / F.col("n")).alias("accuracy"), "macro_f1", "weighted_f1",
                    "macro_precision", "macro_recall", F.col("n").cast("long").alias("n"), "confusion_matrix"))


def classification_report(pred: DataFrame, keys: Sequence[str], label: str = "label",
                          prediction: str = "prediction") -> DataFrame:
    """Long report: one row per class, plus ``accuracy`` (in f1; precision
    and recall null), ``macro avg`` and ``weighted avg``; support of the
    summary rows is the group size."""
    keys = list(keys)
    pc = per_class(confusion_cells(pred, keys, label, prediction), keys)
    classes = pc.select(*keys, F.col("class").cast("string").alias("class_name"),
                        "precision", "recall", "f1", F.col("support").cast("double").alias("support"))
    tot = pc.groupBy(*keys).agg(
        F.sum("support").alias("n"), F.sum("tp").alias("correct"),
        F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1").alias("mf"),
        F.sum(F.col("precision") * F.col("support")).alias("wp"),
        F.sum(F.col("recall") * F.col("support")).alias("wr"),
        F.sum(F.col("f1") * F.col("support")).alias("wf"))
    n = F.col("n").cast("double")
    def row(name, p, r, f):
        return F.struct(F.lit(name).alias("class_name"), p.alias("precision"), r.alias("recall"),
                        f.alias("f1"), n.alias("support"))
    none = F.lit(None).cast("double")
    summary = tot.select(*keys, F.explode(F.array(
        row("accuracy", none, none, F.col("correct") / n),
        row("macro avg", F.col("mp"), F.col("mr"), F.col("mf")),
        row("weighted avg", F.col("wp") / n, F.col("wr") / n, F.col("wf") / n),
    )).alias("s")).select(*keys, "s.*")
    return classes.unionByName(summary)


def _f1(tp: Column, fp: Column, fn: Column) -> Column:
    den = 2 * tp + fp + fn
    return F.when(den > 0, (2 * tp).cast("double") / den).otherwise(F.lit(0.0))


def _binary_metrics(tp: Column, fp: Column, p: Column, n: Column):
    """accuracy and macro-F1 of a binary split from counts; a class counts in
    the macro average when it is present in labels or predictions."""
    fn, tn = p - tp, n - fp
    f1_1, f1_0 = _f1(tp, fp, fn), _f1(tn, fn, fp)
    has1 = (p > 0) | (tp + fp > 0)
    has0 = (n > 0) | (tn + fn > 0)
    macro = (F.when(has0 & has1, (f1_0 + f1_1) / F.lit(2.0))
             .when(has1, f1_1).otherwise(f1_0))
    acc = (tp + tn).cast("double") / (p + n)
    return acc, macro, fn, tn


def threshold_sweep(pred: DataFrame, keys: Sequence[str], label: str = "label",
                    prob: str = "prob", positive: int = 1) -> DataFrame:
    """Metrics at all 181 grid thresholds plus the default 0.5 in ONE pass.

    Each probability is bucketed to the highest grid threshold it passes;
    counts per (group, bucket, class) -- at most 182 x 2 rows per group --
    then suffix sums give true/false positives at every threshold.
    """
    keys = list(keys)
    is_pos = (F.col(label) == positive).cast("long")
    b = pred.select(*keys, is_pos.alias("pos"), grid_bucket(prob).alias("k"),
                    (F.col(prob) >= F.lit(DEFAULT_THRESHOLD)).cast("long").alias("half"))
    names = ("pos_k", "neg_k", "half_pos_k", "half_neg_k")
    per_k = b.groupBy(*keys, "k").agg(F.sum("pos").alias("pos_k"),
                                      F.sum(1 - F.col("pos")).alias("neg_k"),
                                      F.sum(F.col("half") * F.col("pos")).alias("half_pos_k"),
                                      F.sum(F.col("half") * (1 - F.col("pos"))).alias("half_neg_k"))
    # <= 182 buckets of a group in one row: the input is scanned once
    group = per_k.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("k", F.struct(*names)))).alias("m"))
    filled = (group.select(*keys, "m", F.explode(F.sequence(F.lit(-1), F.lit(GRID_POINTS - 1))).alias("k"))
              .select(*keys, "k", F.element_at("m", F.col("k")).alias("v"))
              .select(*keys, "k", *[F.coalesce(f"v.{c}", F.lit(0)).alias(c) for c in names]))
    suffix = Window.partitionBy(*keys).orderBy(F.desc("k")).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*keys)
    s = filled.select(*keys, "k",
                      F.sum("pos_k").over(suffix).alias("tp"), F.sum("neg_k").over(suffix).alias("fp"),
                      F.sum("pos_k").over(whole).alias("p"), F.sum("neg_k").over(whole).alias("n"),
                      F.sum("half_pos_k").over(whole).alias("tp_half"),
                      F.sum("half_neg_k").over(whole).alias("fp_half"))
    on_grid = s.where(F.col("k") >= 0).select(
        *keys, threshold_at("k").alias("threshold"), F.lit(False).alias("is_default"), "tp", "fp", "p", "n")
    half = s.where(F.col("k") == -1).select(
        *keys, F.lit(DEFAULT_THRESHOLD).alias("threshold"), F.lit(True).alias("is_default"),
        F.col("tp_half").alias("tp"), F.col("fp_half").alias("fp"), "p", "n")
    both = on_grid.unionByName(half)
    acc, macro, fn, tn = _binary_metrics(F.col("tp"), F.col("fp"), F.col("p"), F.col("n"))
    return both.select(*keys, "threshold", "is_default", F.col("tp").cast("long").alias("tp"),
                       F.col("fp").cast("long").alias("fp"), fn.cast("long").alias("fn"),
                       tn.cast("long").alias("tn"), acc.alias("accuracy"), macro.alias("macro_f1"))


def best_threshold(sweep: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Best macro-F1 per group; 0.5 wins ties, otherwise the smallest
    threshold (the reference replaces only on a strictly greater score)."""
    keys = list(keys)
    w = Window.partitionBy(*keys).orderBy(F.desc("macro_f1"), F.desc("is_default"), F.asc("threshold"))
    return (sweep.withColumn("rn", F.row_number().over(w)).where(F.col("rn") == 1)
            .select(*keys, "threshold", "macro_f1", "accuracy"))


def thresholded_metrics(pred: DataFrame, key: str = "experiment", split: str = "split",
                        choose_on: str = "validation", apply_to: str = "test") -> DataFrame:
    """Pick the threshold on the validation split per model and apply it to
    both splits: (key, threshold, val_accuracy, val_macro_f1,
    test_accuracy, test_macro_f1)."""
    sweep = threshold_sweep(pred.where(F.col(split) == choose_on), [key])
    chosen = best_threshold(sweep, [key]).select(key, "threshold")
    # one row per model: the chosen table is as small as the model list
    applied = (pred.where(F.col(split).isin(choose_on, apply_to))
               .join(F.broadcast(chosen), key)
               .withColumn("prediction", apply_threshold("prob", F.col("threshold"))))
    mb = metric_bundle(applied, [key, "threshold", split])
    return (mb.groupBy(key, "threshold").agg(
        F.max(F.when(F.col(split) == choose_on, F.col("accuracy"))).alias("val_accuracy"),
        F.max(F.when(F.col(split) == choose_on, F.col("macro_f1"))).alias("val_macro_f1"),
        F.max(F.when(F.col(split) == apply_to, F.col("accuracy"))).alias("test_accuracy"),
        F.max(F.when(F.col(split) == apply_to, F.col("macro_f1"))).alias("test_macro_f1")))
