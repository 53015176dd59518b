"""Result tables: leaderboards, summaries, baseline comparison, error
examples, feature tables, chart data in long form.

Result tables hold one row per experiment (tens of rows); their global
windows are over that handful of rows only.  Operators that touch corpus
rows (error examples, coefficient tables) use keyed joins and per-group
top-k that Catalyst turns into map-side limits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.text import REFERENCE_MASK_TERMS, sanitize_text
from tessera.operators.ranks import dense_index, exact_percentile

SUMMARY_COLS = ("val_accuracy", "val_macro_f1", "test_accuracy", "test_macro_f1")


def experiment_table(bundles: DataFrame, key: str = "experiment", split: str = "split") -> DataFrame:
    """Metric bundles per (experiment, split) -> one row per experiment."""
    def pick(s, c):
        return F.max(F.when(F.col(split) == s, F.col(c)))
    return bundles.groupBy(key).agg(
        pick("validation", "accuracy").alias("val_accuracy"),
        pick("validation", "macro_f1").alias("val_macro_f1"),
        pick("test", "accuracy").alias("test_accuracy"),
        pick("test", "macro_f1").alias("test_macro_f1"))


def leaderboard(table: DataFrame, key: str = "experiment") -> DataFrame:
    """Sort by validation macro-F1 (desc; ties by name) with a 1-based rank."""
    w = Window.orderBy(F.desc("val_macro_f1"), F.asc(key))
    return table.withColumn("rank", F.row_number().over(w))


def with_gap(table: DataFrame) -> DataFrame:
    return table.withColumn("gap", F.col("val_macro_f1") - F.col("test_macro_f1"))


def leaderboard_v2(table: DataFrame, key: str = "experiment") -> DataFrame:
    """Sort by val macro-F1, cv_mean, test macro-F1, all desc, nulls last
    (a table without cross-validation gets a null ``cv_mean``)."""
    if "cv_mean" not in table.columns:
        table = table.withColumn("cv_mean", F.lit(None).cast("double"))
    w = Window.orderBy(F.desc_nulls_last("val_macro_f1"), F.desc_nulls_last("cv_mean"),
                       F.desc_nulls_last("test_macro_f1"), F.asc(key))
    return table.withColumn("rank", F.row_number().over(w))


def append_rows(table: DataFrame, extra: DataFrame) -> DataFrame:
    """UNION ALL with missing columns null-filled, metric columns as double."""
    out = table.unionByName(extra, allowMissingColumns=True)
    for c in ("val_accuracy", "val_macro_f1", "test_accuracy", "test_macro_f1", "cv_mean", "cv_std", "gap"):
        if c in out.columns:
            out = out.withColumn(c, F.col(c).cast("double"))
    return out


def best_model_summary(board: DataFrame, key: str = "experiment") -> DataFrame:
    """Best by rank + largest val->test drop, in one aggregate."""
    return board.agg(
        F.min_by(key, "rank").alias("best_validation_model"),
        F.min_by("val_macro_f1", "rank").alias("best_validation_macro_f1"),
        F.min_by("test_macro_f1", "rank").alias("corresponding_test_macro_f1"),
        F.max(F.col("val_macro_f1") - F.col("test_macro_f1")).alias("largest_drop_val_to_test_macro_f1"))


def baseline_compare(original: DataFrame, improved: DataFrame, key: str = "experiment") -> DataFrame:
    """Best of the original runs against best of the improved runs (each by
    val desc, test desc): test improvement and gap reduction, one row."""
    def ranked(t, tag):
        w = Window.orderBy(F.desc("val_macro_f1"), F.desc("test_macro_f1"), F.asc(key))
        return t.select(F.lit(tag).alias("tag"), key, "val_macro_f1", "test_macro_f1",
                        F.row_number().over(w).alias("r"))
    both = ranked(original, "original").unionByName(ranked(improved, "improved"))

    def best(tag, c):
        return F.min_by(c, F.when(F.col("tag") == tag, F.col("r")))
    out = both.agg(
        best("original", key).alias("best_original_model"),
        best("original", "val_macro_f1").alias("best_original_val_f1"),
        best("original", "test_macro_f1").alias("best_original_test_f1"),
        best("improved", key).alias("best_improved_model"),
        best("improved", "val_macro_f1").alias("best_improved_val_f1"),
        best("improved", "test_macro_f1").alias("best_improved_test_f1"))
    return out.select(
        "*",
        (F.col("best_improved_test_f1") - F.col("best_original_test_f1")).alias("test_improvement"),
        ((F.col("best_original_val_f1") - F.col("best_original_test_f1"))
         - (F.col("best_improved_val_f1") - F.col("best_improved_test_f1"))).alias("gap_reduction"))


def error_examples(pred: DataFrame, docs: DataFrame, per_type: int = 8, key: str = "doc_id",
                   mask_terms: Sequence[str] = REFERENCE_MASK_TERMS) -> DataFrame:
    """First ``per_type`` false positives and false negatives (by doc_id),
    with sanitized text.  The per-type limit runs map-side (window group
    limit), so a huge error class never lands in one task."""
    err = pred.where(F.col("label") != F.col("prediction")).select(
        key, "label", "prediction",
        F.when((F.col("label") == 0) & (F.col("prediction") == 1), "false_positive")
        .when((F.col("label") == 1) & (F.col("prediction") == 0), "false_negative").alias("error_type"))
    err = err.where(F.col("error_type").isNotNull())
    w = Window.partitionBy("error_type").orderBy(key)
    first = err.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= per_type)
    return (first.join(docs.select(key, "text"), key)
            .select("error_type", key, sanitize_text("text", mask_terms).alias("sanitized_text"),
                    "label", "prediction", "rn"))


def metric_long(table: DataFrame, key: str = "experiment") -> DataFrame:
    """Chart data: experiment x {validation, test} -> macro-F1."""
    t = table.select(key, F.col("val_macro_f1").alias("validation"), F.col("test_macro_f1").alias("test"))
    return t.unpivot(key, ["validation", "test"], "split", "macro_f1")


def top_features(coef: DataFrame, k: int = 15) -> DataFrame:
    """k largest weights as ``hate`` (desc) and k smallest as ``non_hate``
    (asc); ties by feature.  Two TakeOrderedAndProject + union."""
    hate = coef.orderBy(F.desc("weight"), F.asc("feature")).limit(k).withColumn("class", F.lit("hate"))
    non = coef.orderBy(F.asc("weight"), F.asc("feature")).limit(k).withColumn("class", F.lit("non_hate"))
    return hate.select("feature", "weight", "class").unionByName(non.select("feature", "weight", "class"))


def top_abs_features(coef: DataFrame, k: int = 12) -> DataFrame:
    """k largest |weight| (ties by feature)."""
    return (coef.withColumn("abs_weight", F.abs("weight"))
            .orderBy(F.desc("abs_weight"), F.asc("feature")).limit(k)
            .select("feature", "weight", "abs_weight"))


def feature_select(coef: DataFrame) -> DataFrame:
    """Keep features with |weight| >= median |weight|; re-index densely in
    the old index order.  Median and index are exact at any number of features."""
    med = exact_percentile(coef, F.abs("weight"), 0.5)
    kept = coef.where(F.abs("weight") >= F.lit(med))  # none without features
    return dense_index(kept, ["idx"], name="new_idx").withColumn("new_idx", F.col("new_idx").cast("int"))


def v2_summary(board: DataFrame, original: DataFrame, key: str = "experiment") -> DataFrame:
    """One row: best model by the board's rank (validation first) with its
    gap, the best model by test macro-F1 (diagnostic only; ties by name),
    and the comparison with the original baseline row
    (``model, val_macro_f1, test_macro_f1, gap``)."""
    gap = F.col("val_macro_f1") - F.col("test_macro_f1")
    rows = board.select(F.lit("new").alias("tag"), F.col(key).alias("model"), "val_macro_f1", "test_macro_f1",
                        gap.alias("gap"), F.col("rank").cast("double").alias("r"))
    base = original.select(F.lit("original").alias("tag"), "model", "val_macro_f1", "test_macro_f1", "gap",
                           F.lit(1.0).alias("r"))
    both = rows.unionByName(base)
    is_new = F.col("tag") == "new"
    by_rank = F.when(is_new, F.col("r"))
    by_test = F.when(is_new, F.struct(-F.col("test_macro_f1"), F.col("model")))
    orig = F.when(F.col("tag") == "original", F.col("r"))
    out = both.agg(
        F.min_by("model", by_rank).alias("best_model"),
        F.min_by("val_macro_f1", by_rank).alias("best_val_f1"),
        F.min_by("test_macro_f1", by_rank).alias("corresponding_test_f1"),
        F.min_by("gap", by_rank).alias("gap"),
        F.min_by("model", by_test).alias("best_test_model"),
        F.min_by("test_macro_f1", by_test).alias("best_test_f1"),
        F.min_by("val_macro_f1", by_test).alias("best_test_model_val_f1"),
        F.min_by("gap", by_test).alias("best_test_model_gap"),
        F.min_by("model", orig).alias("original_best_model"),
        F.min_by("test_macro_f1", orig).alias("original_test_f1"),
        F.min_by("gap", orig).alias("original_gap"))
    return out.select(
        "best_model", "best_val_f1", "corresponding_test_f1", "gap", F.lit("val_macro_f1").alias("selection_metric"),
        "best_test_model", "best_test_f1", "best_test_model_val_f1", "best_test_model_gap",
        "original_best_model", "original_test_f1", "original_gap",
        (F.col("corresponding_test_f1") - F.col("original_test_f1")).alias("improvement_over_original"),
        (F.col("original_gap") - F.col("gap")).alias("gap_reduction"))
