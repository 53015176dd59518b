"""Stratified folds, cross-validation summaries and balanced class weights.

Folds without a single-partition window: rows are hashed into buckets; the
per-(label, bucket) counts (at most labels x buckets rows) give each bucket
its start offset inside its class; a row number inside (label, bucket) then
yields the class-wide rank, and ``fold = rank mod k``.  Fold sizes per class
differ by at most one; the seed enters through the hash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.numeric import hash_bucket

N_BUCKETS = 1024


def stratified_folds(corpus: DataFrame, k: int = 5, seed: int = 42, key: str = "doc_id",
                     label: str = "label", n_buckets: int = N_BUCKETS) -> DataFrame:
    """(key, label, fold) with fold in [0, k)."""
    b = hash_bucket(F.concat(F.lit(f"{seed}:fold:"), F.col(key).cast("string")), n_buckets)
    rows = corpus.select(key, label, b.alias("bucket"))
    counts = rows.groupBy(label, "bucket").agg(F.count(F.lit(1)).alias("cnt"))
    # Exclusive prefix sum over buckets within a class: <= n_buckets rows per class.
    w = Window.partitionBy(label).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(label, "bucket", F.coalesce(F.sum("cnt").over(w), F.lit(0)).alias("start"))
    rn = F.row_number().over(Window.partitionBy(label, "bucket").orderBy(key))
    ranked = rows.select(key, label, "bucket", rn.alias("rn"))
    # starts has at most (classes x n_buckets) rows: a parameter-bounded broadcast.
    return (ranked.join(F.broadcast(starts), [label, "bucket"])
            .select(key, label, F.pmod(F.col("start") + F.col("rn") - 1, F.lit(k)).cast("int").alias("fold")))


def class_weights(corpus: DataFrame, label: str = "label") -> DataFrame:
    """Balanced weights n / (k * n_class) per label."""
    counts = corpus.groupBy(label).agg(F.count(F.lit(1)).alias("n_class"))
    whole = Window.partitionBy()  # over the tiny per-class table only
    return counts.select(
        label, "n_class",
        (F.sum("n_class").over(whole).cast("double")
         / (F.count(F.lit(1)).over(whole) * F.col("n_class"))).alias("weight"))


def cv_summary(fold_scores: DataFrame, group: str = "experiment") -> DataFrame:
    """Mean and POPULATION std of fold scores, plus the scores in fold order."""
    return (fold_scores.groupBy(group)
            .agg(F.avg("macro_f1").alias("cv_mean"),
                 F.stddev_pop("macro_f1").alias("cv_std"),
                 F.transform(F.array_sort(F.collect_list(F.struct("fold", "macro_f1"))),
                             lambda s: s["macro_f1"]).alias("cv_scores")))
