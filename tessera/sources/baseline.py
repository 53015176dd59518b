"""Earlier-result scan: the best row of a stored experiment summary, or
fixed fallback numbers when the summary is absent or empty."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values: fallback baseline of the reference -----------------------
FALLBACK_MODEL = "word_lr"
FALLBACK_VAL_F1 = 0.7312
FALLBACK_TEST_F1 = 0.4780
FALLBACK_GAP = 0.2532
# ----------------------------------------------------------------------------

SUMMARY_SCHEMA = ("experiment STRING, val_accuracy DOUBLE, val_macro_f1 DOUBLE, "
                  "test_accuracy DOUBLE, test_macro_f1 DOUBLE")


def best_of(summary: DataFrame) -> DataFrame:
    """Best row by val macro-F1 desc, then test macro-F1 desc, with its gap."""
    return (summary.orderBy(F.desc("val_macro_f1"), F.desc("test_macro_f1"), F.asc("experiment")).limit(1)
            .select(F.col("experiment").alias("model"), "val_macro_f1", "test_macro_f1",
                    (F.col("val_macro_f1") - F.col("test_macro_f1")).alias("gap")))


def load_original_baseline(spark: SparkSession, path: str) -> DataFrame:
    """One row (model, val_macro_f1, test_macro_f1, gap)."""
    fallback = spark.createDataFrame(
        [(FALLBACK_MODEL, FALLBACK_VAL_F1, FALLBACK_TEST_F1, FALLBACK_GAP)],
        "model STRING, val_macro_f1 DOUBLE, test_macro_f1 DOUBLE, gap DOUBLE")
    try:
        summary = spark.read.schema(SUMMARY_SCHEMA).option("header", True).csv(path)
        summary.schema
    except AnalysisException:
        return fallback
    best = best_of(summary)
    return best if not best.isEmpty() else fallback
