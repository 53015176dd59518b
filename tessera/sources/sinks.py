"""Sinks: split CSV files, result tables, nested metric JSON, prediction tables.

Result tables are tens of rows, so they are written as one file
(``coalesce(1)``); corpus-sized outputs (splits, predictions) keep their
partitioning and are partitioned by ``split`` on disk.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.evaluate import classification_report, confusion_cells, metric_bundle
from tessera.operators.validate import cv_summary


def _csv(writer, quote_all: bool = False):
    """A CSV writer that keeps texts as they are: quotes doubled, newlines inside
    quotes, and leading and trailing spaces not trimmed."""
    return (writer.option("header", True).option("escape", '"').option("quoteAll", quote_all)
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """What ``_csv`` wrote."""
    return (spark.read.schema(schema).option("header", True).option("multiLine", True).option("escape", '"').csv(path))


def write_split_csvs(corpus: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One folder per split (``split=train/`` ...), header, quoted texts."""
    _csv(corpus.select("text", "label", "split").write.mode(mode).partitionBy("split"), quote_all=True).csv(path)


def write_result_csv(table: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A small result table (one row per experiment) as a single CSV file; null
    numbers stay empty."""
    _csv(table.coalesce(1).write.mode(mode)).csv(path)


def write_json(table: DataFrame, path: str, mode: str = "overwrite", single_file: bool = True) -> None:
    out = table.coalesce(1) if single_file else table
    out.write.mode(mode).json(path)


PREDICTION_COLS = ("text", "label", "prob_hate", "prediction")


def write_predictions(pred: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Prediction table (text, label, prob_hate, prediction + keys), by split."""
    w = pred.write.mode(mode).partitionBy("split")
    if fmt == "csv":
        _csv(w, quote_all=True).csv(path)
    else:
        w.parquet(path)


def metrics_struct(pred: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Nested metric bundle per group: accuracy, macro_f1,
    confusion_matrix ARRAY<ARRAY<LONG>>, classification_report
    MAP<STRING, STRUCT<precision, recall, f1, support>> (the report's
    accuracy stays a plain number in ``accuracy``)."""
    keys = list(keys)
    cells = confusion_cells(pred, keys)
    rows = (cells.groupBy(*keys, "true_label")
            .agg(F.array_sort(F.collect_list(F.struct("pred_label", "n"))).alias("r"))
            .select(*keys, "true_label", F.transform("r", lambda x: x["n"]).alias("row")))
    cm = (rows.groupBy(*keys)
          .agg(F.array_sort(F.collect_list(F.struct("true_label", "row"))).alias("rows"))
          .select(*keys, F.transform("rows", lambda x: x["row"]).alias("confusion_matrix")))
    rep = (classification_report(pred, keys).where(F.col("class_name") != "accuracy")
           .groupBy(*keys)
           .agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(
               "class_name", F.struct("precision", "recall", "f1", "support"))))).alias("classification_report")))
    mb = metric_bundle(pred, keys).select(*keys, "accuracy", "macro_f1")
    return mb.join(cm, keys).join(rep, keys)


# Canonical JSON: keys in ascending order, no spaces, whole numbers as they are and
# all others with six decimals, so equal tables give equal bytes in any engine.

def json_number(c: Column) -> Column:
    """Six decimals; ``null`` for null."""
    return F.coalesce(F.round(c.cast("double"), 6).cast("decimal(18,6)").cast("string"), F.lit("null"))


def json_string(c: Column) -> Column:
    one = F.to_json(F.array(c))
    return F.coalesce(F.substring(one, F.lit(2), F.length(one) - 2), F.lit("null"))


def json_object(**members: Column) -> Column:
    """An object of members that are JSON text already."""
    parts = [F.concat(F.lit(f'"{k}":'), members[k]) for k in sorted(members)]
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))


def json_list(items: Column) -> Column:
    """A list of an array of JSON texts."""
    return F.concat(F.lit("["), F.array_join(items, ","), F.lit("]"))


def metrics_json(pred: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys..., metrics_json STRING): the metric bundle of each group as canonical
    JSON -- accuracy, classification_report (by class, macro and weighted average),
    confusion_matrix (rows true, columns predicted), macro_f1."""
    keys = list(keys)
    entry = json_object(f1=json_number(F.col("f1")), precision=json_number(F.col("precision")),
                        recall=json_number(F.col("recall")), support=F.col("support").cast("long").cast("string"))
    report = (classification_report(pred, keys).where(F.col("class_name") != "accuracy")
              .select(*keys, "class_name", F.concat(json_string(F.col("class_name")), F.lit(":"), entry).alias("e"))
              .groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("class_name", "e"))).alias("r"))
              .select(*keys, F.concat(F.lit("{"), F.array_join(F.transform("r", lambda x: x["e"]), ","), F.lit("}")).alias("report")))
    body = json_object(accuracy=json_number(F.col("accuracy")), classification_report=F.col("report"),
                       confusion_matrix=F.col("confusion_matrix"), macro_f1=json_number(F.col("macro_f1")))
    return metric_bundle(pred, keys).join(report, keys).select(*keys, body.alias("metrics_json"))


def metrics_payload(pred: DataFrame, folds: DataFrame | None = None, config: DataFrame | None = None,
                    ensembles: DataFrame | None = None, key: str = "experiment") -> DataFrame:
    """(experiment, payload STRING): everything a result file holds of an
    experiment, as canonical JSON with the blocks

    * ``validation``, ``test``: metric bundles;
    * ``config``: the JSON text of ``config`` (experiment, config), else null;
    * ``cross_validation``: cv_mean, cv_scores (in fold order) and cv_std from
      ``folds`` (experiment, fold, macro_f1), else null;
    * ``ensemble``: component_models and weights, in rank order, from
      ``ensembles`` (experiment, members array of (experiment, weight)), else null.
    """
    bundles = metrics_json(pred.where(F.col("split").isin("validation", "test")), [key, "split"])

    def of(split: str) -> Column:
        return F.coalesce(F.max(F.when(F.col("split") == split, F.col("metrics_json"))), F.lit("null")).alias(split)

    out = bundles.groupBy(key).agg(of("validation"), of("test"))
    blocks = {"validation": F.col("validation"), "test": F.col("test")}
    if config is not None:
        out = out.join(config.select(key, "config"), key, "left")
    if folds is not None:
        cv = cv_summary(folds, key)
        text = json_object(cv_mean=json_number(F.col("cv_mean")), cv_std=json_number(F.col("cv_std")),
                           cv_scores=json_list(F.transform("cv_scores", json_number)))
        out = out.join(cv.select(key, text.alias("cross_validation")), key, "left")
    if ensembles is not None:
        text = json_object(component_models=json_list(F.transform("members", lambda m: json_string(m["experiment"]))),
                           weights=json_list(F.transform("members", lambda m: json_number(m["weight"]))))
        out = out.join(ensembles.select(key, text.alias("ensemble")), key, "left")
    for name in ("config", "cross_validation", "ensemble"):
        blocks[name] = F.coalesce(F.col(name), F.lit("null")) if name in out.columns else F.lit("null")
    return out.select(key, json_object(**blocks).alias("payload"))
