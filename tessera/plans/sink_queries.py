"""Registered queries of sources and sinks: each writes into the shared folder and
returns what a later, pruned read finds there."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import ensemble as en
from tessera.operators import evaluate as ev
from tessera.operators import report as rp
from tessera.operators import validate as va
from tessera.plans import eval_queries as eq
from tessera.plans import experiments as ex
from tessera.plans import sqlbits as S
from tessera.plans.fixtures import sink_edge_frame, sink_edge_values_sql
from tessera.plans.text_queries import LABELLED_SQL
from tessera.session import shared_path
from tessera.sources import corpus as co
from tessera.sources import sinks

R = 6
KEYS = ["experiment", "split"]


def _corpus(spark, sf_dir) -> DataFrame:
    """The labelled corpus and a few rows that are hard on text files."""
    return co.labelled_docs(spark, sf_dir).select("text", "label", "split").unionByName(sink_edge_frame(spark))


def q_sink_split_csv(spark, sf_dir):
    """Split CSV files written and read back, two of the three splits."""
    path = shared_path(spark, "splits")
    sinks.write_split_csvs(_corpus(spark, sf_dir), path)
    back = sinks.read_csv(spark, path, "text string, label int, split string")
    return back.where(F.col("split").isin("test", "validation")).select(F.coalesce("text", F.lit("")).alias("text"), "label", "split")


def q_sink_result_csv(spark, sf_dir):
    """Result table with an ensemble row (no cross-validation) through a CSV file."""
    corpus = co.labelled_docs(spark, sf_dir)
    pred = eq._scored(corpus)
    ens = rp.with_gap(rp.experiment_table(ev.metric_bundle(eq._vote_rows(pred), KEYS)))
    table = rp.leaderboard_v2(rp.append_rows(eq._v2_table(pred, corpus), ens))
    path = shared_path(spark, "results")
    sinks.write_result_csv(table, path)
    back = sinks.read_csv(spark, path, table.schema.simpleString()[len("struct<"):-1].replace(":", " "))
    return eq._rnd(back, *rp.SUMMARY_COLS, "cv_mean", "cv_std", "gap")


def _predictions(spark, sf_dir):
    corpus = co.labelled_docs(spark, sf_dir)
    pred = eq.scorer_predictions(corpus).where(F.col("experiment") == "punct")
    return (pred.join(corpus.select("doc_id", "text"), "doc_id")
            .select("doc_id", "split", "text", "label", F.col("prob").alias("prob_hate"), "prediction"))


def q_sink_predictions(spark, sf_dir):
    """Prediction table by split, the test split read back from Parquet and CSV."""
    pred = _predictions(spark, sf_dir)
    out = None
    for fmt in ("parquet", "csv"):
        path = shared_path(spark, f"predictions-{fmt}")
        sinks.write_predictions(pred, path, fmt)
        schema = "doc_id long, text string, label int, prob_hate double, prediction int, split string"
        back = spark.read.parquet(path) if fmt == "parquet" else sinks.read_csv(spark, path, schema)
        part = back.where(F.col("split") == "test").select(F.lit(fmt).alias("format"), "doc_id", *sinks.PREDICTION_COLS)
        out = part if out is None else out.unionByName(part)
    return out.withColumn("prob_hate", F.round("prob_hate", R))


def q_landed_corpus(spark, sf_dir):
    """Split CSV files scanned, given content ids and landed; what the table holds."""
    path = shared_path(spark, "csv")
    corpus = _corpus(spark, sf_dir)
    for split in co.SPLITS:
        part = corpus.where(F.col("split") == split).select("text", "label")
        sinks._csv(part.write, quote_all=True).csv(f"{path}/{split}.csv")
    return co.land_corpus(co.scan_split_csvs(spark, path), shared_path(spark, "landed"))


def q_metrics_json(spark, sf_dir):
    pred = eq.scorer_predictions(co.labelled_docs(spark, sf_dir))
    return sinks.metrics_json(pred, KEYS)


def q_metrics_payload(spark, sf_dir):
    """Result payload of the four scorers and their soft-vote ensemble: metrics,
    cross-validation, members and settings, as canonical JSON."""
    corpus = co.labelled_docs(spark, sf_dir)
    pred = eq._scored(corpus)
    members = en.ranked_members(eq._base_table(pred), 3)
    votes = en.vote_with_members(pred, members, "prob").withColumn("experiment", F.lit("ensemble_top3"))
    who = votes.groupBy("experiment").agg(F.first("members").alias("members"))  # the same in every vote
    folds = va.stratified_folds(corpus.where(F.col("split") == "train")).select("doc_id", "fold")
    cv = ev.metric_bundle(pred.where(F.col("split") == "train").join(folds, "doc_id"), ["experiment", "fold"])
    both = pred.select(*KEYS, "label", "prediction").unionByName(votes.select(*KEYS, "label", "prediction"))
    names = pred.select("experiment").distinct()
    config = names.select("experiment", sinks.json_object(scorer=sinks.json_string(F.col("experiment")),
                                                          threshold=sinks.json_number(F.lit(0.5))).alias("config"))
    return sinks.metrics_payload(both, cv, config, who)


def q_grid_payload(spark, sf_dir):
    """Result payload of the original grid and its soft vote."""
    res = ex.run_grid(ex.normalized_corpus(co.labelled_docs(spark, sf_dir)), ex.ORIGINAL)
    votes = ex.ensemble_votes(res, "soft").withColumn("experiment", F.lit(ex.ENSEMBLES["soft"]))
    who = votes.groupBy("experiment").agg(F.first("members").alias("members"))
    both = res.predictions.select(*KEYS, "label", "prediction").unionByName(votes.select(*KEYS, "label", "prediction"))
    return sinks.metrics_payload(both, res.folds, ex.experiment_config(spark, ex.ORIGINAL), who)


QUERIES = {
    "sink_split_csv": q_sink_split_csv,
    "sink_result_csv": q_sink_result_csv,
    "sink_predictions": q_sink_predictions,
    "landed_corpus": q_landed_corpus,
    "metrics_json": q_metrics_json,
    "metrics_payload": q_metrics_payload,
    "grid_payload": q_grid_payload,
}

# ------------------------------------------------------------ oracle SQL ---
ALL = f"al AS (SELECT text, label, split FROM ({LABELLED_SQL}) UNION ALL SELECT text, label, split FROM {sink_edge_values_sql()})"
CONTENT = "md5(split || chr(31) || CAST(label AS VARCHAR) || chr(31) || text)"


def num(x: str) -> str:
    return f"coalesce(CAST(CAST(round({x}, 6) AS DECIMAL(18,6)) AS VARCHAR), 'null')"


def bundle_sql(p: str, keys: list[str]) -> str:
    """CTE {p}js (keys..., js) over {p}pc and {p}mb of ``metric_ctes``."""
    k = ", ".join(keys)

    def entry(precision: str, recall: str, f1: str, n: str) -> str:
        return (f"'{{\"f1\":' || {num(f1)} || ',\"precision\":' || {num(precision)} || ',\"recall\":' || {num(recall)} || "
                f"',\"support\":' || CAST(CAST({n} AS BIGINT) AS VARCHAR) || '}}'")

    return f"""
    {p}rows AS (SELECT {k}, CAST(cls AS VARCHAR) AS name, {entry('precision', 'recall', 'f1', 'support')} AS e FROM {p}pc
        UNION ALL SELECT {k}, 'macro avg', {entry('avg(precision)', 'avg(recall)', 'avg(f1)', 'sum(support)')} FROM {p}pc GROUP BY {k}
        UNION ALL SELECT {k}, 'weighted avg', {entry('sum(precision * support) / sum(support)', 'sum(recall * support) / sum(support)',
                                                     'sum(f1 * support) / sum(support)', 'sum(support)')} FROM {p}pc GROUP BY {k}),
    {p}rep AS (SELECT {k}, '{{' || string_agg('"' || name || '":' || e, ',' ORDER BY name) || '}}' AS report FROM {p}rows GROUP BY {k}),
    {p}js AS (SELECT {k}, '{{"accuracy":' || {num('accuracy')} || ',"classification_report":' || report || ',"confusion_matrix":'
              || confusion_matrix || ',"macro_f1":' || {num('macro_f1')} || '}}' AS js FROM {p}mb JOIN {p}rep USING ({k}))"""


ORACLE = {
    "sink_split_csv": f"WITH {ALL} SELECT * FROM al WHERE split IN ('test', 'validation')",
    "sink_result_csv": eq.ORACLE["leaderboard_with_ensemble"],
    "sink_predictions": f"""{eq.BASE}, one AS (SELECT pred.doc_id, ld.text, pred.label, round(prob, {R}) AS prob_hate, prediction
        FROM pred JOIN ld USING (doc_id) WHERE experiment = 'punct' AND pred.split = 'test')
        SELECT 'parquet' AS format, * FROM one UNION ALL SELECT 'csv', * FROM one""",
    "landed_corpus": f"""WITH {ALL} SELECT {CONTENT} || '-' || CAST(row_number() OVER (PARTITION BY {CONTENT}) - 1 AS VARCHAR) AS doc_id,
        text, label, split FROM al""",
    "metrics_json": f"{eq.BASE}, {bundle_sql('a_', KEYS)} SELECT experiment, split, js AS metrics_json FROM a_js",
    "metrics_payload": f"""{eq.BASE}, {eq.CV}, {eq.MEMBERS}, {bundle_sql('a_', KEYS)},
        w AS (SELECT experiment, val_macro_f1 / sum(val_macro_f1) OVER () AS weight,
                     row_number() OVER (ORDER BY val_macro_f1 DESC, experiment) AS rank FROM mem),
        sv AS (SELECT split, label, CAST(sum(weight * prob) / sum(weight) >= 0.5::DOUBLE AS INTEGER) AS prediction
               FROM pred JOIN w USING (experiment) GROUP BY doc_id, split, label),
        ve AS (SELECT 'ensemble_top3' AS experiment, * FROM sv), {eq.metric_ctes('ve', KEYS, 'e_')}, {bundle_sql('e_', KEYS)},
        js AS (SELECT * FROM a_js UNION ALL SELECT * FROM e_js),
        cvj AS (SELECT experiment, '{{"cv_mean":' || {num('avg(macro_f1)')} || ',"cv_scores":[' || string_agg({num('macro_f1')}, ',' ORDER BY fold)
                || '],"cv_std":' || {num('stddev_pop(macro_f1)')} || '}}' AS cv FROM cv_mb GROUP BY experiment),
        enj AS (SELECT 'ensemble_top3' AS experiment, '{{"component_models":[' || string_agg('"' || experiment || '"', ',' ORDER BY rank)
                || '],"weights":[' || string_agg({num('weight')}, ',' ORDER BY rank) || ']}}' AS en FROM w),
        cfg AS (SELECT DISTINCT experiment, '{{"scorer":"' || experiment || '","threshold":0.500000}}' AS cfg FROM pred)
        SELECT v.experiment, '{{"config":' || coalesce(cfg, 'null') || ',"cross_validation":' || coalesce(cv, 'null') || ',"ensemble":'
               || coalesce(en, 'null') || ',"test":' || t.js || ',"validation":' || v.js || '}}' AS payload
        FROM js v JOIN js t ON t.experiment = v.experiment AND t.split = 'test' LEFT JOIN cfg ON cfg.experiment = v.experiment
        LEFT JOIN cvj ON cvj.experiment = v.experiment LEFT JOIN enj ON enj.experiment = v.experiment WHERE v.split = 'validation'""",
}
