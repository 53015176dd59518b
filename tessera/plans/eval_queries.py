"""Registered queries: evaluation, threshold search, ensembles, leaderboards,
summaries, error examples, feature tables -- on the deterministic scorers
of ``tessera.plans.scorers`` so that DuckDB can check every value."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import text as tx
from tessera.functions.numeric import GRID_POINTS, GRID_START, GRID_STEP, argmax_class, hash_uniform, softmax_prob
from tessera.operators import ensemble as en
from tessera.operators import evaluate as ev
from tessera.operators import features as fe
from tessera.operators import report as rp
from tessera.operators import validate as va
from tessera.plans import sqlbits as S
from tessera.plans.scorers import DATA_TERMS, predictions_sql, scorer_predictions
from tessera.plans.text_queries import LABELLED_SQL
from tessera.session import stored
from tessera.sources.corpus import all_docs, labelled_docs

R = 6
KEYS = ["experiment", "split"]
MASKS = tx.REFERENCE_MASK_TERMS + DATA_TERMS


def _rnd(df: DataFrame, *cols: str) -> DataFrame:
    for c in cols:
        df = df.withColumn(c, F.round(c, R))
    return df


# ------------------------------------------------------------ Spark side ---
def _scored(corpus):
    """Scorer predictions, stored for the several sub-plans that read them
    (one row per document and scorer)."""
    return stored(scorer_predictions(corpus), "scores")


def _pred(spark, sf_dir):
    return _scored(labelled_docs(spark, sf_dir))


def _base_table(pred):
    return rp.experiment_table(ev.metric_bundle(pred, KEYS))


def _cv(pred, corpus):
    """Fold macro-F1 of each scorer on the train split's stratified folds."""
    folds = va.stratified_folds(corpus.where(F.col("split") == "train"))
    fp = pred.where(F.col("split") == "train").join(folds.select("doc_id", "fold"), "doc_id")
    scores = ev.metric_bundle(fp, ["experiment", "fold"]).select("experiment", "fold", "macro_f1")
    return va.cv_summary(scores)


def _v2_table(pred, corpus):
    cv = _cv(pred, corpus).select("experiment", "cv_mean", "cv_std")
    return rp.with_gap(_base_table(pred).join(cv, "experiment", "left"))


def _members(pred):
    return en.top_members(_base_table(pred), 3)


def _vote_rows(pred):
    return en.majority_vote(pred, _members(pred)).withColumn("experiment", F.lit("voting_ensemble"))


def q_confusion_matrix(spark, sf_dir):
    return ev.confusion_cells(_pred(spark, sf_dir), KEYS)


def q_classification_report(spark, sf_dir):
    return _rnd(ev.classification_report(_pred(spark, sf_dir), KEYS), "precision", "recall", "f1")


def q_metric_bundle(spark, sf_dir):
    return _rnd(ev.metric_bundle(_pred(spark, sf_dir), KEYS),
                "accuracy", "macro_f1", "weighted_f1", "macro_precision", "macro_recall")


def q_threshold_sweep(spark, sf_dir):
    return _rnd(ev.threshold_sweep(_pred(spark, sf_dir), KEYS), "threshold", "accuracy", "macro_f1")


def q_best_threshold(spark, sf_dir):
    sw = ev.threshold_sweep(_pred(spark, sf_dir), KEYS)
    return _rnd(ev.best_threshold(sw, KEYS), "threshold", "accuracy", "macro_f1")


def q_thresholded_metrics(spark, sf_dir):
    return _rnd(ev.thresholded_metrics(_pred(spark, sf_dir)), "threshold", *rp.SUMMARY_COLS)


def _logits(corpus):
    u0 = hash_uniform(F.concat(F.lit("l0:"), F.col("doc_id").cast("string")))
    u1 = hash_uniform(F.concat(F.lit("l1:"), F.col("doc_id").cast("string")))
    return corpus.select("doc_id", F.array(u0 * 4.0 - 2.0, u1 * 4.0 - 2.0).alias("logits"))


def q_softmax_prob(spark, sf_dir):
    lg = _logits(all_docs(spark, sf_dir))
    return lg.select("doc_id", F.round(softmax_prob("logits"), R).alias("prob_hate"))


def q_argmax_class(spark, sf_dir):
    lg = _logits(all_docs(spark, sf_dir))
    return lg.select("doc_id", argmax_class("logits").alias("prediction"))


def q_majority_vote(spark, sf_dir):
    pred = _pred(spark, sf_dir)
    return en.majority_vote(pred, _members(pred))


def q_soft_vote(spark, sf_dir):
    pred = _pred(spark, sf_dir)
    w = en.normalised_weights(_members(pred))
    return _rnd(en.soft_vote(pred, w), "prob")


def q_weighted_vote(spark, sf_dir):
    pred = _pred(spark, sf_dir)
    return en.weighted_vote(pred, members=_members(pred))


def q_leaderboard(spark, sf_dir):
    return _rnd(rp.leaderboard(_base_table(_pred(spark, sf_dir))), *rp.SUMMARY_COLS)


def q_leaderboard_v2(spark, sf_dir):
    corpus = labelled_docs(spark, sf_dir)
    t = rp.leaderboard_v2(_v2_table(_scored(corpus), corpus))
    return _rnd(t, *rp.SUMMARY_COLS, "cv_mean", "cv_std", "gap")


def q_leaderboard_gap(spark, sf_dir):
    t = rp.with_gap(_base_table(_pred(spark, sf_dir)))
    return _rnd(t.select("experiment", "val_macro_f1", "test_macro_f1", "gap"), "val_macro_f1", "test_macro_f1", "gap")


def q_leaderboard_with_ensemble(spark, sf_dir):
    corpus = labelled_docs(spark, sf_dir)
    pred = _scored(corpus)
    ens = rp.with_gap(rp.experiment_table(ev.metric_bundle(_vote_rows(pred), KEYS)))
    t = rp.leaderboard_v2(rp.append_rows(_v2_table(pred, corpus), ens))
    return _rnd(t, *rp.SUMMARY_COLS, "cv_mean", "cv_std", "gap")


def q_v2_summary(spark, sf_dir):
    """Best by validation (v2 order, ensemble included) and by test, against
    the best row of the base table."""
    from tessera.sources.baseline import best_of
    corpus = labelled_docs(spark, sf_dir)
    pred = _scored(corpus)
    ens = rp.with_gap(rp.experiment_table(ev.metric_bundle(_vote_rows(pred), KEYS)))
    board = rp.leaderboard_v2(rp.append_rows(_v2_table(pred, corpus), ens))
    out = rp.v2_summary(board, best_of(_base_table(pred)))
    return _rnd(out, "best_val_f1", "corresponding_test_f1", "gap", "best_test_f1", "best_test_model_val_f1",
                "best_test_model_gap", "original_test_f1", "original_gap", "improvement_over_original",
                "gap_reduction")


def q_best_model_summary(spark, sf_dir):
    b = rp.best_model_summary(rp.leaderboard(_base_table(_pred(spark, sf_dir))))
    return _rnd(b, "best_validation_macro_f1", "corresponding_test_macro_f1", "largest_drop_val_to_test_macro_f1")


def q_baseline_compare(spark, sf_dir):
    pred = _pred(spark, sf_dir)
    tuned = ev.thresholded_metrics(pred).withColumn("experiment", F.concat("experiment", F.lit("_tuned")))
    out = rp.baseline_compare(_base_table(pred), tuned)
    return _rnd(out, "best_original_val_f1", "best_original_test_f1", "best_improved_val_f1",
                "best_improved_test_f1", "test_improvement", "gap_reduction")


def q_error_examples(spark, sf_dir):
    corpus = labelled_docs(spark, sf_dir)
    pred = _scored(corpus)
    best = rp.leaderboard(_base_table(pred)).where(F.col("rank") == 1).select("experiment")
    test_pred = pred.where(F.col("split") == "test").join(F.broadcast(best), "experiment")
    return rp.error_examples(test_pred, corpus, 8, mask_terms=MASKS)


def q_metric_long(spark, sf_dir):
    return _rnd(rp.metric_long(_base_table(_pred(spark, sf_dir))), "macro_f1")


def q_cv_summary(spark, sf_dir):
    corpus = labelled_docs(spark, sf_dir)
    cv = _cv(_scored(corpus), corpus)
    return _rnd(cv.select("experiment", "cv_mean", "cv_std", F.size("cv_scores").alias("n_folds")), "cv_mean", "cv_std")


def coefficient_table(spark, sf_dir, spec=fe.WORD_1_2, split: str | None = "train") -> DataFrame:
    """Smoothed log-odds weight of every vocabulary term (presence in
    positive vs negative documents of ``split``, None: of all labelled ones): a
    data-derived stand-in for a fitted model's coefficients, computed as the log
    of one integer ratio so equal ratios tie exactly."""
    corpus = labelled_docs(spark, sf_dir)
    if split is not None:
        corpus = corpus.where(F.col("split") == split)
    norm = corpus.select("doc_id", "label", tx.normalize_text("text").alias("text"))
    counts = fe.term_counts(norm, spec)
    n_docs, n_pos = norm.agg(F.count(F.lit(1)), F.sum("label")).first()
    n_neg = n_docs - n_pos
    vocab = fe.fit_vocab(counts, n_docs, spec)
    per = (counts.join(F.broadcast(vocab.select("term", "idx")), "term")
           .join(norm.select("doc_id", "label"), "doc_id")
           .groupBy("term", "idx")
           .agg(F.sum("label").alias("p"), F.sum(1 - F.col("label")).alias("n")))
    ratio = ((F.col("p") + 1.0) * float(n_neg + 2)) / ((F.col("n") + 1.0) * float(n_pos + 2))
    return per.select(F.col("term").alias("feature"), "idx", F.log(ratio).alias("weight"))


def q_top_features(spark, sf_dir):
    return _rnd(rp.top_features(coefficient_table(spark, sf_dir)), "weight")


def q_top_abs_features(spark, sf_dir):
    """Largest |weight| over the whole labelled corpus, all three splits."""
    return _rnd(rp.top_abs_features(coefficient_table(spark, sf_dir, split=None)), "weight", "abs_weight")


def q_feature_select(spark, sf_dir):
    fs = rp.feature_select(coefficient_table(spark, sf_dir))
    return _rnd(fs.select("feature", "idx", "new_idx", "weight"), "weight")


QUERIES = {
    "confusion_matrix": q_confusion_matrix,
    "classification_report": q_classification_report,
    "metric_bundle": q_metric_bundle,
    "threshold_sweep": q_threshold_sweep,
    "best_threshold": q_best_threshold,
    "thresholded_metrics": q_thresholded_metrics,
    "softmax_prob": q_softmax_prob,
    "argmax_class": q_argmax_class,
    "majority_vote": q_majority_vote,
    "soft_vote": q_soft_vote,
    "weighted_vote": q_weighted_vote,
    "leaderboard": q_leaderboard,
    "leaderboard_v2": q_leaderboard_v2,
    "leaderboard_gap": q_leaderboard_gap,
    "leaderboard_with_ensemble": q_leaderboard_with_ensemble,
    "best_model_summary": q_best_model_summary,
    "v2_summary": q_v2_summary,
    "baseline_compare": q_baseline_compare,
    "error_examples": q_error_examples,
    "metric_long": q_metric_long,
    "cv_summary": q_cv_summary,
    "top_features": q_top_features,
    "top_abs_features": q_top_abs_features,
    "feature_select": q_feature_select,
}


# ------------------------------------------------------------ oracle SQL ---
def metric_ctes(src: str, keys: list[str], p: str) -> str:
    """CTEs {p}cells, {p}pc (per class), {p}mb (bundle) over CTE ``src``
    with columns keys..., label, prediction."""
    k = ", ".join(keys)
    ku = ", ".join(keys)
    return f"""
    {p}cnt AS (SELECT {k}, label AS true_label, prediction AS pred_label, count(*) AS n FROM {src} GROUP BY ALL),
    {p}cls AS (SELECT {k}, list_sort(list_distinct(list(true_label) || list(pred_label))) AS classes FROM {p}cnt GROUP BY ALL),
    {p}g1 AS (SELECT {k}, unnest(classes) AS true_label, classes FROM {p}cls),
    {p}grid AS (SELECT {k}, true_label, unnest(classes) AS pred_label FROM {p}g1),
    {p}cells AS (SELECT {k}, true_label, pred_label, CAST(coalesce(n, 0) AS BIGINT) AS n
                 FROM {p}grid LEFT JOIN {p}cnt USING ({ku}, true_label, pred_label)),
    {p}pc0 AS (SELECT r.*, c.predicted FROM
        (SELECT {k}, true_label AS cls, CAST(sum(n) AS BIGINT) AS support,
                CAST(sum(CASE WHEN true_label = pred_label THEN n ELSE 0 END) AS BIGINT) AS tp FROM {p}cells GROUP BY ALL) r
        JOIN (SELECT {k}, pred_label AS cls, CAST(sum(n) AS BIGINT) AS predicted FROM {p}cells GROUP BY ALL) c
        USING ({ku}, cls)),
    {p}pc AS (SELECT {k}, cls, tp, predicted - tp AS fp, support - tp AS fn, support,
        CASE WHEN predicted <> 0 THEN tp::DOUBLE / predicted ELSE 0.0 END AS precision,
        CASE WHEN support <> 0 THEN tp::DOUBLE / support ELSE 0.0 END AS recall,
        CASE WHEN 2 * tp + (predicted - tp) + (support - tp) <> 0
             THEN (2 * tp)::DOUBLE / (2 * tp + (predicted - tp) + (support - tp)) ELSE 0.0 END AS f1 FROM {p}pc0),
    {p}rt AS (SELECT {k}, true_label, '[' || string_agg(CAST(n AS VARCHAR), ',' ORDER BY pred_label) || ']' AS row_txt
              FROM {p}cells GROUP BY ALL),
    {p}cm AS (SELECT {k}, '[' || string_agg(row_txt, ',' ORDER BY true_label) || ']' AS confusion_matrix FROM {p}rt GROUP BY ALL),
    {p}mb AS (SELECT {k}, sum(tp)::DOUBLE / sum(support) AS accuracy, avg(f1) AS macro_f1,
                     sum(f1 * support) / sum(support) AS weighted_f1, avg(precision) AS macro_precision,
                     avg(recall) AS macro_recall, CAST(sum(support) AS BIGINT) AS n, any_value(confusion_matrix) AS confusion_matrix
              FROM {p}pc JOIN {p}cm USING ({ku}) GROUP BY ALL)"""


def exp_table_sql(mb: str) -> str:
    return f"""SELECT experiment,
        max(CASE WHEN split = 'validation' THEN accuracy END) AS val_accuracy,
        max(CASE WHEN split = 'validation' THEN macro_f1 END) AS val_macro_f1,
        max(CASE WHEN split = 'test' THEN accuracy END) AS test_accuracy,
        max(CASE WHEN split = 'test' THEN macro_f1 END) AS test_macro_f1 FROM {mb} GROUP BY experiment"""


def sweep_ctes(src: str, keys: list[str], p: str) -> str:
    """CTE {p}sw over ``src`` (keys..., label, prob)."""
    k = ", ".join(keys)
    g = S.grid_value
    step = f"{GRID_STEP!r}::DOUBLE"
    last = GRID_POINTS - 1
    return f"""
    {p}b0 AS (SELECT {k}, CAST(label = 1 AS BIGINT) AS pos, CAST(prob >= 0.5::DOUBLE AS BIGINT) AS half, prob,
                     least(greatest(CAST(floor((prob - {GRID_START!r}::DOUBLE) / {step}) AS INTEGER), -1), {last}) AS guess
              FROM {src}),
    {p}b1 AS (SELECT *, CASE WHEN guess >= 0 AND {g('guess')} > prob THEN guess - 1 ELSE guess END AS down FROM {p}b0),
    {p}b2 AS (SELECT *, CASE WHEN down + 1 <= {last} AND {g('down + 1')} <= prob THEN down + 1 ELSE down END AS k FROM {p}b1),
    {p}perk AS (SELECT {k}, k, sum(pos) AS pos_k, sum(1 - pos) AS neg_k, sum(half * pos) AS hp_k,
                       sum(half * (1 - pos)) AS hn_k FROM {p}b2 GROUP BY ALL),
    {p}grid AS (SELECT {k}, unnest(range(-1, {GRID_POINTS})) AS k FROM (SELECT DISTINCT {k} FROM {p}perk)),
    {p}fill AS (SELECT {k}, k, coalesce(pos_k, 0) AS pos_k, coalesce(neg_k, 0) AS neg_k,
                       coalesce(hp_k, 0) AS hp_k, coalesce(hn_k, 0) AS hn_k
                FROM {p}grid LEFT JOIN {p}perk USING ({k}, k)),
    {p}suf AS (SELECT {k}, k,
        CAST(sum(pos_k) OVER (PARTITION BY {k} ORDER BY k DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS tp,
        CAST(sum(neg_k) OVER (PARTITION BY {k} ORDER BY k DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS fp,
        CAST(sum(pos_k) OVER (PARTITION BY {k}) AS BIGINT) AS p, CAST(sum(neg_k) OVER (PARTITION BY {k}) AS BIGINT) AS n,
        CAST(sum(hp_k) OVER (PARTITION BY {k}) AS BIGINT) AS tp_half, CAST(sum(hn_k) OVER (PARTITION BY {k}) AS BIGINT) AS fp_half
        FROM {p}fill),
    {p}both AS (SELECT {k}, {g('k')} AS threshold, false AS is_default, tp, fp, p, n FROM {p}suf WHERE k >= 0
                UNION ALL SELECT {k}, 0.5::DOUBLE, true, tp_half, fp_half, p, n FROM {p}suf WHERE k = -1),
    {p}m0 AS (SELECT *, p - tp AS fn, n - fp AS tn FROM {p}both),
    {p}m1 AS (SELECT *,
        CASE WHEN 2 * tp + fp + fn > 0 THEN (2 * tp)::DOUBLE / (2 * tp + fp + fn) ELSE 0.0 END AS f1_1,
        CASE WHEN 2 * tn + fn + fp > 0 THEN (2 * tn)::DOUBLE / (2 * tn + fn + fp) ELSE 0.0 END AS f1_0,
        (p > 0 OR tp + fp > 0) AS has1, (n > 0 OR tn + fn > 0) AS has0 FROM {p}m0),
    {p}sw AS (SELECT {k}, threshold, is_default, tp, fp, fn, tn, (tp + tn)::DOUBLE / (p + n) AS accuracy,
        CASE WHEN has0 AND has1 THEN (f1_0 + f1_1) / 2.0::DOUBLE WHEN has1 THEN f1_1 ELSE f1_0 END AS macro_f1 FROM {p}m1)"""


def best_sql(sw: str, keys: list[str]) -> str:
    k = ", ".join(keys)
    return f"""SELECT {k}, threshold, macro_f1, accuracy FROM (SELECT *, row_number() OVER (PARTITION BY {k}
        ORDER BY macro_f1 DESC, is_default DESC, threshold ASC) AS rn FROM {sw}) WHERE rn = 1"""


def folds_sql(src: str, p: str = "f_") -> str:
    return f"""
    {p}r AS (SELECT doc_id, label, {S.hash32("'42:fold:' || CAST(doc_id AS VARCHAR)")} % {va.N_BUCKETS} AS bucket FROM {src}),
    {p}c AS (SELECT label, bucket, count(*) AS cnt FROM {p}r GROUP BY label, bucket),
    {p}s AS (SELECT label, bucket, coalesce(sum(cnt) OVER (PARTITION BY label ORDER BY bucket
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM {p}c),
    {p}k AS (SELECT doc_id, label, bucket, row_number() OVER (PARTITION BY label, bucket ORDER BY doc_id) AS rn FROM {p}r),
    {p}folds AS (SELECT {p}k.doc_id, {p}k.label, CAST(({p}s.start + {p}k.rn - 1) % 5 AS INTEGER) AS fold
              FROM {p}k JOIN {p}s ON {p}k.label = {p}s.label AND {p}k.bucket = {p}s.bucket)"""


BASE = f"WITH ld AS ({LABELLED_SQL}), {predictions_sql()}, {metric_ctes('pred', KEYS, 'a_')}, et AS ({exp_table_sql('a_mb')})"
MEMBERS = "mem AS (SELECT experiment, val_macro_f1 FROM et ORDER BY val_macro_f1 DESC, experiment ASC LIMIT 3)"
CV = f"""trn AS (SELECT * FROM ld WHERE split = 'train'), {folds_sql('trn')},
    fp AS (SELECT pred.experiment, f_folds.fold, pred.label, pred.prediction FROM pred JOIN f_folds USING (doc_id)
           WHERE pred.split = 'train'),
    {metric_ctes('fp', ['experiment', 'fold'], 'cv_')},
    cvs AS (SELECT experiment, avg(macro_f1) AS cv_mean, stddev_pop(macro_f1) AS cv_std, count(*) AS n_folds
            FROM cv_mb GROUP BY experiment)"""
V2 = "v2 AS (SELECT et.*, cv_mean, cv_std, val_macro_f1 - test_macro_f1 AS gap FROM et LEFT JOIN cvs USING (experiment))"
VOTE = """vote AS (SELECT doc_id, split, label, CAST(avg(prediction) >= 0.5::DOUBLE AS INTEGER) AS prediction,
                   count(*) AS n_members FROM pred JOIN mem USING (experiment) GROUP BY doc_id, split, label)"""
TUNED = f"""vpred AS (SELECT * FROM pred WHERE split = 'validation'), {sweep_ctes('vpred', ['experiment'], 't_')},
    chosen AS ({best_sql('t_sw', ['experiment'])}),
    app AS (SELECT pred.experiment, chosen.threshold, pred.split, pred.label,
                   CAST(pred.prob >= chosen.threshold AS INTEGER) AS prediction
            FROM pred JOIN chosen USING (experiment) WHERE pred.split IN ('validation', 'test')),
    {metric_ctes('app', ['experiment', 'threshold', 'split'], 'h_')},
    tuned AS (SELECT experiment, threshold,
        max(CASE WHEN split = 'validation' THEN accuracy END) AS val_accuracy,
        max(CASE WHEN split = 'validation' THEN macro_f1 END) AS val_macro_f1,
        max(CASE WHEN split = 'test' THEN accuracy END) AS test_accuracy,
        max(CASE WHEN split = 'test' THEN macro_f1 END) AS test_macro_f1 FROM h_mb GROUP BY experiment, threshold)"""
SUMMARY_R = ", ".join(f"round({c}, {R}) AS {c}" for c in rp.SUMMARY_COLS)
V2_ORDER = ("ORDER BY val_macro_f1 DESC NULLS LAST, cv_mean DESC NULLS LAST, "
            "test_macro_f1 DESC NULLS LAST, experiment ASC")
LOGITS = f"""lg AS (SELECT doc_id, [{S.hash_uniform("'l0:' || CAST(doc_id AS VARCHAR)")} * 4.0::DOUBLE - 2.0::DOUBLE,
                     {S.hash_uniform("'l1:' || CAST(doc_id AS VARCHAR)")} * 4.0::DOUBLE - 2.0::DOUBLE] AS logits FROM documents)"""


def coef_sql(where: str = "") -> str:
    """CTEs up to ``coef``, the weights of the labelled documents that ``where`` keeps."""
    return f"""
WITH ld AS ({LABELLED_SQL}),
nd AS (SELECT doc_id, label, {S.normalize('text')} AS text FROM ld{where}),
counts AS (SELECT doc_id, term, count(*) AS tf FROM ({S.word_ngram_rows('nd', 'text', 1, 2)}) GROUP BY doc_id, term),
stats AS (SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS cf FROM counts GROUP BY term HAVING count(*) >= 2),
top AS (SELECT * FROM stats ORDER BY cf DESC, term ASC LIMIT 8000),
vocab AS (SELECT term, CAST(row_number() OVER (ORDER BY term) - 1 AS INTEGER) AS idx FROM top),
tot AS (SELECT count(*) AS n_docs, sum(label) AS n_pos FROM nd),
per AS (SELECT term, idx, sum(label) AS p, sum(1 - label) AS n FROM counts JOIN vocab USING (term)
        JOIN nd USING (doc_id) GROUP BY term, idx),
coef AS (SELECT term AS feature, idx, ln(((p + 1.0::DOUBLE) * CAST(tot.n_docs - tot.n_pos + 2 AS DOUBLE))
                / ((n + 1.0::DOUBLE) * CAST(tot.n_pos + 2 AS DOUBLE))) AS weight FROM per, tot)"""


COEF = coef_sql(" WHERE split = 'train'")

ORACLE = {
    "confusion_matrix": f"{BASE} SELECT experiment, split, true_label, pred_label, n FROM a_cells",
    "classification_report": f"""{BASE},
        tot AS (SELECT experiment, split, CAST(sum(support) AS DOUBLE) AS n, sum(tp) AS correct,
                       avg(precision) AS mp, avg(recall) AS mr, avg(f1) AS mf,
                       sum(precision * support) AS wp, sum(recall * support) AS wr, sum(f1 * support) AS wf
                FROM a_pc GROUP BY ALL)
        SELECT experiment, split, CAST(cls AS VARCHAR) AS class_name, round(precision, {R}) AS precision,
               round(recall, {R}) AS recall, round(f1, {R}) AS f1, CAST(support AS DOUBLE) AS support FROM a_pc
        UNION ALL SELECT experiment, split, 'accuracy', NULL, NULL, round(correct / n, {R}), n FROM tot
        UNION ALL SELECT experiment, split, 'macro avg', round(mp, {R}), round(mr, {R}), round(mf, {R}), n FROM tot
        UNION ALL SELECT experiment, split, 'weighted avg', round(wp / n, {R}), round(wr / n, {R}), round(wf / n, {R}), n FROM tot""",
    "metric_bundle": f"""{BASE} SELECT experiment, split, round(accuracy, {R}) AS accuracy, round(macro_f1, {R}) AS macro_f1,
        round(weighted_f1, {R}) AS weighted_f1, round(macro_precision, {R}) AS macro_precision,
        round(macro_recall, {R}) AS macro_recall, n, confusion_matrix FROM a_mb""",
    "threshold_sweep": f"""{BASE}, {sweep_ctes('pred', KEYS, 's_')}
        SELECT experiment, split, round(threshold, {R}) AS threshold, is_default, tp, fp, fn, tn,
               round(accuracy, {R}) AS accuracy, round(macro_f1, {R}) AS macro_f1 FROM s_sw""",
    "best_threshold": f"""{BASE}, {sweep_ctes('pred', KEYS, 's_')}, bt AS ({best_sql('s_sw', KEYS)})
        SELECT experiment, split, round(threshold, {R}) AS threshold, round(macro_f1, {R}) AS macro_f1,
               round(accuracy, {R}) AS accuracy FROM bt""",
    "thresholded_metrics": f"""{BASE}, {TUNED} SELECT experiment, round(threshold, {R}) AS threshold, {SUMMARY_R} FROM tuned""",
    "softmax_prob": f"""WITH {LOGITS},
        sm AS (SELECT doc_id, list_transform(logits, lambda x: exp(x - list_max(logits))) AS ex FROM lg)
        SELECT doc_id, round(ex[2] / (ex[1] + ex[2]), {R}) AS prob_hate FROM sm""",
    "argmax_class": f"""WITH {LOGITS}
        SELECT doc_id, CAST(list_position(logits, list_max(logits)) - 1 AS INTEGER) AS prediction FROM lg""",
    "majority_vote": f"{BASE}, {MEMBERS}, {VOTE} SELECT * FROM vote",
    "soft_vote": f"""{BASE}, {MEMBERS}, w AS (SELECT experiment, val_macro_f1 / sum(val_macro_f1) OVER () AS weight FROM mem),
        sv AS (SELECT doc_id, split, label, sum(weight * prob) / sum(weight) AS prob FROM pred JOIN w USING (experiment)
               GROUP BY doc_id, split, label)
        SELECT doc_id, split, label, round(prob, {R}) AS prob, CAST(prob >= 0.5::DOUBLE AS INTEGER) AS prediction FROM sv""",
    "weighted_vote": f"""{BASE}, {MEMBERS}, wv AS (SELECT doc_id, split, label, sum(1.0::DOUBLE * prediction) AS vote
        FROM pred JOIN mem USING (experiment) GROUP BY doc_id, split, label)
        SELECT doc_id, split, label, vote, CAST(vote >= 0.5::DOUBLE AS INTEGER) AS prediction FROM wv""",
    "leaderboard": f"""{BASE} SELECT experiment, {SUMMARY_R},
        CAST(row_number() OVER (ORDER BY val_macro_f1 DESC, experiment ASC) AS INTEGER) AS rank FROM et""",
    "leaderboard_v2": f"""{BASE}, {CV}, {V2} SELECT experiment, {SUMMARY_R}, round(cv_mean, {R}) AS cv_mean,
        round(cv_std, {R}) AS cv_std, round(gap, {R}) AS gap, CAST(row_number() OVER ({V2_ORDER}) AS INTEGER) AS rank FROM v2""",
    "leaderboard_gap": f"""{BASE} SELECT experiment, round(val_macro_f1, {R}) AS val_macro_f1,
        round(test_macro_f1, {R}) AS test_macro_f1, round(val_macro_f1 - test_macro_f1, {R}) AS gap FROM et""",
    "leaderboard_with_ensemble": f"""{BASE}, {CV}, {V2}, {MEMBERS}, {VOTE},
        ve AS (SELECT 'voting_ensemble' AS experiment, split, label, prediction FROM vote),
        {metric_ctes('ve', KEYS, 'e_')}, ee AS ({exp_table_sql('e_mb')}),
        allr AS (SELECT experiment, val_accuracy, val_macro_f1, test_accuracy, test_macro_f1, cv_mean, cv_std, gap FROM v2
                 UNION ALL SELECT experiment, val_accuracy, val_macro_f1, test_accuracy, test_macro_f1, NULL, NULL,
                 val_macro_f1 - test_macro_f1 FROM ee)
        SELECT experiment, {SUMMARY_R}, round(cv_mean, {R}) AS cv_mean, round(cv_std, {R}) AS cv_std,
               round(gap, {R}) AS gap, CAST(row_number() OVER ({V2_ORDER}) AS INTEGER) AS rank FROM allr""",
    "v2_summary": f"""{BASE}, {CV}, {V2}, {MEMBERS}, {VOTE},
        ve AS (SELECT 'voting_ensemble' AS experiment, split, label, prediction FROM vote),
        {metric_ctes('ve', KEYS, 'e_')}, ee AS ({exp_table_sql('e_mb')}),
        allr AS (SELECT experiment, val_macro_f1, test_macro_f1, cv_mean FROM v2
                 UNION ALL SELECT experiment, val_macro_f1, test_macro_f1, NULL FROM ee),
        lb AS (SELECT *, val_macro_f1 - test_macro_f1 AS gap, row_number() OVER ({V2_ORDER}) AS rank FROM allr),
        b AS (SELECT * FROM lb WHERE rank = 1),
        bt AS (SELECT * FROM lb ORDER BY test_macro_f1 DESC, experiment ASC LIMIT 1),
        o AS (SELECT experiment, test_macro_f1, val_macro_f1 - test_macro_f1 AS gap FROM et
              ORDER BY val_macro_f1 DESC, test_macro_f1 DESC, experiment ASC LIMIT 1)
        SELECT b.experiment AS best_model, round(b.val_macro_f1, {R}) AS best_val_f1,
               round(b.test_macro_f1, {R}) AS corresponding_test_f1, round(b.gap, {R}) AS gap,
               'val_macro_f1' AS selection_metric, bt.experiment AS best_test_model,
               round(bt.test_macro_f1, {R}) AS best_test_f1, round(bt.val_macro_f1, {R}) AS best_test_model_val_f1,
               round(bt.gap, {R}) AS best_test_model_gap, o.experiment AS original_best_model,
               round(o.test_macro_f1, {R}) AS original_test_f1, round(o.gap, {R}) AS original_gap,
               round(b.test_macro_f1 - o.test_macro_f1, {R}) AS improvement_over_original,
               round(o.gap - b.gap, {R}) AS gap_reduction
        FROM b, bt, o""",
    "best_model_summary": f"""{BASE}, lb AS (SELECT *, row_number() OVER (ORDER BY val_macro_f1 DESC, experiment ASC) AS rank FROM et)
        SELECT arg_min(experiment, rank) AS best_validation_model,
               round(arg_min(val_macro_f1, rank), {R}) AS best_validation_macro_f1,
               round(arg_min(test_macro_f1, rank), {R}) AS corresponding_test_macro_f1,
               round(max(val_macro_f1 - test_macro_f1), {R}) AS largest_drop_val_to_test_macro_f1 FROM lb""",
    "baseline_compare": f"""{BASE}, {TUNED},
        o AS (SELECT experiment, val_macro_f1, test_macro_f1 FROM et ORDER BY val_macro_f1 DESC, test_macro_f1 DESC, experiment LIMIT 1),
        i AS (SELECT experiment || '_tuned' AS experiment, val_macro_f1, test_macro_f1 FROM tuned
              ORDER BY val_macro_f1 DESC, test_macro_f1 DESC, experiment LIMIT 1)
        SELECT o.experiment AS best_original_model, round(o.val_macro_f1, {R}) AS best_original_val_f1,
               round(o.test_macro_f1, {R}) AS best_original_test_f1, i.experiment AS best_improved_model,
               round(i.val_macro_f1, {R}) AS best_improved_val_f1, round(i.test_macro_f1, {R}) AS best_improved_test_f1,
               round(i.test_macro_f1 - o.test_macro_f1, {R}) AS test_improvement,
               round((o.val_macro_f1 - o.test_macro_f1) - (i.val_macro_f1 - i.test_macro_f1), {R}) AS gap_reduction
        FROM o, i""",
    "error_examples": f"""{BASE}, best AS (SELECT experiment FROM et ORDER BY val_macro_f1 DESC, experiment ASC LIMIT 1),
        err AS (SELECT pred.doc_id, pred.label, pred.prediction,
                       CASE WHEN pred.label = 0 AND pred.prediction = 1 THEN 'false_positive'
                            WHEN pred.label = 1 AND pred.prediction = 0 THEN 'false_negative' END AS error_type
                FROM pred JOIN best USING (experiment) WHERE pred.split = 'test' AND pred.label <> pred.prediction),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY error_type ORDER BY doc_id) AS rn FROM err
                   WHERE error_type IS NOT NULL)
        SELECT error_type, ranked.doc_id, {S.sanitize('ld.text', MASKS)} AS sanitized_text, ranked.label, prediction, rn
        FROM ranked JOIN ld ON ranked.doc_id = ld.doc_id WHERE rn <= 8""",
    "metric_long": f"""{BASE} SELECT experiment, 'validation' AS split, round(val_macro_f1, {R}) AS macro_f1 FROM et
        UNION ALL SELECT experiment, 'test', round(test_macro_f1, {R}) FROM et""",
    "cv_summary": f"""{BASE}, {CV} SELECT experiment, round(cv_mean, {R}) AS cv_mean, round(cv_std, {R}) AS cv_std,
        CAST(n_folds AS INTEGER) AS n_folds FROM cvs""",
    "top_features": f"""{COEF}
        (SELECT feature, round(weight, {R}) AS weight, 'hate' AS class FROM coef ORDER BY weight DESC, feature ASC LIMIT 15)
        UNION ALL
        (SELECT feature, round(weight, {R}) AS weight, 'non_hate' AS class FROM coef ORDER BY weight ASC, feature ASC LIMIT 15)""",
    "top_abs_features": f"""{coef_sql()} SELECT feature, round(weight, {R}) AS weight, round(abs(weight), {R}) AS abs_weight
        FROM coef ORDER BY abs(weight) DESC, feature ASC LIMIT 12""",
    "feature_select": f"""{COEF}, med AS (SELECT quantile_cont(abs(weight), 0.5) AS m FROM coef)
        SELECT feature, idx, CAST(row_number() OVER (ORDER BY idx) - 1 AS INTEGER) AS new_idx, round(weight, {R}) AS weight
        FROM coef, med WHERE abs(weight) >= med.m""",
}
