"""Registered queries around real model fits (rows-only checks: MLlib fits
are not SQL-expressible), train-only features and linear scoring, the
batch-scoring operator."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import preprocess_auto
from tessera.operators import evaluate as ev
from tessera.operators import features as fe
from tessera.operators import models as mo
from tessera.operators import report as rp
from tessera.plans import eval_queries as eq
from tessera.plans import experiments as ex
from tessera.plans import sqlbits as S
from tessera.plans import text_queries as tq
from tessera.plans.scorers import full_stop_model
from tessera.sources.corpus import all_docs, labelled_docs

R = 6
KEYS = ["experiment", "split"]


def _norm(spark, sf_dir) -> DataFrame:
    return ex.normalized_corpus(labelled_docs(spark, sf_dir))


def _fit_query(spark, sf_dir, vec, spec):
    fs = mo.build_features(_norm(spark, sf_dir), (vec,))
    _, scored = mo.train_and_score(fs, spec)
    return scored


def flagship(spark, sf_dir) -> DataFrame:
    """Word TF-IDF (fit on train) -> L2 LR with penalised intercept ->
    metric bundle per split."""
    scored = _fit_query(spark, sf_dir, fe.WORD_1_2, mo.ModelSpec("lr", 4.0, max_iter=800))
    return ev.metric_bundle(scored.withColumn("experiment", F.lit("word_lr")), KEYS)


def q_train_lr(spark, sf_dir):
    return _fit_query(spark, sf_dir, fe.WORD_1_2, mo.ModelSpec("lr", 4.0, max_iter=800))


def q_train_lr_free_intercept(spark, sf_dir):
    return _fit_query(spark, sf_dir, fe.WORD_1_3, mo.ModelSpec("lr", 0.1, intercept="free"))


def q_train_lr_l1(spark, sf_dir):
    return _fit_query(spark, sf_dir, fe.WORD_1_2_MIN3, mo.ModelSpec("lr", 0.5, penalty="l1"))


def q_train_lr_balanced(spark, sf_dir):
    return _fit_query(spark, sf_dir, fe.WORD_1_3, mo.ModelSpec("lr", 1.0, balanced=True))


def q_train_svc(spark, sf_dir):
    return _fit_query(spark, sf_dir, fe.WORD_1_2, mo.ModelSpec("svc", 1.0))


def q_predictions(spark, sf_dir):
    """Prediction table of the word LR: text, label, prob_hate, prediction."""
    corpus = labelled_docs(spark, sf_dir)
    scored = _fit_query(spark, sf_dir, fe.WORD_1_2, mo.ModelSpec("lr", 4.0, max_iter=800))
    return (scored.join(corpus.select("doc_id", "text"), "doc_id")
            .select("doc_id", "split", "text", "label", F.col("prob").alias("prob_hate"), "prediction"))


def q_experiment_summary(spark, sf_dir):
    res = ex.run_grid(_norm(spark, sf_dir), ex.BASE)
    return rp.leaderboard(res.table)


def q_ensemble_summary(spark, sf_dir):
    """Base grid plus the top-3 soft-vote ensemble, ranked (v2 order)."""
    res = ex.run_grid(_norm(spark, sf_dir), ex.BASE)
    return rp.leaderboard_v2(rp.with_gap(ex.with_ensemble(res, "soft")))


def _one_experiment(spark, sf_dir, exp):
    res = ex.run_grid(_norm(spark, sf_dir), [exp])
    return rp.with_gap(res.table).withColumn("n_features", F.lit(res.features[exp.name].size))


def q_selected_svc_cv(spark, sf_dir):
    """Median feature selection (LR C=0.5 selector) + LinearSVC C=0.1 with
    stratified 5-fold CV: the improved grid's word_svc_strong_reg."""
    return _one_experiment(spark, sf_dir, ex.IMPROVED[1])


def q_balanced_lr_cv(spark, sf_dir):
    """Class-balanced LR C=1 on word 1-3 grams with stratified 5-fold CV:
    the v2 grid's word_lr_balanced."""
    return _one_experiment(spark, sf_dir, ex.V2[0])


def q_preprocessing_ablation(spark, sf_dir):
    """Word LR (C=4) on raw vs normalized text."""
    corpus = labelled_docs(spark, sf_dir)
    exp = ex.Experiment("word_lr", (fe.WORD_1_2,), mo.ModelSpec("lr", 4.0, max_iter=800))
    rows = []
    for variant, c in (("raw", corpus), ("normalized", ex.normalized_corpus(corpus))):
        t = ex.run_grid(c, [exp]).table
        rows.append(t.select(F.lit(variant).alias("variant"), *rp.SUMMARY_COLS))
    return rows[0].unionByName(rows[1])


def _train_features(spark, sf_dir, *specs):
    return mo.build_features(_norm(spark, sf_dir), specs)


def _train_tfidf(spark, sf_dir, *specs):
    long = _train_features(spark, sf_dir, *specs).long
    return long.select("doc_id", "idx", F.round("value", R).alias("value"))


def q_tfidf_word_train(spark, sf_dir):
    """TF-IDF of the labelled corpus, vocabulary and idf from train rows only."""
    return _train_tfidf(spark, sf_dir, fe.WORD_1_2)


def q_tfidf_char_train(spark, sf_dir):
    return _train_tfidf(spark, sf_dir, fe.CHAR_3_5)


def q_combined_train(spark, sf_dir):
    return _train_tfidf(spark, sf_dir, tq.COMBINED_WORD, tq.COMBINED_CHAR)


INTERCEPT = -0.25


def q_linear_scores(spark, sf_dir):
    """Scores of every labelled document under log-odds weights of the train rows."""
    fs = _train_features(spark, sf_dir, fe.WORD_1_2)
    out = mo.weighted_scores(fs, mo.log_odds_weights(fs), INTERCEPT)
    return out.select("doc_id", "split", "label", F.round("score", R).alias("score"),
                      F.round("prob", R).alias("prob"), "prediction")


def _batch(docs):
    pre = docs.withColumn("text", preprocess_auto("text", tq.HUB_MODEL))
    return mo.batch_score(pre, full_stop_model, batch_size=64)


def q_batch_score(spark, sf_dir):
    """The batch model over all documents, labelled or not."""
    out = _batch(all_docs(spark, sf_dir))
    return out.select("doc_id", F.round("prob", R).alias("prob"), "prediction")


def q_batch_score_tuned(spark, sf_dir):
    """Batch model end to end: score, choose the threshold on validation,
    report both splits."""
    pred = _batch(labelled_docs(spark, sf_dir)).withColumn("experiment", F.lit("batch"))
    t = ev.thresholded_metrics(pred.select("experiment", "split", "label", "prob"))
    return t.select("experiment", *[F.round(c, R).alias(c) for c in ("threshold", *rp.SUMMARY_COLS)])


def q_callback_metrics(spark, sf_dir):
    """Accuracy and macro-F1 of the batch model's argmax over its logits, by split."""
    pred = _batch(labelled_docs(spark, sf_dir))
    return ev.metric_bundle(pred, ["split"]).select("split", F.round("accuracy", R).alias("accuracy"),
                                                    F.round("macro_f1", R).alias("macro_f1"), "n")


QUERIES = {
    "train_lr": q_train_lr,
    "train_lr_free_intercept": q_train_lr_free_intercept,
    "train_lr_l1": q_train_lr_l1,
    "train_lr_balanced": q_train_lr_balanced,
    "train_svc": q_train_svc,
    "predictions": q_predictions,
    "experiment_summary": q_experiment_summary,
    "ensemble_summary": q_ensemble_summary,
    "selected_svc_cv": q_selected_svc_cv,
    "balanced_lr_cv": q_balanced_lr_cv,
    "preprocessing_ablation": q_preprocessing_ablation,
    "tfidf_word_train": q_tfidf_word_train,
    "tfidf_char_train": q_tfidf_char_train,
    "combined_train": q_combined_train,
    "linear_scores": q_linear_scores,
    "batch_score": q_batch_score,
    "batch_score_tuned": q_batch_score_tuned,
    "callback_metrics": q_callback_metrics,
}
# ------------------------------------------------------------ oracle SQL ---
LD = f"ld AS ({tq.LABELLED_SQL})"
TRAIN = f"""{LD}, nd AS (SELECT doc_id, label, split, {S.normalize('text')} AS text FROM ld),
    trn AS (SELECT doc_id FROM nd WHERE split = 'train')"""


def _train_sql(spec, p: str = "") -> str:
    return tq.tfidf_sql_ctes(spec, p, fit_on="trn")


def _batch_sql(src: str, extra: str = "") -> str:
    """(doc_id, prob, prediction, extra) of the batch model over ``src``."""
    return f"""SELECT doc_id{extra}, {S.sigmoid('z')} AS prob, CAST(z > 0 AS INTEGER) AS prediction FROM (
        SELECT doc_id{extra}, (length(t) - length(replace(t, '.', ''))) * 100.0::DOUBLE / greatest(length(t), 1)
               - 1.5::DOUBLE AS z FROM (SELECT doc_id{extra}, {S.mentions_links('text')} AS t FROM {src}))"""


ORACLE = {
    "tfidf_word_train": f"WITH {TRAIN}, {_train_sql(fe.WORD_1_2)} SELECT doc_id, idx, round(value, {R}) AS value FROM tfidf",
    "tfidf_char_train": f"WITH {TRAIN}, {_train_sql(fe.CHAR_3_5)} SELECT doc_id, idx, round(value, {R}) AS value FROM tfidf",
    "combined_train": f"""WITH {TRAIN}, {_train_sql(tq.COMBINED_WORD, 'w_')}, {_train_sql(tq.COMBINED_CHAR, 'c_')}
        SELECT doc_id, idx, round(value, {R}) AS value FROM w_tfidf UNION ALL
        SELECT doc_id, CAST(idx + (SELECT count(*) FROM w_vocab) AS INTEGER) AS idx, round(value, {R}) AS value FROM c_tfidf""",
    "linear_scores": f"""WITH {TRAIN}, {_train_sql(fe.WORD_1_2)},
        tot AS (SELECT count(*) AS n_docs, sum(label) AS n_pos FROM nd WHERE split = 'train'),
        per AS (SELECT idx, sum(label) AS p, sum(1 - label) AS n FROM tfidf JOIN nd USING (doc_id)
                WHERE split = 'train' GROUP BY idx),
        wt AS (SELECT idx, ln(((p + 1.0::DOUBLE) * CAST(n_docs - n_pos + 2 AS DOUBLE))
                              / ((n + 1.0::DOUBLE) * CAST(n_pos + 2 AS DOUBLE))) AS weight FROM per, tot),
        dots AS (SELECT doc_id, sum(value * weight) AS dot FROM tfidf JOIN wt USING (idx) GROUP BY doc_id),
        sc AS (SELECT nd.doc_id, split, label, coalesce(dot, 0.0::DOUBLE) + ({INTERCEPT}::DOUBLE) AS score
               FROM nd LEFT JOIN dots USING (doc_id))
        SELECT doc_id, split, label, round(score, {R}) AS score, round({S.sigmoid('score')}, {R}) AS prob,
               CAST(score > 0 AS INTEGER) AS prediction FROM sc""",
    "batch_score": f"""SELECT doc_id, round(prob, {R}) AS prob, prediction
        FROM ({_batch_sql("(SELECT doc_id, coalesce(text, '') AS text FROM documents)")})""",
    "batch_score_tuned": f"""WITH {LD}, pred AS (SELECT 'batch' AS experiment, * FROM ({_batch_sql('ld', ', split, label')})),
        {eq.TUNED} SELECT experiment, round(threshold, {R}) AS threshold, {eq.SUMMARY_R} FROM tuned""",
    "callback_metrics": f"""WITH {LD}, pred AS ({_batch_sql('ld', ', split, label')}), {eq.metric_ctes('pred', ['split'], 'c_')}
        SELECT split, round(accuracy, {R}) AS accuracy, round(macro_f1, {R}) AS macro_f1, n FROM c_mb""",
}
