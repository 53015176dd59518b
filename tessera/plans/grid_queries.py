"""Registered queries around many models at once: vectorizer sweep, both forms of
cross-validation, cube scores, the full experiment grids, their ensembles and the
coefficient tables of fitted models.

Vocabularies, folds and cube scores are checked against SQL under log-odds
weights, which SQL can state; MLlib fits are rows-only.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import evaluate as ev
from tessera.operators import features as fe
from tessera.operators import report as rp
from tessera.operators import validate as va
from tessera.operators import vocab as vo
from tessera.operators.cube import cube_scores, weight_cube
from tessera.plans import eval_queries as eq
from tessera.plans import experiments as ex
from tessera.plans import sqlbits as S
from tessera.plans import text_queries as tq
from tessera.session import stored
from tessera.sources.corpus import labelled_docs

R = 6
K = 5
SLOTS = [-1, *range(K)]
INTERCEPT = -0.25
SWEEP = tuple(dict.fromkeys(v for e in (*ex.BASE, *ex.ORIGINAL, *ex.IMPROVED, *ex.V2) for v in e.vectorizers))
COMBINED = (tq.COMBINED_WORD, tq.COMBINED_CHAR)


def _norm(spark, sf_dir) -> DataFrame:
    return ex.normalized_corpus(labelled_docs(spark, sf_dir))


def _folded_train(corpus: DataFrame) -> DataFrame:
    train = corpus.where(F.col("split") == "train")
    return train.join(va.stratified_folds(train, k=K).select("doc_id", "fold"), "doc_id")


def q_vocab_sweep(spark, sf_dir):
    """Every vocabulary of all experiment grids, fitted on train in one pass for
    words and one for characters."""
    train = _norm(spark, sf_dir).where(F.col("split") == "train")
    names = F.array(*[F.lit(vo.variant_name(s)) for s in SWEEP])
    out = vo.fit_vocabs(train, SWEEP)
    return out.select(F.get(names, F.col("variant")).alias("variant"), "term", "idx", "df", "cf", F.round("idf", R).alias("idf"))


def q_vocab_uncapped(spark, sf_dir):
    """All word n-grams of train, no cap: dense index without a single-task window."""
    train = _norm(spark, sf_dir).where(F.col("split") == "train")
    spec = fe.VectorizerSpec("word", 1, 2, 1, None)
    v = fe.fit_vocab(fe.term_counts(train, spec), train.count(), spec)
    return v.select("term", "idx", "df", "cf", F.round("idf", R).alias("idf"))


def q_cv_refit_vocab(spark, sf_dir):
    """Word vocabularies of both forms of cross-validation: the shared one of the
    whole train split (fold -1), and one for each fold, fitted without it."""
    v = vo.fit_vocabs(_folded_train(_norm(spark, sf_dir)), [fe.WORD_1_2], K, refit=True)
    return v.select(F.when(F.col("slot") < 0, "shared").otherwise("refit").alias("form"), F.col("slot").alias("fold"),
                    "term", "idx", F.round("idf", R).alias("idf"))


def _log_odds_scores(spark, sf_dir, models: dict, refit: bool) -> DataFrame:
    """Cube scores of log-odds models, all slots: {name: vectorizers}."""
    corpus = _norm(spark, sf_dir)
    train = _folded_train(corpus)
    specs = list(dict.fromkeys(v for vs in models.values() for v in vs))
    blocks = [(name, specs.index(v)) for name, vs in models.items() for v in vs]
    vocabs = stored(vo.fit_vocabs(train, specs, K, refit), "vocabs")
    odds = vo.log_odds(train, vocabs, specs, K)
    numbered = F.explode(F.array(*[F.struct(F.lit(b).alias("block"), F.lit(v).alias("v")) for b, (_, v) in enumerate(blocks)]))
    weights = (odds.withColumn("b", numbered).where(F.col("b.v") == F.col("variant"))
               .select("b.block", "slot", "term", "weight"))
    docs = corpus.join(train.select("doc_id", "fold"), "doc_id", "left").withColumn(
        "slots", F.array_compact(F.array(F.lit(-1), F.col("fold"))))
    intercepts = {(name, s): INTERCEPT for name in models for s in SLOTS}
    return cube_scores(docs, weight_cube(vocabs, weights, specs, blocks, SLOTS), specs, blocks, SLOTS, intercepts)


def q_cube_scores(spark, sf_dir):
    """Every document under a word and a combined model, and every training
    document also under the models fitted without its fold, in one pass."""
    out = _log_odds_scores(spark, sf_dir, {"word": (fe.WORD_1_2,), "combined": COMBINED}, refit=False)
    return out.select("experiment", "slot", "doc_id", "split", "label", F.round("score", R).alias("score"),
                      F.round("prob", R).alias("prob"), "prediction")


def q_cv_forms(spark, sf_dir):
    """Macro-F1 of every fold with shared and with refitted vocabularies."""
    out = None
    for form, refit in (("shared", False), ("refit", True)):
        held = _log_odds_scores(spark, sf_dir, {"word": (fe.WORD_1_2,)}, refit).where("slot >= 0")
        part = held.select(F.lit(form).alias("form"), F.col("slot").alias("fold"), "label", "prediction")
        out = part if out is None else out.unionByName(part)
    return ev.metric_bundle(out, ["form", "fold"]).select("form", "fold", F.round("macro_f1", R).alias("macro_f1"), "n")


def _grid(spark, sf_dir, experiments, **options) -> ex.GridResult:
    return ex.run_grid(_norm(spark, sf_dir), experiments, **options)


def _sizes(res: ex.GridResult) -> DataFrame:
    """The ranked result table with each model's number of columns."""
    n = F.create_map(*[x for name, f in res.features.items() for x in (F.lit(name), F.lit(f.size))])
    return rp.leaderboard_v2(rp.with_gap(res.table)).withColumn("n_features", n[F.col("experiment")])


def q_grid_original(spark, sf_dir):
    """The original grid, ranked."""
    return _sizes(_grid(spark, sf_dir, ex.ORIGINAL))


def q_grid_improved(spark, sf_dir):
    """The improved grid (selection, L1, combined blocks, 5-fold CV), ranked."""
    return _sizes(_grid(spark, sf_dir, ex.IMPROVED))


def q_grid_v2(spark, sf_dir):
    """The second grid (class weights, wider n-grams, 5-fold CV), ranked."""
    return _sizes(_grid(spark, sf_dir, ex.V2))


def q_grid_refit_per_fold(spark, sf_dir):
    """Two experiments of the improved grid with vocabularies and selectors
    fitted anew for every fold."""
    return _sizes(_grid(spark, sf_dir, (ex.IMPROVED[0], ex.IMPROVED[4]), refit_per_fold=True))


def _without_cv(experiments):
    # members are chosen by validation macro-F1, which cross-validation does not touch
    return [replace(e, cv=False) for e in experiments]


def q_ensemble_improved(spark, sf_dir):
    """Soft vote of the improved grid's three best, members beside each vote."""
    return ex.ensemble_votes(_grid(spark, sf_dir, _without_cv(ex.IMPROVED)), "soft")


def q_ensemble_v2(spark, sf_dir):
    """Majority vote of the second grid's three best, members beside each vote."""
    return ex.ensemble_votes(_grid(spark, sf_dir, _without_cv(ex.V2)), "majority")


def q_fitted_coefficients(spark, sf_dir):
    """Coefficient table of the fitted word logistic regression."""
    return _grid(spark, sf_dir, ex.BASE[:1]).coefficients


def q_fitted_top_features(spark, sf_dir):
    """Largest and smallest weights of the fitted word logistic regression (15
    each), and its 12 largest by size."""
    coef = _grid(spark, sf_dir, ex.BASE[:1]).coefficients
    top = rp.top_features(coef).select("class", "feature", "weight")
    return top.unionByName(rp.top_abs_features(coef).select(F.lit("largest").alias("class"), "feature", "weight"))


QUERIES = {
    "vocab_sweep": q_vocab_sweep,
    "vocab_uncapped": q_vocab_uncapped,
    "cv_refit_vocab": q_cv_refit_vocab,
    "cube_scores": q_cube_scores,
    "cv_forms": q_cv_forms,
    "grid_original": q_grid_original,
    "grid_improved": q_grid_improved,
    "grid_v2": q_grid_v2,
    "grid_refit_per_fold": q_grid_refit_per_fold,
    "ensemble_improved": q_ensemble_improved,
    "ensemble_v2": q_ensemble_v2,
    "fitted_coefficients": q_fitted_coefficients,
    "fitted_top_features": q_fitted_top_features,
}

# ------------------------------------------------------------ oracle SQL ---
LD = f"ld AS ({tq.LABELLED_SQL})"
TRAIN = f"""{LD}, nd AS (SELECT doc_id, label, split, {S.normalize('text')} AS text FROM ld),
    trn AS (SELECT doc_id, label FROM nd WHERE split = 'train')"""
FOLDS = f"""fr AS (SELECT doc_id, label, {S.hash32("'42:fold:' || CAST(doc_id AS VARCHAR)")} % {va.N_BUCKETS} AS bucket FROM trn),
    fc AS (SELECT label, bucket, count(*) AS cnt FROM fr GROUP BY label, bucket),
    fs AS (SELECT label, bucket, coalesce(sum(cnt) OVER (PARTITION BY label ORDER BY bucket
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM fc),
    fk AS (SELECT doc_id, label, bucket, row_number() OVER (PARTITION BY label, bucket ORDER BY doc_id) AS rn FROM fr),
    fd AS (SELECT fk.doc_id, fk.label, CAST((start + rn - 1) % {K} AS INTEGER) AS fold
           FROM fk JOIN fs ON fk.label = fs.label AND fk.bucket = fs.bucket),
    sl AS (SELECT CAST(range - 1 AS INTEGER) AS slot FROM range({K + 1})),
    sz AS (SELECT slot, count(*) AS n, sum(label) AS np FROM fd, sl WHERE fold <> slot GROUP BY slot),
    ds AS (SELECT doc_id, -1 AS slot FROM nd UNION ALL SELECT doc_id, fold AS slot FROM fd)"""


def _slot_sql(spec, p: str) -> str:
    """CTEs {p}counts, {p}st (slot statistics), {p}vc (slot vocabularies)."""
    return f"""
    {p}counts AS ({tq._counts_sql(tq._rows_sql(spec))}),
    {p}st AS (SELECT slot, term, count(*) AS df, sum(tf) AS cf, sum(label) AS pos
              FROM {p}counts JOIN fd USING (doc_id), sl WHERE fold <> slot GROUP BY slot, term),
    {p}rk AS (SELECT *, row_number() OVER (PARTITION BY slot ORDER BY cf DESC, term) AS rn FROM {p}st WHERE df >= {spec.min_df}),
    {p}vc AS (SELECT slot, term, CAST(row_number() OVER (PARTITION BY slot ORDER BY term) - 1 AS INTEGER) AS idx,
                     ln((1 + n)::DOUBLE / (1 + df)) + 1 AS idf FROM {p}rk JOIN sz USING (slot) WHERE rn <= {spec.max_features})"""


def _scores_sql(p: str, form: str) -> str:
    """CTE {p}sc (doc_id, slot, dot): a block's dot product for the slots of ``ds``."""
    vocab = (f"SELECT slot, term, idf FROM {p}vc" if form == "refit" else
             f"SELECT sl.slot, term, idf FROM {p}vc, sl WHERE {p}vc.slot = -1")
    q = f"{p}{form}_"
    return f"""
    {q}wt AS (SELECT slot, term, idf, ln(((coalesce(pos, 0) + 1.0::DOUBLE) * CAST(n - np + 2 AS DOUBLE))
        / ((coalesce(df, 0) - coalesce(pos, 0) + 1.0::DOUBLE) * CAST(np + 2 AS DOUBLE))) AS w
        FROM ({vocab}) JOIN sz USING (slot) LEFT JOIN {p}st USING (slot, term)),
    {q}sc AS (SELECT doc_id, slot, sum(raw * w) / sqrt(sum(raw * raw)) AS dot FROM (
        SELECT doc_id, slot, (1 + ln(tf)) * idf AS raw, w FROM {p}counts JOIN ds USING (doc_id) JOIN {q}wt USING (slot, term))
        GROUP BY doc_id, slot)"""


def _models_sql(parts: list[tuple[str, str]]) -> str:
    """experiment, slot, doc_id, split, label, score from [(experiment, join CTEs)]."""
    out = []
    for name, ctes in parts:
        joins = " ".join(f"LEFT JOIN {c} ON {c}.doc_id = ds.doc_id AND {c}.slot = ds.slot" for c in ctes.split())
        total = " + ".join(f"coalesce({c}.dot, 0.0::DOUBLE)" for c in ctes.split())
        out.append(f"SELECT '{name}' AS experiment, ds.slot, ds.doc_id, split, label, ({INTERCEPT}::DOUBLE) + {total} AS score "
                   f"FROM ds JOIN nd ON nd.doc_id = ds.doc_id {joins}")
    return " UNION ALL ".join(out)


SWEEP_SQL = ",".join(tq.tfidf_sql_ctes(s, f"v{i}_", fit_on="trn") for i, s in enumerate(SWEEP))
SWEEP_ROWS = " UNION ALL ".join(
    f"SELECT '{vo.variant_name(s)}' AS variant, term, idx, df, cf, round(idf, {R}) AS idf FROM v{i}_vocab" for i, s in enumerate(SWEEP))

ORACLE = {
    "vocab_sweep": f"WITH {TRAIN}, {SWEEP_SQL} {SWEEP_ROWS}",
    "vocab_uncapped": f"""WITH {TRAIN}, cnt AS ({tq._counts_sql(S.word_ngram_rows('nd', 'text', 1, 2))}),
        st AS (SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS cf FROM cnt WHERE doc_id IN (SELECT doc_id FROM trn) GROUP BY term)
        SELECT term, CAST(row_number() OVER (ORDER BY term) - 1 AS INTEGER) AS idx, df, cf,
               round(ln((1 + (SELECT count(*) FROM trn))::DOUBLE / (1 + df)) + 1, {R}) AS idf FROM st""",
    "cv_refit_vocab": f"""WITH {TRAIN}, {FOLDS}, {_slot_sql(fe.WORD_1_2, 'w_')}
        SELECT CASE WHEN slot < 0 THEN 'shared' ELSE 'refit' END AS form, slot AS fold, term, idx, round(idf, {R}) AS idf FROM w_vc""",
    "cube_scores": f"""WITH {TRAIN}, {FOLDS}, {_slot_sql(fe.WORD_1_2, 'a_')}, {_slot_sql(COMBINED[0], 'b_')}, {_slot_sql(COMBINED[1], 'c_')},
        {_scores_sql('a_', 'shared')}, {_scores_sql('b_', 'shared')}, {_scores_sql('c_', 'shared')},
        al AS ({_models_sql([('word', 'a_shared_sc'), ('combined', 'b_shared_sc c_shared_sc')])})
        SELECT experiment, slot, doc_id, split, label, round(score, {R}) AS score, round({S.sigmoid('score')}, {R}) AS prob,
               CAST(score > 0 AS INTEGER) AS prediction FROM al""",
    "cv_forms": f"""WITH {TRAIN}, {FOLDS}, {_slot_sql(fe.WORD_1_2, 'a_')}, {_scores_sql('a_', 'shared')}, {_scores_sql('a_', 'refit')},
        al AS ({_models_sql([('shared', 'a_shared_sc'), ('refit', 'a_refit_sc')])}),
        held AS (SELECT experiment AS form, slot AS fold, label, CAST(score > 0 AS INTEGER) AS prediction FROM al WHERE slot >= 0),
        {eq.metric_ctes('held', ['form', 'fold'], 'z_')}
        SELECT form, fold, round(macro_f1, {R}) AS macro_f1, n FROM z_mb""",
}
