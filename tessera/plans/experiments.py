"""Experiment grids: vectorizer(s) + linear model (+ feature selection,
cross-validation) per named experiment, evaluated on validation and test.

The loop over experiments runs on the driver (it is configuration, not
data).  Vocabularies, training vectors and scores of all experiments and
folds come from one pass over the texts each; the metrics of all experiments
come from ONE grouped aggregate over the long prediction table.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.text import normalize_text
from tessera.operators import ensemble as en
from tessera.operators import evaluate as ev
from tessera.operators import features as fe
from tessera.operators import grams as gr
from tessera.operators import linear as ln
from tessera.operators import models as mo
from tessera.operators import report as rp
from tessera.operators import validate as va
from tessera.operators import vocab as vo
from tessera.operators.cube import cube_scores, weight_cube
from tessera.session import stored


@dataclass(frozen=True)
class Experiment:
    name: str
    vectorizers: tuple
    model: mo.ModelSpec
    select: bool = False
    cv: bool = False


# --- fixed values: the reference's experiment settings ----------------------
LR = "lr"
SVC = "svc"
BASE = (
    Experiment("word_lr", (fe.WORD_1_2,), mo.ModelSpec(LR, 4.0, max_iter=800)),
    Experiment("word_svc", (fe.WORD_1_2,), mo.ModelSpec(SVC, 1.0)),
    Experiment("char_svc", (fe.CHAR_3_5,), mo.ModelSpec(SVC, 0.5)),
)
ORIGINAL = (
    Experiment("word_lr_original", (fe.WORD_1_2_MIN3,), mo.ModelSpec(LR, 4.0, max_iter=800)),
    Experiment("word_svc_original", (fe.WORD_1_2_MIN3,), mo.ModelSpec(SVC, 1.0)),
    Experiment("char_svc_original", (fe.CHAR_3_5_MIN3,), mo.ModelSpec(SVC, 0.5)),
)
IMPROVED = (
    Experiment("word_lr_strong_reg", (fe.WORD_1_2_MIN3,), mo.ModelSpec(LR, 0.5), select=True, cv=True),
    Experiment("word_svc_strong_reg", (fe.WORD_1_2_MIN3,), mo.ModelSpec(SVC, 0.1), select=True, cv=True),
    Experiment("char_svc_strong_reg", (fe.CHAR_3_5_MIN3,), mo.ModelSpec(SVC, 0.1), select=True, cv=True),
    Experiment("word_lr_l1_reg", (fe.WORD_1_2_MIN3,), mo.ModelSpec(LR, 0.5, penalty="l1"), cv=True),
    Experiment("combined_word_char",
               (fe.VectorizerSpec("word", 1, 2, 3, 5000), fe.VectorizerSpec("char", 3, 5, 3, 3000)),
               mo.ModelSpec(LR, 0.5), cv=True),
)
V2 = (
    Experiment("word_lr_balanced", (fe.WORD_1_3,), mo.ModelSpec(LR, 1.0, balanced=True), cv=True),
    Experiment("word_svc_balanced", (fe.WORD_1_3,), mo.ModelSpec(SVC, 0.5, balanced=True), cv=True),
    Experiment("word_lr_higher_c", (fe.WORD_1_3,), mo.ModelSpec(LR, 10.0), cv=True),
    Experiment("word_lr_tri_gram", (fe.WORD_1_3,), mo.ModelSpec(LR, 2.0), cv=True),
    Experiment("char_wider_range", (fe.CHAR_3_6,), mo.ModelSpec(SVC, 0.3), cv=True),
    Experiment("combined_features",
               (fe.VectorizerSpec("word", 1, 3, 2, 6000), fe.VectorizerSpec("char", 3, 6, 2, 4000)),
               mo.ModelSpec(LR, 1.0), cv=True),
    Experiment("word_lr_l2_strong", (fe.WORD_1_3,), mo.ModelSpec(LR, 0.1, intercept="free"), cv=True),
)
SELECTOR = mo.ModelSpec(LR, 0.5, max_iter=500)
# ----------------------------------------------------------------------------


def normalized_corpus(corpus: DataFrame) -> DataFrame:
    return corpus.select("doc_id", normalize_text("text").alias("text"), "label", "split")


@dataclass
class Fitted:
    """What a grid knows of one experiment: its columns and its model's weights."""
    size: int                     # columns the model was fitted on
    weights: object               # numpy, one entry per vocabulary column, 0 where dropped
    intercept: float
    converged: bool


@dataclass
class GridResult:
    predictions: DataFrame        # experiment, doc_id, split, label, score, prob, prediction
    table: DataFrame              # one row per experiment (+ cv columns when run)
    features: dict[str, Fitted] = field(default_factory=dict)
    coefficients: DataFrame | None = None   # experiment, feature, idx, weight
    folds: DataFrame | None = None          # experiment, fold, macro_f1


def _fitted(model: ln.LinearModel, size: int, job: ln.Job) -> Fitted:
    """A model's weights by vocabulary column."""
    w = model.coefficients.toArray()
    intercept = w[-1] if job.spec.intercept == "penalised" else model.intercept
    return Fitted(size if job.kept is None else len(job.kept), w[:size], float(intercept), model.converged)


def run_grid(corpus: DataFrame, experiments: Sequence[Experiment], k: int = 5, refit_per_fold: bool = False,
             parallelism: int = 8) -> GridResult:
    """Fit, cross-validate, score and evaluate every experiment; ``corpus``
    carries doc_id, text (already preprocessed), label, split.

    All vocabularies come from one pass over the training texts for each kind, the
    training vectors from one for each set of vocabularies, all scores (every
    model, every fold) from one more for each kind.
    The models and folds of one set of vectors are fitted together, one Spark job for
    each step of all; up to ``parallelism`` sets run at a time.  Folds share the vocabularies and selectors of the
    whole train split, as in the reference; with ``refit_per_fold`` each fold has
    its own, fitted without it.
    """
    from concurrent.futures import ThreadPoolExecutor

    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    spark = corpus.sparkSession
    specs = list(dict.fromkeys(v for e in experiments for v in e.vectorizers))
    slots = [-1, *range(k)] if any(e.cv for e in experiments) else [-1]
    fitted_slots = slots if refit_per_fold else [-1]
    folds = va.stratified_folds(corpus.where(F.col("split") == "train"), k=k).select("doc_id", "fold")
    # every pass below reads the preprocessed texts with their folds
    corpus = stored(corpus.select("doc_id", "text", "label", "split").join(folds, "doc_id", "left"), "grid-corpus")
    train = corpus.where((F.col("split") == "train") & F.col("fold").isNotNull())
    vocabs = stored(vo.fit_vocabs(train, specs, k, refit_per_fold), "grid-vocabs")
    sizes = {(r.variant, r.slot): r.n for r in vocabs.groupBy("variant", "slot").agg(F.count(F.lit(1)).alias("n")).collect()}
    arrays = None
    if fe.capped(*specs):
        table = vocabs.select("variant", "slot", "term", "idx", "idf").toArrow()
        arrays = {(v, slot): gr.vocabulary(specs[v], table.filter((pc.field("variant") == v) & (pc.field("slot") == slot)))
                  for v in range(len(specs)) for slot in fitted_slots}
    else:
        long = stored(vo.tfidf_many(train, vocabs, specs, refit_per_fold), "grid-tfidf")

    def columns(exp: Experiment, slot: int) -> list[tuple[int, int, int]]:
        """(variant, offset, size) of the blocks of an experiment in a fitted slot."""
        out, at = [], 0
        for v in map(specs.index, exp.vectorizers):
            out.append((v, at, sizes.get((v, slot), 0)))
            at += out[-1][2]
        return out

    def home(slot: int) -> int:
        return slot if refit_per_fold else -1

    def width(exp: Experiment, slot: int) -> int:
        return sum(n for _, _, n in columns(exp, home(slot)))

    def packed(exp: Experiment, slot: int) -> ln.Blocks:
        """The training vectors under the vocabularies of a fitted slot."""
        at = columns(exp, slot)
        docs = train.where(F.col("fold") != slot) if slot >= 0 else train
        size = sum(n for _, _, n in at)
        if arrays is not None:
            rows = mo.packed_rows(docs, [(arrays[v, slot], o) for v, o, _ in at], ("label", "split", "fold"))
            fs = mo.FeatureSet(None, docs, size, [], rows)
        else:
            offset = F.create_map(*[x for v, o, _ in at for x in (F.lit(v), F.lit(o))])
            part = (long.where(F.col("variant").isin([v for v, _, _ in at]) & (F.col("slot") == slot))
                    .select("doc_id", (F.col("idx") + offset[F.col("variant")]).alias("idx"), "value"))
            fs = mo.FeatureSet(part, docs.select("doc_id", "label", "split", "fold"), size, [])
        return ln.pack(mo.entries(fs, carry=("label", "fold")), size, "fold")

    tasks = [(e, s) for e in experiments for s in (slots if e.cv else [-1])]
    sets: dict = {}
    for e, s in tasks:
        sets.setdefault((e.vectorizers, home(s)), []).append((e, s))

    def fit(members: list[tuple[Experiment, int]]) -> list[Fitted]:
        """All models of one set of vectors."""
        exp, slot = members[0]
        rows, size = packed(exp, home(slot)), width(exp, slot)
        kept = None
        with ln.held(rows):
            if any(e.select for e, _ in members):
                # columns whose weight in a selector is at least the median; a model's
                # weights are on the driver, one per vocabulary column
                w = np.abs(ln.fit_many(rows, [ln.Job(SELECTOR)])[0].coefficients.toArray()[:size])
                kept = np.flatnonzero(w >= np.median(w)) if size else np.arange(0)
            jobs = [ln.Job(e.model, s if s >= 0 and home(s) < 0 else None, kept if e.select else None) for e, s in members]
            return [_fitted(m, size, j) for m, j in zip(ln.fit_many(rows, jobs), jobs)]

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        done = {(e.name, s): m for members, models in zip(sets.values(), pool.map(fit, sets.values()))
                for (e, s), m in zip(members, models)}

    blocks = [(e.name, specs.index(v)) for e in experiments for v in e.vectorizers]
    parts = []
    for exp, slot in tasks:
        model = done[(exp.name, slot)]
        for v, offset, n in columns(exp, home(slot)):
            w = model.weights[offset:offset + n]
            at = w.nonzero()[0]
            parts.append(pa.table({"block": pa.array([blocks.index((exp.name, v))] * len(at), pa.int32()),
                                   "slot": pa.array([slot] * len(at), pa.int32()), "idx": pa.array(at, pa.int32()),
                                   "weight": pa.array(w[at], pa.float64())}))
    weights = spark.createDataFrame(pa.concat_tables(parts))
    variant_of = F.create_map(*[x for b, (_, v) in enumerate(blocks) for x in (F.lit(b), F.lit(v))])
    fitted_in = F.col("slot") if refit_per_fold else F.lit(-1)
    named = (weights.withColumns({"variant": variant_of[F.col("block")], "home": fitted_in})
             .join(vocabs.select("variant", F.col("slot").alias("home"), "idx", "term"), ["variant", "home", "idx"])
             .select("block", "slot", "term", "weight", "idx"))
    named = stored(named, "grid-weights")
    cube = weight_cube(vocabs, named, specs, blocks, slots)
    docs = corpus.withColumn(
        "slots", F.array_compact(F.array(F.lit(-1), F.when(F.lit(len(slots) > 1), F.col("fold")))))
    scored = stored(cube_scores(docs, cube, specs, blocks, slots, {key: m.intercept for key, m in done.items()}), "grid-scores")
    preds = scored.where("slot = -1").drop("slot")
    table = rp.experiment_table(ev.metric_bundle(preds, ["experiment", "split"]))
    cv_names = [e.name for e in experiments if e.cv]
    fold_scores = None
    if cv_names:
        held = scored.where((F.col("slot") >= 0) & F.col("experiment").isin(cv_names)).withColumnRenamed("slot", "fold")
        fold_scores = stored(ev.metric_bundle(held, ["experiment", "fold"]).select("experiment", "fold", "macro_f1"), "grid-cv")
        table = table.join(va.cv_summary(fold_scores).select("experiment", "cv_mean", "cv_std"), "experiment", "left")
    offsets = {}
    for exp in experiments:
        for v, offset, _ in columns(exp, -1):
            offsets[blocks.index((exp.name, v))] = offset
    tag = lambda m: F.create_map(*[x for b, y in m.items() for x in (F.lit(b), F.lit(y))])[F.col("block")]
    coef = named.where("slot = -1").select(tag({b: n for b, (n, _) in enumerate(blocks)}).alias("experiment"),
                                           F.col("term").alias("feature"), (F.col("idx") + tag(offsets)).alias("idx"), "weight")
    return GridResult(preds, table, {e.name: done[(e.name, -1)] for e in experiments}, coef, fold_scores)


ENSEMBLES = {"soft": "ensemble_top3", "majority": "voting_ensemble"}


def ensemble_votes(res: GridResult, kind: str = "soft", k: int = 3) -> DataFrame:
    """Votes of the k best experiments by validation macro-F1, with the members
    beside each vote: ``members`` is ordered by rank, (experiment, weight, output).

    ``soft``: validation-macro-F1-weighted mean of the members' sigmoid decision
    values >= 0.5; ``majority``: mean member vote >= 0.5, weights 1.
    """
    if kind not in ENSEMBLES:
        raise ValueError(kind)
    members = en.ranked_members(res.table, k, weighted=kind == "soft")
    return en.vote_with_members(res.predictions, members, "prob" if kind == "soft" else "prediction")


def ensemble_row(votes: DataFrame, name: str) -> DataFrame:
    """Result-table row of an ensemble with its members and weights."""
    ens = rp.experiment_table(ev.metric_bundle(votes.withColumn("experiment", F.lit(name)), ["experiment", "split"]))
    # the members' names and weights are the same in every vote
    who = votes.agg(F.first(F.transform("members", lambda m: F.struct(m["experiment"], m["weight"]))).alias("members"))
    return ens.join(F.broadcast(who))  # one row


def with_ensemble(res: GridResult, kind: str = "soft", k: int = 3, name: str | None = None) -> DataFrame:
    """Append a top-k voting ensemble to a grid's result table; the ensemble row
    has no CV columns and lists its members, which are null in all others."""
    votes = stored(ensemble_votes(res, kind, k), "ensemble-votes")
    return rp.append_rows(res.table, ensemble_row(votes, name or ENSEMBLES[kind]))


def experiment_config(spark: SparkSession, experiments: Sequence[Experiment]) -> DataFrame:
    """(experiment, config): each experiment's settings as JSON with sorted keys."""
    rows = [(e.name, json.dumps({"vectorizers": [asdict(v) for v in e.vectorizers], "model": asdict(e.model),
                                 "select": e.select, "cv": e.cv}, sort_keys=True, separators=(",", ":"))) for e in experiments]
    return spark.createDataFrame(rows, "experiment string, config string")
