"""Voting ensembles over a long prediction table.

Models' outputs are rows ``(experiment, doc_id, ..., prediction, prob)``; an
ensemble is one ``groupBy(doc_id)`` -- no n-way join of model outputs.  The
member list (and its weights) is a table with one row per member model, so
its broadcast is bounded by the number of members.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _members(pred: DataFrame, members: DataFrame, key: str) -> DataFrame:
    return pred.join(F.broadcast(members), key)


def top_members(leaderboard: DataFrame, k: int = 3, key: str = "experiment",
                score: str = "val_macro_f1") -> DataFrame:
    """The k best models by validation macro-F1 (ties by name)."""
    return leaderboard.orderBy(F.desc(score), F.asc(key)).limit(k).select(key, score)


def majority_vote(pred: DataFrame, members: DataFrame, group: Sequence[str] = ("doc_id", "split", "label"),
                  key: str = "experiment") -> DataFrame:
    """Mean member prediction >= 0.5 -> 1 (a tie goes to 1)."""
    return (_members(pred, members.select(key), key)
            .groupBy(*group)
            .agg((F.avg("prediction") >= F.lit(0.5)).cast("int").alias("prediction"),
                 F.count(F.lit(1)).alias("n_members")))


def normalised_weights(members: DataFrame, key: str = "experiment", score: str = "val_macro_f1") -> DataFrame:
    """w / sum(w) over the member table (a handful of rows)."""
    from pyspark.sql import Window
    total = F.sum(score).over(Window.partitionBy())
    return members.select(key, (F.col(score) / total).alias("weight"))


def soft_vote(pred: DataFrame, weights: DataFrame, group: Sequence[str] = ("doc_id", "split", "label"),
              key: str = "experiment", prob: str = "prob") -> DataFrame:
    """Weighted average of member probabilities >= 0.5 -> 1.

    ``prob`` is the sigmoid of the decision value (or the class-1
    probability) per member; the average divides by the weight total.
    """
    j = _members(pred, weights.select(key, "weight"), key)
    avg_p = F.sum(F.col("weight") * F.col(prob)) / F.sum("weight")
    return (j.groupBy(*group)
            .agg(avg_p.alias("prob"))
            .withColumn("prediction", (F.col("prob") >= F.lit(0.5)).cast("int")))


def weighted_vote(pred: DataFrame, weights: DataFrame | None = None,
                  group: Sequence[str] = ("doc_id", "split", "label"), key: str = "experiment",
                  members: DataFrame | None = None) -> DataFrame:
    """Weighted SUM of 0/1 predictions >= 0.5 -> 1; weights are not
    normalised and default to 1 each, so any one positive member wins."""
    if weights is None:
        base = members.select(key) if members is not None else pred.select(key).distinct()
        weights = base.withColumn("weight", F.lit(1.0))
    j = _members(pred, weights.select(key, "weight"), key)
    return (j.groupBy(*group)
            .agg(F.sum(F.col("weight") * F.col("prediction")).alias("vote"))
            .withColumn("prediction", (F.col("vote") >= F.lit(0.5)).cast("int")))


def ranked_members(leaderboard: DataFrame, k: int = 3, key: str = "experiment", score: str = "val_macro_f1",
                   weighted: bool = True) -> DataFrame:
    """(experiment, rank, weight) of the k best models (ties by name); weights are
    the scores divided by their sum, or 1 each."""
    from pyspark.sql import Window
    top = top_members(leaderboard, k, key, score)  # k rows: the windows run over those
    rank = F.row_number().over(Window.orderBy(F.desc(score), F.asc(key)))
    weight = F.col(score) / F.sum(score).over(Window.partitionBy()) if weighted else F.lit(1.0)
    return top.select(key, rank.alias("rank"), weight.alias("weight"))


def vote_with_members(pred: DataFrame, members: DataFrame, output: str, group: Sequence[str] = ("doc_id", "split", "label"),
                      key: str = "experiment") -> DataFrame:
    """(group..., prob, prediction, members): the weighted mean of the members'
    ``output`` (probabilities for a soft vote, 0/1 predictions for a majority)
    >= 0.5, beside who voted what: ``members`` is an array of (experiment, weight,
    output) in rank order."""
    entry = F.struct("rank", F.col(key).alias("experiment"), "weight", F.col(output).cast("double").alias("output"))
    votes = _members(pred, members, key).groupBy(*group).agg(F.array_sort(F.collect_list(entry)).alias("m"))
    total = lambda f: F.aggregate("m", F.lit(0.0), lambda a, x: a + f(x))
    prob = total(lambda x: x["weight"] * x["output"]) / total(lambda x: x["weight"])
    return (votes.select(*group, prob.alias("prob"),
                         F.transform("m", lambda x: F.struct(x["experiment"], x["weight"], x["output"])).alias("members"))
            .select(*group, "prob", (F.col("prob") >= 0.5).cast("int").alias("prediction"), "members"))
