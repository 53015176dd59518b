"""A bounded sample of labelled texts for fitting a classifier."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import fold, written


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int, max_bytes: int,
                    held_out_fold: int = 1, max_text_bytes: int | None = None) -> list[tuple[int, str, int]]:
    """(doc_id, text, label) rows for fitting, whole texts, in a fixed order.

    Takes, for each class, the ``per_class`` labelled ids outside the held-out
    fold that have the smallest hash, and of their texts, in that order, as
    many as fit into ``max_bytes`` bytes of UTF-8 for each class.  Both bounds
    hold whatever the size of the corpus.  A text of over ``max_text_bytes``
    (an eighth of ``max_bytes`` if not given) is left out, so that a few long
    texts do not take the place of all others: raise it, up to ``max_bytes``,
    where long texts are to be learnt from.
    """
    known = (labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
             .where(fold(F.col("doc_id")) != held_out_fold)
             .groupBy("doc_id").agg(F.max(label).alias("y")).withColumn("h", F.xxhash64("doc_id")))
    picked = None
    for y in (0, 1):
        part = known.where(F.col("y") == y).orderBy("h", "doc_id").limit(per_class)
        picked = part if picked is None else picked.unionByName(part)
    picked = written(picked, "label-sample")  # at most 2 * per_class rows
    texts = (docs.select(F.col("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
             .join(F.broadcast(picked), "doc_id").withColumn("b", F.octet_length("text")))
    longest = max_bytes // 8 if max_text_bytes is None else max_text_bytes
    first = (texts.where(F.col("b") <= longest)
             .withColumn("rn", F.row_number().over(Window.partitionBy("doc_id").orderBy("text"))).where("rn = 1"))
    room = Window.partitionBy("y").orderBy("h", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    rows = first.withColumn("used", F.sum("b").over(room)).where(F.col("used") <= max_bytes)
    return [(r.doc_id, r.text, r.y) for r in rows.orderBy("h", "doc_id").select("doc_id", "text", "y").collect()]


def fit_logistic(x, y, ridge: float = 1e-3, steps: int = 50):
    """Weights (last one the intercept) of a ridge logistic regression by
    Newton steps; a handful of columns only."""
    import numpy as np

    a = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(a.shape[1])
    pen = np.full(a.shape[1], ridge)
    pen[-1] = 1e-9
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -35, 35)))
        g = a.T @ (p - y) / len(y) + pen * w
        h = (a * (p * (1 - p))[:, None]).T @ a / len(y) + np.diag(pen + 1e-9)
        step = np.linalg.solve(h, g)
        step *= min(1.0, 4.0 / max(np.abs(step).max(), 1e-12))
        w = w - step
        if np.abs(step).max() < 1e-9:
            break
    return w
