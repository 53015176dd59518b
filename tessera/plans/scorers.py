"""Deterministic scorers over the labelled corpus.

Real model fits are not SQL-expressible, so the evaluation, ensemble and
leaderboard queries run on four scorers that both Spark and the DuckDB
oracle can compute from the documents: a lexicon-hit count, an md5 coin,
a log-length score and a full-stop density.  Each yields a decision value
``score``, ``prob = sigmoid(score)`` and ``prediction = prob >= 0.5``.

The long prediction table comes from ONE scan of the corpus: every row
explodes into one row per scorer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.numeric import apply_threshold, hash_uniform, sigmoid
from tessera.plans import sqlbits as S

# Words of the lexicon scorer, and terms that the sanitizer's queries mask besides
# the reference's: seen in the positive documents of the given tables.
DATA_TERMS = ("idiot", "moron", "worthless", "clown")
SCORERS = ("coin", "length", "lexicon", "punct")


def _occurrences(lt, term: str):
    return (F.char_length(lt) - F.char_length(F.replace(lt, F.lit(term), F.lit("")))) / F.lit(float(len(term)))


def scorer_predictions(corpus: DataFrame) -> DataFrame:
    """(experiment, doc_id, split, label, score, prob, prediction)."""
    lt = F.lower("text")
    ln = F.char_length("text")
    hits = sum((_occurrences(lt, t) for t in DATA_TERMS[1:]), _occurrences(lt, DATA_TERMS[0]))
    dots = F.char_length("text") - F.char_length(F.replace(F.col("text"), F.lit("."), F.lit("")))
    scores = {
        "coin": (hash_uniform(F.concat(F.lit("coin:"), F.col("doc_id").cast("string"))) - F.lit(0.5)) * F.lit(6.0),
        "length": F.log(F.lit(1.0) + ln) - F.lit(7.5),
        "lexicon": F.lit(1.5) * hits - F.lit(1.0),
        "punct": dots * F.lit(100.0) / F.greatest(ln, F.lit(1)) - F.lit(1.5),
    }
    rows = F.explode(F.array(*[F.struct(F.lit(k).alias("experiment"), v.cast("double").alias("score"))
                               for k, v in scores.items()]))
    out = corpus.select("doc_id", "split", "label", rows.alias("s")).select(
        "s.experiment", "doc_id", "split", "label", "s.score")
    return out.withColumn("prob", sigmoid("score")).withColumn("prediction", apply_threshold("prob", 0.5))


def _occ_sql(lt: str, term: str) -> str:
    return f"((length({lt}) - length(replace({lt}, {S.lit(term)}, ''))) / {float(len(term))}::DOUBLE)"


def predictions_sql(ld: str = "ld") -> str:
    """CTE body list ``sc, pr0, pred`` over the labelled-docs CTE ``ld``."""
    hits = " + ".join(_occ_sql("lt", t) for t in DATA_TERMS)
    coin = f"(({S.hash_uniform(chr(39) + 'coin:' + chr(39) + ' || CAST(doc_id AS VARCHAR)')} - 0.5::DOUBLE) * 6.0::DOUBLE)"
    return f"""
    sc AS (SELECT doc_id, split, label, text, lower(text) AS lt, length(text) AS len FROM {ld}),
    pr0 AS (
      SELECT 'coin' AS experiment, doc_id, split, label, {coin} AS score FROM sc
      UNION ALL SELECT 'length', doc_id, split, label, ln(1.0::DOUBLE + len) - 7.5::DOUBLE FROM sc
      UNION ALL SELECT 'lexicon', doc_id, split, label, 1.5::DOUBLE * ({hits}) - 1.0::DOUBLE FROM sc
      UNION ALL SELECT 'punct', doc_id, split, label,
             (len - length(replace(text, '.', ''))) * 100.0::DOUBLE / greatest(len, 1) - 1.5::DOUBLE FROM sc),
    pred AS (SELECT experiment, doc_id, split, label, score, {S.sigmoid('score')} AS prob,
                    CAST({S.sigmoid('score')} >= 0.5::DOUBLE AS INTEGER) AS prediction FROM pr0)"""


def full_stop_model():
    """The ``punct`` scorer as a batch model: a predict factory whose logits
    are ``[0, 100 * full stops / max(length, 1) - 1.5]``."""
    import numpy as np

    def predict(texts):
        dots = np.array([t.count(".") for t in texts], dtype=float)
        chars = np.array([len(t) for t in texts], dtype=float)
        return np.stack([np.zeros_like(dots), dots * 100.0 / np.maximum(chars, 1.0) - 1.5], axis=1)
    return predict
