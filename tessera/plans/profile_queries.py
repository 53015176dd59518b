"""Registered queries: corpus profile, class weights, folds, augmentation."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import text as tx
from tessera.operators import profile as pr
from tessera.operators import validate as va
from tessera.plans import sqlbits as S
from tessera.plans.text_queries import LABELLED_SQL
from tessera.sources.corpus import all_docs, labelled_docs

R = 6
LD = f"ld AS ({LABELLED_SQL})"


def q_split_counts(spark, sf_dir):
    return pr.split_counts(labelled_docs(spark, sf_dir))


def q_label_counts(spark, sf_dir):
    return pr.label_counts(labelled_docs(spark, sf_dir))


def q_text_length_stats(spark, sf_dir):
    s = pr.text_length_stats(labelled_docs(spark, sf_dir))
    return s.select("split", F.round("avg_len", R).alias("avg_len"), "median_len", "max_len")


def q_length_boxplot(spark, sf_dir):
    return pr.length_boxplot(labelled_docs(spark, sf_dir))


def q_corpus_profile(spark, sf_dir):
    p = pr.corpus_profile(labelled_docs(spark, sf_dir), "parquet")
    return p.withColumn("avg_text_len_chars_train", F.round("avg_text_len_chars_train", R))


def q_class_weights(spark, sf_dir):
    w = va.class_weights(labelled_docs(spark, sf_dir))
    return w.select("label", "n_class", F.round("weight", R).alias("weight"))


def q_stratified_folds(spark, sf_dir):
    return va.stratified_folds(labelled_docs(spark, sf_dir))


def q_augment_dropout(spark, sf_dir):
    d = all_docs(spark, sf_dir)
    return d.select("doc_id", tx.augment_dropout("text", "doc_id").alias("text_aug"))


def q_augment_swap(spark, sf_dir):
    d = all_docs(spark, sf_dir)
    return d.select("doc_id", tx.augment_swap("text", "doc_id").alias("text_aug"))


FOLD_SQL = f"""
WITH {LD},
r AS (SELECT doc_id, label, {S.hash32("'42:fold:' || CAST(doc_id AS VARCHAR)")} % {va.N_BUCKETS} AS bucket FROM ld),
c AS (SELECT label, bucket, count(*) AS cnt FROM r GROUP BY label, bucket),
s AS (SELECT label, bucket, coalesce(sum(cnt) OVER (PARTITION BY label ORDER BY bucket
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM c),
k AS (SELECT doc_id, label, bucket, row_number() OVER (PARTITION BY label, bucket ORDER BY doc_id) AS rn FROM r)
SELECT k.doc_id, k.label, CAST((s.start + k.rn - 1) % 5 AS INTEGER) AS fold
FROM k JOIN s ON k.label = s.label AND k.bucket = s.bucket"""

_LEN = "length(text)"
ORACLE = {
    "split_counts": f"WITH {LD} SELECT split, count(*) AS n FROM ld GROUP BY split",
    "label_counts": f"WITH {LD} SELECT split, label, count(*) AS n FROM ld GROUP BY split, label",
    "text_length_stats": (f"WITH {LD} SELECT split, round(avg({_LEN}), {R}) AS avg_len, "
                          f"quantile_cont({_LEN}, 0.5) AS median_len, CAST(max({_LEN}) AS INTEGER) AS max_len FROM ld GROUP BY split"),
    "length_boxplot": f"""
        WITH {LD}, l AS (SELECT split, CAST({_LEN} AS INTEGER) AS len FROM ld),
        q AS (SELECT split, quantile_cont(len, 0.25) AS q1, quantile_cont(len, 0.5) AS median,
                     quantile_cont(len, 0.75) AS q3 FROM l GROUP BY split)
        SELECT l.split, q1, median, q3,
               min(CASE WHEN len >= q1 - 1.5 * (q3 - q1) THEN len END) AS whisker_lo,
               max(CASE WHEN len <= q3 + 1.5 * (q3 - q1) THEN len END) AS whisker_hi,
               min(len) AS min_len, max(len) AS max_len, count(*) AS n
        FROM l JOIN q ON l.split = q.split GROUP BY l.split, q1, median, q3""",
    "corpus_profile": f"""
        WITH {LD} SELECT 'parquet' AS source,
          count(*) FILTER (WHERE split = 'train') AS n_train,
          count(*) FILTER (WHERE split = 'validation') AS n_validation,
          count(*) FILTER (WHERE split = 'test') AS n_test,
          count(*) FILTER (WHERE split = 'train' AND label = 0) AS train_label_0,
          count(*) FILTER (WHERE split = 'train' AND label = 1) AS train_label_1,
          round(avg({_LEN}) FILTER (WHERE split = 'train'), {R}) AS avg_text_len_chars_train,
          quantile_cont({_LEN}, 0.5) FILTER (WHERE split = 'train') AS median_text_len_chars_train,
          CAST(max({_LEN}) FILTER (WHERE split = 'train') AS INTEGER) AS max_text_len_chars_train
        FROM ld""",
    "class_weights": f"""
        WITH {LD}, c AS (SELECT label, count(*) AS n_class FROM ld GROUP BY label)
        SELECT label, n_class, round(CAST(sum(n_class) OVER () AS DOUBLE) / (count(*) OVER () * n_class), {R}) AS weight FROM c""",
    "stratified_folds": FOLD_SQL,
    "augment_dropout": f"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
        k AS (SELECT doc_id, text, list_filter({S.split_words('text')},
               lambda w, i: {S.hash_uniform("'42:' || CAST(doc_id AS VARCHAR) || ':' || CAST(i - 1 AS VARCHAR)")} > 0.15) AS kept FROM d)
        SELECT doc_id, CASE WHEN len(kept) > 0 THEN array_to_string(kept, ' ') ELSE text END AS text_aug FROM k""",
    "augment_swap": f"""
        WITH d AS (SELECT doc_id, {S.split_words("coalesce(text, '')")} AS words FROM documents),
        k AS (SELECT doc_id, words, len(words) AS n,
                     CAST(floor({S.hash_uniform("'42:' || CAST(doc_id AS VARCHAR)")} * (len(words) - 1)) AS INTEGER) AS idx FROM d)
        SELECT doc_id, CASE WHEN n > 1 THEN array_to_string(list_transform(words, lambda w, i:
                 CASE WHEN i - 1 = idx THEN words[idx + 2] WHEN i - 1 = idx + 1 THEN words[idx + 1] ELSE w END), ' ')
               ELSE array_to_string(words, ' ') END AS text_aug FROM k""",
}

QUERIES = {
    "split_counts": q_split_counts,
    "label_counts": q_label_counts,
    "text_length_stats": q_text_length_stats,
    "length_boxplot": q_length_boxplot,
    "corpus_profile": q_corpus_profile,
    "class_weights": q_class_weights,
    "stratified_folds": q_stratified_folds,
    "augment_dropout": q_augment_dropout,
    "augment_swap": q_augment_swap,
}
